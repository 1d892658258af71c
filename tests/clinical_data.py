"""A small seeded clinical data set for tests."""

import numpy as np
import pandas as pd

CULTURE = "blood"


def make(folder, n=400, seed=3):
    rng = np.random.default_rng(seed)
    base = pd.Timestamp("2020-01-01")
    ids = [f"h{i}" for i in range(n)]
    patient = [f"p{i % (n * 3 // 4)}" for i in range(n)]
    admitted = base + pd.to_timedelta(rng.integers(0, 1500 * 86400, n), unit="s")
    hospital = rng.integers(0, 4, n)
    index = admitted + pd.to_timedelta(rng.integers(3600, 40 * 3600, n), unit="s")
    discharged = index + pd.to_timedelta(rng.integers(86400, 12 * 86400, n), unit="s")
    tables = {}
    tables["patient"] = pd.DataFrame({
        "patient_id": sorted(set(patient))}).assign(
        sex_category=lambda d: rng.choice(["Male", "Female"], len(d)),
        race_category=lambda d: rng.choice(["White", "Black", "Asian", "Other"], len(d)),
        ethnicity_category=lambda d: rng.choice(["Hispanic", "Non-Hispanic"], len(d)))
    tables["hospitalization"] = pd.DataFrame({
        "patient_id": patient, "hospitalization_id": ids, "admission_dttm": admitted,
        "discharge_dttm": discharged, "age_at_admission": rng.integers(14, 95, n).astype(float),
        "admission_type_category": "ed",
        "discharge_category": rng.choice(["Home", "Expired"], n, p=[0.8, 0.2])})
    place = rng.choice(["ED", "ICU", "ward"], n, p=[0.4, 0.5, 0.1])
    unit = rng.choice(["medical_icu", "surgical_icu", "cardiac_icu"], n)
    tables["adt"] = pd.DataFrame({
        "hospitalization_id": ids, "hospital_id": [f"s{h}" for h in hospital],
        "hospital_type": np.where(hospital % 2, "Academic", "Community"),
        "location_category": place, "location_type": unit, "in_dttm": admitted,
        "out_dttm": discharged})
    tables["hospital_diagnosis"] = pd.DataFrame({
        "hospitalization_id": np.repeat(ids, 2),
        "diagnosis_code": rng.choice(["I50.9", "E11.9", "C34.1", "Z00.0"], 2 * n),
        "diagnosis_code_format": "ICD10CM"})
    provider = hospital * 100 + rng.integers(0, 8, n)
    tables["patient_procedures"] = pd.DataFrame({
        "hospitalization_id": ids, "procedure_code": "31500", "procedure_code_format": "cpt",
        "procedure_billed_dttm": index,
        "billing_provider_id": [None if i % 37 == 0 else f"d{p}" for i, p in
                                enumerate(provider)]})
    drug = rng.choice(["Etomidate", "Ketamine"], n, p=[0.6, 0.4])
    weight = rng.normal(80, 15, n).clip(40, 150).round(1)
    per_kg = np.where(drug == "Etomidate", 0.28, 1.6) * np.exp(
        rng.normal(0, 0.2, n) + 0.12 * (provider % 8 - 3.5) / 3.5)
    dose = (per_kg * weight).round(1)
    gap = rng.choice([60, 240, 299, 301, 1200, 3000], n, p=[.4, .3, .15, .05, .05, .05])
    tables["medication_admin_intermittent"] = pd.concat([
        pd.DataFrame({"hospitalization_id": ids, "admin_dttm": index, "med_category": drug,
                      "med_dose": dose.astype(str)}),
        pd.DataFrame({"hospitalization_id": ids,
                      "admin_dttm": index + pd.to_timedelta(gap, unit="s"),
                      "med_category": rng.choice(["rocuronium", "succinylcholine"], n),
                      "med_dose": (weight * 1.1).round(1).astype(str)}),
        pd.DataFrame({"hospitalization_id": ids[::19], "admin_dttm": index[::19]
                      - pd.Timedelta(minutes=20), "med_category": "propofol",
                      "med_dose": "50"}),
        *[pd.DataFrame({"hospitalization_id": ids[::4],
                        "admin_dttm": index[::4] - pd.Timedelta(days=3 - d),
                        "med_category": "ceftriaxone", "med_dose": "1000"}) for d in range(5)],
    ]).assign(med_dose_unit="mg", mar_action_category="Given")
    tables["medication_admin_continuous"] = pd.DataFrame({
        "hospitalization_id": ids[::3], "admin_dttm": index[::3] - pd.to_timedelta(
            rng.integers(0, 30 * 3600, len(ids[::3])), unit="s"),
        "med_category": rng.choice(["Norepinephrine", "vasopressin"], len(ids[::3])),
        "med_dose": rng.uniform(0.01, 0.3, len(ids[::3]))})
    tables["respiratory_support"] = pd.concat([
        pd.DataFrame({"hospitalization_id": ids, "device_category": "IMV", "tracheostomy": 0,
                      "recorded_dttm": index + pd.to_timedelta(
                          rng.integers(0, 7 * 3600, n), unit="s")}),
        pd.DataFrame({"hospitalization_id": ids[::2], "device_category": "Nasal Cannula",
                      "tracheostomy": 0, "recorded_dttm": index[::2] - pd.Timedelta(hours=2)}),
        pd.DataFrame({"hospitalization_id": ids[::41], "device_category": "Trach Collar",
                      "tracheostomy": 1, "recorded_dttm": admitted[::41]
                      + pd.Timedelta(hours=3)})])
    vit = []
    for hours in (0.5, 3, 10, 20):
        for cat, mean in (("heart_rate", 95), ("sbp", 110), ("dbp", 60), ("map", 75),
                          ("spo2", 94)):
            some = rng.random(n) < 0.8
            vit.append(pd.DataFrame({
                "hospitalization_id": np.array(ids)[some],
                "recorded_dttm": index[some] - pd.Timedelta(hours=hours), "vital_category": cat,
                "vital_value": rng.normal(mean, 6, some.sum()).round(0).clip(55, 180)}))
    has_weight = np.arange(n) % 9 != 0
    vit.append(pd.DataFrame({
        "hospitalization_id": np.array(ids)[has_weight],
        "recorded_dttm": index[has_weight] - pd.Timedelta(hours=1),
        "vital_category": "weight_kg", "vital_value": weight[has_weight]}))
    vit.append(pd.DataFrame({
        "hospitalization_id": ids, "recorded_dttm": index + pd.Timedelta(hours=9),
        "vital_category": "weight_kg", "vital_value": weight + 1}))
    tables["vitals"] = pd.concat(vit)
    tables["labs"] = pd.DataFrame({
        "hospitalization_id": np.repeat(ids, 2), "recorded_dttm": np.repeat(
            index - pd.Timedelta(hours=4), 2), "lab_category": ["creatinine", "platelets"] * n,
        "lab_value": rng.uniform(0.5, 300, 2 * n)})
    tables["microbiology_culture"] = pd.DataFrame({
        "hospitalization_id": ids[::2], "recorded_dttm": index[::2] - pd.Timedelta(days=2),
        "fluid_category": "Blood"})
    for name, frame in tables.items():
        frame.to_parquet(f"{folder}/{name}.parquet", index=False, coerce_timestamps="us",
                         allow_truncated_timestamps=True)
    return tables
