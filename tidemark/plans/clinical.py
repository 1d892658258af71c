"""The three-step study on clinical tables: cohort, wide dataset, modeling view."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.recode import (band_within, chain, folded, lenient_double, level_of, present,
                                ratio, shortfall)
from ..operators import cohort as C, features as X, scores as S, temporal as T
from ..operators.describe import (box_stats, count_matrix, histogram, pair_timing_stats,
                                  stacked_stats)
from ..operators.quality import collapse_levels
from ..operators.subanalyses import gap_for_excluded, pre_post_change
from ..session import materialise
from ..sources.site import (Site, flow_document, load_table, write_flow, write_private,
                            write_shared)

KEY, OWNER = "hospitalization_id", "patient_id"
HOUR, DAY = 3600.0, 86400.0

# Fixed values of the study definition.
INDUCTION = ["etomidate", "ketamine"]
PARALYTIC = ["rocuronium", "succinylcholine"]
SEDATIVES = ["lorazepam", "diazepam", "midazolam", "propofol"]
PUSH_DOSE = ["phenylephrine", "epinephrine", "norepinephrine"]
VASOPRESSORS = ["norepinephrine", "vasopressin", "epinephrine", "phenylephrine", "dopamine"]
INTUBATION = "31500"
TRACHEOSTOMY = ["31600", "31601", "31603", "31605", "31610"]
FEASIBLE_DOSE = {"etomidate": (2, 100), "ketamine": (15, 300)}
WEIGHT_RANGE = (20, 300)
RESPIRATORY_LEVELS = {"room air": 1, "nasal cannula": 2, "face mask": 2, "high flow nc": 3,
                      "nippv": 4, "cpap": 4}
DEVICES = {"nasal cannula": "any_nc", "face mask": "any_facemask", "high flow nc": "any_hfno",
           "cpap": "any_cpap", "nippv": "any_nippv"}
WINDOWS = {"24hrs_prior": DAY, "6hrs_prior": 6 * HOUR, "1hr_prior": HOUR}
INDUCTION_BANDS = {
    "etomidate": ([0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60],
                  ["<0.05", "0.05-0.09", "0.10-0.14", "0.15-0.19", "0.20-0.24", "0.25-0.29",
                   "0.30-0.34", "0.35-0.39", "0.40-0.44", "0.45-0.49", "0.50-0.54",
                   "0.55-0.59", ">0.60"]),
    "ketamine": ([0.3, 0.5, 0.7, 0.9, 1.1, 1.3],
                 ["<0.3", "0.3-0.49", "0.5-0.69", "0.7-0.89", "0.9-1.09", "1.1-1.29",
                  ">=1.3"]),
}
PARALYTIC_BANDS = {
    "rocuronium": ([0.4, 0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.9],
                   ["<0.4", "0.4-0.59", "0.6-0.79", "0.8-0.99", "1.0-1.19", "1.2-1.39",
                    "1.4-1.59", "1.6-1.89", ">=1.9"]),
    "succinylcholine": ([0.25, 0.50, 0.75, 1.00, 1.25, 1.50],
                        ["<0.25", "0.25-0.49", "0.50-0.74", "0.75-0.99", "1.00-1.24",
                         "1.25-1.49", ">=1.50"]),
}
TIER_NAMES = ["reduced", "intermediate_reduced", "intermediate_full", "full"]
TIERS = {"etomidate": ([0.20, 0.25, 0.30], TIER_NAMES), "ketamine": ([1.0, 1.5, 2.0], TIER_NAMES)}
REDUCED_BELOW = {"etomidate": 0.25, "ketamine": 1.5}
REFERENCE_DOSE = {"etomidate": 0.30, "ketamine": 2.00}


@dataclass(frozen=True)
class StudyOptions:
    """Choices that differ between sites."""

    date_range: tuple[str, str] | None = ("2018-01-01", "2026-01-01")
    provider_if_missing: str | None = None
    culture_sites: list[str] = field(default_factory=lambda: ["blood"])


def _coded(procedures: DataFrame, codes: list[str]) -> DataFrame:
    return procedures.where(F.col("procedure_code").isin(codes)
                            & (F.upper("procedure_code_format") == "CPT"))


@dataclass(frozen=True)
class CohortResult:
    cohort: DataFrame
    flow: DataFrame
    pairs: DataFrame
    no_weight: DataFrame
    hospitalizations: DataFrame
    weights: DataFrame


def build_cohort(spark: SparkSession, site: Site,
                 options: StudyOptions = StudyOptions()) -> CohortResult:
    """Adults intubated in the ED or ICU after an induction drug and a paralytic."""
    stays = load_table(spark, site, "hospitalization")
    in_range: Column = F.lit(True)
    if options.date_range:
        lo, hi = (F.lit(d).cast("timestamp_ntz") for d in options.date_range)
        in_range = ((F.col("admission_dttm") >= lo) & (F.col("admission_dttm") < hi)
                    & (F.col("discharge_dttm") >= lo) & (F.col("discharge_dttm") < hi))
    adult = F.col("age_at_admission") >= 18
    eligible = stays.where(adult & in_range)
    ids = eligible.select(KEY)

    procedures = load_table(spark, site, "patient_procedures", ids=ids)
    tubes = _coded(procedures, [INTUBATION])
    if options.provider_if_missing is not None:
        tubes = tubes.withColumn("billing_provider_id", F.coalesce(
            "billing_provider_id", F.lit(options.provider_if_missing)))
        known = F.col("billing_provider_id").isNotNull()
    else:
        known = present("billing_provider_id")
    coded = tubes.groupBy(KEY).agg(F.max(known.cast("int")).alias("has_provider"))
    with_code = coded.where(F.col("has_provider") == 1).select(KEY)

    meds = (load_table(spark, site, "medication_admin_intermittent", ids=with_code)
            .withColumn("med_category", F.lower("med_category"))
            .withColumn("med_dose", lenient_double("med_dose"))
            .where((F.lower("mar_action_category") == "given")
                   & F.col("med_category").isin(INDUCTION + PARALYTIC + SEDATIVES)))
    index, pairs = C.index_events(
        meds.withColumnRenamed("med_dose", "dose").withColumnRenamed("med_dose_unit", "unit"),
        KEY, "admin_dttm", "med_category", INDUCTION, PARALYTIC, 30, 5, ["dose", "unit"])
    index = materialise(index.withColumnRenamed("index_time", "index_dttm"), "index")

    adt = load_table(spark, site, "adt", ids=index.select(KEY)).withColumn(
        "location_category", F.lower("location_category"))
    place = C.location_at(index, adt, KEY, "index_dttm", "in_dttm", "out_dttm",
                          ["location_category"], "location_category", ["ed", "icu"])
    devices = load_table(spark, site, "respiratory_support", ids=index.select(KEY))
    vented = devices.where(F.lower("device_category") == "imv")
    first_imv = C.first_event_within(index, vented, KEY, "index_dttm", "recorded_dttm", 0,
                                     6 * HOUR, "imv_dttm")
    admitted = index.join(eligible.select(KEY, "admission_dttm"), KEY)
    trach = C.ids_with_event_within(admitted, KEY, [
        C.Source(devices.where(F.col("tracheostomy") == 1), "recorded_dttm", "admission_dttm",
                 0, DAY),
        C.Source(_coded(procedures, TRACHEOSTOMY), "procedure_billed_dttm", "admission_dttm",
                 0, DAY)])
    both = C.ids_with_multiple(meds, KEY, "med_category", INDUCTION)
    sedated = C.ids_with_event_within(index, KEY, [
        C.Source(meds.where(F.col("med_category").isin(SEDATIVES)), "admin_dttm", "index_dttm",
                 -HOUR, 0, "[)")])

    weights = load_table(spark, site, "vitals", {"vital_category": ["weight_kg"]})
    of_index = X.keep_of(weights, index, KEY)
    own = T.around(index, of_index, KEY, "index_dttm", "recorded_dttm", "vital_value")
    without = C.drop_ids(index, own.where(F.col("before_time").isNotNull()), KEY)
    history = T.from_history(without, eligible, weights, KEY, OWNER, "admission_dttm",
                             "index_dttm", "recorded_dttm", "vital_value")
    weighed = T.nearest_measurement(
        index, of_index, KEY, "index_dttm", "recorded_dttm", "vital_value",
        {"current": "current_hospitalization", "history": "previous_hospitalization",
         "none": "no_weight"}, history).select(
        "*", F.col("value").alias("weight_kg"), F.col("value_source").alias("weight_source"),
        F.col("value_time").alias("weight_recorded_dttm"),
        F.col("value_gap_hours").alias("weight_to_rsi_hours"),
        F.col("post_value").alias("post_rsi_weight_kg"),
        F.col("post_time").alias("post_rsi_weight_recorded_dttm"),
        F.col("post_gap_hours").alias("post_rsi_weight_to_rsi_hours"))

    frame = stays.join(coded, KEY, "left").join(weighed, KEY, "left").join(
        place, KEY, "left").join(first_imv, KEY, "left")
    for name, found in (("_trach", trach), ("_both", both), ("_sedated", sedated)):
        frame = C.with_flag(frame, found, KEY, name)
    frame = materialise(frame, "candidates")
    drug, dose, weight = F.col("a_category"), F.col("a_dose"), F.col("weight_kg")
    infeasible = {d: (drug == d) & ((dose < lo) | (dose > hi))
                  for d, (lo, hi) in FEASIBLE_DOSE.items()}
    any_infeasible = infeasible["etomidate"] | infeasible["ketamine"]
    steps = [
        C.Step("Age >= 18", adult, "Age < 18"),
        C.Step("Admission & discharge 2018-01-01 to 2025-12-31", in_range,
               "Admission or discharge outside study date range"),
        C.Step("CPT 31500 with billing provider", F.col("has_provider") == 1,
               "No CPT 31500 or missing billing_provider_id",
               {"n_no_cpt": F.col("has_provider").isNull(),
                "n_cpt_no_provider": F.col("has_provider") == 0}),
        C.Step("RSI pairing (induction + paralytic within 5 min)",
               F.col("index_dttm").isNotNull(), "No valid RSI medication pair"),
        C.Step("ED or ICU location at RSI time", F.col("location_category").isNotNull(),
               "Not in ED or ICU at RSI time"),
        C.Step("IMV within 6 hours of induction", F.col("imv_dttm").isNotNull(),
               "No IMV within 6 hours"),
        C.Step("No tracheostomy within 24h of admission", F.col("_trach") == 0,
               "Tracheostomy within 24h of admission"),
        C.Step("Not both etomidate and ketamine", F.col("_both") == 0,
               "Received both etomidate and ketamine"),
        C.Step("No benzo/propofol within 60 min prior", F.col("_sedated") == 0,
               "Benzo or propofol within 60 min prior to RSI"),
        C.Step("First RSI per hospitalization", F.lit(True),
               "Prior intubation in same hospitalization"),
        # A missing dose is dropped here: NOT unknown is unknown.
        C.Step("Feasible induction dose", ~any_infeasible,
               "Non-feasible etomidate or ketamine dose",
               {f"n_bad_{d}": c for d, c in infeasible.items()}),
        C.Step("Physiological weight (20-300 kg)",
               weight.isNull() | weight.between(*WEIGHT_RANGE), "Non-physiological weight"),
    ]
    kept, flow = C.inclusion_exclusion(frame, steps, "Total hospitalizations")
    people = load_table(spark, site, "patient", ids=kept.select(OWNER)).select(
        OWNER, *[F.lower(c).alias(c) for c in
                 ("sex_category", "race_category", "ethnicity_category")])
    cohort = kept.join(people, OWNER, "left").select(
        KEY, OWNER, "index_dttm", "imv_dttm", F.col("a_category").alias("med_category_ind"),
        F.col("a_dose").alias("med_dose_ind"), F.col("a_unit").alias("med_dose_unit_ind"),
        F.col("b_category").alias("med_category_par"), F.col("b_time").alias("admin_dttm_par"),
        F.col("b_dose").alias("med_dose_par"), F.col("b_unit").alias("med_dose_unit_par"),
        "weight_kg", "weight_source", "weight_recorded_dttm", "weight_to_rsi_hours",
        "post_rsi_weight_kg", "post_rsi_weight_recorded_dttm", "post_rsi_weight_to_rsi_hours",
        "admission_dttm", "discharge_dttm", "age_at_admission", "admission_type_category",
        "discharge_category", "sex_category", "race_category", "ethnicity_category",
        "location_category", ratio("a_dose", "weight_kg").alias("induction_dose_per_kg"))
    no_weight = frame.where(F.col("weight_source") == "no_weight").select(KEY, "index_dttm")
    return CohortResult(cohort, flow, pairs, no_weight, eligible, weights)


def write_cohort(result: CohortResult, site: Site) -> None:
    """Step 1 outputs: cohort, flow, pair timing and weight timing."""
    cohort = result.cohort
    write_private(cohort, site, "rsi_cohort")
    write_private(result.pairs, site, "subanalysis_rsi_timing_pairs")
    write_shared(pair_timing_stats(result.pairs, "gap_minutes", "a_category", "b_category"),
                 site, ".", "subanalysis_rsi_timing_stats.csv")
    write_shared(result.flow, site, ".", "consort_cohort.csv")
    write_flow(flow_document(result.flow, site, cohort, KEY, OWNER), site,
               "consort_cohort.json")
    timing = weight_timing(result)
    write_private(timing, site, "subanalysis_weight_timing")
    write_shared(weight_timing_stats(timing), site, ".", "subanalysis_weight_timing_stats.csv")
    gap = weight_gap(result)
    write_private(gap, site, "subanalysis_weight_gap")
    for name, table in chart_tables(result, timing, gap).items():
        write_shared(table, site, "figures", f"{name}.csv")


def chart_tables(result: CohortResult, timing: DataFrame, gap: DataFrame) -> dict[str, DataFrame]:
    """The rows that the charts of step 1 are drawn from."""
    pair = F.concat("med_category_ind", F.lit(" + "), "med_category_par")
    return {
        "rsi_timing_histogram": histogram(result.pairs, "gap_minutes", 0.5, stop=30.0),
        "rsi_pair_by_location": count_matrix(result.cohort, pair, "location_category",
                                             ["ed", "icu"], "med_pair"),
        "weight_hours_before_histogram": histogram(timing, "pre_hours_before", 2.0, stop=100.0),
        "weight_hours_after_histogram": histogram(timing, "post_hours_after", 2.0, stop=100.0),
        "weight_change_histogram": histogram(timing, "change", 1.0),
        "weight_change_by_pair": box_stats(timing, "change", ["med_pair"]),
        "weight_gap_excluded": stacked_stats(gap, ["gap_days", "change"], {}),
    }


def weight_timing(result: CohortResult) -> DataFrame:
    index = result.cohort.select(
        KEY, "index_dttm", "med_category_ind", "med_category_par", "location_category",
        F.concat("med_category_ind", F.lit(" + "), "med_category_par").alias("med_pair"))
    return pre_post_change(index, result.weights, KEY, "index_dttm", "recorded_dttm",
                           "vital_value")


def weight_timing_stats(timing: DataFrame) -> DataFrame:
    groups = ["med_category_ind", "med_category_par", "location_category", "med_pair"]
    return stacked_stats(timing, ["pre_hours_before", "post_hours_after", "pre_to_post_hours",
                                  "change"], {g: F.col(g) for g in groups})


def weight_gap(result: CohortResult, max_lookback_days: float = 365.25) -> DataFrame:
    """Weight gaps of index events without an own earlier weight."""
    history = T.from_history(result.no_weight, result.hospitalizations, result.weights, KEY,
                             OWNER, "admission_dttm", "index_dttm", "recorded_dttm",
                             "vital_value", max_lookback_days, True)
    return gap_for_excluded(result.no_weight, result.weights, KEY, "index_dttm",
                            "recorded_dttm", "vital_value", history)


def build_dataset(spark: SparkSession, site: Site, cohort: DataFrame,
                  options: StudyOptions = StudyOptions()) -> DataFrame:
    """The wide frame: cohort columns, dose bands and all look-back features."""
    ids = cohort.select(KEY)
    base = (cohort.drop("location_category")
            .withColumn("nmb_dose_mg_kg", ratio("med_dose_par", "weight_kg"))
            .withColumn("induction_categorical_mg_kg", band_within(
                "induction_dose_per_kg", "med_category_ind", INDUCTION_BANDS, True))
            .withColumn("nmb_categorical_mg_kg", band_within(
                "nmb_dose_mg_kg", "med_category_par", PARALYTIC_BANDS, True)))

    drips = load_table(spark, site, "medication_admin_continuous", {
        "med_category": sorted({*PUSH_DOSE, *VASOPRESSORS, "dobutamine"})}, ids).withColumn(
        "med_category", F.lower("med_category"))
    push = X.category_flags_before(cohort, drips, KEY, "admin_dttm_par", "admin_dttm",
                                   "med_category", {m: f"push_dose_{m}" for m in PUSH_DOSE}, 120)
    pressors = X.lookback_features(
        cohort, drips, KEY, "index_dttm", "admin_dttm", WINDOWS,
        [f for m in VASOPRESSORS for f in (
            X.Feature(f"any_vasopressor_{m}", "any", F.col("med_category") == m),
            X.Feature(f"{m}_dose", "max", F.col("med_category") == m, "med_dose"))],
        {"any_vasopressor": [f"any_vasopressor_{m}" for m in VASOPRESSORS]})

    diagnoses = load_table(spark, site, "hospital_diagnosis", ids=ids)
    comorbidity = S.comorbidity_index(diagnoses, KEY, "diagnosis_code",
                                      "diagnosis_code_format").withColumnRenamed(
        "cci_score", "cci")
    vitals = load_table(spark, site, "vitals", {
        "vital_category": ["heart_rate", "sbp", "dbp", "map", "spo2"]}, ids).withColumn(
        "vital_category", F.lower("vital_category"))
    kind = F.col("vital_category")
    vital_features = X.lookback_features(
        cohort, vitals, KEY, "index_dttm", "recorded_dttm", WINDOWS,
        [X.Feature("highest_hr", "max", kind == "heart_rate", "vital_value"),
         *[X.Feature(f"lowest_{c}", "min", kind == c, "vital_value")
           for c in ("sbp", "dbp", "map", "spo2")]])
    devices = load_table(spark, site, "respiratory_support", ids=ids).withColumn(
        "device_category", F.lower("device_category"))
    breathing = X.lookback_features(
        cohort, devices.withColumn("level", level_of("device_category", RESPIRATORY_LEVELS)),
        KEY, "index_dttm", "recorded_dttm", WINDOWS,
        [X.Feature("highest_resp_support", "max", F.lit(True), "level"),
         *[X.Feature(name, "any", F.col("device_category") == d)
           for d, name in DEVICES.items()]])

    labs = load_table(spark, site, "labs", ids=ids).withColumn(
        "lab_category", F.lower("lab_category"))
    measures = (
        labs.select(KEY, F.col("recorded_dttm").alias("t"), F.col("lab_category").alias("c"),
                    F.col("lab_value").alias("v"))
        .unionByName(vitals.select(KEY, F.col("recorded_dttm").alias("t"),
                                   kind.alias("c"), F.col("vital_value").alias("v")))
        .unionByName(drips.select(KEY, F.col("admin_dttm").alias("t"),
                                  F.col("med_category").alias("c"),
                                  F.col("med_dose").alias("v")))
        .unionByName(devices.where(F.col("device_category").isin("imv", "nippv", "cpap")).select(
            KEY, F.col("recorded_dttm").alias("t"), F.lit("ventilated").alias("c"),
            F.lit(1.0).alias("v"))))
    sofa = S.organ_failure(cohort, measures, KEY, "index_dttm", "t", "c", "v", {
        "24hr_prior_intubation": DAY, "6hr_prior_intubation": 6 * HOUR})
    dialysis = X.flags_before(
        cohort, load_table(spark, site, "crrt_therapy", ids=ids), KEY, "index_dttm",
        "recorded_dttm", {"crrt_24hr_prior_intubation": DAY,
                          "crrt_6hr_prior_intubation": 6 * HOUR})

    adt = load_table(spark, site, "adt", ids=ids)
    for c in ("location_category", "location_type", "hospital_type"):
        adt = adt.withColumn(c, F.lower(c))
    procedures = load_table(spark, site, "patient_procedures", ids=ids)
    where = X.unit_and_provider(
        cohort, adt, procedures, KEY, "index_dttm", "in_dttm", "out_dttm", "location_category",
        "location_type", "hospital_id", "hospital_type", "icu",
        (F.col("procedure_code") == INTUBATION) & (F.upper("procedure_code_format") == "CPT"),
        "procedure_billed_dttm", "billing_provider_id").withColumnsRenamed({
            "location_at_index": "location_at_intubation", "unit_type_at_index": "icu_type",
            "unit_days": "los_icu", "billing_provider_id": "provider_id"})
    ends = X.outcomes(cohort, adt, KEY, "admission_dttm", "discharge_dttm",
                      "discharge_category", "in_dttm", "out_dttm", "location_category", "icu",
                      "expired|death").withColumnsRenamed({
                          "los_days": "los_hospital", "died": "died_hospital",
                          "died_in_unit": "died_icu"})
    sepsis = _sepsis_flags(spark, site, cohort, options, labs, drips, devices)
    parts = [push, comorbidity, sofa, dialysis, sepsis, vital_features, breathing, pressors,
             where, ends]
    return X.assemble_wide(base, parts, KEY).withColumn("cpt_31500", F.lit(1).cast("tinyint"))


def _sepsis_flags(spark, site, cohort, options, labs, drips, devices) -> DataFrame:
    ids = cohort.select(KEY)
    cultures = load_table(spark, site, "microbiology_culture",
                          {"fluid_category": options.culture_sites}, ids).select(
        KEY, F.col("recorded_dttm").alias("t"))
    antibiotics = load_table(spark, site, "medication_admin_intermittent", ids=ids).where(
        F.lower("med_category").rlike(ANTIBIOTIC_NAMES)).select(
        KEY, F.col("admin_dttm").alias("t"))
    supports = (drips.where(F.col("med_category").isin(VASOPRESSORS))
                .select(KEY, F.col("admin_dttm").alias("t"))
                .unionByName(devices.where(F.col("device_category") == "imv")
                             .select(KEY, F.col("recorded_dttm").alias("t"))))
    failing = S.organ_dysfunction(labs.withColumnRenamed("recorded_dttm", "t"), supports, KEY,
                                  "t", "lab_category", "lab_value")
    found = S.sepsis_event(cultures, antibiotics, failing, cohort, KEY, "t", "discharge_dttm")
    week = 7 * DAY
    flags = X.flags_before(cohort, found.where(F.col("sepsis") == 1), KEY, "index_dttm",
                           "sepsis_onset", {"ASE_7d_prior": week})
    infection = X.flags_before(cohort, found.where(F.col("presumed_infection") == 1), KEY,
                               "index_dttm", "infection_onset",
                               {"presumed_infection_7d_prior": week})
    return flags.join(infection, KEY)


# Fixed value: stems of the qualifying antibiotics.
ANTIBIOTIC_NAMES = ("cillin|cef|penem|bactam|mycin|micin|floxacin|cycline|vancomycin|linezolid|"
                    "aztreonam|metronidazole|colistin|polymyxin|sulfamethoxazole|amikacin|"
                    "daptomycin|chloramphenicol|fluconazole|fungin|amphotericin")

MODELING_COLUMNS = {
    KEY: KEY, "med_dose_ind": "induction_dose_mg", "induction_dose_per_kg": "dose_mg_kg",
    "med_category_ind": "drug_received", "age_at_admission": "age_years",
    **{c: c for c in ("sex_category", "race_category", "ethnicity_category", "cci",
                      "ASE_7d_prior", "presumed_infection_7d_prior")},
    "lowest_sbp_24hrs_prior": "worst_sbp_24hr_pre", "highest_hr_24hrs_prior": "worst_hr_24hr_pre",
    "lowest_spo2_24hrs_prior": "worst_spo2_24hr_pre",
    "any_vasopressor_24hrs_prior": "any_vasopressor_24hrs_prior",
    "lowest_sbp_6hrs_prior": "worst_sbp_6hr_pre", "highest_hr_6hrs_prior": "worst_hr_6hr_pre",
    "lowest_spo2_6hrs_prior": "worst_spo2_6hr_pre",
    **{c: c for c in ("any_vasopressor_6hrs_prior", "any_vasopressor_1hr_prior",
                      "location_at_intubation", "icu_type", "hospital_type", "hospital_id",
                      "provider_id", "weight_kg", "weight_source", "weight_recorded_dttm",
                      "weight_to_rsi_hours", "post_rsi_weight_kg",
                      "post_rsi_weight_recorded_dttm", "post_rsi_weight_to_rsi_hours")},
}


def modeling_frame(wide: DataFrame, site: Site) -> DataFrame:
    return X.modeling_view(wide, MODELING_COLUMNS, "index_dttm", {"site_id": site.name})


def derive(frame: DataFrame, history_label: str = "previous_hospitalization") -> DataFrame:
    """Analysis categories and dose variables of the modeling frame.

    ``history_label`` is the weight source that has a look-back window.
    """
    drug = folded("drug_received")
    origin, unit = F.lower("location_at_intubation"), F.lower("icu_type")
    race, per_kg = F.lower("race_category"), F.col("dose_mg_kg")
    hours, old = F.col("weight_to_rsi_hours"), F.col("weight_source") == history_label
    out = (
        frame.withColumn("drug", drug).drop("drug_received")
        .withColumn("race_eth", chain([
            (F.lower("ethnicity_category") == "hispanic", "Hispanic"),
            (race == "white", "NH White"),
            (race.isin("black", "black or african american"), "NH Black/African American"),
            (race == "asian", "NH Asian")], "NH Other/Unknown"))
        .withColumn("location_group", chain([
            (origin == "ed", "ED"),
            (unit.isin("medical_icu", "medical", "mixed_icu", "mixed", "general_icu"),
             "Medical/Mixed ICU"),
            (unit.isin("surgical_icu", "surgical"), "Surgical ICU"),
            (unit.isin("cardiac_icu", "cardiac", "cardiovascular"), "Cardiac ICU"),
            (unit.isin("neuro_icu", "neuro", "neurological", "neurosurgical"), "Neuro ICU")],
            "Other/Unknown"))
        .withColumn("icu_type", F.when(origin == "ed", "Not applicable (ED)")
                    .when(origin.isNotNull(), F.col("icu_type")))
        .withColumn("weight_window", chain([
            (old & (hours <= 168), "7 days"), (old & (hours <= 336), "14 days"),
            (old & (hours <= 672), "28 days")]).cast("string"))
        .withColumn("drug_ketamine", (F.col("drug") == "ketamine").cast("int")))
    limit = chain([(F.col("drug") == d, v) for d, v in REDUCED_BELOW.items()])
    reference = chain([(F.col("drug") == d, v) for d, v in REFERENCE_DOSE.items()])
    out = (out.withColumn("dose_reduced", (per_kg < limit).cast("int"))
           .withColumn("dose_ref", reference)
           .withColumn("pct_below_ref", shortfall("dose_mg_kg", F.col("dose_ref")))
           .withColumn("dose_low_25pct", (F.col("pct_below_ref") > 0.25).cast("int"))
           .withColumn("dose_tier", band_within("dose_mg_kg", "drug", TIERS)))
    out = collapse_levels(out, "location_group", 10, "Other/Unknown")
    return X.centred_year(out)

