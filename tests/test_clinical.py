import json
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.clinical_data import make
from tidemark.plans import analysis as A, clinical as K
from tidemark.sources.site import Site, write_private


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("clinical")
    tables = make(str(folder))
    settings = folder / "site.json"
    settings.write_text(json.dumps({
        "site_name": "site_a", "data_directory": str(folder), "filetype": "parquet",
        "timezone": "America/Chicago", "output_directory": str(folder / "private"),
        "output_to_share_directory": str(folder / "share")}))
    site = Site.from_json(spark, str(settings))
    result = K.build_cohort(spark, site)
    path = write_private(result.cohort, site, "cohort")
    cohort = spark.read.parquet(path)
    write_private(K.build_dataset(spark, site, cohort), site, "wide")
    wide = spark.read.parquet(site.private("wide"))
    return site, tables, result, cohort, wide


def test_flow_telescopes_and_matches_pandas(study):
    site, tables, result, cohort, _ = study
    flow = result.flow.toPandas().sort_values("step").reset_index(drop=True)
    assert len(flow) == 13
    left = flow["n_remaining"]
    assert (left.shift(1)[1:] == (left + flow["n_excluded"])[1:]).all()
    assert cohort.count() == left.iloc[-1] > 150
    hosp = tables["hospitalization"]
    adult = hosp[hosp["age_at_admission"] >= 18]
    assert left[1] == len(adult)
    inside = adult[(adult["discharge_dttm"] < "2026-01-01")]
    assert left[2] == len(inside)
    proc = tables["patient_procedures"].merge(inside[["hospitalization_id"]])
    assert left[3] == proc["billing_provider_id"].notna().sum()
    assert flow["n_cpt_no_provider"][3] == proc["billing_provider_id"].isna().sum()
    meds = tables["medication_admin_intermittent"]
    ind = meds[meds["med_category"].isin(["Etomidate", "Ketamine"])]
    par = meds[meds["med_category"].isin(["rocuronium", "succinylcholine"])]
    both = ind.merge(par, on="hospitalization_id").merge(
        proc[proc["billing_provider_id"].notna()][["hospitalization_id"]])
    near = (both["admin_dttm_y"] - both["admin_dttm_x"]).dt.total_seconds() <= 300
    assert left[4] == near.sum()


def test_weight_sources(study):
    *_, cohort, _ = study
    sources = {r[0] for r in cohort.select("weight_source").distinct().collect()}
    assert "current_hospitalization" in sources and "no_weight" in sources
    wrong = cohort.where((F.col("weight_source") == "no_weight") & F.col("weight_kg").isNotNull())
    assert wrong.count() == 0


def test_wide_has_one_row_per_entity(study):
    *_, cohort, wide = study
    assert wide.count() == cohort.count() == wide.select(K.KEY).distinct().count()
    assert len(wide.columns) > 90
    flags = [c for c in wide.columns if c.startswith(("any_", "push_dose", "crrt"))]
    row = wide.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in flags]).first()
    assert not any(row.asDict().values())
    assert wide.agg(F.sum("ASE_7d_prior")).first()[0] is not None
    assert wide.where(F.col("sofa_24hr_prior_intubation").isNotNull()).count() > 0


def test_lowest_value_matches_pandas(study):
    _, tables, _, cohort, wide = study
    vit = tables["vitals"]
    sbp = vit[vit["vital_category"] == "sbp"].merge(
        cohort.select(K.KEY, "index_dttm").toPandas(), on=K.KEY)
    hours = (sbp["index_dttm"] - sbp["recorded_dttm"]).dt.total_seconds() / 3600
    want = sbp[(hours >= 0) & (hours <= 6)].groupby(K.KEY)["vital_value"].min()
    got = wide.select(K.KEY, "lowest_sbp_6hrs_prior").toPandas().set_index(K.KEY)[
        "lowest_sbp_6hrs_prior"].dropna()
    pd.testing.assert_series_equal(got.sort_index(), want.sort_index(), check_names=False)


def test_cohort_outputs_and_analysis(spark, study):
    site, _, result, _, wide = study
    K.write_cohort(result, site)
    document = json.loads(next(
        open(os.path.join(site.shared(".", "consort_cohort.json"), f)).read()
        for f in os.listdir(site.shared(".", "consort_cohort.json")) if f.startswith("part")))
    assert [s["step"] for s in document["steps"]] == list(range(13))
    final = document["final_cohort"]
    assert set(final) == {"n_hospitalizations", "n_patients"}
    for name in ("rsi_timing_histogram", "rsi_pair_by_location", "weight_hours_before_histogram",
                 "weight_hours_after_histogram", "weight_change_histogram", "weight_change_by_pair",
                 "weight_gap_excluded"):
        written = spark.read.option("header", "true").csv(site.shared("figures", f"{name}.csv"))
        assert written.count() > 0 or name == "weight_gap_excluded"
    pairs = spark.read.option("header", "true").csv(site.shared("figures", "rsi_pair_by_location.csv"))
    assert sum(int(r["ed"]) + int(r["icu"]) for r in pairs.collect()) == result.cohort.count()
    os.stat(site.private("subanalysis_weight_gap"))
    frame = K.modeling_frame(wide, site)
    assert len(frame.columns) == 35
    prepared = A.prepare(frame, impute_iterations=1)
    assert prepared.imputation_method == "pmm"
    clean = prepared.clean
    assert clean.where(F.col("worst_sbp_6hr_pre").isNull()).count() == 0
    tables = {**A.quality_tables(prepared), **A.descriptive_tables(prepared)}
    sizes = {name: t.count() for name, t in tables.items()}
    assert sizes["tables/dose_tier_counts"] == 8
    checks = tables["02_derived_variable_checks"].toPandas()
    assert (checks["verdict"] == "PASS").all(), checks
    first = checks[checks["check_name"] == "dose_tier below threshold == dose_reduced 1"]
    assert len(checks) == 6 and sorted(first["drug"]) == ["etomidate", "ketamine"]
    assert checks["max_discrepancy"].notna().sum() == 1 and checks["max_discrepancy"].max() <= 0.01
    may_be_empty = {"01_duplicates", "tables/provider_dose_summary",
                    "tables/03_provider_drug_choice_summary"}
    assert not [name for name, n in sizes.items() if n == 0 and name not in may_be_empty]
    model = A.study_design(prepared.analytic, "dose_mg_kg", keep=(K.KEY,))
    from tidemark.operators import lmm as L
    fitted = L.fit_lmm(L.sufficient_sums(model))
    assert set(fitted["fit"]) == {"etomidate", "ketamine"}
    shares = L.variance_components(fitted).groupby("fit")["pct_variance"].sum()
    assert shares.round(6).eq(100).all()
    begun = time.time()
    models = A.model_tables(spark, prepared, replicates=40, raw_replicates=20)
    assert time.time() - begun < 300
    assert set(models) >= {
        "variance_components", "fixed_effects", "icc_results", "sa_rawmg_variance_components", "sa_provider_fixed_lrt",
        "sa_drug_choice_mor_icc", "sa_drug_choice_fixed_effects", "aim4_mor_icc_results", "aim4_fixed_effects",
        "time_trend_model_results"}
    parts = models["variance_components"].toPandas()
    assert (parts["n_replicates"] == 40).all() and (parts["ci_lo"] <= parts["ci_hi"]).all()
    odds = models["aim4_mor_icc_results"].toPandas()
    assert set(odds["outcome"]) == {"dose_reduced", "dose_low_25pct"} and set(odds["fit"]) == {"etomidate", "ketamine"}
    trend = models["time_trend_model_results"].toPandas()
    assert (trend["model"] == "drug_choice_time_trend").all()
    assert set(trend["model_type"]) <= set(A.TREND_MODELS.values())
    metadata = A.site_metadata(prepared, models["variance_components"]).first()
    assert metadata["date_range_years"] == f"{metadata['year_min']}-{metadata['year_max']}"
    assert metadata["lmm_etomidate_model_type"] in L.MODEL_TYPES.values() and metadata["lmm_ketamine_no_interval"] is False
    assert len(metadata["run_datetime"]) == 19
