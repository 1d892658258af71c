"""The study's analysis step: quality tables, descriptive tables and models.

``quality_tables`` and ``descriptive_tables`` return lazy frames by output name;
``model_tables`` fits the models and returns their small result tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.measures import n_missing, n_where
from ..functions.recode import chain
from ..operators import (bootstrap as R, describe as B, design as D, glmm as G, impute as I,
                         lmm as L, quality as Q)
from ..session import materialise
from ..sources.site import Site, write_shared
from .clinical import KEY, REDUCED_BELOW, REFERENCE_DOSE, TIER_NAMES, derive

DRUGS = ["etomidate", "ketamine"]
SEED = 20260319
MIN_SITE, MIN_PROVIDER = 50, 10

# Ranges, bands and variable lists of the study.
RANGES = [
    ("induction_dose_mg", 2, 300, "Dose (mg): 2-300", None),
    ("dose_mg_kg", 0.05, 0.75, "Dose mg/kg etomidate: 0.05-0.75", "etomidate"),
    ("dose_mg_kg", 0.10, 6.00, "Dose mg/kg ketamine: 0.10-6.00", "ketamine"),
    ("weight_kg", 20, 300, "Weight (kg): 20-300", None),
    ("age_years", 18, 120, "Age (years): 18-120", None),
    ("worst_sbp_24hr_pre", 20, 300, "SBP 24hr (mmHg): 20-300", None),
    ("worst_hr_24hr_pre", 20, 300, "HR 24hr (bpm): 20-300", None),
    ("worst_spo2_24hr_pre", 50, 100, "SpO2 24hr (%): 50-100", None),
    ("worst_sbp_6hr_pre", 20, 300, "SBP 6hr (mmHg): 20-300", None),
    ("worst_hr_6hr_pre", 20, 300, "HR 6hr (bpm): 20-300", None),
    ("worst_spo2_6hr_pre", 50, 100, "SpO2 6hr (%): 50-100", None),
    ("cci", 0, 50, "CCI: 0-50", None),
]
FLAGS = ["any_vasopressor_24hrs_prior", "any_vasopressor_6hrs_prior",
         "any_vasopressor_1hr_prior", "ASE_7d_prior", "presumed_infection_7d_prior"]
VITALS = ["worst_sbp_6hr_pre", "worst_hr_6hr_pre", "worst_spo2_6hr_pre"]
EXPECTED_MISSING = {"dose_mg_kg", "dose_reduced", "dose_low_25pct", "dose_tier", "weight_kg",
                    "weight_source", "weight_window", *VITALS, "any_vasopressor_6hrs_prior"}
DOSE_BANDS = {
    "etomidate": ([0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.45, 0.60],
                  ["<0.05", "0.05-0.09", "0.10-0.14", "0.15-0.19", "0.20-0.24", "0.25-0.29",
                   "0.30-0.34", "0.35-0.44", "0.45-0.60", ">0.60"]),
    "ketamine": ([0.30, 0.50, 0.70, 0.90, 1.10, 1.30, 1.50, 1.70, 1.90],
                 ["<0.30", "0.30-0.49", "0.50-0.69", "0.70-0.89", "0.90-1.09", "1.10-1.29",
                  "1.30-1.49", "1.50-1.69", "1.70-1.89", "≥1.90"]),
}
SCALED = {"age_years": "age_s", "cci": "cci_s", "worst_sbp_6hr_pre": "sbp_s",
          "worst_hr_6hr_pre": "hr_s", "worst_spo2_6hr_pre": "spo2_s"}
NUMERIC_TERMS = ["age_s", "cci_s", "sbp_s", "hr_s", "spo2_s", "any_vasopressor_6hrs_prior",
                 "presumed_infection_7d_prior", "ASE_7d_prior", "calendar_year_c"]
FACTOR_TERMS = {"sex_category": None, "race_eth": "NH White",
                "location_group": "Medical/Mixed ICU", "hospital_type": None}
TREND_MODELS = {  # (several hospitals, several hospital types): label
    (True, True): "multi-hosp + hospital_type", (True, False): "multi-hosp, no hospital_type",
    (False, True): "single-hosp + hospital_type (glm)", (False, False): "single-hosp, year only (glm)"}


@dataclass(frozen=True)
class Prepared:
    raw: DataFrame
    clean: DataFrame
    waterfall: DataFrame
    analytic: DataFrame
    no_weight: DataFrame
    imputation_method: str


def prepare(frame: DataFrame, impute_iterations: int = 10) -> Prepared:
    """Exclusions, derived variables, imputation, scaling, split and anonymous providers."""
    raw = frame.withColumn("drug_received", F.lower(F.trim("drug_received")))
    drug, per_kg = F.col("drug_received"), F.col("dose_mg_kg")
    weight = F.col("weight_kg")
    kept, waterfall = Q.waterfall(raw, [
        ("Exclude: impossible induction_dose_mg", F.col("induction_dose_mg").between(2, 300)),
        ("Exclude: impossible weight_kg (where present)",
         weight.isNull() | weight.between(20, 300)),
        ("Exclude: impossible age_years", F.col("age_years").between(18, 120)),
        ("Exclude: impossible dose_mg_kg (drug-specific)",
         per_kg.isNull() | ((drug == "etomidate") & per_kg.between(0.05, 0.75))
         | ((drug == "ketamine") & per_kg.between(0.10, 6.00)))], "Raw data loaded")
    clean = materialise(derive(kept), "clean")
    factors = {f: D.levels_of(clean, f, ref) for f, ref in
               {**FACTOR_TERMS, "drug": None}.items()}
    clean, method = I.impute_pmm(
        clean, KEY, VITALS,
        ["age_years", "cci", "any_vasopressor_6hrs_prior", "ASE_7d_prior",
         "presumed_infection_7d_prior", "calendar_year"], factors, impute_iterations, seed=SEED)
    clean = materialise(Q.z_scores(clean, SCALED), "scaled")
    has_weight = clean.where(F.col("weight_kg").isNotNull())
    names = materialise(Q.anonymous_ids(has_weight, "provider_id", "provider_anon"), "providers")

    def anonymous(df: DataFrame) -> DataFrame:
        return (df.join(names, "provider_id", "left").drop("provider_id")
                .withColumnRenamed("provider_anon", "provider_id"))

    return Prepared(raw, clean, waterfall, materialise(anonymous(has_weight), "analytic"),
                    anonymous(clean.where(F.col("weight_kg").isNull())), method)


def quality_tables(p: Prepared) -> dict[str, DataFrame]:
    clean, tier = p.clean, F.col("dose_tier")
    is_missing_dose = tier.isNull()
    off = F.abs(F.col("dose_mg_kg") - F.col("induction_dose_mg") / F.col("weight_kg"))
    checks = [
        Q.Consistency("dose_tier below threshold == dose_reduced 1",
                      tier.isin(TIER_NAMES[:2]), F.col("dose_reduced") == 1),
        Q.Consistency("ED location_group vs location_at_intubation",
                      F.col("location_group") == "ED",
                      F.lower("location_at_intubation") == "ed"),
        Q.Consistency("Hispanic ethnicity -> Hispanic race_eth",
                      F.lower("ethnicity_category") == "hispanic",
                      F.col("race_eth") == "Hispanic"),
        Q.Consistency("dose_mg_kg vs induction_dose_mg/weight_kg (tol=0.01)",
                      F.col("dose_mg_kg").isNotNull(), off <= 0.01, off, "DISCREPANCY"),
        Q.Consistency("dose variable NAs match missing weight", is_missing_dose,
                      F.col("weight_kg").isNull())]
    # every place that occurs: the study does not limit them
    places = sorted(r[0] for r in p.raw.select("location_at_intubation").distinct().collect() if r[0] is not None)
    raw_vars = [c for c in p.raw.columns if not c.startswith("post_rsi") and c != "site_id"]
    return {
        "01_duplicates": Q.duplicate_keys(p.raw, [KEY]),
        "01_drug_values": B.shares(p.raw, ["drug_received"], (), 1),
        "01_unexpected_drugs": Q.domain_checks(p.raw, {"drug_received": DRUGS}),
        "01_missingness_raw": Q.missingness(p.raw, raw_vars),
        "01_impossible_values": Q.range_checks(
            p.raw, [Q.RangeRule(*r) for r in RANGES], "drug_received", FLAGS),
        "01_weight_source_by_location": B.cross_tab(
            p.raw, "weight_source", "location_at_intubation", places),
        "01_icu_type_by_location": B.cross_tab(
            p.raw, "icu_type", "location_at_intubation", places),
        "01_exclusion_waterfall": p.waterfall,
        "01_provider_encounter_table": Q.volume_summary(
            clean, "provider_id", F.col("weight_kg").isNotNull(), MIN_PROVIDER),
        "01_provider_encounter_dist": Q.volume_chart(Q.volume_by_unit(
            clean, "provider_id", F.col("weight_kg").isNotNull(), MIN_PROVIDER), "provider_id"),
        "01_missing_weight": Q.included_vs_excluded(
            clean, F.col("weight_kg").isNotNull(), "age_years", {
                "pct_male": F.lower("sex_category") == "male",
                "pct_vaso_6hr": F.col("any_vasopressor_6hrs_prior") == 1,
                "pct_ase": F.col("ASE_7d_prior") == 1,
                "pct_ed": F.col("location_group") == "ED",
                "pct_etomidate": F.col("drug") == "etomidate"}),
        "02_derived_variable_checks": Q.derived_checks(
            clean.where(F.col("dose_mg_kg").isNotNull()), checks[:1], ["drug"]).unionByName(
            Q.derived_checks(clean, checks[1:]), allowMissingColumns=True),
        "02_missingness_analytic": Q.missingness(
            clean, [c for c in clean.columns if c not in SCALED.values() and c != "site_id"],
            EXPECTED_MISSING),
        "02_cohort_summary": _summary(p),
    }


def _sizes(df: DataFrame, column: str, minimum: int) -> Column:
    """(number of groups, number with at least ``minimum`` rows) as one scalar."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.struct(F.count(F.lit(1)).alias("n_all"),
                               n_where(F.col("n") >= minimum).alias("n_large"))).scalar()


def _summary(p: Prepared) -> DataFrame:
    rows = Q.cohort_summary(p.clean, {
        "n_after_exclusions": F.count(F.lit(1)), "n_with_weight": F.count("weight_kg"),
        "n_excluded_missing_weight": n_missing("weight_kg"),
        "n_etomidate": n_where((F.col("drug") == "etomidate") & F.col("weight_kg").isNotNull()),
        "n_ketamine": n_where((F.col("drug") == "ketamine") & F.col("weight_kg").isNotNull()),
        "year_min": F.min("calendar_year"), "year_max": F.max("calendar_year")},
        {"imputation_method": p.imputation_method})
    return (rows.withColumn("n_raw", p.raw.agg(F.count(F.lit(1))).scalar())
            .withColumn("_s", _sizes(p.analytic, "hospital_id", MIN_SITE))
            .withColumn("_p", _sizes(p.analytic, "provider_id", MIN_PROVIDER))
            .select("*", F.col("_s.n_all").alias("n_hospitals"),
                    F.col("_s.n_large").alias("n_hospitals_re"),
                    F.col("_p.n_all").alias("n_providers"),
                    F.col("_p.n_large").alias("n_providers_re"),
                    (F.col("_s.n_all") == 1).alias("single_hosp_site")).drop("_s", "_p"))


def _by_drug(values: dict[str, float]) -> Column:
    return chain([(F.col("drug") == d, v) for d, v in values.items()])


def descriptive_tables(p: Prepared) -> dict[str, DataFrame]:
    df, tier = p.analytic, F.col("dose_tier")
    reduced = {"pct_reduced": F.col("dose_reduced") == 1}
    low = {**reduced, "pct_low25": F.col("dose_low_25pct") == 1}
    tiers = {f"pct_tier_{t}": tier == t for t in TIER_NAMES}
    races = {"white": "NH White", "black": "NH Black/African American", "hispanic": "Hispanic",
             "asian": "NH Asian", "other_unk": "NH Other/Unknown"}
    dose = lambda group, more=reduced, **kw: B.group_summary(
        df, group, "dose_mg_kg", more, prefix="dose_mgkg", **kw)
    numeric = ["age_years", "cci", "worst_sbp_24hr_pre", "worst_hr_24hr_pre",
               "worst_spo2_24hr_pre", *VITALS, "induction_dose_mg", "dose_mg_kg"]
    is_set = lambda c: F.col(c) == 1
    present = df.where(F.col("dose_mg_kg").isNotNull())
    return {
        "tables/table1_by_drug": B.table_one(df, "drug", DRUGS, numeric, {
            "pct_male": F.lower("sex_category") == "male",
            **{f"pct_{n}": F.col("race_eth") == v for n, v in races.items()},
            **{f"pct_{f}": is_set(f) for f in FLAGS}, **low, **tiers,
            "pct_ed": F.col("location_group") == "ED"}),
        "tables/table1_missingness": B.missing_by_group(df, "drug", DRUGS, [
            *numeric, "sex_category", "race_category", "ethnicity_category", *FLAGS,
            "dose_tier", "location_group"]),
        "tables/table1_icu_type": B.shares(df, ["drug", "icu_type"], ["drug"], 1),
        "figures/dose_distribution_percentiles": B.percentile_ladder(
            df, "dose_mg_kg", ["drug"], "location_group", range(1, 100)),
        "figures/dose_decile_percentiles": B.percentile_ladder(
            df, "dose_mg_kg", ["drug"], "location_group", range(10, 100, 10), "decile"),
        "tables/dose_categorical_counts": B.band_counts(df, "drug", "dose_mg_kg", DOSE_BANDS,
                                                        label="dose_category"),
        "tables/dose_tier_counts": B.level_counts(
            df.where(tier.isNotNull()), "drug", "dose_tier", {d: TIER_NAMES for d in DRUGS}),
        "figures/dose_histogram_bins": B.histogram(present, "dose_mg_kg", 0.02, ["drug"]),
        "tables/hospital_dose_summary": dose(["hospital_id", "drug"]),
        "tables/provider_dose_summary": B.provider_summary(
            df, "provider_id", "drug", "dose_mg_kg", MIN_PROVIDER, reduced)
        .withColumn("ref_line", _by_drug(REFERENCE_DOSE))
        .withColumn("thresh_line", _by_drug(REDUCED_BELOW)),
        "tables/03_provider_drug_choice_summary": B.preference_share(
            df, "provider_id", F.col("drug") == "ketamine", MIN_PROVIDER,
            labels=("Predominantly etomidate (<=25%)", "Mixed (26-74%)",
                    "Predominantly ketamine (>=75%)")),
        "figures/annual_dose_trends": dose(["drug", "calendar_year"], low),
        "figures/quarterly_dose_trends": dose(["drug", "calendar_quarter", "hospital_type"]),
        "figures/drug_choice_by_quarter": B.shares(
            df, ["calendar_quarter", "hospital_type", "location_group", "drug"],
            ["calendar_quarter", "hospital_type", "location_group"], total="total"),
        "figures/drug_choice_by_year": B.shares(df, ["calendar_year", "drug"],
                                                ["calendar_year"], total="total"),
        "figures/dose_by_location": dose(["drug", "location_group"]),
        "figures/drug_choice_by_location": B.shares(df, ["location_group", "drug"],
                                                    ["location_group"], total="total"),
        "tables/table3_dose_by_strata": dose(
            ["drug", "hospital_type", "location_group"],
            {**low, **tiers, "pct_vaso_6hr": is_set("any_vasopressor_6hrs_prior"),
             "pct_ase": is_set("ASE_7d_prior")},
            others={"n_miss_dose_mgkg": n_missing("dose_mg_kg"),
                    "n_miss_sbp_24hr": n_missing("worst_sbp_24hr_pre"),
                    "n_miss_sbp_6hr": n_missing("worst_sbp_6hr_pre")},
            more_values=["induction_dose_mg"]),
    }


def study_design(df: DataFrame, outcome: str, fit: str | None = "drug",
                 keep: tuple[str, ...] = ()) -> D.Design:
    """The study's fixed effects, without terms that do not vary."""
    numeric, factors = D.varying_terms(df, NUMERIC_TERMS, list(FACTOR_TERMS))
    levels = {f: D.levels_of(df, f, FACTOR_TERMS[f]) for f in factors}
    return D.design(df, outcome, numeric, levels, "hospital_id", "provider_id", fit, keep)


def model_tables(spark: SparkSession, p: Prepared, replicates: int = 1000,
                 raw_replicates: int = 500) -> dict[str, DataFrame]:
    """Mixed models of dose, drug choice and reduced dose, with their sensitivity analyses."""
    df, out = p.analytic, {}
    table = lambda name, frame: out.__setitem__(
        name, spark.createDataFrame(frame)) if len(frame) else None
    for prefix, outcome, runs in (("", "dose_mg_kg", replicates),
                                  ("sa_rawmg_", "induction_dose_mg", raw_replicates)):
        model = study_design(df, outcome, keep=(KEY,))
        sums = L.sufficient_sums(model)
        fitted = L.fit_lmm(sums)
        parts = L.variance_components(fitted)
        if runs:
            parts = parts.merge(R.bootstrap_shares(model, fitted, [KEY], runs, SEED), how="left",
                                on=["fit", "component"])
        table(f"{prefix}variance_components", parts)
        table(f"{prefix}fixed_effects", L.fixed_effects(
            fitted, model.names, dof=L.degrees_of_freedom(sums, fitted)))
        table(f"{prefix}icc_results", L.icc_table(fitted))
        if not prefix:
            table("sa_provider_fixed_lrt", L.unit_fixed_test(sums))
    # one search for all logistic models of the same terms
    designs = {outcome: study_design(df, outcome, fit) for outcome, fit in
               (("drug_ketamine", None), ("dose_reduced", "drug"), ("dose_low_25pct", "drug"))}
    names = designs["drug_ketamine"].names
    rows = [d.rows.withColumn("fit", F.concat_ws("|", F.lit(outcome), "fit")) for outcome, d in designs.items()]
    fitted = G.fit_glmm(D.Design(reduce(DataFrame.unionByName, rows), names))
    parts = fitted["fit"].str.split("|", n=1, expand=True)
    fitted, outcomes = fitted.assign(fit=parts[1]), parts[0]
    choice = fitted[outcomes == "drug_ketamine"]
    table("sa_drug_choice_mor_icc", G.odds_summary(choice))
    table("sa_drug_choice_fixed_effects", L.fixed_effects(choice, names, True))
    aim4 = {o: fitted[outcomes == o] for o in ("dose_reduced", "dose_low_25pct")}
    table("aim4_mor_icc_results", pd.concat(G.odds_summary(f).assign(outcome=o) for o, f in aim4.items()))
    table("aim4_fixed_effects", pd.concat(L.fixed_effects(f, names, True).assign(outcome=o) for o, f in aim4.items()))
    groups = ("hospital_type", "location_group", "ASE_7d_prior")
    table("aim4_subgroup_mor_results", G.fit_subgroups(
        study_design(df, "dose_reduced", keep=groups), {g: g for g in groups}))
    trend_factors = {f: D.levels_of(df, f) for f in
                     D.varying_terms(df, [], ["hospital_type"])[1]}
    trend = D.design(df, "drug_ketamine", ["calendar_year_c"], trend_factors, "hospital_id",
                     "provider_id")
    fitted = G.fit_trend(trend)
    several = bool((fitted["n_sites"] > 1).any())
    table("time_trend_model_results", L.fixed_effects(fitted, trend.names, exponentiate=True).assign(
        model="drug_choice_time_trend", model_type=TREND_MODELS[several, bool(trend_factors)]))
    return out


def site_metadata(p: Prepared, components: DataFrame) -> DataFrame:
    """One row of what was run: sizes, years, time, and the dose model of each drug."""
    facts = {r["fit"]: r for r in components.groupBy("fit").agg(
        F.first("model_type").alias("model_type"), F.max("singular").alias("singular"),
        F.min("converged").alias("converged"),
        *([F.max(F.col("ci_lo").isNull()).alias("no_interval")] if "ci_lo" in components.columns else [])).collect()}
    out = _summary(p).withColumns({
        "date_range_years": F.concat_ws("-", "year_min", "year_max"), "version": F.lit("0.1.0"),
        "run_datetime": F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")})
    for drug in DRUGS:
        own = facts[drug].asDict() if drug in facts else {}
        out = out.withColumns({
            f"lmm_{drug}_{name}": F.lit(own.get(name)).cast("string" if name == "model_type" else "boolean")
            for name in ("model_type", "singular", "converged", "no_interval")})
    return out


def write_analysis(spark: SparkSession, site: Site, frame: DataFrame, replicates: int = 1000,
                   raw_replicates: int = 500) -> Prepared:
    """All tables of the analysis step, written to the site's shared folders."""
    prepared = prepare(frame)
    for name, table in quality_tables(prepared).items():
        write_shared(table, site, "diagnostics", f"{name}.csv")
    for name, table in descriptive_tables(prepared).items():
        kind, _, file = name.partition("/")
        write_shared(table, site, kind, f"{file}.csv")
    models = model_tables(spark, prepared, replicates, raw_replicates)
    for name, table in models.items():
        write_shared(table, site, "models", f"{name}.csv")
    metadata = site_metadata(prepared, models["variance_components"])
    write_shared(metadata, site, "diagnostics", "site_metadata.csv")
    return prepared
