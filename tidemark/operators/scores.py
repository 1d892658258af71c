"""Clinical scores from published definitions, as joins and aggregations.

Comorbidity index: codes of Quan et al. 2005, weights of Quan et al. 2011 (or Charlson et al.
1987). Organ failure score: Vincent et al. 1996. Sepsis surveillance event: Rhee et al. 2017.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.recode import chain
from .temporal import spread_join, window_join

# Conditions, their ICD-10 and ICD-9-CM codes (prefixes and prefix ranges, as
# published), the 2011 weights and the original weights.
CONDITIONS = {
    "myocardial_infarction": ("I21 I22 I252", "410 412", 0, 1),
    "heart_failure": ("I099 I110 I130 I132 I255 I420 I425-I429 I43 I50 P290",
                      "39891 40201 40211 40291 40401 40403 40411 40413 40491 40493 4254-4259 "
                      "428", 2, 1),
    "peripheral_vascular": ("I70 I71 I731 I738 I739 I771 I790 I792 K551 K558 K559 Z958 Z959",
                            "0930 4373 440 441 4431-4439 4471 5571 5579 V434", 0, 1),
    "cerebrovascular": ("G45 G46 H340 I60-I69", "36234 430-438", 0, 1),
    "dementia": ("F00-F03 F051 G30 G311", "290 2941 3312", 2, 1),
    "chronic_pulmonary": ("I278 I279 J40-J47 J60-J67 J684 J701 J703",
                          "4168 4169 490-505 5064 5081 5088", 1, 1),
    "rheumatic": ("M05 M06 M315 M32-M34 M351 M353 M360",
                  "4465 7100-7104 7140-7142 7148 725", 1, 1),
    "peptic_ulcer": ("K25-K28", "531-534", 0, 1),
    "mild_liver": ("B18 K700-K703 K709 K713-K715 K717 K73 K74 K760 K762-K764 K768 K769 Z944",
                   "07022 07023 07032 07033 07044 07054 0706 0709 570 571 5733 5734 5738 5739 "
                   "V427", 2, 1),
    "diabetes": ("E100 E101 E106 E108 E109 E110 E111 E116 E118 E119 E120 E121 E126 E128 E129 "
                 "E130 E131 E136 E138 E139 E140 E141 E146 E148 E149",
                 "2500-2503 2508 2509", 0, 1),
    "diabetes_complicated": ("E102-E105 E107 E112-E115 E117 E122-E125 E127 E132-E135 E137 "
                             "E142-E145 E147", "2504-2507", 1, 2),
    "paralysis": ("G041 G114 G801 G802 G81 G82 G830-G834 G839",
                  "3341 342 343 3440-3446 3449", 2, 2),
    "renal": ("I120 I131 N032-N037 N052-N057 N18 N19 N250 Z490-Z492 Z940 Z992",
              "40301 40311 40391 40402 40403 40412 40413 40492 40493 582 5830-5837 585 586 "
              "5880 V420 V451 V56", 1, 2),
    "cancer": ("C00-C26 C30-C34 C37-C41 C43 C45-C58 C60-C76 C81-C85 C88 C90-C97",
               "140-172 174-1958 200-208 2386", 2, 2),
    "severe_liver": ("I850 I859 I864 I982 K704 K711 K721 K729 K765 K766 K767",
                     "4560-4562 5722-5728", 4, 3),
    "metastatic": ("C77-C80", "196-199", 6, 6),
    "hiv": ("B20-B22 B24", "042-044", 4, 6),
}
# The milder condition does not count beside the graver one.
GRAVER = {"diabetes": "diabetes_complicated", "mild_liver": "severe_liver",
          "cancer": "metastatic"}


def _heads(lo: str, hi: str) -> list[str]:
    """Three-character stems from ``lo`` to ``hi``, which share their first character or are
    plain numbers."""
    lead = lo[0] if lo[0].isalpha() else ""
    first, last = int(lo[len(lead):3]), int(hi[len(lead):3])
    return [lead + str(i).zfill(3 - len(lead)) for i in range(first, last + 1)]


def code_table() -> list[tuple[str, str, str, str, str]]:
    """(version, stem, lo, hi, condition) for every stem of every range."""
    rows = []
    for condition, (icd10, icd9, _, _) in CONDITIONS.items():
        for version, text in (("10", icd10), ("9", icd9)):
            for part in text.split():
                lo, _, hi = part.partition("-")
                hi = hi or lo
                rows += [(version, head, lo, hi, condition) for head in _heads(lo, hi)]
    return rows


def comorbidity_index(diagnoses: DataFrame, key: str, code: str, code_format: str,
                      original_weights: bool = False) -> DataFrame:
    """``key, cci_score`` for every entity with a diagnosis row."""
    table = diagnoses.sparkSession.createDataFrame(
        code_table(), "version string, stem string, lo string, hi string, condition string")
    plain = F.upper(F.regexp_replace(F.col(code), "[^A-Za-z0-9]", ""))
    version = F.when(F.col(code_format).contains("10"), "10").otherwise("9")
    coded = (diagnoses.select(key, plain.alias("_code"), version.alias("version"))
             .withColumn("stem", F.substring("_code", 1, 3)))
    # A code belongs to a range if it begins with the end or lies between the ends.
    inside = (F.col("_code") >= F.col("lo")) & (
        F.expr("substring(_code, 1, length(hi))") <= F.col("hi"))
    matched = coded.join(F.broadcast(table), ["version", "stem"], "left").withColumn(
        "condition", F.when(inside, F.col("condition")))
    flags = matched.groupBy(key).agg(*[
        F.max(F.coalesce(F.col("condition") == c, F.lit(False))).alias(c) for c in CONDITIONS])
    score: Column = F.lit(0)
    for c, (_, _, new, old) in CONDITIONS.items():
        counts = F.col(c) & ~F.col(GRAVER[c]) if c in GRAVER else F.col(c)
        score = score + F.when(counts, old if original_weights else new).otherwise(0)
    return flags.select(key, score.cast("int").alias("cci_score"))


# Fixed values of the organ failure score: limits from mild to grave. A value scores the number
# of limits it passes.
BELOW = {"platelets": (150, 100, 50, 20), "gcs": (15, 13, 10, 6)}
AT_LEAST = {"bilirubin": (1.2, 2.0, 6.0, 12.0), "creatinine": (1.2, 2.0, 3.5, 5.0)}
RATIO = (400, 300, 200, 100)       # the last two count only with ventilation


def _steps(limits: Sequence[float], passed) -> Column:
    return sum((F.coalesce(passed(limit), F.lit(False)).cast("int") for limit in limits[1:]),
               F.coalesce(passed(limits[0]), F.lit(False)).cast("int"))


def organ_failure(index: DataFrame, measures: DataFrame, key: str, index_time: str,
                  event_time: str, category: str, value: str,
                  windows: Mapping[str, float]) -> DataFrame:
    """Organ failure score from the worst values in each look-back window.

    Categories: pf_ratio, ventilated (0/1), platelets, bilirubin, map, gcs, creatinine,
    dopamine, dobutamine, epinephrine, norepinephrine. A missing organ scores 0. Entities
    without any measure in a window get null for it.
    """
    hits = window_join(index.select(key, index_time),
                       measures.select(key, event_time, category, value), key, index_time,
                       event_time, -max(windows.values()), 0.0)
    low = ("pf_ratio", "platelets", "map", "gcs")
    high = ("ventilated", "bilirubin", "creatinine", "dopamine", "dobutamine", "epinephrine",
            "norepinephrine")
    x, kind, before = F.col(value), F.col(category), -F.col("gap_seconds")
    worst = []
    for suffix, length in windows.items():
        here = before <= length
        worst += [F.min(F.when(here & (kind == c), x)).alias(f"{c}_{suffix}") for c in low]
        worst += [F.max(F.when(here & (kind == c), x)).alias(f"{c}_{suffix}") for c in high]
        worst.append(F.count_if(here).alias(f"seen_{suffix}"))
    found = hits.groupBy(key).agg(*worst)
    for suffix in windows:
        at = lambda c: F.col(f"{c}_{suffix}")  # noqa: E731,B023
        ventilated = F.coalesce(at("ventilated") == 1, F.lit(False))
        pressor = F.greatest(at("epinephrine"), at("norepinephrine"))
        respiration = (_steps(RATIO[:2], lambda v: at("pf_ratio") < v)
                       + _steps(RATIO[2:], lambda v: (at("pf_ratio") < v) & ventilated))
        circulation = chain([
            ((at("dopamine") > 15) | (pressor > 0.1), 4),
            ((at("dopamine") > 5) | (pressor > 0), 3),
            ((at("dopamine") > 0) | (at("dobutamine") > 0), 2),
            (at("map") < 70, 1)], 0)
        total = respiration + circulation
        for c, limits in BELOW.items():
            total = total + _steps(limits, lambda v, c=c: at(c) < v)
        for c, limits in AT_LEAST.items():
            total = total + _steps(limits, lambda v, c=c: at(c) >= v)
        found = found.withColumn(f"sofa_{suffix}", F.when(F.col(f"seen_{suffix}") > 0,
                                                          total.cast("int")))
    return found.select(key, *[f"sofa_{s}" for s in windows])


def organ_dysfunction(labs: DataFrame, supports: DataFrame, key: str, time: str, category: str,
                      value: str) -> DataFrame:
    """Times of organ dysfunction: start of support, or a laboratory value far off the
    entity's best one (creatinine doubled; bilirubin at least 2 and doubled; platelets below
    100 and at most half of a best value of 100 or more)."""
    x, kind = F.col(value), F.col(category)
    best = labs.groupBy(key).agg(
        F.min(F.when(kind == "creatinine", x)).alias("_creatinine"),
        F.min(F.when(kind == "bilirubin", x)).alias("_bilirubin"),
        F.max(F.when(kind == "platelets", x)).alias("_platelets"))
    off = (((kind == "creatinine") & (x >= 2 * F.col("_creatinine")))
           | ((kind == "bilirubin") & (x >= 2) & (x >= 2 * F.col("_bilirubin")))
           | ((kind == "platelets") & (x < 100) & (F.col("_platelets") >= 100)
              & (x <= 0.5 * F.col("_platelets"))))
    far = spread_join(best, labs, key, [time]).where(off).select(key, time)
    return far.unionByName(supports.select(key, time))


def antibiotic_runs(doses: DataFrame, key: str, time: str, gap_days: int = 2) -> DataFrame:
    """Runs of antibiotic days with at most ``gap_days - 1`` days between them.

    Doses are first reduced to days, so the windows hold at most one row per calendar day of
    an entity. Columns: ``key, first_day, last_day, first_dose``.
    """
    days = doses.groupBy(key, F.to_date(time).alias("_day")).agg(F.min(time).alias("_first"))
    order = W.partitionBy(key).orderBy("_day")
    new = F.coalesce(F.datediff("_day", F.lag("_day").over(order)) > gap_days, F.lit(True))
    return (days.withColumn("_run", F.sum(new.cast("int")).over(order))
            .groupBy(key, "_run").agg(F.min("_day").alias("first_day"),
                                      F.max("_day").alias("last_day"),
                                      F.min("_first").alias("first_dose")).drop("_run"))


def sepsis_event(cultures: DataFrame, doses: DataFrame, dysfunction: DataFrame,
                 ends: DataFrame, key: str, time: str, end_time: str, min_days: int = 4,
                 near_days: int = 2) -> DataFrame:
    """Presumed infection and sepsis per entity with a culture.

    Infection: a run of antibiotics that starts within ``near_days`` days of a culture and
    lasts ``min_days`` days, or up to the day before the entity's end. Sepsis: also an organ
    dysfunction within ``near_days`` days of that culture. Onset is the earliest part.

    All parts are reduced to one row per entity and calendar day before they meet, and meet
    on (entity, day).
    """
    drawn = cultures.groupBy(key, F.to_date(time).alias("_day")).agg(
        F.min(time).alias("_culture"))
    span = F.sequence(F.date_sub("_day", near_days), F.date_add("_day", near_days))
    around = drawn.withColumn("_near", F.explode(span))
    runs = antibiotic_runs(doses, key, time).join(
        ends.select(key, F.to_date(end_time).alias("_end")), key, "left")
    long_enough = (F.datediff("last_day", "first_day") + 1 >= min_days) | (
        F.col("last_day") >= F.date_sub("_end", 1))
    starts = runs.where(long_enough).select(key, F.col("first_day").alias("_near"), "first_dose")
    infected = (around.join(starts, [key, "_near"])
                .groupBy(key, "_day", "_culture").agg(F.min("first_dose").alias("_dose"))
                .withColumn("_infection", F.least("_culture", "_dose")))
    failing = dysfunction.groupBy(key, F.to_date(time).alias("_near")).agg(
        F.min(time).alias("_failure"))
    septic = (infected.withColumn("_near", F.explode(span)).join(failing, [key, "_near"])
              .groupBy(key).agg(F.min(F.least("_infection", "_failure")).alias("sepsis_onset")))
    onset = infected.groupBy(key).agg(F.min("_infection").alias("infection_onset"))
    return (drawn.select(key).distinct().join(onset, key, "left").join(septic, key, "left")
            .select(key, F.col("infection_onset").isNotNull().cast("int")
                    .alias("presumed_infection"), "infection_onset",
                    F.col("sepsis_onset").isNotNull().cast("int").alias("sepsis"),
                    "sepsis_onset"))
