"""Queries on the encounter stand-in: quality checks, descriptive tables, trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.measures import n_missing, n_where
from ..functions.recode import band_within, chain, shortfall
from ..operators import describe as B, quality as Q
from .registry import query
from .standins import ENCOUNTERS_SQL, encounters, events, table

ENC = f"WITH {ENCOUNTERS_SQL}"
DRUGS = ["F", "O"]

# Band edges and labels per drug of the stand-in.
BANDS = {
    "F": ([500.0, 1000.0, 2000.0, 4000.0, 8000.0, 50000.0],
          ["<500", "500-999", "1000-1999", "2000-3999", "4000-7999", "8000-49999", ">=50000"]),
    "O": ([1000.0, 3000.0, 9000.0], ["<1000", "1000-2999", "3000-8999", ">=9000"]),
}
TIERS = {
    "F": ([1500.0, 2500.0, 3500.0],
          ["reduced", "intermediate_reduced", "intermediate_full", "full"]),
    "O": ([1000.0, 2000.0, 3000.0],
          ["reduced", "intermediate_reduced", "intermediate_full", "full"]),
}


def _case(value: str, bands: dict, name: str) -> str:
    parts = []
    for drug, (edges, labels) in bands.items():
        for edge, label in zip(edges, labels):
            parts.append(f"WHEN drug = '{drug}' AND {value} < {edge} THEN '{label}'")
        parts.append(f"WHEN drug = '{drug}' THEN '{labels[-1]}'")
    return f"CASE WHEN {value} IS NULL THEN NULL {' '.join(parts)} END AS {name}"


def _levels(bands: dict) -> str:
    return ", ".join(f"('{d}', '{label}', {i})" for d, (_, labels) in bands.items()
                     for i, label in enumerate(labels))


def derived(enc):
    """Tiers, reduced-dose flag and relative shortfall of the dose."""
    reduced = chain([
        ((F.col("drug") == "F") & F.col("dose_per_weight").isNotNull(),
         (F.col("dose_per_weight") < 2500).cast("int")),
        ((F.col("drug") == "O") & F.col("dose_per_weight").isNotNull(),
         (F.col("dose_per_weight") < 2000).cast("int"))]).cast("int")
    reference = chain([(F.col("drug") == "F", 3500.0), (F.col("drug") == "O", 3000.0)])
    return (enc.withColumn("tier", band_within("dose_per_weight", "drug", TIERS))
            .withColumn("reduced", reduced)
            .withColumn("below_reference", shortfall("dose_per_weight", reference))
            .withColumn("low25", (F.col("below_reference") > 0.25).cast("int")))


DERIVED_SQL = f"""{ENCOUNTERS_SQL},
der AS (
  SELECT *, CAST(below_reference > 0.25 AS INTEGER) AS low25 FROM (
    SELECT *, {_case('dose_per_weight', TIERS, 'tier')},
      CASE WHEN drug = 'F' THEN CAST(dose_per_weight < 2500 AS INTEGER)
           WHEN drug = 'O' THEN CAST(dose_per_weight < 2000 AS INTEGER) END AS reduced,
      (CASE WHEN drug = 'F' THEN 3500.0::DOUBLE ELSE 3000.0::DOUBLE END - dose_per_weight)
        / CASE WHEN drug = 'F' THEN 3500.0::DOUBLE ELSE 3000.0::DOUBLE END AS below_reference
    FROM enc))"""


def _rounded(df, *names, digits=6):
    """Averages with 6 digits, order statistics with 9 (they have no exact tie there)."""
    exact = ("_median", "_q1", "_q3", "quantile")
    return df.select(*[
        F.round(c, 9 if c.endswith(exact) else digits).alias(c) if c in names else c
        for c in df.columns])


def _quart(x: str, prefix: str) -> str:
    return (f"round(median({x}), 9) AS {prefix}_median, "
            f"round(quantile_cont({x}, 0.25), 9) AS {prefix}_q1, "
            f"round(quantile_cont({x}, 0.75), 9) AS {prefix}_q3")


def _pct(cond: str, name: str) -> str:
    return f"round(avg(CAST({cond} AS DOUBLE)) * 100, 6) AS {name}"


@query("missingness", """
WITH m AS (SELECT CASE WHEN value <= 100 THEN value END AS value,
                  CASE WHEN event_id % 50 > 0 THEN event_type END AS event_type,
                  user_id, ts FROM events),
c AS (SELECT count(*) AS n, count(*) - count(value) AS a, count(*) - count(event_type) AS b,
             count(*) - count(user_id) AS u, count(*) - count(ts) AS t FROM m),
l AS (SELECT 'value' AS variable, n, a AS miss, false AS expected FROM c
      UNION ALL SELECT 'event_type', n, b, false FROM c
      UNION ALL SELECT 'user_id', n, u, false FROM c
      UNION ALL SELECT 'ts', n, t, true FROM c)
SELECT variable, n AS n_total, miss AS n_missing, round(miss * 100.0::DOUBLE / n, 1) AS pct_missing,
       expected AS expected_missing,
       CASE WHEN expected THEN 'expected_missing'
            WHEN round(miss * 100.0::DOUBLE / n, 1) = 0 THEN 'ok'
            WHEN round(miss * 100.0::DOUBLE / n, 1) <= 5 THEN 'low_missing'
            WHEN round(miss * 100.0::DOUBLE / n, 1) <= 20 THEN 'moderate_missing'
            ELSE 'high_missing' END AS flag FROM l""")
def missingness(spark, sf):
    ev = events(spark, sf).select(
        F.when(F.col("value") <= 100, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 50 > 0, F.col("event_type")).alias("event_type"),
        "user_id", "ts")
    return Q.missingness(ev, ["value", "event_type", "user_id", "ts"], {"ts"})


@query("range_checks", f"""
{ENC},
r AS (
  SELECT 'dose' AS variable, 'dose: 1000-90000' AS label, 'all' AS category, min(dose) AS lo,
         max(dose) AS hi, count(*) FILTER (WHERE dose < 1000) AS b,
         count(*) FILTER (WHERE dose > 90000) AS a FROM enc
  UNION ALL
  SELECT 'dose_per_weight', 'F: 100-20000', 'F', min(dose_per_weight), max(dose_per_weight),
         count(*) FILTER (WHERE dose_per_weight < 100),
         count(*) FILTER (WHERE dose_per_weight > 20000) FROM enc WHERE drug = 'F'
  UNION ALL
  SELECT 'weight', 'weight: 1-50', 'all', min(weight), max(weight),
         count(*) FILTER (WHERE weight < 1), count(*) FILTER (WHERE weight > 50) FROM enc)
SELECT variable, label, category, round(lo, 3) AS min_obs, round(hi, 3) AS max_obs,
       b AS n_below, a AS n_above, a + b AS n_flagged,
       CASE WHEN a + b > 0 THEN 'impossible_value' ELSE 'ok' END AS flag FROM r
UNION ALL
SELECT 'returned', 'returned: expect 0/1', 'all', min(returned)::DOUBLE, max(returned)::DOUBLE,
       NULL, NULL, count(*) FILTER (WHERE returned NOT IN (0, 1)),
       CASE WHEN count(*) FILTER (WHERE returned NOT IN (0, 1)) > 0 THEN 'impossible_value'
            ELSE 'ok' END FROM enc""")
def range_checks(spark, sf):
    return Q.range_checks(encounters(spark, sf), [
        Q.RangeRule("dose", 1000, 90000, "dose: 1000-90000"),
        Q.RangeRule("dose_per_weight", 100, 20000, "F: 100-20000", "F"),
        Q.RangeRule("weight", 1, 50, "weight: 1-50")], "drug", ["returned"])


@query("domain_checks", """
SELECT 'l_returnflag' AS variable,
       count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) AS n_unexpected,
       CASE WHEN count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) > 0
            THEN 'unexpected_value' ELSE 'ok' END AS flag FROM lineitem
UNION ALL
SELECT 'l_linestatus', count(*) FILTER (WHERE l_linestatus NOT IN ('F', 'O')),
       CASE WHEN count(*) FILTER (WHERE l_linestatus NOT IN ('F', 'O')) > 0
            THEN 'unexpected_value' ELSE 'ok' END FROM lineitem""")
def domain_checks(spark, sf):
    return Q.domain_checks(table(spark, sf, "lineitem"), {
        "l_returnflag": ["A", "N"], "l_linestatus": ["F", "O"]})


@query("dup_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dup_keys(spark, sf):
    return Q.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dup_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
WHERE (l_orderkey, l_linenumber) IN (
  SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber
  HAVING count(*) > 1)""")
def dup_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                "l_extendedprice")
    return Q.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


@query("exclusion_waterfall", f"""
{ENC},
f AS (SELECT dose BETWEEN 2000 AND 90000 AS a, weight IS NULL OR weight BETWEEN 3 AND 45 AS b,
             dose_per_weight IS NULL OR (drug = 'F' AND dose_per_weight BETWEEN 100 AND 20000)
               OR (drug = 'O' AND dose_per_weight BETWEEN 50 AND 10000) AS c FROM enc),
n AS (SELECT count(*) AS n0, count(*) FILTER (WHERE a) AS n1,
             count(*) FILTER (WHERE a AND b) AS n2,
             count(*) FILTER (WHERE a AND b AND c) AS n3 FROM f)
SELECT 0 AS step_no, 'Loaded' AS step, n0 AS n, CAST(0 AS BIGINT) AS n_excluded FROM n
UNION ALL SELECT 1, 'Exclude: impossible dose', n1, n0 - n1 FROM n
UNION ALL SELECT 2, 'Exclude: impossible weight', n2, n1 - n2 FROM n
UNION ALL SELECT 3, 'Exclude: impossible dose per weight', n3, n2 - n3 FROM n""")
def exclusion_waterfall(spark, sf):
    per, drug = F.col("dose_per_weight"), F.col("drug")
    _, flow = Q.waterfall(encounters(spark, sf), [
        ("Exclude: impossible dose", F.col("dose").between(2000, 90000)),
        ("Exclude: impossible weight",
         F.col("weight").isNull() | F.col("weight").between(3, 45)),
        ("Exclude: impossible dose per weight",
         per.isNull() | ((drug == "F") & per.between(100, 20000))
         | ((drug == "O") & per.between(50, 10000)))])
    return flow


@query("volume_summary", f"""
{ENC},
u AS (SELECT provider, count(weight) AS c, count(*) AS n FROM enc GROUP BY provider),
lim AS (SELECT 580 AS k),
g AS (SELECT CASE WHEN c >= k THEN '>= 580' ELSE '< 580' END AS grp, * FROM u, lim
      UNION ALL SELECT 'all', * FROM u, lim)
SELECT grp AS "group", count(*) AS n_units, CAST(sum(c) AS BIGINT) AS n_complete,
       CAST(sum(n - c) AS BIGINT) AS n_incomplete, CAST(sum(n) AS BIGINT) AS n_rows,
       max(c) AS complete_max, median(c) AS complete_median,
       quantile_cont(c, 0.25) AS complete_q1, quantile_cont(c, 0.75) AS complete_q3,
       round(count(*) / (SELECT count(*) FROM u) * 100, 1) AS pct_units,
       round(sum(n - c) / sum(n) * 100, 1) AS pct_incomplete
FROM g GROUP BY grp""")
def volume_summary(spark, sf):
    return Q.volume_summary(encounters(spark, sf), "provider", F.col("weight").isNotNull(), 580)


@query("volume_chart", f"""
{ENC},
u AS (SELECT provider, count(weight) AS c, count(*) AS n FROM enc GROUP BY provider),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, provider) AS unit_rank FROM u)
SELECT unit_rank, 'n_complete' AS kind, c AS n FROM r
UNION ALL SELECT unit_rank, 'n_incomplete', n - c FROM r""")
def volume_chart(spark, sf):
    units = Q.volume_by_unit(encounters(spark, sf), "provider", F.col("weight").isNotNull(), 580)
    return Q.volume_chart(units, "provider")


@query("derived_checks", f"""
WITH {DERIVED_SQL},
c AS (SELECT drug, tier IN ('reduced', 'intermediate_reduced') AS l1, reduced = 1 AS r1,
             below_reference > 0.25 AS l2, low25 = 1 AS r2,
             abs(dose_per_weight - dose / weight) <= 0.01 AS l3, true AS r3 FROM der),
s AS (
  SELECT drug, 'tier below threshold' AS check_name, l1 AS l, r1 AS r FROM c
  UNION ALL SELECT drug, 'low by a quarter', l2, r2 FROM c
  UNION ALL SELECT drug, 'recomputed ratio', l3, CASE WHEN l3 IS NOT NULL THEN r3 END FROM c)
SELECT drug, check_name, count(*) FILTER (WHERE l) AS n_left, count(*) FILTER (WHERE r) AS n_right,
       count(*) FILTER (WHERE l <> r) AS n_mismatch,
       CASE WHEN count(*) FILTER (WHERE l <> r) = 0 THEN 'PASS' ELSE 'MISMATCH' END AS verdict
FROM s GROUP BY drug, check_name""")
def derived_checks(spark, sf):
    close = F.abs(F.col("dose_per_weight") - F.col("dose") / F.col("weight")) <= 0.01
    return Q.derived_checks(derived(encounters(spark, sf)), [
        Q.Consistency("tier below threshold",
                      F.col("tier").isin("reduced", "intermediate_reduced"),
                      F.col("reduced") == 1),
        Q.Consistency("low by a quarter", F.col("below_reference") > 0.25, F.col("low25") == 1),
        Q.Consistency("recomputed ratio", close, F.when(close.isNotNull(), F.lit(True))),
    ], ["drug"])


@query("collapse_levels", """
WITH lv AS (SELECT CASE WHEN l_partkey % 1000 < 3 THEN 'rare_' || (l_partkey % 1000)::VARCHAR
                        WHEN l_partkey % 5 = 0 THEN 'east' WHEN l_partkey % 5 < 3 THEN 'north'
                        ELSE 'west' END AS level FROM lineitem),
n AS (SELECT level, count(*) AS k FROM lv GROUP BY level),
lim AS (SELECT count(*) / 400 AS m FROM lineitem),
o AS (SELECT sum(k) AS ok FROM n, lim WHERE k < m),
big AS (SELECT level FROM n, lim WHERE k >= m ORDER BY k DESC, level LIMIT 1)
SELECT CASE WHEN k >= m THEN lv.level WHEN (SELECT ok FROM o) < m THEN (SELECT level FROM big)
            ELSE 'other' END AS level, count(*) AS n
FROM lv JOIN n USING (level), lim GROUP BY 1""")
def collapse_levels(spark, sf):
    part = F.col("l_partkey")
    level = chain([
        (part % 1000 < 3, F.concat(F.lit("rare_"), (part % 1000).cast("string"))),
        (part % 5 == 0, "east"), (part % 5 < 3, "north")], "west")
    rows = table(spark, sf, "lineitem").select(level.alias("level"))
    smallest = rows.count() / 400
    return (Q.collapse_levels(rows, "level", smallest, "other")
            .groupBy("level").agg(F.count(F.lit(1)).alias("n")))


@query("anon_ids", """
SELECT s_name, row_number() OVER (ORDER BY s_name) AS anon_id
FROM (SELECT DISTINCT s_name FROM supplier JOIN lineitem ON l_suppkey = s_suppkey)""")
def anon_ids(spark, sf):
    used = table(spark, sf, "lineitem").select("l_suppkey")
    names = table(spark, sf, "supplier").join(used, F.col("s_suppkey") == F.col("l_suppkey"),
                                              "left_semi")
    return Q.anonymous_ids(names, "s_name", "anon_id")


@query("included_vs_excluded", f"""
{ENC}
SELECT CASE WHEN weight IS NOT NULL THEN 'included' ELSE 'excluded' END AS "group",
       count(*) AS n, median(dose) AS dose_median, {_pct("returned = 1", "pct_returned")},
       {_pct("drug = 'F'", "pct_f")}
FROM enc GROUP BY 1""")
def included_vs_excluded(spark, sf):
    out = Q.included_vs_excluded(encounters(spark, sf), F.col("weight").isNotNull(), "dose", {
        "pct_returned": F.col("returned") == 1, "pct_f": F.col("drug") == "F"})
    return _rounded(out, "pct_returned", "pct_f")


@query("cohort_summary", f"""
{ENC}
SELECT count(*) AS n_raw, count(weight) AS n_with_weight,
       count(*) FILTER (WHERE drug = 'F') AS n_f, count(DISTINCT site) AS n_sites,
       count(DISTINCT provider) AS n_providers, min(year)::SMALLINT AS year_min,
       max(year)::SMALLINT AS year_max, 'site_a' AS site_id FROM enc""")
def cohort_summary(spark, sf):
    return Q.cohort_summary(encounters(spark, sf), {
        "n_raw": F.count(F.lit(1)), "n_with_weight": F.count("weight"),
        "n_f": n_where(F.col("drug") == "F"), "n_sites": F.countDistinct("site"),
        "n_providers": F.countDistinct("provider"), "year_min": F.min("year"),
        "year_max": F.max("year")}, {"site_id": "site_a"})


_T1_NUMERIC = ["dose", "dose_per_weight", "weight", "discount"]


@query("table1", f"""
WITH {DERIVED_SQL},
s AS (SELECT drug, count(*)::DOUBLE AS n, {_pct("returned = 1", "pct_returned")},
  {_pct("reduced = 1", "pct_reduced")}, {_pct("tier = 'full'", "pct_tier_full")},
  {', '.join(_quart(x, x) for x in _T1_NUMERIC)} FROM der GROUP BY drug),
l AS (SELECT drug, statistic, value FROM s UNPIVOT (value FOR statistic IN (
  n, pct_returned, pct_reduced, pct_tier_full,
  {', '.join(f'{x}_{q}' for x in _T1_NUMERIC for q in ('median', 'q1', 'q3'))})))
SELECT statistic, max(CASE WHEN drug = 'F' THEN value END) AS "F",
       max(CASE WHEN drug = 'O' THEN value END) AS "O" FROM l GROUP BY statistic""")
def table1(spark, sf):
    out = B.table_one(derived(encounters(spark, sf)), "drug", DRUGS, _T1_NUMERIC, {
        "pct_returned": F.col("returned") == 1, "pct_reduced": F.col("reduced") == 1,
        "pct_tier_full": F.col("tier") == "full"})
    is_order = F.col("statistic").rlike("_(median|q1|q3)$")
    return out.select("statistic", *[
        F.when(is_order, F.round(d, 9)).otherwise(F.round(d, 6)).alias(d) for d in DRUGS])


@query("table1_missing", f"""
WITH {DERIVED_SQL},
s AS (SELECT drug, (count(*) - count(weight))::DOUBLE AS weight_n_miss,
        round((count(*) - count(weight))::DOUBLE / count(*) * 100, 1) AS weight_pct_miss,
        (count(*) - count(tier))::DOUBLE AS tier_n_miss,
        round((count(*) - count(tier))::DOUBLE / count(*) * 100, 1) AS tier_pct_miss
      FROM der GROUP BY drug),
l AS (SELECT drug, statistic, value FROM s UNPIVOT (value FOR statistic IN (
        weight_n_miss, weight_pct_miss, tier_n_miss, tier_pct_miss)))
SELECT statistic, max(CASE WHEN drug = 'F' THEN value END) AS "F",
       max(CASE WHEN drug = 'O' THEN value END) AS "O" FROM l GROUP BY statistic""")
def table1_missing(spark, sf):
    return B.missing_by_group(derived(encounters(spark, sf)), "drug", DRUGS, ["weight", "tier"])


@query("subtype_shares", f"""
{ENC}
SELECT drug, place, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY drug) * 100, 1) AS pct
FROM enc GROUP BY drug, place""")
def subtype_shares(spark, sf):
    return B.shares(encounters(spark, sf), ["drug", "place"], ["drug"], 1)


@query("cross_tab", f"""
{ENC},
n AS (SELECT CASE WHEN year < 1998 THEN 'before' WHEN year > 1998 THEN 'after'
             ELSE 'Unknown' END AS era, CASE WHEN weight IS NULL THEN 'Unknown' ELSE drug END AS d
      FROM enc)
SELECT era, count(*) FILTER (WHERE d = 'F') AS "n_F", count(*) FILTER (WHERE d = 'O') AS "n_O",
       count(*) FILTER (WHERE d = 'Unknown') AS "n_Unknown", count(*) AS total,
       round(count(*) FILTER (WHERE d = 'F') / count(*) * 100, 1) AS "pct_F",
       round(count(*) FILTER (WHERE d = 'O') / count(*) * 100, 1) AS "pct_O",
       round(count(*) FILTER (WHERE d = 'Unknown') / count(*) * 100, 1) AS "pct_Unknown"
FROM n GROUP BY era""")
def cross_tab(spark, sf):
    enc = encounters(spark, sf)
    era = F.when(F.col("year") < 1998, "before").when(F.col("year") > 1998, "after")
    masked = enc.select(era.alias("era"),
                        F.when(F.col("weight").isNotNull(), F.col("drug")).alias("drug"))
    return B.cross_tab(masked, "era", "drug", DRUGS)


def _ladder_sql(percents, name):
    steps = ", ".join(str(p) for p in percents)
    return f"""
{ENC},
g AS (SELECT drug, 'All' AS place, dose_per_weight AS x FROM enc
      UNION ALL SELECT drug, place, dose_per_weight FROM enc),
q AS (SELECT drug, place, quantile_cont(x, [{', '.join(str(p / 100) for p in percents)}]) AS qs
      FROM g GROUP BY drug, place)
SELECT drug, place, unnest([{steps}])::INTEGER AS {name}, round(unnest(qs), 9) AS quantile
FROM q"""


@query("percentile_ladder", _ladder_sql(range(1, 100), "percentile"))
def percentile_ladder(spark, sf):
    out = B.percentile_ladder(encounters(spark, sf), "dose_per_weight", ["drug"], "place",
                              range(1, 100))
    return _rounded(out, "quantile")


@query("decile_ladder", _ladder_sql(range(10, 100, 10), "decile"))
def decile_ladder(spark, sf):
    out = B.percentile_ladder(encounters(spark, sf), "dose_per_weight", ["drug"], "place",
                              range(10, 100, 10), "decile")
    return _rounded(out, "quantile")


def _level_sql(bands, label, rounding):
    pct = "coalesce(k, 0) * 100.0::DOUBLE / sum(coalesce(k, 0)) OVER (PARTITION BY lv.drug)"
    return f"""
{ENC},
b AS (SELECT drug, {_case('dose_per_weight', bands, 'lab')} FROM enc
      WHERE dose_per_weight IS NOT NULL),
n AS (SELECT drug, lab, count(*) AS k FROM b GROUP BY drug, lab),
lv(drug, lab, level_no) AS (VALUES {_levels(bands)})
SELECT lv.drug, lv.lab AS {label}, level_no, coalesce(k, 0) AS n, round({pct}, {rounding}) AS pct
FROM lv LEFT JOIN n ON n.drug = lv.drug AND n.lab = lv.lab"""


@query("band_counts", _level_sql(BANDS, "band", 1))
def band_counts(spark, sf):
    return B.band_counts(encounters(spark, sf), "drug", "dose_per_weight", BANDS)


@query("tier_counts", _level_sql(TIERS, "tier", 6))
def tier_counts(spark, sf):
    rows = derived(encounters(spark, sf)).where(F.col("tier").isNotNull())
    return _rounded(B.level_counts(rows, "drug", "tier",
                                   {d: names for d, (_, names) in TIERS.items()}), "pct")


_SUMMARY = "n value_mean value_sd value_median value_q1 value_q3".split()


def _summary_sql(x="dose_per_weight", prefix="value"):
    return (f"count(*) AS n, round(avg({x}), 6) AS {prefix}_mean, "
            f"round(stddev_samp({x}), 6) AS {prefix}_sd, {_quart(x, prefix)}")


def _summary(df, group, percentages, others=None, more=()):
    out = B.group_summary(df, group, "dose_per_weight", percentages, others, "value", more)
    floats = [c for c, t in out.dtypes if t == "double"]
    return _rounded(out, *floats)


@query("group_dose_summary", f"""
WITH {DERIVED_SQL}
SELECT site, drug, {_summary_sql()}, {_pct("reduced = 1", "pct_reduced")}
FROM der GROUP BY site, drug""")
def group_dose_summary(spark, sf):
    return _summary(derived(encounters(spark, sf)), ["site", "drug"],
                    {"pct_reduced": F.col("reduced") == 1})


@query("provider_summary", f"""
WITH {DERIVED_SQL},
s AS (SELECT provider, drug, count(*) AS n, median(dose_per_weight) AS med,
        {_summary_sql()[_summary_sql().index('round'):]}, {_pct("reduced = 1", "pct_reduced")}
      FROM der GROUP BY provider, drug HAVING count(*) >= 290)
SELECT drug, n, value_mean, value_sd, value_median, value_q1, value_q3, pct_reduced,
       row_number() OVER (PARTITION BY drug ORDER BY med, provider) AS provider_rank FROM s""")
def provider_summary(spark, sf):
    out = B.provider_summary(derived(encounters(spark, sf)), "provider", "drug",
                             "dose_per_weight", 290, {"pct_reduced": F.col("reduced") == 1})
    return _rounded(out, *[c for c, t in out.dtypes if t == "double"])


@query("preference_share", f"""
{ENC},
s AS (SELECT provider, count(*) AS n, count(*) FILTER (WHERE drug = 'O') AS n_chosen,
             round(count(*) FILTER (WHERE drug = 'O') / count(*) * 100, 1) AS pct_chosen
      FROM enc GROUP BY provider HAVING count(*) >= 550)
SELECT n, n_chosen, n - n_chosen AS n_other, pct_chosen,
       row_number() OVER (ORDER BY pct_chosen, provider) AS provider_rank,
       CASE WHEN pct_chosen >= 52 THEN 'mostly_chosen' WHEN pct_chosen <= 48 THEN 'mostly_other'
            ELSE 'mixed' END AS predominant FROM s""")
def preference_share(spark, sf):
    return B.preference_share(encounters(spark, sf), "provider", F.col("drug") == "O", 550,
                              52.0, 48.0)


@query("annual_trends", f"""
WITH {DERIVED_SQL}
SELECT drug, year::SMALLINT AS year, {_summary_sql()}, {_pct("reduced = 1", "pct_reduced")},
       {_pct("low25 = 1", "pct_low25")}
FROM der GROUP BY drug, year""")
def annual_trends(spark, sf):
    return _summary(derived(encounters(spark, sf)), ["drug", "year"], {
        "pct_reduced": F.col("reduced") == 1, "pct_low25": F.col("low25") == 1})


@query("quarterly_trends", f"""
WITH {DERIVED_SQL}
SELECT drug, quarter::TINYINT AS quarter, place, {_summary_sql()},
       {_pct("reduced = 1", "pct_reduced")}
FROM der GROUP BY drug, quarter, place""")
def quarterly_trends(spark, sf):
    return _summary(derived(encounters(spark, sf)), ["drug", "quarter", "place"],
                    {"pct_reduced": F.col("reduced") == 1})


@query("choice_by_quarter", f"""
{ENC}
SELECT quarter::TINYINT AS quarter, site, place, drug, count(*) AS n,
       CAST(sum(count(*)) OVER (PARTITION BY quarter, site, place) AS BIGINT) AS total,
       round(count(*) / sum(count(*)) OVER (PARTITION BY quarter, site, place) * 100, 6) AS pct
FROM enc GROUP BY quarter, site, place, drug""")
def choice_by_quarter(spark, sf):
    return B.shares(encounters(spark, sf), ["quarter", "site", "place", "drug"],
                    ["quarter", "site", "place"], 6, "total")


@query("choice_by_year", f"""
{ENC}
SELECT year::SMALLINT AS year, drug, count(*) AS n,
       CAST(sum(count(*)) OVER (PARTITION BY year) AS BIGINT) AS total,
       round(count(*) / sum(count(*)) OVER (PARTITION BY year) * 100, 6) AS pct
FROM enc GROUP BY year, drug""")
def choice_by_year(spark, sf):
    return B.shares(encounters(spark, sf), ["year", "drug"], ["year"], 6, "total")


@query("dose_by_place", f"""
WITH {DERIVED_SQL}
SELECT drug, place, {_summary_sql()}, {_pct("reduced = 1", "pct_reduced")}
FROM der GROUP BY drug, place""")
def dose_by_place(spark, sf):
    return _summary(derived(encounters(spark, sf)), ["drug", "place"],
                    {"pct_reduced": F.col("reduced") == 1})


@query("strata_table", f"""
WITH {DERIVED_SQL}
SELECT drug, site, place, {_summary_sql()}, {_quart("dose", "dose")},
       {_pct("tier = 'reduced'", "pct_tier_reduced")}, {_pct("tier = 'full'", "pct_tier_full")},
       {_pct("low25 = 1", "pct_low25")}, count(*) - count(dose_per_weight) AS n_missing
FROM der GROUP BY drug, site, place""")
def strata_table(spark, sf):
    return _summary(derived(encounters(spark, sf)), ["drug", "site", "place"], {
        "pct_tier_reduced": F.col("tier") == "reduced",
        "pct_tier_full": F.col("tier") == "full", "pct_low25": F.col("low25") == 1},
        {"n_missing": n_missing("dose_per_weight")}, ["dose"])


@query("histogram_bins", f"""
{ENC}
SELECT drug, CAST(floor(dose_per_weight / 250.0::DOUBLE) AS BIGINT) AS bin, count(*) AS n,
       floor(dose_per_weight / 250.0::DOUBLE) * 250.0::DOUBLE AS bin_start
FROM enc WHERE dose_per_weight IS NOT NULL GROUP BY drug, 2, 4""")
def histogram_bins(spark, sf):
    return B.histogram(encounters(spark, sf), "dose_per_weight", 250.0, ["drug"])


@query("box_stats", f"""
{ENC},
q AS (SELECT drug, place, quantile_cont(dose_per_weight, 0.25) AS q1,
             median(dose_per_weight) AS q2, quantile_cont(dose_per_weight, 0.75) AS q3
      FROM enc GROUP BY drug, place)
SELECT drug, place, round(q1, 9) AS dose_per_weight_q1, round(q2, 9) AS dose_per_weight_median,
       round(q3, 9) AS dose_per_weight_q3,
       round(min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END), 6) AS whisker_low,
       round(max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END), 6) AS whisker_high,
       count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT drug, place, dose_per_weight AS x FROM enc WHERE dose_per_weight IS NOT NULL)
JOIN q USING (drug, place) GROUP BY drug, place, q1, q2, q3""")
def box_stats(spark, sf):
    out = B.box_stats(encounters(spark, sf), "dose_per_weight", ["drug", "place"])
    return _rounded(out, *[c for c, t in out.dtypes if t == "double"])


@query("zscore", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
       round((l_extendedprice - avg(l_extendedprice) OVER ())
             / stddev_samp(l_extendedprice) OVER (), 4) AS price_s,
       round((l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER (), 4)
         AS quantity_s
FROM lineitem""")
def zscore(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    scaled = Q.z_scores(lines, {"l_extendedprice": "price_s", "l_quantity": "quantity_s"})
    return _rounded(scaled.drop("l_quantity"), "price_s", "quantity_s", digits=4)


@query("top_level", """
SELECT l_shipyear AS level, n FROM (
  SELECT year(l_shipdate) AS l_shipyear, count(*) AS n FROM lineitem GROUP BY 1)
ORDER BY n DESC, level LIMIT 1""")
def top_level(spark, sf):
    years = table(spark, sf, "lineitem").select(F.year("l_shipdate").cast("long").alias("level"))
    return B.top_level(years, "level")
