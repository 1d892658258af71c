"""Data-quality profiles, cohort waterfalls and derived-variable checks."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.measures import n_missing, pct_where
from ..functions.recode import chain
from .cohort import Step, inclusion_exclusion
from .describe import QUARTILES, join_null_safe
from .ranking import quantile_columns, ranked


def missingness(df: DataFrame, variables: Sequence[str],
                expected: Collection[str] = (), digits: int = 1) -> DataFrame:
    """Per variable: rows, missing rows, percentage and a banded flag, from one scan."""
    counts = df.agg(F.count(F.lit(1)).alias("n_total"),
                    *[n_missing(v).alias(v) for v in variables])
    cells = [F.struct(F.lit(v).alias("variable"), F.col(v).alias("n_missing"),
                      F.lit(v in expected).alias("expected_missing")) for v in variables]
    pct = F.col("pct_missing")
    flag = chain([(F.col("expected_missing"), "expected_missing"), (pct == 0, "ok"),
                  (pct <= 5, "low_missing"), (pct <= 20, "moderate_missing")], "high_missing")
    return (counts.select("n_total", F.inline(F.array(*cells)))
            .withColumn("pct_missing", F.round(F.try_divide(F.col("n_missing") * 100.0,
                                                            F.col("n_total")), digits))
            .withColumn("flag", flag)
            .select("variable", "n_total", "n_missing", "pct_missing", "expected_missing",
                    "flag"))


@dataclass(frozen=True)
class RangeRule:
    variable: str
    lo: float
    hi: float
    label: str
    category: str | None = None


def range_checks(df: DataFrame, rules: Sequence[RangeRule], category: str,
                 binary: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """Observed extremes and counts outside each rule's range, all rules in one scan.

    ``binary`` variables are checked for values other than 0, 1 and missing.
    """
    sums, cells = [], []
    for i, rule in enumerate(rules):
        x = F.col(rule.variable).cast("double")
        if rule.category is not None:
            x = F.when(F.col(category) == rule.category, x)
        sums += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.count_if(x < rule.lo).alias(f"below{i}"),
                 F.count_if(x > rule.hi).alias(f"above{i}")]
        cells.append(F.struct(
            F.lit(rule.variable).alias("variable"), F.lit(rule.label).alias("label"),
            F.lit(rule.category or "all").alias("category"),
            F.round(f"lo{i}", digits).alias("min_obs"), F.round(f"hi{i}", digits).alias("max_obs"),
            F.col(f"below{i}").alias("n_below"), F.col(f"above{i}").alias("n_above"),
            (F.col(f"below{i}") + F.col(f"above{i}")).alias("n_flagged")))
    unknown = F.lit(None).cast("bigint")
    for name in binary:
        x = F.col(name).cast("double")
        sums += [F.min(x).alias(f"min_{name}"), F.max(x).alias(f"max_{name}"),
                 F.count_if(~x.isin(0.0, 1.0)).alias(f"bad_{name}")]
        cells.append(F.struct(
            F.lit(name).alias("variable"), F.lit(f"{name}: expect 0/1").alias("label"),
            F.lit("all").alias("category"), F.col(f"min_{name}").alias("min_obs"),
            F.col(f"max_{name}").alias("max_obs"), unknown.alias("n_below"),
            unknown.alias("n_above"), F.col(f"bad_{name}").alias("n_flagged")))
    return (df.agg(*sums).select(F.inline(F.array(*cells)))
            .withColumn("flag", F.when(F.col("n_flagged") > 0, "impossible_value")
                        .otherwise("ok")))


def domain_checks(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per variable: rows whose value is not in its list (missing counts as outside)."""
    counts = df.agg(*[
        F.count_if(~F.coalesce(F.col(v).isin(list(allowed)), F.lit(False))).alias(v)
        for v, allowed in domains.items()])
    cells = [F.struct(F.lit(v).alias("variable"), F.col(v).alias("n_unexpected"))
             for v in domains]
    return (counts.select(F.inline(F.array(*cells)))
            .withColumn("flag", F.when(F.col("n_unexpected") > 0, "unexpected_value")
                        .otherwise("ok")))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    return join_null_safe(df, duplicate_keys(df, keys).drop("n_rows"), keys, "left_semi")


def waterfall(df: DataFrame, steps: Sequence[tuple[str, Column]],
              first: str = "Loaded") -> tuple[DataFrame, DataFrame]:
    """(kept rows, table ``step_no, step, n, n_excluded``)."""
    kept, flow = inclusion_exclusion(df, [Step(label, keep) for label, keep in steps], first)
    return kept, flow.select(F.col("step").alias("step_no"), F.col("description").alias("step"),
                             F.col("n_remaining").alias("n"), "n_excluded")


def volume_by_unit(df: DataFrame, unit: str, complete: Column, threshold: int) -> DataFrame:
    """Rows per unit, split by whether they are complete."""
    return (df.groupBy(unit)
            .agg(F.count_if(complete).alias("n_complete"), F.count(F.lit(1)).alias("n_total"))
            .withColumn("n_incomplete", F.col("n_total") - F.col("n_complete"))
            .withColumn("meets_threshold", F.col("n_complete") >= threshold))


def volume_summary(df: DataFrame, unit: str, complete: Column, threshold: int) -> DataFrame:
    """Units at or above and below a threshold of complete rows, and all units."""
    units = volume_by_unit(df, unit, complete, threshold)
    named = units.withColumn("group", F.explode(F.array(
        F.when(F.col("meets_threshold"), F.lit(f">= {threshold}"))
        .otherwise(F.lit(f"< {threshold}")), F.lit("all"))))
    basic = named.groupBy("group").agg(
        F.count(F.lit(1)).alias("n_units"), F.sum("n_complete").alias("n_complete"),
        F.sum("n_incomplete").alias("n_incomplete"), F.sum("n_total").alias("n_rows"),
        F.max("n_complete").alias("complete_max"))
    spread = quantile_columns(named.withColumnRenamed("n_complete", "complete"), ["complete"],
                              ["group"], QUARTILES)
    size = units.agg(F.count(F.lit(1))).scalar()
    return (basic.join(spread, "group")
            .withColumn("pct_units", F.round(F.col("n_units") / size * 100, 1))
            .withColumn("pct_incomplete",
                        F.round(F.col("n_incomplete") / F.col("n_rows") * 100, 1)))


def volume_chart(units: DataFrame, unit: str) -> DataFrame:
    """Chart rows ``unit_rank, kind, n`` of ``volume_by_unit``, largest unit first."""
    placed = ranked(units, ["-n_total", unit], (), "unit_rank")
    return placed.unpivot(["unit_rank"], ["n_complete", "n_incomplete"], "kind", "n")


@dataclass(frozen=True)
class Consistency:
    """Two conditions that must agree on every row where both are known.

    ``distance`` is how far off a row is; its largest value is reported. ``failed`` is the verdict on a mismatch.
    """

    name: str
    left: Column
    right: Column
    distance: Column | None = None
    failed: str = "MISMATCH"


def derived_checks(df: DataFrame, checks: Sequence[Consistency],
                   by: Sequence[str] = ()) -> DataFrame:
    """Mismatch counts of derived variables with a verdict, all checks in one scan."""
    sums, cells = [], []
    measured = any(check.distance is not None for check in checks)
    for i, check in enumerate(checks):
        sums += [F.count_if(check.left).alias(f"l{i}"), F.count_if(check.right).alias(f"r{i}"),
                 F.count_if(check.left != check.right).alias(f"d{i}")]
        cell = [F.lit(check.name).alias("check_name"), F.col(f"l{i}").alias("n_left"), F.col(f"r{i}").alias("n_right"),
                F.col(f"d{i}").alias("n_mismatch"),
                F.when(F.col(f"d{i}") == 0, "PASS").otherwise(check.failed).alias("verdict")]
        if measured:
            sums.append((F.lit(None).cast("double") if check.distance is None
                         else F.round(F.max(check.distance), 4)).alias(f"m{i}"))
            cell.append(F.col(f"m{i}").alias("max_discrepancy"))
        cells.append(F.struct(*cell))
    return df.groupBy(*by).agg(*sums).select(*by, F.inline(F.array(*cells)))


def collapse_levels(df: DataFrame, level: str, min_n: int, other: str) -> DataFrame:
    """Levels with fewer than ``min_n`` rows become ``other``; an ``other`` that is still
    small is absorbed into the largest level (ties by name)."""
    counts = df.groupBy(level).agg(F.count(F.lit(1)).alias("_n"))
    rare = (F.col("_n") < min_n) | (F.col(level) == other)
    known = F.col(level).isNotNull()
    totals = counts.where(known).agg(F.struct(
        F.sum(F.when(rare, F.col("_n")).otherwise(0)).alias("other_n"),
        F.min(F.when(~rare, F.struct((-F.col("_n")).alias("m"), F.col(level).alias("name"))))
        .alias("largest"))).scalar()
    absorb = (F.col("_all.other_n") < min_n) & F.col("_all.largest").isNotNull()
    target = F.when(~rare, F.col(level)).when(absorb, F.col("_all.largest.name")).otherwise(other)
    mapping = counts.where(known).withColumn("_all", totals).select(level, target.alias("_to"))
    return (df.join(mapping, level, "left").withColumn(level, F.col("_to")).drop("_to")
            .select(*df.columns))


def anonymous_ids(df: DataFrame, column: str, name: str) -> DataFrame:
    """Numbers from 1 for the sorted distinct values of a column."""
    return ranked(df.select(column).where(F.col(column).isNotNull()).distinct(), [column], (),
                  name)


def included_vs_excluded(df: DataFrame, included: Column, numeric: str,
                         percentages: Mapping[str, Column]) -> DataFrame:
    """Size, median of a value and percentages for included and excluded rows."""
    named = df.withColumn("group", F.when(F.coalesce(included, F.lit(False)), "included")
                          .otherwise("excluded"))
    basic = named.groupBy("group").agg(F.count(F.lit(1)).alias("n"), *[
        pct_where(c).alias(n) for n, c in percentages.items()])
    spread = quantile_columns(named, [numeric], ["group"], {"median": (0.5, "linear")})
    return basic.join(spread, "group", "left")


def cohort_summary(df: DataFrame, measures: Mapping[str, Column],
                   constants: Mapping[str, object] | None = None) -> DataFrame:
    """One row of named aggregates and constants."""
    return df.agg(*[c.alias(n) for n, c in measures.items()]).select(
        "*", *[F.lit(v).alias(n) for n, v in (constants or {}).items()])


def z_scores(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``(x - mean) / sd`` for each ``source -> name``; one extra scan for all columns, made at once."""
    stats = df.agg(*[c for x in columns for c in (
        F.avg(x).alias(f"m_{x}"), F.stddev_samp(x).alias(f"s_{x}"))]).first()
    known = lambda name: F.lit(stats[name]) if stats[name] is not None else F.lit(None).cast("double")
    return df.select(*df.columns, *[
        F.try_divide(F.col(x) - known(f"m_{x}"), known(f"s_{x}")).alias(name)
        for x, name in columns.items()])
