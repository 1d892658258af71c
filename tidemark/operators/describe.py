"""Descriptive tables: distributions, shares, bands, ladders, trends, chart rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.measures import n_missing, pct_where
from ..functions.recode import band_within, chain
from ..session import materialise
from .ranking import QUARTILES, quantile_columns, quantiles, ranked

# Probability and rule of the statistics in the stacked tables.
STACKED = {"median": (0.5, "linear"), "p25": (0.25, "nearest"), "p75": (0.75, "nearest")}


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Equi-join in which a missing key matches a missing key; keys come from the left.

    Without keys the right side must be one row of totals.
    """
    if not keys:
        for c in right.columns:
            left = left.withColumn(c, right.select(c).scalar())
        return left
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def stacked_stats(df: DataFrame, metrics: Sequence[str], groupings: Mapping[str, Column],
                  overall: str = "overall", overall_value: str = "all") -> DataFrame:
    """Long table ``group_by, group_value, metric, n, median, mean, p25, p75, min, max``.

    One block over everything and one per grouping; rows with a missing metric or a missing
    group are left out of the block. The input is computed once and its measured columns are written.
    """
    df = materialise(df.select(*[F.col(m).cast("double").alias(m) for m in metrics],
                               *[value.cast("string").alias(f"_g{i}") for i, value in enumerate(groupings.values())]), "measured")
    kinds = [F.struct(F.lit(overall).alias("group_by"), F.lit(overall_value).alias("group_value"))]
    kinds += [F.struct(F.lit(name).alias("group_by"), F.col(f"_g{i}").alias("group_value"))
              for i, name in enumerate(groupings)]
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("x")) for m in metrics]
    long = (df.select(F.explode(F.array(*kinds)).alias("g"), F.array(*cells).alias("cells"))
            .select("g.*", F.explode("cells").alias("c")).select("group_by", "group_value", "c.*")
            .where(F.col("x").isNotNull() & F.col("group_value").isNotNull()))
    keys = ["group_by", "group_value", "metric"]
    basic = long.groupBy(*keys).agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.min("x").alias("min"),
        F.max("x").alias("max"))
    spread = quantile_columns(long, ["x"], keys, STACKED, written=True)
    return (basic.join(spread, keys)
            .select(*keys, "n", F.col("x_median").alias("median"), "mean",
                    F.col("x_p25").alias("p25"), F.col("x_p75").alias("p75"), "min", "max"))


def pair_timing_stats(pairs: DataFrame, gap: str, first: str, second: str) -> DataFrame:
    """Gap distribution over all pairs and per pair of categories."""
    both = F.concat(F.col(first), F.lit(" + "), F.col(second))
    stats = stacked_stats(pairs, [gap], {"pair": both}, "overall", "Overall")
    return stats.select(F.col("group_value").alias("group"), F.col("n").alias("count"),
                        "median", "mean", "p25", "p75", "min", "max")


def group_summary(df: DataFrame, group: Sequence[str], value: str,
                  percentages: Mapping[str, Column] | None = None,
                  others: Mapping[str, Column] | None = None,
                  prefix: str | None = None, more_values: Sequence[str] = ()) -> DataFrame:
    """Per group: ``n``, median, quartiles, mean and sd of a value, percentages of predicates.

    ``others`` adds further aggregates, ``more_values`` quartiles of further columns. ``df`` is read three
    times, so it should be a table or little more.
    """
    prefix = prefix or value
    basic = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias(f"{prefix}_mean"),
        F.stddev_samp(value).alias(f"{prefix}_sd"),
        *[pct_where(c).alias(name) for name, c in (percentages or {}).items()],
        *[c.alias(name) for name, c in (others or {}).items()])
    spread = quantile_columns(df, [value, *more_values], group, QUARTILES, written=True)
    if prefix != value:
        for q in QUARTILES:
            spread = spread.withColumnRenamed(f"{value}_{q}", f"{prefix}_{q}")
    return join_null_safe(basic, spread, list(group))


def to_statistic_rows(wide: DataFrame, by: str, levels: Sequence[str]) -> DataFrame:
    """Statistics as rows and the levels of ``by`` as columns."""
    names = [c for c in wide.columns if c != by]
    long = wide.select(by, F.explode(F.array(*[
        F.struct(F.lit(n).alias("statistic"), F.col(n).cast("double").alias("value"))
        for n in names])).alias("s")).select(by, "s.*")
    return long.groupBy("statistic").pivot(by, list(levels)).agg(F.first("value"))


def table_one(df: DataFrame, by: str, levels: Sequence[str], numeric: Sequence[str],
              percentages: Mapping[str, Column]) -> DataFrame:
    """Group sizes, medians with quartiles and percentages, one column per group."""
    basic = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[
        pct_where(c).alias(name) for name, c in percentages.items()])
    spread = quantile_columns(df, numeric, [by], QUARTILES)
    return to_statistic_rows(join_null_safe(basic, spread, [by]), by, levels)


def missing_by_group(df: DataFrame, by: str, levels: Sequence[str],
                     variables: Sequence[str], digits: int = 1) -> DataFrame:
    """Missing counts and percentages per variable, one column per group."""
    wide = df.groupBy(by).agg(*[c for v in variables for c in (
        n_missing(v).alias(f"{v}_n_miss"),
        F.round(F.avg(F.col(v).isNull().cast("double")) * 100, digits).alias(f"{v}_pct_miss"))])
    return to_statistic_rows(wide, by, levels)


def shares(df: DataFrame, by: Sequence[str], within: Sequence[str] = (),
           digits: int | None = None, total: str | None = None) -> DataFrame:
    """Counts per ``by`` with their percentage of the total of ``within``.

    The totals are summed from the counts and joined back, so no task holds a whole total.
    """
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    sums = counts.groupBy(*within).agg(F.sum("n").alias("_total"))
    out = join_null_safe(counts, sums, list(within))
    pct = F.col("n") / F.col("_total") * 100
    out = out.withColumn("pct", F.round(pct, digits) if digits is not None else pct)
    return out.withColumnRenamed("_total", total) if total else out.drop("_total")


def percentile_ladder(df: DataFrame, value: str, group: Sequence[str], strata: str,
                      percents: Sequence[int], name: str = "percentile",
                      overall: str = "All") -> DataFrame:
    """Quantiles at a list of percents per group and stratum, and over all strata."""
    rows = materialise(df.select(*group, value, strata), "values")
    both = rows.select(*group, value, F.explode(
        F.array(F.lit(overall), F.col(strata).cast("string"))).alias(strata))
    found = quantiles(both, value, [(p / 100, "linear") for p in percents], [*group, strata], written=True)
    percent = F.round(F.col("prob") * 100).cast("int")
    return found.select(*group, strata, percent.alias(name), "quantile")


def level_counts(df: DataFrame, group: str, level: str,
                 levels: Mapping[str, Sequence[str]], digits: int | None = None) -> DataFrame:
    """Counts and group percentages of every listed level, also those that never occur.

    ``levels`` lists the levels of each group. Values outside the list are not counted.
    """
    spark = df.sparkSession
    listed = spark.createDataFrame(
        [(g, name, i) for g, names in levels.items() for i, name in enumerate(names)],
        f"{group} string, {level} string, level_no int")
    counts = df.groupBy(group, level).agg(F.count(F.lit(1)).alias("_n"))
    full = (listed.join(counts, [group, level], "left")
            .withColumn("n", F.coalesce("_n", F.lit(0).cast("bigint"))).drop("_n"))
    sums = full.groupBy(group).agg(F.sum("n").alias("_total"))
    pct = F.try_divide(F.col("n") * 100.0, F.col("_total"))
    return (full.join(sums, group)
            .withColumn("pct", F.round(pct, digits) if digits is not None else pct)
            .drop("_total"))


def band_counts(df: DataFrame, group: str, value: str,
                bands: Mapping[str, tuple[Sequence[float], Sequence[str]]],
                digits: int | None = 1, label: str = "band") -> DataFrame:
    """Counts per half-open band of a value, with the bands chosen by the group."""
    banded = (df.where(F.col(value).isNotNull())
              .withColumn(label, band_within(value, group, bands)))
    return level_counts(banded, group, label, {g: names for g, (_, names) in bands.items()},
                        digits)


def cross_tab(df: DataFrame, row: str, column: str, columns: Sequence[str],
              missing: str = "Unknown") -> DataFrame:
    """Counts and row percentages by row and column value, missing ones as their own level."""
    names = [*columns, missing]
    named = df.select(F.coalesce(F.col(row).cast("string"), F.lit(missing)).alias(row),
                      F.coalesce(F.col(column).cast("string"), F.lit(missing)).alias(column))
    counts = named.groupBy(row).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(column) == c).alias(f"n_{c}") for c in names])
    return counts.select(row, *[f"n_{c}" for c in names], "total", *[
        F.round(F.col(f"n_{c}") / F.col("total") * 100, 1).alias(f"pct_{c}") for c in names])


def provider_summary(df: DataFrame, provider: str, category: str, value: str, min_n: int,
                     percentages: Mapping[str, Column]) -> DataFrame:
    """Group summary per provider and category for providers with at least ``min_n`` rows.

    The provider is replaced by its rank by median inside the category.
    """
    summary = group_summary(df, [provider, category], value, percentages, prefix="value")
    large = summary.where(F.col("n") >= min_n)
    return (ranked(large, ["value_median", provider], [category], "provider_rank")
            .drop(provider))


def preference_share(df: DataFrame, provider: str, chosen: Column, min_n: int,
                     high: float = 75.0, low: float = 25.0,
                     labels: Sequence[str] = ("mostly_other", "mixed", "mostly_chosen"),
                     digits: int = 1) -> DataFrame:
    """Share of a choice per provider, ranked from least to most, with a three-way label."""
    counts = (df.groupBy(provider)
              .agg(F.count(F.lit(1)).alias("n"), F.count_if(chosen).alias("n_chosen"))
              .withColumn("n_other", F.col("n") - F.col("n_chosen"))
              .withColumn("pct_chosen", F.round(F.col("n_chosen") / F.col("n") * 100, digits))
              .where(F.col("n") >= min_n))
    label = chain([(F.col("pct_chosen") >= high, labels[2]),
                   (F.col("pct_chosen") <= low, labels[0])], labels[1])
    return (ranked(counts, ["pct_chosen", provider], (), "provider_rank")
            .withColumn("predominant", label).drop(provider))


def histogram(df: DataFrame, value: str, width: float, group: Sequence[str] = (),
              start: float = 0.0, stop: float | None = None) -> DataFrame:
    """Counts per bin ``[start + i*width, start + (i+1)*width)``.

    With ``stop`` only values in ``[start, stop]`` count and the last bin is closed.
    """
    x = F.col(value)
    kept = df.where(x.isNotNull())
    place = F.floor((x - F.lit(start)) / F.lit(width)).cast("bigint")
    if stop is not None:
        kept = kept.where((x >= start) & (x <= stop))
        place = F.least(place, F.lit(round((stop - start) / width) - 1).cast("bigint"))
    return (kept.groupBy(*group, place.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("bin_start", F.lit(start) + F.col("bin") * F.lit(width)))


def box_stats(df: DataFrame, value: str, group: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 quartile ranges, and outlier count."""
    spread = quantile_columns(df, [value], group, QUARTILES)
    q1, q3 = F.col(f"{value}_q1"), F.col(f"{value}_q3")
    reach = (q3 - q1) * 1.5
    rows = join_null_safe(df.where(F.col(value).isNotNull()).select(*group, value), spread,
                          list(group))
    inside = (F.col(value) >= q1 - reach) & (F.col(value) <= q3 + reach)
    return rows.groupBy(*group, f"{value}_q1", f"{value}_median", f"{value}_q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))


def count_matrix(df: DataFrame, row: Column, columns: str, values: Sequence[str],
                 name: str = "pair") -> DataFrame:
    """Counts with the values of one column spread to columns, zero where none."""
    return (df.groupBy(row.alias(name)).pivot(columns, list(values))
            .agg(F.count(F.lit(1))).na.fill(0))


def top_level(df: DataFrame, level: str) -> DataFrame:
    """The most frequent level, ties by name."""
    return (df.groupBy(level).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), level).limit(1))
