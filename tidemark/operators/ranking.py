"""Ranks and exact quantiles that never bring a whole group into one task.

Rows are sorted once over the whole cluster by (group, value), numbered in that order and
cut into slices of consecutive rows. Each slice knows how many rows of a group lie in the
slices before it, so a rank is slice offset plus position inside the slice. A group holding
most of the rows spreads over many slices. For a quantile rows are first counted in bins of nearly the
same value, and only the bins it falls into are sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import materialise

_SLICE, _WEIGHT, _BEFORE, _ROW, _BLOCK = "_slice", "_weight", "_before", "_row_no", "_block"
SLICE_BITS = 12
BLOCK_BITS = 12  # slices of one block, for sums over slices
_BIN = "_bin"
BINS = 256  # of values from a power of e to the next


def _ordering(names: Sequence[str]) -> list[Column]:
    return [F.col(n[1:]).desc() if n.startswith("-") else F.col(n).asc() for n in names]


def _sliced(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Sorted copy of ``df`` with a growing row number and the slice of 4096 rows it is in.

    The number is drawn above the sort in the task that writes the row, so it counts the
    sorted rows of the range partition (low bits) after those of earlier ranges (high bits).
    """
    keys = [F.col(g) for g in group] + _ordering(order)
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialise(
        sorted_rows.withColumn(_ROW, F.monotonically_increasing_id())
        .withColumn(_SLICE, F.shiftright(_ROW, SLICE_BITS)), "sorted")


def _within(group: Sequence[str], order: Sequence[str]):
    return (W.partitionBy(_SLICE, *group).orderBy(*_ordering(order))
            .rowsBetween(W.unboundedPreceding, 0))


def _before_slices(sizes: DataFrame, group: Sequence[str], value: str, name: str,
                   add: Callable, total: str | None = None) -> DataFrame:
    """``sizes`` with ``name``: ``value`` combined by ``add`` over the group's earlier slices.

    Two levels: within blocks of 4096 slices, and over one row per block (16 million rows), so
    that no window holds all slices of a large group. ``total`` names the whole group's value.
    """
    blocked = sizes.withColumn(_BLOCK, F.shiftright(_SLICE, BLOCK_BITS))
    blocks = blocked.groupBy(*group, _BLOCK).agg(add(value).alias("_of_block"))
    per_group = W.partitionBy(*group) if group else W.partitionBy(F.lit(1))
    earlier = per_group.orderBy(_BLOCK).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(*group, _BLOCK, add("_of_block").over(earlier).alias("_blocks_before"),
                           *([add("_of_block").over(per_group).alias(total)] if total else []))
    inside = (W.partitionBy(*group, _BLOCK).orderBy(_SLICE)
              .rowsBetween(W.unboundedPreceding, -1))
    within = blocked.withColumn("_slices_before", add(value).over(inside))
    out = _join(within, blocks, group, _BLOCK)
    if add is F.sum:
        both = F.coalesce("_blocks_before", F.lit(0)) + F.coalesce("_slices_before", F.lit(0))
    else:
        both = F.greatest("_blocks_before", "_slices_before")
    return out.withColumn(name, both).drop("_blocks_before", "_slices_before", _BLOCK)


def _offsets(sliced: DataFrame, group: Sequence[str], size: Column) -> DataFrame:
    """Per (group, slice): first row number, weight of the group before it, and in total."""
    sizes = sliced.groupBy(*group, _SLICE).agg(size.alias("_size"),
                                               F.min(_ROW).alias("_first"))
    return _before_slices(sizes, group, "_size", _BEFORE, F.sum, "_total")


def _join(rows: DataFrame, facts: DataFrame, group: Sequence[str],
          part: str = _SLICE) -> DataFrame:
    """Rows with the facts of their (group, part); a missing group value is a value."""
    keys = [part, *group]
    named = facts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                         *[c for c in facts.columns if c not in keys])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(named, same).drop(*[f"_k{i}" for i in range(len(keys))])


def ranked(df: DataFrame, order: Sequence[str], group: Sequence[str] = (),
           rank: str = "rank_no", weight: Column | None = None) -> DataFrame:
    """Row number (from 1) of each row in its group by ``order`` (``-name`` = descending).

    With ``weight`` it is the sum of the weights up to and including the row. Add columns to
    ``order`` until it is total; equal rows are numbered arbitrarily.
    """
    group = list(group)
    if weight is None:
        sliced = _sliced(df, group, order)
        offsets = _offsets(sliced, group, F.count(F.lit(1)))
        place = F.col(_BEFORE) + F.col(_ROW) - F.col("_first") + 1
    else:
        sliced = _sliced(df.withColumn(_WEIGHT, weight.cast("bigint")), group, order)
        offsets = _offsets(sliced, group, F.sum(_WEIGHT))
        sliced = sliced.withColumn("_pos", F.sum(_WEIGHT).over(_within(group, [_ROW])))
        place = F.col(_BEFORE) + F.col("_pos")
    return _join(sliced, offsets, group).select(*df.columns, place.cast("bigint").alias(rank))


def running_max(df: DataFrame, order: Sequence[str], value: str, group: Sequence[str],
                name: str = "so_far") -> DataFrame:
    """Largest ``value`` among the rows of the group up to and including each row."""
    sliced = _sliced(df, group, order)
    most = sliced.groupBy(*group, _SLICE).agg(F.max(value).alias("_most"))
    carried = _before_slices(most, group, "_most", "_carry", F.max).drop("_most")
    seen = sliced.withColumn("_here", F.max(value).over(_within(group, [_ROW])))
    return _join(seen, carried, group).select(
        *df.columns, F.greatest("_here", "_carry").alias(name))


def _bin_of(value: Column) -> Column:
    """A whole number that grows with the value; values of nearly the same size share one."""
    x = value.cast("double")
    size = F.floor((F.log(F.abs(x)) + 750) * BINS)  # the smallest double is above e^-750; infinity is cut to a long
    return F.when(F.isnan(x), F.lit(2**63 - 1)).when(x == 0, F.lit(0)).when(x > 0, size).otherwise(-size)


def quantiles(df: DataFrame, value: str, probs: Sequence[tuple[float, str]],
              group: Sequence[str] = (), written: bool = False) -> DataFrame:
    """Exact quantiles per group: columns ``group..., prob, rule, quantile, n_values``.

    ``probs`` holds (probability, rule) with rule ``linear`` (interpolate between the two
    neighbouring order statistics) or ``nearest`` (the value at the rounded position,
    halves upward). Missing values are left out.

    Values are counted by group and bin first; only those of a bin with a wanted order statistic are
    shuffled and sorted. ``df`` is read twice and written before, unless it comes from a ``written`` table.
    """
    group, own = list(group), [*group, _BIN]
    values = df.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("_value"))
    binned = (values if written else materialise(values, "values")).withColumn(_BIN, _bin_of(F.col("_value")))
    sizes = materialise(binned.groupBy(*own).agg(F.count(F.lit(1)).alias("_size")), "bins")
    per_group = W.partitionBy(*group) if group else W.partitionBy(F.lit(1))  # its bins: their number has a bound
    earlier = per_group.orderBy(_BIN).rowsBetween(W.unboundedPreceding, -1)
    bins = sizes.select("*", F.sum("_size").over(per_group).alias("_total"),
                        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias(_BEFORE))

    # Which order statistics each probability needs; positions count from 0. Only the bins and then
    # the slices that hold one of them go on.
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.lit(r).alias("rule"))
                       for p, r in probs])
    is_linear = F.col("rule") == "linear"
    place = (F.col("_total") - 1) * F.col("prob")
    asked = (
        bins.select("*", F.inline(wanted)).withColumn("_place", place)
        .withColumn("_low", F.when(is_linear, F.floor("_place"))
                    .otherwise(F.floor(F.col("_place") + 0.5)).cast("bigint"))
        .withColumn("_high", F.when(is_linear, F.ceil("_place")).otherwise(F.col("_low"))
                    .cast("bigint")))
    holds = lambda at: ((F.col(at) >= F.col(_BEFORE))
                        & (F.col(at) < F.col(_BEFORE) + F.col("_size")))
    held = lambda parts, *keys: parts.where(holds("_low") | holds("_high")).groupBy(*keys).agg(
        F.first(_BEFORE).alias(_BEFORE), F.first("_total").alias("_total"),
        F.collect_list(F.struct("prob", "rule", "_place", "_low", "_high")).alias("_asked"))
    of_bin = materialise(held(asked, *own).withColumnRenamed(_BEFORE, "_bin_before"), "asked")
    name = F.xxhash64(*own).alias("_name")  # one number leaves few rows to the join by group and bin
    near = binned.withColumn("_name", name).join(of_bin.select(name).distinct(), "_name", "left_semi").drop("_name")
    counted = materialise(  # the range partitioning samples this copy, not the input again
        _join(near, of_bin.select(*own), group, _BIN)
        .groupBy(*own, "_value").agg(F.count(F.lit(1)).alias(_WEIGHT)), "counted")
    sliced = _sliced(counted, own, ["_value"])
    offsets = _offsets(sliced, own, F.sum(_WEIGHT)).drop("_total")
    in_slices = (_join(offsets, of_bin, group, _BIN).withColumn(_BEFORE, F.col(_BEFORE) + F.col("_bin_before"))
                 .select(*own, _SLICE, _BEFORE, "_size", "_total", F.inline("_asked")))
    rows = (_join(sliced, held(in_slices, *own, _SLICE), own)
            .withColumn("_end", F.col(_BEFORE) + F.sum(_WEIGHT).over(_within(own, [_ROW]))))
    inside = lambda at: ((at < F.col("_end"))
                         & (at >= F.col("_end") - F.col(_WEIGHT)))
    hits = (rows.withColumn("_asked", F.filter(
        "_asked", lambda a: inside(a["_low"]) | inside(a["_high"])))
        .where(F.size("_asked") > 0)
        .select(*group, "_total", "_value", "_end", _WEIGHT, F.inline("_asked")))
    found = hits.groupBy(*group, "prob", "rule").agg(
        F.max(F.when(inside(F.col("_low")), F.col("_value"))).alias("_a"),
        F.max(F.when(inside(F.col("_high")), F.col("_value"))).alias("_b"),
        F.max("_total").alias("n_values"),
        F.max(F.col("_place") - F.col("_low")).alias("_share"))
    between = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_share")
    return found.select(
        *group, "prob", "rule", F.when(is_linear, between).otherwise(F.col("_a"))
        .alias("quantile"), "n_values")


def quantile_columns(df: DataFrame, values: Sequence[str], group: Sequence[str],
                     names: dict[str, tuple[float, str]], written: bool = False) -> DataFrame:
    """One row per group with ``{value}_{name}`` for every value column and quantile.

    All value columns share the passes over (group, measure, value).
    """
    group = list(group)
    wide = df.select(*group, *[F.col(v).cast("double").alias(f"_of_{v}") for v in values])
    wide = wide if written else materialise(wide, "values")
    long = wide.select(*group, F.explode(F.array(*[
        F.struct(F.lit(v).alias("measure"), F.col(f"_of_{v}").alias("measured"))
        for v in values])).alias("m")).select(*group, "m.measure", "m.measured")
    found = quantiles(long, "measured", list(dict.fromkeys(names.values())),
                      [*group, "measure"], written=True)
    return found.groupBy(*group).agg(*[
        F.max(F.when((F.col("measure") == v) & (F.col("prob") == p) & (F.col("rule") == r),
                     F.col("quantile"))).alias(f"{v}_{name}")
        for v in values for name, (p, r) in names.items()])


QUARTILES = {"median": (0.5, "linear"), "q1": (0.25, "linear"), "q3": (0.75, "linear")}
