"""Joins along time: windows, intervals, nearest values, nearest partners, history.

Every join here has two equi keys, the entity and a second one (a time slot or a salt), so
an entity that owns a large part of the events is spread over many tasks, and the partial
aggregation above it runs before rows are brought together by entity.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.elapsed import elapsed, seconds_between, time_slot
from .ranking import running_max

HEAVY_ROWS, HEAVY_SHARE = 100_000, 1000
TRACKED, MERGED = 8192, 64  # counters of a sketch, and tasks that merge sketches first


def heavy_keys(events: DataFrame, key: Column) -> DataFrame:
    """(_heavy, _salts): keys with over 100,000 rows and over a thousandth of all rows, by their hash.

    Frequencies come from mergeable sketches of bounded size, one row for each task and then for each of ``MERGED`` tasks, so
    no key is shuffled. A count is off by less than a thousandth of all rows, which changes the number of salts only.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(MERGED)).alias("_part")
    sketches = events.select(key.alias("_key"), part).groupBy("_part").agg(
        F.expr(f"approx_top_k_accumulate(_key, {TRACKED})").alias("_sketch"), F.count(F.lit(1)).alias("_rows"))
    whole = sketches.agg(F.expr(f"approx_top_k_combine(_sketch, {TRACKED})").alias("_sketch"), F.sum("_rows").alias("_rows"))
    share = F.greatest(F.col("_rows") / HEAVY_SHARE, F.lit(HEAVY_ROWS))
    return (whole.where("_rows > 0").select(F.inline(F.expr(f"approx_top_k_estimate(_sketch, {HEAVY_SHARE})")), share.alias("_share"))
            .select(F.col("item").alias("_heavy"), F.ceil(F.col("count") / F.col("_share")).cast("int").alias("_salts"))
            .where("_salts > 1"))


def spread_join(index: DataFrame, events: DataFrame, key: Sequence[str] | str,
                salt_on: Sequence[str]) -> DataFrame:
    """Inner equi-join of a small and a large side; heavy keys of the large side are salted.

    There are at most a thousand heavy keys, and they may be broadcast. A key gets as many salts as it has
    shares of a thousandth; its index rows are repeated for each, all others stay single.
    """
    keys = [key] if isinstance(key, str) else list(key)
    heavy = F.broadcast(heavy_keys(events, F.xxhash64(*keys)))
    salts = F.coalesce("_salts", F.lit(1))

    def with_salts(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_heavy", F.xxhash64(*keys)).join(heavy, "_heavy", "left").drop("_heavy")

    few = (with_salts(index)
           .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts"))
    many = (with_salts(events)
            .withColumn("_salt", F.pmod(F.xxhash64(*salt_on), salts).cast("int")).drop("_salts"))
    return few.join(many, [*keys, "_salt"]).drop("_salt")


def window_join(index: DataFrame, events: DataFrame, key: str, index_time: str,
                event_time: str, lo: float, hi: float, bounds: str = "[]",
                gap: str = "gap_seconds", slot_width: float | None = None) -> DataFrame:
    """Events of the same entity with ``lo <= event - index <= hi`` seconds.

    ``bounds`` marks each end as closed or open, e.g. ``"[)"``. The gap is in whole seconds
    cut toward zero. ``slot_width`` is the width of the time slots used as second join key
    (default: the width of the window).
    """
    width = slot_width or max(hi - lo, 1.0)
    # Whole-second gaps can belong to instants up to a second outside the window.
    first = time_slot(F.col(index_time) + F.make_dt_interval(secs=F.lit(lo - 1)), width)
    last = time_slot(F.col(index_time) + F.make_dt_interval(secs=F.lit(hi + 1)), width)
    few = index.withColumn("_slot", F.explode(F.sequence(first, last)))
    many = events.withColumn("_slot", time_slot(event_time, width))
    seconds = seconds_between(index_time, event_time)
    above = seconds >= lo if bounds[0] == "[" else seconds > lo
    below = seconds <= hi if bounds[1] == "]" else seconds < hi
    return (few.join(many, [key, "_slot"]).drop("_slot")
            .withColumn(gap, seconds).where(above & below))


def point_in_interval(index: DataFrame, stays: DataFrame, key: str, at: str, start: str,
                      end: str, open_end: bool = False) -> DataFrame:
    """Stays with ``start <= at < end``. Open stays count only with ``open_end``."""
    before_end = F.col(at) < F.col(end)
    if open_end:
        before_end = before_end | F.col(end).isNull()
    return (spread_join(index, stays, key, [start])
            .where((F.col(at) >= F.col(start)) & before_end))


def first_per(df: DataFrame, key: Sequence[str] | str, order: Sequence[Column | str],
              keep: Sequence[str], last: bool = False) -> DataFrame:
    """First (or last) row per key by a total order, as one partial aggregation.

    ``keep`` columns are compared after ``order`` to settle ties.
    """
    keys = [key] if isinstance(key, str) else list(key)
    picks = [F.col(o).alias(f"_o{i}") if isinstance(o, str) else o.alias(f"_o{i}")
             for i, o in enumerate(order)]
    record = F.struct(*picks, *[F.col(c) for c in keep])
    chosen = F.max(record) if last else F.min(record)
    return (df.groupBy(*keys).agg(chosen.alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in keep]))


def around(index: DataFrame, events: DataFrame, key: str, index_time: str, event_time: str,
           value: str, max_gap_hours: float | None = None,
           strictly_before: bool = False) -> DataFrame:
    """Nearest value at or before, and first value after, the index time of each entity.

    One row per entity with at least one of them: ``key, before_time, before_value,
    after_time, after_value``. Both sides come from one join and one aggregation. Values at
    the same instant are settled by the larger value before and the smaller one after.
    """
    joined = spread_join(index.select(key, index_time),
                         events.select(key, event_time, value), key, [event_time])
    t, at = F.col(event_time), F.col(index_time)
    is_before = t < at if strictly_before else t <= at
    is_after = t > at
    if max_gap_hours is not None:
        is_before = is_before & (elapsed(event_time, index_time) <= max_gap_hours)
        is_after = is_after & (elapsed(index_time, event_time) <= max_gap_hours)
    pick = F.struct(t.alias("t"), F.col(value).alias("v"))
    return (joined.groupBy(key)
            .agg(F.max(F.when(is_before, pick)).alias("b"),
                 F.min(F.when(is_after, pick)).alias("a"))
            .where(F.col("b").isNotNull() | F.col("a").isNotNull())
            .select(key, F.col("b.t").alias("before_time"), F.col("b.v").alias("before_value"),
                    F.col("a.t").alias("after_time"), F.col("a.v").alias("after_value")))


def from_history(index: DataFrame, entities: DataFrame, events: DataFrame, key: str,
                 owner: str, entity_time: str, index_time: str, event_time: str, value: str,
                 max_lookback_days: float | None = None,
                 strictly_before: bool = False) -> DataFrame:
    """Latest value before the index from earlier entities of the same owner.

    ``entities`` lists (key, owner, entity_time). Only entities that began before the
    index's own entity count, optionally within ``max_lookback_days`` of it.

    Values taken before the own entity began come from one running maximum per owner over
    all owners' values in time order, without pairing entities. Two cases remain and are
    joined exactly: values of an earlier entity taken while the own one already ran, and
    entities whose running maximum belongs to one too old for the look-back.

    Returns ``key, before_time, before_value``.
    """
    dims = entities.select(key, owner, entity_time)
    # only the owners of asked entities take part
    owners = index.select(key).join(dims, key).select(owner).distinct()
    dims = dims.join(owners, owner, "left_semi").select(key, owner, entity_time)
    asked = (index.select(key, index_time).join(dims, key)
             .select(key, owner, F.col(entity_time).alias("_own"),
                     F.col(index_time).alias("_at")))
    values = (events.select(key, event_time, value).join(dims, key)
              .select(F.col(owner).alias("_owner"), F.col(event_time).alias("_t"),
                      F.col(value).alias("_v"), F.col(entity_time).alias("_began")))
    in_time = F.col("_t") < F.col("_at") if strictly_before else F.col("_t") <= F.col("_at")
    recent = F.lit(True) if max_lookback_days is None else (
        seconds_between("_began", "_own") <= max_lookback_days * 86400)
    record = F.struct("_t", "_v", "_began")

    # A value counts from the later of its own time and the start of its entity onward.
    known = values.select(
        F.col("_owner"), F.greatest("_t", "_began").alias("_from"), F.lit(1).alias("_is_value"),
        record.alias("_record"), F.lit(None).cast(asked.schema[key].dataType).alias(key),
        F.lit(None).cast("timestamp_ntz").alias("_own"),
        F.lit(None).cast("timestamp_ntz").alias("_at"))
    asking = asked.select(
        F.col(owner).alias("_owner"), F.col("_own").alias("_from"), F.lit(0).alias("_is_value"),
        F.lit(None).cast(known.schema["_record"].dataType).alias("_record"), key, "_own", "_at")
    swept = (running_max(known.unionByName(asking), ["_from", "_is_value"], "_record",
                         ["_owner"], "_best")
             .where(F.col("_is_value") == 0)
             .select("_owner", key, "_own", "_at",
                     F.col("_best._t").alias("_t"), F.col("_best._v").alias("_v"),
                     F.col("_best._began").alias("_began")))
    usable = F.col("_t").isNotNull() & in_time & recent
    before_start = swept.where(usable).select(key, "_t", "_v")

    day = 86400.0
    late = (asked.where(F.col("_at") >= F.col("_own")).withColumnRenamed(owner, "_owner")
            .withColumn("_slot", F.explode(F.sequence(time_slot("_own", day),
                                                      time_slot("_at", day)))))
    during = (late.join(values.withColumn("_slot", time_slot("_t", day)), ["_owner", "_slot"])
              .where((F.col("_began") < F.col("_own")) & (F.col("_t") >= F.col("_own"))
                     & in_time & recent)
              .select(key, "_t", "_v"))
    open_cases = (swept.where(F.col("_t").isNotNull() & ~usable)
                  .select("_owner", key, "_own", "_at"))
    rest = (spread_join(open_cases, values, "_owner", ["_t"])
            .where((F.col("_began") < F.col("_own")) & in_time & recent)
            .select(key, "_t", "_v"))
    found = before_start.unionByName(during).unionByName(rest)
    return (found.groupBy(key).agg(F.max(F.struct("_t", "_v")).alias("b"))
            .select(key, F.col("b._t").alias("before_time"), F.col("b._v").alias("before_value")))


def nearest_measurement(index: DataFrame, events: DataFrame, key: str, index_time: str,
                        event_time: str, value: str, labels: Mapping[str, str],
                        history: DataFrame | None = None) -> DataFrame:
    """Value at or before the index, else from ``history``, else null, with its source.

    ``history`` is the result of ``from_history``. ``labels`` names the three sources
    ``current``, ``history`` and ``none``. Adds ``value, value_time, value_source,
    value_gap_hours`` and, for the first later value, ``post_value, post_time,
    post_gap_hours``.
    """
    near = around(index, events, key, index_time, event_time, value)
    out = index.join(near, key, "left")
    if history is not None:
        old = history.select(key, F.col("before_time").alias("_ht"),
                             F.col("before_value").alias("_hv"))
        out = out.join(old, key, "left")
    else:
        out = (out.withColumn("_ht", F.lit(None).cast("timestamp_ntz"))
               .withColumn("_hv", F.lit(None).cast("double")))
    current, past = F.col("before_time").isNotNull(), F.col("_ht").isNotNull()
    return (
        out.withColumn("value", F.when(current, F.col("before_value"))
                       .when(past, F.col("_hv")))
        .withColumn("value_time", F.when(current, F.col("before_time")).when(past, F.col("_ht")))
        .withColumn("value_source", F.when(current, F.lit(labels["current"]))
                    .when(past, F.lit(labels["history"])).otherwise(F.lit(labels["none"])))
        .withColumn("value_gap_hours", elapsed("value_time", index_time))
        .withColumnRenamed("after_value", "post_value")
        .withColumnRenamed("after_time", "post_time")
        .withColumn("post_gap_hours", elapsed(index_time, "post_time"))
        .drop("before_time", "before_value", "_ht", "_hv"))


def nearest_partners(events: DataFrame, key: str, time: str, category: str,
                     a_categories: Sequence[str], b_categories: Sequence[str],
                     max_gap_minutes: float, carry: Sequence[str] = ()) -> DataFrame:
    """For each instant with an A or a B event, its nearest partner of the other kind at or
    after it, no further than ``max_gap_minutes``.

    Any pair within the gap has an earlier member, and the first pair of an entity is formed
    by the earliest such member with its nearest partner, so these rows are all a first-pair
    search needs; their number grows with the events and not with the pairs. Events at one
    instant are first reduced to the least (category, carry...) per kind.

    Columns: ``key, index_time, gap_minutes, a_time, b_time, a_category, b_category`` and
    ``a_/b_`` versions of ``carry``.
    """
    kind = (F.when(F.col(category).isin(list(a_categories)), F.lit("a"))
            .when(F.col(category).isin(list(b_categories)), F.lit("b")))
    width = max_gap_minutes * 60 + 1
    record = F.struct(F.col(category).alias("c"), *[F.col(c) for c in carry])
    instants = (events.withColumn("_kind", kind).where(F.col("_kind").isNotNull())
                .groupBy(key, F.col(time).alias("_t"))
                .agg(F.min(F.when(F.col("_kind") == "a", record)).alias("_a"),
                     F.min(F.when(F.col("_kind") == "b", record)).alias("_b")))
    # A partner lies in the slot of its earlier member or in the next slot, so each instant
    # is looked up from its own slot and offered to the slot before it.
    placed = (instants.withColumn("_own", time_slot("_t", width))
              .withColumn("_slot", F.explode(F.array(F.col("_own"), F.col("_own") - 1))))
    ahead = (W.partitionBy(key, "_slot").orderBy(F.col("_t").desc())
             .rowsBetween(W.unboundedPreceding, 0))
    own = F.struct(F.col("_t").alias("t"), F.col("_a").alias("r"))
    other = F.struct(F.col("_t").alias("t"), F.col("_b").alias("r"))
    looked = (placed
              .withColumn("_next_a", F.last(F.when(F.col("_a").isNotNull(), own), True)
                          .over(ahead))
              .withColumn("_next_b", F.last(F.when(F.col("_b").isNotNull(), other), True)
                          .over(ahead))
              .where(F.col("_slot") == F.col("_own")))
    here = F.col("_t")
    pairs = F.array(
        F.when(F.col("_a").isNotNull() & F.col("_next_b").isNotNull(), F.struct(
            here.alias("at"), F.col("_a").alias("ar"),
            F.col("_next_b.t").alias("bt"), F.col("_next_b.r").alias("br"))),
        F.when(F.col("_b").isNotNull() & F.col("_next_a").isNotNull(), F.struct(
            F.col("_next_a.t").alias("at"), F.col("_next_a.r").alias("ar"),
            here.alias("bt"), F.col("_b").alias("br"))))
    gap = F.abs(seconds_between("p.at", "p.bt")) / F.lit(60.0)
    return (looked.select(key, F.explode(F.filter(pairs, lambda p: p.isNotNull())).alias("p"))
            .select(key, F.least("p.at", "p.bt").alias("index_time"),
                    gap.alias("gap_minutes"), F.col("p.at").alias("a_time"),
                    F.col("p.bt").alias("b_time"), F.col("p.ar.c").alias("a_category"),
                    F.col("p.br.c").alias("b_category"),
                    *[F.col(f"p.ar.{c}").alias(f"a_{c}") for c in carry],
                    *[F.col(f"p.br.{c}").alias(f"b_{c}") for c in carry])
            .where(F.col("gap_minutes") <= max_gap_minutes).distinct())
