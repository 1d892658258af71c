"""Index events, inclusion and exclusion steps, membership rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.recode import flag
from .temporal import first_per, nearest_partners, point_in_interval, window_join


def index_events(events: DataFrame, key: str, time: str, category: str,
                 a_categories: Sequence[str], b_categories: Sequence[str],
                 pair_window: float, keep_window: float, carry: Sequence[str] = (),
                 select: str = "first_then_filter") -> tuple[DataFrame, DataFrame]:
    """(index events, first wide pairs): one row per entity each, windows in minutes.

    With ``first_then_filter`` the first pair within ``pair_window`` is chosen and the entity
    is kept only if that pair is within ``keep_window``. With ``filter_then_first`` the first
    pair within ``keep_window`` is chosen.
    """
    order = ["index_time", "gap_minutes", "a_time", "b_time", "a_category", "b_category"]
    keep = [*order, *[f"{side}_{c}" for c in carry for side in ("a", "b")]]
    near = nearest_partners(events, key, time, category, a_categories, b_categories,
                            pair_window, carry)
    wide = first_per(near, key, order, keep)
    if select == "filter_then_first":
        index = first_per(near.where(F.col("gap_minutes") <= keep_window), key, order, keep)
    else:
        index = wide.where(F.col("gap_minutes") <= keep_window)
    return index, wide


@dataclass(frozen=True)
class Step:
    """One rule of a cohort definition. Rows for which ``keep`` is not true are excluded."""

    description: str
    keep: Column
    reason: str | None = None
    sub_counts: Mapping[str, Column] = field(default_factory=dict)


def inclusion_exclusion(df: DataFrame, steps: Sequence[Step],
                        total: str = "Total") -> tuple[DataFrame, DataFrame]:
    """Rows that pass every step, and the flow table.

    All counts of the flow come from one aggregation over flags of one plan. Sub-counts are
    taken among the rows that entered the step.
    """
    entered: Column = F.lit(True)
    flags, sums, cells = [], [F.count(F.lit(1)).alias("n_0")], []
    for i, step in enumerate(steps, 1):
        flags.append((entered & F.coalesce(step.keep, F.lit(False))).alias(f"_in_{i}"))
        for name, condition in step.sub_counts.items():
            flags.append((entered & F.coalesce(condition, F.lit(False))).alias(f"_{i}_{name}"))
            sums.append(F.count_if(f"_{i}_{name}").alias(f"{name}_{i}"))
        sums.append(F.count_if(f"_in_{i}").alias(f"n_{i}"))
        entered = entered & F.coalesce(step.keep, F.lit(False))
    counts = df.select(*flags).agg(*sums)

    names = sorted({name for step in steps for name in step.sub_counts})
    no_reason = F.lit(None).cast("string")

    def row(i: int, step: Step | None) -> Column:
        excluded = F.lit(0).cast("bigint") if step is None else (
            F.col(f"n_{i - 1}") - F.col(f"n_{i}"))
        extra = [
            (F.col(f"{n}_{i}") if step is not None and n in step.sub_counts
             else F.lit(None).cast("bigint")).alias(n) for n in names]
        return F.struct(
            F.lit(i).alias("step"),
            F.lit(total if step is None else step.description).alias("description"),
            F.col(f"n_{i}").alias("n_remaining"), excluded.alias("n_excluded"),
            (F.lit(step.reason) if step is not None and step.reason else no_reason)
            .alias("exclusion_reason"), *extra)

    cells = [row(0, None), *[row(i, s) for i, s in enumerate(steps, 1)]]
    flow = counts.select(F.inline(F.array(*cells)))
    return df.where(entered), flow


def with_flag(df: DataFrame, ids: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with 1 / 0 for membership of its key in ``ids``."""
    marks = ids.select(key).distinct().withColumn("_hit", F.lit(True))
    return (df.join(marks, key, "left").withColumn(name, flag(F.col("_hit"))).drop("_hit"))


def keep_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def location_at(index: DataFrame, stays: DataFrame, key: str, at: str, start: str, end: str,
                keep: Sequence[str], category: str | None = None,
                categories: Sequence[str] | None = None, open_end: bool = False) -> DataFrame:
    """The stay that holds the index time, one per entity: latest start, then least values."""
    here = point_in_interval(index.select(key, at), stays.select(key, start, end, *keep), key,
                             at, start, end, open_end)
    if categories is not None:
        here = here.where(F.col(category).isin(list(categories)))
    origin = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return first_per(here, key, [origin - F.col(start)], list(keep))


def first_event_within(index: DataFrame, events: DataFrame, key: str, index_time: str,
                       event_time: str, lo: float, hi: float, name: str) -> DataFrame:
    """Time of the first event with ``lo <= event - index <= hi`` seconds, per entity."""
    inside = window_join(index.select(key, index_time), events.select(key, event_time), key,
                         index_time, event_time, lo, hi)
    return inside.groupBy(key).agg(F.min(event_time).alias(name))


@dataclass(frozen=True)
class Source:
    """Events of one kind and the window around an anchor in which they count."""

    events: DataFrame
    event_time: str
    anchor: str
    lo: float
    hi: float
    bounds: str = "[]"


def ids_with_event_within(cohort: DataFrame, key: str, sources: Sequence[Source]) -> DataFrame:
    """Keys with an event inside the window of any source (a union of id sets)."""
    found = None
    for source in sources:
        hits = window_join(cohort.select(key, source.anchor),
                           source.events.select(key, source.event_time), key, source.anchor,
                           source.event_time, source.lo, source.hi, source.bounds).select(key)
        found = hits if found is None else found.unionByName(hits)
    return found.distinct()


def exclude_if_event_within(cohort: DataFrame, key: str,
                            sources: Sequence[Source]) -> DataFrame:
    return drop_ids(cohort, ids_with_event_within(cohort, key, sources), key)


def ids_with_multiple(events: DataFrame, key: str, category: str,
                      among: Sequence[str], more_than: int = 1) -> DataFrame:
    """Keys that received more than ``more_than`` distinct categories of a list."""
    listed = events.where(F.col(category).isin(list(among)))
    return (listed.groupBy(key).agg(F.countDistinct(category).alias("_n"))
            .where(F.col("_n") > more_than).select(key))


def exclude_if_multiple(cohort: DataFrame, events: DataFrame, key: str, category: str,
                        among: Sequence[str]) -> DataFrame:
    return drop_ids(cohort, ids_with_multiple(events, key, category, among), key)
