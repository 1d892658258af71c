"""Features from look-back windows, stays and outcomes, one row per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.elapsed import elapsed, quarter_of, year_of
from ..functions.recode import flag, matches
from .cohort import location_at
from .temporal import first_per, spread_join, window_join


@dataclass(frozen=True)
class Feature:
    """``kind``: ``max``, ``min`` of a value or ``any`` for existence, over rows where
    ``where`` holds. Missing entities get 0 for ``any`` and null otherwise."""

    name: str
    kind: str
    where: Column
    value: str | None = None

    def over(self, in_window: Column) -> Column:
        condition = self.where & in_window
        if self.kind == "any":
            return F.max(F.coalesce(condition, F.lit(False)).cast("tinyint"))
        picked = F.when(condition, F.col(self.value))
        return F.max(picked) if self.kind == "max" else F.min(picked)


def lookback_features(index: DataFrame, events: DataFrame, key: str, index_time: str,
                      event_time: str, windows: Mapping[str, float],
                      features: Sequence[Feature],
                      any_of: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """All features for all windows in one join and one aggregation.

    ``windows`` maps a suffix to its length in seconds; a window covers
    ``0 <= index - event <= length``. Columns are ``{name}_{suffix}``. ``any_of`` adds the
    row-wise maximum of listed flags, also per window. One row per entity of ``index``.
    """
    widest = max(windows.values())
    hits = window_join(index.select(key, index_time), events, key, index_time, event_time,
                       -widest, 0.0)
    before = -F.col("gap_seconds")
    columns = [f.over(before <= length).alias(f"{f.name}_{suffix}")
               for suffix, length in windows.items() for f in features]
    found = hits.groupBy(key).agg(*columns)
    out = index.select(key).join(found, key, "left")
    zero = [f"{f.name}_{s}" for s in windows for f in features if f.kind == "any"]
    out = out.na.fill(0, zero)
    for name, members in (any_of or {}).items():
        for suffix in windows:
            out = out.withColumn(
                f"{name}_{suffix}", F.greatest(*[F.col(f"{m}_{suffix}") for m in members]))
    return out


def flags_before(index: DataFrame, events: DataFrame, key: str, anchor: str,
                 event_time: str, windows: Mapping[str, float],
                 where: Column | None = None) -> DataFrame:
    """0/1 per named window: any event with ``0 <= anchor - event <= seconds``."""
    picked = events if where is None else events.where(where)
    hits = window_join(index.select(key, anchor), picked.select(key, event_time), key, anchor,
                       event_time, -max(windows.values()), 0.0)
    found = hits.groupBy(key).agg(*[
        F.max((-F.col("gap_seconds") <= seconds).cast("tinyint")).alias(name)
        for name, seconds in windows.items()])
    return index.select(key).join(found, key, "left").na.fill(0, list(windows))


def category_flags_before(index: DataFrame, events: DataFrame, key: str, anchor: str,
                          event_time: str, category: str, names: Mapping[str, str],
                          seconds: float) -> DataFrame:
    """0/1 per category: any event of it with ``0 <= anchor - event <= seconds``."""
    listed = events.where(F.col(category).isin(list(names)))
    hits = window_join(index.select(key, anchor), listed.select(key, event_time, category), key,
                       anchor, event_time, -seconds, 0.0)
    found = hits.groupBy(key).agg(*[
        F.max((F.col(category) == c).cast("tinyint")).alias(name) for c, name in names.items()])
    return index.select(key).join(found, key, "left").na.fill(0, list(names.values()))


def unit_and_provider(index: DataFrame, stays: DataFrame, codes: DataFrame, key: str, at: str,
                      start: str, end: str, category: str, unit_type: str, site: str,
                      site_type: str, unit_category: str, code_filter: Column,
                      code_time: str, provider: str) -> DataFrame:
    """Place and unit type at the index, days in units, provider of the first listed code.

    Only entities with at least one of the three parts appear.
    """
    tagged = stays.withColumn("_unit", F.when(F.col(category) == unit_category,
                                              F.col(unit_type)))
    place = location_at(index, tagged, key, at, start, end,
                        [site, category, "_unit", site_type])
    days = unit_days(stays.where(F.col(category) == unit_category), key, start, end)
    who = first_per(codes.where(code_filter), key, [F.col(code_time).isNull(), code_time], [provider])
    return (place.withColumnRenamed("_unit", "unit_type_at_index")
            .withColumnRenamed(category, "location_at_index")
            .join(days, key, "full").join(who, key, "full"))


def unit_days(stays: DataFrame, key: str, start: str, end: str,
              name: str = "unit_days") -> DataFrame:
    """Total length of an entity's stays in days; open stays add nothing."""
    return stays.groupBy(key).agg(
        F.coalesce(F.sum(elapsed(start, end, "day")), F.lit(0.0)).alias(name))


def last_stay(stays: DataFrame, key: str, start: str, end: str, category: str,
              name: str = "last_location") -> DataFrame:
    """Category of the stay that ended last; open stays come first."""
    return first_per(stays, key, [F.col(end).isNotNull(), end, start], [category],
                     last=True).withColumnRenamed(category, name)


def outcomes(index: DataFrame, stays: DataFrame, key: str, begin: str, finish: str,
             status: str, stay_start: str, stay_end: str, category: str, unit_category: str,
             death_pattern: str) -> DataFrame:
    """Length of stay in days, death, and death while last located in the unit."""
    died = matches(status, death_pattern).cast("tinyint")
    base = index.select(key, elapsed(begin, finish, "day").alias("los_days"),
                        died.alias("died"))
    last = last_stay(keep_of(stays, index, key), key, stay_start, stay_end, category)
    return (base.join(last, key, "left")
            .withColumn("died_in_unit", flag((F.col("died") == 1)
                                             & (F.col("last_location") == unit_category)))
            .drop("last_location"))


def keep_of(events: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Events of the entities in ``index``."""
    return events.join(index.select(key), key, "left_semi")


def assemble_wide(base: DataFrame, parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Base rows with every part joined on the key (parts have one row per entity)."""
    return reduce(lambda left, right: left.join(right, key, "left"), parts, base)


def modeling_view(wide: DataFrame, columns: Mapping[str, str], index_time: str,
                  constants: Mapping[str, object] | None = None) -> DataFrame:
    """Selected and renamed columns (``source -> name``) with calendar parts."""
    picked = [F.col(source).alias(name) for source, name in columns.items()]
    return wide.select(
        *picked, year_of(index_time).alias("calendar_year"),
        quarter_of(index_time).alias("calendar_quarter"),
        *[F.lit(v).alias(n) for n, v in (constants or {}).items()])


def centred_year(df: DataFrame, year: str = "calendar_year",
                 name: str = "calendar_year_c") -> DataFrame:
    """Years since the first year of the data."""
    return df.withColumn(name, F.col(year) - df.agg(F.min(year)).scalar())
