"""Time arithmetic on wall-clock (``timestamp_ntz``) columns.

Differences are taken as day-time intervals, so no session time zone enters the result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end``, cut toward zero."""
    gap = as_column(end) - as_column(start)
    return gap.cast("interval second").cast("bigint")


def elapsed(start: Column | str, end: Column | str, unit: str = "hour") -> Column:
    """Whole seconds from ``start`` to ``end`` expressed in ``unit``."""
    return seconds_between(start, end) / F.lit(float(SECONDS[unit]))


def shift(ts: Column | str, seconds: float) -> Column:
    """``ts`` moved by a number of seconds (negative = earlier)."""
    return as_column(ts) + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))


def to_site_clock(instant: Column | str, time_zone: str) -> Column:
    """The local wall clock of an instant, without a zone."""
    return F.convert_timezone(F.current_timezone(), F.lit(time_zone),
                              as_column(instant).cast("timestamp_ntz"))


def time_slot(ts: Column | str, width_seconds: float) -> Column:
    """Number of the fixed-width slot that holds ``ts``."""
    origin = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    width = float(max(1, math.ceil(width_seconds)))
    return F.floor(seconds_between(origin, ts) / F.lit(width))


def year_of(ts: Column | str) -> Column:
    return F.year(as_column(ts)).cast("smallint")


def quarter_of(ts: Column | str) -> Column:
    return F.quarter(as_column(ts)).cast("tinyint")
