"""Aggregate expressions used across tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .elapsed import as_column


def n_where(condition: Column) -> Column:
    """Rows for which the condition is true."""
    return F.count(F.when(condition, F.lit(1)))


def n_missing(value: Column | str) -> Column:
    return n_where(as_column(value).isNull())


def pct_where(condition: Column) -> Column:
    """Percentage of rows for which a condition holds, over rows where it is known."""
    return F.avg(condition.cast("double")) * 100


def any_of(condition: Column) -> Column:
    """1 if any row of the group satisfies the condition, else 0."""
    return F.max(F.coalesce(condition, F.lit(False)).cast("tinyint"))


def max_of(value: Column | str, condition: Column) -> Column:
    return F.max(F.when(condition, as_column(value)))


def min_of(value: Column | str, condition: Column) -> Column:
    return F.min(F.when(condition, as_column(value)))


def n_distinct_with_null(value: Column | str) -> Column:
    """Distinct values, counting null as one of them."""
    value = as_column(value)
    return F.countDistinct(value) + F.max(value.isNull().cast("bigint"))
