"""Row-level recoding: normalised text, lenient casts, bands, levels, ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from .elapsed import as_column


def folded(text: Column | str) -> Column:
    """Trimmed lower case."""
    return F.lower(F.trim(as_column(text)))


def matches(text: Column | str, pattern: str) -> Column:
    """Case-insensitive regular-expression search."""
    return as_column(text).rlike(f"(?i){pattern}")


def lenient_double(value: Column | str) -> Column:
    """A double, or null where the text is no number."""
    return as_column(value).try_cast("double")


def present(value: Column | str) -> Column:
    """Neither null nor the empty string."""
    return as_column(value).isNotNull() & (as_column(value) != "")


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """``top / bottom``; null for a zero or missing divisor."""
    return F.try_divide(as_column(top), as_column(bottom))


def chain(cases: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """First matching case wins."""
    out = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def band(value: Column | str, edges: Sequence[float], labels: Sequence[str],
         null_label: str | None = None) -> Column:
    """Half-open bands ``[edge_i, edge_i+1)``.

    ``labels`` has one more entry than ``edges``: below the first edge up to at or above the
    last one. A missing value gets ``null_label``.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must have one more entry than edges")
    value = as_column(value)
    cases = [(value.isNull(), null_label)]
    cases += [(value < edge, label) for edge, label in zip(edges, labels)]
    return chain(cases, labels[-1]).cast("string")


def band_within(value: Column | str, category: Column | str,
                bands: Mapping[str, tuple[Sequence[float], Sequence[str]]],
                null_into_top: bool = False) -> Column:
    """``band`` with edges chosen by a category; other categories get null.

    With ``null_into_top`` a missing value falls into the last band of its category.
    """
    category = as_column(category)
    return chain([
        (category == name, band(value, edges, labels, labels[-1] if null_into_top else None))
        for name, (edges, labels) in bands.items()
    ]).cast("string")


def level_of(value: Column | str, levels: Mapping[str, int]) -> Column:
    """Ordinal level of a category, null where it is not listed."""
    pairs = [F.lit(part) for item in levels.items() for part in item]
    return F.create_map(*pairs)[as_column(value)]


def shortfall(value: Column | str, reference: Column | float) -> Column:
    """Relative distance below a reference."""
    reference = reference if isinstance(reference, Column) else F.lit(float(reference))
    return (reference - as_column(value)) / reference


def flag(condition: Column) -> Column:
    """1 / 0, with an unknown condition as 0."""
    return F.coalesce(condition, F.lit(False)).cast("tinyint")


def half_even(value: Column | str, digits: int) -> Column:
    """Rounding with ties to the even digit."""
    return F.bround(as_column(value), digits)
