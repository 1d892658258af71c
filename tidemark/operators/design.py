"""Model rows: which terms vary, dummy coding, complete cases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Design:
    """``rows`` has ``fit, site, unit, y, x0..`` for the terms in ``names``."""

    rows: DataFrame
    names: tuple[str, ...]

    @property
    def xs(self) -> list[str]:
        return [f"x{i}" for i in range(len(self.names))]


def varying_terms(df: DataFrame, numeric: Sequence[str],
                  categorical: Sequence[str]) -> tuple[list[str], list[str]]:
    """Terms with more than one value, from one aggregation."""
    row = df.agg(*[F.var_samp(c).alias(f"v_{c}") for c in numeric],
                 *[F.countDistinct(c).alias(f"d_{c}") for c in categorical]).first()
    return ([c for c in numeric if row[f"v_{c}"]],
            [c for c in categorical if row[f"d_{c}"] > 1])


def levels_of(df: DataFrame, column: str, reference: str | None = None) -> list[str]:
    """Levels of a factor with the reference first (default: the most frequent one)."""
    found = (df.where(F.col(column).isNotNull()).groupBy(column).count()
             .orderBy(F.desc("count"), column).collect())
    names = [r[0] for r in found]
    first = reference if reference in names else names[0]
    return [first] + sorted(n for n in names if n != first)


def design(df: DataFrame, outcome: str, numeric: Sequence[str],
           factors: Mapping[str, Sequence[str]], site: str, unit: str,
           fit: str | None = None, keep: Sequence[str] = ()) -> Design:
    """Complete cases with an intercept, numeric terms and one 0/1 column per other level."""
    names = ["(Intercept)", *numeric]
    columns = [F.lit(1.0), *[F.col(c).cast("double") for c in numeric]]
    for factor, levels in factors.items():
        for level in levels[1:]:
            names.append(f"{factor}{level}")
            columns.append((F.col(factor) == level).cast("double"))
    used = [outcome, *numeric, *factors, site, unit]
    rows = df.na.drop(subset=used).select(
        (F.col(fit).cast("string") if fit else F.lit("all")).alias("fit"),
        F.col(site).cast("string").alias("site"), F.col(unit).cast("string").alias("unit"),
        F.col(outcome).cast("double").alias("y"),
        *[c.alias(f"x{i}") for i, c in enumerate(columns)], *keep)
    return Design(rows, tuple(names))
