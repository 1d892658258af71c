"""Chained-equation imputation with predictive mean matching.

A regression needs one cross-product per target; donors are found by sorting donors and
recipients together over the cluster once: a recipient's donors lie just before and after it in its
range of the order, or at the ends of the ranges beside it. Recipients carry their row along, so a turn
writes the rows it fills and nothing else; complete rows are written once.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise, spread_count
from .bootstrap import hash_uniform
from .laplace import then_none
from .lmm import symmetric, triangle


def missing_shares(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Percentage of missing values per column."""
    row = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c)
                   for c in columns]).first()
    return row.asDict()


def _linear(beta: np.ndarray, terms: Sequence[Column]) -> Column:
    out = F.lit(float(beta[0]))
    for b, x in zip(beta[1:], terms):
        out = out + F.lit(float(b)) * x
    return out


def _draw(frame: DataFrame, target: str, terms: Sequence[Column], rng: np.random.Generator):
    """Least-squares coefficients of the observed rows and one draw around them."""
    xs = [F.lit(1.0), *terms]
    p, y = len(xs), F.col(target)
    row = frame.where(~F.col(f"_miss_{target}")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y * y).alias("yy"),
        F.array(*[F.sum(x * y) for x in xs]).alias("xy"),
        F.array(*[F.sum(xs[i] * xs[j]) for i, j in triangle(p)]).alias("xx")).first()
    a, b = symmetric(np.array([row["xx"]]), p)[0], np.array(row["xy"])
    inverse = np.linalg.pinv(a, hermitian=True)
    beta = inverse @ b
    rss = max(row["yy"] - b @ beta, 1e-12)
    sigma2 = rss / rng.chisquare(max(row["n"] - p, 1))
    values, vectors = np.linalg.eigh(inverse)
    noise = vectors @ (np.sqrt(np.maximum(values, 0)) * rng.standard_normal(p))
    return beta, beta + np.sqrt(sigma2) * noise, row["n"]


FOUND, OPEN, EDGE = 0, 1, 2  # a recipient with its value, one that needs donors of other ranges, the donors at the ends of a range
LISTS = ["_before", "_before_value", "_after", "_after_value"]


def _picked(before: Sequence, before_value: Sequence, after: Sequence, after_value: Sequence, at: float, u: float, donors: int) -> float:
    """Value of one of the nearest donors of a recipient at ``at``; the first in order of equally near ones."""
    near = np.array([*before, *after], float)
    order = np.argsort(np.abs(near - at), kind="stable")[:donors]
    return [*before_value, *after_value][order[int(u * len(order))]]


def _matched(frame: DataFrame, key: str, target: str, terms: Sequence[Column], rng: np.random.Generator,
             donors: int, seed: int, turn: int, carry: Sequence[str] = ()) -> DataFrame:
    """``key, _pick`` and the row (``carry``): a value for each missing row, from its nearest observed rows."""
    fitted, drawn, _ = _draw(frame, target, terms, rng)
    missing = F.col(f"_miss_{target}")
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.struct(F.lit(True).alias("_none"))
    order = ["_pred", "_missing", key]
    scored = frame.select(
        key, missing.alias("_missing"), F.when(~missing, F.col(target)).alias("_value"), F.when(missing, carried).alias("_row"),
        F.when(missing, _linear(drawn, terms)).otherwise(_linear(fitted, terms)).alias("_pred"))
    placed = (scored.repartitionByRange(spread_count(frame.sparkSession), *order).sortWithinPartitions(*order)
              .withColumn("_u", F.when(F.col("_missing"), hash_uniform(F.lit(seed), F.lit(turn), F.col(key))))
              .withColumn("_part", F.spark_partition_id()))
    names = [key, "_row", "_pred", "_u", "_part"]
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "_kind int", "_pick double", *(f"{c} array<double>" for c in LISTS)])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, head, tail, part, shape = None, np.zeros((0, 2)), np.zeros((0, 2)), None, None
        for batch in then_none(batches):
            if batch is not None and not batch.num_rows:
                continue
            parts = [t for t in (rest, None if batch is None else pa.Table.from_batches([batch])) if t is not None]
            if not parts:
                continue
            held = pa.concat_tables(parts).combine_chunks()
            asked = held["_missing"].to_numpy()
            pred = held["_pred"].to_numpy()
            upto = np.cumsum(~asked)
            count = int(upto[-1])
            of_donor = np.column_stack((pred[~asked], held["_value"].to_numpy()[~asked]))
            part, shape = held["_part"][0].as_py(), held.schema
            if len(head) < donors:  # rows held over begin with the first donors as long as these are too few
                head = of_donor[:donors]
            tail = of_donor[-donors:] if count >= donors else of_donor
            at = np.flatnonzero(asked)
            ready = at if batch is None else at[count - upto[at] >= donors]
            n = upto[ready]
            full = (n >= donors) & (count - n >= donors)
            some = ready[full]
            if len(some):
                places = n[full][:, None] + np.arange(-donors, donors)
                near = np.argsort(np.abs(of_donor[places, 0] - pred[some][:, None]), axis=1, kind="stable")[:, :donors]
                u = held["_u"].to_numpy()[some]
                chosen = near[np.arange(len(some)), (u * donors).astype(int)]
                yield from filled(held.take(pa.array(some)), FOUND, of_donor[places[np.arange(len(some)), chosen], 1], None)
            if not full.all():
                lists = [[of_donor[max(0, k - donors):k], of_donor[k:k + donors]] for k in n[~full]]
                yield from filled(held.take(pa.array(ready[~full])), OPEN, None, lists)
            if batch is not None:  # recipients that wait, and from the donors before the first of them on
                waits = np.zeros(len(asked), bool)
                waits[at[count - upto[at] < donors]] = True
                first = max(0, (upto[np.argmax(waits)] if waits.any() else count) - donors)
                rest = held.filter(pa.array(waits | (~asked & (upto > first))))
        if part is not None:
            edge = pa.table([pa.nulls(1, shape.field(c).type) if c != "_part" else pa.array([part], pa.int32()) for c in names], names=names)
            yield from filled(edge, EDGE, None, [[tail, head]])

    def filled(rows: pa.Table, kind: int, values: np.ndarray | None, lists: list | None) -> list[pa.RecordBatch]:
        size = rows.num_rows
        listed = [pa.nulls(size, pa.list_(pa.float64()))] * 4 if lists is None else [
            pa.array([x[side][:, c].tolist() for x in lists], pa.list_(pa.float64())) for side in (0, 1) for c in (0, 1)]
        return pa.table([*(rows[c] for c in names), pa.array(np.full(size, kind, np.int32)),
                         pa.nulls(size, pa.float64()) if values is None else pa.array(values), *listed],
                        names=[*names, "_kind", "_pick", *LISTS]).to_batches()

    out = materialise(placed.mapInArrow(match, schema), "matched")
    ends = {r["_part"]: r for r in out.where(F.col("_kind") == EDGE).select("_part", *LISTS).collect()}
    before, after = {}, {}  # last donors of all earlier ranges, first ones of all later ranges
    for numbers, beside, first in ((sorted(ends), before, True), (sorted(ends, reverse=True), after, False)):
        seen: tuple[list, list] = ([], [])
        for k in numbers:
            beside[k] = seen
            own = ends[k]
            seen = tuple((x + y)[-donors:] if first else (y + x)[:donors] for x, y in zip(
                seen, (own["_before"], own["_before_value"]) if first else (own["_after"], own["_after_value"]), strict=True))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picks = []
            for part, at, u, b, bv, a, av in zip(*(batch.column(c).to_pylist() for c in ("_part", "_pred", "_u", *LISTS)), strict=True):
                b, bv = ((x + y)[-donors:] for x, y in zip(before[part], (b, bv), strict=True))
                a, av = ((y + x)[:donors] for x, y in zip(after[part], (a, av), strict=True))
                picks.append(_picked(b, bv, a, av, at, u, donors))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("_row"), pa.array(picks, pa.float64())], [key, "_row", "_pick"])

    rest = out.where(F.col("_kind") == OPEN).select(*names, *LISTS).mapInArrow(
        finish, f"`{key}` {kinds[key]}, _row {kinds['_row']}, _pick double")
    found = out.where(F.col("_kind") == FOUND).select(key, "_row", "_pick").unionByName(materialise(rest, "matched-at-ends"))
    return found.select(key, "_pick", *[F.col("_row")[c].alias(c) for c in carry])


def impute_pmm(df: DataFrame, key: str, targets: Sequence[str], numeric: Sequence[str],
               factors: Mapping[str, Sequence[str]], iterations: int = 10, donors: int = 5,
               seed: int = 20260319, imputation: int = 1,
               skip_below: float = 1.0) -> tuple[DataFrame, str]:
    """(rows with the targets completed, method used).

    If every target has less than ``skip_below`` percent missing the rows stay as they are.
    Missing numeric predictors are completed in the same chain for use inside it; a missing
    factor is its own level. The chain starts from the observed means. Only ``targets`` change
    in the result. ``imputation`` numbers independent completions.
    """
    shares = missing_shares(df, [*targets, *numeric])
    if all(shares[t] < skip_below for t in targets):
        return df, "complete_case"
    chain = [*targets, *[c for c in numeric if shares[c] > 0]]
    steady = [c for c in numeric if shares[c] == 0]
    means = df.agg(*[F.avg(c).alias(c) for c in chain]).first()
    dummies = {}
    for factor, levels in factors.items():
        named = F.coalesce(F.col(factor).cast("string"), F.lit("(missing)"))
        for level in [*levels[1:], "(missing)"]:
            dummies[f"_d{len(dummies)}"] = (named == level).cast("double")
    frame = materialise(df.select(
        key, *[F.coalesce(F.col(c).cast("double"), F.lit(float(means[c]))).alias(c)
               for c in chain],
        *[F.col(c).isNull().alias(f"_miss_{c}") for c in chain],
        *[F.col(c).cast("double").alias(c) for c in steady],
        *[c.alias(n) for n, c in dummies.items()]), "chain")
    miss = [F.col(f"_miss_{c}") for c in chain]
    filled: dict[str, DataFrame] = {}  # rows as the last turn of a target left them, last turn first

    def incomplete() -> list[DataFrame]:
        later, parts = F.lit(False), []
        for c, rows in filled.items():
            parts.append(rows.where(~later))
            later = later | F.col(f"_miss_{c}")
        return parts if len(filled) == len(chain) else [*parts, frame.where(reduce(Column.__or__, miss)).where(~later)]

    for iteration in range(iterations):
        for at, target in enumerate(chain):
            terms = [F.col(c) for c in [*[c for c in chain if c != target], *steady, *dummies]]
            rng = np.random.default_rng([seed, imputation, iteration, at])
            turn = (imputation * 1000 + iteration) * 100 + at
            now = reduce(DataFrame.unionByName, incomplete(), frame.where(~reduce(Column.__or__, miss)))
            done = _matched(now, key, target, terms, rng, donors, seed, turn,
                            [c for c in frame.columns if c not in (key, target)])
            filled = {target: done.withColumnRenamed("_pick", target).select(*frame.columns),
                      **{c: rows for c, rows in filled.items() if c != target}}
    new = reduce(DataFrame.unionByName, incomplete()).select(key, *[F.col(t).alias(f"_new_{t}") for t in targets])
    out = df.join(new, key, "left")
    for t in targets:
        out = out.withColumn(t, F.coalesce(F.col(t).cast("double"), f"_new_{t}"))
    return out.select(*df.columns), "pmm"
