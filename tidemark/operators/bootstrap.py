"""Case bootstrap of variance shares, with exactly as many draws as rows in every replicate.

The draws of a replicate go down a tree. Rows lie in blocks of a unit (parts of it by a hash of the row key, so
the same rows are together however the table is partitioned), and blocks in a bounded number of ranges by a hash of
their name. The draws of each model are split over its ranges on the driver, over the blocks of a range in
the task that lists them, and over the rows of a block in the task that holds it; each
split is multinomial with a generator seeded by the name of its node. So a replicate has n draws, and a task that is
run again draws the same. Rows are never multiplied: the draws of all replicates times the rows of a block
are one matrix product, which leaves one row of sums per unit and replicate.

The likelihood takes a unit's sums only through its number of drawn rows, so units of a site that drew equally many rows
are added up: a replicate is fitted from rows (site, drawn n), whose number grows with the square root of the
rows at most, all replicates side by side. Blocks of a site meet their draws in parts of bounded size, and a part adds up its
units before anything is written; only units that lie in several blocks are written with a sum per replicate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise, spread, spread_count
from .design import Design
from .laplace import array_sum
from .lmm import COARSE, solve_system, symmetric, triangle, variance_components
from .variance_search import minimise

BLOCK = 4096  # rows of a block, about
RANGES = 1024  # of blocks, over all models
PART_ROWS = 1 << 19  # rows of a part of a site, about
PART_PAIRS = 1 << 21  # (unit, replicate) of a part, about
CHUNK_PAIRS = 1 << 17  # of them held at once before they are added up
NODE = ["fit", "site", "unit", "block"]
PART = ["fit", "site", "part"]


def hash_uniform(*parts: Column) -> Column:
    """A number in [0, 1) fixed by its parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(2**53)


def split_draws(draws: np.ndarray, sizes: np.ndarray, *node: int) -> np.ndarray:
    """Draws (one number per replicate) split over parts of the given sizes: replicates x parts."""
    rng = np.random.default_rng([x & (2**63 - 1) for x in node])
    sizes = np.asarray(sizes, float)
    return rng.multinomial(draws, sizes / sizes.sum())


def row_draws(draws: np.ndarray, rows: int, *node: int) -> np.ndarray:
    """How often each of ``rows`` rows is drawn in each replicate: replicates x rows."""
    rng = np.random.default_rng([x & (2**63 - 1) for x in node])
    of_replicate = np.repeat(np.arange(len(draws)), draws)
    drawn = of_replicate * rows + rng.integers(0, rows, len(of_replicate))
    return np.bincount(drawn, minlength=len(draws) * rows).reshape(len(draws), rows)


def packed_blocks(model: Design, row_key: list[str], ranges: int) -> DataFrame:
    """Rows of each block as matrices in the order of their keys: NODE, blocks (of the unit), range, name, rows, x, y; written."""
    xs = model.xs
    keyed = model.rows.select("fit", "site", "unit", "y", *xs, F.xxhash64(*row_key).alias("_key"))
    units = keyed.groupBy("fit", "site", "unit").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_blocks"))
    large = units.where("_blocks > 1")
    rows = (keyed.join(large, ["fit", "site", "unit"], "left").withColumn("blocks", F.coalesce("_blocks", F.lit(1)))
            .withColumn("block", F.pmod("_key", F.col("blocks")).cast("int")).drop("_blocks"))
    fields = F.struct("_key", "y", *xs)
    blocks = rows.groupBy(*NODE, "blocks").agg(F.sort_array(F.collect_list(fields)).alias("_rows"))
    name = F.xxhash64(*NODE)
    listed = blocks.select(
        *NODE, "blocks", name.alias("name"), F.pmod(F.shiftright(name, 20), F.lit(ranges)).cast("int").alias("range"),
        F.size("_rows").alias("rows"), F.col("_rows.y").alias("y"),
        F.array(*[F.col(f"_rows.{x}") for x in xs]).alias("x"))
    return materialise(listed, "blocks")


def in_parts(blocks: DataFrame, replicates: int) -> DataFrame:
    """Blocks with the part of their site: a bounded number of rows and of (unit, replicate)."""
    sites = materialise(blocks.groupBy("fit", "site").agg(F.ceil(F.greatest(
        F.sum("rows") / PART_ROWS, F.count(F.lit(1)) * replicates / PART_PAIRS)).cast("int").alias("parts")), "parts")
    return blocks.join(sites, ["fit", "site"]).withColumn("part", F.pmod(F.shiftright("name", 7), "parts").cast("int"))


def drawn_blocks(blocks: DataFrame, replicates: int, seed: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """fit, name and the draws of each block in every replicate (32-bit, one behind the other); and ``keep``."""
    sizes = blocks.groupBy("fit", "range").agg(F.sum("rows").alias("n")).toPandas().sort_values(["fit", "range"])
    of_range = {}
    for number, (fit, own) in enumerate(sizes.groupby("fit")):
        whole = np.full(replicates, own["n"].sum(), np.int64)
        parts = split_draws(whole, own["n"].to_numpy(), seed, number)
        of_range |= {(fit, r): parts[:, k] for k, r in enumerate(own["range"])}
    shared = blocks.sparkSession.sparkContext.broadcast(of_range)  # RANGES (or one a model) x replicates numbers at most

    def split(listed: pd.DataFrame) -> pd.DataFrame:
        listed = listed.sort_values("name")
        fit, part = listed["fit"].iloc[0], int(listed["range"].iloc[0])
        names = listed["name"].to_numpy()
        parts = split_draws(shared.value[fit, part], listed["rows"].to_numpy(), seed, 1 << 40, part, int(names[0]))
        return listed[["fit", "name", *keep]].assign(draws=[parts[:, k].astype("<i4").tobytes() for k in range(len(names))])

    kinds = dict(blocks.dtypes)
    return (blocks.select("fit", "range", "name", "rows", *keep).groupBy("fit", "range")
            .applyInPandas(split, ", ".join([f"{c} {kinds[c]}" for c in ("fit", "name", *keep)] + ["draws binary"])))


def totals_of(p: int) -> list[tuple[int, int]]:
    """Pairs of (y, x0, x1, ...) whose products are added over all drawn rows."""
    return triangle(p + 1)


def added_up(key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different keys in order, their values summed)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[begin], np.add.reduceat(values[order], begin, axis=0)


N_BITS = 40  # of a key (replicate, drawn n)


def folded_units(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys (replicate, drawn n), sums) of units x replicates x (n, r, s): units that drew equally many rows together."""
    units, replicates, width = v.shape
    flat = v.reshape(-1, width)
    key = (np.tile(np.arange(1, replicates + 1), units) << N_BITS) + flat[:, 0].astype(np.int64)
    at = np.flatnonzero(flat[:, 0])
    at = at[np.argsort(key[at], kind="stable")]
    key = key[at]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(at) else at
    r, s = flat[at, 1], [flat[at, k] for k in range(2, width)]
    out = np.empty((len(begin), 3 + 2 * len(s) + len(triangle(len(s)))))
    if not len(at):
        return key, out
    out[:, 0] = np.diff(np.append(begin, len(at)))
    # a column at a time: the products of all pairs side by side would be several times the sums
    columns = chain([r, r * r], s, (r * x for x in s), (s[i] * s[j] for i, j in triangle(len(s))))
    for place, column in enumerate(columns, 1):
        out[:, place] = np.add.reduceat(column, begin)
    return key[begin], out


SUMS = ["fit", "site", "unit", "replicate", "n", "v"]
SUMS_SCHEMA = "fit string, site string, unit string, replicate int, n double, v array<double>"


def sum_rows(fit: str, site: str | None, unit: list | None, key: np.ndarray | None, values: np.ndarray) -> pa.Table:
    """Rows of ``SUMS``: ``values`` by unit, or by key (replicate, n)."""
    rows, width = values.shape
    empty = lambda kind: pa.nulls(rows, kind)
    named = lambda x: pa.repeat(pa.scalar(x, pa.string()), rows)
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
    return pa.table([
        named(fit), named(site), empty(pa.string()) if unit is None else pa.array(unit, pa.string()),
        empty(pa.int32()) if key is None else pa.array((key >> N_BITS).astype(np.int32)),
        empty(pa.float64()) if key is None else pa.array((key & ((1 << N_BITS) - 1)).astype(float)),
        pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).ravel()))], names=SUMS)


def replicate_sums(model: Design, row_key: list[str], replicates: int, seed: int, models: int = 1) -> tuple[DataFrame, DataFrame]:
    """(sums per fit, replicate, site and drawn n; products per fit and replicate).

    Sums: m units, r, rr, s (p), rs (p), ss (``triangle``). Products: n and those of ``totals_of``.
    """
    p = len(model.names)
    blocks = in_parts(packed_blocks(model, row_key, max(1, RANGES // models)), replicates)
    drawn = drawn_blocks(blocks, replicates, seed, ("site", "part"))
    pairs = np.array(totals_of(p))
    held = max(1, CHUNK_PAIRS // replicates)

    def multiply(key: tuple, listed: pa.Table, draws: pa.Table) -> pa.Table:
        fit, site = key[0].as_py(), key[1].as_py()
        drawn_of = dict(zip(draws["name"].to_pylist(), draws["draws"].to_pylist(), strict=True))
        names, rows = listed["name"].to_numpy(), listed["rows"].to_numpy()
        units, alone = listed["unit"].to_pylist(), listed["blocks"].to_numpy() == 1
        y = listed["y"].combine_chunks().flatten().to_numpy()
        x = listed["x"].combine_chunks().flatten().flatten().to_numpy()
        end = np.cumsum(rows)
        whole, found, large = np.zeros((replicates, len(pairs))), None, []
        order = np.argsort(names)
        for at in range(0, len(order), held):
            some = order[at:at + held]
            v = np.empty((len(some), replicates, p + 2))
            for place, k in enumerate(some):
                begin = end[k] - rows[k]
                z = np.column_stack((y[begin:end[k]], x[begin * p:end[k] * p].reshape(p, -1).T))
                counts = row_draws(np.frombuffer(drawn_of[names[k]], "<i4"), len(z), seed, 1 << 41, int(names[k])).astype(float)
                whole += counts @ (z[:, pairs[:, 0]] * z[:, pairs[:, 1]])
                v[place, :, 0] = counts.sum(axis=1)
                v[place, :, 1:] = counts @ z
            own = alone[some]
            if own.any():
                new = folded_units(v[own])
                found = new if found is None else added_up(*(np.concatenate(x) for x in zip(found, new, strict=True)))
            if not own.all():
                large.append(sum_rows(fit, site, [units[k] for k in some[~own]], None, v[~own].reshape(-1, replicates * (p + 2))))
        numbers = np.arange(1, replicates + 1, dtype=np.int64) << N_BITS
        return pa.concat_tables([sum_rows(fit, None, None, numbers, whole), *large,
                                 *([] if found is None else [sum_rows(fit, site, None, *found)])])

    near = lambda df: df.repartition(spread_count(df.sparkSession), *PART).groupBy(*PART)
    sums = materialise(near(blocks.select(*PART, "unit", "blocks", "name", "rows", "y", "x"))
                       .cogroup(near(drawn.select(*PART, "name", "draws"))).applyInArrow(multiply, SUMS_SCHEMA), "replicate-sums")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fit, site, v in zip(*(batch.column(c) for c in ("fit", "site", "v")), strict=True):
                yield from sum_rows(fit.as_py(), site.as_py(), None, *folded_units(
                    v.values.to_numpy().reshape(1, replicates, p + 2))).to_batches()

    added = lambda count: F.array(*[F.sum(F.col("v")[k]) for k in range(count)])
    large = (sums.where("unit IS NOT NULL").groupBy("fit", "site", "unit").agg(array_sum("v"))
             .select("fit", "site", "v").mapInArrow(fold, SUMS_SCHEMA))
    folded = (sums.where("unit IS NULL AND site IS NOT NULL").unionByName(large).repartition("fit", "replicate")
              .groupBy("fit", "replicate", "site", "n").agg(added(3 + 2 * p + p * (p + 1) // 2).alias("u")))
    totals = sums.where("site IS NULL").groupBy("fit", "replicate").agg(added(len(pairs)).alias("products"))
    return folded, totals


def fit_folded(sums: pd.DataFrame, products: np.ndarray, p: int, structure: str, grids) -> dict:
    """Best (tp, th) and residual variance of one replicate from its folded sums, by REML."""
    sums = sums.sort_values(["site", "n"], kind="stable")
    site = sums["site"].to_numpy()
    cut = np.flatnonzero(np.append(True, site[1:] != site[:-1]))
    n, u = sums["n"].to_numpy(), np.vstack(sums["u"].to_numpy())
    m, r, rr, s, rs = u[:, 0], u[:, 1], u[:, 2], u[:, 3:3 + p], u[:, 3 + p:3 + 2 * p]
    ss = u[:, 3 + 2 * p:]
    whole = symmetric(products[None], p + 1)[0]
    yy, xy, xx, rows = whole[0, 0], whole[0, 1:], whole[1:, 1:], float(m @ n)
    found = {}

    def deviance(point):
        tp, th = point
        k = 1 / (1 + n * tp)
        w = tp * k
        a, e = np.add.reduceat(m * n * k, cut), np.add.reduceat(r * k, cut)
        t = np.add.reduceat(s * k[:, None], cut, axis=0)
        v = th / (1 + th * a)
        found[point] = solve_system(
            xx - symmetric((w @ ss)[None], p)[0] - (t * v[:, None]).T @ t, xy - w @ rs - t.T @ (v * e),
            yy - w @ rr - v @ (e * e), m @ np.log1p(n * tp) + np.log1p(th * a).sum(), rows, True)
        return found[point][0]

    best = minimise({"": grids}, lambda points: {f: [deviance(x) for x in at] for f, at in points.items()})[""]
    return {"tp": best.point[0], "th": best.point[1], "sigma2": found[best.point][1],
            "structure": structure, "converged": best.converged, "n_rows": rows}


def percentile_limit(values: np.ndarray, share: float) -> float:
    """Order statistic (R + 1) share of R values, between two of them along the normal quantile scale."""
    values, count = np.sort(values), len(values)
    place = (count + 1) * share
    low = math.floor(place)
    if low <= 0 or low >= count:
        return float(values[0] if low <= 0 else values[-1])
    if place == low:
        return float(values[low - 1])
    quantile = NormalDist().inv_cdf
    first, after = quantile(low / (count + 1)), quantile((low + 1) / (count + 1))
    along = (quantile(share) - first) / (after - first)
    return float(values[low - 1] + along * (values[low] - values[low - 1]))


def with_row_number(rows: DataFrame, name: str = "row_key") -> DataFrame:
    """Rows written once with a fixed number each, for tables without a unique key."""
    return materialise(spread(rows).withColumn(name, F.monotonically_increasing_id()), "rows")


def bootstrap_shares(model: Design, fitted: pd.DataFrame, row_key: list[str], replicates: int,
                     seed: int, level: float = 0.95) -> pd.DataFrame:
    """Percentile intervals of ``pct_variance`` per model and component.

    Every replicate keeps the structure chosen for the original rows. ``row_key`` names the rows; rows of
    equal keys are told apart by their values.
    """
    p, plan = len(model.names), {}
    for m in fitted.itertuples():
        # a start near the estimate; the search goes on past any edge
        near = tuple((0.0,) if v == 0 else (0.0, v / 8, v, v * 8) for v in (m.tp, m.th))
        plan[m.fit] = m.structure, COARSE[m.structure] if m.singular else near
    wanted = Design(model.rows.where(F.col("fit").isin(list(plan))), model.names)
    folded, totals = replicate_sums(wanted, row_key, replicates, seed, max(1, len(plan)))

    def fit(key: tuple, sums: pd.DataFrame, products: pd.DataFrame) -> pd.DataFrame:
        own = fit_folded(sums, np.asarray(products["products"].iloc[0]), p, *plan[key[0]])
        return pd.DataFrame([{"fit": key[0], **own}])

    each = (folded.groupBy("fit", "replicate").cogroup(totals.groupBy("fit", "replicate"))
            .applyInPandas(fit, "fit string, tp double, th double, sigma2 double, structure string, "
                           "converged boolean, n_rows double").toPandas())
    shares = variance_components(each.assign(singular=False))
    tail = (1 - level) / 2
    return pd.DataFrame([
        {"fit": name, "component": component, "ci_lo": percentile_limit(own["pct_variance"].to_numpy(), tail),
         "ci_hi": percentile_limit(own["pct_variance"].to_numpy(), 1 - tail), "n_replicates": len(own)}
        for (name, component), own in shares.groupby(["fit", "component"])],
        columns=["fit", "component", "ci_lo", "ci_hi", "n_replicates"])
