"""Nearest neighbours by largest inner product with cross-polytope hashing.

A fast pseudo-rotation (signs and a Hadamard transform, three times) turns each unit vector, and the nearest signed axis of
the rotated space is its hash; the first hash uses as many axes as the table needs buckets, and large tables
add a second rotation whose axes split the buckets further. A table of vectors keeps each of them in
one bucket of each of ``tables`` rotations. A query visits the ``probes`` buckets of least penalty (the sum over its
hashes of the squared distance between its best axis and the bucket's). Within a bucket, candidates and queries
are multiplied as matrices, in blocks, and the best are ranked again by the inner product in double precision.

For inner products the indexed vectors are scaled by the largest norm of their band (norms within a factor of two)
and get one more component that makes them unit vectors, so that the nearest direction is the largest product.
Each band is hashed by itself, so one long vector does not spoil the others. Vectors of different lengths do not meet.

* ``probes`` is fitted: a bounded sample of queries is compared with all vectors, and the least number is taken whose
  buckets hold the share ``recall`` of their true neighbours. Every vector is indexed; no candidate is dropped. A
  query that found fewer than ``k`` though more exist is searched again with eight times the probes, up to all buckets.
* Equal vectors are one class, searched once. Of a class only the ``k`` + 1 smallest identifiers can be among
  the nearest of any query, so only those are listed; this loses nothing.
* Probes go in rounds that grow eightfold: what a query has found bounds what the next round sends on, so a query costs
  some hundred rows however many buckets it visits.
* A bucket with more than ``BLOCK`` vectors (or a quarter of it in queries) is dealt in blocks over tasks.

Vectors that are null, empty or zero, or hold null or non-finite components, take no part. Null identifiers are no queries
and come last among equals; rows that repeat an identifier are rows of their own, and only the query's own
row is left out. Ties go to the smaller identifier, then the earlier row. An empty table gives no rows.
Only the two named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from tidemark.session import materialise

from .common import by_group, matrix, uniform_of

BLOCK = 4096
IN_BUCKET = 1024  # wanted vectors in a bucket
SAMPLE = 256  # queries to fit the probes


def lengths_of(vectors: np.ndarray) -> np.ndarray:
    """Norms of rows, free of overflow and underflow in the squares."""
    largest = np.abs(vectors).max(axis=1, initial=0.0)
    safe = np.where(largest > 0, largest, 1.0)
    with np.errstate(over="ignore"):
        return np.minimum(largest * np.sqrt(np.square(vectors / safe[:, None]).sum(axis=1)), 1.7e308)


def component_type(vectors: DataFrame, vector_column: str) -> str:
    return "f4" if vectors.schema[vector_column].dataType.elementType.simpleString() == "float" else "f8"


def usable_vectors(vectors: DataFrame, id_column: str, vector_column: str, is_query: Column) -> DataFrame:
    """vec_id, row, is_query, size, band, norm, packed components and their hashes of every vector that takes part; written."""
    kind = component_type(vectors, vector_column)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes[sizes > 0]).tolist():
                at = np.flatnonzero(sizes == size)
                own = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, size)
                good = np.isfinite(own).all(axis=1)  # a null component is read as nan
                good[good] = own[good].any(axis=1)
                at, own = pa.array(at[good]), own[good]
                norm = lengths_of(own.astype(np.float64))
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(at) for c in ("vec_id", "is_query", "row")), pa.array(np.full(n, size), pa.int32()),
                     pa.array(np.rint(np.log2(norm)), pa.int32()), pa.array(norm), pa.array([x.tobytes() for x in own], pa.binary())],
                    ["vec_id", "is_query", "row", "size", "band", "norm", "packed"])

    wide = "array<float>" if kind == "f4" else "array<double>"
    rows = vectors.select(
        F.col(id_column).alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.monotonically_increasing_id().alias("row"), F.col(vector_column).cast(wide).alias("vector"))
    name = rows.schema["vec_id"].dataType.simpleString()
    packed = rows.mapInArrow(pack, f"vec_id {name}, is_query boolean, row bigint, size int, band int, norm double, packed binary")
    return materialise(packed.withColumn("h1", F.xxhash64("packed")).withColumn("h2", F.xxhash64("packed", F.lit(1))), "vectors")


def _hadamard(x: np.ndarray) -> np.ndarray:
    rows, n, step = *x.shape, 1
    while step < n:
        pair = x.reshape(rows, -1, 2, step)
        x = np.stack((pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]), axis=2).reshape(rows, n)
        step *= 2
    return x / math.sqrt(n)


class Polytope:
    """The hashes of vectors of one length: ``tables`` rotations of one or two parts."""

    def __init__(self, size: int, count: int, tables: int, seed: int) -> None:
        self.width = 1 << max(0, math.ceil(math.log2(size + 1)))  # one component more, to fill up the norm
        wanted = max(1, count // IN_BUCKET)
        first = min(self.width, 1 << max(0, math.ceil(math.log2(max(1, wanted / 2)))))
        left = wanted / (2 * first)
        self.axes = [first] + ([min(self.width, 1 << math.ceil(math.log2(left)))] if left > 1 else [])
        rng = np.random.default_rng([seed, size])
        self.signs = rng.choice([-1.0, 1.0], (tables, len(self.axes), 3, self.width))
        self.buckets = math.prod(2 * a for a in self.axes)

    def _turned(self, unit: np.ndarray, table: int) -> list[np.ndarray]:
        """For each part the coordinates along its signed axes (positive ones first)."""
        out = []
        for part, axes in enumerate(self.axes):
            x = np.zeros((len(unit), self.width))
            x[:, :unit.shape[1]] = unit
            for signs in self.signs[table, part]:
                x = _hadamard(x * signs)
            out.append(np.concatenate((x[:, :axes], -x[:, :axes]), axis=1))
        return out

    def codes(self, vectors: np.ndarray, largest: float, table: int) -> np.ndarray:
        """Bucket of each indexed vector of a band whose largest norm is given."""
        x = vectors / largest
        fill = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", x, x)))
        code = np.zeros(len(x), np.int64)
        for along in self._turned(np.column_stack((x, fill)), table):
            code = code * along.shape[1] + along.argmax(axis=1)
        return code

    def penalties(self, queries: np.ndarray, table: int) -> list[np.ndarray]:
        unit = queries / lengths_of(queries)[:, None]
        return [(along.max(axis=1, keepdims=True) - along) ** 2 for along in self._turned(unit, table)]

    def probes(self, queries: np.ndarray, table: int, number: int) -> np.ndarray:
        """The ``number`` buckets of least penalty of each query."""
        number = min(number, self.buckets)
        parts = self.penalties(queries, table)
        order = [np.argsort(p, axis=1, kind="stable")[:, :number] for p in parts]
        if len(parts) == 1:
            return order[0]
        low = [np.take_along_axis(p, o, axis=1) for p, o in zip(parts, order, strict=True)]
        # the k-th smallest sum of two sorted lists has (i + 1)(j + 1) <= k
        i, j = np.nonzero(np.outer(np.arange(low[0].shape[1]) + 1, np.arange(low[1].shape[1]) + 1) <= number)
        total = low[0][:, i] + low[1][:, j]
        best = np.argsort(total, axis=1, kind="stable")[:, :number]
        return (np.take_along_axis(order[0], i[best], axis=1) * parts[1].shape[1]
                + np.take_along_axis(order[1], j[best], axis=1))

    def rank(self, parts: list[np.ndarray], code: int) -> int:
        """Which probe (from 1) a bucket is for one query; ``parts`` are the query's own penalties, sorted ones last."""
        if len(parts) == 2:
            return int(np.searchsorted(parts[1], parts[0][code] + 1e-12, "right"))
        split = len(parts[1])
        total = parts[0][code // split] + parts[1][code % split] + 1e-12
        return int(np.searchsorted(parts[2], total - parts[0], "right").sum())


class Plan:
    """Hashes by vector length and the largest norm by (length, band); a few numbers for each."""

    def __init__(self, classes: DataFrame, kind: str, tables: int, seed: int) -> None:
        self.kind, self.tables = kind, tables
        self.largest = {(r["size"], r["band"]): (r["norm"], r["n"]) for r in classes.groupBy("size", "band").agg(
            F.max("norm").alias("norm"), F.count(F.lit(1)).alias("n")).collect()}
        counts: dict[int, int] = {}
        for (size, _), (_, n) in self.largest.items():
            counts[size] = counts.get(size, 0) + n
        self.hashes = {size: Polytope(size, n, tables, seed) for size, n in counts.items()}

    def bands(self, size: int) -> list[int]:
        return sorted(band for own, band in self.largest if own == size)

    def vectors(self, column: pa.Array) -> np.ndarray:
        return matrix(column, self.kind).astype(np.float64)


def by_shape(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of a batch with equal values of ``columns``."""
    keys = list(zip(*(batch.column(c).to_pylist() for c in columns), strict=True))
    for key in dict.fromkeys(keys):
        yield key, batch.take(pa.array([k for k, own in enumerate(keys) if own == key], pa.int64()))


def best_pairs(queries: np.ndarray, others: np.ndarray, names: np.ndarray, k: int,
               bound: np.ndarray | float = -math.inf) -> tuple[np.ndarray, ...]:
    """(query, other, product) of the ``k`` largest products of each query from its bound on, ties to smaller names."""
    rough = queries @ others.T
    least = np.broadcast_to(bound, len(queries))
    if len(others) > k:
        least = np.maximum(least, np.partition(rough, len(others) - k, axis=1)[:, len(others) - k])
    slack = 1e-9 * np.linalg.norm(queries, axis=1) * np.linalg.norm(others, axis=1).max()
    at, other = np.nonzero(rough >= (least - slack)[:, None])
    score = (queries[at] * others[other]).sum(axis=1)
    held = score >= np.broadcast_to(bound, len(queries))[at]
    at, other, score = at[held], other[held], score[held]
    order = np.lexsort((names[other], -score, at))
    at, other, score = at[order], other[order], score[order]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    keep = place < k
    return at[keep], other[keep], score[keep]


def fitted_probes(classes: DataFrame, plan: Plan, k: int, recall: float) -> int:
    """The least number of probes whose buckets hold ``recall`` of the neighbours of a sample of queries."""
    asked = classes.where("is_query")
    share = min(1.0, 4 * SAMPLE / max(asked.count(), 1))  # some more than are kept
    sample = (asked.where(uniform_of("h1", "h2") < share).orderBy(F.xxhash64("h2"), "cls").limit(SAMPLE)
              .select("cls", "size", "packed").collect())
    by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in {r["size"] for r in sample}:
        own = [r for r in sample if r["size"] == size]
        by_size[size] = (np.array([r["cls"] for r in own]),
                         np.vstack([np.frombuffer(r["packed"], plan.kind).astype(np.float64) for r in own]))
    shared = classes.sparkSession.sparkContext.broadcast((plan, by_size))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, by_size = shared.value
        for batch in batches:
            for (size, band), rows in by_shape(batch, "size", "band"):
                if size not in by_size:
                    continue
                names, queries = by_size[size]
                others, cls = plan.vectors(rows.column("packed")), rows.column("cls").to_numpy()
                at, other, score = best_pairs(queries, others, cls, k + 1)
                use = names[at] != cls[other]
                at, other, score = at[use], other[use], score[use]
                codes = [plan.hashes[size].codes(others[other], plan.largest[size, band][0], t) for t in range(plan.tables)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[at]), pa.array(cls[other]), pa.array(score),
                     pa.array(list(np.transpose(codes)), pa.list_(pa.int64()))], ["query", "cls", "score", "codes"])

    nearest = W.partitionBy("query").orderBy(F.desc("score"), "cls")
    true = (classes.select("cls", "size", "band", "packed")
            .mapInArrow(compare, "query bigint, cls bigint, score double, codes array<bigint>")
            .withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k).select("query", "codes").collect())
    ranks = []
    for size, (names, queries) in by_size.items():
        hashes = plan.hashes[size]
        parts = [hashes.penalties(queries, t) for t in range(plan.tables)]
        sorted_ones = [np.sort(p[-1], axis=1) for p in parts]
        at = {name: q for q, name in enumerate(names.tolist())}
        for row in true:
            if (q := at.get(row["query"])) is not None:
                ranks.append(min(hashes.rank([*(x[q] for x in own), low[q]], code)
                                 for own, low, code in zip(parts, sorted_ones, row["codes"], strict=True)))
    return sorted(ranks)[min(len(ranks) - 1, math.ceil(recall * len(ranks)))] if ranks else 1


def postings(rows: DataFrame, plan: Plan, probes: tuple[int, int] | None) -> DataFrame:
    """Rows (size, band, tab, bucket, cls, bound, packed) of the index, or of queries with some of their probes."""
    shared = rows.sparkSession.sparkContext.broadcast(plan)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            for (size, band), rows in by_shape(batch, "size", "band"):
                own, hashes = plan.vectors(rows.column("packed")), plan.hashes[size]
                for table in range(plan.tables):
                    if probes is None:
                        yield placed(rows, band, table, hashes.codes(own, plan.largest[size, band][0], table)[:, None])
                        continue
                    for low in range(0, len(own), 1024):
                        codes = hashes.probes(own[low:low + 1024], table, probes[1])[:, probes[0]:]
                        for other in plan.bands(size):
                            yield placed(rows.slice(low, 1024), other, table, codes)

    def placed(rows: pa.RecordBatch, band: int, table: int, codes: np.ndarray) -> pa.RecordBatch:
        again = rows.take(pa.array(np.repeat(np.arange(rows.num_rows), codes.shape[1]), pa.int64()))
        n = again.num_rows
        return pa.RecordBatch.from_arrays(
            [again.column("size"), pa.array(np.full(n, band), pa.int32()), pa.array(np.full(n, table), pa.int32()),
             pa.array(codes.ravel().astype(np.int64)), again.column("cls"), again.column("bound"), again.column("packed")],
            ["size", "band", "tab", "bucket", "cls", "bound", "packed"])

    return rows.select("size", "band", "cls", "bound", "packed").mapInArrow(
        post, "size int, band int, tab int, bucket bigint, cls bigint, bound double, packed binary")


def search_round(classes: DataFrame, asked: DataFrame, plan: Plan, k: int, probes: tuple[int, int],
                 before: DataFrame | None) -> DataFrame:
    """The ``k`` + 1 nearest classes (query, cls, score) of each query class in these probes and ``before``; written.

    What is no nearer than the ``k`` + 1 found before leaves no task.
    """
    key = ["size", "band", "tab", "bucket"]
    index = postings(classes.withColumn("bound", F.lit(None).cast("double")), plan, None)
    if before is None:
        bounded = asked.withColumn("bound", F.lit(-math.inf))
    else:
        full = (before.groupBy(F.col("query").alias("cls")).agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > k).drop("n"))
        bounded = asked.join(full, "cls", "left").fillna(-math.inf, ["bound"])
    queries = postings(bounded, plan, probes)
    blocks = {}
    for name, posted, rows in (("c_blocks", index, BLOCK), ("q_blocks", queries, BLOCK // 4)):
        large = posted.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows)
        blocks[name] = materialise(large.select(*key, F.ceil(F.col("n") / rows).cast("int").alias(name)), "blocks")

    def dealt(posted: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        """Each row in one block of its own side, for every block of the other side."""
        both = posted.join(blocks[own], key, "left").join(blocks[other], key, "left").fillna(1, [own, other])
        mine = F.pmod(F.xxhash64("cls"), F.col(own)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        names = ("q_block", "c_block") if asks else ("c_block", "q_block")
        return both.select(*key, mine.alias(names[0]), theirs.alias(names[1]), F.lit(asks).alias("asks"), "cls", "bound", "packed")

    parts = [*key, "c_block", "q_block"]
    met = (dealt(index, "c_blocks", "q_blocks", False).unionByName(dealt(queries, "q_blocks", "c_blocks", True))
           .repartition(*parts).sortWithinPartitions(*parts))
    shared = classes.sparkSession.sparkContext.broadcast(plan)

    def convert(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        packed = np.empty(batch.num_rows, object)
        packed[:] = batch.column("packed").to_pylist()
        return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*parts, "asks", "cls", "bound")} | {"packed": packed}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in by_group(batches, parts, convert):
            for group in groups:
                asks = group["asks"]
                if asks.all() or not asks.any():
                    continue
                q, c = (shared.value.vectors(pa.array(group["packed"][side].tolist(), pa.binary())) for side in (asks, ~asks))
                q_names, c_names = group["cls"][asks], group["cls"][~asks]
                at, other, score = best_pairs(q, c, c_names, k + 1, group["bound"][asks])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_names[at]), pa.array(c_names[other]), pa.array(score)], ["query", "cls", "score"])

    found = met.mapInArrow(search, "query bigint, cls bigint, score double")
    if before is not None:
        found = found.unionByName(before)
    # a class found in several tables has one dense rank, so the cut is right before the repeats go
    nearest = W.partitionBy("query").orderBy(F.desc("score"), "cls")
    return materialise(found.withColumn("place", F.dense_rank().over(nearest)).where(F.col("place") <= k + 1)
                       .groupBy("query", "cls").agg(F.max("score").alias("score")), "found")


def nearest_vectors(vectors: DataFrame, is_query: Column, id_column: str = "vec_id", vector_column: str = "embedding",
                    k: int = 20, tables: int = 2, recall: float = 0.95, probes: int | None = None, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found for every row where ``is_query`` holds."""
    rows = usable_vectors(vectors, id_column, vector_column, is_query & F.col(id_column).isNotNull())
    one = ["h1", "h2", "size"]
    named = F.struct(F.col("vec_id").isNull().alias("unnamed"), F.col("vec_id").alias("id"), F.col("row").alias("row"))
    smallest = W.partitionBy(*one).orderBy("member")
    listed = (rows.select(*one, named.alias("member")).withColumn("place", F.row_number().over(smallest))
              .where(F.col("place") <= k + 1).groupBy(*one).agg(F.sort_array(F.collect_list("member")).alias("members")))
    whole = rows.groupBy(*one).agg(F.max("is_query").alias("is_query"), F.first("band").alias("band"),
                                   F.first("norm").alias("norm"), F.first("packed").alias("packed"))
    # classes are numbered by their smallest members, so equal products go to smaller identifiers everywhere
    numbered = materialise(listed.repartitionByRange(F.col("members")[0]).sortWithinPartitions(F.col("members")[0])
                           .withColumn("cls", F.monotonically_increasing_id()), "members")
    classes = materialise(whole.join(numbered, one), "classes")
    plan = Plan(classes, component_type(vectors, vector_column), tables, seed)
    asked = classes.where("is_query").select("cls", "size", "band", "packed")
    probes = probes or fitted_probes(classes, plan, k, recall)
    of_size = {size: sum(n for (s, _), (_, n) in plan.largest.items() if s == size) for size in plan.hashes}
    most = max((h.buckets for h in plan.hashes.values()), default=1)
    enough = F.lit(0)
    for size, n in of_size.items():
        enough = F.when(F.col("size") == size, F.lit(min(k, n - 1))).otherwise(enough)
    levels = [probes]
    while levels[0] > 8:
        levels.insert(0, -(-levels[0] // 8))
    found, low = None, 0
    for high in levels:
        found, low = search_round(classes, asked, plan, k, (low, high), found), high
    while low < most:
        held = found.where("query <> cls").groupBy(F.col("query").alias("cls")).agg(F.count(F.lit(1)).alias("held"))
        short = asked.join(held, "cls", "left").where(F.coalesce("held", F.lit(0)) < enough).drop("held")
        asked = materialise(short, "short")
        if asked.isEmpty():
            break
        names = asked.select(F.col("cls").alias("query"))
        again = search_round(classes, asked, plan, k, (low, 8 * low), found.join(names, "query", "left_semi"))
        found, low = found.join(names, "query", "left_anti").unionByName(again), 8 * low
    # classes to rows: k + 1 nearest members, then each query row leaves itself out
    member = F.explode("members").alias("member")
    near = found.join(classes.select("cls", member), "cls").select(
        "query", "score", "member", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "member")).alias("place"))
    lists = (near.where(F.col("place") <= k + 1).groupBy("query")
             .agg(F.sort_array(F.collect_list(F.struct("place", "score", "member"))).alias("list")))
    of_class = classes.where("is_query").select(F.col("cls").alias("query"), *one).join(lists, "query")
    # own rows outside the smallest k + 1 of a class do not occur in the list; the cut then drops its last entry
    own = F.filter("list", lambda x: x["member"]["row"] != F.col("row"))
    out = rows.where("is_query").select("vec_id", "row", *one).join(of_class, one).select(
        F.col("vec_id").alias("query_id"), F.posexplode(F.slice(own, 1, k)).alias("pos", "hit"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.member.id").alias("vec_id"),
                      F.col("hit.score").alias("score"))
