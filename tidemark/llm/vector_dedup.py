"""Near-duplicate vectors through a pivot-permutation index.

Reference points (``pivots`` per vector length, drawn by a hash from the distinct vectors) give each
vector its ordered list of the ``nearest`` closest ones. The index is the inverted lists
(label, pivot) -> vectors. Two vectors are candidates if they share at least ``shared``
pivots, so each is posted under its first nearest - shared + 1 pivots in pivot order only: two
vectors that share enough must meet there. Lists are compared in blocks by matrix products,
a pair in the first list in which it meets; candidates are verified by their cosine in double
precision. A block sends on link counts and a spanning forest of its links, never pairs.

Equal vectors of a label are one class with a multiplicity, so a vector that fills a third
of the table is one entry. Every vector is indexed; only the reference points are a sample.

Vectors with a null label, null, empty or zero vectors and those with null or non-finite components
link with nothing. Vectors of different lengths never link. Null identifiers come last;
rows that repeat an identifier are rows of their own. Only the three named columns are read, so other columns may have any
name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

from .common import by_group, components, dealt_in_blocks, id_order, matrix, uniform_of

PIVOTS, NEAREST, SHARED = 256, 8, 3
BLOCK = 1024
MAX_LENGTHS = 64


def usable_vectors(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """vec_id, label, row, and the components as bytes (null if the vector cannot link); written."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for label, value in zip(batch.column("label"), batch.column("vector"), strict=True):
                own = value.as_py()
                good = label.is_valid and own is not None and None not in own
                own = np.array(own, np.float64) if good else np.zeros(0)
                good = len(own) and np.isfinite(own).all() and own.any()
                packed.append(own.tobytes() if good else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "label", "row")), pa.array(packed, pa.binary())],
                ["vec_id", "label", "row", "packed"])

    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"),
                          F.monotonically_increasing_id().alias("row"), F.col(vector_column).alias("vector"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return materialise(rows.mapInArrow(
        pack, f"vec_id {kinds['vec_id']}, label {kinds['label']}, row bigint, packed binary"), "vectors")


def reference_points(classes: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """Unit reference vectors by number of bytes: those with the smallest hash."""
    sizes = classes.groupBy(F.octet_length("packed").alias("size")).agg(
        F.count(F.lit(1)).alias("n")).limit(MAX_LENGTHS + 1).collect()
    if len(sizes) > MAX_LENGTHS:
        raise ValueError(f"more than {MAX_LENGTHS} different vector lengths")
    points = {}
    for size, n in sizes:
        share = uniform_of("packed") < min(1.0, 4 * pivots / n)  # some more than are kept
        drawn = (classes.where((F.octet_length("packed") == size) & share).select("packed").distinct()
                 .orderBy(F.xxhash64("packed"), "packed").limit(pivots).collect())
        whole = np.vstack([np.frombuffer(r["packed"], np.float64) for r in drawn])
        points[size] = whole / np.linalg.norm(whole, axis=1, keepdims=True)
    return points


def describe(classes: DataFrame, points: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """Each class with its nearest reference points in order of distance."""
    shared = classes.sparkSession.sparkContext.broadcast(points)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for value in batch.column("packed").to_pylist():
                own = np.frombuffer(value, np.float64)
                close = shared.value[len(value)] @ (own / np.linalg.norm(own))
                lists.append(np.argsort(-close, kind="stable")[:nearest].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists, pa.list_(pa.int32()))], [*batch.schema.names, "pivots"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(order, f"{kinds}, pivots array<int>")


def linked(group: dict[str, np.ndarray], threshold: float, shared: int, pivots: int) -> tuple:
    """(nodes, link counts, roots) of one pair of blocks of an inverted list."""
    within = group["low"][0] == group["high"][0]
    first = np.flatnonzero(group["block"] == group["low"][0])
    second = first if within else np.flatnonzero(group["block"] == group["high"][0])
    if not len(first) or not len(second):
        return (), (), ()
    vectors, lists = group["packed"], group["pivots"]
    width = lists.shape[1]
    member = np.zeros((len(lists), pivots), np.float32)
    np.put_along_axis(member, lists.astype(np.int64), 1, axis=1)
    # posted under the first pivots in pivot order: an earlier common posting owns the pair
    posted = np.sort(lists, axis=1)[:, :width - shared + 1] if width >= shared else np.sort(lists, axis=1)
    before = np.zeros_like(member)
    np.put_along_axis(before, posted.astype(np.int64), 1, axis=1)
    before[:, group["pivot"][0]:] = 0
    enough = min(shared, width)
    links = member[first] @ member[second].T >= enough
    links &= before[first] @ before[second].T == 0
    norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    cosine = (vectors[first] @ vectors[second].T) / (norm[first][:, None] * norm[second])
    links &= cosine >= threshold
    if within:
        np.fill_diagonal(links, False)
        links = np.logical_or(links, links.T)
    size = group["size"].astype(np.float64)
    count = np.zeros(len(lists))
    count[first] += links @ size[second]
    if not within:
        count[second] += links.T @ size[first]
    # roots: smallest member reachable within the block
    nodes = group["node"]
    root = np.arange(len(nodes))
    rank = np.argsort(np.argsort(nodes))
    label = rank.copy()
    while True:
        old = label.copy()
        label[second] = np.minimum(label[second], np.where(links, label[first][:, None], len(nodes)).min(axis=0))
        label[first] = np.minimum(label[first], np.where(links, label[second], len(nodes)).min(axis=1))
        if (label == old).all():
            break
    root = np.sort(nodes)[label]
    some = np.flatnonzero(count)
    return nodes[some], count[some].astype(np.int64), root[some]


def vector_dedup(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                 label_column: str = "label", threshold: float = 0.98, pivots: int = PIVOTS,
                 nearest: int = NEAREST, shared: int = SHARED) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = usable_vectors(vectors, id_column, vector_column, label_column)
    usable = rows.where("packed IS NOT NULL")
    classes = materialise(usable.groupBy("label", "packed").agg(
        F.min("row").alias("node"), F.min(id_order("vec_id")).alias("first"),
        F.count(F.lit(1)).alias("size")), "classes")
    points = reference_points(classes, pivots)
    lists = materialise(describe(classes.select("label", "node", "size", "packed"), points, nearest), "pivot-lists")
    posted = lists.select("*", F.octet_length("packed").alias("bytes"), F.explode(
        F.slice(F.array_sort("pivots"), 1, F.greatest(F.size("pivots") - F.lit(shared - 1), F.lit(1)))).alias("pivot"))
    keys = ["list"]
    lengths = posted.groupBy("label", "bytes", "pivot").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n")).where("n > 1")
    named = materialise(lengths.select("label", "bytes", "pivot", "blocks",
                                       F.monotonically_increasing_id().alias("list")), "lists")
    dealt = dealt_in_blocks(posted.join(named, ["label", "bytes", "pivot"])
                            .select("list", "pivot", "blocks", "node", "size", "packed", "pivots"),
                            keys, "node", "blocks")

    def arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        # vectors of one list have one length; a batch may hold several lists
        out = {c: batch.column(c).to_numpy(zero_copy_only=False)
               for c in ("list", "low", "high", "block", "pivot", "node", "size")}
        for c, kind in (("packed", np.float64), ("pivots", np.int32)):
            out[c] = np.empty(batch.num_rows, object)
            for k, value in enumerate(batch.column(c).to_pylist()):
                out[c][k] = np.frombuffer(value, kind) if c == "packed" else np.array(value, kind)
        return out

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in by_group(batches, ["list", "low", "high"], arrays):
            for group in groups:
                stacked = group | {c: np.vstack(group[c]) for c in ("packed", "pivots")}
                nodes, count, root = linked(stacked, threshold, shared, pivots)
                if len(nodes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes), pa.array(count), pa.array(root)], ["node", "links", "root"])

    found = materialise(dealt.mapInArrow(compare, "node bigint, links bigint, root bigint"), "links")
    labels = components(found, "node", "root")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named_classes = (classes.join(counts, "node", "left").join(labels, "node", "left")
                     .select("label", "packed", "first",
                             (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                             F.coalesce("component", "node").alias("component")))
    firsts = named_classes.groupBy("component").agg(F.min("first").alias("keep"))
    per_class = named_classes.join(firsts, "component").select("label", "packed", "n_links", "keep")
    # a class with many rows is met once per block of rows
    spread = rows.withColumn("block", F.shiftright("row", 33))
    per_block = (spread.where("packed IS NOT NULL").select("label", "packed", "block").distinct()
                 .join(per_class, ["label", "packed"]))
    return spread.join(per_block, ["label", "packed", "block"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("keep").isNotNull(), F.col("keep.id")).otherwise(F.col("vec_id")).alias("component_id"),
        F.coalesce(F.col("row") == F.col("keep.row"), F.lit(True)).alias("kept"))
