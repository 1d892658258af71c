"""Helpers shared by the operators: shared scratch, row keys, prefix sums and components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def parquet_row_key() -> Column:
    """A key of a row that every scan of the same parquet files gives again.

    Only for frames that come straight from ``spark.read.parquet``.
    """
    return F.struct(F.xxhash64("_metadata.file_path").alias("file"),
                    F.col("_metadata.row_index").alias("line"))


def uniform_of(*columns: str) -> Column:
    """A number in [0, 1) fixed by the values, to draw a sample without sorting the table."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / float(2**53)


def id_order(id_column: str = "doc_id", row: str = "row") -> Column:
    """Smallest identifier first, null last, equal identifiers by row number."""
    return F.struct(F.col(id_column).isNull().alias("unnamed"),
                    F.col(id_column).alias("id"), F.col(row).alias("row"))


def drop_written(*frames: DataFrame) -> None:
    """Delete the files of materialised frames that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node in ``links``; component is the smallest node.

    Each round hooks every node to its smallest neighbour, follows the pointers to their
    roots, and contracts the links to pairs of different roots; the number of roots at
    least halves per round. Hooks are a partial aggregation and joins are split by Spark
    where a hub is hot. All state lies in written tables.
    """
    edges = materialise(links.select(F.col(a).alias("a"), F.col(b).alias("b"))
                        .where("a <> b").distinct(), "links")
    labels: DataFrame | None = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialise(both.groupBy(F.col("a").alias("node"))
                            .agg(F.least(F.min("b"), F.col("node")).alias("root")), "hooks")
        hooks = _to_roots(hooks)
        if labels is None:
            merged = hooks
        else:
            merged = materialise(labels.join(
                hooks.select(F.col("node").alias("root"), F.col("root").alias("next")),
                "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels")
        root_a = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        root_b = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        rest = materialise(
            edges.join(root_a, "a").join(root_b, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(), "links")
        if labels is not None:
            drop_written(labels)
            drop_written(hooks)
        drop_written(edges)
        labels, edges = merged, rest
        if edges.isEmpty():
            return labels.select("node", F.col("root").alias("component"))


def _to_roots(hooks: DataFrame) -> DataFrame:
    """Replace each pointer by the root it leads to (pointers always lead downwards)."""
    while True:
        onward = hooks.select(F.col("node").alias("root"), F.col("root").alias("next")) \
            .where("root <> next")
        moved = materialise(
            hooks.join(onward, "root", "left")
            .select("node", F.coalesce("next", "root").alias("root"),
                    F.col("next").isNotNull().alias("moved")), "hooks")
        drop_written(hooks)
        hooks = moved.select("node", "root")
        if moved.where("moved").isEmpty():
            return hooks


def matrix(column: pa.Array, kind: type | str) -> np.ndarray:
    """A binary column with values of one length as rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str],
             convert: Callable[[pa.RecordBatch], dict[str, np.ndarray]]
             ) -> Iterator[list[dict[str, np.ndarray]]]:
    """Rows of equal keys together, from a partition that is sorted by ``keys``.

    ``convert`` turns a batch into arrays of one row each, keys included. What is held is one
    batch and the group that is still open.
    """
    held = None
    for batch in _with_end(batches):
        if batch is not None:
            if not batch.num_rows:
                continue
            new = convert(batch)
            held = new if held is None else {c: np.concatenate((held[c], new[c])) for c in new}
        if held is None:
            continue
        at = np.column_stack([held[c] for c in keys])
        cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist()]
        ends = [*cuts[1:], len(at)]
        complete = len(cuts) if batch is None else len(cuts) - 1
        yield [{c: v[a:b] for c, v in held.items()}
               for a, b in zip(cuts[:complete], ends[:complete], strict=True)]
        held = None if batch is None else {c: v[cuts[-1]:].copy() for c, v in held.items()}


def _with_end(batches: Iterator) -> Iterator:
    """The batches, and None behind the last."""
    yield from batches
    yield None


def dealt_in_blocks(rows: DataFrame, keys: list[str], node: str, blocks: str) -> DataFrame:
    """Copies of the rows of a group for every pair of its blocks: ``low``, ``high`` and ``block``.

    A group of ``blocks`` blocks becomes blocks * (blocks + 1) / 2 groups of at most two blocks.
    """
    return (rows.withColumn("block", F.pmod(F.xxhash64(node), F.col(blocks)).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
            .withColumn("low", F.least("block", "other"))
            .withColumn("high", F.greatest("block", "other"))
            .drop("other", blocks)
            .repartition(*keys, "low", "high").sortWithinPartitions(*keys, "low", "high"))
