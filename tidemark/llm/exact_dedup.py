"""Exact duplicates by tree-merging sorted runs of digests (DataFrame operations only).

Every input partition is a run. Round by round, ``fan_in`` neighbouring runs are merged on
(digest, second hash, byte length), and each level keeps the smallest identifier and the
count of every digest. Runs are spread over tasks by (group of runs, digest), so a merged
run is never one task, and a text that fills a third of the table sends one row per run.
The result goes back down the same way: root to runs, runs to rows.

Null text counts as empty. Null identifiers come last; rows with equal identifiers and
texts are told apart by their place, and one of them stays. Texts of any length are read whole and travel as digests. Other
columns are not read, unless carried. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

from .common import SPACE, id_order

DIGEST = ["digest", "check", "n_bytes"]


def digest_runs(docs: DataFrame, id_column: str, text_column: str,
                carry: dict | None = None) -> DataFrame:
    """One written row per document: digest of the normalised text, run and place in it."""
    carried = [c.alias(name) for name, c in (carry or {}).items()]
    text = F.regexp_replace(F.coalesce(F.col(text_column), F.lit("")), SPACE, " ")
    return materialise(
        docs.select(F.col(id_column).alias("doc_id"), *carried, text.alias("normal_text"),
                    F.spark_partition_id().alias("run"),
                    F.monotonically_increasing_id().alias("row"))
        .select("doc_id", *(carry or {}), "run", "row",
                F.unhex(F.sha2("normal_text", 256)).alias("digest"),
                F.xxhash64("normal_text").alias("check"),
                F.octet_length("normal_text").alias("n_bytes")), "digests")


def merge_runs(runs: DataFrame, n_runs: int, fan_in: int) -> DataFrame:
    """Merge sorted runs in rounds until one is left: digest, first identifier, size."""
    level = runs
    while n_runs > 1:
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
                 .groupBy("run", *DIGEST)
                 .agg(F.min("first").alias("first"), F.sum("size").alias("size")))
        n_runs = -(-n_runs // fan_in)
    return level.select(*DIGEST, F.col("first").alias("keep"), F.col("size").alias("group_size"))


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                fan_in: int = 16, carry: dict | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row, and ``carry`` columns.

    ``carry`` maps output names to columns of ``docs`` that go along with each row.
    """
    digests = digest_runs(docs, id_column, text_column, carry)
    n_runs = (digests.agg(F.max("run").alias("last")).first()["last"] or 0) + 1
    runs = digests.groupBy("run", *DIGEST).agg(F.min(id_order()).alias("first"),
                                               F.count(F.lit(1)).alias("size"))
    root = merge_runs(runs, n_runs, fan_in)
    per_run = runs.select("run", *DIGEST).join(root, DIGEST)
    return (digests.join(per_run, ["run", *DIGEST])
            .select("doc_id", F.col("keep.id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("keep.row")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"), *(carry or {})))
