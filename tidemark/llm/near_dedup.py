"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass over the texts writes, per document, the size and digest of its shingle set, a
   min-hash signature and one key per band. Documents with the same set are one class.
2. Candidates are classes that share a band key. A bucket is not expanded into pairs: its
   members are first compared with one leader, the member that meets most others over all
   bands, and what the leader joins is known to be connected. Buckets that then still hold
   different components are compared in blocks, across components, with each pair of
   signatures met in the first band it shares; only pairs that survive leave the block.
3. A candidate pair is verified in sequence: batches of the signatures are compared, and a
   pair goes once the posterior probability (uniform prior) of a similarity at or above the
   threshold is under ``miss``. Survivors are confirmed on the full shingle sets.
4. Components of the confirmed links, joined back to classes and documents.

With 40 bands of 5 rows a pair at similarity 0.75 shares no band with probability 2e-5.
Shingles are compared by 64-bit hashes. No bucket, partner list or text is capped.

Null, empty or blank texts have no shingles and link with nothing. Null identifiers come
last. Rows that repeat an identifier and text are one class, and one of them stays. Very long
texts are whole sets in one task. Only the two named columns are read, so other columns may have any name. An
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

from .common import by_group, components, dealt_in_blocks, id_order, matrix
from .shingles import MinHash, mix, set_digest, shingle_set

BANDS, ROWS, HASHES = 40, 5, 400
SEED = 7
BLOCK = 4096  # members of a bucket that one block holds


def prune_table(n: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """(hashes compared, fewest matches to go on) after each batch.

    With m of n matching and a uniform prior, the posterior is Beta(m+1, n-m+1), and its
    mass above the threshold is the chance of at most m successes in n+1 trials. Signatures
    keep 8 bits a hash, so unequal hashes match once in 256 times.
    """
    table = []
    threshold += (1 - threshold) / 256
    for seen in range(batch, n + 1, batch):
        mass, least = 0.0, 0
        for m in range(seen + 1):
            mass += math.comb(seen + 1, m) * threshold**m * (1 - threshold)**(seen + 1 - m)
            if mass >= miss:
                break
            least = m + 1
        table.append((seen, least))
    return table


def sketches(docs: DataFrame, width: int, bands: int, rows: int, hashes: int) -> DataFrame:
    """Size, digest, signature (8 bits a hash) and band keys of each document, written."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = MinHash(hashes, SEED)
        salts = mix(np.arange(1, bands + 1, dtype=np.uint64))
        weights = mix(np.arange(101, 101 + rows, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            size, digest, signature, keys = [], [], [], []
            for text in batch.column("text"):
                own = shingle_set(text.as_py(), width)
                size.append(len(own))
                if not len(own):
                    digest.append(None), signature.append(None), keys.append(None)
                    continue
                low = signer(own)
                digest.append(set_digest(own))
                signature.append(low.astype(np.uint8).tobytes())  # low bits: minima are small
                by_band = (low[:bands * rows].reshape(bands, rows).astype(np.uint64) * weights).sum(axis=1)
                keys.append(mix(by_band ^ salts).view(np.int64))
            kept = [batch.column(c) for c in ("doc_id", "key", "row")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(size, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(signature, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "key", "row", "n_shingles", "digest", "signature", "bands"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return materialise(docs.mapInArrow(
        sketch, f"doc_id {kinds['doc_id']}, key {kinds['key']}, row bigint, n_shingles bigint, "
        "digest binary, signature binary, bands array<bigint>"), "sketches")


def go_on(left: np.ndarray, right: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Places of the pairs (rows of two signature arrays) that no batch prunes."""
    alive, begin = np.arange(len(right)), 0
    matches = np.zeros(len(right), np.int64)
    for seen, least in steps:
        one = left if left.ndim == 1 else left[alive]
        matches[alive] += (one[..., begin:seen] == right[alive, begin:seen]).sum(axis=1)
        alive = alive[matches[alive] >= least]
        begin = seen
        if not len(alive):
            break
    return alive


def survivors(pairs: DataFrame, candidates: DataFrame, threshold: float,
              steps: list[tuple[int, int]]) -> DataFrame:
    """Candidate pairs that no batch of their signatures prunes."""
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive = pa.array(go_on(matrix(batch.column("sig_a"), np.uint8),
                                       matrix(batch.column("sig_b"), np.uint8), steps))
                yield batch.select(["a", "b"]).take(alive)

    of = candidates.select(F.col("node").alias("a"), F.col("signature").alias("sig_a"),
                           F.col("n_shingles").alias("n_a"))
    to = candidates.select(F.col("node").alias("b"), F.col("signature").alias("sig_b"),
                           F.col("n_shingles").alias("n_b"))
    return (pairs.join(of, "a").join(to, "b")
            .where(F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b"))
            .select("a", "b", "sig_a", "sig_b").mapInArrow(prune, "a bigint, b bigint"))


def leader_pairs(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's most central member."""
    central = members.groupBy("node").agg(F.sum("n").alias("met"))
    known = members.join(central, "node")
    leaders = known.groupBy("band", "bucket").agg(
        F.max(F.struct("met", (-F.col("node")).alias("first"))).alias("leader"))
    return (members.join(leaders.select("band", "bucket", (-F.col("leader.first")).alias("b")),
                         ["band", "bucket"])
            .where("node <> b").select(F.col("node").alias("a"), "b").distinct())


def block_pairs(members: DataFrame, labels: DataFrame, candidates: DataFrame, threshold: float,
                steps: list[tuple[int, int]]) -> DataFrame:
    """Surviving pairs of different components in the buckets that still hold several."""
    labelled = (members.join(labels, "node", "left")
                .withColumn("component", F.coalesce("component", "node")))
    open_ = (labelled.groupBy("band", "bucket")
             .agg(F.min("component").alias("low"), F.max("component").alias("high"),
                  F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
             .where("low <> high").select("band", "bucket", "blocks"))
    rows = labelled.drop("n").join(open_, ["band", "bucket"]).join(
        candidates.select("node", "n_shingles", "signature", "tags"), "node")
    dealt = dealt_in_blocks(rows, ["band", "bucket"], "node", "blocks")

    def compare(group: dict) -> list[tuple[int, int]]:
        found = []
        node, part = group["node"], group["component"]
        within = group["low"][0] == group["high"][0]
        first = np.arange(len(node)) if within else np.flatnonzero(group["block"] == group["low"][0])
        second = first if within else np.flatnonzero(group["block"] == group["high"][0])
        band = int(group["band"][0])
        for k, i in enumerate(first):
            others = second[k + 1:] if within else second
            size = group["n_shingles"][others]
            own = group["n_shingles"][i]
            others = others[(part[others] != part[i]) & (np.minimum(size, own) >= threshold * np.maximum(size, own))]
            if not len(others):
                continue
            others = others[go_on(group["signature"][i], group["signature"][others], steps)]
            if band and len(others):
                met = (group["tags"][others, :band] == group["tags"][i, :band]).any(axis=1)
                others = others[~met]
            found += [(int(node[i]), int(node[j])) for j in others]
        return found

    def arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        plain = ("band", "bucket", "low", "high", "block", "node", "component", "n_shingles")
        return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in plain} | {
            "signature": matrix(batch.column("signature"), np.uint8),
            "tags": matrix(batch.column("tags"), np.uint32)}

    def survive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in by_group(batches, ["band", "bucket", "low", "high"], arrays):
            found = [pair for group in groups for pair in compare(group)]
            if found:
                left, right = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(survive, "a bigint, b bigint")


def confirm(pairs: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold, exactly (in hundredths)."""
    hundredths = round(100 * threshold)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            hit = []
            for a, b, left, right in zip(*(batch.column(c) for c in ("a", "b", "text_a", "text_b")),
                                         strict=True):
                if last is None or b.as_py() != last:
                    last, last_set = b.as_py(), shingle_set(right.as_py(), width)
                own = shingle_set(left.as_py(), width)
                both = np.intersect1d(own, last_set, assume_unique=True).size
                hit.append(100 * both >= hundredths * (own.size + last_set.size - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(hit, pa.bool_())),
                 batch.column("b").filter(pa.array(hit, pa.bool_()))], ["a", "b"])

    joined = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
              .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return joined.mapInArrow(check, "a bigint, b bigint")


def near_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               width: int = 5, threshold: float = 0.75, bands: int = BANDS, rows: int = ROWS,
               hashes: int = HASHES, batch: int = 25, miss: float = 1e-4,
               key: Column | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and the row key of every row.

    ``key`` names each row again in a second scan (``parquet_row_key`` for parquet tables);
    without it the identifiers and texts are written once to have such a key.
    """
    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"),
                        *([] if key is None else [key.alias("key")]))
    if key is None:
        plain = materialise(plain.withColumn("key", F.monotonically_increasing_id()), "texts")
    sketched = sketches(plain.withColumn("row", F.monotonically_increasing_id()),
                        width, bands, rows, hashes)
    with_words = sketched.where("n_shingles > 0")
    # a class is all documents with one shingle set; its node is the smallest row of it
    classes = materialise(
        with_words.groupBy("digest", "n_shingles")
        .agg(F.min("row").alias("node"), F.min(id_order()).alias("first")), "classes")
    nodes = with_words.select(F.col("row").alias("node"), "key", "n_shingles", "signature", "bands") \
        .join(classes.select("node"), "node", "left_semi")
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = buckets.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialise(buckets.join(shared, ["band", "bucket"])
                          .select("band", "bucket", "node", "n"), "members")
    candidates = materialise(
        nodes.join(members.select("node").distinct(), "node", "left_semi")
        .select("node", "key", "n_shingles", "signature", _tags("bands").alias("tags")), "candidates")
    texts = materialise(plain.select("key", "text").join(candidates.select("node", "key"), "key")
                        .select("node", "text"), "candidate-texts")
    steps = prune_table(hashes, batch, threshold, miss)

    near_leaders = survivors(leader_pairs(members), candidates, threshold, steps)
    links = materialise(confirm(near_leaders, texts, width, threshold), "links")
    labels = components(links)
    across = block_pairs(members, labels, candidates, threshold, steps)
    more = materialise(confirm(across, texts, width, threshold), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    named = (classes.join(labels, "node", "left")
             .select("digest", "n_shingles", "first",
                     F.coalesce("component", "node").alias("component")))
    firsts = named.groupBy("component").agg(F.min("first").alias("keep"))
    per_class = named.join(firsts, "component").select("digest", "n_shingles", "keep")
    per_run = _spread_classes(sketched, per_class)
    return per_run.select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("keep.id")).otherwise(F.col("doc_id"))
        .alias("component_id"),
        ((F.col("n_shingles") == 0) | (F.col("row") == F.col("keep.row"))).alias("kept"), "key")


def _tags(bands: str) -> Column:
    """The last 32 bits of each band key, as bytes."""
    return F.unhex(F.array_join(F.transform(bands, lambda k: F.lpad(
        F.hex(k.bitwiseAND(0xFFFFFFFF)), 8, "0")), ""))


def _spread_classes(sketched: DataFrame, per_class: DataFrame) -> DataFrame:
    """Bring class results to rows; a class with many rows is met once per block of rows."""
    rows = sketched.select("doc_id", "key", "row", "n_shingles", "digest",
                           F.shiftright("row", 33).alias("block"))
    per_block = (rows.where("n_shingles > 0").select("digest", "n_shingles", "block").distinct()
                 .join(per_class, ["digest", "n_shingles"]))
    return rows.join(per_block, ["digest", "n_shingles", "block"], "left")
