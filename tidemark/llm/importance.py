"""Drawing documents whose hashed n-gram counts resemble a target text collection.

A 256-byte table turns A-Z into a-z and every separator into a space, in UTF-8, so that ``bytes.split`` gives
the words (digits, letters and all bytes from 0x80 on). The features of a text are its runs of 1 to ``most`` words,
joined by one space: the CRC-32 of a run goes on from the CRC-32 of the run without its last word, so each run costs
one chained call. Counters reduce the checksums of a task to counts per bucket, and Spark sums them: what
reaches the driver is ``buckets`` rows, whatever the corpus.

    gain of a bucket  floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))
    weight of a text  floor(mean gain of its features), 0 without features
    score             weight + floor(-1000 ln(-ln((h + 0.5) / 2^32))), h from sha256("<seed>:<id>")

The highest scores among texts of ``min_words`` words are a sample without replacement with chances
in proportion to exp(weight / 1000). Scores are integers in a range set by the formulas, so a histogram of them (a bounded
table) says which score the last drawn text has; only texts from there on are sorted, over the whole cluster.

Null and empty texts have no words, weight 0 and are not drawn (unless ``min_words`` is 0). Very long texts
are one list of words in one task. Ties go to the smaller identifier, then fewer features, then row; a null identifier
is hashed as an empty one and comes last. Repeated rows are texts of their own. An empty table or an empty target
gives counts of 0 and needs no special case. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import ranked
from tidemark.session import materialise

TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def words(raw: bytes) -> list[bytes]:
    return raw.translate(TABLE).split()


def features(found: list[bytes], most: int) -> list[int]:
    """CRC-32 of every run of 1 to ``most`` words."""
    last = out = list(map(crc32, found))
    if most > 1 and len(found) > 1:
        out = last.copy()
        after = [b" " + w for w in found[1:]]
        for k in range(most - 1):
            last = list(map(crc32, after[k:], last))
            out += last
    return out


def raw_texts(batch: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]


def bucket_counts(texts: DataFrame, most: int, buckets: int, flush: int = 500_000) -> np.ndarray:
    """How many features of all ``texts`` fall into each bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(buckets, np.int64), Counter()

        def fold() -> None:
            at = np.fromiter(seen.keys(), np.int64, len(seen)) % buckets
            np.add.at(total, at, np.fromiter(seen.values(), np.int64, len(seen)))
            seen.clear()

        for batch in batches:
            for raw in raw_texts(batch):
                seen.update(features(words(raw), most))
                if len(seen) > flush:
                    fold()
        fold()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    for row in (texts.mapInArrow(count, "bucket bigint, n bigint")
                .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket in thousandths."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, most: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw in raw_texts(batch):
                found = words(raw)
                own = features(found, most)
                total = int(shared.value[np.array(own, np.int64) % len(shared.value)].sum()) if own else 0
                out.append((len(found), len(own), total // len(own) if own else 0))
            columns = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(sums, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(seed: int, id_column: str) -> Column:
    """Gumbel noise in thousandths, fixed by seed and identifier."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             target_text: str = "text", most: int = 2, buckets: int = 10_000, percent: int = 10,
             min_words: int = 20, seed: int = 0) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; rank is null for rows not drawn."""
    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    gain = gains(bucket_counts(plain.select("text"), most, buckets),
                 bucket_counts(target.select(F.col(target_text).cast("string").alias("text")), most, buckets))
    scored = materialise(
        weigh(plain, gain, most)
        .withColumn("score", F.col("weight") + noise(seed, "doc_id"))
        .withColumn("row", F.monotonically_increasing_id()).withColumn("unnamed", F.col("doc_id").isNull()), "scored")
    able = F.col("n_words") >= min_words
    levels = sorted(scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    wanted, total, lowest = percent * sum(r["n"] for r in levels) // 100, 0, None
    for row in levels:
        if total >= wanted:
            break
        total, lowest = total + row["n"], row["score"]
    kept = ["doc_id", "n_features", "weight", "score"]
    if lowest is None:
        return scored.select(*kept, F.lit(None).cast("long").alias("rank"))
    near = able & (F.col("score") >= lowest)
    first = ranked(scored.where(near), ["-score", "unnamed", "doc_id", "n_features", "row"], rank="place")
    place = F.when(F.col("place") <= wanted, F.col("place"))
    return first.select(*kept, place.alias("rank")).unionByName(
        scored.where(~near).select(*kept, F.lit(None).cast("long").alias("rank")))
