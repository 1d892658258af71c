"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and gives a frame that is written as parquet and read
again as the next stage's ``docs``; ``docs`` must come straight from parquet files. All but
the last keep the columns of ``documents``.

* language: drops texts without a letter and texts that fit no learned language (by labelled
  texts of their size that had no part in the fit);
* exact copies: of equal texts the smallest doc_id stays;
* near copies: of each group of linked documents the smallest doc_id stays;
* mix: documents leave or come again so that sources meet their targets (a document taken
  twice is there twice);
* pack: the place of each document's tokens (words and one end) in training sequences.

Null texts have no language and leave in the first stage. Very long texts are read whole, each in one task. Repeated rows
are exact copies. An empty table gives no rows. Further columns of ``documents`` go along, whatever their names (but
for those that start with two underscores).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import parquet_row_key
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.language_id import identify_language
from tidemark.llm.mixing import cycled_weights, mix_sources, words_of
from tidemark.llm.near_dedup import near_dedup
from tidemark.llm.packing import pack
from tidemark.session import materialise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = {c: f"__{k}" for k, c in enumerate(docs.columns)}  # no column of the table meets the verdict's columns
    plain = docs.toDF(*names.values())
    judged = identify_language(plain, plain, names["doc_id"], names["text"], names["lang"], fits=True)
    return judged.where("fits").select(*names.values()).toDF(*docs.columns)


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``kept`` names by key, with their columns."""
    return (docs.withColumn("__key", parquet_row_key())
            .join(kept.select(F.col("key").alias("__key")), "__key", "left_semi")
            .select(*docs.columns))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _only(docs, exact_dedup(docs, carry={"key": parquet_row_key()}).where("kept"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _only(docs, near_dedup(docs, key=parquet_row_key()).where("kept"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed, _, _ = mix_sources(docs, cycled_weights, carry={"key": parquet_row_key()})
    taken = mixed.where("copies > 0").select(F.col("key").alias("__key"),
                                             F.sequence(F.lit(1), "copies").alias("__copies"))
    return (docs.withColumn("__key", parquet_row_key()).join(taken, "__key")
            .withColumn("__copy", F.explode("__copies")).select(*docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, words_of("text") + 1)


STAGES = [("language", language), ("exact copies", exact_copies), ("near copies", near_copies),
          ("mix", mix), ("pack", packed)]

ORACLE_SQL = None  # components, flow and packing are tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
