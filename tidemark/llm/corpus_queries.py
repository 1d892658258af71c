"""Queries of the operators that compose a corpus: mixing and packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from .mixing import cycled_weights, mix_sources, words_of
from .packing import pack
from .registry import query


@query("op2_mix_sources")
def op2_mix_sources(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed, sizes, targets = mix_sources(docs, cycled_weights)
    of_source = spark.createDataFrame(
        [([s], sizes[s], targets[s]) for s in sizes],
        "members array<string>, source_size bigint, target double")
    return (mixed.join(of_source, "members")
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken"), "copies"))


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, words_of("text") + 1)
