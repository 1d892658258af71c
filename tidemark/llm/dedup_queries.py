"""Queries of the deduplication operators."""

from __future__ import annotations

from .common import parquet_row_key
from .exact_dedup import exact_dedup
from .near_dedup import near_dedup
from .registry import query
from .span_dedup import span_dedup
from .vector_dedup import vector_dedup


@query("op7_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
""")
def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query("op4_minhash_near_dedup")
def op4_minhash_near_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_dedup(docs, key=parquet_row_key()).drop("key")


@query("op3_pivot_vector_dedup")
def op3_pivot_vector_dedup(spark, sf_dir):
    return vector_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op8_sentence_spans")
def op8_sentence_spans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return span_dedup(docs, min_sentences=2, cut_window=9, key=parquet_row_key()).drop("key")
