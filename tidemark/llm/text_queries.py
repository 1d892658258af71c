"""Queries of the operators that score or change single texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import parquet_row_key
from .hmm_lm import score_texts
from .language_id import fold_of, identify_language
from .page_text import page_text
from .registry import query


@query("op9_language_id")
def op9_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text", F.coalesce(fold_of("doc_id", 5) == 0, F.lit(False)).alias("held_out"))
    predicted = identify_language(rows, docs.where(fold_of("doc_id", 5) != 0),
                                  keep_text=False)
    return predicted.select("doc_id", "held_out", "lang_pred", "score")


@query("op1_hmm_score")
def op1_hmm_score(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_texts(docs, fold_of("doc_id", 7) == 2)


@query("op5_page_text")
def op5_page_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return page_text(pages, key=parquet_row_key()).withColumn("n_chars", F.length("text").cast("long"))
