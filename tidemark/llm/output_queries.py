"""Queries of the operators that write training input."""

from __future__ import annotations

import uuid

import public_tokenizers

from tidemark.session import scratch_root

from .registry import query
from .token_alignment import align_tokens
from .token_files import read_documents, write_token_files


@query("op10_token_files")
def op10_token_files(spark, sf_dir):
    # beside the written stages, so that release_scratch frees it too
    folder = f"{scratch_root(spark)}/tidemark/{spark.sparkContext.applicationId}/token-files-{uuid.uuid4().hex}"
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder,
                      public_tokenizers.path("word_bpe_49k.json"), end_id=1,
                      separator="~")
    return read_documents(spark, folder)


@query("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    return align_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
