"""Exact round trip of the token files."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.token_files import (
    documents_of_segment, local_path, read_documents, write_token_files)

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "  ", "it's we're 'SÉ é e ́x 12 3½ ΣΣ \x1cx\x1d \x85y z　w",
       "<|endoftext|> a<|startoftext|>b", "a\r\nb\x0bc\x0cd\te", "İstanbul ﬁ ​ 한글",
       "x" * 5000, "word " * 3000, "$$$ &&& *** ### .,;", "naïve café’s don't", "~ a~b ~~ 5 ~ ~~x ~"]


def encoded(text):
    ids = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 1], "<u4")


@pytest.mark.parametrize("separator", ["~", None])
def test_round_trip(spark, tmp_path, separator):
    rows = [(7 * i % 12 - 3, text) for i, text in enumerate(ODD)] + [(None, "no name"), (2, "again")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, segment int, ids string")
    write_token_files(docs, f"file://{tmp_path}/out", PATH, 1, segments=3, separator=separator)
    got = read_documents(spark, f"{tmp_path}/out").collect()
    start, want = 0, []
    for doc_id, text in docs.orderBy("doc_id", F.xxhash64("text")).select("doc_id", "text").collect():
        ids = encoded(text)
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want
    flat = [(d, x.tolist()) for k in range(3) for d, x in documents_of_segment(f"{tmp_path}/out", k)]
    assert [d for d, _ in flat] == [w[0] for w in want]
    assert sum(len(x) for _, x in flat) == start


def test_empty_table_and_unmounted_folder(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    write_token_files(docs, str(tmp_path / "none"), PATH, 1, segments=2)
    assert read_documents(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        local_path("hdfs://somewhere/x")
