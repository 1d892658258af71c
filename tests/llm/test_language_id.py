"""Language identification: kernels against sets, accuracy on held-out rows, odd texts."""

import math

import numpy as np
import pytest

from tidemark.llm import language_id as L
from tidemark.llm.text_queries import op9_language_id


def test_kernel_of_two_texts_is_the_blended_presence_spectrum():
    texts = ["The cat, the hat!", "a cat in THE hat", "über 12 öl"]
    rows = np.zeros((3, L._STARTS[-1]), bool)
    assert all(L.mark_ngrams(t, rows[i]) for i, t in enumerate(texts))
    folded = [" " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " " for t in texts]
    grams = [[{t[i:i + k] for i in range(len(t) - k + 1)} for k in (1, 2, 3, 4)] for t in folded]
    scaled = L.scale(rows)
    for i in range(3):
        for j in range(3):
            want = sum(len(grams[i][k] & grams[j][k]) / math.sqrt(len(grams[i][k]) * len(grams[j][k])) for k in range(4)) / 4
            assert scaled[i] @ scaled[j] == pytest.approx(want, abs=0.06)  # slots are hashed


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in op9_language_id(spark, sf).collect()]
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_texts_no_training_and_empty_table(spark):
    train = [(i, w, lang) for i in range(40) for w, lang in (("the house and the garden " * 3, "en"), ("das haus und der garten " * 3, "de"))]
    train += [(99, None, "en"), (98, "the", None), (97, "123", "de")]
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "12 ?!", 5), (None, "das Haus und der Garten", 5),
                                  (4, "the house " * 20000, 5), (4, "the garden and the house", 5)], "doc_id long, text string, score int")
    training = spark.createDataFrame(train, "doc_id long, text string, lang string")
    got = L.identify_language(docs, training).collect()
    assert [r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)] == ["und"] * 3
    assert {(r["doc_id"], r["lang_pred"]) for r in got if r["doc_id"] not in (1, 2, 3)} == {(None, "de"), (4, "en")}
    none = L.identify_language(docs, training.where("lang = 'x'"))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    assert L.identify_language(docs.limit(0), training).count() == 0
