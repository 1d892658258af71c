"""The language model against plain recursions, counts and sums over all paths."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hmm_lm as H
from tidemark.llm.language_id import fold_of


def model(states, classes, seed):
    rng = np.random.default_rng(seed)
    start, move, emit = rng.random(states), rng.random((states, states)), rng.random((classes, states))
    return H.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def path_probabilities(m, text):
    for path in itertools.product(range(len(m.start)), repeat=len(text)):
        p = m.start[path[0]] * m.emit[text[0], path[0]]
        for t in range(1, len(text)):
            p *= m.move[path[t - 1], path[t]] * m.emit[text[t], path[t]]
        yield path, p


def test_likelihood_is_the_sum_over_all_paths():
    m = model(3, 5, 1)
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 5, n).astype(np.uint16) for n in (1, 4, 6, 2, 6)]
    got = H.log_likelihoods(m, texts, block=2)
    want = [math.log10(sum(p for _, p in path_probabilities(m, t))) for t in texts]
    assert got == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("steps, width", [(2, 2), (3, 1), (100, 4)])
def test_expected_counts_over_all_paths(steps, width):
    m = model(2, 4, 3)
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 4, n).astype(np.uint16) for n in (1, 5, 3, 7, 9)]
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    total = 0.0
    for text in texts:
        paths = list(path_probabilities(m, text))
        whole = sum(p for _, p in paths)
        total += math.log10(whole)
        for path, p in paths:
            start[path[0]] += p / whole
            for t, s in enumerate(path):
                emit[text[t], s] += p / whole
                if t:
                    move[path[t - 1], s] += p / whole
    got = H.expected_counts(m, texts, steps, width)
    for a, b in zip(got, (start, move, emit, total), strict=True):
        assert a == pytest.approx(b, rel=1e-4)


def plain_counts(m, text):
    """Start, move and emission counts of one sequence by unhurried recursions in double precision."""
    alpha, scale = np.zeros((len(text), len(m.start))), np.zeros(len(text))
    for t, c in enumerate(text):
        alpha[t] = m.emit[c] * (m.start if t == 0 else alpha[t - 1] @ m.move)
        scale[t] = alpha[t].sum()
        alpha[t] /= scale[t]
    beta = np.ones(len(m.start))
    move, emit = np.zeros_like(m.move), np.zeros_like(m.emit)
    for t in range(len(text) - 1, -1, -1):
        emit[text[t]] += alpha[t] * beta
        if t:
            onward = m.emit[text[t]] * beta / scale[t]
            move += np.outer(alpha[t - 1], onward) * m.move
            beta = m.move @ onward
    return alpha[0] * beta, move, emit, np.log10(scale).sum()


def test_expected_counts_of_long_texts():
    m = model(3, 40, 8)
    rng = np.random.default_rng(9)
    texts = [rng.integers(0, 40, n).astype(np.uint16) for n in (3000, 1, 700, 1024, 2048, 1025)]
    want = [sum(x) for x in zip(*(plain_counts(m, t) for t in texts), strict=True)]
    for a, b in zip(H.expected_counts(m, texts), want, strict=True):
        assert a == pytest.approx(b, rel=2e-3, abs=2e-3)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_counts_base_score_and_score(spark):
    sf = "/root/testdata/sf0.001"
    frame = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit(1).alias("row"))
    extra = spark.createDataFrame([(None, None, 1), (7001, "", 1), (7002, "The the THE nowhere-seen\x0bé", 1),
                                   (7003, "the " * 30000, 1), (7003, "the " * 30000, 1)], frame.schema)
    docs = frame.unionByName(extra)
    small = dict(own_classes=200, suffix_classes=32, known_words=500, rounds=4, states=4)
    got = H.score_texts(docs, fold_of("doc_id", 7) == 2, **small).collect()
    rows = docs.collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = Counter()
    for r in rows:
        if not held(r["doc_id"]):
            counts.update([*words(r["text"]), None])
    n, v = sum(counts.values()), len(counts)
    want = {}
    for r in rows:
        tokens = [*words(r["text"]), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        want[r["doc_id"]] = (held(r["doc_id"]), len(tokens), sum(counts[w] > 0 for w in tokens), n, base)
    assert len(got) == len(rows)
    better = 0
    for r in got:
        h, tokens, known, train, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, tokens, known, train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0
        better += r["score"] > r["base_score"]
    assert better > 0.8 * len(got)
    again = {r["doc_id"]: r["score"] for r in H.score_texts(docs, fold_of("doc_id", 7) == 2, **small).collect()}
    assert all(again[r["doc_id"]] == pytest.approx(r["score"], rel=1e-6) for r in got)


def test_no_training_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = H.score_texts(docs, F.lit(True), own_classes=3, suffix_classes=2, known_words=4).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got} == {
        (1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)}
    assert H.score_texts(docs.limit(0), F.lit(False), own_classes=3, suffix_classes=2, known_words=4).count() == 0


def plain_scores(rows, held, own_classes, suffix_classes, rounds, states, seed=17):
    """log10 probability of every text, by dictionaries and loops (tokens of bytes, None for the end)."""
    texts = [[w.encode() for w in words(t)] + [None] for _, t in rows]
    train = [t for (d, _), t in zip(rows, texts, strict=True) if not held(d)]
    counts = Counter(w for t in train for w in t)
    ends = counts.pop(None, 0)
    level = {w: math.floor(math.log(c) / math.log(1.02)) for w, c in counts.items()}
    total, lowest = 0, None
    for x, n in sorted(Counter(level.values()).items(), reverse=True):
        total += n
        if total > own_classes:
            break
        lowest = x
    own = sorted((w for w in counts if lowest is not None and level[w] >= lowest), key=lambda w: (-counts[w], w))
    number = {w: k + 1 for k, w in enumerate(own)} | {None: 0}
    suffix = lambda w: zlib.crc32(w[-3:]) % suffix_classes
    room = np.ones(suffix_classes)
    for w, c in counts.items():
        if w not in number:
            room[suffix(w)] += c + 1
    unigram = np.zeros(1 + own_classes + suffix_classes)
    unigram[0], unigram[1 + own_classes:] = ends, room - 1
    for w in own:
        unigram[number[w]] = counts[w]
    encode = lambda t: np.array([number.get(w, -1) if w in number else 1 + own_classes + suffix(w) for w in t])
    m = H.Model.seeded(unigram, states, seed)
    prior = (unigram + 0.5) / (unigram + 0.5).sum() * 20
    for _ in range(rounds):
        start, move, emit, _ = (sum(x) for x in zip(*(plain_counts(m, encode(t)) for t in train), strict=True))
        m = H.Model.from_counts(start, move, emit, prior)
    inner = lambda t: sum(math.log10((counts[w] + 1) / room[suffix(w)]) for w in t if w not in number)
    return [plain_counts(m, encode(t))[3] + inner(t) for t in texts]


def test_scores_against_a_plain_model(spark):
    held = lambda d: d % 7 == 2
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(90).collect()]
    rows.append((5000, " ".join(f"w{k % 97}" for k in range(2500))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    small = dict(own_classes=150, suffix_classes=16, rounds=3, states=3)
    want = dict(zip((d for d, _ in rows), plain_scores(rows, held, **small), strict=True))
    got = {r["doc_id"]: r["score"] for r in H.score_texts(docs, F.col("doc_id") % 7 == 2, known_words=40, **small).collect()}
    assert got == pytest.approx(want, rel=1e-3)


def test_held_out_texts_change_no_other_score(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(80).collect()]
    changed = [(d, "entirely other words " * 900 if d % 7 == 2 else t) for d, t in rows]
    scores = []
    for own in (rows, changed):
        docs = spark.createDataFrame(own, "doc_id long, text string").coalesce(2)
        got = H.score_texts(docs, F.col("doc_id") % 7 == 2, own_classes=100, suffix_classes=16, known_words=50, rounds=2, states=3)
        scores.append({r["doc_id"]: r["score"] for r in got.collect() if r["doc_id"] % 7 != 2})
    assert scores[0] == pytest.approx(scores[1], rel=1e-9)
