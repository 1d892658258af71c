"""Importance resampling against a plain reimplementation."""

import hashlib
import math
import random
import re
import zlib

import pytest

from tidemark.llm.importance import features, resample, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, most):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = WORD.findall(lowered)
    return found, [" ".join(found[k:k + n]) for n in range(1, most + 1) for k in range(len(found) - n + 1)]


def brute_force(docs, target, most, buckets, percent, min_words, seed):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in plain_features(text, most)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for k, (doc_id, text) in enumerate(docs):
        found, own = plain_features(text, most)
        weight = math.floor(sum(gain[bucket(f)] for f in own) / len(own)) if own else 0
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), weight, score, None, len(found)])
    able = sorted((r for r in rows if r[5] >= min_words),
                  key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def collection():
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma9", "é", "名前", "x_y", "don't", " a", "Ω", "end."]
    docs = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for k in range(120)]
    docs += [(200, None), (201, ""), (202, " \t\n"), (None, "alpha beta " * 12), (None, "alpha beta " * 12),
             (5, docs[5][1]), (5, docs[5][1]), (203, "word " * 30_000), (204, "alpha\x00beta\x7fgamma\x85d")]
    return docs, ["alpha beta gamma9", None, "", "名前 é alpha " * 5]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_same_as_plain_counts(spark, most):
    docs, target = collection()
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, score int, rank string")
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample(frame.repartition(3), aim, most=most, buckets=97, percent=25, min_words=3, seed=11)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(docs, target, most, 97, 25, 3, 11)


def test_chained_checksums_are_those_of_the_joined_words():
    found = words("The QUICK brown-fox, naïve".encode())
    assert features(found, 3) == [zlib.crc32(f.encode()) for f in plain_features("The QUICK brown-fox, naïve", 3)[1]]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert resample(docs, some).collect() == []
    rows = resample(some, docs, percent=100, min_words=1).collect()
    assert sorted((r["doc_id"], r["rank"]) for r in rows) == [(1, 1), (2, None)]
