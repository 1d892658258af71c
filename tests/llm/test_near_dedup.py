"""Near-duplicates against all pairs of full shingle sets."""

import random
import re
from itertools import combinations

import pytest

import tidemark.llm.near_dedup as operator
from tidemark.llm.near_dedup import near_dedup, prune_table


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    size = min(5, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute_force(rows):
    sets = [shingles(text) for _, text in rows]
    order = [(doc_id is None, doc_id or 0, i) for i, (doc_id, _) in enumerate(rows)]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and 100 * both >= 75 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)), key=lambda k: order[k])
            root[b] = a
    return sorted(((rows[i][0], len(sets[i]), rows[find(i)][0] if sets[i] else rows[i][0],
                    find(i) == i) for i in range(len(rows))), key=str)


def variants(seed, n):
    """Families of texts at many similarities around the threshold, with odd cases."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice((3, 8, 40, 150)))]
        for _ in range(rng.randrange(1, 7)):
            copy = list(words)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("seed, block", [(1, 4096), (2, 4)])
def test_same_as_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(operator, "BLOCK", block)
    rows = variants(seed, 60)
    rows += [(9000, None), (9001, ""), (9002, " \t\n"), (9003, "One word"), (9004, "one word"),
             (None, rows[0][1]), (None, "only without a name here"), (None, "only without a name here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = near_dedup(docs).drop("key").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_force(rows)


def test_repeated_rows_clashing_columns_and_one_hot_family(spark):
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base[:i % 40] + ["new"] + base[i % 40 + 1:])) for i in range(400)]
    rows += rows[:5]
    docs = spark.createDataFrame(
        [(*r, "x", 1, 2) for r in rows],
        "doc_id long, text string, node string, component long, n_shingles int").coalesce(1)
    got = near_dedup(docs).collect()
    assert len(got) == 405
    assert {r["component_id"] for r in got} == {0}
    assert sum(r["kept"] for r in got) == 1


def test_empty_table(spark):
    assert near_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    for seen, least in prune_table(400, 25, 0.75, 1e-4):
        assert least < 0.75 * seen
