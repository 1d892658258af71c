"""Mixing: the flow against all cuts, targets against a plain loop, selection against its rules."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixing import cycled_weights, mix_sources, route, water_filled
from tidemark.llm.corpus_queries import op2_mix_sources


def most_tokens(capacity, quotas, times):
    """Largest possible flow: the smallest cut over all sets of sources."""
    sources = list(quotas)
    return min(
        sum(quotas[s] for s in cut) + sum(times * c for p, c in capacity.items()
                                          if set(p) & (set(sources) - set(cut)))
        for k in range(len(sources) + 1) for cut in combinations(sources, k))


@pytest.mark.parametrize("seed", range(8))
def test_flow_is_largest_and_repeats_as_little_as_possible(seed):
    rng = random.Random(seed)
    sources = ["a", "b", "c", "d"]
    capacity = {tuple(sorted(rng.sample(sources, rng.randrange(1, 4)))): rng.randrange(0, 60) for _ in range(6)}
    quotas = {s: rng.randrange(0, 90) for s in sources}
    routes = route(capacity, quotas, 3)
    by_level = [sum(sum(r[level].values()) for r in routes.values()) for level in range(3)]
    for level in range(3):
        assert sum(by_level[:level + 1]) == most_tokens(capacity, quotas, level + 1)
    for p, levels in routes.items():
        assert all(sum(part.values()) <= capacity[p] for part in levels)
        assert all(set(part) <= set(p) for part in levels)
    for s in sources:
        assert sum(part.get(s, 0) for r in routes.values() for part in r) <= quotas[s]


def test_water_filling_stops_at_the_cap():
    got = water_filled({"a": 10, "b": 100, "c": 90}, {"a": 3, "b": 1, "c": 2}, 300, 2)
    assert got == {"a": 20, "c": 180, "b": 100}


def test_query_reaches_targets_and_repeats_itself(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in op2_mix_sources(spark, sf).collect()}
    again = {r["doc_id"]: r for r in op2_mix_sources(spark, sf).collect()}
    assert rows == again
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert {d["doc_id"] for d in docs} == set(rows)
    by_source = {}
    for d in docs:
        r = rows[d["doc_id"]]
        assert r["size"] == len(d["text"].encode().split())
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        by_source.setdefault(d["source"], []).append(r)
    sizes = {s: sum(r["size"] for r in own) for s, own in by_source.items()}
    targets = cycled_weights(sizes)
    for s, own in by_source.items():
        assert {r["source_size"] for r in own} == {sizes[s]}
        assert own[0]["target"] == pytest.approx(targets[s])
        smallest = min(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - targets[s]) <= max(smallest, 0.02 * targets[s])


def test_overlapping_sources_nulls_and_empty(spark):
    rows = [(i, f"w {i}", ["a", "b"] if i % 3 else ["a"], 10 + i % 7) for i in range(300)]
    rows += [(None, None, ["b", None], 5), (1, "w 1", None, 7), (2, "x", [], 7), (3, "x", ["b", "b"], None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows],
                                 "doc_id long, text string, sources array<string>, n int, cell int")
    mixed, sizes, wanted = mix_sources(docs, lambda s: {"a": 2000, "b": 900, None: 4}, size=F.col("n"),
                                       members=F.col("sources"), repeats=2)
    got = mixed.collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r["copies"] == len(r["assigned"]) <= 2
        assert set(r["assigned"]) <= set(r["members"])
        for s in r["assigned"]:
            taken[s] = taken.get(s, 0) + r["size"]
    assert abs(taken["a"] - 2000) < 40 and abs(taken["b"] - 900) < 40
    empty = spark.createDataFrame([], docs.schema)
    mixed, sizes, wanted = mix_sources(empty, cycled_weights, size=F.col("n"), members=F.col("sources"))
    assert mixed.count() == 0 and sizes == {}
