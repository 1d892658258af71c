"""Packing against a plain search of all open bins, and the invariants of the whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.packing import best_fit, pack, sequence_cost


@pytest.mark.parametrize("seed", range(4))
def test_every_choice_is_a_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.integers(1, 128, 200))[::-1].tolist()
    capacities = (16, 32, 64, 128)
    where, offset, final = best_fit(np.array(lengths), capacities)
    room, held = [], []
    for k, length in enumerate(lengths):
        fits = [r for r in room if r >= length]
        if not fits:
            def price(c, length=length, k=k):
                later = sum(x for x in lengths[k + 1:] if x <= c - length)
                return sequence_cost(c) / (length + min(c - length, later))
            assert where[k] == len(room)
            room.append(min((c for c in capacities if c >= length), key=price))
            held.append(0)
        else:
            assert room[where[k]] == min(fits)
        assert offset[k] == held[where[k]]
        room[where[k]] -= length
        held[where[k]] += length
    assert final.tolist() == [min(c for c in capacities if c >= h) for h in held]


def test_whole_pack(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(n)) for i, n in enumerate(rng.integers(0, 700, 500))]
    rows += [(None, 90), (1, None), (7, 5000), (7, 5000), (8, 0)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, n int, bin int")
    got = pack(docs, F.col("n"), capacities=(128, 512, 256), shard_tokens=20_000).toPandas()
    assert got["length"].sum() == sum(n or 0 for _, n in rows)
    binned = got[got["bin"].notna()].sort_values(["bin", "bin_offset"])
    for _, own in binned.groupby("bin"):
        assert own["bin_offset"].tolist() == np.concatenate(([0], own["length"].cumsum()[:-1])).tolist()
        capacity = own["capacity"].iloc[0]
        total = own["length"].sum()
        assert total <= capacity and capacity == min(c for c in (128, 256, 512) if c >= total)
    long = got[got["doc_id"] == 7].sort_values("start")
    assert sorted(long["start"]) == sorted(list(range(0, 5000, 512)) * 2 + [0])
    fill = binned["length"].sum() / binned.groupby("bin")["capacity"].first().sum()
    assert fill > 0.9
    assert pack(docs.limit(0), F.col("n")).count() == 0
