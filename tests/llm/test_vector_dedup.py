"""Vector near-duplicates against all cosines of a label."""

import numpy as np
import pytest

import tidemark.llm.vector_dedup as operator
from tidemark.llm.dedup_queries import op3_pivot_vector_dedup


def brute_force(rows, threshold=0.98):
    good = [v is not None and label is not None and len(v) > 0 and None not in v
            and np.isfinite(v).all() and np.any(v) for _, v, label in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    links = {i: [] for i in range(len(rows))}
    groups = {}
    for i, (_, v, label) in enumerate(rows):
        if good[i]:
            groups.setdefault((label, len(v)), []).append(i)
    for own in groups.values():
        x = np.array([rows[i][1] for i in own], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        hit = x @ x.T >= threshold
        for k, i in enumerate(own):
            links[i] = [own[j] for j in np.flatnonzero(hit[k]) if own[j] != i]
    first = {}
    for i in order:
        if i in first:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if j not in first:
                first[j] = i
                stack += links[j]
    return sorted(((rows[i][0], len(links[i]), rows[first[i]][0], first[i] == i) for i in range(len(rows))), key=str)


@pytest.mark.parametrize("block", [1024, 16])
def test_same_as_all_cosines(spark, monkeypatch, block):
    monkeypatch.setattr(operator, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = []
    for label in (0, 1):
        centre = rng.normal(size=32)
        for spread in (0.02, 0.1, 0.13, 0.3):
            rows += [(len(rows) + k, (centre + spread * rng.normal(size=32)).tolist(), label) for k in range(30)]
        rows += [(len(rows) + k, rng.normal(size=32).tolist(), label) for k in range(40)]
    rows += [(900 + k, rows[0][1], 0) for k in range(50)]
    rows += [(1000, None, 0), (1001, [], 0), (1002, [0.0] * 32, 0), (1003, [float("nan")] + [1.0] * 31, 0),
             (1004, [None] + [1.0] * 31, 0), (1005, rows[0][1], None), (None, rows[0][1], 0), (None, rows[200][1], 1),
             (900, rows[0][1], 0), (1006, [1.0, 2.0], 0), (1007, [1.0, 2.0001], 0), (1008, [float("inf")] * 32, 1)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, node int")
    got = operator.vector_dedup(frame.coalesce(1), pivots=48).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_force(rows)


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = op3_pivot_vector_dedup(spark, sf).collect()
    want = brute_force(rows)
    assert sum(r["n_links"] for r in got) >= 0.99 * sum(w[1] for w in want)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert operator.vector_dedup(frame).count() == 0
