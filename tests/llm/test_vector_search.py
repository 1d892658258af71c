"""Cross-polytope search against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import tidemark.llm.vector_search as operator
from tidemark.llm.selection_queries import op13_nearest_vectors


def usable(v):
    return v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v)


def brute_force(rows, asks, k):
    """(query_id, rank, vec_id, score) over rows (vec_id, vector)."""
    out = []
    good = [(i, r[0], np.array(r[1], float)) for i, r in enumerate(rows) if usable(r[1])]
    for i, name, v in good:
        if name is None or not asks(name):
            continue
        others = [(-float((v * w).sum()), other is None, other or 0, j) for j, other, w in good if j != i and len(w) == len(v)]
        for rank, (score, unnamed, other, _) in enumerate(sorted(others)[:k], 1):
            out.append((name, rank, None if unnamed else other, round(-score, 9)))
    return sorted(out, key=str)


def found(frame, **settings):
    got = operator.nearest_vectors(frame, F.col("vec_id") % 5 == 0, **settings)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    return sorted(((r[0], r[1], r[2], round(r[3], 9)) for r in got.collect()), key=str)


def collection(rng):
    rows = [(k, rng.normal(size=16).tolist()) for k in range(150)]
    rows += [(200 + k, (np.array(rows[k][1]) * 10.0 ** (k % 7 - 3)).tolist()) for k in range(40)]  # other norms
    rows += [(300 + k, rows[0][1]) for k in range(60)]  # copies, a third of some bucket
    rows += [(400 + k, np.sign(rng.normal(size=16)).tolist()) for k in range(60)]  # many equal products
    rows += [(500 + k, rng.normal(size=3).tolist()) for k in range(4)]  # fewer candidates than wanted
    rows += [(600, None), (605, []), (610, [0.0] * 16), (615, [float("nan")] * 16), (620, [float("inf")] * 16),
             (625, [None] + [1.0] * 15), (None, rows[0][1]), (None, rows[3][1]), (5, rows[5][1]), (5, rows[9][1]),
             (630, [1e200] * 16), (635, [1e-200] * 16), (640, [2.0])]
    return rows


@pytest.mark.parametrize("block, in_bucket", [(4096, 1024), (16, 8), (16, 1)])
def test_all_buckets_give_all_products(spark, monkeypatch, block, in_bucket):
    monkeypatch.setattr(operator, "BLOCK", block)
    monkeypatch.setattr(operator, "IN_BUCKET", in_bucket)
    rows = collection(np.random.default_rng(2))
    rows = [r for r in rows if r[0] not in (630,)]  # its products overflow
    frame = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "vec_id long, embedding array<double>, score double, rank int")
    assert found(frame.coalesce(1), k=7, probes=1 << 20) == brute_force(rows, lambda n: n % 5 == 0, 7)


def test_rounds_find_what_one_search_finds(spark, monkeypatch):
    monkeypatch.setattr(operator, "IN_BUCKET", 2)
    rows = [r for r in collection(np.random.default_rng(8)) if r[0] not in (630,)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    hashes = operator.Polytope(16, 300, 2, 7)
    assert hashes.buckets > 64  # so that there are three rounds
    assert found(frame, k=7, probes=hashes.buckets) == brute_force(rows, lambda n: n % 5 == 0, 7)


def test_widens_until_enough_are_found(spark, monkeypatch):
    monkeypatch.setattr(operator, "IN_BUCKET", 2)
    rows = [(k, v) for k, (_, v) in enumerate(collection(np.random.default_rng(5))[:190])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(frame, k=20, probes=1, tables=1)
    assert len(got) == 20 * 38
    want = {(q, v) for q, _, v, _ in brute_force(rows, lambda n: n % 5 == 0, 20)}
    assert len({(q, v) for q, _, v, _ in got} & want) > 0.2 * len(want)


def test_probe_order(spark):
    rng = np.random.default_rng(3)
    hashes = operator.Polytope(20, operator.IN_BUCKET * 1500, 2, 7)
    assert len(hashes.axes) == 2
    queries = rng.normal(size=(5, 20))
    parts = hashes.penalties(queries, 1)
    total = (parts[0][:, :, None] + parts[1][:, None, :]).reshape(5, -1)
    for number in (1, 7, 60):
        probes = hashes.probes(queries, 1, number)
        assert np.allclose(np.sort(total, axis=1)[:, :number], np.take_along_axis(total, probes, axis=1))
    for q in range(5):
        own = [p[q] for p in parts]
        for place in (0, 9, 200):
            code = int(np.argsort(total[q], kind="stable")[place])
            assert hashes.rank([*own, np.sort(own[1])], code) == place + 1


def test_rotation_keeps_lengths_and_the_same_vector_its_bucket():
    rng = np.random.default_rng(3)
    hashes = operator.Polytope(64, operator.IN_BUCKET * 100, 1, 7)
    x = rng.normal(size=(50, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    along = hashes._turned(x, 0)[0]
    assert hashes.axes == [64] and along.shape == (50, 128)
    near = x + 0.005 * rng.normal(size=x.shape)
    assert (hashes.codes(x, 1.0, 0) == hashes.probes(near, 0, 1)[:, 0]).mean() > 0.9


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = op13_nearest_vectors(spark, f"/root/testdata/{sf}").collect()
    want = brute_force(rows, lambda n: n % 20 == 0, 20)
    assert len(got) == len(want)
    same = {(r["query_id"], r["vec_id"]) for r in got} & {(q, v) for q, _, v, _ in want}
    assert len(same) >= 0.92 * len(want)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert found(frame) == []
