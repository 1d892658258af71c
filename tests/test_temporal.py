"""Window edges, ties and hot entities."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cohort as C, features as X, temporal as T

T0 = dt.datetime(2024, 3, 9, 23, 0, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def pairs_of(spark, events, **kw):
    ev = rows(spark, events, "k string, t timestamp_ntz, c string, v double")
    index, wide = C.index_events(ev, "k", "t", "c", ["a", "a2"], ["b", "b2"], 30, 5, ["v"], **kw)
    return ({r["k"]: r for r in index.collect()}, {r["k"]: r for r in wide.collect()})


def test_pair_edges(spark):
    events = []
    for k, gap in (("in", 300), ("late", 301), ("wide", 1800), ("out", 1801), ("sub", 300.9)):
        events += [(k, at(0), "a", 1.0), (k, at(gap), "b", 2.0)]
    index, wide = pairs_of(spark, events)
    assert set(index) == {"in", "sub"}
    assert set(wide) == {"in", "sub", "late", "wide"}


def test_early_wide_pair_hides_later_close_pair(spark):
    events = [("k", at(0), "a", 1.0), ("k", at(1200), "b", 1.0),
              ("k", at(9000), "a", 1.0), ("k", at(9060), "b", 1.0)]
    index, wide = pairs_of(spark, events)
    assert not index and wide["k"]["index_time"] == at(0)
    index, _ = pairs_of(spark, events, select="filter_then_first")
    assert index["k"]["index_time"] == at(9000)


def test_smaller_gap_then_least_category_wins(spark):
    events = [("k", at(0), "a", 1.0), ("k", at(50), "b2", 9.0), ("k", at(20), "b2", 7.0),
              ("k", at(20), "b", 8.0), ("k", at(-10), "b", None)]
    index, _ = pairs_of(spark, events)
    assert index["k"]["index_time"] == at(-10) and index["k"]["b_v"] is None
    index, _ = pairs_of(spark, events[:-1])
    assert (index["k"]["gap_minutes"], index["k"]["b_category"]) == (20 / 60, "b")


def test_first_pairs_equal_all_pairs(spark):
    rng = random.Random(5)
    events = [(f"k{rng.randint(0, 9)}", at(rng.randint(0, 20000)), rng.choice(["a", "a2", "b"]),
               float(rng.randint(0, 3))) for _ in range(400)]
    _, wide = pairs_of(spark, events)
    for k in {e[0] for e in events}:
        best = min(((min(x[1], y[1]), int(abs((y[1] - x[1]).total_seconds())), x[1], y[1], x[2],
                     y[2], x[3], y[3]) for x in events for y in events
                    if x[0] == y[0] == k and x[2] in ("a", "a2") and y[2] == "b"
                    and int(abs((y[1] - x[1]).total_seconds())) <= 1800), default=None)
        if best is None:
            assert k not in wide
            continue
        r = wide[k]
        assert (r["index_time"], r["a_time"], r["b_time"], r["a_category"], r["a_v"],
                r["b_v"]) == (best[0], best[2], best[3], best[4], best[6], best[7])


def gaps(spark, lo, hi, offsets, bounds="[]"):
    index = rows(spark, [("k", T0)], "k string, i timestamp_ntz")
    events = rows(spark, [("k", at(o), float(o)) for o in offsets],
                  "k string, t timestamp_ntz, o double")
    hit = T.window_join(index, events, "k", "i", "t", lo, hi, bounds)
    return sorted(r["o"] for r in hit.collect())


def test_window_edges(spark):
    six = 21600
    assert gaps(spark, 0, six, [-1, -0.5, 0, six, six + 0.5, six + 1]) == [-0.5, 0, six, six + .5]
    assert gaps(spark, -3600, 0, [0, -1, -3600, -3601], "[)") == [-3600, -1]
    assert gaps(spark, -120, 0, [0, -120, -121]) == [-120, 0]


def test_window_join_equals_plain_join(spark):
    rng = random.Random(2)
    # One entity holds most of the events.
    events = [("hot" if rng.random() < 0.7 else f"k{rng.randint(0, 5)}",
               at(rng.uniform(-200000, 200000)), i) for i in range(1500)]
    index = [("hot", at(0)), *[(f"k{i}", at(rng.uniform(-50000, 50000))) for i in range(5)]]
    got = {(r["k"], r["n"]) for r in T.window_join(
        rows(spark, index, "k string, i timestamp_ntz"),
        rows(spark, events, "k string, t timestamp_ntz, n long"), "k", "i", "t", -7200,
        3600).collect()}
    start = dict(index)
    want = {(k, n) for k, t, n in events if k in start
            and -7200 <= int((t - start[k]).total_seconds()) <= 3600}
    assert got == want and want


def test_stay_edges(spark):
    index = rows(spark, [(k, T0) for k in "abc"], "k string, i timestamp_ntz")
    stays = rows(spark, [("a", at(0), at(60), "x"), ("b", at(-60), at(0), "x"),
                         ("c", at(-60), None, "x")],
                 "k string, s timestamp_ntz, e timestamp_ntz, c string")
    hit = T.point_in_interval(index, stays, "k", "i", "s", "e")
    assert [r["k"] for r in hit.collect()] == ["a"]
    hit = T.point_in_interval(index, stays, "k", "i", "s", "e", open_end=True)
    assert sorted(r["k"] for r in hit.collect()) == ["a", "c"]
    last = X.last_stay(stays.unionByName(rows(
        spark, [("c", at(-90), at(-80), "y")], stays.schema)), "k", "s", "e", "c")
    assert {r["k"]: r["last_location"] for r in last.collect()}["c"] == "y"


def history_case(spark, lookback=None, strict=False):
    rng = random.Random(11)
    day = 86400
    entities, events, index = [], [], []
    for e in range(60):
        owner = "hot" if e % 3 == 0 else f"o{e % 7}"
        began = at(rng.randint(0, 900) * day)
        entities.append((f"e{e}", owner, began))
        for _ in range(rng.randint(0, 4)):
            # Some values come long after the entity began, some before.
            events.append((f"e{e}", began + dt.timedelta(days=rng.randint(-5, 400)),
                           float(rng.randint(0, 999))))
        index.append((f"e{e}", began + dt.timedelta(days=rng.randint(-2, 40))))
    got = T.from_history(
        rows(spark, index, "k string, i timestamp_ntz"),
        rows(spark, entities, "k string, o string, b timestamp_ntz"),
        rows(spark, events, "k string, t timestamp_ntz, v double"), "k", "o", "b", "i", "t", "v",
        lookback, strict)
    got = {r["k"]: (r["before_time"], r["before_value"]) for r in got.collect()}
    info = {k: (o, b) for k, o, b in entities}
    want = {}
    for k, i in index:
        owner, began = info[k]
        found = [(t, v) for e, t, v in events if info[e][0] == owner and info[e][1] < began
                 and (t < i if strict else t <= i)
                 and (lookback is None
                      or (began - info[e][1]).total_seconds() <= lookback * day)]
        if found:
            want[k] = max(found)
    return got, want


@pytest.mark.parametrize("lookback,strict", [(None, False), (200, False), (365.25, True)])
def test_history_equals_brute_force(spark, lookback, strict):
    got, want = history_case(spark, lookback, strict)
    assert got == want and want


def test_measurement_sources(spark):
    index = rows(spark, [(k, T0) for k in ("at", "after", "none", "old")],
                 "k string, i timestamp_ntz")
    events = rows(spark, [("at", at(0), 1.0), ("at", at(-5), 2.0), ("after", at(9), 3.0)],
                  "k string, t timestamp_ntz, v double")
    history = rows(spark, [("old", at(-99), 4.0)],
                   "k string, before_time timestamp_ntz, before_value double")
    got = {r["k"]: r for r in T.nearest_measurement(
        index, events, "k", "i", "t", "v",
        {"current": "now", "history": "then", "none": "never"}, history).collect()}
    assert [(got[k]["value"], got[k]["value_source"], got[k]["post_value"]) for k in
            ("at", "after", "none", "old")] == [
        (1.0, "now", None), (None, "never", 3.0), (None, "never", None), (4.0, "then", None)]


def test_exclusions_and_steps(spark):
    df = rows(spark, [(1, 5.0), (2, None), (3, 50.0), (4, 7.0)], "k long, v double")
    kept, flow = C.inclusion_exclusion(df, [
        C.Step("known or low", ~(F.col("v") > 20), "high"),
        C.Step("not seven", F.col("v") != 7, None, {"n_seven": F.col("v") == 7})])
    assert [r["k"] for r in kept.collect()] == [1]
    flow = flow.orderBy("step").collect()
    assert [(r["n_remaining"], r["n_excluded"]) for r in flow] == [(4, 0), (2, 2), (1, 1)]
    assert flow[2]["n_seven"] == 1


def test_outcomes(spark):
    index = rows(spark, [(k, T0, at(86400), s) for k, s in
                         (("icu", "Expired"), ("ward", "expired"), ("null", None))],
                 "k string, b timestamp_ntz, f timestamp_ntz, s string")
    stays = rows(spark, [("icu", at(0), at(9), "icu"), ("ward", at(0), at(9), "icu"),
                         ("ward", at(9), at(10), "ward"), ("null", at(0), at(9), "icu")],
                 "k string, a timestamp_ntz, z timestamp_ntz, c string")
    got = {r["k"]: (r["los_days"], r["died"], r["died_in_unit"]) for r in X.outcomes(
        index, stays, "k", "b", "f", "s", "a", "z", "c", "icu", "expired|death").collect()}
    assert got == {"icu": (1.0, 1, 1), "ward": (1.0, 1, 0), "null": (1.0, None, 0)}


def test_heavy_keys_come_from_sketches(spark, monkeypatch):
    monkeypatch.setattr(T, "HEAVY_ROWS", 1000)
    events = spark.range(300_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 100 = 1 THEN 8 ELSE id END AS k", "id AS v").repartition(6)
    heavy = {r["_heavy"]: r["_salts"] for r in T.heavy_keys(events, F.xxhash64("k")).collect()}
    hashes = {r["h"]: r["k"] for r in spark.createDataFrame([(7,), (8,)], "k long").select("k", F.xxhash64("k").alias("h")).collect()}
    assert {hashes.get(h) for h in heavy} == {7, 8}
    salts = {hashes[h]: n for h, n in heavy.items()}
    assert 100 <= salts[7] <= 102 and salts[8] in (2, 3)  # shares are 1,000 rows of 100,000 and 2,000
    index = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c"), (10, "d"), (999_999, "e"), (None, "f")], "k long, w string")
    found = T.spread_join(index, events, "k", ["v"])
    plain = index.join(events, "k")
    assert found.groupBy("k", "w").count().exceptAll(plain.groupBy("k", "w").count()).count() == 0
    assert found.count() == plain.count()
    assert T.spread_join(index, events.limit(0), "k", ["v"]).count() == 0
