"""Ranks, quantiles, bands, levels and models against direct computation."""

import math
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.recode import band, band_within
from tidemark.operators import (bootstrap as R, describe as B, design as D, glmm as G,
                                impute as I, laplace as P, lmm as L, quality as Q)
from tidemark.operators.quality import z_scores
from tidemark.operators.ranking import quantiles, ranked, running_max
from tidemark.session import materialise


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({
        "g": np.where(rng.random(3000) < 0.8, "hot", rng.choice(list("abc"), 3000)),
        "x": np.where(rng.random(3000) < 0.3, 7.0, rng.normal(0, 50, 3000).round(1)),
        "i": np.arange(3000)})
    pdf.loc[::50, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.nanvl("x", F.lit(None)))
    return pdf, df.repartition(6)


def test_rank_and_running_max(skewed):
    pdf, df = skewed
    want = pdf.dropna().sort_values(["g", "x", "i"])
    got = ranked(df.where("x is not null"), ["x", "i"], ["g"]).toPandas().sort_values(
        ["g", "x", "i"])
    assert (got["rank_no"].to_numpy() == want.groupby("g").cumcount().to_numpy() + 1).all()
    top = running_max(df.where("x is not null"), ["i"], "x", ["g"]).toPandas().sort_values(
        ["g", "i"])
    want = pdf.dropna().sort_values(["g", "i"]).groupby("g")["x"].cummax()
    assert (top["so_far"].to_numpy() == want.to_numpy()).all()


@pytest.mark.parametrize("p", [0.0, 0.01, 0.25, 0.5, 0.9, 1.0])
def test_quantiles(skewed, p):
    pdf, df = skewed
    got = quantiles(df, "x", [(p, "linear"), (p, "nearest")], ["g"]).toPandas()
    for g, x in pdf.dropna().groupby("g")["x"]:
        mine = got[got["g"] == g].set_index("rule")["quantile"]
        assert mine["linear"] == pytest.approx(x.quantile(p), abs=1e-12)
        assert mine["nearest"] == np.sort(x)[math.floor((len(x) - 1) * p + 0.5)]
        assert (got[got["g"] == g]["n_values"] == len(x)).all()


def test_quantiles_sort_only_the_bins_they_fall_into(spark, monkeypatch):
    x = np.random.default_rng(5).lognormal(3, 1, 20000)
    x[:8] = [0.0, -0.0, 5e-324, -5e-324, np.inf, -np.inf, -1e300, 1e300]
    x[8:4000] *= -1
    df = spark.createDataFrame(pd.DataFrame({"x": x, "g": np.arange(len(x)) % 2})).withColumn(
        "g", F.when(F.col("g") == 1, "a"))  # a missing group is a group
    sizes = {}

    def count(rows, label="stage"):
        out = materialise(rows, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr("tidemark.operators.ranking.materialise", count)
    probs = (0.0, 0.1, 0.5, 0.999, 1.0)
    got = quantiles(df, "x", [(p, "nearest") for p in probs], ["g"]).toPandas()
    assert sizes["counted"] < 500 and sizes["sorted"] < 500
    for g, own in ((None, np.sort(x[::2])), ("a", np.sort(x[1::2]))):
        mine = got[got["g"].isna() if g is None else got["g"] == g].sort_values("prob")
        assert mine["quantile"].tolist() == [own[math.floor((len(own) - 1) * p + 0.5)] for p in probs]
    whole = quantiles(df, "x", [(0.5, "linear")]).toPandas()
    assert whole["quantile"].tolist() == [np.median(x)]


def test_bands(spark):
    df = spark.createDataFrame([(0.04,), (0.05,), (0.60,), (None,)], "x double")
    edges, names = [0.05, 0.6], ["<0.05", "0.05-0.59", ">0.60"]
    got = df.select(band("x", edges, names), band_within(
        "x", F.lit("e"), {"e": (edges, names)}, True)).collect()
    assert [r[0] for r in got] == ["<0.05", "0.05-0.59", ">0.60", None]
    assert [r[1] for r in got] == ["<0.05", "0.05-0.59", ">0.60", ">0.60"]


def collapsed(spark, sizes):
    rows = [(k,) for k, n in sizes.items() for _ in range(n)]
    out = Q.collapse_levels(spark.createDataFrame(rows, "level string"), "level", 10, "other")
    return {r[0]: r[1] for r in out.groupBy("level").count().collect()}


def test_rare_levels(spark):
    assert collapsed(spark, {"a": 20, "b": 10, "c": 9, "other": 9}) == {
        "a": 20, "b": 10, "other": 18}
    assert collapsed(spark, {"a": 20, "b": 20, "c": 9}) == {"a": 29, "b": 20}


def test_all_missing_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "g string, x double")
    out = B.table_one(df, "g", ["a", "b"], ["x"], {"pct": F.col("x") == 1}).collect()
    got = {r["statistic"]: (r["a"], r["b"]) for r in out}
    assert got["pct"] == (100.0, None) and got["x_median"] == (1.0, None)


def nested(seed=0, n=600, binary=False, site_sd=0.6):
    rng = np.random.default_rng(seed)
    unit = rng.integers(0, 30, n)
    site = unit % 5
    x = rng.normal(size=n)
    eta = 0.5 + 0.8 * x + rng.normal(0, 0.7, 30)[unit] + rng.normal(0, site_sd, 5)[site]
    y = (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(float) if binary else (
        eta + rng.normal(size=n))
    return pd.DataFrame({"y": y, "x": x, "site": site, "unit": unit, "i": np.arange(n),
                         "m": "m"})


def dense_deviance(pdf, tp, th):
    x = np.column_stack([np.ones(len(pdf)), pdf["x"]])
    zu = (pdf["unit"].to_numpy()[:, None] == np.arange(30)).astype(float)
    zs = (pdf["site"].to_numpy()[:, None] == np.arange(5)).astype(float)
    v = np.eye(len(pdf)) + tp * zu @ zu.T + th * zs @ zs.T
    vi = np.linalg.inv(v)
    a = x.T @ vi @ x
    beta = np.linalg.solve(a, x.T @ vi @ pdf["y"])
    r = pdf["y"] - x @ beta
    df = len(pdf) - 2
    s2 = r @ vi @ r / df
    return (df * (np.log(2 * np.pi * s2) + 1) + np.linalg.slogdet(v)[1]
            + np.linalg.slogdet(a)[1]), s2, beta


def test_lmm_against_dense_likelihood(spark):
    pdf = nested()
    model = D.design(spark.createDataFrame(pdf), "y", ["x"], {}, "site", "unit", "m", ("i",))
    sums = L.sufficient_sums(model)
    got = L.evaluate_points(sums, [("m", (0.3, 0.2)), ("m", (0.0, 0.7))], True)
    for i, point in enumerate([(0.3, 0.2), (0.0, 0.7)]):
        dev, s2, beta = dense_deviance(pdf, *point)
        assert got.loc[i, "deviance"] == pytest.approx(dev, abs=1e-6)
        assert got.loc[i, "sigma2"] == pytest.approx(s2, rel=1e-9)
        assert got.loc[i, "beta"] == pytest.approx(beta, rel=1e-8)
    fitted = L.fit_lmm(sums).iloc[0]
    best = fitted["deviance"]
    for tp in (0.9, 1.1):
        for th in (0.9, 1.1):
            assert best < dense_deviance(pdf, fitted["tp"] * tp, fitted["th"] * th)[0]
    shares = L.variance_components(L.fit_lmm(sums))
    assert shares["pct_variance"].sum() == pytest.approx(100)
    spans = R.bootstrap_shares(model, L.fit_lmm(sums), ["i"], 12, 7)
    assert (spans["ci_lo"] <= spans["ci_hi"]).all() and (spans["n_replicates"] == 12).all()
    test = L.unit_fixed_test(sums).iloc[0]
    assert test["lrt_df"] == 29 and 0 <= test["lrt_p"] < 0.05


def replicate_rows(model, keys, replicates, seed):
    """(fit, replicate, site, n) sums and products as plain rows."""
    folded, totals = R.replicate_sums(model, keys, replicates, seed)
    sums = sorted((r["fit"], r["replicate"], r["site"], r["n"], tuple(np.round(r["u"], 8))) for r in folded.collect())
    return sums, sorted((r["fit"], r["replicate"], tuple(np.round(r["products"], 8))) for r in totals.collect())


@pytest.mark.parametrize("block", [4096, 20])
def test_bootstrap_draws_exactly_n_rows_however_they_lie(spark, monkeypatch, block):
    monkeypatch.setattr(R, "BLOCK", block)
    pdf = nested()
    pdf.loc[: len(pdf) // 3, "unit"] = 0
    pdf.loc[: len(pdf) // 3, "site"] = 0
    frame = spark.createDataFrame(pdf)
    got = []
    for rows in (frame.coalesce(1), frame.repartition(7, "y")):
        model = D.design(rows, "y", ["x"], {}, "site", "unit", "m", ("i",))
        got.append(replicate_rows(model, ["i"], 25, 7))
    assert got[0] == got[1]
    drawn = {}
    for _, replicate, _, n, u in got[0][0]:
        drawn[replicate] = drawn.get(replicate, 0) + n * u[0]
    assert drawn == {k: len(pdf) for k in range(1, 26)}
    assert len({p for _, _, p in got[0][1]}) == 25
    # products have the mean and spread of n draws with replacement
    z = np.column_stack((pdf["y"], np.ones(len(pdf)), pdf["x"]))
    names = R.totals_of(2)
    products = np.array([p for _, _, p in replicate_rows(D.design(frame, "y", ["x"], {}, "site", "unit", "m", ("i",)), ["i"], 400, 3)[1]])
    for k, (i, j) in enumerate(names):
        own = z[:, i] * z[:, j]
        spread_of = math.sqrt(len(own)) * own.std()
        assert products[:, k].mean() == pytest.approx(own.sum(), abs=5 * spread_of / 20 + 1e-6)
        assert products[:, k].std() == pytest.approx(spread_of, rel=0.2, abs=1e-6)


def test_folded_replicate_is_fitted_like_its_rows(spark):
    pdf = nested()
    model = D.design(spark.createDataFrame(pdf), "y", ["x"], {}, "site", "unit", "m", ("i",))
    folded, totals = R.replicate_sums(model, ["i"], 3, 11)
    sums = folded.where("replicate = 2").toPandas()
    products = np.array(totals.where("replicate = 2").first()["products"])
    fitted = R.fit_folded(sums, products, 2, L.NESTED, L.COARSE[L.NESTED])
    # the drawn rows themselves, from the same generators
    blocks = {r["name"]: r for r in R.packed_blocks(model, ["i"], R.RANGES).collect()}
    drawn = {r["name"]: np.frombuffer(r["draws"], "<i4") for r in R.drawn_blocks(
        R.packed_blocks(model, ["i"], R.RANGES), 3, 11).collect()}
    rows = []
    for name, b in blocks.items():
        times = R.row_draws(drawn[name], b["rows"], 11, 1 << 41, name)[1]
        for k, n in enumerate(times):
            rows += [{"y": b["y"][k], "x": b["x"][1][k], "unit": int(b["unit"]), "site": int(b["site"])}] * int(n)
    again = pd.DataFrame(rows).assign(m="m")
    assert len(again) == len(pdf)
    direct = L.fit_structures(L.sufficient_sums(D.design(spark.createDataFrame(again), "y", ["x"], {}, "site", "unit", "m")),
                              [("m", L.NESTED)]).iloc[0]
    assert fitted["sigma2"] == pytest.approx(direct["sigma2"], rel=1e-3)
    assert fitted["tp"] == pytest.approx(direct["tp"], rel=0.02) and fitted["th"] == pytest.approx(direct["th"], rel=0.02, abs=1e-3)


def test_percentile_limits():
    values = np.arange(1.0, 1001.0)
    assert R.percentile_limit(values, 0.025) == pytest.approx(25.0250, abs=5e-3)
    assert R.percentile_limit(values[:999], 0.025) == 25.0
    assert R.percentile_limit(values[:10], 0.025) == 1.0 and R.percentile_limit(values[:10], 0.975) == 10.0


def test_balanced_design_equals_anova(spark):
    rng = np.random.default_rng(4)
    y = rng.normal(size=(12, 8)) + rng.normal(0, 1.5, 12)[:, None]
    pdf = pd.DataFrame({"y": y.ravel(), "unit": np.repeat(np.arange(12), 8), "site": 0, "m": "m"})
    model = D.design(spark.createDataFrame(pdf), "y", [], {}, "site", "unit", "m")
    got = L.fit_lmm(L.sufficient_sums(model)).iloc[0]
    within = y.var(axis=1, ddof=1).mean()
    between = y.mean(axis=1).var(ddof=1) - within / 8
    assert got["structure"] == L.UNIT
    assert got["sigma2"] == pytest.approx(within, rel=1e-5)
    assert got["tp"] * got["sigma2"] == pytest.approx(between, rel=1e-3)


def dense_laplace(pdf, x, beta, tp, th):
    """Half the Laplace deviance at the modes of the effects, with dense matrices."""
    z, d = [], []
    for column, variance in (("unit", tp), ("site", th)):
        if variance > 0:
            number = pd.factorize(pdf[column])[0]
            z.append((number[:, None] == np.arange(number.max() + 1)).astype(float))
            d += [variance] * (number.max() + 1)
    y, fixed = pdf["y"].to_numpy(), x @ beta
    if not z:
        return float((np.logaddexp(0, fixed) - y * fixed).sum())
    z, d = np.column_stack(z), np.array(d)
    b = np.zeros(len(d))
    for _ in range(60):
        mu = 1 / (1 + np.exp(-(fixed + z @ b)))
        h = z.T @ ((mu * (1 - mu))[:, None] * z)
        b += np.linalg.solve(h + np.diag(1 / d), z.T @ (y - mu) - b / d)
    eta = fixed + z @ b
    mu = 1 / (1 + np.exp(-eta))
    h = z.T @ ((mu * (1 - mu))[:, None] * z)
    return float((np.logaddexp(0, eta) - y * eta).sum() + (b * b / d).sum() / 2
                 + np.linalg.slogdet(np.eye(len(d)) + d[:, None] * h)[1] / 2)


def binary_rows(seed, n, tp, th, name="m"):
    rng = np.random.default_rng(seed)
    unit = rng.integers(0, 30, n)
    unit[: n // 3] = 0  # one unit with a third of the rows
    x = rng.normal(size=n)
    eta = -0.3 + 0.8 * x + rng.normal(0, math.sqrt(tp), 30)[unit] + rng.normal(0, math.sqrt(th), 5)[unit % 5]
    return pd.DataFrame({"y": (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(float), "x": x, "unit": unit,
                         "site": unit % 5, "m": name})


@pytest.mark.parametrize("block", [4096, 16])
def test_laplace_gradient_against_dense_differences(spark, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK", block)
    pdf = binary_rows(3, 400, 1.0, 0.5)
    model = D.design(spark.createDataFrame(pdf), "y", ["x"], {}, "site", "unit", "m")
    solver = P.LaplaceSolver(materialise(model.rows), model.xs)
    place = np.array([0.2, 0.5, 0.64, 0.36])
    at = {"m": (place[:2], np.sqrt(place[2:]))}
    effects = solver._start({"m": P.Fit("m", (True, True), *at["m"])})
    for _ in range(6):
        sums = solver._unit_sums(effects, {"m": place[:2]})
        value = solver._values(sums, at)["m"]
        effects = solver._moved_effects(sums, at, at)
    solver.close()
    x = np.column_stack([np.ones(len(pdf)), pdf["x"]])
    dense = lambda q: dense_laplace(pdf, x, q[:2], *q[2:])
    assert value[0] == pytest.approx(dense(place), abs=1e-8) and abs(value[1]) < 1e-12
    slope = [(dense(place + e) - dense(place - e)) / 2e-5 for e in np.eye(4) * 1e-5]
    assert [*value[6:8], *value[2:4]] == pytest.approx(slope, rel=1e-5, abs=1e-5)


def test_logistic_fits_are_joint_optima(spark):
    truth = {"a": (1.0, 0.5), "b": (12.0, 0.0), "c": (0.01, 0.3)}
    rows = {m: binary_rows(k, 700, *v, m) for k, (m, v) in enumerate(truth.items())}
    model = D.design(spark.createDataFrame(pd.concat(rows.values())), "y", ["x"], {}, "site", "unit", "m")
    model = D.Design(materialise(model.rows), model.names)
    fitted = G.fit_structures(model, [(m, s) for m in truth for s in (L.NESTED, L.SITE, L.UNIT, G.NONE)])
    assert len(fitted) == 12 and fitted["converged"].all()
    for r in fitted.itertuples():
        x = np.column_stack([np.ones(700), rows[r.fit]["x"]])
        free = [r.structure in (L.NESTED, L.UNIT) and r.tp > 0, r.structure in (L.NESTED, L.SITE) and r.th > 0]
        dense = lambda q: dense_laplace(rows[r.fit], x, q[:2], q[2]**2, q[3]**2)  # noqa: B023, E731
        place = np.array([*r.beta, math.sqrt(r.tp), math.sqrt(r.th)])
        assert r.deviance / 2 == pytest.approx(dense(place), abs=1e-6)
        for on, e in zip([True, True, *free], np.eye(4) * 1e-4):
            assert not on or abs(dense(place + e) - dense(place - e)) / 2e-4 < 2e-2
        for on, e in zip([True, True, *free], np.eye(4) * 0.05):
            assert not on or dense(place) < min(dense(place + e), dense(place - e))
        # with a variance at zero a positive one is no better
        for k, structures in ((2, (L.NESTED, L.UNIT)), (3, (L.NESTED, L.SITE))):
            if r.structure in structures and place[k] == 0:
                assert dense(place) <= dense(place + 0.1 * np.eye(4)[k]) + 1e-6
    nested = fitted[fitted["structure"] == L.NESTED].set_index("fit")
    assert nested.loc["b", "tp"] > 5 and not nested.loc["a", "singular"]
    assert G.median_odds_ratio(0) == 1


def test_small_and_degenerate_logistic_models(spark):
    rng = np.random.default_rng(5)
    one = pd.DataFrame({"y": (rng.random(200) < 0.4).astype(float), "x": 1.0, "unit": np.arange(200) % 7, "site": 0, "m": "one"})
    model = D.design(spark.createDataFrame(one), "y", ["x"], {}, "site", "unit", "m")  # x equals the intercept
    fitted = G.fit_structures(D.Design(materialise(model.rows), model.names), [("one", G.NONE)]).iloc[0]
    mean = one["y"].mean()
    assert fitted["beta"][0] == pytest.approx(math.log(mean / (1 - mean)), abs=1e-4)
    assert math.isnan(fitted["beta"][1]) and math.isnan(fitted["se"][1])
    assert fitted["se"][0] == pytest.approx(1 / math.sqrt(200 * mean * (1 - mean)), rel=1e-4)


def test_degrees_of_freedom_in_a_balanced_design(spark):
    # One between-unit and one within-unit covariate, so the exact answers are known.
    rng = np.random.default_rng(6)
    units, each = 14, 10
    w = np.tile(np.repeat([-1.0, 1.0], each // 2), units)
    b = np.repeat(np.tile([-1.0, 1.0], units // 2), each)
    y = np.repeat(rng.normal(0, 1.5, units), each) + 0.3 * w + rng.normal(size=units * each)
    pdf = pd.DataFrame({"y": y, "w": w, "b": b, "unit": np.repeat(np.arange(units), each),
                        "site": 0, "m": "m"})
    sums = L.sufficient_sums(D.design(spark.createDataFrame(pdf), "y", ["w", "b"], {}, "site",
                                      "unit", "m"))
    fitted = L.fit_lmm(sums)
    dof = L.degrees_of_freedom(sums, fitted)["m"]
    assert dof[0] == pytest.approx(units - 2, rel=0.01)
    assert dof[2] == pytest.approx(units - 2, rel=0.01)
    assert dof[1] == pytest.approx(units * (each - 1) - 1, rel=0.01)


def test_tails():
    assert L.student_tails(2.2281388519649385, 10) == pytest.approx(0.05, abs=1e-9)
    assert L.student_tails(-0.3, 4) == pytest.approx(0.7790, abs=1e-3)
    assert L.student_tails(0.0, 7) == 1.0


def test_chi_square_tail():
    assert L.chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert L.chi_square_tail(124.34211340400407, 100) == pytest.approx(0.05, abs=1e-9)


def test_matching_takes_one_of_the_nearest(spark):
    rng = np.random.default_rng(0)
    n = 400
    pdf = pd.DataFrame({"k": np.arange(n), "x": rng.normal(size=n).round(2)})
    pdf["t"] = 3 * pdf["x"] + rng.normal(0, 0.5, n)
    pdf.loc[rng.random(n) < 0.2, "t"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("t", F.nanvl("t", F.lit(None)))
    frame = df.withColumn("_miss_t", F.col("t").isNull()).withColumn(
        "t", F.coalesce("t", F.lit(0.0)))
    terms, seed = [F.col("x")], [1, 2]
    fitted, drawn, _ = I._draw(frame, "t", terms, np.random.default_rng(seed))
    picks = I._matched(frame, "k", "t", terms, np.random.default_rng(seed), 5, 1, 1).toPandas()
    known = pdf.dropna()
    scores = fitted[0] + fitted[1] * known["x"]
    assert len(picks) == pdf["t"].isna().sum()
    for k, value in zip(picks["k"], picks["_pick"]):
        distance = (scores - (drawn[0] + drawn[1] * pdf["x"][k])).abs()
        limit = np.sort(distance)[4] + 1e-9
        assert value in set(known["t"][distance <= limit])
    done, method = I.impute_pmm(df, "k", ["t"], ["x"], {}, iterations=1)
    assert method == "pmm" and done.where("t is null").count() == 0
    same, method = I.impute_pmm(df.where("t is not null"), "k", ["t"], ["x"], {})
    assert method == "complete_case" and same.count() == len(known)


@pytest.mark.parametrize("variance", [5000.0, 0.001, 12.0])
def test_variance_search_has_no_ceiling(variance):
    # a deviance with its minimum far from the grid, and one without an inner minimum
    from tidemark.operators.variance_search import minimise
    inner = lambda tp, th: (math.log(max(tp, 1e-300) / variance)) ** 2 if tp > 0 else 1e6
    falling = lambda tp, th: -tp / (1 + tp)
    names = {"inner": inner, "falling": falling}
    grid = (0.0, 1e-2, 0.1, 1.0)
    got = minimise({m: (grid, (0.0,)) for m in names},
                   lambda points: {m: [names[m](*p) for p in at] for m, at in points.items()})
    assert got["inner"].point[0] == pytest.approx(variance, rel=1e-3) and got["inner"].converged
    assert got["falling"].point[0] > 1e6 and not got["falling"].converged


def test_logistic_fit_with_a_large_variance(spark):
    rng = np.random.default_rng(12)
    unit = np.repeat(np.arange(60), 20)
    eta = rng.normal(0, 3.5, 60)[unit]
    pdf = pd.DataFrame({"y": (rng.random(1200) < 1 / (1 + np.exp(-eta))).astype(float), "unit": unit,
                        "site": 0, "m": "m"})
    model = D.design(spark.createDataFrame(pdf), "y", [], {}, "site", "unit", "m")
    fitted = G.fit_glmm(model).iloc[0]
    assert fitted["tp"] > 6 and fitted["converged"]


def test_term_that_is_constant_in_one_model_only(spark):
    rng = np.random.default_rng(21)
    n = 400
    m = np.where(np.arange(n) % 2 == 0, "a", "b")
    z = np.where(m == "a", 1.0, rng.integers(0, 2, n))
    pdf = pd.DataFrame({"y": 1.6 + 0.5 * z * (m == "b") + rng.normal(size=n), "z": z, "m": m,
                        "unit": rng.integers(0, 20, n), "site": 0})
    model = D.design(spark.createDataFrame(pdf), "y", ["z"], {}, "site", "unit", "m")
    got = L.fixed_effects(L.fit_lmm(L.sufficient_sums(model)), model.names)
    assert got[got["fit"] == "a"]["term"].tolist() == ["(Intercept)"]
    assert got[got["fit"] == "b"]["term"].tolist() == ["(Intercept)", "z"]
    mean = pdf[pdf["m"] == "a"]["y"].mean()
    assert got[got["fit"] == "a"]["estimate"].iloc[0] == pytest.approx(mean, abs=0.1)


def test_bootstrap_broadcasts_no_draws_and_holds_sums_of_bounded_parts(spark, monkeypatch, capsys):
    pdf = nested()
    model = D.design(spark.createDataFrame(pdf), "y", ["x"], {}, "site", "unit", "m", ("i",))
    whole = replicate_rows(model, ["i"], 25, 7)
    # draws and sums must not grow a plan's broadcast or a written row with the number of units
    written = []
    monkeypatch.setattr(R, "materialise", lambda df, label="stage": written.append((label, df)) or materialise(df, label))
    monkeypatch.setattr(R, "PART_ROWS", 60)
    monkeypatch.setattr(R, "PART_PAIRS", 100)
    monkeypatch.setattr(R, "CHUNK_PAIRS", 50)
    again = replicate_rows(model, ["i"], 25, 7)
    assert [x[:4] for x in again[0]] == [x[:4] for x in whole[0]]
    assert np.vstack([x[4] for x in again[0]]) == pytest.approx(np.vstack([x[4] for x in whole[0]]), abs=1e-6)
    sums = dict(written)["replicate-sums"]
    sums.explain()
    plan = capsys.readouterr().out
    assert "FlatMapCoGroups" in plan and "draws" not in "".join(
        line for line in plan.splitlines() if "BroadcastHashJoin" in line or "BroadcastExchange" in line)
    assert sums.where("unit is not null").isEmpty()  # units of one block are added up where they are drawn


def test_folding_units_holds_little_more_than_their_sums():
    rng, p, width = np.random.default_rng(3), 5, 7
    v = rng.normal(size=(400, 300, width))
    v[:, :, 0] = rng.integers(0, 40, v.shape[:2])
    tracemalloc.start()
    key, u = R.folded_units(v)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 3 * v.nbytes  # 28 columns of products for each pair would be 8 times as much
    for at in (0, len(key) // 2, len(key) - 1):
        replicate, n = key[at] >> R.N_BITS, key[at] & ((1 << R.N_BITS) - 1)
        own = v[v[:, replicate - 1, 0] == n, replicate - 1]
        r, x = own[:, 1], own[:, 2:]
        want = [len(own), r.sum(), r @ r, *x.sum(axis=0), *(r @ x), *((x.T @ x)[np.triu_indices(p)])]
        np.testing.assert_allclose(u[at], want, atol=1e-9)
    nothing = R.folded_units(np.zeros((2, 3, width)))
    assert len(nothing[0]) == 0 and nothing[1].shape == (0, 28)


def test_equal_rows_are_packed_once_and_count_as_often(spark, monkeypatch):
    packed = []
    plain = P.packed_rows
    monkeypatch.setattr(P, "packed_rows", lambda rows, xs: packed.append(rows.count()) or plain(rows, xs))
    pdf = binary_rows(5, 300, 1.0, 0.5)
    pdf["x"] = pdf["x"].round()
    frame = spark.createDataFrame(pd.concat([pdf] * 6))
    model = D.design(frame, "y", ["x"], {}, "site", "unit", "m")
    fitted = G.fit_structures(D.Design(materialise(model.rows), model.names), [("m", L.SITE), ("m", L.NESTED)])
    distinct = [len(pdf.drop_duplicates(keys)) for keys in (["site", "x", "y"], ["unit", "site", "x", "y"])]
    assert packed == distinct and distinct[0] < distinct[1] < len(pdf)
    six = pd.concat([pdf] * 6)
    for r in fitted.itertuples():
        dense = dense_laplace(six, np.column_stack([np.ones(len(six)), six["x"]]), np.array(r.beta), r.tp, r.th)
        assert r.deviance / 2 == pytest.approx(dense, abs=1e-6)


def _drawn_choices(spark, n=6000, units=300):
    rng = np.random.default_rng(11)
    site = rng.integers(0, 6, n)
    year = rng.integers(0, 4, n)
    chosen = rng.random(n) < 1 / (1 + np.exp(0.5 - 0.3 * year - 0.8 * (site % 3)))
    return spark.createDataFrame(pd.DataFrame({
        "site": site, "unit": rng.integers(0, units, n), "year": year, "chosen": chosen.astype(int),
        "ward": rng.choice(["a", "b"], n)}))


def _written(monkeypatch):
    sizes = []

    def count(df, label="stage"):
        out = materialise(df, label)
        sizes.append((label, out.count()))
        return out

    monkeypatch.setattr("tidemark.operators.laplace.materialise", count)
    return sizes


def test_trend_models_write_no_rows_by_unit(spark, monkeypatch):
    model = D.design(_drawn_choices(spark), "chosen", ["year"], {}, "site", "unit")
    sizes = _written(monkeypatch)
    got = G.fit_trend(model)
    assert max(n for label, n in sizes if label == "equal-rows") <= 6 * 4 * 2  # sites, years, outcomes
    whole = G.fit_structures(model, [("all", G.SITE)])
    assert (got["n"].item(), got["n_sites"].item(), got["structure"].item()) == (6000, 6, G.SITE)
    np.testing.assert_allclose(got["beta"].item(), whole["beta"].item(), rtol=1e-9)


def test_subgroups_are_formed_from_equal_rows(spark, monkeypatch):
    model = D.design(_drawn_choices(spark), "chosen", ["year"], {}, "site", "unit", keep=("ward",))
    seen, by_site = [], G._by_site
    monkeypatch.setattr(G, "_by_site", lambda m: (seen.append(m.rows.count()), by_site(m))[1])
    got = G.fit_subgroups(model, {"ward": "ward"}).sort_values("subgroup_value")
    assert seen[0] <= 6 * 4 * 2 * 2  # sites, years, outcomes, wards
    for value, n, icc in zip(got["subgroup_value"], got["n"], got["icc"], strict=True):
        own = D.Design(model.rows.where(F.col("ward") == value), model.names)
        alone = G.fit_structures(own, [("all", G.SITE)])["th"].item()
        assert n == own.rows.count()
        assert icc == pytest.approx(alone / (alone + math.pi**2 / 3), rel=1e-6)


def test_z_scores_scan_their_input_once(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 2.0)], "x double, same double")
    scaled = z_scores(df, {"x": "xs", "same": "ss"})
    assert "subquery" not in scaled._jdf.queryExecution().toString().lower()
    rows = scaled.orderBy("x").collect()
    assert [r["xs"] for r in rows] == pytest.approx([-2 / 7**0.5, -1 / 7**0.5, 3 / 7**0.5])
    assert [r["ss"] for r in rows] == [None] * 3
    assert z_scores(df.where("x > 10"), {"x": "xs"}).collect() == []


def test_a_unit_that_goes_over_an_arrow_batch_stays_one_block(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        pdf = binary_rows(3, 200, 1.0, 0.5)
        model = D.design(spark.createDataFrame(pdf), "y", ["x"], {}, "site", "unit", "m")
        blocks, _ = P.packed_rows(materialise(model.rows), model.xs)
        assert blocks.count() == pdf["unit"].nunique() == blocks.select("unit").distinct().count()
        blocks.unpersist()
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("levels", [2, 400])
def test_matching_shuffles_rows_once_and_picks_as_brute_force(spark, capsys, monkeypatch, levels):
    written = []
    monkeypatch.setattr(I, "materialise", lambda df, label="stage": written.append((label, df)) or materialise(df, label))
    rng = np.random.default_rng(17)
    pdf = pd.DataFrame({"k": np.arange(300), "x": rng.integers(0, levels, 300) / 7, "t": rng.normal(size=300).round(6)})
    pdf["_miss_t"] = rng.random(300) < 0.3
    pdf["y"] = pdf["k"] * 0.5
    frame, terms = spark.createDataFrame(pdf), [F.col("x")]
    fitted, drawn, _ = I._draw(frame, "t", terms, np.random.default_rng(3))
    got = I._matched(frame, "k", "t", terms, np.random.default_rng(3), 5, 1, 4, ["y"]).toPandas().set_index("k")
    u = frame.where("_miss_t").select("k", I.hash_uniform(F.lit(1), F.lit(4), F.col("k")).alias("u")).toPandas().set_index("k")["u"]
    known = pdf[~pdf["_miss_t"]].assign(p=lambda d: fitted[0] + fitted[1] * d["x"]).sort_values(["p", "k"])
    p, values = known["p"].to_numpy(), known["t"].to_numpy()
    assert len(got) == pdf["_miss_t"].sum()
    for k in got.index:
        at = drawn[0] + drawn[1] * pdf["x"][k]
        n = np.searchsorted(p, at, side="right")
        near = np.arange(max(0, n - 5), min(len(p), n + 5))
        near = near[np.argsort(np.abs(p[near] - at), kind="stable")][:5]
        assert got["_pick"][k] == values[near[int(u[k] * len(near))]] and got["y"][k] == k * 0.5
    assert [label for label, _ in written] == ["matched", "matched-at-ends"]  # only the filled rows are written
    assert dict(written)["matched"].where("_kind <> 2").count() == len(got)
