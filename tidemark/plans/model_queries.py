"""Model queries: price per unit by provider within site, and low-priced lines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..operators import bootstrap as R, design as D, glmm as G, impute as I, lmm as L
from ..operators.laplace import equal_rows
from ..operators.quality import z_scores
from .registry import query
from .standins import encounters, events

NUMERIC = ["discount_s", "tax_s"]


def _rows(spark, sf):
    enc = encounters(spark, sf).where(F.col("weight").isNotNull())
    scaled = z_scores(enc, {"discount": "discount_s", "tax": "tax_s"})
    # Lines carry no group effects of their own, so both outcomes get some by provider and site.
    shift = 0.1 * (F.col("provider") % 7) + 0.15 * (F.col("site") % 5)
    return (scaled.withColumn("price", F.log("dose_per_weight") + shift)
            .withColumn("low", (F.log("dose_per_weight") + 3 * shift < 8).cast("int")))


def _design(rows, outcome, numeric=NUMERIC, fit="drug", keep=()):
    varying, _ = D.varying_terms(rows, numeric, [])
    return D.design(rows, outcome, varying, {"place": ["A", "N", "R"]}, "site", "provider", fit,
                    keep)


def _out(spark, frame: pd.DataFrame):
    return spark.createDataFrame(frame)


@query("lmm_variance")
def lmm_variance(spark, sf):
    sums = L.sufficient_sums(_design(_rows(spark, sf), "price"))
    return _out(spark, L.variance_components(L.fit_lmm(sums)))


@query("lmm_icc")
def lmm_icc(spark, sf):
    sums = L.sufficient_sums(_design(_rows(spark, sf), "price"))
    return _out(spark, L.icc_table(L.fit_lmm(sums)))


@query("lmm_fixed")
def lmm_fixed(spark, sf):
    model = _design(_rows(spark, sf), "price")
    sums = L.sufficient_sums(model)
    fitted = L.fit_lmm(sums)
    return _out(spark, L.fixed_effects(fitted, model.names,
                                       dof=L.degrees_of_freedom(sums, fitted)))


@query("lmm_raw")
def lmm_raw(spark, sf):
    sums = L.sufficient_sums(_design(_rows(spark, sf), "dose"))
    return _out(spark, L.variance_components(L.fit_lmm(sums)))


def _bootstrap(spark, sf, outcome: str, replicates: int):
    model = _design(_rows(spark, sf), outcome)
    model = D.Design(R.with_row_number(model.rows), model.names)
    fitted = L.fit_lmm(L.sufficient_sums(model))
    shares = L.variance_components(fitted)
    spans = R.bootstrap_shares(model, fitted, ["row_key"], replicates, 20260319)
    return _out(spark, shares.merge(spans, on=["fit", "component"]))


@query("lmm_bootstrap")
def lmm_bootstrap(spark, sf, replicates: int = 1000):
    return _bootstrap(spark, sf, "price", replicates)


@query("lmm_raw_bootstrap")
def lmm_raw_bootstrap(spark, sf, replicates: int = 500):
    return _bootstrap(spark, sf, "dose", replicates)


@query("group_fixed_lrt")
def group_fixed_lrt(spark, sf):
    return _out(spark, L.unit_fixed_test(L.sufficient_sums(_design(_rows(spark, sf), "price"))))


@query("glmm_mor")
def glmm_mor(spark, sf):
    model = _design(_rows(spark, sf), "low")
    return _out(spark, G.odds_summary(G.fit_glmm(model)))


@query("glmm_subgroups")
def glmm_subgroups(spark, sf):
    model = _design(_rows(spark, sf), "low", keep=("quarter",))
    return _out(spark, G.fit_subgroups(model, {"quarter": "quarter"}))


@query("time_trend")
def time_trend(spark, sf):
    enc = equal_rows(encounters(spark, sf), ["site", "year", "place", "drug"])
    first = enc.agg(F.min("year")).first()[0]
    rows = enc.withColumn("year_c", (F.col("year") - first).cast("double")).withColumn(
        "chosen", (F.col("drug") == "O").cast("int"))
    model = D.design(rows, "chosen", ["year_c"], {"place": ["A", "N", "R"]}, "site", "site", keep=("times",))
    fitted = G.fit_trend(model)
    return _out(spark, L.fixed_effects(fitted, model.names, exponentiate=True))


@query("impute_pmm")
def impute_pmm(spark, sf):
    ev = events(spark, sf).select(
        "event_id", "event_type",
        F.when((F.col("event_id") % 7 != 0), F.col("value")).alias("value"),
        F.when((F.col("event_id") % 11 != 0), F.log1p("value") + F.col("user_id") % 5)
        .alias("score"), F.hour("ts").cast("double").alias("hour"))
    done, _ = I.impute_pmm(ev, "event_id", ["value", "score"], ["hour"], {
        "event_type": ["click", "error", "purchase", "signup", "view"]}, iterations=10)
    return done.select("event_id", F.round("value", 6).alias("value"),
                       F.round("score", 6).alias("score"))
