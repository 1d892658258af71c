"""What SQL can state of the models: their sums, likelihoods at given points, and closed forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bootstrap as R, design as D, glmm as G, impute as I, lmm as L
from ..session import materialise
from .model_queries import _design, _rows
from .registry import query
from .standins import ENCOUNTERS_SQL, encounters, events

MODEL_SQL = f"""{ENCOUNTERS_SQL},
used AS (SELECT *, ln(dose_per_weight) + 0.1 * (provider % 7) + 0.15 * (site % 5) AS price FROM enc WHERE weight IS NOT NULL)"""
POINTS = [(0.0, 0.0), (0.05, 0.0), (0.3, 0.2), (0.0, 0.7)]  # unit and site variance over the residual one


def _alone(spark, sf, one_site: bool = False):
    """The price by drug with an intercept alone, providers within sites or within one."""
    rows = _rows(spark, sf)
    return D.design(rows.withColumn("site", F.lit("all")) if one_site else rows, "price", [], {}, "site", "provider", "drug")


@query("design_products", f"""
WITH {MODEL_SQL},
z AS (SELECT drug, price, 1.0 AS t0, (discount - avg(discount) OVER ()) / stddev_samp(discount) OVER () AS t1,
             (tax - avg(tax) OVER ()) / stddev_samp(tax) OVER () AS t2, (place = 'N')::INT::DOUBLE AS t3,
             (place = 'R')::INT::DOUBLE AS t4 FROM used),
wide AS (SELECT drug AS fit, [price, t0, t1, t2, t3, t4] AS v FROM z),
long AS (SELECT fit, i, j, v[i + 1] * v[j + 1] AS p FROM wide, range(6) a(i), range(6) b(j) WHERE i <= j)
SELECT fit, i::INT AS i, j::INT AS j, round(sum(p), 3) AS product FROM long GROUP BY fit, i, j""")
def design_products(spark, sf):
    """Cross-products of outcome (0) and terms (from 1), from the sufficient sums of the model."""
    model = _design(_rows(spark, sf), "price")
    totals = L.sufficient_sums(model).totals
    p = len(model.names)
    cells = [(0, 0, F.col("yy")), *((0, i + 1, F.col("xy")[i]) for i in range(p)),
             *((i + 1, j + 1, F.col("xx")[k]) for k, (i, j) in enumerate(L.triangle(p)))]
    return totals.select("fit", F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.round(v, 3).alias("product")) for i, j, v in cells])))


@query("reml_at_points", f"""
WITH {MODEL_SQL},
u AS (SELECT drug, site, provider, count(*)::DOUBLE AS n, sum(price) AS r, sum(price * price) AS yy FROM used GROUP BY drug, site, provider),
points AS (SELECT * FROM (VALUES {", ".join(f"({i}, {tp}, {th})" for i, (tp, th) in enumerate(POINTS))}) v(point, tp, th)),
e AS (SELECT *, 1 / (1 + n * tp) AS k FROM u, points),
s AS (SELECT drug, point, any_value(tp) AS tp, any_value(th) AS th, site, sum(n * k) AS a, sum(r * k) AS c, sum(ln(1 + n * tp)) AS ld,
             sum(tp * k * n * n) AS wnn, sum(tp * k * n * r) AS wnr, sum(tp * k * r * r) AS wrr, sum(n) AS n, sum(r) AS r, sum(yy) AS yy
      FROM e GROUP BY drug, point, site),
w AS (SELECT drug, point, any_value(tp) AS tp, any_value(th) AS th, sum(n) AS rows_, sum(ld + ln(1 + th * a)) AS logdet,
             sum(n) - sum(wnn + th / (1 + th * a) * a * a) AS xx, sum(r) - sum(wnr + th / (1 + th * a) * a * c) AS xy,
             sum(yy) - sum(wrr + th / (1 + th * a) * c * c) AS yy FROM s GROUP BY drug, point),
v AS (SELECT *, xy / xx AS beta, (yy - xy * xy / xx) / (rows_ - 1) AS sigma2 FROM w)
SELECT drug AS fit, tp::DOUBLE AS tp, th::DOUBLE AS th, round(beta, 6) AS intercept, round(sigma2, 6) AS sigma2,
       round((rows_ - 1) * (ln(2 * pi() * sigma2) + 1) + logdet + ln(xx), 3) AS deviance,
       round(100 * tp / (1 + tp + th), 6) AS pct_unit, round(th / (1 + tp + th), 6) AS icc_site FROM v""")
def reml_at_points(spark, sf):
    sums = L.sufficient_sums(_alone(spark, sf))
    fits = [r["fit"] for r in sums.totals.select("fit").collect()]
    got = L.evaluate_points(sums, [(fit, point) for fit in fits for point in POINTS], True)
    got = got.assign(structure=L.NESTED, singular=False, converged=True).reset_index(drop=True)
    parts = got.assign(fit=got.index).pipe(L.variance_components)
    pct = parts[parts["component"] == "unit"].set_index("fit")["pct_variance"]
    out = got.assign(intercept=[b[0] for b in got["beta"]], pct_unit=pct, icc_site=L.icc_table(
        got.assign(n_sites=2, n_units=2, n_obs=0))["icc_site"])
    return spark.createDataFrame(out[["fit", "tp", "th", "intercept", "sigma2", "deviance", "pct_unit", "icc_site"]]).select(
        "fit", "tp", "th", F.round("intercept", 6).alias("intercept"), F.round("sigma2", 6).alias("sigma2"),
        F.round("deviance", 3).alias("deviance"), F.round("pct_unit", 6).alias("pct_unit"), F.round("icc_site", 6).alias("icc_site"))


@query("unit_effect_test", f"""
WITH {MODEL_SQL},
m AS (SELECT drug, provider, price, avg(price) OVER (PARTITION BY drug) AS whole, avg(price) OVER (PARTITION BY drug, provider) AS own FROM used)
SELECT drug AS fit, count(*) AS n, count(DISTINCT provider) AS n_units, count(DISTINCT provider) - 1 AS lrt_df,
       round(count(*) * ln(sum((price - whole) ** 2) / sum((price - own) ** 2)), 4) AS lrt_chisq,
       round(1 - sum((price - own) ** 2) / sum((price - whole) ** 2), 6) AS r2_marginal FROM m GROUP BY drug""")
def unit_effect_test(spark, sf):
    test = L.unit_fixed_test(L.sufficient_sums(_alone(spark, sf, True)))
    return spark.createDataFrame(test).select("fit", "n", "n_units", "lrt_df", F.round("lrt_chisq", 4).alias("lrt_chisq"),
                                              F.round("r2_marginal", 6).alias("r2_marginal"))


@query("logistic_trend_one_site", f"""
WITH RECURSIVE {ENCOUNTERS_SQL},
c AS (SELECT year - (SELECT min(year) FROM enc) AS x, count(*)::DOUBLE AS n, count(*) FILTER (WHERE drug = 'O')::DOUBLE AS y
      FROM enc GROUP BY year),
fit(step, b0, b1) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT step + 1, b0 + (wxx * g0 - wx * g1) / (w * wxx - wx * wx), b1 + (w * g1 - wx * g0) / (w * wxx - wx * wx)
  FROM (SELECT step, any_value(b0) AS b0, any_value(b1) AS b1, sum(n * mu * (1 - mu)) AS w, sum(n * mu * (1 - mu) * x) AS wx,
               sum(n * mu * (1 - mu) * x * x) AS wxx, sum(y - n * mu) AS g0, sum((y - n * mu) * x) AS g1
        FROM (SELECT step, b0, b1, x, n, y, 1 / (1 + exp(-(b0 + b1 * x))) AS mu FROM fit, c WHERE step < 12) e GROUP BY step) s)
SELECT t.term, round(CASE t.term WHEN 'year_c' THEN b1 ELSE b0 END, 4) AS estimate
FROM fit, (VALUES ('(Intercept)'), ('year_c')) t(term) WHERE step = 12""")
def logistic_trend_one_site(spark, sf):
    enc = encounters(spark, sf)
    first = enc.agg(F.min("year")).scalar()
    rows = (enc.withColumn("year_c", (F.col("year") - first).cast("double")).withColumn("site", F.lit("all"))
            .withColumn("chosen", (F.col("drug") == "O").cast("int")))
    model = D.design(rows, "chosen", ["year_c"], {}, "site", "provider")
    fitted = G.fit_structures(D.Design(materialise(model.rows, "logit"), model.names), [("all", G.NONE)])
    return spark.createDataFrame(L.fixed_effects(fitted, model.names)).select("term", F.round("estimate", 4).alias("estimate"))


@query("bootstrap_sizes", f"""
WITH {MODEL_SQL}
SELECT drug AS fit, 40::BIGINT AS n_replicates, count(*) AS least_rows, count(*) AS most_rows, count(DISTINCT site) AS n_sites
FROM used GROUP BY drug""")
def bootstrap_sizes(spark, sf):
    """Rows drawn in each of 40 replicates: exactly as many as the model has."""
    model = _alone(spark, sf)
    model = D.Design(R.with_row_number(model.rows), model.names)
    folded, _ = R.replicate_sums(model, ["row_key"], 40, 20260319)
    each = folded.groupBy("fit", "replicate").agg(F.sum(F.col("n") * F.col("u")[0]).cast("long").alias("rows"))
    sites = folded.groupBy("fit").agg(F.countDistinct("site").alias("n_sites"))
    return (each.groupBy("fit").agg(F.count(F.lit(1)).alias("n_replicates"), F.min("rows").alias("least_rows"),
                                    F.max("rows").alias("most_rows")).join(sites, "fit"))


@query("imputation_facts", """
WITH e AS (SELECT CASE WHEN event_id % 7 <> 0 THEN value END AS value,
                  CASE WHEN event_id % 11 <> 0 THEN value + user_id % 5 END AS score FROM events)
SELECT 'value' AS variable, count(*) AS n, count(*) - count(value) AS n_filled, 0::BIGINT AS n_changed, 0::BIGINT AS n_not_observed FROM e
UNION ALL SELECT 'score', count(*), count(*) - count(score), 0, 0 FROM e""")
def imputation_facts(spark, sf):
    """Observed values stay, and every filled value is an observed one."""
    ev = events(spark, sf).select(
        "event_id", "event_type", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 11 != 0, F.col("value") + F.col("user_id") % 5).alias("score"), F.hour("ts").cast("double").alias("hour"))
    done, _ = I.impute_pmm(ev, "event_id", ["value", "score"], ["hour"], {
        "event_type": ["click", "error", "purchase", "signup", "view"]}, iterations=2)
    parts = []
    for name in ("value", "score"):
        known = ev.where(F.col(name).isNotNull()).select(F.col(name).alias("was")).distinct()
        both = done.select("event_id", F.col(name).alias("now")).join(ev.select("event_id", F.col(name).alias("before")), "event_id")
        strange = both.where("before IS NULL").join(known, F.col("now") == F.col("was"), "left_anti").agg(F.count(F.lit(1))).scalar()
        parts.append(both.agg(
            F.lit(name).alias("variable"), F.count("now").alias("n"), F.count_if(F.col("before").isNull()).alias("n_filled"),
            F.count_if(F.col("before") != F.col("now")).alias("n_changed")).withColumn("n_not_observed", strange))
    return parts[0].unionByName(parts[1])
