"""Linear mixed models with nested random intercepts from distributed sufficient statistics.

Rows are reduced once to sums per unit (provider within site) and to one cross-product per
model. A likelihood value at a pair of variance ratios is then one aggregation over the unit
sums; all models and all points of a round share that aggregation.

For a unit with n rows, sums s of x and r of y, and ratios tp (unit) and th (site) to the
residual variance: k = 1/(1+n tp), w = tp k; per site a = sum n k, t = sum s k, u = sum r k,
v = th/(1+th a). Then A = X'X - sum w s s' - sum v t t' and likewise for X'y and y'y.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialise
from .design import Design
from .variance_search import Point, minimise, stencil

GRID = (0.0, 1e-4, 1e-3, 1e-2, 10**-1.5, 0.1, 10**-0.5, 1.0, 10**0.5, 10.0, 100.0)
NESTED, SITE, UNIT = "nested", "site", "unit"
MODEL_TYPES = {NESTED: "3-level (row/unit/site)", SITE: "2-level (row/site)",
               UNIT: "1-site (row/unit)"}


@dataclass(frozen=True)
class Sums:
    """Sufficient statistics: per unit and per model, with ``p`` terms."""

    units: DataFrame
    totals: DataFrame
    names: tuple[str, ...]

    @property
    def p(self) -> int:
        return len(self.names)


def triangle(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def sufficient_sums(model: Design, weight: str | None = None) -> Sums:
    """Sums per (fit, site, unit) and cross-products per fit, optionally weighted."""
    w = f"cast({weight} AS double)" if weight else "1D"
    p = len(model.names)
    units = materialise(model.rows.groupBy("fit", "site", "unit").agg(*_sums({
        "n": w, "r": f"{w} * y", "yy": f"{w} * y * y",
        **{f"s{i}": f"{w} * x{i}" for i in range(p)},
        **{f"xy{i}": f"{w} * x{i} * y" for i in range(p)},
        **{f"g{i}_{j}": f"{w} * x{i} * x{j}" for i, j in triangle(p)}})), "units")
    return _with_totals(units, model.names)


def _with_totals(units: DataFrame, names: Sequence[str]) -> Sums:
    p = len(names)
    totals = units.groupBy("fit").agg(
        F.sum("n").alias("n_obs"), F.count(F.lit(1)).alias("n_units"),
        F.countDistinct("site").alias("n_sites"), F.sum("yy").alias("yy"),
        F.sum("r").alias("sum_y"), _array_sum([f"xy{i}" for i in range(p)], "xy"),
        _array_sum([f"g{i}_{j}" for i, j in triangle(p)], "xx"))
    return Sums(units, materialise(totals, "totals"), tuple(names))


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Driver rows as a table, by way of Arrow."""
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame(pd.DataFrame(rows, columns=names), schema)


def _sums(parts: Mapping[str, str]) -> list[Column]:
    return [F.expr(f"sum({expression}) AS {name}") for name, expression in parts.items()]


def _array_sum(parts: Sequence[str], name: str) -> Column:
    return F.expr(f"array({', '.join(f'sum({x})' for x in parts)}) AS {name}")


def reduced_systems(units: DataFrame, totals: DataFrame, points: DataFrame,
                    p: int) -> DataFrame:
    """Per point: the reduced normal equations and the log determinant."""
    each = (units.select("fit", "site", "n", "r", *[f"s{i}" for i in range(p)])
            .join(points, "fit").withColumn("k", F.expr("1 / (1 + n * tp)")))
    w = "(tp * k)"
    sites = each.groupBy("fit", "point", "site").agg(
        F.first("tp").alias("tp"), F.first("th").alias("th"),
        *_sums({"a": "n * k", "u": "r * k", "ld": "log1p(n * tp)", "c": f"{w} * r * r",
                **{f"t{i}": f"s{i} * k" for i in range(p)},
                **{f"b{i}": f"{w} * s{i} * r" for i in range(p)},
                **{f"m{i}_{j}": f"{w} * s{i} * s{j}" for i, j in triangle(p)}}))
    sites = sites.withColumn("v", F.expr("th / (1 + th * a)"))
    whole = sites.groupBy("fit", "point").agg(
        F.first("tp").alias("tp"), F.first("th").alias("th"),
        *_sums({"logdet": "ld + log1p(th * a)", "cut_c": "c + v * u * u"}),
        _array_sum([f"b{i} + v * t{i} * u" for i in range(p)], "cut_b"),
        _array_sum([f"m{i}_{j} + v * t{i} * t{j}" for i, j in triangle(p)], "cut_a"))
    return whole.join(totals, "fit").selectExpr(
        "fit", "point", "tp", "th", "logdet", "n_obs",
        "zip_with(xx, cut_a, (x, y) -> x - y) AS a", "zip_with(xy, cut_b, (x, y) -> x - y) AS b",
        "yy - cut_c AS c")


_SOLVED = ("fit string, point int, tp double, th double, deviance double, sigma2 double, "
           "n_obs double, resid_df double, beta array<double>, se array<double>")


def symmetric(flat: np.ndarray, p: int) -> np.ndarray:
    """Full matrices from rows of upper triangles."""
    out = np.zeros((len(flat), p, p))
    for at, (i, j) in enumerate(triangle(p)):
        out[:, i, j] = out[:, j, i] = flat[:, at]
    return out


def independent(a: np.ndarray, tolerance: float = 1e-10) -> np.ndarray:
    """Which columns of a cross-product are no combination of earlier ones."""
    left, keep = a.copy(), np.zeros(len(a), bool)
    for j in range(len(a)):
        if left[j, j] > tolerance * a[j, j]:
            keep[j] = True
            left = left - np.outer(left[:, j], left[j]) / left[j, j]
    return keep


def solve_system(a: np.ndarray, b: np.ndarray, c: float, logdet: float, n: float,
                 reml: bool) -> tuple[float, float, int, np.ndarray, np.ndarray]:
    """(deviance, residual variance, rank, coefficients, standard errors) of one point.

    Terms that are combinations of earlier terms in this model's rows get no coefficient (NaN).
    """
    keep = independent(a)
    inverse = np.linalg.inv(a[np.ix_(keep, keep)])
    beta, se = np.full((2, len(b)), np.nan)
    beta[keep] = inverse @ b[keep]
    rank = int(keep.sum())
    df = n - rank if reml else n
    sigma2 = max(c - b[keep] @ beta[keep], 1e-300) / df
    deviance = df * (math.log(2 * math.pi * sigma2) + 1) + logdet
    if reml:
        deviance -= np.linalg.slogdet(inverse)[1]
    se[keep] = np.sqrt(np.diag(inverse) * sigma2)
    return deviance, sigma2, rank, beta, se


def _solver(p: int, reml: bool):
    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            a = symmetric(np.stack(pdf["a"].to_numpy()), p)
            solved = [solve_system(x, np.asarray(b), c, logdet, n, reml) for x, b, c, logdet, n in zip(
                a, pdf["b"], pdf["c"], pdf["logdet"], pdf["n_obs"])]
            deviance, sigma2, rank, beta, se = zip(*solved)
            yield pd.DataFrame({
                "fit": pdf["fit"], "point": pdf["point"], "tp": pdf["tp"], "th": pdf["th"],
                "deviance": deviance, "sigma2": sigma2, "n_obs": pdf["n_obs"],
                "resid_df": pdf["n_obs"] - np.array(rank), "beta": list(beta), "se": list(se)})
    return solve


def evaluate_points(sums: Sums, points: Sequence[tuple[str, Point]], reml: bool) -> pd.DataFrame:
    """Deviance, residual variance and coefficients at each (model rows, point)."""
    listed = small_table(
        sums.units.sparkSession,
        [(fit, i, float(tp), float(th)) for i, (fit, (tp, th)) in enumerate(points)],
        "fit string, point int, tp double, th double")
    systems = reduced_systems(sums.units, sums.totals, listed, sums.p)
    return systems.mapInPandas(_solver(sums.p, reml), _SOLVED).toPandas().set_index("point")


Grids = tuple[Sequence[float], Sequence[float]]
COARSE: dict[str, Grids] = {NESTED: (GRID, GRID), SITE: ((0.0,), GRID), UNIT: (GRID, (0.0,))}


def fit_structures(sums: Sums, wanted: Sequence[tuple[str, str]], reml: bool = True,
                   grids: Mapping[tuple[str, str], Grids] | None = None) -> pd.DataFrame:
    """One row per wanted (fit, structure): ``fit, structure, tp, th, deviance, sigma2, beta,
    se, n_obs, singular``. Intercepts of sites alone are the nested model without unit
    variance, so all structures share the unit sums and every evaluation."""
    keep: dict[tuple[str, Point], pd.Series] = {}
    names = {f"{fit}#{structure}": (fit, structure) for fit, structure in wanted}

    def evaluate(points):
        flat = [(names[m][0], p) for m, at in points.items() for p in at]
        flat = list(dict.fromkeys(flat))
        got = evaluate_points(sums, flat, reml)
        for i, key in enumerate(flat):
            keep[key] = got.loc[i]
        return {m: [keep[names[m][0], p]["deviance"] for p in at] for m, at in points.items()}

    coarse = {m: (grids or {}).get(names[m], COARSE[names[m][1]]) for m in names}
    best = minimise(coarse, evaluate)
    out = pd.DataFrame([keep[names[m][0], f.point] for m, f in best.items()]).reset_index(drop=True)
    out["structure"] = [names[m][1] for m in best]
    out["converged"] = [f.converged for f in best.values()]
    least = np.where(out["structure"] == NESTED, out[["tp", "th"]].min(axis=1),
                     out[["tp", "th"]].max(axis=1))
    return out.assign(singular=least < 1e-8)


def choose_structures(sizes: pd.DataFrame, min_units: int,
                      prefer_nested: bool) -> list[tuple[str, str]]:
    """Candidate structures: units for one site, else units within sites and sites alone.

    ``sizes`` has ``fit, n_sites, n_units``; nesting needs ``min_units`` units.
    """
    wanted = []
    for m in sizes.itertuples():
        if m.n_sites == 1:
            wanted.append((m.fit, UNIT))
            continue
        if prefer_nested and m.n_units >= min_units:
            wanted.append((m.fit, NESTED))
        wanted.append((m.fit, SITE))
    return wanted


def first_admissible(fitted: pd.DataFrame) -> pd.DataFrame:
    """Per model the nested fit unless it is singular, else the one with a single level."""
    usable = fitted[~(fitted["singular"] & (fitted["structure"] == NESTED))]
    order = usable["structure"].map({NESTED: 0, UNIT: 1, SITE: 2})
    return (usable.assign(_order=order).sort_values(["fit", "_order"])
            .drop_duplicates("fit").drop(columns="_order").reset_index(drop=True))


def fit_lmm(sums: Sums, min_units: int = 5, prefer_nested: bool = True,
            reml: bool = True) -> pd.DataFrame:
    """Best admissible structure per model, with ``n_units`` and ``n_sites``."""
    sizes = sums.totals.select("fit", "n_units", "n_sites").toPandas()
    fitted = fit_structures(sums, choose_structures(sizes, min_units, prefer_nested), reml)
    return first_admissible(fitted).merge(sizes, on="fit")


def variance_components(fitted: pd.DataFrame) -> pd.DataFrame:
    """Long table: ``fit, component, variance, pct_variance, sd_component, model_type``."""
    rows = []
    for r in fitted.itertuples():
        parts = {"site": r.th * r.sigma2, "unit": r.tp * r.sigma2, "residual": r.sigma2}
        if r.structure == SITE:
            parts.pop("unit")
        if r.structure == UNIT:
            parts.pop("site")
        total = sum(parts.values())
        rows += [(r.fit, c, v, v / total * 100, math.sqrt(v), total,
                  MODEL_TYPES[r.structure], bool(r.singular), bool(r.converged))
                 for c, v in parts.items()]
    return pd.DataFrame(rows, columns=["fit", "component", "variance", "pct_variance",
                                       "sd_component", "total_variance", "model_type",
                                       "singular", "converged"])


def icc_table(fitted: pd.DataFrame) -> pd.DataFrame:
    """Intraclass correlations: site, and unit cumulated with site."""
    site, unit = fitted["th"] * fitted["sigma2"], fitted["tp"] * fitted["sigma2"]
    total = site + unit + fitted["sigma2"]
    return pd.DataFrame({
        "fit": fitted["fit"], "var_site": site, "var_unit": unit, "icc_site": site / total,
        "icc_unit": (site + unit) / total, "single_site": fitted["n_sites"] == 1,
        "model_type": fitted["structure"].map(MODEL_TYPES)})


def _curvature(cells: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian at the middle of a stencil with three points per axis."""
    d = cells.ndim
    mid = (1,) * d
    grad, hess = np.zeros(d), np.zeros((d, d))
    move = lambda **at: tuple(at.get(f"a{i}", 1) for i in range(d))
    for i in range(d):
        up, down = cells[move(**{f"a{i}": 2})], cells[move(**{f"a{i}": 0})]
        grad[i] = (up - down) / (2 * step)
        hess[i, i] = (up - 2 * cells[mid] + down) / step**2
    if d == 2:
        hess[0, 1] = hess[1, 0] = (cells[2, 2] - cells[2, 0] - cells[0, 2]
                                   + cells[0, 0]) / (4 * step**2)
    return grad, hess


def degrees_of_freedom(sums: Sums, fitted: pd.DataFrame, step: float = 0.05) -> pd.Series:
    """Satterthwaite degrees of freedom per model and coefficient.

    The variance of a coefficient is a function of the variance parameters; its own sampling
    variance follows from its slope and the curvature of the REML deviance. Both come from
    one more evaluation on a small stencil around the estimate.
    """
    points, spans = [], {}
    for m in fitted.itertuples():
        at = stencil((m.tp, m.th), step)
        spans[m.fit] = range(len(points), len(points) + len(at))
        points += [(m.fit, p) for p in at]
    got = evaluate_points(sums, points, True)
    out = {}
    for m in fitted.itertuples():
        part = got.loc[list(spans[m.fit])]
        shape = [3 for v in (m.tp, m.th) if v > 0]
        d, df, s2 = len(shape), m.resid_df, m.sigma2
        cells = lambda v: np.asarray(v, float).reshape(shape)  # noqa: E731,B023
        resid = df * part["sigma2"].to_numpy()
        rest = part["deviance"].to_numpy() - df * (np.log(2 * np.pi * part["sigma2"]) + 1)
        hess = np.zeros((d + 1, d + 1))
        hess[d, d] = df
        if d:
            slope, bend = _curvature(cells(resid), step)
            hess[:d, :d] = bend / s2 + _curvature(cells(rest), step)[1]
            hess[:d, d] = hess[d, :d] = -slope / s2
        cov = 2 * np.linalg.pinv(hess, hermitian=True)
        unit = np.stack(part["se"].to_numpy()) ** 2 / part["sigma2"].to_numpy()[:, None]
        values = []
        for j in range(unit.shape[1]):
            v = m.se[j] ** 2
            g = np.append(s2 * _curvature(cells(unit[:, j]), step)[0] if d else [], v)
            values.append(2 * v * v / (g @ cov @ g))
        out[m.fit] = values
    return pd.Series(out)


def fixed_effects(fitted: pd.DataFrame, names: Sequence[str], exponentiate: bool = False,
                  dof: pd.Series | None = None, z: float = 1.959963984540054) -> pd.DataFrame:
    """Estimates with 95 % Wald intervals; t tests with ``dof``, else normal ones."""
    rows = []
    for r in fitted.itertuples():
        for j, (term, b, se) in enumerate(zip(names, r.beta, r.se)):
            if math.isnan(b):                    # no term of this model's rows
                continue
            stat = b / se if se > 0 else float("nan")
            df = dof[r.fit][j] if dof is not None else float("inf")
            p = math.erfc(abs(stat) / math.sqrt(2)) if math.isinf(df) else student_tails(stat, df)
            lo, hi = b - z * se, b + z * se
            if exponentiate:
                with np.errstate(over="ignore"):  # a term that separates the outcome has no upper limit
                    b, se, lo, hi = (float(x) for x in (np.exp(b), se * np.exp(b), np.exp(lo), np.exp(hi)))
            rows.append((r.fit, term, b, se, stat, df, p, lo, hi))
    out = pd.DataFrame(rows, columns=["fit", "term", "estimate", "std_error", "statistic", "df",
                                      "p_value", "conf_low", "conf_high"])
    return out if dof is not None else out.drop(columns="df")


def student_tails(t: float, df: float) -> float:
    """Two-sided tail of Student's t (incomplete beta by continued fraction)."""
    x = df / (df + t * t)
    a, b = df / 2, 0.5
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) if 0 < x < 1 else 0.0
    if x >= 1:
        return 1.0

    def fraction(a: float, b: float, x: float) -> float:
        c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
        h = d
        for m in range(1, 5000):
            for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                        -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1 / (1 + num * d)
                c = 1 + num / c
                h *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return h

    if x < (a + 1) / (a + b + 2):
        return front * fraction(a, b, x) / a
    return 1 - front * fraction(b, a, 1 - x) / b


def chi_square_tail(x: float, df: float) -> float:
    """Upper tail of the chi-square distribution (series or continued fraction)."""
    if x <= 0:
        return 1.0
    a, half = df / 2, x / 2
    scale = math.exp(-half + a * math.log(half) - math.lgamma(a))
    if half < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= half / n
            total += term
        return max(0.0, 1 - total * scale)
    b, c = half + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return scale * h


def unit_fixed_test(sums: Sums) -> pd.DataFrame:
    """Units as fixed effects against no unit effect: likelihood ratio and R squared.

    Fixed unit effects (units nested in sites) leave the within-unit sums, so the full model
    is X'X - sum s s'/n. With several sites the null model has site intercepts, by ML.
    """
    p = sums.p
    between = sums.units.groupBy("fit").agg(
        F.expr("sum(r * r / n) AS rr"), _array_sum([f"s{i} * r / n" for i in range(p)], "sr"),
        _array_sum([f"s{i} * s{j} / n" for i, j in triangle(p)], "ss"))
    got = sums.totals.join(between, "fit").toPandas()
    several = got.loc[got["n_sites"] > 1, "fit"].tolist()
    parts = []
    if several:
        parts.append(fit_structures(sums, [(m, SITE) for m in several], reml=False))
    single = got.loc[got["n_sites"] == 1, "fit"].tolist()
    if single:
        parts.append(evaluate_points(sums, [(m, (0.0, 0.0)) for m in single], False))
    null = pd.concat(parts).set_index("fit")["deviance"]
    rows = []
    for m in got.itertuples():
        within = symmetric(np.array([m.xx]) - np.array([m.ss]), p)[0]
        b = np.array(m.xy) - np.array(m.sr)
        beta = np.linalg.pinv(within, hermitian=True) @ b
        rss = m.yy - m.rr - b @ beta
        deviance = m.n_obs * (math.log(2 * math.pi * rss / m.n_obs) + 1)
        chi, df = null[m.fit] - deviance, m.n_units - 1
        var_fixed = (m.rr + beta @ within @ beta - m.sum_y**2 / m.n_obs) / (m.n_obs - 1)
        if m.n_sites > 1:
            r2 = var_fixed / (var_fixed + rss / m.n_obs)
        else:
            r2 = 1 - rss / (m.yy - m.sum_y**2 / m.n_obs)
        tail = chi_square_tail(chi, df)
        rows.append((m.fit, int(m.n_obs), int(m.n_units), int(m.n_sites), chi, int(df), tail,
                     "significant" if tail < 0.05 else "not significant", r2,
                     r2 if m.n_sites > 1 else float("nan"), m.n_units > m.n_obs / 10))
    return pd.DataFrame(rows, columns=[
        "fit", "n", "n_units", "n_sites", "lrt_chisq", "lrt_df", "lrt_p", "lrt_note",
        "r2_marginal", "r2_conditional", "rank_deficiency_warning"])
