"""Logistic models with nested random intercepts at the joint optimum of the Laplace deviance.

With rows i of unit u in site s and eta = x beta + b_s + b_u, half the deviance is

    F = - log likelihood + sum b_u^2 / 2 tp + sum b_s^2 / 2 th
        + (sum log(1 + tp W_u) + sum log(1 + th A_s)) / 2

at the modes of b, where w = mu(1 - mu), W_u = sum of w, k = 1 / (1 + tp W), A_s = sum W k. The gradient in beta and both
variances goes through the modes: with w' = w(1 - 2 mu), T = sum w' and the leverage
h_u = tp k + v k^2 (v = th / (1 + th A)), a change of eta moves the log determinant by h w', and a change of beta moves
the modes by the solution of a system that has an arrow for each site. All of that is sums over units and then over
sites, so one pass over the rows gives value, gradient and information of every model.

* Equal rows of a unit are one row with a number of times. Rows of a unit are packed once as matrices of at most ``BLOCK``
  rows and stay where they are, keyed and sorted by unit and block; a unit with more rows lies in several tasks. A pass sends
  one row of effects per unit and block to them, and they give back sums per unit by matrix products, for all models of the
  same rows.
* Modes are not iterated by themselves: each pass moves them by the Newton step for the new coefficients and variances, and
  the value and gradient are corrected for what is left of that step.
* The driver holds some p x p numbers per model and takes quasi-Newton steps in the coefficients and the two standard
  deviations (so a variance of zero is an ordinary stationary point); all models step side by side.

Standard errors come from the information of the coefficients at the modes, variances held.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialise
from .lmm import independent

BLOCK = 4096
PASSES = 80
FAR = 50.0  # a standard deviation that gets here has no inner optimum
TOLERANCE = 1e-6  # fall of half the deviance that is still expected
CHUNK = 1 << 16  # rows worked on at once
KEYS = ["fit", "site", "unit", "block"]
SCALARS = 18  # of the sums of a site, before the vectors
VECTORS = 7


def equal_rows(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row for all that agree in ``by``, with their number as ``times``; written."""
    times = F.sum("times") if "times" in rows.columns else F.count(F.lit(1))
    return materialise(rows.groupBy(*by).agg(times.cast("double").alias("times")), "equal-rows")


def packed_rows(rows: DataFrame, xs: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(blocks with the rows of a unit as matrices, units with their number of blocks).

    ``rows`` must give the same rows in the same order whenever they are read (a written table).
    """
    units = materialise(rows.groupBy("fit", "site", "unit").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "units")
    large = units.where("blocks > 1")
    salted = (rows.join(large, ["fit", "site", "unit"], "left")
              .withColumn("block", F.pmod(F.monotonically_increasing_id(), F.coalesce("blocks", F.lit(1))).cast("int"))
              .select(*KEYS, "y", *xs, "times" if "times" in rows.columns else F.lit(1.0).alias("times")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of the last block, which may go on in the next batch
        for batch in then_none(batches):
            if batch is not None and not batch.num_rows:
                continue
            parts = [t for t in (rest, batch and pa.Table.from_batches([batch])) if t is not None]
            if not parts:
                continue
            held = pa.concat_tables(parts).combine_chunks()
            names = pd.MultiIndex.from_arrays([held.column(c).to_pandas() for c in KEYS]).factorize()[0]
            begin = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            end = np.append(begin[1:], len(names))
            if batch is not None:
                rest = held.slice(begin[-1])
                begin, end = begin[:-1], end[:-1]
            x = np.column_stack([held.column(c).to_numpy() for c in xs])
            y, times = held.column("y").to_numpy(), held.column("times").to_numpy()
            cut = lambda v: pa.array([v[a:b].tobytes() for a, b in zip(begin, end, strict=True)], pa.binary())  # noqa: E731,B023
            yield pa.RecordBatch.from_arrays(
                [*(held.column(c).combine_chunks().take(pa.array(begin)) for c in KEYS), cut(x), cut(y), cut(times)],
                [*KEYS, "x", "y", "times"])

    near = salted.repartition(*KEYS).sortWithinPartitions(*KEYS)
    packed = near.mapInArrow(pack, "fit string, site string, unit string, block int, x binary, y binary, times binary")
    return packed.repartition(*KEYS).sortWithinPartitions(*KEYS).persist(StorageLevel.MEMORY_AND_DISK), units


def then_none(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def grouped(batch: pa.RecordBatch, *keys: str) -> tuple[pd.DataFrame, np.ndarray]:
    """(different keys of a batch, number of the key of each row); a missing value is a value."""
    frame = pd.DataFrame({k: batch.column(k).to_pandas() for k in keys})
    number = frame.groupby(list(keys), sort=False, dropna=False).ngroup().to_numpy()
    return frame.iloc[np.unique(number, return_index=True)[1]], number


def summed_by(number: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Rows of ``values`` summed by group number."""
    order = np.argsort(number, kind="stable")
    begin = np.flatnonzero(np.append(True, np.diff(number[order]) != 0))
    return np.add.reduceat(values[order], begin, axis=0)


def vectors(column: pa.Array) -> np.ndarray:
    return np.vstack(column.to_numpy(zero_copy_only=False))


def array_sum(name: str) -> Column:
    """Sum of arrays place by place (one array a task reaches it)."""
    held = F.collect_list(name)
    return F.aggregate(F.slice(held, 2, F.size(held)), held[0],
                       lambda a, b: F.zip_with(a, b, lambda x, y: x + y)).alias(name)


@dataclass
class Fit:
    """A model: its rows, which standard deviations are free, and where its search is."""

    fit: str
    free: tuple[bool, bool]
    beta: np.ndarray
    sd: np.ndarray
    keep: np.ndarray | None = None
    value: float = math.inf
    gradient: np.ndarray | None = None
    curvature: np.ndarray | None = None
    information: np.ndarray | None = None
    rise: np.ndarray = field(default_factory=lambda: np.zeros(2))  # dF / d(tp, th)
    step: np.ndarray | None = None
    scale: float = 1.0
    converged: bool = False
    done: bool = False
    state: int = -1

    @property
    def active(self) -> np.ndarray:
        return np.append(self.keep, self.free)

    def moved(self) -> tuple[np.ndarray, np.ndarray]:
        """(beta, sd) at the trial step; a negative standard deviation is its mirror image."""
        if self.step is None:
            return self.beta, self.sd
        to = np.concatenate((self.beta, self.sd)) + self.scale * self.step
        return to[:-2], np.abs(to[-2:])

    def judge(self, value: float, gradient: np.ndarray, information: np.ndarray, spread: np.ndarray, rise: np.ndarray,
              left: float) -> bool:
        """Take in a pass at the trial step; whether it becomes the place to go on from."""
        p = len(self.beta)
        if left > 1e-2:  # the modes are not there yet: stay at the trial, and let them move
            return True
        if self.step is not None and not value <= self.value + 1e-4 * self.scale * (self.gradient @ self.step) + 1e-9 * abs(self.value):
            self.scale /= 2
            if self.scale < 1e-3:
                self.done = True
            return False
        beta, sd = self.moved()
        if self.keep is None:
            self.keep = independent(information)
        on = self.active
        first = np.zeros((p + 2, p + 2))
        first[:p, :p] = information
        first[[p, p + 1], [p, p + 1]] = np.maximum(4 * sd**2 * spread, 1e-3)
        if self.curvature is None or self.gradient is None:
            curvature = first
        else:
            d = np.concatenate((beta - self.beta, sd - self.sd))
            g = gradient - self.gradient
            b, bend = self.curvature, d @ g
            bd = b @ d
            if bend < 0.2 * (d @ bd):  # damped, so that it stays positive
                theta = 0.8 * (d @ bd) / (d @ bd - bend) if d @ bd > bend else 1.0
                g = theta * g + (1 - theta) * bd
                bend = d @ g
            curvature = b - np.outer(bd, bd) / (d @ bd) + np.outer(g, g) / bend if d @ bd > 0 and bend > 0 else b
        self.beta, self.sd, self.value, self.gradient, self.rise = beta, sd, value, gradient, rise
        self.done = bool((sd > FAR).any())
        self.curvature, self.information, self.scale = curvature, information, 1.0
        step = np.zeros(p + 2)
        step[on] = -np.linalg.solve(curvature[np.ix_(on, on)], gradient[on])
        if gradient @ step >= 0:
            self.curvature = first
            step[on] = -np.linalg.solve(first[np.ix_(on, on)], gradient[on])
        longest = np.abs(step[p:]) / np.maximum(0.5, sd)
        self.scale = 1 / max(1.0, 2 * longest.max(), np.abs(step[:p]).max() / 4)
        self.step = step
        if -(gradient @ step) < TOLERANCE and left < TOLERANCE:
            low = (sd < 0.05) & (rise < -0.5) & self.free
            if low.any():  # a standard deviation near zero has no slope, though its variance wants to grow
                self.step, self.scale = np.zeros(p + 2), 1.0
                self.step[p:][low] = 0.2
            else:  # the last step is taken without a pass: it moves the value by less than the tolerance
                self.beta, self.sd = self.moved()
                self.converged = self.done = True
        return True


class LaplaceSolver:
    """Passes over the packed rows for a set of models."""

    def __init__(self, rows: DataFrame, xs: Sequence[str]) -> None:
        self.spark: SparkSession = rows.sparkSession
        self.p = len(xs)
        self.blocks, self.units = packed_rows(rows, xs)
        self.split = not self.units.where("blocks > 1").isEmpty()  # else a block has all rows of its unit
        self.passes = 0

    def close(self) -> None:
        self.blocks.unpersist()

    def _start(self, models: Mapping[str, Fit]) -> DataFrame:
        listed = self.spark.createDataFrame([(m, f.fit) for m, f in models.items()], "model string, fit string")
        return self.units.join(listed, "fit").selectExpr("model", "fit", "site", "unit", "blocks", "0D AS b_site", "0D AS b_unit")

    def _moved_effects(self, sums: DataFrame, old: Mapping[str, tuple], new: Mapping[str, tuple]) -> DataFrame:
        """The modes of a quadratic around the last effects, for new coefficients and variances."""
        p = self.p
        parts = {m: (new[m][0] - old[m][0], new[m][1]) for m in new}

        def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                v = vectors(batch.column("v")) if batch.num_rows else np.zeros((0, 4 + 3 * p))
                models, number = grouped(batch, "model")
                shift = np.array([parts[m][0] for m in models["model"]]).reshape(-1, p)[number]
                tp, th = np.array([parts[m][1] ** 2 for m in models["model"]]).reshape(-1, 2)[number].T
                now = batch.column("b_site").to_numpy() + batch.column("b_unit").to_numpy()
                pull = v[:, 1] + v[:, 0] * now - (v[:, 4:4 + p] * shift).sum(axis=1)
                columns = {"w": v[:, 0], "pull": pull, "k": 1 / (1 + tp * v[:, 0]), "tp": tp, "th": th}
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("model", "fit", "site", "unit", "blocks")), *map(pa.array, columns.values())],
                    ["model", "fit", "site", "unit", "blocks", *columns])

        each = sums.where("unit IS NOT NULL").mapInArrow(
            moments, "model string, fit string, site string, unit string, blocks int, w double, pull double, k double, tp double, th double")
        sites = each.groupBy("model", "site").agg(F.expr("max(th) * sum(k * pull) / (1 + max(th) * sum(w * k)) AS b_site"))
        return each.join(sites, ["model", "site"]).selectExpr(
            "model", "fit", "site", "unit", "blocks", "b_site", "tp * k * (pull - w * b_site) AS b_unit")

    def _unit_sums(self, effects: DataFrame, betas: Mapping[str, np.ndarray]) -> DataFrame:
        """v = (W, R, T, loss, S, T_x, R_x) per unit, and X'WX per model in a row without unit; written."""
        p, betas = self.p, dict(betas)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole: dict[str, np.ndarray] = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                effect = batch.column("b_site").to_numpy() + batch.column("b_unit").to_numpy()
                xs, ys, ts = (batch.column(c) for c in ("x", "y", "times"))
                rows = np.array([len(y) // 8 for y in ys.to_pylist()])
                v = np.empty((len(rows), 4 + 3 * p))
                models, number = np.unique(batch.column("model").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
                for k, m in enumerate(models):
                    own = np.flatnonzero(number == k)
                    chunk = np.cumsum(rows[own]) // CHUNK
                    for at in np.split(own, np.flatnonzero(np.diff(chunk)) + 1):
                        taken = pa.array(at)
                        x = np.frombuffer(b"".join(xs.take(taken).to_pylist())).reshape(-1, p)
                        y, times = (np.frombuffer(b"".join(c.take(taken).to_pylist())) for c in (ys, ts))
                        eta = x @ betas[m] + np.repeat(effect[at], rows[at])
                        e = np.exp(-np.abs(eta))
                        one = 1 / (1 + e)
                        mu = np.where(eta >= 0, one, e * one)
                        w = times * e * one * one
                        rest, bend = times * (y - mu), w * (1 - 2 * mu)
                        loss = times * (np.log1p(e) + np.maximum(eta, 0) - y * eta)
                        begin = np.append(0, np.cumsum(rows[at])[:-1])
                        turned = np.ascontiguousarray(x.T)
                        wx = turned * w
                        v[at] = np.vstack([*(np.add.reduceat(c, begin)[None] for c in (w, rest, bend, loss)),
                                           *(np.add.reduceat(c, begin, axis=1) for c in (wx, turned * bend, turned * rest))]).T
                        whole[m] = whole.get(m, 0) + wx @ x
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("model", "fit", "site", "unit", "blocks", "b_site", "b_unit")),
                     pa.array(list(v), pa.list_(pa.float64()))],
                    ["model", "fit", "site", "unit", "blocks", "b_site", "b_unit", "v"])
            if whole:
                empty = [None] * len(whole)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(whole), pa.string()), *(pa.array(empty, t) for t in (
                        pa.string(), pa.string(), pa.string(), pa.int32(), pa.float64(), pa.float64())),
                     pa.array([m.ravel() for m in whole.values()], pa.list_(pa.float64()))],
                    ["model", "fit", "site", "unit", "blocks", "b_site", "b_unit", "v"])

        sent = effects.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        met = self.blocks.join(sent, KEYS).select("model", "fit", "site", "unit", "blocks", "b_site", "b_unit", "x", "y", "times")
        found = met.mapInArrow(sums, "model string, fit string, site string, unit string, blocks int, b_site double, b_unit double, "
                               "v array<double>")
        if self.split:
            found = found.groupBy("model", "fit", "site", "unit").agg(
                *(F.first(c).alias(c) for c in ("blocks", "b_site", "b_unit")), array_sum("v"))
        return materialise(found, "sums")

    def _values(self, sums: DataFrame, at: Mapping[str, tuple]) -> dict[str, np.ndarray]:
        """Per model: F, left, dF/d(tp, th), information of (tp, th), dF/dbeta, information of beta (p x p)."""
        p, variances = self.p, {m: sd**2 for m, (_, sd) in at.items()}

        def by_site(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys, number = grouped(batch, "model", "site", "b_site")
                v = vectors(batch.column("v"))
                tp = np.array([variances[m][0] for m in keys["model"]])[number]
                w, r, t, loss = v[:, :4].T
                s, tx, rx = v[:, 4:4 + p], v[:, 4 + p:4 + 2 * p], v[:, 4 + 2 * p:]
                b = batch.column("b_unit").to_numpy()
                k = 1 / (1 + tp * w)
                z, d = r + w * b, tp * r - b
                penalty, rest = (np.divide(x, tp, out=np.zeros_like(x), where=tp > 0) for x in (b * b / 2, k * d * d))
                scalars = np.column_stack((
                    w * k, k * z, (k * z) ** 2, k * k * z * w, (k * w) ** 2, t * k**2, t * k**3, t * k**3 * z, t * k**3 * w,
                    t * k**4 * z, t * k**4 * w, w * k * k * z, np.log1p(tp * w), loss, penalty, rest, w * k * d, r))
                c = lambda x: x[:, None]
                wide = np.column_stack((
                    scalars, c(k) * s, c(t * k**2) * s, c(t * k**3) * s, c(k) * tx, c(k * k) * tx, c(k * d) * s, rx,
                    ((c(tp * k) * s)[:, :, None] * s[:, None, :]).reshape(len(s), -1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys["model"], pa.string()), pa.array(keys["site"], pa.string()), pa.array(keys["b_site"], pa.float64()),
                     pa.array(list(summed_by(number, wide)), pa.list_(pa.float64()))], ["model", "site", "b_site", "u"])

        def by_model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys, number = grouped(batch, "model")
                u, b = vectors(batch.column("u")), batch.column("b_site").to_numpy()
                tp, th = np.array([variances[m] for m in keys["model"]])[number].T
                (a, kz, kz2, kzw, kw2, c2, c3, t3z, t3w, t4z, t4w, wkz, logdet, loss, penalty, rest, wkd, r) = u[:, :SCALARS].T
                ks, t2s, t3s, ktx, k2tx, kds, rx = (u[:, SCALARS + i * p:SCALARS + (i + 1) * p] for i in range(VECTORS))
                inner = u[:, SCALARS + VECTORS * p:]
                one = 1 / (1 + th * a)
                v = th * one
                move = (th * kz - b) * one  # of the site's effect to its mode
                q = tp * c2 / 2 + v * c3 / 2
                adjoint = v * q
                pull = (kz + a * b) * one
                with np.errstate(divide="ignore", invalid="ignore"):
                    own = np.where(th > 0, b * b / th, 0.0)
                    slope = np.where(th > 0, r - b / th, 0.0)
                value = loss + penalty + own / 2 + (logdet + np.log1p(th * a)) / 2
                left = rest - move * wkd + slope * move
                d_tp = (-(kz2 - 2 * move * kzw + move**2 * kw2) / 2 + a / 2 - v * kw2 / 2 + tp * (t3z - move * t3w) / 2
                        + v * (t4z - move * t4w) / 2 - adjoint * (wkz - move * kw2))
                d_th = -pull**2 / 2 + a * one / 2 + q * one * pull
                c = lambda x: x[:, None]
                d_beta = (-rx + c(tp / 2) * ktx + c(v / 2) * k2tx - c(adjoint) * ks - c(tp * tp / 2) * t2s - c(tp * v / 2) * t3s
                          + c(move) * ks + kds)
                information = -inner - c(v) * (ks[:, :, None] * ks[:, None, :]).reshape(len(ks), -1)
                wide = np.column_stack((value - left / 2, left, d_tp, d_th, kw2 / 2, (a * one) ** 2 / 2, d_beta, information))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys["model"], pa.string()), pa.array(list(summed_by(number, wide)), pa.list_(pa.float64()))], ["model", "t"])

        per_site = (sums.where("unit IS NOT NULL").select("model", "site", "b_site", "b_unit", "v")
                    .mapInArrow(by_site, "model string, site string, b_site double, u array<double>")
                    .groupBy("model", "site").agg(F.first("b_site").alias("b_site"), array_sum("u")))
        rows = (per_site.mapInArrow(by_model, "model string, t array<double>")
                .unionByName(sums.where("unit IS NULL").select("model", F.col("v").alias("t"))).collect())
        out = {m: np.zeros(6 + p + p * p) for m in at}
        for row in rows:
            t = np.array(row["t"])
            out[row["model"]][-len(t):] += t
        return out

    def run(self, models: Mapping[str, Fit]) -> None:
        """Search the optimum of every model; their fields hold the result."""
        p, states = self.p, {}
        at = {m: (f.beta, f.sd) for m, f in models.items()}
        effects = self._start(models)
        for step in range(PASSES):
            trial = {m: f.moved() for m, f in models.items() if not f.done}
            if not trial:
                break
            if step:
                parts = []
                for k in sorted({models[m].state for m in trial}):
                    own = [m for m in trial if models[m].state == k]
                    parts.append(self._moved_effects(states[k].where(F.col("model").isin(own)), {m: at[m] for m in own},
                                                     {m: trial[m] for m in own}))
                effects = parts[0]
                for more in parts[1:]:
                    effects = effects.unionByName(more)
            sums = self._unit_sums(effects, {m: beta for m, (beta, _) in trial.items()})
            self.passes += 1
            states[step] = sums
            for m, t in self._values(sums, trial).items():
                f, sd = models[m], trial[m][1]
                gradient = np.concatenate((t[6:6 + p], 2 * sd * t[2:4]))
                if f.judge(t[0], gradient, t[6 + p:].reshape(p, p), t[4:6], t[2:4], abs(t[1])):
                    f.state, at[m] = step, trial[m]


def fit_laplace(solver: LaplaceSolver, wanted: Mapping[str, tuple[str, tuple[bool, bool]]],
                near: Mapping[str, Fit] | None = None) -> dict[str, Fit]:
    """The optimum of each model (rows, which of unit and site vary), from the place of a simpler model in ``near``.

    A small variance is also tried at zero, and zero is taken where the deviance is no higher.
    """
    fits = {}
    for m, (fit, free) in wanted.items():
        start = (near or {}).get(m)
        fits[m] = Fit(fit, free, np.zeros(solver.p) if start is None else start.beta.copy(), np.where(free, 0.7, 0.0))
    solver.run(fits)
    pinned = {}
    for m, f in fits.items():
        small = (f.sd**2 < 1e-2) & f.free
        for zero in ([(True, False)] if small[0] else []) + ([(False, True)] if small[1] else []) + ([(True, True)] if small.all() else []):
            free = tuple(bool(on and not off) for on, off in zip(f.free, zero, strict=True))
            pinned[m, zero] = Fit(f.fit, free, f.beta.copy(), np.where(free, f.sd, 0.0))
    if pinned:
        solver.run({f"{m}#{zero}": f for (m, zero), f in pinned.items()})
    for (m, _), f in pinned.items():
        if f.value <= fits[m].value + 1e-6:
            fits[m] = f
    return fits
