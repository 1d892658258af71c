"""Search for variance ratios of many models at once.

Every round sends the points of all models through one Spark evaluation and receives one
number per point, so the driver only ever holds (models x points) numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np

Point = tuple[float, float]          # (unit, site) variance or variance ratio
Evaluate = Callable[[Mapping[str, list[Point]]], Mapping[str, list[float]]]

FIRST_STEP, LAST_STEP = 0.6, 0.02      # log-distance of stencil points
TOLERANCE = 1e-5                       # expected further fall of the deviance
FAR, NEAR = 1e12, 1e-12                # a search that gets here has no inner minimum
ROUNDS = 60


@dataclass(frozen=True)
class Found:
    """Best point of a model; ``converged`` if the quadratic there is at its minimum."""

    point: Point
    converged: bool
    gradient: float


def stencil(centre: Point, step: float) -> list[Point]:
    """Three points per positive axis at log-distance ``step``, in row-major order."""
    axes = [(v,) if v == 0 else tuple(v * np.exp(step * k) for k in (-1, 0, 1)) for v in centre]
    return list(product(*axes))


def _newton(centre: Point, step: float, points: list[Point], values: list[float]
            ) -> tuple[Point, float, float, float]:
    """(next point, its log-distance, expected fall, gradient) from a stencil.

    Where the quadratic has no minimum the next point is the lowest of the stencil and the
    expected fall is infinite.
    """
    active = [i for i in (0, 1) if centre[i] > 0]
    if not active:
        return centre, 0.0, 0.0, 0.0
    cells = np.array(values).reshape([3] * len(active))
    mid = (1,) * len(active)
    gradient, hessian = np.zeros(len(active)), np.zeros((len(active), len(active)))
    for i in range(len(active)):
        up, down = list(mid), list(mid)
        up[i], down[i] = 2, 0
        gradient[i] = (cells[tuple(up)] - cells[tuple(down)]) / (2 * step)
        hessian[i, i] = (cells[tuple(up)] - 2 * cells[mid] + cells[tuple(down)]) / step**2
    if len(active) == 2:
        hessian[0, 1] = hessian[1, 0] = (
            cells[2, 2] - cells[2, 0] - cells[0, 2] + cells[0, 0]) / (4 * step**2)
    slope = float(np.abs(gradient).max())
    if not np.all(np.linalg.eigvalsh(hessian) > 1e-9):
        best = points[int(np.argmin(values))]
        return best, step if best != centre else step / 2, np.inf, slope
    move = -np.linalg.solve(hessian, gradient)
    fall = float(-gradient @ move / 2)
    move = np.clip(move, -1.5, 1.5)
    out = list(centre)
    for i, axis in enumerate(active):
        out[axis] = centre[axis] * float(np.exp(move[i]))
    return (out[0], out[1]), float(np.abs(move).max()), fall, slope


def _beyond(best: Point, tried: Mapping[Point, float]) -> list[Point]:
    """Points past the edge of what was tried, where the best point lies on it."""
    more = []
    for axis in (0, 1):
        v = best[axis]
        along = [p[axis] for p in tried if p[axis] > 0]
        if v > 0 and v == max(along) and v < FAR:
            more.append(tuple(v * 10**0.5 if i == axis else best[i] for i in (0, 1)))
        if v > 0 and v == min(along) and v > NEAR:
            more.append(tuple(v / 10 if i == axis else best[i] for i in (0, 1)))
    return more


def minimise(models: Mapping[str, tuple[Sequence[float], Sequence[float]]],
             evaluate: Evaluate, last_step: float = LAST_STEP,
             rounds: int = ROUNDS) -> dict[str, Found]:
    """Best (unit, site) point per model.

    ``models`` holds the coarse grids of the two variances; ``(0.0,)`` keeps one at zero. A grid is
    extended while the best point lies on its edge; then Newton steps on shrinking stencils
    go on until the expected further fall is under ``TOLERANCE`` on a stencil of at most twice
    ``last_step``.
    """
    seen: dict[str, dict[Point, float]] = {m: {} for m in models}

    def run(points: dict[str, list[Point]]) -> Mapping[str, list[float]]:
        values = evaluate(points)
        for model, found in values.items():
            seen[model].update(zip(points[model], found))
        return values

    run({m: list(product(unit, site)) for m, (unit, site) in models.items()})
    best = lambda m: min(seen[m], key=seen[m].get)
    while more := {m: at for m in models if (at := [
            p for p in _beyond(best(m), seen[m]) if p not in seen[m]])}:
        run(more)
    centre = {m: best(m) for m in models}
    step = dict.fromkeys(models, FIRST_STEP)
    state: dict[str, tuple[bool, float]] = {}
    for _ in range(rounds):
        points = {m: stencil(centre[m], step[m]) for m in models if not state.get(m, (False,))[0]}
        if not points:
            break
        values = run(points)
        for m in points:
            to, distance, fall, slope = _newton(centre[m], step[m], points[m], values[m])
            state[m] = (fall < TOLERANCE and step[m] <= 2 * last_step, slope)
            if state[m][0]:
                centre[m] = to
                continue
            lowest = best(m)
            if seen[m][lowest] < seen[m][centre[m]] - 1 and not np.isfinite(fall):
                to = lowest
            centre[m] = to
            step[m] = min(max(distance / 2 if np.isfinite(fall) else distance, last_step), FIRST_STEP)
    run({m: list(dict.fromkeys([c, (0.0, c[1]), (c[0], 0.0)])) for m, c in centre.items()})
    out = {}
    for m in models:
        lowest = best(m)
        inner = state[m][0] or not any(lowest)
        ends = all(NEAR < v < FAR for v in lowest if v > 0)
        # a variance at zero is the edge of its range: the search along the others decides
        out[m] = Found(lowest, bool(ends and (inner or lowest != centre[m] and 0.0 in lowest)), state[m][1])
    return out
