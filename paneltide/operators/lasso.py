"""Lasso regressions from co-moments, by coordinate descent."""

from __future__ import annotations

import numpy as np

from paneltide.operators.comoments import State, merged

TOLERANCE = 1e-13


def pooled(states: list[State], dims: int) -> State:
    out: State = (0, np.zeros(dims), np.zeros((dims, dims)))
    for s in states:
        out = merged(out, s)
    return out


def _descend(gram: np.ndarray, cross: np.ndarray, penalty: float, used: np.ndarray) -> np.ndarray:
    """Sweeps over the coordinates. Between them, columns that are alike make
    for slow steps: so now and then the columns in use are solved for directly,
    and that ends it if no sign changes and no other column is worth its
    penalty, which is when it is the minimum."""
    b = np.zeros(len(cross))
    limit, sweeps = TOLERANCE * max(np.abs(cross).max(initial=0.0), 1e-300), 0
    while True:
        moved, sweeps = 0.0, sweeps + 1
        for j in used:
            rest = cross[j] - gram[j] @ b + gram[j, j] * b[j]
            new = np.sign(rest) * max(abs(rest) - penalty, 0.0) / gram[j, j]
            moved, b[j] = max(moved, abs(new - b[j])), new
        if moved <= limit:
            return b
        if sweeps % 20 == 0:
            on = np.flatnonzero(b)
            direct = np.zeros(len(b))
            try:
                direct[on] = np.linalg.solve(gram[np.ix_(on, on)], cross[on] - penalty * np.sign(b[on]))
            except np.linalg.LinAlgError:
                continue  # equal columns: the sweeps go on
            off = np.setdiff1d(used, on)
            if (np.sign(direct[on]) == np.sign(b[on])).all() and (np.abs(cross - gram @ direct)[off] <= penalty).all():
                return direct


def fit(state: State, x: list[int], target: int, penalty: float) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) that minimise, over the rows behind ``state``,
        mean squared error / 2 + penalty * sum |coefficient * spread of its column|
    i.e. the lasso on standardised columns with a free intercept. A column
    without spread gets 0."""
    n, mean, c = state
    if n == 0:
        return np.zeros(len(x)), 0.0
    spread = np.sqrt(np.maximum(np.diag(c)[x] / n, 0.0))
    used = spread > 0
    scale = np.where(used, spread, 1.0)
    gram = c[np.ix_(x, x)] / n / np.outer(scale, scale)
    cross = c[x, target] / n / scale
    b = _descend(gram, cross, penalty, np.flatnonzero(used))
    coefficients = np.where(used, b / scale, 0.0)
    return coefficients, float(mean[target] - coefficients @ mean[x])


def error(state: State, x: list[int], target: int, coefficients: np.ndarray, intercept: float) -> float | None:
    """Mean squared error on the rows behind ``state``."""
    n, mean, c = state
    if n == 0:
        return None
    spread = c[target, target] - 2 * coefficients @ c[x, target] + coefficients @ c[np.ix_(x, x)] @ coefficients
    return float(spread / n + (mean[target] - intercept - coefficients @ mean[x]) ** 2)
