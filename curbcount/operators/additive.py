"""Additive trend-and-season model of one series, fitted from weighted observations.

The model is the published one of Taylor and Letham, "Forecasting at Scale" (2018): a
piecewise-linear trend with sparse slope changes plus Fourier seasons, fitted to its most
probable parameters. Runs inside tasks on one short series at a time.
"""

from __future__ import annotations

import numpy as np

# Published defaults of the model.
CHANGE_POINTS = 25
CHANGE_POINT_SPAN = 0.8
CHANGE_SCALE = 0.05
TREND_SCALE = 5.0
SEASON_SCALE = 10.0
NOISE_SCALE = 0.5
# name, period in days, Fourier order, shortest span in days, longest allowed spacing in days
SEASONS = (
    ("yearly", 365.25, 10, 730.0, np.inf),
    ("weekly", 7.0, 3, 14.0, 7.0),
    ("daily", 1.0, 4, 2.0, 1.0),
)

#: Plain rounds before the noise variance is bracketed.
PLAIN_ROUNDS = 50
TOLERANCE = 1e-6
SLOPE_TOLERANCE = 1e-9
LEAST_VARIANCE = 1e-9
BLOCK_ROWS = 65_536


def knot_ranks(rows: int) -> np.ndarray:
    """Ranks among the rows at which the slope may change: evenly spaced over the first 80 %."""
    span = int(np.floor(rows * CHANGE_POINT_SPAN))
    count = min(CHANGE_POINTS, span - 1)
    if count < 1:
        return np.empty(0, np.int64)
    return np.round(np.linspace(0, span - 1, count + 1)).astype("int64")[1:]


def times_at(ranks: np.ndarray, t: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The times of the rows of these ranks, given times and their numbers of rows."""
    return t[np.searchsorted(np.cumsum(n), ranks, side="right")]


def seasons(span: float, spacing: float) -> list[tuple[float, int]]:
    """Period and order of the seasons that a history of this span and least spacing, in days, allows."""
    return [(p, k) for _, p, k, shortest, widest in SEASONS if span >= shortest and spacing < widest]


def _design(t: np.ndarray, days: np.ndarray, knots: np.ndarray, waves) -> np.ndarray:
    """Columns: slope, level, seasons, and last the slope changes."""
    columns = [t[:, None], np.ones((t.size, 1))]
    for period, order in waves:
        angle = 2.0 * np.pi * days[:, None] * np.arange(1, order + 1)[None, :] / period
        columns += [np.sin(angle), np.cos(angle)]
    columns.append(np.maximum(t[:, None] - knots[None, :], 0.0))
    return np.concatenate(columns, axis=1)


def _sparse_minimum(quad: np.ndarray, lin: np.ndarray, weight: float, x: np.ndarray) -> np.ndarray:
    """Least of ``x.quad.x / 2 - lin.x + weight * |x|``, starting from ``x``.

    Active-set search over the signs of the entries: solve for the entries in use, step back to
    the best sign change if one changes sign, and let in the entry with the steepest slope.
    """

    def cost(v):
        return v @ (quad @ v) / 2.0 - lin @ v + weight * np.abs(v).sum()

    signs = np.sign(x)
    while True:  # every step lowers the cost, so no set of signs comes twice
        slope = quad @ x - lin
        used = np.flatnonzero(signs)
        if not used.size or np.abs(slope[used] + weight * signs[used]).max() <= SLOPE_TOLERANCE:
            idle = np.where(signs == 0, np.abs(slope), 0.0)
            enter = idle.argmax()
            if idle[enter] <= weight + SLOPE_TOLERANCE:
                break
            signs[enter] = -np.sign(slope[enter])
            used = np.flatnonzero(signs)
        goal = np.zeros_like(x)
        goal[used] = np.linalg.lstsq(
            quad[np.ix_(used, used)], lin[used] - weight * signs[used], rcond=None
        )[0]
        crossing = used[(x[used] != 0) & (np.sign(goal[used]) != signs[used])]
        best, best_cost = goal, cost(goal)
        for i in crossing:
            stop = x + (goal - x) * (x[i] / (x[i] - goal[i]))
            stop[i] = 0.0
            if (stop_cost := cost(stop)) < best_cost:
                best, best_cost = stop, stop_cost
        if best_cost >= cost(x):
            break
        x, signs = best, np.sign(best)
    return x


def _most_probable(gram, moment, square, rows, n_knots) -> np.ndarray:
    """Parameters at the posterior mode.

    Alternates between the parameters for a given noise variance and the variance, which has a
    closed form. Trend and seasons have Gaussian priors and are eliminated exactly; the slope
    changes have a Laplace prior, which leaves a small sparse problem.
    """
    m = moment.size - n_knots
    ridge = np.full(m, 1.0 / SEASON_SCALE**2)
    ridge[:2] = 1.0 / TREND_SCALE**2
    ridge = np.diag(ridge)
    inner, mixed, bends = gram[:m, :m], gram[:m, m:], gram[m:, m:]
    sides = np.concatenate([moment[:m, None], mixed], axis=1)
    theta = np.zeros(moment.size)

    def next_variance(variance: float) -> float:
        """Fits the parameters for a noise variance; the variance that suits their residual."""
        solved = np.linalg.solve(inner + variance * ridge, sides)
        if n_knots:
            quad, lin = bends - mixed.T @ solved[:, 1:], moment[m:] - mixed.T @ solved[:, 0]
            theta[m:] = _sparse_minimum(quad, lin, variance / CHANGE_SCALE, theta[m:])
        theta[:m] = solved[:, 0] - solved[:, 1:] @ theta[m:]
        residual = max(square - 2.0 * theta @ moment + theta @ gram @ theta, 0.0)
        root = np.sqrt(rows**2 + 4.0 * residual / NOISE_SCALE**2)
        return max(2.0 * residual / (rows + root), LEAST_VARIANCE)

    variance = 0.01
    for _ in range(PLAIN_ROUNDS):
        previous, variance = variance, next_variance(variance)
        if abs(variance - previous) <= TOLERANCE * previous:
            return theta
    # A larger variance never leaves a smaller residual, so the rounds move one way, and the fixed
    # point they near lies between here and where a step would turn back.
    low, high = variance, variance
    if next_variance(variance) > variance:
        while next_variance(high) > high:
            high *= 2.0
    else:
        while low > LEAST_VARIANCE and next_variance(low) < low:
            low = max(low / 2.0, LEAST_VARIANCE)
    while high - low > TOLERANCE * high:
        middle = (low + high) / 2.0
        low, high = (middle, high) if next_variance(middle) > middle else (low, middle)
    next_variance((low + high) / 2.0)
    return theta


def fit_predict(
    days: np.ndarray, n: np.ndarray, total: np.ndarray, squares: np.ndarray,
    low: np.ndarray, high: np.ndarray, at: np.ndarray,
) -> np.ndarray | None:
    """Fitted values at the times ``at``.

    ``days`` are ascending times in days since the Unix epoch; the others are the count, sum,
    sum of squares, least and greatest value observed at each. One observation, or equal ones,
    give a constant; none gives None.
    """
    seen = n > 0
    days, n, total, squares = days[seen], n[seen].astype(float), total[seen], squares[seen]
    if not n.size:
        return None
    least, greatest = low[seen].min(), high[seen].max()
    if least == greatest or n.size == 1:
        return np.full(at.size, total.sum() / n.sum())
    scale = max(abs(least), abs(greatest))
    start, length = days[0], days[-1] - days[0]
    t = (days - start) / length
    knots, waves = times_at(knot_ranks(int(n.sum())), t, n), seasons(days[-1] - days[0], np.diff(days).min(initial=np.inf))
    gram, moment = sums(days, n, total / scale, start, length, knots, waves)
    theta = _most_probable(gram, moment, squares.sum() / scale**2, n.sum(), knots.size)
    return fitted(theta, at, start, length, knots, waves) * scale


def sums(days, n, total, start: float, length: float, knots: np.ndarray, waves) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrix and moments of a stretch of observations; those of several stretches add up."""
    gram, moment = 0.0, 0.0
    for lo in range(0, days.size, BLOCK_ROWS):
        part = slice(lo, lo + BLOCK_ROWS)
        x = _design((days[part] - start) / length, days[part], knots, waves)
        gram = gram + x.T @ (x * n[part, None])
        moment = moment + x.T @ total[part]
    return gram, moment


def solve(gram: np.ndarray, moment: np.ndarray, square: float, rows: float, n_knots: int) -> np.ndarray:
    """The most probable parameters, from sums over all observations."""
    return _most_probable(gram, moment, square, rows, n_knots)


def fitted(theta: np.ndarray, at: np.ndarray, start: float, length: float, knots: np.ndarray, waves) -> np.ndarray:
    return _design((at - start) / length, at, knots, waves) @ theta
