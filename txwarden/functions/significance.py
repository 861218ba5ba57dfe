"""Tail probabilities of the drift tests; called once per column on a handful of numbers."""

from __future__ import annotations

import math

import numpy as np


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi_square_tail(statistic: float, dof: int) -> float:
    """P(X > statistic), by the finite sums for whole degrees of freedom."""
    if dof <= 0:
        return 1.0
    if math.isinf(statistic):
        return 0.0
    half = statistic / 2.0
    if half <= 0:
        return 1.0
    start = 0.5 if dof % 2 else 0.0
    total = math.erfc(math.sqrt(half)) if dof % 2 else 0.0
    total += sum(
        math.exp((start + i) * math.log(half) - half - math.lgamma(start + i + 1.0))
        for i in range(dof // 2)
    )
    return min(total, 1.0)


def ks_two_sample_tail(distance: float, n: int, m: int, exact: bool = False) -> float:
    """P(D >= distance) for two samples of sizes n and m without drift.

    By the limiting series with its correction for the sample sizes; `exact` counts merge orders
    instead, which takes n times m steps.
    """
    if distance <= 0:
        return 1.0
    if exact:
        return _ks_by_paths(distance, n, m)
    size = math.sqrt(n * m / (n + m))
    lam = (size + 0.12 + 0.11 / size) * distance
    if lam < 0.2:  # the alternating series has not converged there; its value is 1
        return 1.0
    tail = 2.0 * sum((-1) ** (k - 1) * math.exp(-2.0 * k * k * lam * lam) for k in range(1, 101))
    return min(max(tail, 0.0), 1.0)


def _ks_by_paths(distance: float, n: int, m: int) -> float:
    """Share of merge orders of the two samples whose distribution functions ever part by `distance`.

    A merge order is a lattice path from (0, 0) to (n, m); paths that stay inside the band are
    counted row by row, rescaled so the counts stay in range.
    """
    n, m = min(n, m), max(n, m)
    # |i/n - j/m| on whole numbers: the distance is a multiple of 1 / (n m).
    reach = round(distance * n * m)
    j = np.arange(m + 1)
    ways = np.where(j * n < reach, 1.0, 0.0)
    log_scale = 0.0
    for i in range(1, n + 1):
        inside = np.abs(i * m - j * n) < reach
        if not inside.any():
            return 1.0
        low, high = np.flatnonzero(inside)[[0, -1]]
        row = np.zeros(m + 1)
        row[low:high + 1] = np.cumsum(ways[low:high + 1])
        top = row.max()
        if top == 0.0:
            return 1.0
        ways = row / top
        log_scale += math.log(top)
    if ways[m] == 0.0:
        return 1.0
    log_all = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    log_inside = math.log(ways[m]) + log_scale
    return min(max(-math.expm1(log_inside - log_all), 0.0), 1.0)
