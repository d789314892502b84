"""Tail probabilities for the paired tests: small scalar helpers for one row per compared group."""

from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def regularized_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float | None, dof: float | None) -> float | None:
    """Two-sided p-value of a Student-t statistic; None where it is undefined."""
    if t is None or dof is None or dof < 1 or math.isnan(t):
        return None
    if math.isinf(t):
        return 0.0
    if dof > 1e7:
        return math.erfc(abs(t) / math.sqrt(2.0))
    return regularized_beta(dof / 2.0, 0.5, dof / (dof + t * t))


def signed_rank_two_sided(
    w_plus: float | None, n: int | None, tie_term: float, normal: bool
) -> float | None:
    """Two-sided p-value of the signed-rank statistic over n non-zero differences.

    By the exact null distribution, which is counted (n * n^2 / 2 steps), or by the normal approximation
    with its tie correction.
    """
    if w_plus is None or not n:
        return None
    total = n * (n + 1) / 2.0
    w = min(w_plus, total - w_plus)
    if not normal:
        ways = [1] + [0] * int(total)
        for rank in range(1, n + 1):
            for s in range(int(total), rank - 1, -1):
                ways[s] += ways[s - rank]
        return min(1.0, 2.0 * sum(ways[: int(w) + 1]) / 2.0**n)
    variance = n * (n + 1) * (2 * n + 1) / 24.0 - tie_term / 48.0
    if variance <= 0:
        return None
    return math.erfc(abs(w - total / 2.0) / math.sqrt(variance) / math.sqrt(2.0))


def tied_signed_rank_two_sided(w_plus: float | None, doubled: list[int], counts: list[int]) -> float | None:
    """Two-sided exact p-value of the signed-rank statistic with ties.

    ``doubled`` holds twice the mid-rank of each group of equal absolute differences (a whole number), ``counts`` their number. Under the
    null every difference has either sign alike, so the ways to reach a sum are counted group by group, with binomial weights.
    """
    if w_plus is None or not counts:
        return None
    total = sum(r * c for r, c in zip(doubled, counts))
    ways = [1] + [0] * total
    top = 0
    for rank, count in zip(doubled, counts):
        chosen = [math.comb(count, k) for k in range(count + 1)]
        fresh = [0] * (total + 1)
        for s in range(top + 1):
            if ways[s]:
                for k, many in enumerate(chosen):
                    fresh[s + k * rank] += ways[s] * many
        ways, top = fresh, top + rank * count
    low = min(round(2 * w_plus), total - round(2 * w_plus))
    return min(1.0, 2.0 * (sum(ways[: low + 1]) / 2 ** sum(counts)))
