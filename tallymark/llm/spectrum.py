"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The signs of the pivots of an LDLᵀ factorisation of the shifted matrix count the eigenvalues above the shift (Sylvester's law of
inertia). Bisection by such counts isolates each wanted eigenvalue, Rayleigh quotient iteration converges cubically to it, and a
count on either side of the result certifies its number.
"""

from __future__ import annotations

import numpy as np

#: Bunch and Kaufman's bound between pivots of one and two rows.
PIVOT = (1 + 17**0.5) / 8
ROUNDS = 40


def count_above(matrix: np.ndarray, shift: float) -> int:
    """The number of eigenvalues greater than `shift`: positive pivots of LDLᵀ with symmetric pivoting."""
    a = matrix - shift * np.eye(len(matrix))
    positive, k, n = 0, 0, len(a)

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        pair = False
        if k + 1 < n:
            column = np.abs(a[k + 1 :, k])
            r = k + 1 + int(column.argmax())
            below, own = column[r - k - 1], abs(a[k, k])
            if below > 0 and own < PIVOT * below:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                most = row.max()
                if own * most < PIVOT * below * below:
                    if abs(a[r, r]) >= PIVOT * most:
                        swap(k, r)
                    else:
                        swap(k + 1, r)
                        pair = True
        if pair:
            # such a block has one eigenvalue of either sign
            side = a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= side @ np.linalg.solve(a[k : k + 2, k : k + 2], side.T)
            positive, k = positive + 1, k + 2
            continue
        pivot = a[k, k]
        if pivot != 0:
            side = a[k + 1 :, k].copy()
            a[k + 1 :, k + 1 :] -= np.outer(side, side / pivot)
        positive, k = positive + (pivot > 0), k + 1
    return positive


class Slices:
    """Counts at shifts that were tried, and the bounds they give each eigenvalue."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
        #: differences of eigenvalues below this are rounding
        self.grain = 8 * np.finfo(float).eps * self.norm * max(len(matrix), 1) ** 0.5
        edge = 1.01 * self.norm + self.grain
        self.known = {-edge: len(matrix), edge: 0}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = count_above(self.matrix, shift)
        return self.known[shift]

    def interval(self, number: int) -> tuple[float, float]:
        """The narrowest known interval that holds the eigenvalue of that number (1 is the largest)."""
        return max(s for s, c in self.known.items() if c >= number), min(s for s, c in self.known.items() if c < number)


def _orthogonal(z: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for q in found:
            z = z - (q @ z) * q
    return z / np.linalg.norm(z)


def _solve(matrix: np.ndarray, shift: float, q: np.ndarray, grain: float) -> np.ndarray:
    eye = np.eye(len(matrix))
    for step in range(4):
        try:
            z = np.linalg.solve(matrix - shift * eye, q)
            if np.isfinite(z).all():
                return z
        except np.linalg.LinAlgError:
            pass
        shift += grain * (step + 1)
    return q


def _rayleigh(matrix: np.ndarray, middle: float, found: list[np.ndarray], grain: float, start: np.ndarray) -> tuple[float, np.ndarray]:
    """Inverse iteration at the middle of the interval, then Rayleigh quotient iteration, orthogonal to what was found."""
    q = _orthogonal(start, found)
    for _ in range(4):
        q = _orthogonal(_solve(matrix, middle, q, grain), found)
    value, residual = float(q @ matrix @ q), np.inf
    for _ in range(ROUNDS):
        z = _orthogonal(_solve(matrix, value, q, grain), found)
        at = float(z @ matrix @ z)
        now = float(np.linalg.norm(matrix @ z - at * z))
        if now >= residual and residual <= grain:
            break
        q, value, residual = z, at, now
    return value, q


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as rows) of the `wanted` largest eigenvalues, numbered by falling value and certified by counts.

    Eigenvalues that differ by rounding only are one cluster; its vectors are an orthonormal basis of their space.
    """
    slices, rng = Slices(matrix), np.random.default_rng(11)
    values, vectors = [], []
    number = 1
    while number <= min(wanted, len(matrix)):
        lo, hi = slices.interval(number)
        alone = slices.above(lo) == number and slices.above(hi) == number - 1
        narrow = hi - lo <= slices.grain
        if alone or narrow:
            value, q = _rayleigh(matrix, (lo + hi) / 2, vectors, slices.grain, rng.normal(size=len(matrix)))
            sure = slices.above(value - slices.grain) >= number > slices.above(value + slices.grain)
            if sure or narrow:
                values.append(value)
                vectors.append(q)
                number += 1
                continue
        slices.above((lo + hi) / 2)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors).reshape(-1, len(matrix))[order]
