"""Leading eigenpairs of a symmetric matrix by slicing its spectrum.

An LDL' factorisation of ``A - s I`` tells how many eigenvalues lie above ``s``:
as many as the block-diagonal factor has positive ones.  Bisection on these
counts isolates each of the leading eigenvalues, Rayleigh quotient iteration
started inside the interval converges cubically, and two more counts certify
the number of the eigenvalue it found.  The matrix has the size of a vector
squared, whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np

PIVOT = (1 + 17 ** 0.5) / 8      # bound of element growth for 1x1 against 2x2 pivots
EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny ** 0.5


class Factors:
    """``P A P' = L D L'`` of a symmetric matrix, D with blocks of one or two rows."""

    def __init__(self, matrix: np.ndarray):
        a = np.array(matrix, dtype=float)
        n, at = len(a), 0
        self.order, self.blocks, self.lower = np.arange(n), [], a
        floor = EPS * max(np.abs(a).max(initial=0.0), TINY)

        def swap(i, j):
            a[[i, j]], self.order[[i, j]] = a[[j, i]], self.order[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

        while at < n:
            size = 1
            below = np.abs(a[at + 1:, at])
            if len(below) and abs(a[at, at]) < PIVOT * below.max():
                row, most = at + 1 + int(below.argmax()), below.max()
                beside = np.abs(a[row, at:])
                beside[row - at] = 0
                if abs(a[at, at]) * beside.max() < PIVOT * most ** 2:
                    if abs(a[row, row]) >= PIVOT * beside.max():
                        swap(at, row)
                    else:
                        swap(at + 1, row)
                        size = 2
            end = at + size
            if size == 1 and abs(a[at, at]) < floor:
                a[at, at] = floor
            block, rest = a[at:end, at:end].copy(), a[end:, at:end].copy()
            inverse = np.array([[1 / block[0, 0]]]) if size == 1 else np.linalg.inv(block)
            a[end:, at:end] = rest @ inverse
            a[end:, end:] -= a[end:, at:end] @ rest.T
            self.blocks.append((at, end, block, inverse))
            at = end

    def positive(self) -> int:
        """The number of positive eigenvalues."""
        found = 0
        for at, end, block, _ in self.blocks:
            if end - at == 1:
                found += block[0, 0] > 0
            else:
                det = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
                found += 1 if det < 0 else 2 * (block[0, 0] + block[1, 1] > 0)
        return int(found)

    def solve(self, right: np.ndarray) -> np.ndarray:
        y = right[self.order].astype(float)
        for at, end, _, _ in self.blocks:
            y[end:] -= self.lower[end:, at:end] @ y[at:end]
        for at, end, _, inverse in self.blocks:
            y[at:end] = inverse @ y[at:end]
        for at, end, _, _ in reversed(self.blocks):
            y[at:end] -= self.lower[end:, at:end].T @ y[end:]
        made = np.empty_like(y)
        made[self.order] = y
        return made


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``."""
    return Factors(matrix - shift * np.eye(len(matrix))).positive()


def _unit(vector: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """The part of a vector that is orthogonal to others, with length one."""
    for _ in range(2):
        for other in against:
            vector = vector - (other @ vector) * other
    return vector / np.linalg.norm(vector)


def _refined(matrix: np.ndarray, low: float, high: float, start: np.ndarray, cluster: list[np.ndarray], alone: bool):
    """Rayleigh quotient iteration from inside ``(low, high)``; None if it leaves the interval."""
    eye, slack = np.eye(len(matrix)), len(matrix) * EPS
    vector, shift = _unit(start, cluster), (low + high) / 2
    best, stuck = None, 0
    for turn in range(40):
        vector = _unit(Factors(matrix - shift * eye).solve(vector), cluster)
        value = float(vector @ matrix @ vector)
        wrong = float(np.linalg.norm(matrix @ vector - value * vector))
        if best is None or wrong < best[0]:
            best, stuck = (wrong, value, vector), 0
        else:
            stuck += 1
        if stuck == 2 or wrong <= EPS / 4:
            break
        if turn and alone:  # a cluster has no single quotient to follow
            shift = value
    wrong, value, vector = best
    inside = low - slack <= value <= high + slack
    return (value, vector) if inside and wrong <= 8 * slack else None


def leading_pairs(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` greatest eigenvalues, falling, and their unit vectors as rows.

    Eigenvalues that agree to rounding form a cluster, whose vectors are an
    orthonormal basis of its space.  A matrix of zeros has zeros and the unit
    axes.  ``ArithmeticError`` if the counts don't confirm a number.
    """
    n = len(matrix)
    most = min(most, n)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0.0))  # no eigenvalue is larger
    if scale == 0:
        return np.zeros(most), np.eye(n)[:most]
    a = (matrix + matrix.T) / (2 * scale)
    known: dict[float, int] = {1.0 + 2 * EPS: 0, -1.0 - 2 * EPS: n}

    def above(shift: float) -> int:
        if shift not in known:
            known[shift] = count_above(a, shift)
        return known[shift]

    rng = np.random.default_rng(0)
    slack = 4 * n * EPS
    values, vectors, owners = [], [], []
    for number in range(1, most + 1):
        high = min(s for s, c in known.items() if c < number)
        low = max(s for s, c in known.items() if c >= number and s < high)
        found = None
        while found is None:
            while high - low > 2 * slack and above(low) - above(high) > 1:
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= number else (low, middle)
            alone = above(low) - above(high) == 1
            same = [] if alone else [v for v, (l, h) in zip(vectors, owners) if h >= low and l <= high]
            found = _refined(a, low, high, rng.standard_normal(n), same, alone)
            if found and alone and not above(found[0] + slack) < number <= above(found[0] - slack):
                found = None  # a neighbour just outside
            if found is None:
                if high - low <= 2 * slack:
                    raise ArithmeticError(f"no eigenvector between {low * scale} and {high * scale}")
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= number else (low, middle)
        value, vector = found
        values.append(value)
        vectors.append(_unit(vector, vectors))
        owners.append((low, high))
    order = np.argsort(-np.array(values), kind="stable")  # inside a cluster only
    return np.array(values)[order] * scale, np.array(vectors)[order]
