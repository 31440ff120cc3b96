"""Largest eigenvalues of a symmetric matrix by contour integration, interval by interval.

The spectrum is cut into intervals that hold a few eigenvalues each. How many an interval holds comes from
inertia: by Sylvester's law, the factors of ``A - shift`` have as many positive pivots as ``A`` has eigenvalues
above the shift. For one interval, ``(z - A)^-1 Y`` is summed over quadrature nodes ``z`` on a circle through its
ends, which projects ``Y`` onto the interval's eigenvectors; Rayleigh-Ritz on the projected block gives values and
vectors, and these feed the next round until as many Ritz pairs as the inertia counts have converged.
"""

from __future__ import annotations

import numpy as np

# Quadrature nodes on the upper half circle; those below are their conjugates.
_NODES = 8
_ROUNDS = 40
# Eigenvalues an interval may hold before it is cut in two.
_HELD = 6
# Widths and residuals are told relative to the norm of the matrix.
_NARROW = 1e-11
_CONVERGED = 2e-14
# Bunch and Parlett's bound on the growth of pivots.
_ALPHA = (1 + np.sqrt(17)) / 8


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """Numbers of positive, negative and zero eigenvalues, from a symmetric factorisation with full pivoting."""
    a = np.array(matrix, float)
    positive = negative = 0
    tiny = len(a) * np.finfo(float).eps * np.abs(a).max(initial=0.0)
    while len(a):
        n = len(a)
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(a)
        off[np.arange(n), np.arange(n)] = 0
        r, s = divmod(int(off.argmax()), n)
        if max(diagonal[p], off[r, s]) <= tiny:
            return positive, negative, n
        if diagonal[p] >= _ALPHA * off[r, s]:
            pivots = [p]
            positive, negative = positive + (a[p, p] > 0), negative + (a[p, p] < 0)
        else:
            # Such a block of two has one eigenvalue of each sign.
            pivots = [r, s]
            positive, negative = positive + 1, negative + 1
        rest = np.delete(np.arange(n), pivots)
        block, side = a[np.ix_(pivots, pivots)], a[np.ix_(rest, pivots)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return int(positive), int(negative), 0


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above ``shift``."""
    return inertia(matrix - shift * np.eye(len(matrix)))[0]


def _clear(matrix: np.ndarray, shift: float) -> float:
    """The shift, or one just below it, that no eigenvalue lies at."""
    gap = _NARROW
    while above(matrix, shift - gap) != above(matrix, shift + gap):
        shift -= 3 * gap
        gap *= 1.5
    return shift


def intervals(matrix: np.ndarray, wanted: int, floor: float) -> list[tuple[float, float, int]]:
    """``(low, high, count)``, highest first, which together hold the ``wanted`` largest eigenvalues above ``floor``.

    The matrix has norm one. An interval holds more than a few only where they lie as close as rounding.
    """
    top = 1 + 1e-6
    low = _clear(matrix, floor)
    held = above(matrix, low)
    wanted = min(wanted, held)
    if wanted == 0:
        return []
    # The highest place with at least ``wanted`` above it, and not many more.
    high = top
    while held > wanted + 2 and high - low > 100 * _NARROW:
        middle = _clear(matrix, (low + high) / 2)
        count = above(matrix, middle)
        if count >= wanted:
            low, held = middle, count
        else:
            high = middle

    def cut(a: float, b: float, count: int) -> list[tuple[float, float, int]]:
        if count == 0:
            return []
        if count <= _HELD or b - a <= 100 * _NARROW:
            return [(a, b, count)]
        middle = _clear(matrix, (a + b) / 2)
        upper = above(matrix, middle) - above(matrix, b)
        return cut(middle, b, upper) + cut(a, middle, count - upper)

    return cut(low, top, held)


def solve_interval(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All ``count`` eigenvalues in the interval, falling, and their vectors as columns."""
    d = len(matrix)
    size = min(d, count + max(4, count // 2))
    block = np.random.default_rng(0).standard_normal((d, size))
    centre, radius = (low + high) / 2, (high - low) / 2
    turns = np.exp(1j * np.pi * (np.arange(_NODES) + 0.5) / _NODES)
    shifted = [(centre + radius * t) * np.eye(d) - matrix for t in turns]
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    for _ in range(_ROUNDS):
        projected = sum((radius * t * np.linalg.solve(m, block)).real for t, m in zip(turns, shifted)) / _NODES
        values, block = rayleigh_ritz(matrix, projected)
        apart = np.linalg.norm(matrix @ block - block * values, axis=0)
        inside = (values > low) & (values < high) & (apart <= 1e-9)
        if inside.sum() == count:
            worst = apart[inside].max()
            if best is None or worst < best[0]:
                best = worst, values[inside], block[:, inside]
            elif worst >= best[0] and best[0] <= 1e-12:
                break  # no better than rounding allows
            if worst <= _CONVERGED:
                break
    if best is None:
        middle = _clear(matrix, centre)
        if not low < middle < high or high - low <= 100 * _NARROW:
            raise ArithmeticError(f"no {count} eigenvalues found between {low} and {high}")
        upper = above(matrix, middle) - above(matrix, high)
        parts = [(middle, high, upper), (low, middle, count - upper)]
        found = [solve_interval(matrix, *part) for part in parts if part[2]]
        return np.concatenate([v for v, _ in found]), np.concatenate([x for _, x in found], axis=1)
    order = np.argsort(-best[1], kind="stable")
    return best[1][order], best[2][:, order]


def rayleigh_ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values, falling, and orthonormal Ritz vectors of the space that the columns span."""
    basis, _ = np.linalg.qr(block)
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    return values[::-1], (basis @ turned)[:, ::-1]
