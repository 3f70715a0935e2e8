"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

``inertia`` factors A - s I = L D Lᵀ (Bunch-Kaufman pivots of one and two rows)
and counts the signs of D: by Sylvester's law as many eigenvalues lie above s
as D has positive ones. Bisection with these counts isolates each eigenvalue,
Rayleigh quotient iteration converges to it, and the counts on both sides of
the result certify its number. Eigenvalues that no count can part (equal to
rounding) share a bracket; their vectors are made orthogonal to one another.

The matrix has as many rows as a vector has dimensions, never as many as there
are vectors, so this runs where the sums arrive.
"""

from __future__ import annotations

import numpy as np

_ALPHA = (1 + 17 ** 0.5) / 8


def inertia(a: np.ndarray, shift: float) -> tuple[int, int, int]:
    """How many eigenvalues lie below, at and above ``shift``: the signs of D in L D Lᵀ."""
    m = a - shift * np.eye(len(a))
    below = at = above = 0
    while n := len(m):
        column = np.abs(m[1:, 0])
        most = column.max() if n > 1 else 0.0
        size = 1
        if max(abs(m[0, 0]), most) == 0.0:
            at, m = at + 1, m[1:, 1:]
            continue
        if abs(m[0, 0]) < _ALPHA * most:
            r = 1 + int(column.argmax())
            other = np.abs(m[r])
            other[r] = 0.0
            if abs(m[0, 0]) * other.max() >= _ALPHA * most ** 2:
                pass
            elif abs(m[r, r]) >= _ALPHA * other.max():
                _swap(m, 0, r)
            else:
                _swap(m, 1, r)
                size = 2
        if size == 1:
            d, low = m[0, 0], m[1:, 0]
            below, above = below + (d < 0), above + (d > 0)
            m = m[1:, 1:] - np.outer(low, low / d)
        else:  # such a block has one eigenvalue of either sign
            below, above = below + 1, above + 1
            low = m[2:, :2]
            m = m[2:, 2:] - low @ np.linalg.solve(m[:2, :2], low.T)
    return below, at, above


def _swap(m: np.ndarray, i: int, j: int) -> None:
    m[[i, j]] = m[[j, i]]
    m[:, [i, j]] = m[:, [j, i]]


def _above(a: np.ndarray, shift: float) -> int:
    return inertia(a, shift)[2]


def _orthogonal(v: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):  # twice is enough
        for u in found:
            v = v - (u @ v) * u
    return v / np.linalg.norm(v)


def _solve(a: np.ndarray, shift: float, v: np.ndarray, tiny: float) -> np.ndarray:
    for _ in range(60):
        try:
            x = np.linalg.solve(a - shift * np.eye(len(a)), v)
            if np.isfinite(x).all() and np.abs(x).max() > 0:
                return x
        except np.linalg.LinAlgError:
            pass
        shift += tiny
        tiny *= 2
    return v


def leading(a: np.ndarray, most: int) -> list[tuple[float, np.ndarray]]:
    """The ``most`` greatest eigenvalues that are above rounding, falling, with unit vectors.

    The sign of a vector makes its entry of greatest magnitude (the first of equals) positive."""
    d = len(a)
    scale = float(np.abs(a).sum(axis=1).max()) if d else 0.0  # no eigenvalue is greater
    if not scale > 0:
        return []
    a = a / scale
    tiny = 4 * d * np.finfo(float).eps
    rng = np.random.default_rng(17)
    out: list[tuple[float, np.ndarray]] = []
    for number in range(1, min(most, d) + 1):
        low, high = tiny, 1.0 + tiny
        if _above(a, low) < number:
            break
        n_low, n_high = _above(a, low), 0
        # one eigenvalue in the bracket, or as many as cannot be told apart
        while (n_low >= number + 1 or n_high < number - 1) and high - low > tiny:
            middle = (low + high) / 2
            n = _above(a, middle)
            low, high, n_low, n_high = (middle, high, n, n_high) if n >= number else (low, middle, n_low, n)
        found = [v for _, v in out]
        v = _orthogonal(rng.standard_normal(d), found)
        while True:
            value, vector = _rayleigh(a, (low + high) / 2, v, found, low, high, tiny)
            if low - tiny <= value <= high + tiny and _certified(a, value, number, tiny):
                break
            if high - low <= tiny:
                break
            middle = (low + high) / 2  # the iteration went to a neighbour: halve the bracket
            low, high = (middle, high) if _above(a, middle) >= number else (low, middle)
        out.append((value, vector))
    out.sort(key=lambda x: -x[0])
    return [(value * scale, v * np.sign(v[np.abs(v).argmax()])) for value, v in out]


def _rayleigh(a, shift, v, found, low, high, tiny) -> tuple[float, np.ndarray]:
    """Two steps of inverse iteration at the bracket's middle, then Rayleigh quotient shifts inside the bracket.

    One step more follows the first residual at rounding: it takes the vector there as well."""
    small = 0
    for step in range(40):
        v = _orthogonal(_solve(a, shift, v, tiny), found)
        value = float(v @ a @ v)
        small += float(np.linalg.norm(a @ v - value * v)) <= tiny
        if step >= 2 and small >= 2:
            break
        if step >= 1 and low <= value <= high:
            shift = value
    return value, v


def _certified(a: np.ndarray, value: float, number: int, tiny: float) -> bool:
    """At least ``number`` eigenvalues are not below the value and fewer are above it, to rounding."""
    return _above(a, value - 2 * tiny) >= number > _above(a, value + 2 * tiny)
