"""Singular values and right singular vectors of a small matrix through its bidiagonal form.

Householder reflections make the matrix upper bidiagonal; the qd array of squared
diagonals is driven to its squared singular values by the differential quotient
difference transform with shifts (dqds), which loses no relative accuracy; each
vector then comes from a twisted factorisation of the shifted tridiagonal matrix.
The matrix is one triangle of a dimension's size, whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
#: Values closer than this share of the larger are one cluster, whose vectors are made orthogonal.
CLUSTER = 1e-3
SWEEPS = 60


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right basis V of ``matrix = U B V'``."""
    work = matrix.astype(np.float64).copy()
    size = work.shape[1]
    basis = np.eye(size)
    for k in range(size):
        reflect(work[k:, k:])
        if k < size - 2:
            # the reflection of the row's tail, also applied to the basis
            v, scale = householder(work[k, k + 1 :])
            work[k:, k + 1 :] -= np.outer(work[k:, k + 1 :] @ v, scale * v)
            basis[:, k + 1 :] -= np.outer(basis[:, k + 1 :] @ v, scale * v)
    return np.diag(work).copy(), np.diag(work, 1).copy(), basis


def householder(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and s such that (I - s v v') x has only its first entry left."""
    v = x.copy()
    length = np.linalg.norm(x)
    if length == 0:
        return v, 0.0
    v[0] += np.copysign(length, v[0])
    return v, 2.0 / (v @ v)


def reflect(block: np.ndarray) -> None:
    """Clear the first column of ``block`` below its first entry, in place."""
    v, scale = householder(block[:, 0])
    block -= np.outer(scale * v, v @ block)


def transform(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One dqds step; the smallest of its differences is negative where the shift was too large."""
    new_q, new_e = np.empty_like(q), np.empty_like(e)
    d = least = q[0] - shift
    for k in range(len(e)):
        new_q[k] = d + e[k]
        ratio = q[k + 1] / new_q[k] if new_q[k] else 0.0
        new_e[k] = e[k] * ratio
        d = (d * ratio if new_q[k] else q[k + 1]) - shift
        least = min(least, d)
        if least < 0:
            break
    new_q[-1] = d
    return new_q, new_e, least


def last_value(q: np.ndarray, e: np.ndarray) -> float:
    """The smaller eigenvalue of the trailing two by two part: a guess of the smallest."""
    a, b = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1]
    c = e[-1] * q[-2]
    mean, half = (a + b) / 2, (a - b) / 2
    return max(0.0, mean - np.hypot(half, np.sqrt(c)))


def squared_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the upper bidiagonal (a, b), largest first."""
    found: list[float] = []
    top = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if top == 0:
        return np.zeros(len(a))
    parts = [((a / top) ** 2, (b / top) ** 2, 0.0)]
    while parts:
        q, e, moved = parts.pop()
        tries = 0
        while len(q) > 1:
            small = np.flatnonzero(e <= (EPS * EPS) * (moved + np.minimum(q[:-1], q[1:])))
            if len(small):
                at = small[-1]
                parts.append((q[at + 1 :], e[at + 1 :], moved))
                q, e, tries = q[: at + 1], e[:at], 0
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1].copy(), e[::-1].copy()
            guess = last_value(q, e) if tries < SWEEPS * len(q) else 0.0
            for shift in (guess, 0.9 * guess, 0.25 * guess, 0.0):
                new_q, new_e, least = transform(q, e, shift)
                if least >= 0 or shift == 0:
                    break
            q, e, moved, tries = np.maximum(new_q, 0), np.maximum(new_e, 0), moved + shift, tries + 1
        found.append(moved + (q[0] if len(q) else 0.0))
    return np.sort(np.array(found))[::-1] * top * top


def factored(q: np.ndarray, steps: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multipliers of both triangular factorisations of ``L D L' - value`` and the twists' pivots."""
    n, tiny = len(q), np.finfo(np.float64).tiny / EPS
    down, up = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.empty(n), np.empty(n)
    s[0], p[-1] = -value, q[-1] - value
    for i in range(n - 1):
        pivot = s[i] + q[i]
        pivot = pivot if pivot else tiny
        down[i] = q[i] * steps[i] / pivot
        s[i + 1] = down[i] * steps[i] * s[i] - value
    for i in range(n - 2, -1, -1):
        pivot = q[i] * steps[i] ** 2 + p[i + 1]
        pivot = pivot if pivot else tiny
        ratio = q[i] / pivot
        up[i] = steps[i] * ratio
        p[i] = p[i + 1] * ratio - value
    return down, up, s + p + value


def twisted(down: np.ndarray, up: np.ndarray, at: int) -> np.ndarray:
    """The vector that both factorisations, joined at ``at``, leave there."""
    z = np.zeros(len(down) + 1)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(at, len(up)):
        z[i + 1] = -up[i] * z[i]
    return z


def block_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right singular vectors, one column a value, of one unreduced bidiagonal block."""
    n = len(a)
    if n == 1:
        return np.ones((1, len(values)))
    floor = EPS * max(np.abs(a).max(), np.abs(b).max())
    diagonal = np.where(np.abs(a) < floor, np.copysign(floor, a), a)
    q, steps = diagonal**2, b / diagonal[:-1]
    columns: list[np.ndarray] = []
    first = 0
    for number, value in enumerate(values):
        if number and values[number - 1] - value > CLUSTER * values[number - 1]:
            first = number
        with np.errstate(all="ignore"):
            down, up, pivots = factored(q, steps, value)
            # one Rayleigh correction of the value
            at = int(np.nanargmin(np.abs(pivots)))
            step = pivots[at] / (twisted(down, up, at) ** 2).sum()
            if abs(step) < CLUSTER * 1e-3 * value:
                down, up, pivots = factored(q, steps, value + step)
            near = np.array(columns[first:]).T if first < number else np.zeros((n, 0))
            chosen, left = None, -1.0
            for at in np.argsort(np.abs(pivots)):
                z = twisted(down, up, int(at))
                z = z / np.linalg.norm(z)
                for _ in range(2):
                    z = z - near @ (near.T @ z)
                length = np.linalg.norm(z)
                if np.isfinite(length) and length > left:
                    chosen, left = z / (length or 1.0), length
                if left > 0.5:
                    break
        columns.append(chosen if chosen is not None else np.zeros(n))
    return np.array(columns).T


def decompose(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, largest first, and unit right singular vectors as columns."""
    a, b, basis = bidiagonal(matrix)
    size = len(a)
    top = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    cuts = np.flatnonzero(np.abs(b) <= size * EPS * top) + 1
    values, vectors = [], []
    for low, high in zip([0, *cuts], [*cuts, size], strict=True):
        part = squared_values(a[low:high], b[low : high - 1])
        columns = np.zeros((size, high - low))
        columns[low:high] = block_vectors(a[low:high], b[low : high - 1], part)
        values.append(part)
        vectors.append(columns)
    all_values, all_vectors = np.concatenate(values), np.hstack(vectors)
    order = np.argsort(-all_values, kind="stable")
    return all_values[order], basis @ all_vectors[:, order]
