"""Leading eigenpairs of a symmetric matrix that fits one machine.

Householder reflections make the matrix tridiagonal, Sturm counts bisect to
the leading eigenvalues, inverse iteration gives their vectors; vectors of
close eigenvalues are orthogonalised against each other in every sweep. All
wanted pairs are worked on at once, so the Python loops run over the order of
the matrix only.
"""

from __future__ import annotations

import numpy as np

# Eigenvalues closer than this share of the matrix norm form a cluster.
CLUSTER = 1e-3
SWEEPS = 5
_EPS = np.finfo(float).eps


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, float]]]:
    """(diagonal, off-diagonal, reflections) of a symmetric matrix."""
    a = np.array(a, float)
    d = len(a)
    turns = []
    for k in range(d - 2):
        v = a[k + 1:, k].copy()
        size = np.linalg.norm(v)
        if size == 0.0 or not np.any(v[1:]):
            turns.append((v, 0.0))
            continue
        to = -size if v[0] >= 0 else size
        v[0] -= to
        beta = 2.0 / (v @ v)
        rest = a[k + 1:, k + 1:]
        p = beta * (rest @ v)
        w = p - (0.5 * beta * (p @ v)) * v
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1, k] = a[k, k + 1] = to
        turns.append((v, beta))
    return np.diag(a).copy(), np.diag(a, -1).copy(), turns


def sturm_counts(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eigenvalues of the tridiagonal matrix below each value of ``at``."""
    least = _EPS * _EPS * max(np.abs(diag).max(initial=0.0), np.abs(off).max(initial=0.0), 1e-300) + 1e-300
    q = diag[0] - at
    n = (q < 0).astype(np.int64)
    for i in range(1, len(diag)):
        q = np.where(np.abs(q) < least, -least, q)
        q = diag[i] - at - off[i - 1] * off[i - 1] / q
        n += q < 0
    return n


def leading_values(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling."""
    d = len(diag)
    reach = np.zeros(d)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    span = float((diag + reach).max() - (diag - reach).min())
    slack = _EPS * d * max(abs(float((diag + reach).max())), abs(float((diag - reach).min())), span) + 1e-300
    lo = np.full(k, float((diag - reach).min()) - slack)
    hi = np.full(k, float((diag + reach).max()) + slack)
    place = d - 1 - np.arange(k)        # position from below of the wanted eigenvalues
    while True:
        mid = lo + (hi - lo) / 2
        if np.all((mid <= lo) | (mid >= hi) | (hi - lo <= _EPS * np.maximum(np.abs(lo), np.abs(hi)))):
            return mid
        under = sturm_counts(diag, off, mid) > place
        hi, lo = np.where(under, mid, hi), np.where(under, lo, mid)


def _solve(diag: np.ndarray, off: np.ndarray, shifts: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Columns y with (T - shift) y = right, by elimination with row exchange."""
    d, k = right.shape
    least = _EPS * max(np.abs(diag).max(), np.abs(off).max(initial=0.0), 1e-300)
    u0, u1, u2 = np.empty((d, k)), np.zeros((d, k)), np.zeros((d, k))
    y = right.copy()
    here, nxt = diag[0] - shifts, np.full(k, off[0] if d > 1 else 0.0)
    for i in range(d - 1):
        low0, low1 = np.full(k, off[i]), diag[i + 1] - shifts
        low2 = np.full(k, off[i + 1] if i + 2 < d else 0.0)
        turn = np.abs(low0) > np.abs(here)
        p0, r0 = np.where(turn, low0, here), np.where(turn, here, low0)
        p1, r1 = np.where(turn, low1, nxt), np.where(turn, nxt, low1)
        p2, r2 = np.where(turn, low2, 0.0), np.where(turn, 0.0, low2)
        p0 = np.where(np.abs(p0) < least, least, p0)
        m = r0 / p0
        u0[i], u1[i], u2[i] = p0, p1, p2
        top, low = np.where(turn, y[i + 1], y[i]), np.where(turn, y[i], y[i + 1])
        y[i], y[i + 1] = top, low - m * top
        here, nxt = r1 - m * p1, r2 - m * p2
    u0[d - 1] = np.where(np.abs(here) < least, least, here)
    for i in range(d - 1, -1, -1):
        if i + 1 < d:
            y[i] -= u1[i] * y[i + 1]
        if i + 2 < d:
            y[i] -= u2[i] * y[i + 2]
        y[i] /= u0[i]
    return y


def _clusters(values: np.ndarray, norm: float) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(-np.diff(values) > CLUSTER * norm) + 1).tolist(), len(values)]
    return list(zip(cuts[:-1], cuts[1:]))


def _orthogonal(y: np.ndarray, lo: int, hi: int) -> None:
    for j in range(lo, hi):
        for _ in range(2):
            before = y[:, lo:j]
            y[:, j] -= before @ (before.T @ y[:, j])
            size = np.linalg.norm(y[:, j])
            y[:, j] /= size if size > 0 else 1.0


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the ``k`` largest eigenvalues of the symmetric
    matrix ``a``, falling; vectors are unit columns whose largest entry is
    positive. ``k`` beyond the order counts as the order."""
    d = len(a)
    k = min(k, d)
    if not k:
        return np.zeros(0), np.zeros((d, 0))
    scale = float(np.abs(a).max())
    if scale == 0.0:
        return np.zeros(k), np.eye(d)[:, :k]
    diag, off, turns = tridiagonal(np.asarray(a, float) / scale)
    values = leading_values(diag, off, k)
    norm = max(float(np.abs(diag).max()), float(np.abs(off).max(initial=0.0)))
    y = np.random.default_rng(1).standard_normal((d, k))
    y /= np.linalg.norm(y, axis=0)
    near = values - 4 * _EPS * norm * np.arange(k)      # equal values get shifts of their own
    groups = _clusters(values, norm)
    for _ in range(SWEEPS):
        y = _solve(diag, off, near, y)
        y /= np.abs(y).max(axis=0)
        y /= np.linalg.norm(y, axis=0)
        for lo, hi in groups:
            _orthogonal(y, lo, hi)
    for step in range(len(turns) - 1, -1, -1):
        v, beta = turns[step]
        if beta:
            y[step + 1:] -= beta * np.outer(v, v @ y[step + 1:])
    y /= np.linalg.norm(y, axis=0)
    top = y[np.abs(y).argmax(axis=0), np.arange(k)]
    return values * scale, y * np.where(top < 0, -1.0, 1.0)
