"""Largest singular values and right singular vectors of a square matrix, by a bidiagonal qd solver.

Householder reflections bring the matrix to upper bidiagonal form; differential qd sweeps with shifts find the squares
of all singular values to high relative accuracy; a twisted factorisation for each wanted square gives its vector
without an iteration. All of it works on one small matrix.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
# A coupling below this share of what stands beside it is nothing.
_NEGLIGIBLE = (10 * EPS) ** 2
# Vectors of values closer than this are orthogonalised.
_CLOSE = 1e-3
_TWISTS = 8
_TINY = 1e-290


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(v, beta) of the reflection 1 - beta v v' that leaves only the first entry of ``x``."""
    v = x.copy()
    norm = float(np.sqrt(v @ v))
    if norm == 0:
        return v, 0.0
    v[0] += np.copysign(norm, v[0])
    return v, 2.0 / float(v @ v)


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, float]]]:
    """Diagonal and superdiagonal of an equivalent upper bidiagonal matrix, and the reflections from the right."""
    m = np.array(matrix, float)
    d, rights = len(m), []
    for k in range(d):
        v, beta = _reflector(m[k:, k])
        m[k:, k:] -= beta * np.outer(v, v @ m[k:, k:])
        if k < d - 2:
            v, beta = _reflector(m[k, k + 1:])
            m[k:, k + 1:] -= beta * np.outer(m[k:, k + 1:] @ v, v)
            rights.append((v, beta))
    return np.diag(m).copy(), np.diag(m, 1).copy(), rights


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd step; None if the shift exceeds the least value."""
    out_q, out_e = [0.0] * len(q), [0.0] * len(e)
    d = q[0] - shift
    if d < 0:
        return None
    for k in range(len(e)):
        top = d + e[k]
        out_q[k] = top
        if top == 0:
            # Nothing stands before the next entry: the list splits here.
            d = q[k + 1] - shift
        else:
            t = q[k + 1] / top
            out_e[k] = e[k] * t
            d = d * t - shift
        if d < 0:
            return None
    out_q[-1] = d
    return out_q, out_e, d


def _lower_bound(q: list[float], e: list[float]) -> float:
    """What the least value is not below: a Newton step, from the diagonal of the inverse that a sweep yields."""
    d, total = q[0], 0.0
    for k in range(len(e)):
        if d <= _TINY:
            return 0.0
        total += 1 / d
        d = d * (q[k + 1] / (d + e[k]))
    return 0.0 if d <= _TINY else (1 - 8 * EPS * len(q)) / (total + 1 / d)


def squares(a: np.ndarray, b: np.ndarray) -> list[float]:
    """Squares of the singular values of the bidiagonal matrix (a, b), falling."""
    found: list[float] = []
    waiting = [((a * a).tolist(), (b * b).tolist(), 0.0)]
    while waiting:
        q, e, sigma = waiting.pop()
        while len(q) > 1:
            if e[-1] <= _NEGLIGIBLE * (sigma + q[-1]) or e[-1] <= _TINY:
                found.append(sigma + q.pop())
                e.pop()
                continue
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= _TINY), None)
            if cut is not None:
                waiting.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            shift = _lower_bound(q, e)
            done = None
            # Near the end the last entry is almost the least value: a bolder shift, withdrawn if it is too large.
            bold = q[-1] - 2 * (q[-1] * e[-1]) ** 0.5
            if bold > shift:
                done, taken = _sweep(q, e, bold), bold
            if done is None:
                done, taken = _sweep(q, e, shift), shift
            if done is None:
                done, taken = _sweep(q, e, 0.0), 0.0
            q, e, _ = done
            sigma += taken
        found += [sigma + x for x in q]
    return sorted(found, reverse=True)


class _Twist:
    """Both factorisations of B'B - value, from the top and from the bottom, and where they meet best."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float):
        n = len(a)
        scale = EPS * (float(np.max(a * a)) + value)
        self.down, self.up = np.zeros(n - 1), np.zeros(n - 1)
        s, p = np.empty(n), np.empty(n)
        s[0] = -value
        for k in range(n - 1):
            pivot = s[k] + a[k] * a[k] or scale
            self.down[k] = a[k] * b[k] / pivot
            s[k + 1] = s[k] * (b[k] * b[k] / pivot) - value
        p[-1] = a[-1] * a[-1] - value
        for k in range(n - 2, -1, -1):
            pivot = b[k] * b[k] + p[k + 1] or scale
            self.up[k] = a[k] * b[k] / pivot
            p[k] = p[k + 1] * (a[k] * a[k] / pivot) - value
        self.order = np.argsort(np.abs(s + p + value), kind="stable")

    def vector(self, twist: int) -> np.ndarray:
        z = np.zeros(len(self.down) + 1)
        z[twist] = 1.0
        for k in range(twist - 1, -1, -1):
            z[k] = -self.down[k] * z[k + 1]
        for k in range(twist, len(z) - 1):
            z[k + 1] = -self.up[k] * z[k]
        return z / np.sqrt(z @ z)


def _parts(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Stretches between superdiagonal entries that are nothing beside the matrix."""
    largest = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    cuts = (np.flatnonzero(np.abs(b) <= EPS * largest) + 1).tolist()
    edges = [0, *cuts, len(a)]
    return list(zip(edges, edges[1:]))


def largest(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(squares, vectors): squares of the ``count`` largest singular values, falling, and unit right vectors as rows."""
    scale = float(np.abs(matrix).max(initial=0))
    d = len(matrix)
    count = min(count, d)
    if scale == 0:
        return np.zeros(count), np.eye(d)[:count]
    a, b, rights = bidiagonalise(matrix / scale)
    named = [(value, lo, hi) for lo, hi in _parts(a, b) for value in squares(a[lo:hi], b[lo:hi - 1])]
    named = sorted(named, key=lambda x: -x[0])[:count]
    vectors = []
    for i, (value, lo, hi) in enumerate(named):
        if hi - lo == 1:
            vectors.append(np.eye(d)[lo])
            continue
        near = [vectors[j] for j in range(i) if named[j][1] == lo and named[j][0] - value <= _CLOSE * named[j][0]]
        twist, best, kept = _Twist(a[lo:hi], b[lo:hi - 1], value), None, 0.0
        for at in twist.order[:_TWISTS]:
            z = np.zeros(d)
            z[lo:hi] = twist.vector(int(at))
            left = 1.0
            for _ in range(2 if near else 0):
                for other in near:
                    z -= (z @ other) * other
                norm = float(np.sqrt(z @ z))
                left *= norm
                z = z / norm if norm > 0 else z
            if best is None or left > kept:
                best, kept = z, left
            if kept > 0.5:
                break
        vectors.append(best)
    out = np.array(vectors)
    for v, beta in reversed(rights):
        k = d - len(v)
        out[:, k:] -= beta * np.outer(out[:, k:] @ v, v)
    return np.array([value for value, _, _ in named]) * scale * scale, out
