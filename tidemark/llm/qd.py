"""Singular values and right singular vectors of a small matrix by bidiagonal quotient-difference methods.

Householder reflections make the matrix bidiagonal, dqds finds its squared singular values to high relative accuracy,
and a twisted factorisation of the shifted tridiagonal gives each vector. Vectors of values that lie close together
take different twists and are made orthogonal, with steps of inverse iteration between.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Relative distance under which neighbours count as a cluster.
CLOSE = 1e-3


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta such that x - beta * v * (v . x) is zero but for its first entry."""
    scale = np.abs(x).max(initial=0.0)
    if scale == 0:
        return x, 0.0
    v = x / scale
    v[0] += np.copysign(np.sqrt(v @ v), v[0])
    return v, 2.0 / (v @ v)


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a and superdiagonal b of B, and orthogonal p with matrix = u B p.T; for a square matrix."""
    m, n = matrix.astype(float).copy(), len(matrix)
    p = np.eye(n)
    for k in range(n):
        v, beta = _reflector(m[k:, k].copy())
        m[k:, k:] -= beta * np.outer(v, v @ m[k:, k:])
        if k < n - 1:
            v, beta = _reflector(m[k, k + 1 :].copy())
            m[k:, k + 1 :] -= beta * np.outer(m[k:, k + 1 :] @ v, v)
            p[:, k + 1 :] -= beta * np.outer(p[:, k + 1 :] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), p


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One dqds transform, and the least d of it; a negative one means that the shift was too large."""
    d, least = q[0] - shift, q[0] - shift
    new_q, new_e = [], []
    for k in range(len(e)):
        if d < 0:
            return q, e, d
        top = d + e[k]
        ratio = q[k + 1] / top if top > 0 else 0.0
        new_q.append(top)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift if top > 0 else q[k + 1] - shift
        least = min(least, d)
    new_q.append(d)
    return new_q, new_e, least


def _last(q: list[float], e: list[float]) -> float:
    """A guess of the smallest eigenvalue from the last two rows."""
    a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), q[-2] * e[-1], q[-1] + e[-1]
    half = (a - c) / 2
    return c - b / (abs(half) + np.sqrt(half * half + b)) if half > 0 and b > 0 else c - np.sqrt(b) if b > 0 else min(a, c)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal matrix, falling."""
    found: list[float] = []
    parts = [((a * a).tolist(), (b * b).tolist(), 0.0)]
    while parts:
        q, e, total = parts.pop()
        if len(q) > 1 and q[0] * 1.5 < q[-1]:
            q, e = q[::-1], e[::-1]  # the same values, with the small ones last
        guess = 0.0
        while len(q) > 1:
            tiny = [e[k] <= (10 * EPS) ** 2 * (total + min(q[k], q[k + 1])) for k in range(len(e))]
            if any(tiny):
                k = len(e) - 1 - tiny[::-1].index(True)
                parts.append((q[: k + 1], e[:k], total))
                q, e, guess = q[k + 1 :], e[k + 1 :], 0.0
                continue
            shift = max(min(guess, _last(q, e)), 0.0)
            while True:
                new_q, new_e, least = _sweep(q, e, shift)
                if least >= 0 or shift == 0:
                    break
                # a failure at the end tells how much too large the shift was
                shift = max(shift + least, 0.0) * (1 - 8 * EPS) if least > -shift / 2 else shift / 4 if shift > EPS * (total + q[-1]) else 0.0
            q, e, total = new_q, new_e, total + shift
            guess = max(least, 0.0)
        found.append(q[0] + total)
    return np.sort(np.array(found))[::-1]


class Twisted:
    """Twisted factorisations of B.T B - shift, with B.T B = L D L.T and the given pivots."""

    def __init__(self, d: np.ndarray, low: np.ndarray, shift: float):
        n, least = len(d), EPS * EPS * max(float(d.max()), shift)
        self.down, self.up = np.zeros(n), np.zeros(n)  # multipliers from above and from below
        self.gamma = np.zeros(n)
        s, p = np.zeros(n), np.zeros(n)
        s[0] = -shift
        for i in range(n - 1):
            pivot = d[i] + s[i]
            pivot = pivot if abs(pivot) > least else least
            self.down[i] = d[i] * low[i] / pivot
            s[i + 1] = self.down[i] * low[i] * s[i] - shift
        p[n - 1] = d[n - 1] - shift
        for i in range(n - 2, -1, -1):
            pivot = d[i] * low[i] ** 2 + p[i + 1]
            pivot = pivot if abs(pivot) > least else least
            self.up[i] = low[i] * d[i] / pivot
            p[i] = p[i + 1] * d[i] / pivot - shift
        self.gamma = s + p + shift
        self.d, self.low, self.s, self.p, self.least = d, low, s, p, least

    def vector(self, twist: int) -> np.ndarray:
        z = np.zeros(len(self.d))
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -self.down[i] * z[i + 1]
        for i in range(twist, len(z) - 1):
            z[i + 1] = -self.up[i] * z[i]
        return z / np.sqrt(z @ z)

    def solve(self, right: np.ndarray, twist: int) -> np.ndarray:
        """x with (B.T B - shift) x = right, up to its length."""
        y, n = right.copy(), len(right)
        for i in range(twist):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(n - 2, twist - 1, -1):
            y[i] -= self.up[i] * y[i + 1]
        pivots = np.concatenate(((self.d + self.s)[:twist], self.gamma[twist : twist + 1], self.d[twist:-1] * self.low[twist:] ** 2 + self.p[twist + 1 :]))
        small = np.abs(pivots) <= self.least
        x = y / np.where(small, self.least, pivots)
        x /= np.abs(x).max()
        for i in range(twist - 1, -1, -1):
            x[i] -= self.down[i] * x[i + 1]
        for i in range(twist, n - 1):
            x[i + 1] -= self.up[i] * x[i]
        return x / np.sqrt(x @ x)


def _apart(z: np.ndarray, others: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """z of length one made orthogonal to the others, and how much of it was left."""
    left = z
    for _ in range(2):
        for other in others:
            left = left - (other @ left) * other
    size = float(np.sqrt(left @ left))
    return left / size if size > 0 else left, size


def right_vectors(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of a square matrix, falling, and its first right singular vectors as columns."""
    scale = np.abs(matrix).max(initial=0.0)
    if scale == 0:
        return np.zeros(len(matrix)), np.zeros((len(matrix), 0))
    a, b, p = bidiagonal(matrix / scale)
    norm = np.sqrt((a * a).sum() + (b * b).sum())
    a = np.where(np.abs(a) < 1e-20 * norm, 1e-20 * norm, a)  # far under what the matrix can tell
    b = np.where(np.abs(b) < 1e-20 * norm, 0.0, b)
    values = squares(a, b)
    count = min(count, int((values > (len(values) * EPS * norm) ** 2).sum()))
    out: list[np.ndarray] = []
    cluster: list[np.ndarray] = []
    used: set[int] = set()
    for i in range(count):
        if i and values[i - 1] - values[i] > CLOSE * values[i - 1]:
            cluster, used = [], set()
        own = Twisted(a * a, b / a[:-1], float(values[i]))
        best = (-1.0, 0, None)
        for twist in [int(t) for t in np.argsort(np.abs(own.gamma), kind="stable") if t not in used]:
            z, left = _apart(own.vector(twist), cluster)
            if left > best[0] and np.isfinite(left):
                best = (left, twist, z)
            if left > 0.5:
                break
        _, twist, z = best
        if cluster:
            used.add(twist)
            for _ in range(2):
                again, left = _apart(own.solve(z, twist), cluster)
                if not np.isfinite(left) or left < 0.1:
                    break
                z = again
        else:
            used = {twist}
        cluster.append(z)
        out.append(z)
    return values * scale * scale, p @ np.array(out).reshape(count, -1).T
