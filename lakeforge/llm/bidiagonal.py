"""Right singular vectors of a small triangular matrix, to high relative accuracy.

Householder reflections make the matrix upper bidiagonal; dqds (differential
quotient-difference with shifts) finds the squared singular values; twisted
factorisations of the shifted tridiagonal give a vector for each. Everything is
of the size of the vectors' dimension, whatever the number of rows was.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Neighbouring values closer than this, relative, are made orthogonal together.
NEAR = 1e-3


def householder(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta with (I - beta v v') x along the first axis."""
    v = x.astype(float).copy()
    scale = np.abs(v).max(initial=0.0)
    if scale == 0 or not np.abs(v[1:]).max(initial=0.0):
        return v, 0.0
    v /= scale
    v[0] += np.copysign(np.sqrt(v @ v), v[0])
    return v, 2.0 / (v @ v)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and orthogonal p with r = u B p' for some
    orthogonal u."""
    m = np.array(r, dtype=float)
    d = m.shape[1]
    p = np.eye(d)
    for k in range(d):
        v, beta = householder(m[k:, k])
        m[k:, k:] -= beta * np.outer(v, v @ m[k:, k:])
        if k + 2 < d:
            v, beta = householder(m[k, k + 1:])
            m[k:, k + 1:] -= beta * np.outer(m[k:, k + 1:] @ v, v)
            p[:, k + 1:] -= beta * np.outer(p[:, k + 1:] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), p


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One transform of (q, e); the third list holds the d of each position."""
    new_q, new_e, at = [], [], []
    d = q[0] - shift
    for i in range(len(e)):
        at.append(d)
        total = d + e[i]
        ratio = q[i + 1] / total
        new_q.append(total)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    at.append(d)
    new_q.append(d)
    return new_q, new_e, at


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal matrix, falling.

    Transforms without a shift give the d of each position, and the sum of their
    reciprocals is the trace of the inverse. Its reciprocal is a lower bound of
    the smallest value, so it is a shift that keeps all quantities positive."""
    q, e = list(map(float, a * a)), list(map(float, b * b))
    moved, found, steps = 0.0, [], 0
    tiny = (EPS * EPS) * (max(q) + (max(e) if e else 0.0))
    while q:
        n, steps = len(q), steps + 1
        if steps > 100 * len(a) + 1000:
            raise ArithmeticError("dqds did not converge; are there values that aren't finite?")
        if n == 1:
            found.append(q.pop() + moved)
            continue
        if e[-1] <= (10 * EPS) ** 2 * (moved + q[-1]) or e[-1] <= tiny * EPS:
            found.append(q.pop() + moved)
            e.pop()
            continue
        # only the part below the last negligible coupling takes part
        low = next((i + 1 for i in range(n - 2, -1, -1) if e[i] <= (EPS * EPS) * (moved + min(q[i], q[i + 1]))), 0)
        q_part, e_part, at = _dqds_step(q[low:], e[low:], 0.0)
        bound = 1.0 / sum(1.0 / x for x in at) if min(at) > 0 else 0.0
        shift = bound * (1 - 4 * n * EPS)
        if shift > EPS * moved and shift > 0:
            tried = _dqds_step(q_part, e_part, shift)
            if min(tried[2]) >= 0 and min(tried[0][:-1]) > 0:
                if low:  # a shift holds for a whole matrix: finish this part by itself
                    found += [x + moved for x in dqds(np.sqrt(q_part), np.sqrt(e_part))]
                    del q[low:], e[low - 1:]
                    continue
                q_part, e_part, moved = tried[0], tried[1], moved + shift
        q[low:], e[low:] = q_part, e_part
    return np.sort(np.asarray(found))[::-1]


def _twisted(diagonal: np.ndarray, lower: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of L D L' - value: the factors from the top and from the bottom, and the
    gammas, one for each place of the twist."""
    n = len(diagonal)
    floor = EPS * EPS * (np.abs(diagonal).max() + abs(value))
    s, top = np.empty(n), np.zeros(max(n - 1, 0))
    s[0] = -value
    for i in range(n - 1):
        s[i + 1] = -value
        if lower[i]:
            pivot = s[i] + diagonal[i]
            pivot = pivot if abs(pivot) > floor else floor
            top[i] = diagonal[i] * lower[i] / pivot
            s[i + 1] += top[i] * lower[i] * (pivot - diagonal[i])
    p, bottom = np.empty(n), np.zeros(max(n - 1, 0))
    p[-1] = diagonal[-1] - value
    for i in range(n - 2, -1, -1):
        p[i] = diagonal[i] - value
        if lower[i]:
            square = diagonal[i] * lower[i] ** 2
            pivot = square + p[i + 1]
            pivot = pivot if abs(pivot) > floor else floor
            ratio = diagonal[i] / pivot
            bottom[i] = lower[i] * ratio
            p[i] = (pivot - square) * ratio - value
    return top, bottom, s + p + value


def _from_twist(top: np.ndarray, bottom: np.ndarray, k: int) -> np.ndarray:
    z = np.zeros(len(top) + 1)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -top[i] * z[i + 1]
    for i in range(k, len(bottom)):
        z[i + 1] = -bottom[i] * z[i]
    big = np.abs(z).max()
    z /= big
    return z / np.linalg.norm(z)


def _vector(diagonal: np.ndarray, lower: np.ndarray, value: float, taken: list[np.ndarray]) -> np.ndarray:
    """A unit vector for ``value``, orthogonal to those ``taken``: the twist with
    the smallest gamma, or the next ones where that vector is already taken."""
    top, bottom, gamma = _twisted(diagonal, lower, value)
    best, size = None, -1.0
    for k in np.argsort(np.abs(gamma), kind="stable"):
        z = _from_twist(top, bottom, int(k))
        left = z
        for _ in range(2):
            for x in taken:
                left = left - (x @ left) * x
        norm = float(np.linalg.norm(left))
        if norm > size:
            best, size = left, norm
        if norm > 0.1:
            break
    best = best / np.linalg.norm(best)
    for x in taken:
        best = best - (x @ best) * x
    return best / np.linalg.norm(best)


def _rotate(columns: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-sided rotations until the columns' images are orthogonal."""
    m = columns.shape[1]
    for _ in range(30):
        worst = 0.0
        for i in range(m):
            for j in range(i + 1, m):
                x, y, z = image[:, i] @ image[:, i], image[:, j] @ image[:, j], image[:, i] @ image[:, j]
                if x == 0 or y == 0 or abs(z) <= EPS * np.sqrt(x * y):
                    continue
                worst = max(worst, abs(z) / np.sqrt(x * y))
                t = (y - x) / (2 * z)
                t = np.copysign(1.0, t) / (abs(t) + np.hypot(1.0, t))
                c = 1 / np.hypot(1.0, t)
                turn = np.array([[c, c * t], [-c * t, c]])
                columns[:, [i, j]] = columns[:, [i, j]] @ turn
                image[:, [i, j]] = image[:, [i, j]] @ turn
        if worst < 1e-15:
            break
    return columns, image


def right_vectors(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest squared singular values of an upper triangular (or
    shorter) matrix, falling, and their unit right vectors as columns. The sign
    makes the entry of largest size (the first of equal ones) positive."""
    r = np.vstack((r, np.zeros((max(0, r.shape[1] - r.shape[0]), r.shape[1]))))[:r.shape[1]]
    a, b, p = bidiagonalise(r)
    scale = np.sqrt(np.abs(a).max(initial=0.0) ** 2 + np.abs(b).max(initial=0.0) ** 2)
    if scale == 0:
        return np.zeros(min(most, len(a))), np.eye(len(a))[:, :most]
    a = np.where(np.abs(a) < 0.01 * EPS * scale, 0.01 * EPS * scale, a)  # below rounding of the matrix
    b = np.where(np.abs(b) <= EPS * np.sqrt(np.abs(a[:-1] * a[1:])), 0.0, b)
    values = dqds(a, b)
    diagonal, lower = a * a, b / a[:-1]
    band = np.diag(a) + np.diag(b, 1)
    noise = (len(a) * 16 * EPS) ** 2 * values[0]  # values that are zero but for rounding
    near = lambda k: values[k - 1] - values[k] <= max(NEAR * values[k - 1], noise)
    last = min(most, len(values))
    while last < len(values) and near(last):
        last += 1  # the rest of the last group of near values
    vectors = np.empty((len(a), last))
    start = 0
    while start < last:
        end = start + 1
        while end < last and near(end):
            end += 1
        group: list[np.ndarray] = []
        for k in range(start, end):
            group.append(_vector(diagonal, lower, values[k], group))
        columns = np.stack(group, axis=1)
        if end - start > 1:
            columns, image = _rotate(columns, band @ columns)
            columns = columns[:, np.argsort(-(image * image).sum(axis=0), kind="stable")]
        vectors[:, start:end] = columns
        start = end
    out = p @ vectors[:, :min(most, len(values))]
    out /= np.linalg.norm(out, axis=0)
    out *= np.where(out[np.abs(out).argmax(axis=0), np.arange(out.shape[1])] < 0, -1.0, 1.0)
    return values[:min(most, len(values))], out
