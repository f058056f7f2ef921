"""Arithmetic in the prime field of 2**61 - 1: arrays by numpy, polynomials by Python integers."""

from __future__ import annotations

import random

import numpy as np

P = (1 << 61) - 1
_LOW = np.uint64((1 << 31) - 1)
_MOD = np.uint64(P)


def mul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b mod P for uint64 arrays below P."""
    ah, al = a >> np.uint64(31), a & _LOW
    bh, bl = b >> np.uint64(31), b & _LOW
    mid = ah * bl + al * bh  # below 2**62
    # ah * bh * 2**62 = ah * bh * 2 and mid * 2**31 = (mid >> 30) + (mid & (2**30 - 1)) * 2**31, mod P
    total = (ah * bh << np.uint64(1)) + (mid >> np.uint64(30)) + ((mid & np.uint64((1 << 30) - 1)) << np.uint64(31)) + al * bl
    total = (total & _MOD) + (total >> np.uint64(61))
    return np.where(total >= _MOD, total - _MOD, total)


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(a >= b, a - b, a + _MOD - b)


def trimmed(f: list[int]) -> list[int]:
    while f and f[-1] == 0:
        f.pop()
    return f


def value(f: list[int], x: int) -> int:
    y = 0
    for c in reversed(f):
        y = (y * x + c) % P
    return y


def times(f: list[int], g: list[int]) -> list[int]:
    if not f or not g:
        return []
    out = [0] * (len(f) + len(g) - 1)
    for i, a in enumerate(f):
        if a:
            for j, b in enumerate(g):
                out[i + j] += a * b
    return trimmed([c % P for c in out])


def divided(f: list[int], g: list[int]) -> tuple[list[int], list[int]]:
    """Quotient and remainder; coefficients from the lowest."""
    rest, inverse = list(f), pow(g[-1], -1, P)
    quotient = [0] * max(0, len(f) - len(g) + 1)
    for i in range(len(rest) - len(g), -1, -1):
        q = rest[i + len(g) - 1] * inverse % P
        quotient[i] = q
        if q:
            for j, b in enumerate(g):
                rest[i + j] = (rest[i + j] - q * b) % P
    return trimmed(quotient), trimmed(rest[: len(g) - 1] if len(f) >= len(g) else rest)


def monic(f: list[int]) -> list[int]:
    inverse = pow(f[-1], -1, P)
    return [c * inverse % P for c in f]


def common(f: list[int], g: list[int]) -> list[int]:
    while g:
        f, g = g, divided(f, g)[1]
    return monic(f)


def roots(f: list[int]) -> list[int] | None:
    """The roots of a monic polynomial that is a product of distinct linear factors; None if it isn't.

    Degrees one and two have formulas (P is 3 mod 4, so a square root is one power); higher degrees are split by common
    factors with (x + r)**((P - 1) / 2) - 1 for random r, which hold about half of the roots.
    """
    found: list[int] = []
    rng, todo, left = random.Random(len(f)), [f], 64
    while todo:
        g = todo.pop()
        if len(g) == 2:
            found.append(-g[0] % P)
        elif len(g) == 3:
            square = (g[1] * g[1] - 4 * g[0]) % P
            root = pow(square, (P + 1) // 4, P)
            if not root or root * root % P != square:
                return None
            found += [(s - g[1]) * ((P + 1) // 2) % P for s in (root, -root)]
        elif len(g) > 3:
            left -= 1
            if left < 0:
                return None  # a factor that can't be split isn't linear
            h = _half_power(rng.randrange(P), g)
            h[0] = (h[0] - 1) % P
            part = common(g, trimmed(h))
            split = 1 < len(part) < len(g)
            todo += [part, monic(divided(g, part)[0])] if split else [g]
    return found if len(set(found)) == len(found) and all(value(f, x) == 0 for x in found) else None


def _half_power(r: int, mod: list[int]) -> list[int]:
    """(x + r)**((P - 1) / 2) modulo a monic polynomial of degree n > 1. The exponent is 2**60 - 1: powers of 2**k - 1 are
    put together from smaller k."""
    n = len(mod) - 1
    folds, row = [], [-c % P for c in mod[:n]]  # x**n, x**(n + 1), ... modulo mod
    for _ in range(n - 1):
        folds.append(row)
        row = [(a - row[-1] * m) % P for a, m in zip([0, *row[:-1]], mod, strict=False)]

    def product(f: list[int], g: list[int]) -> list[int]:
        whole = [0] * (2 * n - 1)
        for i, a in enumerate(f):
            for j, b in enumerate(g):
                whole[i + j] += a * b
        low = whole[:n]
        for c, fold in zip(whole[n:], folds, strict=True):
            c %= P
            for i, x in enumerate(fold):
                low[i] += c * x
        return [x % P for x in low]

    base = [r, 1] + [0] * (n - 2)
    out, k = base, 1
    for bit in bin(60)[3:]:
        other = out
        for _ in range(k):
            other = product(other, other)
        out, k = product(other, out), 2 * k
        if bit == "1":
            out, k = product(product(out, out), base), k + 1
    return out


def solved(rows: list[list[int]]) -> list[int] | None:
    """A solution of the linear system whose rows are [coefficients..., right side]; free unknowns are 0. None: none."""
    m, n = [list(r) for r in rows], len(rows[0]) - 1
    at, pivots = 0, []
    for c in range(n):
        k = next((i for i in range(at, len(m)) if m[i][c]), None)
        if k is None:
            continue
        m[at], m[k] = m[k], m[at]
        inverse = pow(m[at][c], -1, P)
        m[at] = top = [x * inverse % P for x in m[at]]
        for i in range(len(m)):
            if i != at and (q := m[i][c]):
                m[i] = [(x - q * y) % P for x, y in zip(m[i], top, strict=True)]
        pivots.append(c)
        at += 1
    if any(r[n] for r in m[at:]):
        return None
    out = [0] * n
    for i, c in enumerate(pivots):
        out[c] = m[i][n]
    return out
