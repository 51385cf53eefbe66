"""Generalised Stirling numbers, and draws of how many tables a dish's customers sit at."""

from __future__ import annotations

import math

import numpy as np

#: Customers up to which the numbers come from their recursion.
EXACT = 1024
#: Points of the grid on which a draw for more customers is made.
GRID = 129


def log_gamma(x: np.ndarray) -> np.ndarray:
    """The logarithm of the gamma function of positive numbers."""
    x = np.asarray(x, float)
    low = np.zeros_like(x)
    for i in range(8):
        low += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y - low


class Stirling:
    """log S(c, t): the weight of c customers at t tables under a discount d, summed over all seatings.

    S(c + 1, t) = S(c, t - 1) + (c - t d) S(c, t), S(1, 1) = 1. Beyond EXACT customers two expansions
    take over: few tables follow S(c, t) = Gamma(c - d) / Gamma(t) d^(1 - t) g(t / c^d), with g read off
    the last exact row; for many tables the saddle point of c! / (t! d^t) [x^c] (1 - (1 - x)^d)^t is used.
    They change over where the saddle point is within 0.03 of the last exact row. Errors are a few hundredths.
    """

    def __init__(self, d: float) -> None:
        self.d = d
        n = EXACT
        t = np.arange(n + 1)
        self.table = np.full((n + 1, n + 1), -np.inf)
        self.table[1, 1] = 0.0
        with np.errstate(all="ignore"):
            for c in range(1, n):
                grow = np.where(t * d < c, np.log(np.maximum(c - t * d, 1e-300)), -np.inf) + self.table[c]
                self.table[c + 1] = np.logaddexp(grow, np.concatenate(([-np.inf], self.table[c][:-1])))
        tables = np.arange(1, n + 1)
        self.log_z = np.log(tables) - d * math.log(n)
        self.g = self.table[n, 1:] - math.lgamma(n - d) + log_gamma(tables) + (tables - 1) * math.log(d)
        off = np.abs(self.saddle(np.full(n - 4, float(n)), tables[:-4].astype(float)) - self.table[n, 1:-4]) > 0.03
        self.change = float(np.flatnonzero(off)[-1] + 2) if off.any() else 0.0

    def saddle(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        d = self.d
        low, high = np.full(t.shape, -60.0), np.full(t.shape, 60.0)  # of the logit of x
        for _ in range(50):
            z = (low + high) / 2
            rest, x = -np.logaddexp(0, z), -np.logaddexp(0, -z)  # log(1 - x), log x
            under = t * d * np.exp((d - 1) * rest + x) / -np.expm1(d * rest) < c
            low, high = np.where(under, z, low), np.where(under, high, z)
        g = -np.expm1(d * rest)
        h = d * np.exp((d - 1) * rest) / g
        curve = t * np.exp(x) * (h + np.exp(x) * h * ((1 - d) * np.exp(-rest) - h))
        return log_gamma(c + 1) - log_gamma(t + 1) + t * np.log(g / d) - c * x - 0.5 * np.log(2 * np.pi * np.maximum(curve, 1e-300))

    def log(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        c, t = np.broadcast_arrays(np.asarray(c, np.int64), np.asarray(t, np.int64))
        out = np.empty(c.shape)
        exact = c <= EXACT
        out[exact] = self.table[c[exact], np.minimum(t[exact], EXACT)]
        few = ~exact & (t * (EXACT / np.maximum(c, 1)) ** self.d <= self.change)
        many = ~exact & ~few
        if few.any():
            a, b = c[few].astype(float), t[few].astype(float)
            out[few] = log_gamma(a - self.d) - log_gamma(b) - (b - 1) * math.log(self.d) + np.interp(np.log(b) - self.d * np.log(a), self.log_z, self.g)
        if many.any():
            out[many] = self.saddle(c[many].astype(float), t[many].astype(float))
        return out


def drawn(numbers: Stirling, counts: np.ndarray, room: np.ndarray, chance: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Tables of each dish, by its conditional: t of 1 to count with weight S(count, t) chance^t prod(room + d i for i < t).

    room: strength + d * tables of the restaurant's other dishes. chance: of the dish in the parent
    restaurant, without this dish's own tables. u: uniform numbers, which decide the draws.
    """
    out = np.minimum(counts, 1)
    many = np.flatnonzero(counts > 1)
    order = many[np.argsort(counts[many], kind="stable")]
    at, starts = np.unique(counts[order], return_index=True)
    for c, i, j in zip(at.tolist(), starts.tolist(), [*starts.tolist(), len(order)][1:], strict=True):
        if c > EXACT:
            out[order[i:]] = _of_many(numbers, counts[order[i:]], room[order[i:]], chance[order[i:]], u[order[i:]])
            break
        for k in range(i, j, max(1, 1_000_000 // c)):
            some = order[k : min(j, k + max(1, 1_000_000 // c))]
            w = np.log(room[some, None] + numbers.d * np.arange(c))
            np.cumsum(w, axis=1, out=w)
            w += numbers.table[c, 1 : c + 1] + np.log(chance[some, None]) * np.arange(1, c + 1)
            w = np.cumsum(np.exp(w - w.max(axis=1, keepdims=True)), axis=1)
            out[some] = 1 + (w < u[some, None] * w[:, -1:]).sum(axis=1)
    return np.minimum(out, counts)


def _of_many(numbers: Stirling, counts: np.ndarray, room: np.ndarray, chance: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The same on a grid of eight standard deviations around the mode."""
    d = numbers.d
    weight = lambda t: numbers.log(counts if t.ndim == 1 else counts[:, None], t) + (log_gamma(t + (room / d if t.ndim == 1 else (room / d)[:, None])) + t * np.log(d * chance if t.ndim == 1 else (d * chance)[:, None]))
    low, high = np.ones(len(counts), np.int64), counts.copy()
    while (high > low).any():  # the weight rises up to the mode
        mid = (low + high) // 2
        rises = weight(np.minimum(mid + 1, counts)) > weight(mid)
        low, high = np.where(rises & (high > low), mid + 1, low), np.where(rises, high, mid)
    step = np.maximum(1, np.sqrt(low).astype(np.int64) // 4)
    around = weight(np.clip(low - step, 1, counts)), weight(low), weight(np.clip(low + step, 1, counts))
    bend = np.maximum(2 * around[1] - around[0] - around[2], 1e-12) / step.astype(float) ** 2
    stride = np.maximum(1, np.ceil(16 / np.sqrt(bend) / GRID)).astype(np.int64)
    grid = low[:, None] + stride[:, None] * (np.arange(GRID) - GRID // 2)
    w = np.where((grid >= 1) & (grid <= counts[:, None]), weight(np.clip(grid, 1, counts[:, None])), -np.inf)
    w = np.exp(w - w.max(axis=1, keepdims=True))
    total = np.cumsum(w, axis=1)
    goal = u * total[:, -1]
    cell = np.minimum((total < goal[:, None]).sum(axis=1), GRID - 1)
    rows = np.arange(len(counts))
    share = np.clip((goal - (total[rows, cell] - w[rows, cell])) / np.maximum(w[rows, cell], 1e-300), 0, 1 - 1e-9)
    return np.clip(grid[rows, cell] - stride // 2 + (share * stride).astype(np.int64), 1, counts)
