import math

import numpy as np
import pytest

from knotwork.llm import stirling


def exact(c, d):
    """S(c, 1) to S(c, c) by the recursion, with whole and floating numbers."""
    row = [1.0]
    for n in range(1, c):
        row = [(row[k - 1] if k else 0.0) + ((n - (k + 1) * d) * row[k] if k < len(row) else 0.0) for k in range(n + 1)]
    return row


@pytest.mark.parametrize("d", [0.2, 0.5, 0.8, 0.93])
def test_numbers(d):
    s = stirling.Stirling(d)
    want = exact(60, d)
    assert np.allclose(s.log(np.full(60, 60), np.arange(1, 61)), np.log(want), atol=1e-8)
    # beyond the exact ones: against the recursion carried on in logarithms
    row, n, most = s.table[stirling.EXACT].copy(), stirling.EXACT, 3000
    row = np.concatenate((row, np.full(most - n, -np.inf)))
    t = np.arange(most + 1)
    with np.errstate(all="ignore"):
        for c in range(n, most):
            row = np.logaddexp(np.where(t * d < c, np.log(np.maximum(c - t * d, 1e-300)), -np.inf) + row, np.concatenate(([-np.inf], row[:-1])))
    at = np.asarray([1, 2, 5, 10, 30, 100, 300, 700, 1200, 2000, 2700])
    assert np.abs(s.log(np.full(len(at), most), at) - row[at]).max() < 0.12


def test_log_gamma():
    x = np.asarray([0.01, 0.5, 1, 3.3, 20, 1e5])
    assert np.allclose(stirling.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-9)  # the series ends at 3e-10


@pytest.mark.parametrize(("c", "room", "chance"), [(2, 1.5, 0.01), (20, 3.0, 0.2), (200, 40.0, 0.05), (1024, 2.0, 0.5), (1500, 30.0, 0.3)])
def test_draws_follow_the_conditional(c, room, chance):
    d, n = 0.7, 4000
    s = stirling.Stirling(d)
    u = (np.arange(n) + 0.5) / n
    got = stirling.drawn(s, np.full(n, c), np.full(n, room), np.full(n, chance), u)
    t = np.arange(1, c + 1)
    w = s.log(np.full(c, c), t) + t * math.log(chance) + np.cumsum(np.log(room + d * np.arange(c)))
    p = np.exp(w - w.max())
    p /= p.sum()
    mean = float((p * t).sum())
    spread = math.sqrt(float((p * t * t).sum()) - mean * mean)
    assert abs(got.mean() - mean) < 0.02 * spread + 1e-3 * mean and abs(got.std() - spread) < 0.05 * spread + 0.01
    assert got.min() >= 1 and got.max() <= c


def test_no_customers_one_customer_and_very_many():
    s = stirling.Stirling(0.8)
    got = stirling.drawn(s, np.asarray([0, 1, 10**9, 10**9]), np.full(4, 5.0), np.asarray([0.1, 0.1, 1e-6, 0.3]), np.full(4, 0.5))
    assert got[0] == 0 and got[1] == 1 and 1 <= got[2] < got[3] < 10**9
