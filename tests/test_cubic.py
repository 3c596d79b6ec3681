"""W10 spline fills: blocks with a halo against a dense numpy solve over the whole
series, and against an independent B-spline."""

import datetime as dt
import random

import numpy as np
import pytest

from skyframe.operators import cubic as CU
from skyframe.operators import gaps as GP

BASE = dt.datetime(2024, 1, 1)


def dense_slopes(x, y):
    n = len(x)
    if n == 2:
        m = (y[1] - y[0]) / (x[1] - x[0])
        return np.array([m, m])
    if n == 3:
        return CU.cubic_slopes(np.array(x), np.array(y))
    A = np.zeros((n, n))
    b = np.zeros(n)
    dx = np.diff(x)
    m = np.diff(y) / dx
    for i in range(1, n - 1):
        A[i, i - 1], A[i, i], A[i, i + 1] = dx[i], 2 * (dx[i - 1] + dx[i]), dx[i - 1]
        b[i] = 3 * (dx[i] * m[i - 1] + dx[i - 1] * m[i])
    d = x[2] - x[0]
    A[0, 0], A[0, 1] = dx[1], d
    b[0] = ((dx[0] + 2 * d) * dx[1] * m[0] + dx[0] ** 2 * m[1]) / d
    d = x[-1] - x[-3]
    A[-1, -2], A[-1, -1] = d, dx[-2]
    b[-1] = (dx[-1] ** 2 * m[-2] + (2 * d + dx[-1]) * dx[-2] * m[-1]) / d
    return np.linalg.solve(A, b)


def herm(x, y, s, q):
    k = np.searchsorted(x, q) - 1
    h = x[k + 1] - x[k]
    t = (q - x[k]) / h
    return ((2 * t**3 - 3 * t**2 + 1) * y[k] + (t**3 - 2 * t**2 + t) * h * s[k]
            + (-2 * t**3 + 3 * t**2) * y[k + 1] + (t**3 - t**2) * h * s[k + 1])


def holed(n, seed, spread=4):
    """A series of n samples at random hours, with every hour between them as a hole."""
    rnd = random.Random(seed)
    hours = sorted(rnd.sample(range(spread * n), n))
    vals = [rnd.uniform(-3, 3) for _ in hours]
    have = dict(zip(hours, vals))
    rows = [(1, BASE + dt.timedelta(hours=h), have.get(h)) for h in range(hours[0], hours[-1] + 1)]
    return hours, vals, rows


@pytest.mark.parametrize("n,block", [(60, 4096), (700, 66), (900, 300), (5, 128), (4, 128), (3, 128), (2, 128)])
def test_cubic_matches_dense(spark, n, block):
    hours, vals, rows = holed(n, n + block)
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double")
    x = np.array([3600.0 * h for h in hours])
    exp = dense_slopes(x, np.array(vals))
    filled = CU.fill_max_gap_cubic(df, ["k"], "ts", ["v"], 10 ** 6, block=block).orderBy("ts").collect()
    assert len(filled) == len(rows)
    for r, (_, ts, v) in zip(filled, rows):
        assert r.ts == ts
        assert r.v == v if v is not None else abs(r.v - herm(x, np.array(vals), exp, (ts - BASE).total_seconds())) < 1e-9


def test_cubic_fills_only_short_gaps_of_every_variable(spark):
    hours, vals, rows = holed(200, 3)
    data = [(k, t, v, None if v is None or i % 5 else v + i, "x") for k in (1, 2) for i, (_, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, ts timestamp_ntz, v double, w double, `a.b` string")
    both = GP.fill_max_gap(df.drop("a.b"), ["k"], "ts", ["v", "w"], 2, "cubic").orderBy("k", "ts").collect()
    for c in ("v", "w"):
        one = GP.fill_max_gap(df.select("k", "ts", c), ["k"], "ts", [c], 2, "cubic").orderBy("k", "ts").collect()
        assert [r[c] for r in both] == [r[c] for r in one]
        given = [r[c] for r in df.orderBy("k", "ts").collect()]
        for i, (g, r) in enumerate(zip(given, both)):
            lo, hi = i, i
            while lo >= 0 and given[lo] is None:
                lo -= 1
            while hi < len(given) and given[hi] is None:
                hi += 1
            if g is None and (lo < 0 or hi >= len(given) or hi - lo - 1 > 2 or data[lo][0] != data[hi][0]):
                assert r[c] is None
            else:
                assert r[c] is not None


def test_tridiagonal_reduction():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 8, 100, 1153):
        lo, up, rhs = rng.normal(size=(3, n))
        di = 3 + abs(lo) + abs(up)
        A = np.diag(di) + (np.diag(lo[1:], -1) + np.diag(up[:-1], 1) if n > 1 else 0)
        assert np.allclose(CU.solve_tridiagonal(lo, di, up, rhs), np.linalg.solve(A, rhs), atol=1e-12)


def test_cubic_on_polynomial_is_exact(spark):
    """A not-a-knot spline reproduces a cubic polynomial exactly."""
    f = lambda t: 0.5 * t**3 - 2 * t**2 + t - 1
    hours = [0, 1, 3, 4, 5, 8, 9, 12]
    rows = [(1, BASE + dt.timedelta(hours=h), f(h / 10.0) if h in hours else None) for h in range(13)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double")
    out = GP.fill_max_gap(df, ["k"], "ts", ["v"], 3, "cubic").orderBy("ts").collect()
    for h, r in enumerate(out):
        assert abs(r.v - f(h / 10.0)) < 1e-9


def _bspline_quadratic_midknots(x, y, q):
    """Independent check: interpolating degree-2 B-spline with knots
    [x0]*3 + midpoints(x)[1:-1] + [x_end]*3, by Cox-de Boor and a dense solve."""
    k = 2
    mids = (x[1:] + x[:-1]) / 2
    t = np.r_[[x[0]] * 3, mids[1:-1], [x[-1]] * 3]
    n = len(x)

    def basis(j, d, v):
        if d == 0:
            if t[j] <= v < t[j + 1] or (v == t[-1] and t[j] < t[j + 1] == t[-1]):
                return 1.0
            return 0.0
        a = 0.0 if t[j + d] == t[j] else (v - t[j]) / (t[j + d] - t[j]) * basis(j, d - 1, v)
        b = 0.0 if t[j + d + 1] == t[j + 1] else (t[j + d + 1] - v) / (t[j + d + 1] - t[j + 1]) * basis(j + 1, d - 1, v)
        return a + b

    A = np.array([[basis(j, k, v) for j in range(n)] for v in x])
    c = np.linalg.solve(A, y)
    return [sum(c[j] * basis(j, k, v) for j in range(n)) for v in q]


@pytest.mark.parametrize("n,block", [(40, 128), (40, 4096), (4, 128), (3, 128), (300, 70)])
def test_quadratic_matches_bspline(spark, n, block):
    rnd = random.Random(100 + n + block)
    hours = sorted(rnd.sample(range(3 * n), n))
    vals = [rnd.uniform(-3, 3) for _ in hours]
    rows = [(1, BASE + dt.timedelta(hours=h), v) for h, v in zip(hours, vals)]
    have = set(hours)
    rows += [(1, BASE + dt.timedelta(hours=h), None) for h in range(hours[0], hours[-1] + 1) if h not in have]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double")
    out = CU.fill_max_gap_cubic(df, ["k"], "ts", ["v"], 10 ** 6, block=block, kind="quadratic").orderBy("ts").collect()
    x = np.array([3600.0 * h for h in hours])
    qs = [(r.ts - BASE).total_seconds() for r in out if int((r.ts - BASE).total_seconds() // 3600) not in have]
    exp = _bspline_quadratic_midknots(x, np.array(vals), qs)
    got = [r.v for r in out if int((r.ts - BASE).total_seconds() // 3600) not in have]
    assert np.allclose(got, exp, rtol=1e-7, atol=1e-7)
