"""Cubic Hermite gap fills: monotone PCHIP (W8) and Akima.

Both are local: the slope at a valid sample depends on its two (PCHIP) or
three (Akima) valid neighbours on each side. Every row gets its nearest valid
samples before and after it in the one chunk pass of
:func:`skyframe.operators.series.neighbours` (``around``), so a row of a short
inside gap holds all that the slopes at both ends of its interval need, and is
evaluated in place: there is no table of slopes and no join for them. Only Akima's
threshold needs a figure of the whole entity, its largest slope weight (one row per
entity). ``x`` is time in seconds, as for a time-indexed series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .series import NROWS, RN, neighbours, post_col, pre_col

DEPTH = {"pchip": 2, "akima": 3}    # samples on each side of a gap


def _sign(x: Column) -> Column:
    return F.signum(x)


def _pchip_edge(h0, h1, m0, m1) -> Column:
    d = ((2 * h0 + h1) * m0 - h0 * m1) / (h0 + h1)
    return (F.when(_sign(d) != _sign(m0), F.lit(0.0))
             .when((_sign(m0) != _sign(m1)) & (F.abs(d) > 3.0 * F.abs(m0)), 3.0 * m0)
             .otherwise(d))


def valid_counts(cols: Sequence[str]) -> dict:
    """``counts`` argument for :func:`neighbours` that numbers the valid samples
    of each column in the same pass (``__vo_c`` and ``__vo_c_total``)."""
    return {f"__vo_{c}": f"`{c}` IS NOT NULL" for c in cols}


def _step(a: Column, b: Column) -> Column:
    return b["x"] - a["x"]


def _secant(a: Column, b: Column) -> Column:
    return (b["v"] - a["v"]) / (b["x"] - a["x"])


def _pchip_inner(h0: Column, h1: Column, m0: Column, m1: Column) -> Column:
    """Weighted harmonic mean of the secants on both sides, 0 where they differ in sign."""
    w1, w2 = 2 * h1 + h0, h1 + 2 * h0
    return F.when((_sign(m0) != _sign(m1)) | (m0 == 0) | (m1 == 0), F.lit(0.0)).otherwise((w1 + w2) / (w1 / m0 + w2 / m1))


def _pchip_slopes(x: DataFrame, ok: Column) -> DataFrame:
    """``__d0`` and ``__d1``: slopes at the samples ``__a0`` and ``__b0`` next to the row."""
    a1, a0, b0, b1 = (F.col(f"__{n}") for n in ("a1", "a0", "b0", "b1"))
    x = x.withColumns({n: F.when(ok, e) for n, e in (
        ("__h", _step(a0, b0)), ("__hm", _step(a1, a0)), ("__hp", _step(b0, b1)),
        ("__m", _secant(a0, b0)), ("__mm", _secant(a1, a0)), ("__mp", _secant(b0, b1)))})
    h, hm, hp, m, mm, mp = (F.col(n) for n in ("__h", "__hm", "__hp", "__m", "__mm", "__mp"))
    return x.withColumns({
        "__d0": F.when(hm.isNotNull(), _pchip_inner(hm, h, mm, m)).when(hp.isNotNull(), _pchip_edge(h, hp, m, mp)).otherwise(m),
        "__d1": F.when(hp.isNotNull(), _pchip_inner(h, hp, m, mp)).when(hm.isNotNull(), _pchip_edge(h, hm, m, mm)).otherwise(m)})


def _akima_terms(x: DataFrame, name: str, samples: Sequence[Column], ok: Column) -> DataFrame:
    """The four secants around the middle one of five consecutive samples (null
    beyond the ends of the series, where secants are extended), as ``name`` + m2,
    m1, m0, p1, and ``name`` + f1, f2: the weights of the slope there."""
    p1, p0, own, n0, n1 = samples
    x = x.withColumns({f"{name}{n}": F.when(ok, e) for n, e in (
        ("q_2", _secant(p1, p0)), ("q_1", _secant(p0, own)), ("q0", _secant(own, n0)), ("q1", _secant(n0, n1)))})
    q_2, q_1, q0, q1 = (F.col(name + n) for n in ("q_2", "q_1", "q0", "q1"))
    x = x.withColumns({
        name + "m1": F.when(q_1.isNull(), 2 * q0 - q1).otherwise(q_1),
        name + "m2": F.when(q_1.isNull(), 3 * q0 - 2 * q1).when(q_2.isNull(), 2 * q_1 - q0).otherwise(q_2),
        name + "m0": F.when(q0.isNull(), 2 * q_1 - q_2).otherwise(q0),
        name + "p1": F.when(q0.isNull(), 3 * q_1 - 2 * q_2).when(q1.isNull(), 2 * q0 - q_1).otherwise(q1)})
    return x.withColumns({name + "f1": F.abs(F.col(name + "p1") - F.col(name + "m0")),
                          name + "f2": F.abs(F.col(name + "m1") - F.col(name + "m2"))})


def _akima_slopes(x: DataFrame, keys: list[str], col: str, ok: Column) -> DataFrame:
    """``__d0`` and ``__d1`` as in :func:`_pchip_slopes`."""
    near = {n: F.col(f"__{n}") for n in ("a2", "a1", "a0", "b0", "b1", "b2")}
    # the entity's largest weight, over all its valid samples; null with fewer than three
    valid = F.col(col).isNotNull()
    w = x.where(valid).select(*keys, *[F.get(pre_col(col), F.lit(k)).alias(f"__p{k}") for k in (0, 1)],
                              F.struct(_epoch().alias("x"), F.col(col).cast("double").alias("v")).alias("__own"),
                              *[F.get(post_col(col), F.lit(k)).alias(f"__n{k}") for k in (0, 1)])
    w = _akima_terms(w, "__w", [F.col(n) for n in ("__p1", "__p0", "__own", "__n0", "__n1")], F.lit(True))
    most = w.groupBy(*keys).agg(F.max(F.col("__wf1") + F.col("__wf2")).alias("__fmax"))
    x = x.join(most, keys, "left")
    for end, five in (("__0", ("a2", "a1", "a0", "b0", "b1")), ("__1", ("a1", "a0", "b0", "b1", "b2"))):
        x = _akima_terms(x, end, [near[n] for n in five], ok)
    line = F.when(near["a1"].isNull() & near["b1"].isNull(), _secant(near["a0"], near["b0"]))

    def slope(n: str) -> Column:
        f1, f2, m2, m1, m0, p1 = (F.col(n + t) for t in ("f1", "f2", "m2", "m1", "m0", "p1"))
        return F.coalesce(line, F.when(f1 + f2 > 1e-9 * F.col("__fmax"), (f1 * m1 + f2 * m0) / (f1 + f2)).otherwise(0.5 * (p1 + m2)))
    return x.withColumns({"__d0": slope("__0"), "__d1": slope("__1")})


def _epoch(ts: str = "__ts") -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts)).cast("double")


def hermite(xq: Column, x0, y0, d0, x1, y1, d1) -> Column:
    h = x1 - x0
    t = (xq - x0) / h
    t2 = t * t
    t3 = t2 * t
    return ((2 * t3 - 3 * t2 + 1) * y0 + (t3 - 2 * t2 + t) * h * d0
            + (-2 * t3 + 3 * t2) * y1 + (t3 - t2) * h * d1)


def fill_max_gap_spline(df: DataFrame, keys, ts: str, cols: Sequence[str], max_gap: int,
                        method: str = "pchip", chunk="month") -> DataFrame:
    """W11 with ``pchip`` or ``akima``: fill inside gaps of at most ``max_gap``
    rows from the cubic Hermite curve through all valid samples."""
    keys = list(keys)
    cols = list(cols)
    if method not in DEPTH:
        raise ValueError(f"method {method!r} is not available (see README, 'Not built')")
    depth = DEPTH[method]
    out = neighbours(df, keys, ts, [], chunk, around=cols, depth=depth).withColumn("__ts", F.col(ts))
    for c in cols:
        x = out.withColumns({f"__{side}{k}": F.get(name, F.lit(k)) for side, name in (("a", pre_col(c)), ("b", post_col(c)))
                             for k in range(depth)})
        a0, b0 = F.col("__a0"), F.col("__b0")
        ok = F.col(c).isNull() & (b0["r"] - a0["r"] - 1 <= max_gap)         # null at the ends of the series
        x = _pchip_slopes(x, ok) if method == "pchip" else _akima_slopes(x, keys, c, ok)
        filled = hermite(_epoch(), a0["x"], a0["v"], F.col("__d0"), b0["x"], b0["v"], F.col("__d1"))
        x = x.withColumn("__filled", F.when(ok, filled).otherwise(F.col(c)))
        out = x.select(*[F.col("__filled").alias(c) if n == c else F.col(f"`{n}`") for n in out.columns])
    return out.drop(RN, NROWS, "__ts", *[f(c) for c in cols for f in (pre_col, post_col)])
