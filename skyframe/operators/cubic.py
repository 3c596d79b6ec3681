"""Cubic-spline gap fill (not-a-knot end conditions) and quadratic-spline
gap fill (knots at the midpoints between samples), through all valid samples of
an entity.

The slopes of both splines solve a tridiagonal system over all samples, but what a
sample does to a slope fades by a factor of two or more with each sample between
them. A row of a short inside gap is therefore filled from the ``BLOCK`` samples
around it and ``HALO`` more on both sides: cutting the system there moves a slope by
less than 2^-64 of its size, below the precision of a double. Samples of an entity
are numbered in the one chunk pass of :func:`skyframe.operators.series.neighbours`,
cut into blocks of consecutive numbers, and only blocks that hold a row to fill are
solved; no group is larger than ``BLOCK`` + 2 ``HALO`` samples and the rows asked of
it, and no step sees a whole entity. All variables go through the same pass.

A block's system is solved by cyclic reduction on whole arrays (log2 of its size
steps). Blocks are many and small, so tasks take them from sorted Arrow batches and
make no data frame of each.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, exchange_parts
from .series import halo_blocks, neighbours, post_col, pre_col
from .splines import valid_counts

BLOCK = 1024
HALO = 64

# the functions on Arrow batches run in Python workers that need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def solve_tridiagonal(lo: np.ndarray, di: np.ndarray, up: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Cyclic reduction: every step doubles the distance between the unknowns that
    an equation links, until each has only its own."""
    lo, di, up, rhs = (np.array(a, dtype=float) for a in (lo, di, up, rhs))
    lo[0] = up[-1] = 0.0
    n, step = len(di), 1
    while step < n:
        below, above = np.zeros(n), np.zeros(n)             # factors of the equations on both sides
        below[step:] = lo[step:] / di[:-step]
        above[:-step] = up[:-step] / di[step:]
        new = [np.zeros(n), di.copy(), np.zeros(n), rhs.copy()]
        new[0][step:] = -lo[:-step] * below[step:]
        new[2][:-step] = -up[step:] * above[:-step]
        for target, left, right in ((new[1], up, lo), (new[3], rhs, rhs)):
            target[step:] -= left[:-step] * below[step:]
            target[:-step] -= right[step:] * above[:-step]
        lo, di, up, rhs = new
        step *= 2
    return rhs / di


def cubic_slopes(x: np.ndarray, y: np.ndarray, starts: bool = True, ends: bool = True) -> np.ndarray:
    """Slopes of the cubic spline at the samples. ``starts`` and ``ends`` say
    whether the series really starts and ends here (not-a-knot) or is cut."""
    h = np.diff(x)
    m = np.diff(y) / h
    if len(x) == 2:
        return np.array([m[0], m[0]])
    if len(x) == 3:
        middle = (h[0] * m[1] + h[1] * m[0]) / (h[0] + h[1])
        return np.array([2 * m[0] - middle, middle, 2 * m[1] - middle])
    lo, di, up, rhs = (np.zeros(len(x)) for _ in range(4))
    lo[1:-1], di[1:-1], up[1:-1] = h[1:], 2 * (h[:-1] + h[1:]), h[:-1]
    rhs[1:-1] = 3 * (h[1:] * m[:-1] + h[:-1] * m[1:])
    if starts:
        d = x[2] - x[0]
        di[0], up[0] = h[1], d
        rhs[0] = ((h[0] + 2 * d) * h[1] * m[0] + h[0] ** 2 * m[1]) / d
    else:
        di[0], rhs[0] = 1.0, m[0]
    if ends:
        d = x[-1] - x[-3]
        lo[-1], di[-1] = d, h[-2]
        rhs[-1] = (h[-1] ** 2 * m[-2] + (2 * d + h[-1]) * h[-2] * m[-1]) / d
    else:
        di[-1], rhs[-1] = 1.0, m[-1]
    return solve_tridiagonal(lo, di, up, rhs)


def quadratic_slopes(x: np.ndarray, y: np.ndarray, starts: bool = True, ends: bool = True) -> np.ndarray:
    """Slopes of the quadratic spline with a piece per sample that meet smoothly at
    the midpoints; no knot in the first and last interval of the series."""
    h = np.diff(x)
    m = np.diff(y) / h
    if len(x) == 3:
        bend = (m[1] - m[0]) / (x[2] - x[0])
        return np.array([m[0] - bend * h[0], m[0] + bend * h[0], m[1] + bend * h[1]])
    lo, di, up, rhs = (np.zeros(len(x)) for _ in range(4))
    left, right = 1 / h[:-1], 1 / h[1:]
    lo[1:-1], di[1:-1], up[1:-1] = left, 3 * (left + right), right
    rhs[1:-1] = 4 * (m[:-1] * left + m[1:] * right)
    di[0] = up[0] = lo[-1] = di[-1] = 1.0
    rhs[0], rhs[-1] = 2 * m[0], 2 * m[-1]
    if starts:
        lo[1], di[1] = 0.0, 2 * left[0] + 3 * right[0]
        rhs[1] = 2 * m[0] * left[0] + 4 * m[1] * right[0]
    if ends:
        di[-2], up[-2] = 3 * left[-1] + 2 * right[-1], 0.0
        rhs[-2] = 4 * m[-2] * left[-1] + 2 * m[-1] * right[-1]
    return solve_tridiagonal(lo, di, up, rhs)


def _cubic_value(u, h, y0, y1, d0, d1, _inner) -> np.ndarray:
    t = u / h
    t2 = t * t
    t3 = t2 * t
    return (2 * t3 - 3 * t2 + 1) * y0 + (t3 - 2 * t2 + t) * h * d0 + (-2 * t3 + 3 * t2) * y1 + (t3 - t2) * h * d1


def _quadratic_value(u, h, y0, y1, d0, d1, inner) -> np.ndarray:
    """``inner``: the interval holds a knot at its midpoint."""
    m = (y1 - y0) / h
    half, turn = (d1 - d0) / (2 * h), 2 * (m - (d0 + d1) / 2) / h
    first = y0 + d0 * u + (half + turn) * u * u
    second = y1 + d1 * (u - h) + (half - turn) * (u - h) ** 2
    return np.where(inner, np.where(u <= h / 2, first, second), y0 + d0 * u + (m - d0) / h * u * u)


def _fill_blocks(columns: list[str], kind: str):
    """Arrow batches of whole partitions, sorted by block, samples first -> the
    ``columns`` of the filled rows and ``value``. ``place`` counts a block's rows from 1."""
    slopes, value = (cubic_slopes, _cubic_value) if kind == "cubic" else (quadratic_slopes, _quadratic_value)
    least = 2 if kind == "cubic" else 3

    def filled(t: pa.Table):
        place, asked, r, x, y, n = (t.column(c).to_numpy() for c in ("place", "asked", "r", "x", "y", "n"))
        starts = np.flatnonzero(place == 1)
        known = np.add.reduceat(~asked.astype(bool), starts, dtype=int)
        rows, values = [], []
        for a, m, e in zip(starts, known, np.append(starts[1:], len(place))):
            if m < least or m == e - a:
                continue
            s, w = slice(a, a + m), slice(a + m, e)
            rs, xs, ys, total = r[s], x[s], y[s], n[a]
            d = slopes(xs, ys, rs[0] == 1, rs[-1] == total)
            k = r[w] - rs[0]                                # the sample before the row
            inner = (rs[k] >= 2) & (rs[k] <= total - 2)
            rows.append(np.arange(a + m, e))
            values.append(value(x[w] - xs[k], xs[k + 1] - xs[k], ys[k], ys[k + 1], d[k], d[k + 1], inner))
        if rows:
            out = t.select(columns).take(pa.array(np.concatenate(rows)))
            yield from out.append_column("value", pa.array(np.concatenate(values))).combine_chunks().to_batches()

    def fn(batches):
        rest = []
        for batch in batches:
            starts = np.flatnonzero(batch.column("place").to_numpy(zero_copy_only=False) == 1)
            if len(starts) and (rest or starts[-1]):
                yield from filled(pa.Table.from_batches([*rest, batch.slice(0, starts[-1])]))
                rest = []
            rest.append(batch.slice(starts[-1]) if len(starts) else batch)
        if rest:
            yield from filled(pa.Table.from_batches(rest))
    return fn


def fill_max_gap_cubic(df: DataFrame, keys, ts: str, cols: Sequence[str], max_gap: int,
                       chunk="month", block: int = BLOCK, kind: str = "cubic") -> DataFrame:
    """W11 with ``cubic``/``cubicspline`` (not-a-knot cubic spline) or
    ``quadratic`` (quadratic spline with knots at the midpoints between
    samples): fill inside gaps of at most ``max_gap`` rows from the spline
    through all valid samples. Two samples make a line for ``cubic`` and nothing
    for ``quadratic``."""
    keys = list(keys)
    cols = list(cols)
    nb = neighbours(df, keys, ts, [], chunk, counts=valid_counts(cols), around=cols, depth=1)
    entries = []
    for i, c in enumerate(cols):
        before, after = F.get(pre_col(c), F.lit(0)), F.get(post_col(c), F.lit(0))
        ask = F.col(c).isNull() & (after["r"] - before["r"] - 1 <= max_gap)
        # the number of a sample; for a null row that of the sample before it
        entries.append(F.when(F.col(c).isNotNull() | ask, F.struct(
            F.lit(i).alias("variable"), F.col(c).isNull().alias("asked"), F.col(c).cast("double").alias("y"),
            F.col(f"__vo_{c}").alias("r"), F.col(f"__vo_{c}_total").alias("n"))))
    # samples, asked rows and the result all start from the one chunk pass
    nb = cut_lineage(nb.select(*df.columns, *[e.alias(f"__e_{i}") for i, e in enumerate(entries)]), "spline")
    x = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts)).cast("double")
    long = nb.select(*keys, F.col(ts).alias("ts"), x.alias("x"),
                     F.explode(F.array_compact(F.array(*[F.col(f"__e_{i}") for i in range(len(cols))]))).alias("e"))
    long = long.select(*keys, "ts", "x", "e.*")
    group = [*keys, "variable", "__blk"]
    asked = long.where("asked").withColumn("__blk", F.floor((F.col("r") - 1) / block).cast("long"))
    samples = halo_blocks(long.where("NOT asked"), [*keys, "variable"], "r", HALO, HALO + 1, block).drop("__halo")
    live = samples.join(asked.select(*group).distinct(), group, "left_semi")
    columns = [*keys, "variable", "ts"]
    schema = T.StructType([*[long.schema[c] for c in columns], T.StructField("value", T.DoubleType())])
    blocks = live.unionByName(asked).repartition(exchange_parts(df.sparkSession), *group).withColumn(
        "place", F.row_number().over(Window.partitionBy(*group).orderBy("asked", "r", "ts")))
    filled = blocks.mapInArrow(_fill_blocks(columns, kind), schema)
    wide = filled.groupBy(*keys, F.col("ts").alias(ts)).agg(
        *[F.max(F.when(F.col("variable") == i, F.col("value"))).alias(f"__f_{i}") for i in range(len(cols))])
    out = nb.join(wide, [*keys, ts], "left").withColumns({c: F.coalesce(F.col(c), F.col(f"__f_{i}")) for i, c in enumerate(cols)})
    return out.select(*df.columns)
