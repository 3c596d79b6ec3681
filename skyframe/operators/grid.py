"""Fixed-interval grids: regularize (J1), missing rows (J2), upsample (J5),
coverage (A7) and first identifiers (A9).

Grid rows are generated from a per-entity (or per entity-year) bounds table
with ``sequence`` + ``explode``. The offsets are exploded in two levels
(blocks of ``block`` steps, then steps) so that no single array grows with the
length of a series, and the generated rows spread over tasks.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import HOURLY_FROM_YEAR
from ..session import exchange_parts
from .series import neighbours, RN

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def step_seconds(step) -> int:
    """``3600``, ``"1 hour"``, ``"3 hours"``, ``"10 minutes"`` -> seconds."""
    if isinstance(step, int):
        return step
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", str(step).lower())
    if not m:
        raise ValueError(f"cannot read step {step!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def _explode_offsets(b: DataFrame, n_steps: Column, block: int, keys: Sequence[str],
                     first: Column | None = None) -> DataFrame:
    """Add ``__k`` = first .. n_steps-1 (one row each). The first level yields one
    row per block of ``block`` steps; those few rows are redistributed by
    (entity, block) before the second level, so a long entity's grid is
    generated by many tasks."""
    b = b.withColumn("__nk", n_steps.cast("long"))
    b = b.withColumn("__k0", (first if first is not None else F.lit(0)).cast("long"))
    b = b.filter(F.col("__nk") > F.col("__k0"))
    b = b.withColumn("__blk", F.explode(F.sequence(F.floor(F.col("__k0") / block).cast("long"),
                                                   F.floor((F.col("__nk") - 1) / block).cast("long"))))
    # explicit count: the rows are few, so adaptive coalescing would otherwise
    # put the whole expansion into one task
    b = b.repartition(exchange_parts(b.sparkSession), *keys, "__blk")
    lo = F.greatest(F.col("__blk") * block, F.col("__k0"))
    hi = F.least(F.col("__blk") * block + block - 1, F.col("__nk") - 1)
    return b.withColumn("__k", F.explode(F.sequence(lo, hi))).drop("__blk", "__nk", "__k0")


def grid_frame(df: DataFrame, keys: Sequence[str], ts: str, step="1 hour", bounds="data",
               carry: Sequence[str] = (), block: int = 4096, clip=None) -> DataFrame:
    """Complete time grid per entity: ``keys, ts`` plus ``carry`` columns taken
    from the entity's first row.

    ``bounds``:
      * ``"data"``  -- from the entity's first to its last timestamp;
      * ``(start, end)`` -- the same closed range for every entity;
      * ``"year"`` -- the archive rule per calendar year present in the data:
        ``Y-01-01 01:00 .. (Y+1)-01-01 00:00`` hourly, or ``03:00`` 3-hourly
        before 1991 (a row belongs to the year of ``ts - 1 second``).

    ``clip=(start, end)`` (year rule only) generates just the grid points inside
    that closed range instead of whole years.
    """
    keys = list(keys)
    carry = list(carry)
    t = F.col(ts)
    firsts = [F.min_by(F.col(c), t).alias(c) for c in carry]
    if bounds == "year":
        yr = F.year(F.timestamp_add("SECOND", F.lit(-1), t))
        b = df.groupBy(*keys, yr.alias("__y")).agg(*firsts) if firsts else \
            df.select(*keys, yr.alias("__y")).distinct()
        y = F.col("__y")
        step_s = F.when(y < HOURLY_FROM_YEAR, F.lit(3 * 3600)).otherwise(F.lit(3600))
        start = F.make_timestamp_ntz(y, F.lit(1), F.lit(1),
                                     F.when(y < HOURLY_FROM_YEAR, 3).otherwise(1), F.lit(0), F.lit(0))
        end = F.make_timestamp_ntz(y + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        b = b.withColumn("__lo", start).withColumn("__s", step_s)
        first = None
        if clip is not None:
            tt = df.schema[ts].dataType
            c0, c1 = F.lit(str(clip[0])).cast(tt), F.lit(str(clip[1])).cast(tt)
            end = F.least(end, c1)
            # first offset at or after the clip start
            first = F.greatest(F.lit(0), F.ceil(F.timestamp_diff("SECOND", start, c0) / F.col("__s")))
        n = F.floor(F.timestamp_diff("SECOND", start, end) / F.col("__s")) + 1
        g = _explode_offsets(b, n, block, keys, first)
        g = g.withColumn(ts, F.timestamp_add("SECOND", F.col("__k") * F.col("__s"), F.col("__lo")))
        return g.select(*keys, ts, *carry)

    s = step_seconds(step)
    if bounds == "data":
        b = df.groupBy(*keys).agg(F.min(t).alias("__lo"), F.max(t).alias("__hi"), *firsts)
    else:
        start, end = bounds
        tt = df.schema[ts].dataType
        if firsts:
            b = df.groupBy(*keys).agg(*firsts)
        else:
            b = df.select(*keys).distinct()
        b = b.withColumn("__lo", F.lit(str(start)).cast(tt)).withColumn("__hi", F.lit(str(end)).cast(tt))
    n = F.floor(F.timestamp_diff("SECOND", F.col("__lo"), F.col("__hi")) / s) + 1
    g = _explode_offsets(b, n, block, keys)
    g = g.withColumn(ts, F.timestamp_add("SECOND", F.col("__k") * s, F.col("__lo")))
    return g.select(*keys, ts, *carry)


def _spread(g: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The grid side of a join on (keys, ts). Its size is not known before it is
    made: the bounds it is made from are small, so without the hint Spark may take
    the grid itself for small and broadcast it."""
    return g.repartition(exchange_parts(g.sparkSession), *keys, ts).hint("merge")


def regularize(df: DataFrame, keys: Sequence[str], ts: str, step="1 hour", bounds="data",
               fill: dict | None = None, carry: Sequence[str] = (), block: int = 4096,
               clip=None) -> DataFrame:
    """Left join of the complete grid with the data.

    Inserted rows get null values, ``fill`` constants (for instance quality code
    0) and the ``carry`` columns (identifiers) of the entity's first row. Rows off
    the grid are dropped (see :func:`off_grid_rows`).
    """
    keys = list(keys)
    carry = list(carry)
    g = grid_frame(df, keys, ts, step, bounds, carry, block, clip)
    g = g.select(*keys, ts, *[F.col(c).alias(f"__g_{c}") for c in carry])
    out = _spread(g, keys, ts).join(df, on=keys + [ts], how="left")
    ex = {c: F.coalesce(F.col(c), F.col(f"__g_{c}")) for c in carry}
    for c, v in (fill or {}).items():
        ex[c] = F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
    return out.withColumns(ex).select(*df.columns)


def missing_rows(df: DataFrame, keys: Sequence[str], ts: str, step="1 hour",
                 bounds="data") -> DataFrame:
    """Grid timestamps with no data row (``keys, ts``)."""
    keys = list(keys)
    g = grid_frame(df, keys, ts, step, bounds)
    return _spread(g, keys, ts).join(df.select(*keys, ts), on=keys + [ts], how="left_anti")


def off_grid_rows(df: DataFrame, keys: Sequence[str], ts: str, step="1 hour",
                  bounds="data") -> DataFrame:
    """Data rows whose timestamp is not on the grid."""
    keys = list(keys)
    g = grid_frame(df, keys, ts, step, bounds)
    return df.join(_spread(g, keys, ts), on=keys + [ts], how="left_anti")


def upsample(df: DataFrame, keys: Sequence[str], ts: str, start, end, step="1 hour",
             carry: Sequence[str] = ()) -> DataFrame:
    """Put the data on the grid ``start..end`` (both inclusive) at ``step``;
    data rows off that grid are not kept (use :func:`regularize` ``fill``/``carry``
    semantics)."""
    return regularize(df, keys, ts, step, (start, end), carry=carry)


def coverage(df: DataFrame, keys: Sequence[str], ts: str, chunk="month") -> DataFrame:
    """First and last timestamp, sample count and step per entity; the step
    is the distance of the first two samples (one hour for a single sample) and
    the inferred end is ``last + step``."""
    keys = list(keys)
    nb = neighbours(df.select(*keys, ts), keys, ts, [], chunk)
    c = nb.groupBy(*keys).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        F.count(F.lit(1)).alias("n_samples"),
        F.min(F.when(F.col(RN) == 2, F.col(ts))).alias("__second"))
    step = F.coalesce(F.timestamp_diff("SECOND", F.col("first_ts"), F.col("__second")), F.lit(3600))
    return (c.withColumn("step_seconds", step.cast("long"))
             .withColumn("end_ts", F.timestamp_add("SECOND", F.col("step_seconds"), F.col("last_ts")))
             .drop("__second"))


def first_ids(df: DataFrame, keys: Sequence[str], ts: str, ids: Sequence[str]) -> DataFrame:
    """Identifier columns of the first row of each group."""
    return df.groupBy(*keys).agg(*[F.min_by(F.col(c), F.col(ts)).alias(c) for c in ids])
