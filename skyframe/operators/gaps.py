"""Gaps: lengths (W4), gap table (A2), statistics (A3), alerts (A4) and the
bounded gap fill (W11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import exchange_parts
from .series import (CHUNK, NROWS, RN, LOCAL_METHODS, chunk_expr, gap_len_expr, gap_pos_expr, interp_expr,
                     neighbours, next_col, prev_col)


def to_long(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str],
            extra: dict | None = None) -> DataFrame:
    """Wide -> long ``(keys, ts, variable, value[, extra...])``.

    ``extra`` maps an output name to ``{variable: column}`` (e.g. the quality
    column paired with each variable)."""
    keys = list(keys)
    cols = list(cols)
    entries = []
    for c in cols:
        fields = [F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")]
        for name, m in (extra or {}).items():
            fields.append(F.col(m[c]).alias(name) if m.get(c) else F.lit(None).alias(name))
        entries.append(F.struct(*fields))
    x = df.select(*keys, ts, F.explode(F.array(*entries)).alias("__e"))
    return x.select(*keys, ts, "__e.*")


def gap_info(df: DataFrame, keys, ts: str, cols, chunk="month") -> DataFrame:
    """Add ``c_gap_len`` (rows in the maximal null run) and ``c_gap_pos``
    (``inside|head|tail|all``) for each null of each column."""
    cols = list(cols)
    nb = neighbours(df, keys, ts, cols, chunk)
    ex = {}
    for c in cols:
        ex[f"{c}_gap_len"] = gap_len_expr(c)
        ex[f"{c}_gap_pos"] = gap_pos_expr(c)
    nb = nb.withColumns(ex)
    return nb.drop(RN, NROWS, *[prev_col(c) for c in cols], *[next_col(c) for c in cols])


def gap_table(df: DataFrame, keys, ts: str, col: str, chunk="month") -> DataFrame:
    """A2: one row per maximal null run: ``keys, gap_start, gap_end, gap_len,
    position``.

    Rows are shuffled once, by (entity, chunk); there each chunk's null runs become
    one row each (run lengths), with places in the entity from the sizes of the
    chunks before. Runs inside a chunk are done. Those that touch a border, two per
    chunk at most, are merged along the entity."""
    keys = list(keys)
    part = [*keys, CHUNK]
    d = df.select(*keys, F.col(ts).alias("__t"), F.col(col).isNotNull().alias("__ok")).withColumn(
        CHUNK, chunk_expr("__t", chunk)).repartition(exchange_parts(df.sparkSession), *part)
    run = Window.partitionBy(*part).orderBy("__t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumns({"__at": F.count(F.lit(1)).over(run), "__run": F.count_if("__ok").over(run)})
    runs = d.where("NOT __ok").groupBy(*part, "__run").agg(
        F.min("__t").alias("gap_start"), F.max("__t").alias("gap_end"), F.min("__at").alias("__from"), F.max("__at").alias("__to"))
    chunks = d.groupBy(*part).agg(F.count(F.lit(1)).alias("__size"))
    along = Window.partitionBy(*keys).orderBy(CHUNK)
    chunks = chunks.withColumns({"__before": F.coalesce(F.sum("__size").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
                                 "__n": F.sum("__size").over(Window.partitionBy(*keys))})
    runs = runs.join(chunks, part).withColumns({
        "__border": (F.col("__from") == 1) | (F.col("__to") == F.col("__size")),
        "__from": F.col("__from") + F.col("__before"), "__to": F.col("__to") + F.col("__before")})
    out = [*keys, "gap_start", "gap_end", "__from", "__to", "__n"]
    order = Window.partitionBy(*keys).orderBy("__from")
    border = runs.where("__border").withColumn("__new", F.coalesce(
        (F.lag("__to").over(order) + 1 != F.col("__from")).cast("long"), F.lit(1).cast("long")))
    border = border.withColumn("__gap", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = border.groupBy(*keys, "__gap").agg(F.min("gap_start").alias("gap_start"), F.max("gap_end").alias("gap_end"),
                                                F.min("__from").alias("__from"), F.max("__to").alias("__to"), F.max("__n").alias("__n"))
    both = runs.where("NOT __border").select(*out).unionByName(merged.select(*out))
    head, tail = F.col("__from") == 1, F.col("__to") == F.col("__n")
    return both.select(*keys, "gap_start", "gap_end", (F.col("__to") - F.col("__from") + 1).alias("gap_len"),
                       F.when(head & tail, "all").when(head, "head").when(tail, "tail").otherwise("inside").alias("position"))


def gap_stats(df: DataFrame, keys, ts: str, col: str, max_gap: int, chunk="month") -> DataFrame:
    """A3: per entity: total missing, fillable (runs of length <= max_gap, as the
    reference counts them, head and tail included), unfillable, and actually
    filled (inside runs only), plus the number of runs."""
    g = gap_table(df, keys, ts, col, chunk)
    short = F.col("gap_len") <= max_gap
    return g.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_gaps"),
        F.sum("gap_len").cast("long").alias("total_missing"),
        F.coalesce(F.sum(F.when(short, F.col("gap_len"))), F.lit(0)).cast("long").alias("fillable"),
        F.coalesce(F.sum(F.when(~short, F.col("gap_len"))), F.lit(0)).cast("long").alias("unfillable"),
        F.coalesce(F.sum(F.when(short & (F.col("position") == "inside"), F.col("gap_len"))),
                   F.lit(0)).cast("long").alias("actually_filled"))


def gap_alerts(df: DataFrame, keys, ts: str, col: str, max_gap: int, chunk="month") -> DataFrame:
    """A4: runs longer than ``max_gap``."""
    return gap_table(df, keys, ts, col, chunk).filter(F.col("gap_len") > max_gap)


def fill_max_gap(df: DataFrame, keys, ts: str, cols, max_gap: int, method: str = "time",
                 chunk="month") -> DataFrame:
    """Fill only inside gaps of at most ``max_gap`` rows; longer gaps and
    leading/trailing gaps stay null. ``method`` is any local method of
    :func:`skyframe.operators.series.interpolate`, or ``pchip``/``akima``
    (windowed cubic Hermite, :mod:`skyframe.operators.splines`) or
    ``cubic``/``cubicspline`` (not-a-knot spline, :mod:`skyframe.operators.cubic`)."""
    if max_gap < 1:
        raise ValueError("max_gap must be >= 1")
    cols = list(cols)
    if method in ("cubic", "cubicspline", "quadratic"):
        from . import cubic
        return cubic.fill_max_gap_cubic(df, keys, ts, cols, max_gap, chunk,
                                        kind="quadratic" if method == "quadratic" else "cubic")
    if method not in LOCAL_METHODS:
        from . import splines
        return splines.fill_max_gap_spline(df, keys, ts, cols, max_gap, method, chunk)
    nb = neighbours(df, keys, ts, cols, chunk)
    ex = {}
    for c in cols:
        ok = (F.col(c).isNull() & (gap_len_expr(c) <= max_gap) & (gap_pos_expr(c) == "inside"))
        ex[c] = F.when(ok, interp_expr(c, ts, method)).otherwise(F.col(c))
    nb = nb.withColumns(ex)
    return nb.drop(RN, NROWS, *[prev_col(c) for c in cols], *[next_col(c) for c in cols])
