"""Order-dependent operators on keyed time series.

Every operator takes ``keys`` (entity columns) and ``ts`` (order column) and
works on all entities of the DataFrame at once.

Scale design
------------
A single entity may hold a large share of all rows, so no window here is
partitioned by the entity alone. Rows are cut into time chunks
(``chunk="month"`` by default) and every window runs over ``(keys, chunk)``.
What must cross a chunk border -- the last valid sample before the chunk, the
first valid sample after it, and the row offset of the chunk -- comes from a
per-chunk summary (one row per entity and chunk) that is scanned per entity
and joined back. On a regular grid a chunk holds a bounded number of rows
(744 for hourly months), so every task is bounded whatever the skew.

Forward-looking values are always taken with ``last(ignorenulls)`` over the
*descending* order with an ``UNBOUNDED PRECEDING`` frame: the equivalent
``first(ignorenulls)`` over ``UNBOUNDED FOLLOWING`` is quadratic in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import exchange_parts

CHUNK = "__chunk"
RN = "__rn"          # global 1-based row number within the entity
NROWS = "__n"        # rows of the entity
_LRN = "__lrn"
_OFF = "__off"

UNB = Window.unboundedPreceding
CUR = Window.currentRow


def prev_col(c: str) -> str:
    """Struct<t, r, v>: last non-null sample at or before the row."""
    return f"{c}__prev"


def next_col(c: str) -> str:
    """Struct<t, r, v>: first non-null sample at or after the row."""
    return f"{c}__next"


def chunk_expr(ts: str, unit: str) -> Column:
    t = F.col(ts)
    if unit == "year":
        return F.year(t)
    if unit == "month":
        return F.year(t) * 12 + F.month(t) - 1
    if unit == "day":
        return F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date"))
    raise ValueError(f"unknown chunk unit {unit!r}")


def q(name: str) -> str:
    """Quote a column name for a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def _sample_sql(ts: str, rn: str, c: str) -> str:
    return (f"CASE WHEN {q(c)} IS NOT NULL THEN named_struct('t', {q(ts)}, "
            f"'r', CAST({q(rn)} AS BIGINT), 'v', {q(c)}) END")


def _shift_sql(x: str, off: str) -> str:
    return (f"CASE WHEN {x} IS NOT NULL THEN named_struct('t', {x}.t, 'r', {x}.r + {q(off)}, "
            f"'v', {x}.v) END")


def _shift_all_sql(x: str, off: str) -> str:
    return f"transform({x}, e -> named_struct('x', e.x, 'r', e.r + {q(off)}, 'v', e.v))"


def pre_col(c: str) -> str:
    """Array of struct<x, r, v>: the nearest valid samples before the row, nearest first."""
    return f"{c}__pre"


def post_col(c: str) -> str:
    """Array of struct<x, r, v>: the nearest valid samples after the row, nearest first."""
    return f"{c}__post"


def neighbours(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str] = (),
               chunk: str = "month", counts: dict | None = None,
               around: Sequence[str] = (), depth: int = 0) -> DataFrame:
    """Add the global row number ``__rn``, the entity size ``__n`` and, for each
    column ``c`` of ``cols``, the previous and next valid samples
    ``c__prev``/``c__next`` as ``struct<t, r, v>`` (time, row number, value).
    The current row counts as its own neighbour when it is valid.

    ``counts`` maps a name to a SQL boolean condition; for each, ``name`` gets
    the running count (inclusive) of rows meeting it within the entity and
    ``name + "_total"`` the entity total -- in the same pass.

    ``around`` names columns that get the ``depth`` nearest valid samples strictly
    before and after each row (:func:`pre_col`, :func:`post_col`; ``x`` is seconds,
    ``v`` a double), also in the same pass: a chunk's summary holds its ``depth``
    first and last samples, and those of the nearest ``depth`` chunks that have any
    fill up what a chunk lacks at its borders.

    ``(keys, ts)`` must be unique.
    """
    keys = list(keys)
    cols = list(cols)
    counts = dict(counts or {})
    part = keys + [CHUNK]
    # Distribute by (entity, chunk): a long entity spreads over several tasks,
    # and the window branch and the summary branch share this one exchange.
    d = df.withColumn(CHUNK, chunk_expr(ts, chunk)).repartition(exchange_parts(df.sparkSession), *part)
    pby = ", ".join(q(k) for k in part)
    kby = ", ".join(q(k) for k in keys)
    d = d.withColumn(_LRN, F.expr(f"row_number() OVER (PARTITION BY {pby} ORDER BY {q(ts)})"))
    if counts:
        run = f"OVER (PARTITION BY {pby} ORDER BY {q(ts)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        d = d.withColumns({f"__lc_{n}": F.expr(f"count_if({cond}) {run}") for n, cond in counts.items()})
    if cols:
        wa = f"OVER (PARTITION BY {pby} ORDER BY {q(ts)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        wd = (f"OVER (PARTITION BY {pby} ORDER BY {q(ts)} DESC "
              f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
        ex = {}
        for c in cols:
            smp = _sample_sql(ts, _LRN, c)
            ex[f"__lp_{c}"] = F.expr(f"last({smp}, true) {wa}")
            ex[f"__ln_{c}"] = F.expr(f"last({smp}, true) {wd}")
        d = d.withColumns(ex)

    around = list(around)
    if around:
        order = f"OVER (PARTITION BY {pby} ORDER BY {q(ts)})"
        d = d.withColumns({f"__s_{c}": F.expr(
            f"CASE WHEN {q(c)} IS NOT NULL THEN named_struct('x', CAST(timestampdiff(SECOND, "
            f"TIMESTAMP_NTZ'1970-01-01 00:00:00', {q(ts)}) AS DOUBLE), 'r', CAST({q(_LRN)} AS BIGINT), "
            f"'v', CAST({q(c)} AS DOUBLE)) END") for c in around})
        d = d.withColumns({f"__{side}_{c}": F.expr("array_compact(array(" + ", ".join(
            f"{fn}({q(f'__s_{c}')}, {k}) IGNORE NULLS {order}" for k in range(1, depth + 1)) + "))")
            for c in around for side, fn in (("pre", "lag"), ("post", "lead"))})

    # One row per (entity, chunk): size, first and last valid sample.
    aggs = [F.count(F.lit(1)).alias("__cn")]
    aggs += [F.expr(f"count_if({cond})").alias(f"__cc_{n}") for n, cond in counts.items()]
    for c in cols:
        smp = _sample_sql(ts, _LRN, c)
        aggs += [F.expr(f"max({smp})").alias(f"__cl_{c}"), F.expr(f"min({smp})").alias(f"__cf_{c}")]
    for c in around:
        for side, fn in (("pre", "max_by"), ("post", "min_by")):
            own = f"array_compact(concat(array({q(f'__s_{c}')}), {q(f'__{side}_{c}')}))"
            aggs.append(F.expr(f"{fn}(slice({own}, 1, {depth}), {q(ts)})").alias(f"__b{side}_{c}"))
    s = d.groupBy(*part).agg(*aggs)
    before = f"OVER (PARTITION BY {kby} ORDER BY {q(CHUNK)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    after = (f"OVER (PARTITION BY {kby} ORDER BY {q(CHUNK)} DESC "
             f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    s = s.withColumns({
        _OFF: F.expr(f"CAST(coalesce(sum(__cn) {before}, 0) AS BIGINT)"),
        NROWS: F.expr(f"CAST(sum(__cn) OVER (PARTITION BY {kby}) AS BIGINT)")})
    keep = part + [_OFF, NROWS]
    if counts:
        ex = {}
        for n in counts:
            ex[f"__co_{n}"] = F.expr(f"CAST(coalesce(sum(__cc_{n}) {before}, 0) AS BIGINT)")
            ex[f"{n}_total"] = F.expr(f"CAST(sum(__cc_{n}) OVER (PARTITION BY {kby}) AS BIGINT)")
            keep += [f"__co_{n}", f"{n}_total"]
        s = s.withColumns(ex)
    if cols:
        shifted, carried = {}, {}
        for c in cols:
            shifted[f"__cl_{c}"] = F.expr(_shift_sql(q(f"__cl_{c}"), _OFF))
            shifted[f"__cf_{c}"] = F.expr(_shift_sql(q(f"__cf_{c}"), _OFF))
            carried[f"__cp_{c}"] = F.expr(f"last({q(f'__cl_{c}')}, true) {before}")
            carried[f"__cx_{c}"] = F.expr(f"last({q(f'__cf_{c}')}, true) {after}")
            keep += [f"__cp_{c}", f"__cx_{c}"]
        s = s.withColumns(shifted).withColumns(carried)
    if around:
        s = s.withColumns({f"__b{side}_{c}": F.expr(_shift_all_sql(q(f"__b{side}_{c}"), _OFF))
                           for c in around for side in ("pre", "post")})
        ex = {}
        for c in around:
            for side, fn in (("pre", "lag"), ("post", "lead")):
                some = f"CASE WHEN size({q(f'__b{side}_{c}')}) > 0 THEN {q(f'__b{side}_{c}')} END"
                near = ", ".join(f"coalesce({fn}({some}, {k}) IGNORE NULLS OVER (PARTITION BY {kby} ORDER BY {q(CHUNK)}), "
                                 f"filter({q(f'__b{side}_{c}')}, e -> false))" for k in range(1, depth + 1))
                ex[f"__c{side}_{c}"] = F.expr(f"concat({near})")
                keep.append(f"__c{side}_{c}")
        s = s.withColumns(ex)
    s = s.select(*keep)

    out = d.join(s, on=part, how="inner")
    ex = {RN: F.expr(f"CAST({q(_LRN)} + {q(_OFF)} AS BIGINT)")}
    drop = [CHUNK, _LRN, _OFF]
    for n in counts:
        ex[n] = F.expr(f"CAST(__lc_{n} + __co_{n} AS BIGINT)")
        drop += [f"__lc_{n}", f"__co_{n}"]
    for c in cols:
        ex[prev_col(c)] = F.expr(f"coalesce({_shift_sql(q(f'__lp_{c}'), _OFF)}, {q(f'__cp_{c}')})")
        ex[next_col(c)] = F.expr(f"coalesce({_shift_sql(q(f'__ln_{c}'), _OFF)}, {q(f'__cx_{c}')})")
        drop += [f"__lp_{c}", f"__ln_{c}", f"__cp_{c}", f"__cx_{c}"]
    for c in around:
        for side, name in (("pre", pre_col(c)), ("post", post_col(c))):
            ex[name] = F.expr(f"slice(concat({_shift_all_sql(q(f'__{side}_{c}'), _OFF)}, {q(f'__c{side}_{c}')}), 1, {depth})")
            drop += [f"__{side}_{c}", f"__c{side}_{c}"]
        drop.append(f"__s_{c}")
    return out.withColumns(ex).drop(*drop)


def _drop_nb(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(RN, NROWS, *[prev_col(c) for c in cols], *[next_col(c) for c in cols])


# ---------------------------------------------------------------------------
# Fills and nearest valid samples
# ---------------------------------------------------------------------------

def ffill(df: DataFrame, keys, ts: str, cols, chunk="month") -> DataFrame:
    """Last non-null value forward within each entity (leading nulls stay)."""
    cols = list(cols)
    nb = neighbours(df, keys, ts, cols, chunk)
    nb = nb.withColumns({c: F.col(prev_col(c))["v"] for c in cols})
    return _drop_nb(nb, cols)


def bfill(df: DataFrame, keys, ts: str, cols, chunk="month") -> DataFrame:
    """Next non-null value backward within each entity (trailing nulls stay)."""
    cols = list(cols)
    nb = neighbours(df, keys, ts, cols, chunk)
    nb = nb.withColumns({c: F.col(next_col(c))["v"] for c in cols})
    return _drop_nb(nb, cols)


def nearest_valid(df: DataFrame, keys, ts: str, col: str, chunk="month") -> DataFrame:
    """Previous and next valid time and value for each row
    (``prev_time, prev_value, next_time, next_value``)."""
    nb = neighbours(df, keys, ts, [col], chunk)
    p, n = F.col(prev_col(col)), F.col(next_col(col))
    nb = (nb.withColumn("prev_time", p["t"]).withColumn("prev_value", p["v"])
            .withColumn("next_time", n["t"]).withColumn("next_value", n["v"]))
    return _drop_nb(nb, [col])


# ---------------------------------------------------------------------------
# Gap length and position
# ---------------------------------------------------------------------------

def gap_len_expr(c: str) -> Column:
    """Length (rows) of the maximal null run containing the row; 0 for valid rows.
    Needs the columns added by :func:`neighbours`."""
    p, n = q(prev_col(c)), q(next_col(c))
    return F.expr(f"CASE WHEN {q(c)} IS NULL THEN coalesce({n}.r, {q(NROWS)} + 1) - coalesce({p}.r, 0) - 1 "
                  f"ELSE CAST(0 AS BIGINT) END")


def gap_pos_expr(c: str) -> Column:
    """``inside`` | ``head`` | ``tail`` | ``all`` for null rows, null for valid rows."""
    p, n = q(prev_col(c)), q(next_col(c))
    return F.expr(f"CASE WHEN {q(c)} IS NOT NULL THEN CAST(NULL AS STRING) "
                  f"WHEN {p} IS NULL AND {n} IS NULL THEN 'all' WHEN {p} IS NULL THEN 'head' "
                  f"WHEN {n} IS NULL THEN 'tail' ELSE 'inside' END")


# ---------------------------------------------------------------------------
# interpolation
# ---------------------------------------------------------------------------

LINEAR_IN_TIME = ("time", "index", "values", "slinear", "piecewise_polynomial")
HOLDS_TAIL = ("time", "linear", "index", "values")
LOCAL_METHODS = LINEAR_IN_TIME + ("linear", "nearest", "zero")


def _seconds(a: Column, b: Column) -> Column:
    return F.timestamp_diff("SECOND", a, b)


def interp_sql(c: str, ts: str, method: str = "time") -> str:
    """SQL for the value of ``c`` interpolated between its neighbours (inside
    gaps only; valid rows keep their value)."""
    p, n, t = q(prev_col(c)), q(next_col(c)), q(ts)
    if method in LINEAR_IN_TIME:
        val = (f"{p}.v + ({n}.v - {p}.v) * CAST(timestampdiff(SECOND, {p}.t, {t}) AS DOUBLE) "
               f"/ CAST(timestampdiff(SECOND, {p}.t, {n}.t) AS DOUBLE)")
    elif method == "linear":
        val = (f"{p}.v + ({n}.v - {p}.v) * CAST({q(RN)} - {p}.r AS DOUBLE) "
               f"/ CAST({n}.r - {p}.r AS DOUBLE)")
    elif method == "nearest":
        # ties go to the earlier sample
        val = (f"CASE WHEN timestampdiff(SECOND, {p}.t, {t}) <= timestampdiff(SECOND, {t}, {n}.t) "
               f"THEN {p}.v ELSE {n}.v END")
    elif method == "zero":
        val = f"{p}.v"
    else:
        raise ValueError(f"method {method!r} is not a local method")
    return (f"CASE WHEN {q(c)} IS NOT NULL THEN {q(c)} "
            f"WHEN {p} IS NOT NULL AND {n} IS NOT NULL THEN {val} END")


def interp_expr(c: str, ts: str, method: str = "time") -> Column:
    """Column form of :func:`interp_sql`. Needs the columns added by :func:`neighbours`."""
    return F.expr(interp_sql(c, ts, method))


def interpolate(df: DataFrame, keys, ts: str, cols, method: str = "time",
                limit_area: str | None = None, chunk="month", ffill_cols=()) -> DataFrame:
    """Fill nulls of ``cols``.

    ``time`` (and ``index``/``values``/``slinear``) is linear in elapsed time,
    ``linear`` is linear in row position; both hold the last valid value over a
    trailing gap. ``nearest`` (ties to the earlier sample) and ``zero``
    (previous sample) fill inside gaps only. Leading gaps stay null.
    ``limit_area="inside"`` restricts every method to inside gaps.
    ``ffill_cols`` are forward-filled in the same pass (one exchange for both).
    """
    cols = list(cols)
    ffill_cols = list(ffill_cols)
    if method not in LOCAL_METHODS:
        raise ValueError(f"unsupported method {method!r}")
    nb = neighbours(df, keys, ts, cols + ffill_cols, chunk)
    ex = {c: F.expr(f"{q(prev_col(c))}.v") for c in ffill_cols}
    for c in cols:
        e = interp_sql(c, ts, method)
        if method in HOLDS_TAIL and limit_area != "inside":
            p, n = q(prev_col(c)), q(next_col(c))
            e = f"CASE WHEN {q(c)} IS NULL AND {p} IS NOT NULL AND {n} IS NULL THEN {p}.v ELSE {e} END"
        ex[c] = F.expr(e)
    return _drop_nb(nb.withColumns(ex), cols + ffill_cols)


# ---------------------------------------------------------------------------
# Every n-th row
# ---------------------------------------------------------------------------

def every_nth(df: DataFrame, keys, ts: str, n: int, chunk="month") -> DataFrame:
    """Keep rows 1, n+1, 2n+1, ... of each entity in time order."""
    if n < 1:
        raise ValueError("n must be >= 1")
    nb = neighbours(df, keys, ts, [], chunk)
    return nb.filter((F.col(RN) - 1) % n == 0).drop(RN, NROWS)


# ---------------------------------------------------------------------------
# Rolling means
# ---------------------------------------------------------------------------

def rolling_bounds(window: int, center: bool = True) -> tuple[int, int]:
    """Rows before and after the current row covered by a rolling window
    (even centred windows lean backwards, as in pandas)."""
    if window < 1:
        raise ValueError("window must be >= 1")
    return (window // 2, (window - 1) // 2) if center else (window - 1, 0)


def halo_blocks(df: DataFrame, keys, rn: str, before: int, after: int,
                block: int | None = None) -> DataFrame:
    """Cut each entity into blocks of ``block`` consecutive row numbers and give
    every block copies of the ``before`` rows preceding it and the ``after``
    rows following it (``__halo = true``). A window over
    ``(keys, __blk) ORDER BY rn`` then sees every row it reaches within
    ``before``/``after`` rows, without partitioning by the entity alone.
    Drop the halo rows (``filter(~__halo)``) after the window."""
    B = block or max(1024, 8 * (before + after + 1))
    if before >= B or after >= B:
        raise ValueError("block must exceed the window reach")
    blk = F.floor((F.col(rn) - 1) / B).cast("long")
    pos = (F.col(rn) - 1) % B
    targets = F.array_compact(F.array(
        F.struct(blk.alias("blk"), F.lit(False).alias("halo")),
        F.when(pos >= B - before, F.struct((blk + 1).alias("blk"), F.lit(True).alias("halo"))),
        F.when(pos < after, F.struct((blk - 1).alias("blk"), F.lit(True).alias("halo"))),
    ))
    x = df.withColumn("__t", F.explode(targets))
    return x.withColumn("__blk", F.col("__t.blk")).withColumn("__halo", F.col("__t.halo")).drop("__t")


def rolling_mean(df: DataFrame, keys, ts: str, cols, window: int, center: bool = True,
                 min_periods: int | None = None, chunk="month", suffix: str = "") -> DataFrame:
    """Rolling mean over ``window`` rows.

    ``min_periods=None`` is strict (a full window of non-null values is required);
    ``min_periods=1`` is tolerant. The result replaces ``c`` (or goes to
    ``c + suffix``).

    Rows are shuffled once, by (entity, chunk). What a window reaches beyond its
    chunk, at most ``window - 1`` rows, comes from the edges of the chunks around it:
    each chunk's summary holds its first and last values, and those of the nearest
    chunks are put in front of its first and behind its last row in place."""
    keys, cols = list(keys), list(cols)
    a, b = rolling_bounds(window, center)
    need = window if min_periods is None else min_periods
    part = [*keys, CHUNK]
    d = df.withColumn(CHUNK, chunk_expr(ts, chunk)).repartition(exchange_parts(df.sparkSession), *part)
    by = Window.partitionBy(*part)
    d = d.withColumns({_LRN: F.row_number().over(by.orderBy(ts)).cast("long"), "__size": F.count(F.lit(1)).over(by)})
    value = F.struct(F.col(_LRN).alias("at"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])

    def edge(cond):
        return F.sort_array(F.collect_list(F.when(cond, value)))
    edges = d.groupBy(*part).agg(edge(F.col(_LRN) <= b).alias("__first"), edge(F.col(_LRN) > F.col("__size") - a).alias("__last"))
    along = Window.partitionBy(*keys).orderBy(CHUNK)
    none = F.filter("__first", lambda e: F.lit(False))

    def near(side, rows, over):
        """The edge values of so many chunks, each of which has a row at least, in order."""
        return F.coalesce(F.flatten(F.collect_list(side).over(over)), none) if rows else none
    edges = edges.withColumns({"__before": near("__last", a, along.rowsBetween(-a, -1)), "__after": near("__first", b, along.rowsBetween(1, b))})
    edges = edges.select(*part, F.expr(f"slice(__before, greatest(size(__before) - {a} + 1, 1), {a})").alias("__before") if a
                         else F.col("__before"), F.slice("__after", 1, b).alias("__after") if b else F.col("__after"))
    x = d.join(edges, part)

    def placed(values, first):
        return F.transform(values, lambda e, i: F.struct((first + i).cast("long").alias("at"), F.lit(True).alias("halo"),
                                                         *[e[f"v{i}"].alias(f"v{i}") for i in range(len(cols))]))
    own = F.array(F.struct(F.col(_LRN).alias("at"), F.lit(False).alias("halo"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)]))
    empty = F.filter(own, lambda e: F.lit(False))
    rows = F.concat(F.when(F.col(_LRN) == 1, placed(F.col("__before"), 1 - F.size("__before"))).otherwise(empty), own,
                    F.when(F.col(_LRN) == F.col("__size"), placed(F.col("__after"), F.col("__size") + 1)).otherwise(empty))
    x = x.withColumn("__e", F.explode(rows))
    x = x.select("*", F.col("__e.at").alias("__pos"), F.col("__e.halo").alias("__halo"),
                 *[F.col(f"__e.v{i}").alias(f"__v{i}") for i in range(len(cols))])
    w = by.orderBy("__pos").rowsBetween(-a, b)
    x = x.withColumns({c + suffix: F.when(F.count(f"__v{i}").over(w) >= need, F.avg(f"__v{i}").over(w)) for i, c in enumerate(cols)})
    return x.where("NOT __halo").select(*df.columns, *[c + suffix for c in cols if suffix])


def rolling_vector_magnitude(df: DataFrame, keys, ts: str, u: str, v: str, window: int,
                             center: bool = True, min_periods: int | None = None,
                             out: str = "speed", chunk="month") -> DataFrame:
    """Magnitude of the rolling-mean vector (average the components first)."""
    r = rolling_mean(df, keys, ts, [u, v], window, center, min_periods, chunk)
    return r.withColumn(out, F.hypot(F.col(u), F.col(v)))


# ---------------------------------------------------------------------------
# slices
# ---------------------------------------------------------------------------

def time_slice(df: DataFrame, ts: str, start, end, closed: str = "both") -> DataFrame:
    """Rows with ``start <= ts <= end`` (``closed="left"``: ``ts < end``)."""
    if start is not None and end is not None and pd.Timestamp(start) >= pd.Timestamp(end):
        raise ValueError("start must be before end")
    t = F.col(ts)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (t >= F.lit(start).cast(df.schema[ts].dataType))
    if end is not None:
        e = F.lit(end).cast(df.schema[ts].dataType)
        cond = cond & ((t <= e) if closed == "both" else (t < e))
    return df.filter(cond)


def pick_variables(df: DataFrame, keep: Sequence[str], variables: Sequence[str],
                   on_unknown: str = "error") -> DataFrame:
    """``keep`` columns plus the requested ``variables``; unknown names raise
    (``on_unknown="error"``) or are skipped with a warning (``"warn"``)."""
    unknown = [v for v in variables if v not in df.columns]
    if unknown and on_unknown == "error":
        raise ValueError(f"unknown variables: {unknown}")
    if unknown:
        import warnings
        warnings.warn(f"skipping unknown variables: {unknown}")
    return df.select(*keep, *[v for v in variables if v in df.columns])


def drop_null(df: DataFrame, cols) -> DataFrame:
    """P5: drop rows where any of ``cols`` is null."""
    return df.na.drop(subset=list(cols))
