"""Sinks: CSV (S8-S10), CF parquet (S11, S12) and model-forcing text (S13,
S14, S16).

Ordered text output is range-partitioned on ``(station, ts)`` and sorted
within partitions, so one long station is written by several tasks whose part
files, taken in name order, form the sorted series.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import forcing_line, local_to_utc, epoch_seconds, utc_to_local
from ..schema import CF_CONVENTIONS, CF_COORDINATES, CF_TIME, HOURLY_COLUMNS, LOCAL_TZ
from ..session import exchange_parts
from .files import write_station_years

FORCING_MET = [("u", 10, 5), ("v", 10, 5), ("shpa", 12, 5), ("kion", 10, 5), ("humd", 10, 5),
               ("clod", 10, 5)]


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", ts: str | None = "ts") -> None:
    """UTF-8, LF, header, time column first."""
    cols = ([ts] if ts and ts in df.columns else []) + [c for c in df.columns if c != ts]
    (df.select(*cols).write.mode(mode).option("header", True).option("encoding", "UTF-8")
       .option("lineSep", "\n").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def read_csv_back(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Re-read a frame written by :func:`write_csv` with its schema."""
    return (spark.read.schema(schema).option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def write_hourly_csv(df: DataFrame, path: str, mode: str = "errorifexists", layout: str = "partitioned") -> None:
    """Headerless 33-column archive rows, one directory per station-year; with
    ``layout="by_year"`` one per year, the station in front of the 33 columns."""
    x = df.select("station", "year", *[F.col(c).cast("string").alias(c) for c in HOURLY_COLUMNS])
    write_station_years(x, path, mode, layout, ["YYYY", "MM", "DD", "HH"])


# What a store says about itself where the caller gives nothing else.
STORE_ATTRIBUTES = {
    "institution": "not stated", "source": "hourly station archive in CSV",
    "comment": "Samples that are missing in the archive are NULL, the fill value of the store."}


def write_cf(cf: DataFrame, path: str, keys: Sequence[str] = ("station",), ts: str = "ts",
             overwrite: bool = False, global_attrs: DataFrame | None = None, attributes: dict | None = None,
             layout: str = "partitioned") -> None:
    """CF frame -> parquet partitioned by ``station, year``; local time
    stays in ``ts`` and the instant goes to ``time`` (seconds since 1970 UTC).
    Variable attributes travel in the column metadata. Other stations and years of
    the store stay as they are: a station-year that is there already is refused
    unless ``overwrite`` replaces it.

    Every batch carries its id. It is committed in this order:

    1. ``{path}/_summary`` gets one row per station-year and batch: first and last
       time, rows, and per variable the valid samples, least and greatest value;
       ``{path}/_attributes`` gets ``global_attrs`` (coordinates and the like);
    2. ``{path}/data`` gets the rows, which name their batch;
    3. ``{path}/_global`` is made again for the stations of the batch
       (:func:`refresh_global`).

    So no station-year is without its summary, and the summary of a batch that was
    not finished, or was replaced, counts nowhere. A writer that ends between 2 and
    3 leaves an old ``_global`` row; :func:`refresh_global` mends it from the
    summaries. ``cf`` is read twice; cut its lineage if it is costly.

    ``layout="by_year"`` is the same store for many stations: no folder per station in
    any of its tables, but rows that name their station, in as many files as there are
    tasks. Such files cannot be replaced by station, so every table is only added to.
    The ids of its batches ascend, and of a station-year (of a station in
    ``_attributes`` and ``_global``) the rows of the last batch count:
    :func:`read_cf` and :func:`read_global` with the same ``layout`` give those."""
    keys = list(keys)
    packed = layout == "by_year"
    batch = _next_batch(cf.sparkSession, path) if packed else uuid.uuid4().hex
    seconds = epoch_seconds(local_to_utc(F.col(ts), LOCAL_TZ)).alias("time", metadata=CF_TIME)
    out = cf.select("*", F.year(F.col(ts)).alias("year"), seconds, F.lit(batch).alias(BATCH))
    if not overwrite:
        _refuse_existing(out, f"{path}/data", [*keys, "year"])
    variables = [c for c in cf.columns if c not in (*keys, ts)]
    numeric = [c for c in variables if isinstance(cf.schema[c].dataType, T.NumericType)]
    stats = [F.struct(F.lit(c).alias("variable"), F.count(c).alias("n_valid"), F.min(c).cast("double").alias("least"),
                      F.max(c).cast("double").alias("greatest")) for c in numeric]
    summary = out.groupBy(*keys, "year", BATCH).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(F.lit(1)).alias("n"),
        (F.array(*stats) if stats else F.lit(None).cast(f"array<{STATS}>")).alias("variables"))
    summary.write.mode("append").partitionBy(*([] if packed else keys)).parquet(f"{path}/_summary")
    if global_attrs is not None:
        named = [F.col(c).alias(c, metadata=CF_COORDINATES[c]) if c in CF_COORDINATES else F.col(c) for c in global_attrs.columns]
        places = global_attrs.join(cf.select(*keys).distinct(), keys, "left_semi").select(*named)
        if packed:
            places.withColumn(BATCH, F.lit(batch)).write.mode("append").parquet(f"{path}/_attributes")
        else:
            (places.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
                .parquet(f"{path}/_attributes"))
    rows = out.repartition(*keys, "year")
    if packed:
        rows.sortWithinPartitions("year", *keys, ts).write.mode("append").partitionBy("year", BATCH).parquet(f"{path}/data")
    else:
        (rows.sortWithinPartitions(*keys, ts).write.mode("overwrite" if overwrite else "append")
            .option("partitionOverwriteMode", "dynamic").partitionBy(*keys, "year").parquet(f"{path}/data"))
    refresh_global(cf.sparkSession, path, {k: cf.schema[k].dataType for k in keys}, batch, attributes, layout)


BATCH = "batch"
STATS = "struct<variable:string,n_valid:bigint,least:double,greatest:double>"


def _next_batch(spark: SparkSession, path: str) -> str:
    """An id that sorts behind those of all batches of a store, finished or not."""
    try:
        last = spark.read.parquet(f"{path}/_summary").agg(F.max(BATCH)).first()[0]
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        last = None
    return f"{int((last or '0').split('-')[0]) + 1:012d}-{uuid.uuid4().hex}"


def _last_batch(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Of the rows of a key, the one of the last batch; ``batch`` goes."""
    rest = [c for c in df.columns if c not in (*names, BATCH)]
    last = df.groupBy(*names).agg(F.max_by(F.struct(*rest), BATCH).alias("__last"))
    return last.select(*names, *[F.col(f"__last.{c}").alias(c, metadata=df.schema[c].metadata) for c in rest])


def _live(data: DataFrame, names: Sequence[str]) -> DataFrame:
    """(names, ``year``, ``batch``): the batch whose rows a station-year holds."""
    return data.groupBy(*names, "year").agg(F.max(BATCH).alias(BATCH))


def _table(spark: SparkSession, path: str, keys: dict, columns: Sequence[str] | None = None) -> DataFrame:
    """A table of the store whose partition columns ``keys`` have the given types:
    inferred ones would turn station "0123" into 123."""
    own = [f for f in spark.read.parquet(path).schema if f.name not in keys and (columns is None or f.name in columns)]
    return spark.read.schema(T.StructType([*own, *[T.StructField(k, t) for k, t in keys.items()]])).parquet(path)


def refresh_global(spark: SparkSession, path: str, keys: dict, batch: str | None = None,
                   attributes: dict | None = None, layout: str = "partitioned") -> None:
    """Make ``{path}/_global`` again from the summaries, one row per station over
    all its years: ``time_coverage_start``, ``time_coverage_end``, ``n_times``,
    ``variables`` (merged statistics by name), the stored attributes and the global
    attributes of the conventions. ``keys``: name -> type of the key columns;
    ``batch``: only for the stations of this batch."""
    names = list(keys)
    packed = layout == "by_year"
    summary = _table(spark, f"{path}/_summary", keys)
    data = _table(spark, f"{path}/data", {**keys, "year": T.IntegerType()}, [BATCH])
    if batch is not None:
        touched = summary.where(F.col(BATCH) == batch).select(*names).distinct()
        summary, data = (x.join(touched, names, "left_semi") for x in (summary, data))
    # a station-year holds the rows of one batch: only that one's summary counts
    live = summary.join(_live(data, names), [*names, "year", BATCH])
    merged = (live.select(*names, F.inline("variables")).groupBy(*names, "variable")
              .agg(F.sum("n_valid").alias("n_valid"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))
              .groupBy(*names).agg(F.sort_array(F.collect_list(F.struct("variable", "n_valid", "least", "greatest"))).alias("variables")))
    out = live.groupBy(*names).agg(F.min("first").alias("time_coverage_start"), F.max("last").alias("time_coverage_end"),
                                   F.sum("n").alias("n_times")).join(merged, names, "left")
    try:
        places = _table(spark, f"{path}/_attributes", keys)
        out = out.join(_last_batch(places, names) if packed else places, names, "left")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    station = F.concat_ws(" ", *[F.col(k).cast("string") for k in names])
    now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    texts = {"Conventions": CF_CONVENTIONS, "history": f"{now} written by skyframe", **STORE_ATTRIBUTES, **(attributes or {})}
    out = out.withColumns({"title": F.concat(F.lit("Hourly surface observations, station "), station), "station_id": station,
                           **{k: F.lit(v) for k, v in texts.items()}})
    if packed:
        out.withColumn(BATCH, F.lit(batch or _next_batch(spark, path))).write.mode("append").parquet(f"{path}/_global")
        return
    (out.repartition(*names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*names).parquet(f"{path}/_global"))


def read_global(spark: SparkSession, path: str, keys: Sequence[str] = ("station",), layout: str = "partitioned") -> DataFrame:
    """The global rows of a store, one per station."""
    out = spark.read.parquet(f"{path}/_global")
    return _last_batch(out, list(keys)) if layout == "by_year" else out


def _refuse_existing(out: DataFrame, path: str, keys: list[str]) -> None:
    """Raise when the store at ``path`` holds one of the partitions of ``out``."""
    try:
        there = out.sparkSession.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return
        raise
    both = there.select(*[F.col(k).cast("string") for k in keys]).distinct().join(
        out.select(*[F.col(k).cast("string") for k in keys]).distinct(), keys, "left_semi")
    found = both.limit(5).collect()
    if found:
        raise FileExistsError(f"{path} already holds {[tuple(r) for r in found]}")


def read_cf(spark: SparkSession, path: str, variables: Sequence[str] | None = None,
            stations: Sequence[str] | None = None, time_tz: str | None = None, layout: str = "partitioned",
            keys: Sequence[str] = ("station",)) -> DataFrame:
    """Load time-dependent variables (NULL is the fill value); unknown
    variables are an error. ``time_tz`` adds ``time_local`` in that zone. A store
    written ``by_year`` is read with that ``layout``."""
    df = spark.read.parquet(f"{path}/data")
    if layout == "by_year":
        # the batch is a folder: one alone in its year has replaced nothing there
        batches = df.select("year", BATCH).distinct().groupBy("year").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not batches.isEmpty():
            live = _live(df, keys).select(*[F.col(c).alias(f"__l_{c}") for c in (*keys, "year", BATCH)])
            same = [F.col(c).eqNullSafe(F.col(f"__l_{c}")) for c in (*keys, "year", BATCH)]
            df = df.join(live, same, "left_semi")
    df = df.drop(BATCH)
    if stations is not None:
        df = df.filter(F.col("station").isin(list(stations)))
    if variables is not None:
        unknown = [v for v in variables if v not in df.columns]
        if unknown:
            raise ValueError(f"unknown variables: {unknown}")
        df = df.select("station", "year", "ts", "time", *variables)
    if time_tz:
        utc = F.timestamp_seconds(F.col("time")).cast("timestamp_ntz")
        df = df.withColumn("time_local", utc_to_local(utc, time_tz))
    return df


def _ordered_text(df: DataFrame, keys: Sequence[str], ts: str, lines: dict, path: str, mode: str, layout: str) -> None:
    """``lines``: name of an output -> parts of its line; an output with a name is the first of the
    keys. The numbers go through the range exchange, once for all outputs; the lines are made of
    sorted rows as they are written, and each key's lines of a file follow each other.

    ``layout="partitioned"``: text below one folder per key; ``layout="packed"``, for many
    keys: gzipped CSV of keys and line, of which :func:`read_lines` gives the lines back."""
    keys = list(keys)
    x = df.select(*dict.fromkeys([*keys, ts, *[c for parts in lines.values() for c, _, _ in parts]]))
    # grid rows compress so well that adaptive execution would put millions in a task
    count = [exchange_parts(df.sparkSession)] if layout == "packed" else []
    x = x.repartitionByRange(*count, *keys, ts)
    made = [(name, forcing_line(ts, parts)) for name, parts in lines.items()]
    line = made[0][1]
    if made[0][0] is not None:
        x = x.withColumn("output", F.explode(F.array(*[F.lit(name) for name, _ in made])))
        keys = ["output", *keys]
        line = F.coalesce(*[F.when(F.col("output") == name, own) for name, own in made])
    x = x.sortWithinPartitions(*keys, ts).select(*keys, line.alias("value"))
    if layout == "packed":
        (x.write.mode(mode).option("header", False).option("lineSep", "\n").option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False).option("compression", "gzip").csv(path))
    else:
        x.write.mode(mode).partitionBy(*keys).text(path)


def export_forcing(df: DataFrame, var: str, path: str, width: int | None = 10, decimals: int | None = 5,
                   keys: Sequence[str] = ("station",), ts: str = "ts", mode: str = "errorifexists",
                   layout: str = "partitioned") -> None:
    """``"{ts} {value:W.Df}"`` lines for one variable, per station."""
    _ordered_text(df, keys, ts, {None: [(var, width, decimals)]}, path, mode, layout)


def export_forcing_met(df: DataFrame, path: str, keys: Sequence[str] = ("station",), ts: str = "ts",
                       mode: str = "errorifexists", layout: str = "partitioned") -> None:
    """``ts u v shpa kion humd clod`` in the fixed widths of the model."""
    _ordered_text(df, keys, ts, {None: FORCING_MET}, path, mode, layout)


def export_forcing_batch(df: DataFrame, path: str, keys: Sequence[str] = ("station",), ts: str = "ts",
                         mode: str = "errorifexists", layout: str = "partitioned") -> None:
    """Irradiance (``10.5f``), precipitation (full value: m/s are small
    numbers) and the meteorological forcing for all stations of ``df``, as
    ``output=slht``, ``output=kous`` and ``output=met``. The rows go through one range
    exchange, as numbers; the three lines of a row are made behind it."""
    lines = {"slht": [("slht", 10, 5)], "kous": [("kous", None, None)], "met": FORCING_MET}
    _ordered_text(df, keys, ts, lines, path, mode, layout)


def read_lines(spark: SparkSession, path: str, keys: Sequence[str] = ("station",), layout: str = "partitioned") -> DataFrame:
    """(keys, ``value``): the lines of an ordered text output, an absent one empty as in a text file."""
    if layout == "packed":
        schema = T.StructType([T.StructField(k, T.StringType()) for k in [*keys, "value"]])
        return spark.read.schema(schema).option("header", False).csv(path).withColumn("value", F.coalesce("value", F.lit("")))
    return spark.read.option("basePath", path).text(path)


def read_ordered(spark: SparkSession, path: str, keys: Sequence[str] = ("station",), layout: str = "partitioned") -> DataFrame:
    """(keys, ``line_no``, ``line``): the lines of an ordered text output with their
    place, 1, 2, ..., in the files of a key taken in name order. Rows of a file
    part are read in order, so their numbers come from a count per part and the
    place within it; no key's lines pass through one task."""
    keys = list(keys)
    part = [*keys, "__file", "__start"]
    rows = read_lines(spark, path, keys, layout).select(
        *keys, F.col("value").alias("line"), F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__at"))
    before = Window.partitionBy(*keys).orderBy("__file", "__start").rowsBetween(Window.unboundedPreceding, -1)
    parts = (rows.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
             .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    # the parts are hashed, which spares sorting the lines; Spark must not go by the size of gzipped files
    return rows.join(parts.hint("shuffle_hash"), part).select(*keys, (F.col("__before") + F.col("__at") - F.col("__first") + 1).alias("line_no"), "line")
