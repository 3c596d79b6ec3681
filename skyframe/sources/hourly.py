"""Hourly archive reader (S1-S4): ``{root}/{station}/{station}{year}.csv``,
no header, 33 positional columns.

One CSV scan over the requested station-year files; the station and year come
from the file path (``_metadata.file_path``). Values stay text until the unit
conversion (``try_cast``), so blank or malformed cells become NULL instead of
failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import parse_local
from ..operators.series import time_slice
from ..schema import HOURLY_VARIABLES, hourly_raw_schema, rmk_col
from .files import FOLDERS, scan_station_years, scan_written


def _dt(x):
    if x is None or isinstance(x, datetime):
        return x
    s = str(x)
    return datetime.fromisoformat(s if len(s) > 10 else s + " 00:00:00")


def year_span(start, end, pad: int = 1) -> list[int]:
    """Years to read: start-1 .. end+1 (an end of Jan 1 00:00 does not need its
    own year, only the pad)."""
    s, e = _dt(start), _dt(end)
    ys, ye = s.year, e.year
    if (e.month, e.day, e.hour, e.minute, e.second) == (1, 1, 0, 0, 0):
        ye -= 1
    return list(range(ys - pad, ye + pad + 1))


def build_ts(y, m, d, hh):
    """date(Y, M, D) + HH hours; HH = 24 rolls to the next day 00:00."""
    base = F.make_timestamp_ntz(y, m, d, F.lit(0), F.lit(0), F.lit(0))
    return F.timestamp_add("HOUR", hh, base)


def read_hourly_raw(spark: SparkSession, root: str, stations: Sequence[str] | None = None,
                    start=None, end=None, pad: int = 1, layout: str = "archive") -> DataFrame:
    """S1 + S2: typed raw rows ``station, year, ts`` + the 33 columns (values as
    text, quality codes as INT). ``stations=None`` reads every station.

    ``layout="archive"``: ``{root}/{station}/{station}{year}.csv``;
    ``layout="partitioned"``: ``{root}/station=../year=../*.csv`` as written by
    :func:`skyframe.sources.sinks.write_hourly_csv` (partition pruning on both);
    ``layout="by_year"``: ``{root}/year=../*.csv`` of the same writer, for many
    stations (partition pruning on the year, the station stands in the rows)."""
    years = year_span(start, end, pad) if start is not None and end is not None else None
    if layout in FOLDERS:
        return _typed(scan_written(spark, root, hourly_raw_schema(), layout, stations, years))
    return _typed(scan_station_years(spark, root, hourly_raw_schema(), stations, years))


def station_years(spark: SparkSession, root: str, layout: str = "archive") -> DataFrame:
    """(station, year) of the files below ``root``. The files are listed, not read;
    of the layout ``by_year``, whose files hold many stations, the names are read."""
    if layout == "by_year":
        return (scan_written(spark, root, hourly_raw_schema(), layout).select("station", "year")
                .where(F.col("year").isNotNull()).distinct())
    path = F.col("path")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.csv").load(root).select("path"))
    pattern = r"/station=([^/]+)/year=(\d+)/[^/]+$" if layout == "partitioned" else r"/([^/]+)/[^/]*?(\d{4})\.csv$"
    return (files.select(F.regexp_extract(path, pattern, 1).alias("station"),
                         F.regexp_extract(path, pattern, 2).try_cast("int").alias("year"))
            .where(F.col("year").isNotNull()).distinct())


def absent_station_years(spark: SparkSession, root: str, requested: DataFrame,
                         layout: str = "archive") -> DataFrame:
    """The (station, year) rows of ``requested`` that have no file: what a read
    of them leaves out."""
    asked = requested.select(F.col("station").cast("string"), F.col("year").cast("int")).distinct()
    return asked.join(station_years(spark, root, layout), ["station", "year"], "left_anti")


def _typed(df: DataFrame) -> DataFrame:
    ints = ["KanID", "KanID_1", "YYYY", "MM", "DD", "HH"] + [rmk_col(v) for v in HOURLY_VARIABLES]
    out = df.withColumns({c: F.trim(F.col(c)).try_cast("int") for c in ints})
    return out.withColumn("ts", build_ts(F.col("YYYY"), F.col("MM"), F.col("DD"), F.col("HH")))


def read_hourly(spark: SparkSession, root: str, stations: Sequence[str] | None = None,
                start=None, end=None, raw: bool = False, units: str = "physical",
                rmk_policy: str = "mask", interpolate: bool = True,
                layout: str = "archive") -> dict[str, DataFrame] | DataFrame:
    """S1-S4. ``raw=True``: original rows in ``[start, end]`` without any
    editing (S3). Otherwise the reader chain of
    :func:`skyframe.plans.hourly.clean_hourly`; ``units="raw"`` stops after
    grid + mask (S4)."""
    df = read_hourly_raw(spark, root, stations, start, end, layout=layout)
    if raw:
        return time_slice(df, "ts", start, end) if start is not None else df
    from ..operators.grid import regularize
    from ..operators.quality import mask_rmk
    from ..plans.hourly import clean_hourly, ID_COLUMNS
    if units == "raw":
        rmks = [rmk_col(v) for v in HOURLY_VARIABLES]
        clip = (start, end) if start is not None and end is not None else None
        g = regularize(df.drop("year", "YYYY", "MM", "DD", "HH"), ["station"], "ts", bounds="year",
                       fill={r: 0 for r in rmks}, carry=ID_COLUMNS, clip=clip)
        g = mask_rmk(g, policy=rmk_policy)
        return time_slice(g, "ts", start, end) if start is not None else g
    return clean_hourly(df.drop("year"), start, end, ["station"], "ts", rmk_policy, interpolate)


def parse_bounds(start: str, end: str):
    """F-25 on the driver: date-only bounds get 00:00:00; start must precede end."""
    s, e = _dt(start), _dt(end)
    if s >= e:
        raise ValueError("start must be before end")
    return s.strftime("%Y-%m-%d %H:%M:%S"), e.strftime("%Y-%m-%d %H:%M:%S")


__all__ = ["read_hourly", "read_hourly_raw", "build_ts", "year_span", "parse_bounds", "parse_local"]
