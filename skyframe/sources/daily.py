"""Daily archive reader (S5) and daily cleaning (A8, D1, D2):
``{root}/{station}/{station}{year}.csv``, 63 positional columns; only the
requested years are read (no padding)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import units as U
from ..functions.quality import masked
from ..operators.series import time_slice
from ..schema import DAILY_PAIRS, daily_raw_schema, rmk_col
from .files import FOLDERS, scan_station_years, scan_written
from .hourly import _dt

DAILY_MISSING_RMK = (0, 1)


def read_daily_raw(spark: SparkSession, root: str, stations: Sequence[str] | None = None,
                   start=None, end=None, layout: str = "archive") -> DataFrame:
    """``layout="archive"`` (``{root}/{station}/{station}{year}.csv``) or
    ``layout="partitioned"`` (``{root}/station=../year=../*.csv``) or
    ``layout="by_year"`` (``{root}/year=../*.csv``, the station in front)."""
    years = list(range(_dt(start).year, _dt(end).year + 1)) if start and end else None
    if layout in FOLDERS:
        df = scan_written(spark, root, daily_raw_schema(), layout, stations, years).drop("year")
    else:
        df = scan_station_years(spark, root, daily_raw_schema(), stations, years).drop("year")
    for c in ["KanID", "KanID_1", "YYYY", "MM", "DD"] + [rmk_col(p) for p in DAILY_PAIRS]:
        df = df.withColumn(c, F.trim(F.col(c)).try_cast("int"))
    df = df.withColumn("date", F.make_timestamp_ntz("YYYY", "MM", "DD", F.lit(0), F.lit(0), F.lit(0)))
    if start is not None:
        df = time_slice(df, "date", start, end)
    return df


def daily_units(df: DataFrame) -> DataFrame:
    """D1 + D2: daily packed units -> physical, both direction codes -> math
    angle, vectors from max and mean speed with the max-wind direction.
    ``minRhum`` stays in percent, as in the archive reader."""
    out = df
    for c, div in U.DAILY_DIVISORS.items():
        if c in df.columns:
            out = out.withColumn(c, U.scale(c, div))
    for c in U.DAILY_ANGLES:
        if c in df.columns:
            out = out.withColumn(c, U.code_to_math_angle(c))
    if "sunlght" in df.columns:
        out = out.withColumn("sunlght", U.daily_irradiance_w_m2("sunlght", F.year("date")))
    for c in ("talSnow", "daySnow", "minRhum"):
        if c in df.columns:
            out = out.withColumn(c, U.num(c))
    umax, vmax = U.math_uv("maxSped", "maxMuki")
    u, v = U.math_uv("avrSped", "maxMuki")
    return out.withColumn("umax", umax).withColumn("vmax", vmax).withColumn("u", u).withColumn("v", v)


def daily_clean(df: DataFrame) -> DataFrame:
    """Null values whose quality code is 0 or 1 (2 is kept)."""
    out = df
    for p in DAILY_PAIRS:
        if p in df.columns and rmk_col(p) in df.columns:
            out = out.withColumn(p, masked(p, rmk_col(p), DAILY_MISSING_RMK))
    return out


def read_daily(spark: SparkSession, root: str, stations=None, start=None, end=None,
               layout: str = "archive") -> dict:
    """``{"org": converted, "clean": converted and masked}``."""
    raw = read_daily_raw(spark, root, stations, start, end, layout)
    org = daily_units(raw)
    return {"org": org, "clean": daily_units(daily_clean(raw))}
