"""Vendor CSV dialect (S6) and its conversion to the hourly archive layout
(F-15..F-20, P6, S10): ``{base}{year}/{station}_{year}.csv`` with a Japanese
header, symbols in cells and compass words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vendor as VD
from ..operators.quality import any_flags
from ..schema import (HOURLY_COLUMNS, HOURLY_VARIABLES, VENDOR_DEFAULT_RMK, VENDOR_DROP_COLUMNS,
                      VENDOR_ID_OFFSET, VENDOR_TIMES_10, VENDOR_TIMES_100, VENDOR_TO_HOURLY, rmk_col)
from .files import FOLDERS, existing

RADIATION = "全天日射量(MJ/㎡)"
SUNSHINE = "日照時間(h)"
DATE = "日付"
HOUR = "時"
WIND_WORD = "風向"
ANY_YEAR = ["[0-9][0-9][0-9][0-9]"]


def read_vendor_csv(spark: SparkSession, base: str, stations: Sequence[str] | None = None,
                    years: Sequence[int] | None = None, layout: str = "vendor") -> DataFrame:
    """Every cell as text; ``station`` and ``year`` from the path.
    ``layout="vendor"``: ``{base}{year}/{station}_{year}.csv``;
    ``layout="partitioned"``: ``{base}/station=../year=../*.csv`` (pruned on both);
    ``layout="by_year"``: ``{base}/year=../*.csv`` with a column ``station``."""
    if layout in FOLDERS:
        df = (spark.read.option("header", True).option("inferSchema", False)
              .option("basePath", base).csv(base))
        df = df.withColumn("station", F.col("station").cast("string")) \
               .withColumn("year", F.col("year").cast("int"))
        if stations is not None:
            df = df.filter(F.col("station").isin(list(stations)))
        if years is not None:
            df = df.filter(F.col("year").isin([int(y) for y in years]))
        return df
    base = base.rstrip("/") + "/"
    patterns = existing(spark, [f"{base}{y}/{s}_{y}.csv" for y in (ANY_YEAR if years is None else years)
                                for s in (["*"] if stations is None else stations)])
    df = spark.read.option("header", True).option("inferSchema", False).csv(patterns)
    path = F.col("_metadata.file_path")
    return (df.withColumn("station", F.regexp_extract(path, r"/([^/]+)_(\d{4})\.csv$", 1))
              .withColumn("year", F.regexp_extract(path, r"_(\d{4})\.csv$", 1).try_cast("int")))


def zero_fill_many(df: DataFrame, keys: Sequence[str], cols: dict) -> DataFrame:
    """F-16 for several columns with one aggregation and one join: for each
    ``col -> quality column``, NULL -> 0 when the group (station-year) has any
    non-null value, quality 2 on the filled rows, 8 on observed rows; an
    all-null group keeps NULL with quality 0."""
    keys = list(keys)
    flags = any_flags(df, keys, {f"__any_{i}": F.col(c).isNotNull() for i, c in enumerate(cols)})
    out = df.join(flags, on=keys, how="left")
    ex = {}
    for i, (c, q) in enumerate(cols.items()):
        flag = F.col(f"__any_{i}")
        ex[q] = (F.when(~flag, F.lit(0)).when(F.col(c).isNull(), F.lit(2))
                  .otherwise(F.lit(VENDOR_DEFAULT_RMK)))
        ex[c] = F.when(flag & F.col(c).isNull(), F.lit(0.0)).otherwise(F.col(c))
    return out.withColumns(ex).drop(*[f"__any_{i}" for i in range(len(cols))])


def zero_fill(df: DataFrame, keys: Sequence[str], col: str, tag: str = "z") -> tuple[DataFrame, str]:
    """F-16 for one column; returns the frame and the quality column it adds."""
    q = f"__q_{tag}"
    return zero_fill_many(df, keys, {col: q}), q


def vendor_to_hourly(df: DataFrame, keys: Sequence[str] = ("station", "year"),
                     extra: Sequence[str] = ()) -> DataFrame:
    """Vendor rows -> the 33 archive columns (plus ``station``, ``year``).

    Cells are cleaned (F-15), radiation and sunshine zero-filled per
    station-year (F-16), compass words coded (F-17), the id shifted and values
    scaled to the archive's integer units (F-18), the date split (F-19), absent
    columns created as all-null (the weather code with quality 0, F-20) and
    every other quality column set to 8 (P6). ``keys`` is the zero-fill group,
    ``extra`` columns are passed through."""
    keys = list(keys)
    present = [c for c in df.columns if c not in VENDOR_DROP_COLUMNS]
    x = df.select(*present)
    numeric = [c for c in VENDOR_TO_HOURLY if c not in ("名称", WIND_WORD) and c in x.columns]
    for c in numeric:
        x = x.withColumn(c, VD.clean_number(c))
    for c in (RADIATION, SUNSHINE):
        if c not in x.columns:
            x = x.withColumn(c, F.lit(None).cast("double"))
    q_rad, q_sun = "__q_rad", "__q_sun"
    x = zero_fill_many(x, keys, {RADIATION: q_rad, SUNSHINE: q_sun})
    y, m, d = VD.split_date(DATE)
    sel = {
        "KanID": (F.col("観測所ID") - VENDOR_ID_OFFSET).cast("int"),
        "Kname": F.col("名称"),
        "KanID_1": (F.col("観測所ID") - VENDOR_ID_OFFSET).cast("int"),
        "YYYY": y, "MM": m, "DD": d, "HH": VD.clean_cell(HOUR).try_cast("int"),
    }
    for src, dst in VENDOR_TO_HOURLY.items():
        if dst in ("KanID_1", "Kname"):
            continue
        if src == WIND_WORD:
            e = VD.compass_code(VD.clean_cell(src)) if src in x.columns else F.lit(None)
        elif src in VENDOR_TIMES_10:
            e = VD.times(src, 10)
        elif src in VENDOR_TIMES_100:
            e = VD.times(src, 100)
        elif src in x.columns:
            e = F.round(F.col(src)).cast("int")
        else:
            e = F.lit(None)
        sel[dst] = e.cast("int")
    for v in HOURLY_VARIABLES:
        sel.setdefault(v, F.lit(None).cast("int"))
        sel[rmk_col(v)] = F.lit(VENDOR_DEFAULT_RMK)
    sel[rmk_col("slht")] = F.col(q_rad)
    sel[rmk_col("lght")] = F.col(q_sun)
    sel[rmk_col("tnki")] = F.lit(0)
    return x.select(*extra, *keys, *[sel[c].alias(c) for c in HOURLY_COLUMNS])
