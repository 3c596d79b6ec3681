"""Path helpers: scans that read only the requested station-year files."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# Folders of a written table. "partitioned" has one per station and year, which suits some
# hundred stations; each folder is a file to make, to list and to open. "by_year" packs the
# stations of a year into as many files as there are tasks and names the station in the rows.
FOLDERS = {"partitioned": ["station", "year"], "by_year": ["year"]}


def existing(spark: SparkSession, patterns: Iterable[str]) -> list[str]:
    """Keep the glob patterns that match at least one file (metadata listing on
    the driver through the Hadoop file system of each path; no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in patterns:
        path = jvm.org.apache.hadoop.fs.Path(p)
        st = path.getFileSystem(conf).globStatus(path)
        if st is not None and len(st) > 0:
            out.append(p)
    return out


def year_glob(years: Iterable[int]) -> str:
    ys = sorted(set(int(y) for y in years))
    return "{" + ",".join(str(y) for y in ys) + "}" if len(ys) > 1 else str(ys[0])


def scan_station_years(spark: SparkSession, root: str, schema: StructType, stations: Sequence[str] | None = None,
                       years: Iterable[int] | None = None) -> DataFrame:
    """CSV rows of the files ``{root}/{station}/{station}{year}.csv`` plus ``station``
    and ``year``, taken from the path. Null ``stations`` or ``years`` mean all.

    The station folders are listed once, by Spark's own listing job where they are
    many, whatever the request: names of other years are left out while listing, and
    the condition on the station reads the file path only, so the scan drops other
    stations' files before it opens them. Files of other names are no archive files."""
    root = root.rstrip("/")
    wanted = year_glob(years) if years is not None else "[0-9][0-9][0-9][0-9]"
    if existing(spark, [f"{root}/*"]):
        df = (spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE")
              .option("pathGlobFilter", f"*{wanted}.csv").csv(f"{root}/*"))
        path, name = F.col("_metadata.file_path"), r"/([^/]+)/\1(\d{4})\.csv$"
        df = df.withColumns({"station": F.regexp_extract(path, name, 1),
                             "year": F.regexp_extract(path, name, 2).try_cast("int")})
    else:
        df = spark.createDataFrame([], schema).withColumns({"station": F.lit(""), "year": F.lit(None).cast("int")})
    return df.where(F.col("station") != "" if stations is None else F.col("station").isin(list(stations)))


def scan_written(spark: SparkSession, root: str, schema: StructType, layout: str, stations: Sequence[str] | None = None,
                 years: Iterable[int] | None = None) -> DataFrame:
    """Headerless CSV rows written under ``FOLDERS[layout]``, plus ``station`` and
    ``year``; the columns that are no folder stand in front of those of ``schema``.
    The types are given: inferred ones would turn station "0123" into 123."""
    named = [StructField("station", StringType()), StructField("year", IntegerType())]
    folders = [f for f in named if f.name in FOLDERS[layout]]
    fields = [*[f for f in named if f not in folders], *schema.fields, *folders]
    df = (spark.read.schema(StructType(fields)).option("header", False).option("mode", "PERMISSIVE")
          .option("basePath", root).csv(root)).select(*schema.names, "station", "year")
    if stations is not None:
        df = df.filter(F.col("station").isin(list(stations)))
    if years is not None:
        df = df.filter(F.col("year").between(min(years), max(years)))
    return df


def write_station_years(df: DataFrame, path: str, mode: str = "errorifexists", layout: str = "partitioned",
                        order: Sequence[str] = (), header: bool = False) -> None:
    """Rows with ``station`` and ``year`` as CSV under ``FOLDERS[layout]``, in this order."""
    folders = FOLDERS[layout]
    own = [c for c in ("station", "year") if c not in folders]
    w = (df.select(*own, *[c for c in df.columns if c not in own]).repartition("station", "year")
         .sortWithinPartitions(*folders, *own, *order).write.mode(mode).partitionBy(*folders)
         .option("header", header).option("lineSep", "\n"))
    if own:       # a name in a folder keeps its blanks, so does one in a row
        w = w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    w.csv(path)
