"""Incremental ingest of hourly archive files with Structured Streaming.

New ``{station}/{station}{year}.csv`` files under ``root`` are picked up by the
file source; each row is typed, time-stamped, quality-masked and converted to
physical units (all row-local rules) and appended to parquet partitioned by
``station, year``. Order-dependent steps (grid, interpolation, gap reports)
then run as batch jobs over the appended table. The checkpoint location makes
the stream restartable after a driver or executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import mask_rmk
from ..plans.hourly import to_physical
from ..schema import hourly_raw_schema
from ..sources.hourly import _typed


def hourly_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(hourly_raw_schema()).option("header", False)
         .option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(f"{root.rstrip('/')}/*/*.csv")
    path = F.col("_metadata.file_path")
    df = (df.withColumn("station", F.regexp_extract(path, r"/([^/]+)/[^/]*?(\d{4})\.csv$", 1))
            .withColumn("year", F.regexp_extract(path, r"(\d{4})\.csv$", 1).try_cast("int")))
    return to_physical(mask_rmk(_typed(df)))


def start_ingest(spark: SparkSession, root: str, out_path: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """Start the append stream; ``available_now`` processes what is there and stops."""
    w = (hourly_stream(spark, root).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("station", "year"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(out_path)
