"""Station catalogue (S7): CSV with a leading ``#`` comment line and a header;
columns renamed and coordinates decoded from ``DD.MMSS``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.units import ddmmss_to_decimal
from ..schema import STATION_COLUMNS


def load_stations(spark: SparkSession, path: str, decode: bool = True) -> DataFrame:
    df = (spark.read.option("header", True).option("comment", "#").option("encoding", "UTF-8")
          .csv(path))
    sel = []
    for src, dst in STATION_COLUMNS.items():
        c = F.trim(F.col(src))
        if dst in ("name_en", "name_ja"):
            sel.append(c.alias(dst))
        elif dst == "kanid":
            sel.append(c.try_cast("int").alias(dst))
        elif dst in ("lat", "lon") and decode:
            sel.append(ddmmss_to_decimal(c.try_cast("double")).alias(dst))
        else:
            sel.append(c.try_cast("double").alias(dst))
    return df.select(*sel)
