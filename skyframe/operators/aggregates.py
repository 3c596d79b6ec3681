"""Value ranges for scalar and vector variables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_range(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Minimum and maximum (NULLs ignored) per entity."""
    return df.groupBy(*keys).agg(F.min(col).alias("vmin"), F.max(col).alias("vmax"))


def vector_range(df: DataFrame, keys: Sequence[str], u: str, v: str) -> DataFrame:
    """Min/max of both components, maximum magnitude and the symmetric
    magnitude range ``[-max, +max]`` used for plotting."""
    mag = F.hypot(F.col(u), F.col(v))
    return (df.groupBy(*keys)
              .agg(F.min(u).alias("u_min"), F.max(u).alias("u_max"),
                   F.min(v).alias("v_min"), F.max(v).alias("v_max"),
                   F.max(mag).alias("mag_max"))
              .withColumn("mag_min", -F.col("mag_max")))
