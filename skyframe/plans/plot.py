"""Plot preparation (3.4): display units -> range filter -> rolling mean ->
every n-th sample; vector variables get the magnitude of the averaged
components and a symmetric range. Drawing itself is not part of the library."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.units import display_value
from ..operators import aggregates as AG
from ..operators import series as SR
from .cf import cf_metadata


def display_units(cf: DataFrame, variables: Sequence[str]) -> DataFrame:
    """F-11 on CF columns (K -> degC, Pa -> hPa, others unchanged)."""
    ex = {}
    for v in variables:
        try:
            units = cf_metadata(v)["units"]
        except KeyError:
            units = ""
        ex[v] = display_value(units, F.col(v).cast("double"))
    return cf.withColumns(ex)


def prepare_timeseries(cf: DataFrame, variables: Sequence[str], start=None, end=None,
                       window: int | None = None, every: int | None = None,
                       keys: Sequence[str] = ("station",), ts: str = "ts",
                       strict: bool = False) -> DataFrame:
    """The filter comes before the rolling mean, so edge windows are
    recomputed from the selected range only. ``strict=False`` is the
    tolerant rolling mean (``min_periods=1``)."""
    keys = list(keys)
    x = display_units(cf.select(*keys, ts, *variables), variables)
    if start is not None or end is not None:
        x = SR.time_slice(x, ts, start, end)
    if window:
        x = SR.rolling_mean(x, keys, ts, variables, window, True, None if strict else 1)
    if every and every > 1:
        x = SR.every_nth(x, keys, ts, every)
    return x


def prepare_vector(cf: DataFrame, u: str, v: str, start=None, end=None, window: int | None = None,
                   every: int | None = None, keys: Sequence[str] = ("station",),
                   ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Vector series (components and magnitude of the averaged components) and
    its per-station value ranges."""
    keys = list(keys)
    x = cf.select(*keys, ts, F.col(u).cast("double").alias(u), F.col(v).cast("double").alias(v))
    if start is not None or end is not None:
        x = SR.time_slice(x, ts, start, end)
    if window:
        x = SR.rolling_vector_magnitude(x, keys, ts, u, v, window, True, 1)
    else:
        x = x.withColumn("speed", F.hypot(u, v))
    if every and every > 1:
        x = SR.every_nth(x, keys, ts, every)
    return x, AG.vector_range(x, keys, u, v)
