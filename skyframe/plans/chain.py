"""The create -> report -> fill chain for many stations in one job.

1. read the requested station-years, grid them and convert to the CF frame
   (quality rules, night zero by code, wind rules, SI units), with night zero
   by solar elevation when a station catalogue is given;
2. unless skipped, the missing-sample report (first ``missing_limit`` per
   station and variable, plus totals);
3. unless skipped, the bounded gap fill (``max_gap`` rows, time
   interpolation by default) and its statistics;
4. write the (filled) CF frame partitioned by station and year.

The CF frame is materialised once in the shared checkpoint folder, so the
report, the fill and the write all start from it instead of re-reading and
re-gridding the archive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gaps as GP
from ..operators import quality as QL
from ..operators import report as RP
from ..operators import stations as OS
from ..schema import CF_SOURCE, rmk_col
from ..session import cut_lineage
from ..sources import hourly as H
from ..sources import sinks as SK
from .cf import NIGHT_ZERO_CF, cf_variables, summarize_missing, to_cf

# Defaults of the reference's shell chain.
DEFAULT_START = "2010-01-01 00:00:00"
DEFAULT_END = "2024-01-01 00:00:00"
DEFAULT_MAX_GAP = 24
DEFAULT_MISSING_LIMIT = 20


def run_station_chain(spark: SparkSession, hourly_root: str, out_path: str | None,
                      stations: Sequence[str], start: str = DEFAULT_START, end: str = DEFAULT_END,
                      max_gap: int = DEFAULT_MAX_GAP, missing_limit: int = DEFAULT_MISSING_LIMIT,
                      method: str = "time", skip_check: bool = False,
                      skip_interpolate: bool = False, catalogue: DataFrame | None = None,
                      overwrite: bool = False, compat: bool = False,
                      layout: str = "archive", variables: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Returns ``{"cf", "summary", "report", "gap_stats", "filled"}`` (absent
    entries when skipped); writes ``filled`` (or ``cf``) when ``out_path`` is set.
    ``variables`` restricts the report and the fill (default: all CF variables).
    The report carries the quality code of the archive variable behind each CF
    variable (of the wind speed for the wind components)."""
    start, end = H.parse_bounds(start, end)          # date-only bounds get 00:00:00
    raw = H.read_hourly(spark, hourly_root, None if stations is None else list(stations), start, end,
                        units="raw", rmk_policy="none", layout=layout)
    codes = {v: rmk_col(CF_SOURCE.get(v, "sped")) for v in cf_variables()}
    code_columns = list(dict.fromkeys(codes.values()))
    cf = to_cf(raw, ["station"], "ts", compat=compat, extra=code_columns)
    if catalogue is not None:
        meta = catalogue.select(F.col("name_en").alias("station"), "lat", "lon", "elev_m")
        cf = OS.attach_station_meta(cf, meta, on="station", how="left")
        cf = QL.enforce_night_zero(cf, ["station"], "ts", "lat", "lon", list(NIGHT_ZERO_CF))
    coded = cut_lineage(cf, "cf")
    cf = coded.drop(*code_columns)
    out: dict[str, DataFrame] = {"cf": cf, "summary": summarize_missing(cf)}
    chosen = list(cf_variables() if variables is None else variables)
    unknown = [v for v in chosen if v not in codes]
    if unknown:
        raise ValueError(f"unknown variables: {unknown}")
    if not skip_check:
        out["report"] = RP.missing_report(coded, ["station"], "ts", chosen, missing_limit, rmk=codes)
    result = cf
    if not skip_interpolate:
        result = GP.fill_max_gap(cf, ["station"], "ts", chosen, max_gap, method)
        out["filled"] = result
        long = GP.to_long(cf, ["station"], "ts", chosen)
        out["gap_stats"] = GP.gap_stats(long, ["station", "variable"], "ts", "value", max_gap)
    if out_path:
        attrs = None
        if catalogue is not None:
            attrs = catalogue.select(F.col("name_en").alias("station"), "kanid", "lat", "lon", "elev_m")
        keep = ["station", "ts", *cf_variables()]
        SK.write_cf(result.select(*keep), out_path, overwrite=overwrite, global_attrs=attrs)
    return out
