"""Text and time helpers: F-14 local <-> UTC, F-21 fixed-width numbers,
F-22 ISO text with N/A, F-25 date-only strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import LOCAL_TZ

ISO_FMT = "yyyy-MM-dd HH:mm:ss"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def local_to_utc(ts, tz: str = LOCAL_TZ) -> Column:
    """F-14: local wall-clock TIMESTAMP_NTZ -> UTC wall-clock TIMESTAMP_NTZ."""
    return F.to_utc_timestamp(_c(ts).cast("timestamp"), tz).cast("timestamp_ntz")


def utc_to_local(ts, tz: str = LOCAL_TZ) -> Column:
    return F.from_utc_timestamp(_c(ts).cast("timestamp"), tz).cast("timestamp_ntz")


def epoch_seconds(ts_utc) -> Column:
    """Seconds since 1970-01-01 00:00 UTC of a UTC wall-clock timestamp."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(ts_utc))


def iso_or_na(ts) -> Column:
    """F-22: ``YYYY-MM-DD HH:MM:SS`` or ``N/A`` for NULL."""
    return F.coalesce(F.date_format(_c(ts), ISO_FMT), F.lit("N/A"))


def parse_local(text) -> Column:
    """F-25: ``YYYY-MM-DD[ HH:MM:SS]`` -> TIMESTAMP_NTZ (date only -> 00:00:00)."""
    return F.to_timestamp_ntz(_c(text))


def fixed(x, width: int | None, decimals: int | None = 5) -> Column:
    """F-21: ``{x:W.Df}``; NULL prints ``nan`` right-aligned, as Python does.
    Without a width the full value is printed."""
    if width is None:
        return F.coalesce(_c(x).cast("string"), F.lit("nan"))
    spec = f"%{width or ''}.{decimals}f"
    nan = F.lpad(F.lit("nan"), width, " ") if width else F.lit("nan")
    return F.when(_c(x).isNull(), nan).otherwise(F.format_string(spec, _c(x)))


def forcing_line(ts, parts: list[tuple[str, int | None, int]]) -> Column:
    """S13/S14 line: ``"{ts} {v1:fmt} {v2:fmt} ..."``."""
    out = [F.date_format(_c(ts), ISO_FMT)]
    for c, w, d in parts:
        out.append(fixed(c, w, d))
    return F.concat_ws(" ", *out)
