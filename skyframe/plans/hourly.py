"""The hourly archive chain (S1 -> J1 -> F-7 -> P1 -> F-2..F-4 -> W5 -> J5/W1).

``clean_hourly`` returns the three frames of the reference reader for all
stations at once: ``org`` (grid + mask + physical units), ``interp`` (time
interpolation on the original interval) and ``hourly`` (strict hourly grid,
measures interpolated in time, quality codes and identifiers forward-filled).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import units as U
from ..operators import grid as GR
from ..operators import quality as QL
from ..operators import series as SR
from ..schema import HOURLY_VARIABLES, rmk_col
from ..session import cut_lineage

ID_COLUMNS = ["KanID", "Kname", "KanID_1"]


def to_physical(df: DataFrame, keep_code: bool = True) -> DataFrame:
    """F-2..F-4: packed units -> physical units, direction code -> math angle,
    wind components ``u, v``. The original direction code stays in
    ``muki_code`` (code 0 and code 16 share the angle 270)."""
    ex = {}
    if keep_code and "muki" in df.columns:
        ex["muki_code"] = U.num("muki").cast("int")
    for v, div in U.HOURLY_DIVISORS.items():
        if v in df.columns:
            ex[v] = U.scale(v, div)
    if "muki" in df.columns:
        ex["muki"] = U.code_to_math_angle("muki")
    if "tnki" in df.columns:
        ex["tnki"] = U.num("tnki")
    if "slht" in df.columns:
        ex["slht"] = U.irradiance_w_m2("slht")
    if "kous" in df.columns:
        ex["kous"] = U.precip_m_s("kous")
    out = df.withColumns(ex)
    if "muki" in df.columns and "sped" in df.columns:
        u, v = U.math_uv("sped", "muki")
        out = out.withColumns({"u": u, "v": v})
    return out


def clean_hourly(raw: DataFrame, start=None, end=None, keys: Sequence[str] = ("station",),
                 ts: str = "ts", rmk_policy: str = "mask", interpolate: bool = True,
                 circular: bool = False, categorical: Sequence[str] = (),
                 chunk: str = "month") -> dict[str, DataFrame]:
    """Reader chain for many stations. ``raw`` has ``keys, ts`` and the 33
    archive columns (Y/M/D/HH may be absent)."""
    keys = list(keys)
    cols = [c for c in raw.columns if c not in ("YYYY", "MM", "DD", "HH")]
    raw = raw.select(*cols)
    ids = [c for c in ID_COLUMNS if c in raw.columns]
    rmks = [rmk_col(v) for v in HOURLY_VARIABLES if rmk_col(v) in raw.columns]
    clip = (start, end) if start is not None and end is not None else None
    g = GR.regularize(raw, keys, ts, bounds="year", fill={r: 0 for r in rmks}, carry=ids, clip=clip)
    g = QL.mask_rmk(g, policy=rmk_policy)
    if start is not None or end is not None:
        g = SR.time_slice(g, ts, start, end)
    org = to_physical(g)
    if not interpolate:
        return {"org": org}
    measures = [v for v in HOURLY_VARIABLES + ["u", "v"] if v in org.columns
                and v not in categorical]
    org = cut_lineage(org, "hourly-org")
    interp = SR.interpolate(org, keys, ts, measures, "time", chunk=chunk,
                            ffill_cols=list(categorical))
    # Strict hourly grid over the requested range. Linear-in-time interpolation
    # composes, so filling the hourly grid straight from the original samples
    # equals interpolating on the original interval first and upsampling after;
    # quality codes and identifiers are forward-filled in the same pass.
    base = org.select(*keys, ts, *measures, *categorical, *rmks, *ids)
    if start is not None and end is not None:
        hourly = GR.upsample(base, keys, ts, start, end)
    else:
        hourly = GR.regularize(base, keys, ts, "1 hour")
    hourly = SR.interpolate(hourly, keys, ts, measures, "time", chunk=chunk,
                            ffill_cols=rmks + ids + list(categorical))
    if circular and "u" in hourly.columns:
        angle = F.pmod(F.degrees(F.atan2(F.col("v"), F.col("u"))), F.lit(360.0)) + 0.0
        hourly = hourly.withColumn("muki", F.when(F.col("u").isNotNull(), angle))
        interp = interp.withColumn("muki", F.when(F.col("u").isNotNull(),
                                                  F.pmod(F.degrees(F.atan2("v", "u")), F.lit(360.0)) + 0.0))
    return {"org": org, "interp": interp, "hourly": hourly}
