"""CF conversion step: universal RMK mask -> night zero by quality code ->
wind calm/missing rules -> SI/CF units with from-direction wind components ->
optional night zero by solar elevation -> missing summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import units as U
from ..operators import quality as QL
from ..operators import report as RP
from ..schema import CF_SOURCE, CF_UNITS, CF_WIND_COMPONENTS

NIGHT_ZERO_CF = ("duration_of_sunshine", "surface_downwelling_shortwave_flux_in_air")


def cf_metadata(name: str) -> dict:
    return {"standard_name": name, "long_name": name.replace("_", " "), "units": CF_UNITS[name]}


def to_cf(raw_grid: DataFrame, keys: Sequence[str] = ("station",), ts: str = "ts",
          compat: bool = False, round_trig: int | None = None,
          extra: Sequence[str] = ()) -> DataFrame:
    """Gridded raw archive rows (packed units, quality codes) -> CF frame
    ``keys, ts, <12 CF variables>, eastward_wind, northward_wind`` as FLOAT with
    CF attributes in the column metadata.

    Default semantics: the wind direction is the meteorological from-direction
    of the code (calm code 0 -> NULL); precipitation is converted to
    kg m-2 s-1. ``compat=True`` keeps the literal reference behaviour
    (math angle exported as from-direction, precipitation left in m s-1,
    calm rules on converted units)."""
    keys = list(keys)
    x = QL.mask_rmk(raw_grid, universal=True)
    x = QL.night_zero_by_rmk(x, keys)
    if compat:
        from ..plans.hourly import to_physical
        x = to_physical(x.withColumn("muki", F.col("muki").cast("double")), keep_code=False)
        x = x.withColumn("sped", F.col("sped"))
        x = QL.wind_rules(x, compat=True).withColumn("wdir", F.col("muki"))
    else:
        x = QL.wind_rules(x)
        x = x.withColumn("wdir", U.code_to_from_direction("muki"))
        for v, div in U.HOURLY_DIVISORS.items():
            x = x.withColumn(v, U.scale(v, div))
        x = x.withColumn("slht", U.irradiance_w_m2("slht")).withColumn("kous", U.precip_m_s("kous"))
    sel = [F.col(k) for k in keys] + [F.col(ts)]
    for name, source in CF_SOURCE.items():
        e = U.cf_value(U.CF_CONVERSION.get(source), "wdir" if source == "muki" else source, compat)
        sel.append(e.cast("float").alias(name, metadata=cf_metadata(name)))
    u, w = U.from_uv("sped", "wdir")
    if round_trig is not None:
        u, w = F.round(u, round_trig), F.round(w, round_trig)
    sel.append(u.cast("float").alias("eastward_wind", metadata=cf_metadata("eastward_wind")))
    sel.append(w.cast("float").alias("northward_wind", metadata=cf_metadata("northward_wind")))
    sel += [F.col(c) for c in extra]
    return x.select(*sel)


def cf_variables() -> list[str]:
    return [*CF_SOURCE, *CF_WIND_COMPONENTS]


def summarize_missing(cf: DataFrame, keys: Sequence[str] = ("station",)) -> DataFrame:
    """A1 on the CF frame."""
    return RP.missing_summary(cf, keys, cf_variables())
