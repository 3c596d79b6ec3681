"""Quality operators over whole frames: RMK masking (F-7), per-entity validity
flags (A5), night zero by quality code (F-8), wind rules (F-9) and night zero
by solar elevation (F-13).

Per-entity flags are a ``groupBy`` (partial aggregation before the shuffle)
joined back on the keys. The flag table has one row per entity; the join is a
plain equi-join so adaptive execution can broadcast it when its measured size
is small, and falls back to a shuffle join (with skew splitting) otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quality import masked, rmk_int, wind_rule_columns
from ..functions.solar import is_night
from ..functions.text import local_to_utc
from ..schema import (HOURLY_VARIABLES, NIGHT_RMK_VARIABLES, RMK_MISSING, RMK_VALID,
                      missing_rmk_codes, rmk_col)


def mask_rmk(df: DataFrame, variables: Sequence[str] = HOURLY_VARIABLES,
             policy: str = "mask", universal: bool = False) -> DataFrame:
    """F-7: NULL every value whose quality code means missing.

    Default sets: 0,1,2 (0,1 for sunshine and irradiance, whose 2 means night).
    ``universal=True`` uses 0,1,2 for every variable (the CF step).
    ``policy="none"`` leaves values unchanged (the archive reader's literal
    behaviour when codes are numeric, see README)."""
    if policy == "none":
        return df
    ex = {}
    for v in variables:
        if v in df.columns and rmk_col(v) in df.columns:
            codes = RMK_MISSING if universal else missing_rmk_codes(v)
            ex[v] = masked(v, rmk_col(v), codes)
    return df.withColumns(ex)


def any_flags(df: DataFrame, keys: Sequence[str], flags: dict) -> DataFrame:
    """A5: ``groupBy(keys)`` of ``bool_or`` flags: name -> boolean Column."""
    return df.groupBy(*keys).agg(*[F.bool_or(F.coalesce(e, F.lit(False))).alias(n)
                                   for n, e in flags.items()])


def has_valid_obs(df: DataFrame, keys: Sequence[str],
                  variables: Sequence[str] = NIGHT_RMK_VARIABLES) -> DataFrame:
    """A5: per entity, whether each variable has any quality code 8."""
    return any_flags(df, keys, {f"{v}_has_valid": rmk_int(rmk_col(v)) == RMK_VALID
                                for v in variables})


def night_zero_by_rmk(df: DataFrame, keys: Sequence[str],
                      variables: Sequence[str] = NIGHT_RMK_VARIABLES) -> DataFrame:
    """F-8: value 0 where the quality code is 2 (night), but only for entities
    with at least one code 8 for that variable (an instrument exists)."""
    keys = list(keys)
    variables = [v for v in variables if v in df.columns]
    flags = has_valid_obs(df, keys, variables)
    out = df.join(flags, on=keys, how="left")
    ex = {}
    for v in variables:
        cond = F.col(f"{v}_has_valid") & (rmk_int(rmk_col(v)) == 2)
        ex[v] = F.when(F.coalesce(cond, F.lit(False)), F.lit(0.0)).otherwise(F.col(v))
    return out.withColumns(ex).select(*df.columns)


def wind_rules(df: DataFrame, muki: str = "muki", sped: str = "sped",
               compat: bool = False) -> DataFrame:
    """F-9 over a frame (see :func:`skyframe.functions.quality.wind_rule_columns`)."""
    m, s = wind_rule_columns(muki, rmk_col(muki), sped, rmk_col(sped), compat)
    return df.withColumns({muki: m, sped: s})


def enforce_night_zero(df: DataFrame, keys: Sequence[str], ts: str, lat: str, lon: str,
                       cols: Sequence[str], tz: str = "Asia/Tokyo") -> DataFrame:
    """F-13: sunshine/irradiance 0 at night (apparent solar elevation <= 0),
    but only for entities that have any non-null daytime value of that column."""
    keys = list(keys)
    night = is_night(local_to_utc(F.col(ts), tz), F.col(lat), F.col(lon))
    x = df.withColumn("__night", night)
    flags = any_flags(x, keys, {f"__day_{c}": (~F.col("__night")) & F.col(c).isNotNull()
                                for c in cols})
    out = x.join(flags, on=keys, how="left")
    out = out.withColumns({c: F.when(F.col("__night") & F.coalesce(F.col(f"__day_{c}"), F.lit(False)),
                                     F.lit(0.0).cast(df.schema[c].dataType)).otherwise(F.col(c))
                           for c in cols})
    return out.select(*df.columns)
