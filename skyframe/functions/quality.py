"""Quality-code (RMK) column rules: F-7 masking and F-9 wind calm/missing rules,
plus F-24 code descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import RMK_DESCRIPTION, RMK_DIR_NOT_OBSERVED, RMK_MISSING, RMK_VALID


def rmk_int(c) -> Column:
    """Quality codes compared as integers (text and number forms collapse)."""
    x = F.col(c) if isinstance(c, str) else c
    return x.try_cast("int")


def masked(value, rmk, codes=RMK_MISSING) -> Column:
    """F-7: NULL where the quality code is in ``codes``."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(~F.coalesce(rmk_int(rmk).isin(*codes), F.lit(False)), v)


def describe_rmk(rmk) -> Column:
    """F-24: quality code -> description."""
    pairs = []
    for k, v in sorted(RMK_DESCRIPTION.items()):
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), rmk_int(rmk))


def wind_rule_columns(muki, muki_rmk, sped, sped_rmk, compat: bool = False):
    """F-9: apply, in order, (1) calm by data, (2) both missing, (3) calm by code.

    Default: ``muki`` is the direction *code* and ``sped`` the raw speed in
    0.1 m/s; rule 1 is code 0 with speed <= 3 (0.3 m/s); rule 3 nulls the
    direction. ``compat=True`` reproduces the literal reference: ``muki`` is the
    converted math angle, rule 1 tests angle 0 and speed <= 3 in the converted
    unit, rule 3 sets the angle to 0.

    Returns (muki, sped) expressions.
    """
    m, s = F.col(muki), F.col(sped)
    mr, sr = rmk_int(muki_rmk), rmk_int(sped_rmk)
    calm1 = (m == 0) & (mr == RMK_VALID) & (s <= 3) & (sr == RMK_VALID)
    dir_missing = mr.isin(*RMK_DIR_NOT_OBSERVED)
    both_missing = dir_missing & sr.isin(*RMK_MISSING)
    calm3 = dir_missing & (sr == RMK_VALID)
    calm1 = F.coalesce(calm1, F.lit(False))
    both_missing = F.coalesce(both_missing, F.lit(False))
    calm3 = F.coalesce(calm3, F.lit(False))
    s1 = F.when(calm1, F.lit(0.0)).otherwise(s.cast("double"))
    m2 = F.when(both_missing, F.lit(None)).otherwise(m)
    s2 = F.when(both_missing, F.lit(None)).otherwise(s1)
    m3 = F.when(calm3, F.lit(0) if compat else F.lit(None)).otherwise(m2)
    s3 = F.when(calm3, F.lit(0.0)).otherwise(s2)
    return m3.cast("double"), s3
