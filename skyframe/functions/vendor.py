"""Vendor CSV dialect cell rules: F-15 cleanup, F-17 compass words,
F-18 scaling, F-19 date split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import CALM_WORD, COMPASS_WORDS, VENDOR_NULL_TOKENS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_cell(x) -> Column:
    """F-15 (+ S6 null tokens): tokens ``×``, ``///``, ``#`` and blank -> NULL;
    exact ``0+`` -> ``0`` and ``10-`` -> ``10``; `` -- `` (with any spaces) -> ``0``;
    ``)`` and ``]`` quality marks removed."""
    s = _c(x).cast("string")
    s = F.when(~s.isin(*VENDOR_NULL_TOKENS), s)
    s = F.when(s == "0+", F.lit("0")).when(s == "10-", F.lit("10")).otherwise(s)
    s = F.regexp_replace(s, r"\s*--\s*", "0")
    return F.regexp_replace(s, r"[\)\]]", "")


def clean_number(x) -> Column:
    v = clean_cell(x).try_cast("double")
    return F.when(~F.isnan(v), v)


def compass_code(word) -> Column:
    """F-17: 16 compass words -> 1..16, calm -> 0, anything else NULL."""
    pairs = []
    for k, v in COMPASS_WORDS.items():
        pairs += [F.lit(k), F.lit(v)]
    pairs += [F.lit(CALM_WORD), F.lit(0)]
    return F.element_at(F.create_map(*pairs), _c(word))


def times(x, factor: int) -> Column:
    """F-18: x * factor rounded to the archive's integer unit."""
    return F.round(_c(x) * factor).cast("int")


def split_date(text) -> tuple[Column, Column, Column]:
    """F-19: ``Y/M/D`` -> (year, month, day) integers."""
    p = F.split(_c(text), "/")
    return (p.getItem(0).try_cast("int"), p.getItem(1).try_cast("int"),
            p.getItem(2).try_cast("int"))
