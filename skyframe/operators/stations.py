"""Station catalogue operators: select by name (P2), metadata join (J4),
catalogue coverage (J6) and key uniqueness (A10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def select_station(catalogue: DataFrame, name: str, column: str = "name_en") -> DataFrame:
    """Catalogue rows whose name equals ``name`` (empty when absent)."""
    return catalogue.filter(F.col(column) == F.lit(name))


def lookup_station(catalogue: DataFrame, name: str, column: str = "name_en") -> DataFrame:
    """O3: the first catalogue row with that name (at most one row)."""
    return select_station(catalogue, name, column).limit(1)


def attach_station_meta(obs: DataFrame, catalogue: DataFrame, on, how: str = "left") -> DataFrame:
    """Latitude, longitude, altitude etc. onto observations. Adaptive
    execution broadcasts the catalogue when its measured size is small."""
    return obs.join(catalogue, on=on, how=how)


def catalogue_missing(data_names: DataFrame, catalogue: DataFrame, data_col: str,
                      cat_col: str) -> DataFrame:
    """Distinct data names that the catalogue does not know (anti join)."""
    d = data_names.select(F.col(data_col).alias("__n")).distinct()
    return d.join(catalogue.select(F.col(cat_col).alias("__n")), on="__n", how="left_anti") \
            .withColumnRenamed("__n", data_col)


def code_disagreements(data: DataFrame, catalogue: DataFrame, name: str, data_code: str,
                       cat_code: str) -> DataFrame:
    """Rows whose code differs from the catalogue code of the same name."""
    return data.join(catalogue.select(name, F.col(cat_code).alias("__cat")), on=name) \
               .filter(F.col(data_code) != F.col("__cat"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A10: keys occurring more than once, with their count (empty = unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, after a check (one job) that no key occurs twice; raises
    with a few of the repeated keys otherwise."""
    found = duplicate_keys(df, keys).limit(5).collect()
    if found:
        raise ValueError(f"repeated keys: {[tuple(r) for r in found]}")
    return df


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the other columns in their order (nulls
    first). Combined before the shuffle, so many copies of a key are one row."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    least = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__least"))
    return least.select(*[F.col(c) if c in keys else F.col(f"__least.{c}").alias(c) for c in df.columns])
