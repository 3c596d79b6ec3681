"""Scalar functions: coordinate decode (catalogue tests of the reference),
wind codes and components, unit conversions, text formats."""

import math

import pytest
from pyspark.sql import functions as F

from skyframe.functions import text as TX
from skyframe.functions import units as U
from skyframe.functions import vendor as VD

DECODE = [
    (35.2612, 35 + 26 / 60 + 12 / 3600),
    (139.3918, 139 + 39 / 60 + 18 / 3600),
    (44.01, 44 + 1 / 60),
    (144.17, 144 + 17 / 60),
    (31.343, 31 + 34 / 60 + 30 / 3600),
    (-35.2612, -(35 + 26 / 60 + 12 / 3600)),
    (0.0, 0.0),
]


def _one(spark, expr, value, dtype="double"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,expected", DECODE)
def test_ddmmss_decode(spark, raw, expected):
    assert abs(_one(spark, U.ddmmss_to_decimal, raw) - expected) < 1e-9


@pytest.mark.parametrize("raw", [35.6500, 35.0061])
def test_ddmmss_invalid_null(spark, raw):
    assert _one(spark, U.ddmmss_to_decimal, raw) is None


def test_ddmmss_invalid_raise(spark):
    df = spark.createDataFrame([(35.65,)], "x double")
    with pytest.raises(Exception):
        df.select(U.ddmmss_to_decimal("x", mode="raise")).collect()


def test_ddmmss_null_and_nan(spark):
    assert _one(spark, U.ddmmss_to_decimal, None) is None
    assert _one(spark, U.ddmmss_to_decimal, float("nan")) is None


def test_math_angle_codes(spark):
    df = spark.createDataFrame([(c,) for c in [0, 4, 8, 12, 16]], "c int")
    got = [r.a for r in df.select(U.code_to_math_angle("c").alias("a")).collect()]
    assert got == [270.0, 180.0, 90.0, 0.0, 270.0]
    assert all(math.copysign(1, a) > 0 for a in got)


def test_from_direction_codes(spark):
    df = spark.createDataFrame([(c,) for c in [0, 1, 4, 8, 12, 16]], "c int")
    got = [r.a for r in df.select(U.code_to_from_direction("c").alias("a")).collect()]
    assert got == [None, 22.5, 90.0, 180.0, 270.0, 0.0]


def test_uv_paths_agree(spark):
    """Math-angle components and from-direction components describe the same wind."""
    rows = [(c, s) for c in range(1, 17) for s in (0.0, 1.5, 7.2)]
    df = spark.createDataFrame(rows, "c int, s double")
    u1, v1 = U.math_uv("s", U.code_to_math_angle("c"))
    u2, v2 = U.from_uv("s", U.code_to_from_direction("c"))
    for r in df.select(u1.alias("u1"), v1.alias("v1"), u2.alias("u2"), v2.alias("v2"), "s").collect():
        assert abs(r.u1 - r.u2) < 1e-9 and abs(r.v1 - r.v2) < 1e-9
        assert abs(math.hypot(r.u1, r.v1) - r.s) < 1e-9


def test_calm_components(spark):
    df = spark.createDataFrame([(None, 0.0), (None, 2.0), (90.0, None)], "d double, s double")
    u, v = U.from_uv("s", "d")
    got = [(r.u, r.v) for r in df.select(u.alias("u"), v.alias("v")).collect()]
    assert got == [(0.0, 0.0), (None, None), (None, None)]


def test_hourly_units(spark):
    df = spark.createDataFrame([("10132", "36", "1", "abc")], "p string, slht string, kous string, bad string")
    r = df.select(U.scale("p", 10.0).alias("p"), U.irradiance_w_m2("slht").alias("i"),
                  U.precip_m_s("kous").alias("k"), U.scale("bad", 10.0).alias("b")).first()
    assert r.p == 1013.2 and abs(r.i - 100.0) < 1e-12 and abs(r.k - 1e-4 / 3600) < 1e-18
    assert r.b is None


def test_cf_and_display(spark):
    df = spark.createDataFrame([(10.0, 1013.2, 0.5)], "c double, p double, h double")
    r = df.select(U.cf_value("c_to_k", "c").alias("k"), U.cf_value("hpa_to_pa", "p").alias("pa"),
                  U.cf_value("h_to_s", "h").alias("s")).first()
    assert r.k == 283.15 and r.pa == 101320.0 and r.s == 1800.0
    d = spark.createDataFrame([(r.k, r.pa)], "k double, pa double").select(
        U.display_value("K", "k").alias("c"), U.display_value("Pa", "pa").alias("h")).first()
    assert abs(d.c - 10.0) < 1e-9 and abs(d.h - 1013.2) < 1e-9


def test_precip_cf_default_and_compat(spark):
    df = spark.createDataFrame([(2e-7,)], "x double")
    r = df.select(U.cf_value("precip", "x").alias("a"), U.cf_value("precip", "x", compat=True).alias("b")).first()
    assert abs(r.a - 2e-4) < 1e-15 and r.b == 2e-7


def test_fixed_width_and_iso(spark):
    df = spark.createDataFrame([(1.5, None)], "a double, b double")
    r = df.select(TX.fixed("a", 10, 5).alias("a"), TX.fixed("b", 10, 5).alias("b"),
                  TX.iso_or_na(F.lit(None).cast("timestamp_ntz")).alias("n")).first()
    assert r.a == f"{1.5:10.5f}" and r.b == f"{float('nan'):10.5f}" and r.n == "N/A"


def test_local_to_utc(spark):
    df = spark.createDataFrame([("2024-01-01 09:00:00",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("t"))
    r = df.select(TX.local_to_utc("t").alias("u"), TX.epoch_seconds(TX.local_to_utc("t")).alias("e")).first()
    assert str(r.u) == "2024-01-01 00:00:00" and r.e == 1704067200


def test_vendor_cells(spark):
    cells = ["×", "///", "#", "", "0+", "10-", " -- ", "12.3)", "4.5]", "7"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r.v for r in df.select(VD.clean_number("c").alias("v")).collect()]
    assert got == [None, None, None, None, 0.0, 10.0, 0.0, 12.3, 4.5, 7.0]


def test_compass_words(spark):
    df = spark.createDataFrame([("北北東",), ("北",), ("静穏",), ("?",)], "w string")
    assert [r.c for r in df.select(VD.compass_code("w").alias("c")).collect()] == [1, 16, 0, None]
