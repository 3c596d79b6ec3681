"""Series operators: hand-worked fixtures, pandas equivalence, invariants and
chunk-border behaviour."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyframe.operators import gaps as GP
from skyframe.operators import grid as GR
from skyframe.operators import series as SR

BASE = dt.datetime(2024, 1, 31, 20)


def series(spark, vals, hours=None, key=1):
    hours = hours or list(range(len(vals)))
    rows = [(key, BASE + dt.timedelta(hours=h), None if v is None else float(v)) for h, v in zip(hours, vals)]
    return spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double")


def values(df):
    return [r.v for r in df.orderBy("k", "ts").collect()]


@pytest.mark.parametrize("chunk", ["day", "month"])
def test_interpolate_time_fixture(spark, chunk):
    df = series(spark, [None, 1, None, None, 4, None, None])
    assert values(SR.interpolate(df, ["k"], "ts", ["v"], "time", chunk=chunk)) == [None, 1, 2, 3, 4, 4, 4]
    assert values(SR.interpolate(df, ["k"], "ts", ["v"], "time", "inside", chunk)) == \
        [None, 1, 2, 3, 4, None, None]


def test_time_vs_linear_on_uneven_grid(spark):
    df = series(spark, [0, None, 4], [0, 1, 4])
    assert values(SR.interpolate(df, ["k"], "ts", ["v"], "time")) == [0, 1, 4]
    assert values(SR.interpolate(df, ["k"], "ts", ["v"], "linear")) == [0, 2, 4]


def test_nearest_tie_goes_earlier(spark):
    df = series(spark, [1, None, 3])
    assert values(SR.interpolate(df, ["k"], "ts", ["v"], "nearest")) == [1, 1, 3]
    assert values(SR.interpolate(df, ["k"], "ts", ["v"], "zero")) == [1, 1, 3]


def test_rolling_fixtures(spark):
    df = series(spark, list(range(8)))
    assert values(SR.rolling_mean(df, ["k"], "ts", ["v"], 4)) == [None, None, 1.5, 2.5, 3.5, 4.5, 5.5, None]
    assert values(SR.rolling_mean(df, ["k"], "ts", ["v"], 4, min_periods=1)) == \
        [0.5, 1, 1.5, 2.5, 3.5, 4.5, 5.5, 6]
    df2 = series(spark, [1, None, 3, 4, 5])
    assert values(SR.rolling_mean(df2, ["k"], "ts", ["v"], 3)) == [None, None, None, 4, None]
    assert values(SR.rolling_mean(df2, ["k"], "ts", ["v"], 3, min_periods=1)) == [1, 2, 3.5, 4, 4.5]


def test_rolling_matches_pandas_across_blocks(spark):
    rnd = random.Random(7)
    vals = [None if rnd.random() < 0.2 else rnd.uniform(-5, 5) for _ in range(300)]
    df = series(spark, vals)
    s = pd.Series(vals, dtype="float64")
    for w, mp in [(5, None), (4, None), (7, 1), (2, 1), (1, None), (61, 1)]:        # 61 rows reach over three days
        got = values(SR.rolling_mean(df, ["k"], "ts", ["v"], w, min_periods=mp, chunk="day"))
        exp = s.rolling(w, center=True, min_periods=mp).mean()
        for g, e in zip(got, exp):
            assert (g is None and np.isnan(e)) or abs(g - e) < 1e-9


def test_interp_matches_pandas(spark):
    rnd = random.Random(3)
    hours = sorted(rnd.sample(range(2000), 400))
    vals = [None if rnd.random() < 0.3 else rnd.uniform(0, 10) for _ in hours]
    df = series(spark, vals, hours)
    idx = pd.DatetimeIndex([BASE + dt.timedelta(hours=h) for h in hours])
    s = pd.Series(vals, index=idx, dtype="float64")
    for method in ["time", "linear"]:
        got = values(SR.interpolate(df, ["k"], "ts", ["v"], method, chunk="day"))
        exp = s.interpolate(method=method)
        for g, e in zip(got, exp):
            assert (g is None and np.isnan(e)) or abs(g - e) < 1e-9


def test_ffill_bfill_and_invariants(spark):
    vals = [None, 1, None, None, 4, None, 6, None]
    df = series(spark, vals)
    assert values(SR.ffill(df, ["k"], "ts", ["v"], chunk="day")) == [None, 1, 1, 1, 4, 4, 6, 6]
    assert values(SR.bfill(df, ["k"], "ts", ["v"], chunk="day")) == [1, 1, 4, 4, 4, 6, 6, None]
    g = GP.gap_info(df, ["k"], "ts", ["v"], chunk="day").orderBy("ts").collect()
    assert [r.v_gap_len for r in g] == [1, 0, 2, 2, 0, 1, 0, 1]
    assert [r.v_gap_pos for r in g] == ["head", None, "inside", "inside", None, "inside", None, "tail"]
    t = GP.gap_table(df, ["k"], "ts", "v", chunk="day")
    assert sum(r.gap_len for r in t.collect()) == sum(v is None for v in vals)


def test_all_null_series(spark):
    df = series(spark, [None, None, None])
    g = GP.gap_table(df, ["k"], "ts", "v").collect()
    assert len(g) == 1 and g[0].gap_len == 3 and g[0].position == "all"


def test_fill_max_gap_and_stats(spark):
    vals = [None, 1, None, None, 4, None, None, None, None, 9, None]
    df = series(spark, vals)
    got = values(GP.fill_max_gap(df, ["k"], "ts", ["v"], 2, "time", chunk="day"))
    assert got == [None, 1, 2, 3, 4, None, None, None, None, 9, None]
    st = GP.gap_stats(df, ["k"], "ts", "v", 2, chunk="day").first()
    assert (st.total_missing, st.fillable, st.unfillable, st.actually_filled) == (8, 4, 4, 2)
    assert GP.gap_alerts(df, ["k"], "ts", "v", 2).count() == 1


def test_every_nth(spark):
    df = series(spark, list(range(10)))
    assert values(SR.every_nth(df, ["k"], "ts", 4, chunk="day")) == [0, 4, 8]
    with pytest.raises(ValueError):
        SR.every_nth(df, ["k"], "ts", 0)


def test_time_slice_inclusive(spark):
    df = series(spark, list(range(5)))
    s = SR.time_slice(df, "ts", "2024-01-31 21:00:00", "2024-01-31 23:00:00")
    assert values(s) == [1, 2, 3]
    s2 = SR.time_slice(df, "ts", "2024-01-31 21:00:00", "2024-01-31 23:00:00", closed="left")
    assert values(s2) == [1, 2]
    with pytest.raises(ValueError):
        SR.time_slice(df, "ts", "2024-02-01", "2024-01-01")


def _pchip_np(x, y, xq):
    """Monotone cubic Hermite (Fritsch-Carlson slopes with the one-sided
    three-point end rule), straight from the published algorithm."""
    h = np.diff(x)
    m = np.diff(y) / h
    n = len(x)
    d = np.zeros(n)
    if n == 2:
        d[:] = m[0]
    else:
        for k in range(1, n - 1):
            if np.sign(m[k - 1]) != np.sign(m[k]) or m[k - 1] == 0 or m[k] == 0:
                d[k] = 0
            else:
                w1, w2 = 2 * h[k] + h[k - 1], h[k] + 2 * h[k - 1]
                d[k] = (w1 + w2) / (w1 / m[k - 1] + w2 / m[k])

        def edge(h0, h1, m0, m1):
            e = ((2 * h0 + h1) * m0 - h0 * m1) / (h0 + h1)
            if np.sign(e) != np.sign(m0):
                return 0.0
            if np.sign(m0) != np.sign(m1) and abs(e) > 3 * abs(m0):
                return 3 * m0
            return e
        d[0] = edge(h[0], h[1], m[0], m[1])
        d[-1] = edge(h[-1], h[-2], m[-1], m[-2])
    return _herm(x, y, d, xq)


def _akima_np(x, y, xq):
    n = len(x)
    m = np.empty(n + 3)
    m[2:-2] = np.diff(y) / np.diff(x)
    m[1] = 2 * m[2] - m[3]
    m[0] = 2 * m[1] - m[2]
    m[-2] = 2 * m[-3] - m[-4]
    m[-1] = 2 * m[-2] - m[-3]
    t = 0.5 * (m[3:] + m[:-3])
    dm = np.abs(np.diff(m))
    f1, f2 = dm[2:], dm[:-2]
    f12 = f1 + f2
    ind = f12 > 1e-9 * np.max(f12)
    t[ind] = (f1[ind] * m[1:-2][ind] + f2[ind] * m[2:-1][ind]) / f12[ind]
    return _herm(x, y, t, xq)


def _herm(x, y, d, xq):
    out = []
    for q in xq:
        k = np.searchsorted(x, q) - 1
        h = x[k + 1] - x[k]
        t = (q - x[k]) / h
        out.append((2 * t**3 - 3 * t**2 + 1) * y[k] + (t**3 - 2 * t**2 + t) * h * d[k]
                   + (-2 * t**3 + 3 * t**2) * y[k + 1] + (t**3 - t**2) * h * d[k + 1])
    return out


@pytest.mark.parametrize("method,ref", [("pchip", _pchip_np), ("akima", _akima_np)])
def test_hermite_fills_match_numpy(spark, method, ref):
    rnd = random.Random(11)
    n = 120
    vals = [rnd.uniform(0, 10) for _ in range(n)]
    holes = set(rnd.sample(range(2, n - 2), 30))
    obs = [None if i in holes else v for i, v in enumerate(vals)]
    df = series(spark, obs)
    got = values(GP.fill_max_gap(df, ["k"], "ts", ["v"], 3, method, chunk="day"))
    x = np.array([3600.0 * i for i, v in enumerate(obs) if v is not None])
    y = np.array([v for v in obs if v is not None])
    info = GP.gap_info(df, ["k"], "ts", ["v"]).orderBy("ts").collect()
    targets = [i for i, r in enumerate(info) if r.v is None and r.v_gap_len <= 3 and r.v_gap_pos == "inside"]
    exp = ref(x, y, [3600.0 * i for i in targets])
    for i, e in zip(targets, exp):
        assert abs(got[i] - e) < 1e-7
    for i, v in enumerate(obs):
        if v is not None:
            assert got[i] == v


def test_grid_year_rule(spark):
    rows = [("A", dt.datetime(1990, 6, 1, 3)), ("A", dt.datetime(1991, 1, 1, 0)),
            ("B", dt.datetime(2020, 3, 1, 5)), ("B", dt.datetime(2021, 1, 1, 0))]
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz")
    g = GR.grid_frame(df, ["s"], "ts", bounds="year")
    counts = {r.s: r.n for r in g.groupBy("s").count().withColumnRenamed("count", "n").collect()}
    assert counts["A"] == 365 * 8          # 1990, 3-hourly, 03:00 .. next 00:00
    assert counts["B"] == 366 * 24         # 2020 is a leap year; 01:00 .. next 00:00
    first = g.filter("s = 'A'").agg({"ts": "min"}).first()[0]
    assert first == dt.datetime(1990, 1, 1, 3)


def test_regularize_fill_and_carry(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 0), 5.0, 8, "x"), (1, dt.datetime(2024, 1, 1, 3), 6.0, 8, "x")]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double, rmk int, name string")
    r = GR.regularize(df, ["k"], "ts", fill={"rmk": 0}, carry=["name"]).orderBy("ts").collect()
    assert [x.rmk for x in r] == [8, 0, 0, 8] and all(x.name == "x" for x in r)
    assert GR.missing_rows(df, ["k"], "ts").count() == 2
    cov = GR.coverage(df, ["k"], "ts").first()
    assert cov.step_seconds == 3 * 3600 and cov.end_ts == dt.datetime(2024, 1, 1, 6)


def test_pick_variables(spark):
    df = series(spark, [1, 2])
    assert SR.pick_variables(df, ["k", "ts"], ["v"]).columns == ["k", "ts", "v"]
    with pytest.raises(ValueError):
        SR.pick_variables(df, ["k", "ts"], ["v", "nope"])
    with pytest.warns(UserWarning):
        assert SR.pick_variables(df, ["k"], ["nope", "v"], on_unknown="warn").columns == ["k", "v"]


def test_grid_year_rule_clipped(spark):
    rows = [("A", dt.datetime(1990, 6, 1, 3)), ("B", dt.datetime(2020, 3, 1, 5))]
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz")
    full = GR.grid_frame(df, ["s"], "ts", bounds="year")
    clip = ("1990-03-01 01:00:00", "2020-03-02 00:00:00")
    g = GR.grid_frame(df, ["s"], "ts", bounds="year", clip=clip)
    exp = SR.time_slice(full, "ts", *clip)
    assert sorted(g.collect()) == sorted(exp.collect())


@pytest.mark.parametrize("chunk", ["day", "month"])
def test_nearest_samples_across_chunks(spark, chunk):
    """The three nearest valid samples on both sides, over chunks without any."""
    import random
    rnd = random.Random(7)
    data = []
    for k in (1, 2):
        for h in range(0, 24 * 70):
            dense = (h // (24 * 9)) % 3 == 0
            data.append((k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(h) if rnd.random() < (0.3 if dense else 0.002) else None))
    df = spark.createDataFrame(data, "k long, ts timestamp_ntz, v double")
    out = SR.neighbours(df, ["k"], "ts", [], chunk, around=["v"], depth=3).orderBy("k", "ts").collect()
    for k in (1, 2):
        own = [r for r in out if r.k == k]
        valid = [i for i, r in enumerate(own) if r.v is not None]
        for i, r in enumerate(own):
            before = [(j + 1, own[j].v) for j in reversed(valid) if j < i][:3]
            after = [(j + 1, own[j].v) for j in valid if j > i][:3]
            assert [(s.r, s.v) for s in r["v__pre"]] == before and [(s.r, s.v) for s in r["v__post"]] == after


def test_rolling_without_centring_over_chunks_of_one_row(spark):
    vals = [float(i * i) if i % 3 else None for i in range(40)]
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(days=40 * i), v) for k in (1, 2) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double").withColumn("w", F.col("v") * 2)
    out = SR.rolling_mean(df, ["k"], "ts", ["v", "w"], 4, center=False, min_periods=1, suffix="_m").orderBy("k", "ts").collect()
    want = pd.Series(vals, dtype="float64").rolling(4, min_periods=1).mean()
    assert out[0].asDict().keys() == {"k", "ts", "v", "w", "v_m", "w_m"}
    for i, r in enumerate(out):
        e = want[i % 40]
        assert r.v == vals[i % 40] and ((r.v_m is None and pd.isna(e)) or (abs(r.v_m - e) < 1e-9 and abs(r.w_m - 2 * e) < 1e-9))


def test_rolling_shuffles_rows_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2024-01-01").cast(
            "timestamp_ntz")).alias("ts"), F.rand(1).alias("v"))
        out = SR.rolling_mean(df, ["k"], "ts", ["v"], 5)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("REPARTITION_BY_COL") <= 2        # the one exchange of the rows, used again by the summary
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
