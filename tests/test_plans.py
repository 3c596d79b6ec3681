"""End-to-end plans: station chain, plot preparation, streaming ingest."""

import os

from pyspark.sql import functions as F

from skyframe.plans.chain import run_station_chain
from skyframe.plans.plot import prepare_timeseries, prepare_vector
from skyframe.streaming.ingest import start_ingest
from test_sources import write_station_year


def test_station_chain(spark, tmpdir_path):
    root = f"{tmpdir_path}/archive"
    write_station_year(root, "Tokyo", 662, 2020, 1, skip=set(range(30, 60)) | {5},
                       override={10: {"kion": ("", 1)}})
    cat = spark.createDataFrame([("Tokyo", 662, 35.69, 139.75, 25.2)],
                                "name_en string, kanid int, lat double, lon double, elev_m double")
    out = run_station_chain(spark, root, f"{tmpdir_path}/cf", ["Tokyo"], "2020-01-01", "2020-01-05",
                            max_gap=3, missing_limit=5, catalogue=cat)
    cf, filled = out["cf"], out["filled"]
    assert cf.count() == 4 * 24          # no 2019 file, so 2020-01-01 00:00 has no row
    rep = out["report"].filter("variable = 'air_temperature'").collect()
    assert len(rep) == 5 and rep[0].total_missing >= 32
    assert {r.rmk for r in out["report"].collect()} & {0, 1}     # the quality code comes along
    t = {r.ts.hour + 24 * (r.ts.day - 1): r.air_temperature for r in filled.collect()}
    assert t[6] is not None and t[11] is not None        # short gaps filled
    assert t[40] is None                                  # long gap kept
    st = {r.variable: r for r in out["gap_stats"].collect()}
    assert st["air_temperature"].unfillable == 30
    assert os.path.isdir(f"{tmpdir_path}/cf/data/station=Tokyo")
    night = cf.filter(F.hour("ts") == 1).select("surface_downwelling_shortwave_flux_in_air").first()[0]
    assert night == 0.0


def test_plot_preparation(spark, tmpdir_path):
    rows = [("A", f"2024-01-01 {h:02d}:00:00", 273.15 + h, 101300.0, float(h % 3), 1.0) for h in range(24)]
    cf = spark.createDataFrame(rows, "station string, t string, air_temperature double, "
                                     "air_pressure double, eastward_wind double, northward_wind double")
    cf = cf.withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    x = prepare_timeseries(cf, ["air_temperature", "air_pressure"], "2024-01-01 02:00:00",
                           "2024-01-01 12:00:00", window=3, every=2).orderBy("ts").collect()
    assert len(x) == 6 and abs(x[0].air_temperature - 2.5) < 1e-9 and abs(x[0].air_pressure - 1013.0) < 1e-9
    v, rng = prepare_vector(cf, "eastward_wind", "northward_wind", window=3)
    r = rng.first()
    assert r.mag_max > 0 and r.mag_min == -r.mag_max


def test_streaming_ingest(spark, tmpdir_path):
    root = f"{tmpdir_path}/in"
    write_station_year(root, "Tokyo", 662, 2020, 1)
    out, ck = f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    start_ingest(spark, root, out, ck).awaitTermination(300)
    assert spark.read.parquet(out).count() == 366 * 24
    write_station_year(root, "Naha", 936, 2021, 1)
    start_ingest(spark, root, out, ck).awaitTermination(300)
    df = spark.read.parquet(out)
    assert df.count() == 366 * 24 + 365 * 24
    assert df.filter("station = 'Naha'").select("KanID").distinct().first()[0] == 936
