"""Daily reader and cleaning (S5, A8, D1, D2), archive CSV writer (S10) and
forcing batch (S16)."""

import datetime as dt
import glob
import os

from skyframe.functions.quality import describe_rmk
from skyframe.schema import DAILY_PAIRS, HOURLY_COLUMNS, daily_columns
from skyframe.sources import daily as D
from skyframe.sources import hourly as H
from skyframe.sources import sinks as SK
from test_sources import write_station_year


def _daily_row(year, month, day, rmk=8):
    vals = {"avrLhpa": 10100, "avrKion": 153, "maxSped": 85, "avrSped": 40, "maxMuki": 4,
            "sunlght": 120, "avrRhum": 65, "minRhum": 30}
    cells = ["662", "Tokyo", "662", str(year), str(month), str(day)]
    for p in DAILY_PAIRS:
        cells += [str(vals.get(p, 10)), str(rmk if p == "avrKion" else 8)]
    cells += ["0"] * 5 + ["0", "8"]
    assert len(cells) == len(daily_columns())
    return ",".join(cells)


def test_daily_reader(spark, tmpdir_path):
    root = f"{tmpdir_path}/daily"
    os.makedirs(f"{root}/Tokyo")
    for y in (1980, 1981):
        with open(f"{root}/Tokyo/Tokyo{y}.csv", "w") as f:
            f.write("\n".join([_daily_row(y, 12, 31), _daily_row(y, 1, 1, rmk=1), _daily_row(y, 1, 2, rmk=2)]) + "\n")
    out = D.read_daily(spark, root, ["Tokyo"], "1980-01-01", "1981-12-31")
    org = {r.date: r for r in out["org"].collect()}
    clean = {r.date: r for r in out["clean"].collect()}
    r80, r81 = org[dt.datetime(1980, 12, 31)], org[dt.datetime(1981, 12, 31)]
    assert abs(r80.sunlght - 120 * 4.2e4 / 3.6e3 / 24.0) < 1e-9     # cal/cm2 before 1981
    assert abs(r81.sunlght - 120 * 1e5 / 3.6e3 / 24.0) < 1e-9       # 0.1 MJ/m2 from 1981
    assert r81.avrKion == 15.3 and r81.avrRhum == 0.65 and r81.minRhum == 30.0 and r81.maxMuki == 180.0
    assert abs(r81.umax - (-8.5)) < 1e-9 and abs(r81.v) < 1e-9
    assert clean[dt.datetime(1981, 1, 1)].avrKion is None           # RMK 1 -> null
    assert clean[dt.datetime(1981, 1, 2)].avrKion == 15.3           # RMK 2 kept


def test_archive_csv_roundtrip(spark, tmpdir_path):
    root = f"{tmpdir_path}/archive"
    write_station_year(root, "Tokyo", 662, 2020, 1)
    raw = H.read_hourly_raw(spark, root, ["Tokyo"])
    SK.write_hourly_csv(raw, f"{tmpdir_path}/out")
    assert glob.glob(f"{tmpdir_path}/out/station=Tokyo/year=2020/*.csv")
    back = H.read_hourly_raw(spark, f"{tmpdir_path}/out", ["Tokyo"], "2020-03-01", "2020-04-01",
                             layout="partitioned")
    assert back.count() == raw.count()
    a = raw.select(*HOURLY_COLUMNS).exceptAll(back.select(*HOURLY_COLUMNS))
    assert a.count() == 0


def test_forcing_batch(spark, tmpdir_path):
    root = f"{tmpdir_path}/archive"
    write_station_year(root, "Tokyo", 662, 2020, 1)
    hourly = H.read_hourly(spark, root, ["Tokyo"], "2020-01-01", "2020-01-02")["hourly"]
    SK.export_forcing_batch(hourly, f"{tmpdir_path}/forcing")
    for sub in ("slht", "kous", "met"):
        files = glob.glob(f"{tmpdir_path}/forcing/output={sub}/station=Tokyo/part-*")
        assert files and sum(len(open(p).read().splitlines()) for p in files) == 25


def test_rmk_description(spark):
    df = spark.createDataFrame([(8,), (1,), (42,)], "r int")
    got = [r.d for r in df.select(describe_rmk("r").alias("d")).collect()]
    assert got[0] == "regular value" and got[1] == "missing" and got[2] is None
