"""What keeps task and driver memory, files and Python calls from growing faster than
the rows: grid joins and exchanges, packed layouts, spline blocks."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from skyframe.operators import gaps as GP
from skyframe.operators import grid as GR
from skyframe.operators import report as RP
from skyframe.operators import series as SR
from skyframe.schema import HOURLY_COLUMNS
from skyframe.sources import hourly as H
from skyframe.sources import sinks as SK
from skyframe.sources import vendor as VS
from skyframe.sources.files import write_station_years

T0 = dt.datetime(2024, 1, 1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def series(spark):
    rows = [(k, T0 + dt.timedelta(hours=h), float(h) if h % 3 else None) for k in (1, 2) for h in range(0, 60, 2)]
    return spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double")


def test_grid_is_not_broadcast(series):
    chosen = SR.drop_null(GR.regularize(series, ["k"], "ts"), ["v"])
    assert "Broadcast" not in _plan(chosen)
    assert {r.ts.hour % 2 for r in chosen.collect()} == {0} and chosen.count() == series.where("v IS NOT NULL").count()
    missing, off = GR.missing_rows(series, ["k"], "ts"), GR.off_grid_rows(series, ["k"], "ts")
    assert "Broadcast" not in _plan(missing) + _plan(off)
    assert missing.count() == 2 * 29 and off.count() == 0


def test_quality_rows_are_not_broadcast(series):
    report = RP.missing_report(series, ["k"], "ts", ["v"], 3)
    codes = series.select("k", "ts", F.lit("v").alias("variable"), F.lit(1).alias("rmk"))
    joined = RP.attach_rmk(report, codes, ["k"], "ts")
    assert "Broadcast" not in _plan(joined).split("\n")[1] + _plan(joined).split("\n")[2]
    assert [r.rmk for r in joined.collect()] == [1] * 6


def test_exchanges_keep_their_partitions(series):
    """Adaptive execution may not pack well compressed grid rows into a few tasks."""
    for df in (GR.regularize(series, ["k"], "ts"), SR.nearest_valid(series, ["k"], "ts", "v"),
               SR.rolling_mean(series, ["k"], "ts", ["v"], 3), GP.gap_table(series, ["k"], "ts", "v")):
        assert "REPARTITION_BY_COL" not in _plan(df) and "REPARTITION_BY_NUM" in _plan(df)


def _archive_rows(spark, stations):
    row = {c: "8" if c.endswith("RMK") else "1" for c in HOURLY_COLUMNS}
    return spark.createDataFrame([{**row, "Kname": f"n,{s}", "YYYY": str(y), "MM": "1", "DD": "1", "HH": str(h), "station": s, "year": y}
                                  for s in stations for y in (2020, 2021) for h in (2, 1)])


def test_archive_packed_by_year(spark, tmp_path):
    path, stations = str(tmp_path / "archive"), ["0123", " a b", 'q"x', "n,m", *[f"s{i}" for i in range(40)]]
    rows = _archive_rows(spark, [*stations, None])
    SK.write_hourly_csv(rows, path, layout="by_year")
    files = glob.glob(f"{path}/year=20*/*.csv")
    assert not glob.glob(f"{path}/station=*") and len(files) <= 8 and len(files) == len(glob.glob(f"{path}/**/*.csv", recursive=True))
    back = H.read_hourly_raw(spark, path, layout="by_year")
    other = str(tmp_path / "folders")
    SK.write_hourly_csv(rows.where("station IS DISTINCT FROM ' a b'"), other)
    both = H.read_hourly_raw(spark, other, layout="partitioned")
    assert both.columns == back.columns
    assert both.exceptAll(back).count() == 0 and back.exceptAll(both).where("station IS DISTINCT FROM ' a b'").count() == 0
    assert {r.station for r in back.select("station").distinct().collect()} == {*stations, None}
    some = H.read_hourly_raw(spark, path, ["0123"], "2020-03-01", "2020-04-01", layout="by_year")
    assert [(r.station, r.year, r.Kname) for r in some.where("YYYY = 2020").collect()] == [("0123", 2020, "n,0123")] * 2
    asked = spark.createDataFrame([("0123", 2020), ("0123", 2022), ("9", 2020)], "station string, year int")
    assert {tuple(r) for r in H.absent_station_years(spark, path, asked, layout="by_year").collect()} == {("0123", 2022), ("9", 2020)}


def test_vendor_rows_packed_by_year(spark, tmp_path):
    path = str(tmp_path / "vendor")
    rows = spark.createDataFrame([(f"0{i}", 2020, "1.0)", "×") for i in range(30)], "station string, year int, a string, b string")
    write_station_years(rows, path, layout="by_year", header=True)
    assert len(glob.glob(f"{path}/**/*.csv", recursive=True)) <= 4
    back = VS.read_vendor_csv(spark, path, ["03"], [2020], layout="by_year")
    assert [(r.station, r.year, r.a, r.b) for r in back.collect()] == [("03", 2020, "1.0)", "×")]


def test_forcing_lines_packed(spark, tmp_path):
    df = spark.range(900).select((F.col("id") % 45).cast("string").alias("station"), F.timestamp_add(
        "HOUR", F.col("id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"), F.col("id").cast("double").alias("v"))
    path, folders = str(tmp_path / "packed"), str(tmp_path / "folders")
    SK.export_forcing(df, "v", path, layout="packed")
    SK.export_forcing(df.where("station IN ('3', '44')"), "v", folders)
    assert len(glob.glob(f"{path}/*.csv")) <= 4 and not glob.glob(f"{path}/station=*")
    got = SK.read_ordered(spark, path, layout="packed").where("station IN (3, 44)")
    want = SK.read_ordered(spark, folders).withColumn("station", F.col("station").cast("string"))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()} and got.count() == 40
    assert SK.read_lines(spark, path, layout="packed").count() == 900


def test_forcing_batch_goes_as_numbers_and_packs_small(spark, tmp_path, monkeypatch):
    """A row goes through the range exchange once and without text; packed lines take a fraction of their length on disk."""
    values = {"slht": 1.5, "kous": 2.0, "u": 3.0, "v": 4.0, "shpa": 1000.0, "kion": 5.0, "humd": 6.0, "clod": 7.0}
    hour = F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    x = spark.range(3000).select((F.col("id") % 5).cast("string").alias("station"), hour.alias("ts"),
                                 *[F.when(F.col("id") % 3 > 0, F.col("id") / 7 + v).alias(c) for c, v in values.items()])
    deal, dealt = type(x).repartitionByRange, []
    monkeypatch.setattr(type(x), "repartitionByRange", lambda self, *a: dealt.append((self.count(), self.dtypes)) or deal(self, *a))
    path, folders = str(tmp_path / "packed"), str(tmp_path / "folders")
    SK.export_forcing_batch(x.repartition(3), path, layout="packed")
    SK.export_forcing_batch(x.repartition(3), folders)
    for n, kinds in dealt:
        assert n == 3000 and [c for c, kind in kinds if kind == "string"] == ["station"]
    assert len(dealt) == 2
    got = {(r.output, r.station, r.line_no): r.line for r in SK.read_ordered(spark, path, ["output", "station"], layout="packed").collect()}
    want = {(r.output, str(r.station), r.line_no): r.line for r in SK.read_ordered(spark, folders, ["output", "station"]).collect()}
    assert got == want and len(got) == 9000
    for i in (0, 1, 2, 1499, 2999):
        time = str(T0 + dt.timedelta(hours=i))
        num = [None if i % 3 == 0 else i / 7 + v for v in values.values()]
        text = [("nan" if v is None else f"{v:.5f}").rjust(w) for v, w in zip(num[2:], (10, 10, 12, 10, 10, 10))]
        assert got["met", str(i % 5), i // 5 + 1] == " ".join([time, *text])
        assert got["slht", str(i % 5), i // 5 + 1] == f"{time} {'nan' if num[0] is None else f'{num[0]:.5f}':>10}"
        rain = got["kous", str(i % 5), i // 5 + 1].removeprefix(f"{time} ")
        assert rain == "nan" if num[1] is None else float(rain) == num[1]
    files = glob.glob(f"{path}/part-*")
    assert len(files) <= 4 and 4 * sum(map(os.path.getsize, files)) < sum(map(len, got.values()))


def test_lines_are_neither_broadcast_nor_sorted(spark, tmp_path):
    df = spark.range(90).select((F.col("id") % 45).cast("string").alias("station"), F.timestamp_add(
        "HOUR", F.col("id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"), F.col("id").cast("double").alias("v"))
    SK.export_forcing(df, "v", str(tmp_path / "x"), layout="packed")
    back = SK.read_ordered(spark, str(tmp_path / "x"), layout="packed")
    assert "Broadcast" not in _plan(back) and "SortMergeJoin" not in _plan(back) and "ShuffledHashJoin" in _plan(back)
    assert {(r.station, r.line_no) for r in back.collect()} == {(str(k), n) for k in range(45) for n in (1, 2)}


def test_store_packed_by_year(spark, tmp_path):
    path = str(tmp_path / "store")

    def of(stations, year, hours, value):
        return spark.createDataFrame([(s, T0.replace(year=year) + dt.timedelta(hours=h), value + h) for s in stations for h in range(hours)],
                                     "station string, ts timestamp_ntz, kion double").withColumn("kion", F.col("kion").alias("kion", metadata={"units": "K"}))

    def rows(station):
        return sorted((r.year, r.kion) for r in SK.read_cf(spark, path, ["kion"], [station], layout="by_year").collect())

    def glob_row(station):
        return SK.read_global(spark, path, layout="by_year").where(F.col("station") == station).collect()
    many = [f"0{i}" for i in range(40)]
    places = spark.createDataFrame([("00", 35.0), ("01", 36.0)], "station string, lat double")
    SK.write_cf(of(many, 2020, 3, 10.0), path, global_attrs=places, layout="by_year")
    SK.write_cf(of(many, 2021, 2, 50.0), path, layout="by_year")
    assert not [d for d, _, _ in os.walk(path) if "station=" in d]
    assert len(glob.glob(f"{path}/**/*.parquet", recursive=True)) <= 40
    with pytest.raises(FileExistsError):
        SK.write_cf(of(["03"], 2021, 1, 0.0), path, layout="by_year")
    SK.write_cf(of(["00", "02"], 2021, 1, 70.0), path, overwrite=True, layout="by_year", global_attrs=places.withColumn("lat", F.lit(1.0)))
    SK.write_cf(of(["02"], 2021, 1, 80.0), path, overwrite=True, layout="by_year")
    assert rows("00") == [(2020, 10.0), (2020, 11.0), (2020, 12.0), (2021, 70.0)]
    assert rows("01") == [(2020, 10.0), (2020, 11.0), (2020, 12.0), (2021, 50.0), (2021, 51.0)]
    assert rows("02")[-1:] == [(2021, 80.0)] and len(rows("02")) == 4
    (g,), (h,), (i,) = glob_row("00"), glob_row("01"), glob_row("02")
    assert (g.n_times, g.lat, tuple(g.variables[0])) == (4, 1.0, ("kion", 4, 10.0, 70.0))
    assert (h.n_times, h.lat, tuple(h.variables[0])) == (5, 36.0, ("kion", 5, 10.0, 51.0))
    assert (i.n_times, i.lat, str(i.time_coverage_end)) == (4, None, "2021-01-01 00:00:00")
    back = SK.read_cf(spark, path, layout="by_year")
    assert "batch" not in back.columns and back.schema["kion"].metadata == {"units": "K"} and back.count() == 40 * 5 - 2
    assert SK.read_global(spark, path, layout="by_year").schema["lat"].metadata["units"] == "degrees_north"


def test_catalogue_files_do_not_grow_with_stations(spark, tmp_path):
    """The store and archive queries write as many files for many stations as for few."""
    from skyframe.plans.catalog import QUERIES
    from skyframe.session import checkpoint_dir
    hour = F.timestamp_add("HOUR", (F.col("id") % 100).cast("int"), F.lit("2024-01-03 00:30:00").cast("timestamp_ntz"))
    spark.range(6000).select(F.col("id").alias("event_id"), hour.alias("ts"), (F.col("id") % 150).alias("user_id"), F.lit("a").alias("event_type"),
                             (F.col("id") % 97 + 0.5).alias("value"), F.lit('{"k": 5}').alias("props")).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("archive_csv_roundtrip", "cf_store_growth", "cf_parquet_roundtrip", "vendor_csv_roundtrip", "daily_csv_roundtrip",
                 "forcing_file_ordered", "forcing_batch_roundtrip"):
        before = set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/skyframe-*"))
        assert QUERIES[name](spark, str(tmp_path)).count() > 0
        made = set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/skyframe-*")) - before
        files = [f for d in made for f in glob.glob(f"{d}/**/part-*", recursive=True)]
        assert made and len(files) < 100, name


def test_spline_blocks_share_tasks(spark):
    """Many blocks of several entities and variables per Arrow batch, null key included: each is
    filled as it is alone, and no data frame is made per block."""
    rows = [(k, T0 + dt.timedelta(hours=h), *(None if (h + s) % 4 == 0 else float((h * h * (1 + s) + 7 * h) % 31) for s in (0, 2)))
            for k in (None, 1, 2**60 + 1, *range(10, 20)) for h in range(60)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, a double, b double")
    for method in ("cubic", "quadratic"):
        out = GP.fill_max_gap(df, ["k"], "ts", ["a", "b"], 2, method)
        assert "FlatMapGroupsInPandas" not in _plan(out) and "MapInArrow" in _plan(out)
        got = {(r.k, r.ts): (r.a, r.b) for r in out.collect()}
        for k in (1, 2**60 + 1, 15):
            alone = GP.fill_max_gap(df.where(F.col("k") == k), ["k"], "ts", ["a", "b"], 2, method).collect()
            assert len(alone) == 60
            for r in alone:
                assert got[r.k, r.ts] == (r.a, r.b)
            assert sum(v is None for r in alone for v in (r.a, r.b)) <= 2
