"""Sources and sinks on generated archive files (the real archive is not
public): hourly CSV tree, vendor dialect, station catalogue, CF parquet,
model-forcing text."""

import datetime as dt
import math
import glob
import os

import pytest
from pyspark.sql import functions as F

from skyframe.operators import quality as QL
from skyframe.plans.cf import summarize_missing, to_cf
from skyframe.schema import HOURLY_VARIABLES
from skyframe.sources import hourly as H
from skyframe.sources import sinks as SK
from skyframe.sources import stations as STN
from skyframe.sources import vendor as VS


def _hourly_line(kanid, name, ts_end, vals, rmks):
    """One archive row for the hour ending at ts_end (hour 1..24)."""
    day = ts_end - dt.timedelta(seconds=1)
    hh = 24 if ts_end.hour == 0 else ts_end.hour
    cells = [str(kanid), name, str(kanid), str(day.year), str(day.month), str(day.day), str(hh)]
    for v, r in zip(vals, rmks):
        cells += [v, str(r)]
    return ",".join(cells)


def write_station_year(root, name, kanid, year, step_h, skip=(), override=None):
    os.makedirs(f"{root}/{name}", exist_ok=True)
    start = dt.datetime(year, 1, 1, step_h if step_h == 3 else 1)
    end = dt.datetime(year + 1, 1, 1, 0)
    lines = []
    t = start
    i = 0
    while t <= end:
        if i not in skip:
            vals = ["10132", "10150", str(100 + i % 50), "120", "65", str(1 + i % 16), str(i % 40),
                    "7", "2", "50", "5", "120", "3"]
            rmks = [8] * 13
            if override and i in override:
                for var, (v, r) in override[i].items():
                    k = HOURLY_VARIABLES.index(var)
                    vals[k], rmks[k] = v, r
            lines.append(_hourly_line(kanid, name, t, vals, rmks))
        t += dt.timedelta(hours=step_h)
        i += 1
    with open(f"{root}/{name}/{name}{year}.csv", "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("archive"))
    write_station_year(root, "Tokyo", 662, 2019, 1)
    write_station_year(root, "Tokyo", 2020, 2020, 1, skip={5, 6, 100},
                       override={10: {"kion": ("", 1)}, 11: {"kion": ("abc", 8)},
                                 12: {"sped": ("2", 8), "muki": ("0", 8)},
                                 13: {"muki": ("4", 2), "sped": ("30", 8)},
                                 14: {"muki": ("4", 2), "sped": ("30", 1)},
                                 20: {"slht": ("0", 2), "lght": ("0", 2)}})
    write_station_year(root, "Tokyo", 662, 2021, 1)
    write_station_year(root, "Old", 100, 1990, 3, skip={0, 7})
    return root


def test_read_raw_and_build_ts(spark, archive):
    raw = H.read_hourly_raw(spark, archive, ["Tokyo"], "2020-01-01 00:00:00", "2020-12-31 00:00:00")
    yrs = sorted(r.year for r in raw.select("year").distinct().collect())
    assert yrs == [2019, 2020, 2021]          # one-year pad on both sides
    last = raw.filter("year = 2020").agg(F.max("ts")).first()[0]
    assert last == dt.datetime(2021, 1, 1, 0)  # hour 24 rolls over
    assert raw.filter("year = 2020").count() == 366 * 24 - 3


def test_read_hourly_chain(spark, archive):
    out = H.read_hourly(spark, archive, ["Tokyo"], "2020-01-01 00:00:00", "2020-01-03 00:00:00")
    org, hourly = out["org"], out["hourly"]
    assert org.count() == 49 and hourly.count() == 49   # inclusive at both ends
    rows = {r.ts: r for r in org.collect()}
    t = dt.datetime(2020, 1, 1, 6)                        # inserted row (index 5)
    assert rows[t].kion is None and rows[t].kionRMK == 0 and rows[t].Kname == "Tokyo"
    assert rows[dt.datetime(2020, 1, 1, 11)].kion is None    # RMK 1 -> null
    assert rows[dt.datetime(2020, 1, 1, 12)].kion is None    # "abc" -> null
    assert rows[dt.datetime(2020, 1, 1, 13)].muki_code == 0 and rows[dt.datetime(2020, 1, 1, 13)].muki == 270.0
    h = {r.ts: r for r in hourly.collect()}
    assert h[dt.datetime(2020, 1, 1, 11)].kion is not None   # interpolated
    assert h[t].kionRMK == 0


def test_read_raw_view_and_3h(spark, archive):
    r = H.read_hourly(spark, archive, ["Old"], "1990-01-01 00:00:00", "1990-01-10 00:00:00", raw=True)
    assert r.filter(F.col("ts") == F.lit("1990-01-01 03:00:00").cast("timestamp_ntz")).count() == 0
    g = H.read_hourly(spark, archive, ["Old"], "1990-01-01 00:00:00", "1990-01-10 00:00:00", units="raw")
    assert g.count() == 9 * 8 and g.filter("kionRMK = 0").count() == 2


def test_missing_station_is_empty(spark, archive):
    raw = H.read_hourly_raw(spark, archive, ["Nowhere"], "2020-01-01", "2020-02-01")
    assert raw.count() == 0


def test_cf_write_read_roundtrip(spark, archive, tmpdir_path):
    raw = H.read_hourly(spark, archive, ["Tokyo"], "2020-01-01 00:00:00", "2020-01-02 00:00:00", units="raw",
                        rmk_policy="none")
    cf = to_cf(raw, ["station"], "ts")
    by_ts = {r.ts: r for r in cf.collect()}
    # wind rule 3: direction not observed, speed valid -> calm
    r13 = by_ts[dt.datetime(2020, 1, 1, 14)]
    assert r13.wind_speed == 0.0 and r13.wind_from_direction is None and r13.eastward_wind == 0.0
    # rule 2: both missing
    r14 = by_ts[dt.datetime(2020, 1, 1, 15)]
    assert r14.wind_speed is None and r14.wind_from_direction is None
    # night code 2 with an instrument -> 0
    assert by_ts[dt.datetime(2020, 1, 1, 21)].duration_of_sunshine == 0.0
    assert cf.schema["air_temperature"].metadata["units"] == "K"
    path = f"{tmpdir_path}/cf"
    SK.write_cf(cf, path)
    with pytest.raises(Exception):
        SK.write_cf(cf, path)                               # refuses to overwrite
    SK.write_cf(cf, path, overwrite=True)
    back = SK.read_cf(spark, path, ["air_temperature"], time_tz="Asia/Tokyo")
    assert back.count() == cf.count()
    assert back.filter(F.col("time_local") != F.col("ts")).count() == 0
    with pytest.raises(ValueError):
        SK.read_cf(spark, path, ["no_such_variable"])
    s = {r.variable: r for r in summarize_missing(cf).collect()}
    assert s["air_temperature"].missing >= 1 and s["air_temperature"].total == 25


def test_wind_rules_compat(spark):
    df = spark.createDataFrame([(0.0, 8, 2.0, 8), (12.0, 8, 0.2, 8)],
                               "muki double, mukiRMK int, sped double, spedRMK int")
    d = [(r.muki, r.sped) for r in QL.wind_rules(df).collect()]
    c = [(r.muki, r.sped) for r in QL.wind_rules(df, compat=True).collect()]
    assert d[0] == (0.0, 0.0) and d[1] == (12.0, 0.2)      # code semantics
    assert c[0] == (0.0, 0.0) and c[1] == (12.0, 0.2)
    w = spark.createDataFrame([(0.0, 8, 0.2, 8)], "muki double, mukiRMK int, sped double, spedRMK int")
    assert QL.wind_rules(w, compat=True).first().sped == 0.0


def test_csv_roundtrip_and_forcing(spark, archive, tmpdir_path):
    out = H.read_hourly(spark, archive, ["Tokyo"], "2020-01-01 00:00:00", "2020-01-02 00:00:00")["hourly"]
    sel = out.select("station", "ts", "kion", "sped")
    SK.write_csv(sel, f"{tmpdir_path}/csv")
    back = SK.read_csv_back(spark, f"{tmpdir_path}/csv", sel.select("ts", "station", "kion", "sped").schema)
    assert back.count() == sel.count()
    SK.export_forcing_met(out, f"{tmpdir_path}/met")
    SK.export_forcing(out, "slht", f"{tmpdir_path}/slht", 10, 5)
    lines = []
    for p in sorted(glob.glob(f"{tmpdir_path}/met/station=Tokyo/part-*")):
        lines += open(p).read().splitlines()
    assert len(lines) == 25 and lines[0].startswith("2020-01-01 00:00:00 ")
    assert lines == sorted(lines)
    assert len(lines[0].split()) == 8


def test_vendor_conversion(spark, tmpdir_path):
    base = f"{tmpdir_path}/vendor/"
    os.makedirs(f"{base}2023")
    header = ("観測所ID,名称,日付,時,現地気圧(hPa),海面気圧(hPa),降水量(mm),気温(℃),露点温度(℃),蒸気圧(hPa),"
              "湿度(%),風速(m/s),風向,日照時間(h),全天日射量(MJ/㎡),降雪(cm),積雪(cm),雲量,--,視程")
    rows = ["47662,Tokyo,2023/1/1,1,1013.2),1015.0,×,5.3,-2.1,4.5,0+,3.2,北北東,,,0,0,10-,,20.0",
            "47662,Tokyo,2023/1/1,2,1013.0,1015.1, -- ,5.1],-2.0,4.4,45,2.9,静穏,0.5,1.23,0,0,3,,20.0"]
    with open(f"{base}2023/Tokyo_2023.csv", "w") as f:
        f.write(header + "\n" + "\n".join(rows) + "\n")
    v = VS.read_vendor_csv(spark, base, ["Tokyo"], [2023])
    h = {r.HH: r for r in VS.vendor_to_hourly(v).collect()}
    r1, r2 = h[1], h[2]
    assert (r1.KanID, r1.YYYY, r1.MM, r1.DD) == (662, 2023, 1, 1)
    assert r1.lhpa == 10132 and r1.kous is None and r2.kous == 0 and r2.kion == 51
    assert r1.rhum == 0 and r1.clod == 10 and r1.muki == 1 and r2.muki == 0
    assert r1.slht == 0 and r1.slhtRMK == 2 and r2.slht == 123 and r2.slhtRMK == 8
    assert r1.lght == 0 and r1.lghtRMK == 2 and r1.tnki is None and r1.tnkiRMK == 0


def test_station_catalogue(spark, tmpdir_path):
    p = f"{tmpdir_path}/stn.csv"
    with open(p, "w") as f:
        f.write("# station list\n")
        f.write("Kname,station_id,name_jp,latitude,longitude,altitude,barometer_height,anemometer_height,"
                "temperature_height\n")
        f.write("Tokyo,662,東京,35.4130,139.4500,25.2,26.4,35.3,1.5\n")
        f.write("Yokohama,670,横浜,35.2612,139.3918,39.1,41.8,19.5,1.5\n")
    st = STN.load_stations(spark, p)
    y = st.filter("name_en = 'Yokohama'").first()
    assert y.kanid == 670 and abs(y.lat - (35 + 26 / 60 + 12 / 3600)) < 1e-9 and y.name_ja == "横浜"
    from skyframe.operators import stations as OS
    assert OS.select_station(st, "Nowhere").count() == 0
    assert OS.duplicate_keys(st, ["kanid"]).count() == 0


# A real station catalogue file, when one is available (skipped otherwise).
CATALOGUE = os.environ.get("SKYFRAME_STATION_CATALOGUE", "")


@pytest.mark.skipif(not (CATALOGUE and os.path.exists(CATALOGUE)), reason="no station catalogue file given")
def test_real_catalogue_facts(spark):
    from skyframe.operators import stations as OS
    st = STN.load_stations(spark, CATALOGUE)
    assert st.count() == 155 and OS.duplicate_keys(st, ["kanid"]).count() == 0
    r = st.agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    assert 20 < r[0] and r[1] < 46 and 122 < r[2] and r[3] < 154
    t = OS.select_station(st, "Tokyo").first()
    assert t.kanid == 662 and t.name_ja == "東京"
    for name, kid in [("Asosan", 821), ("Ibukiyama", 751), ("Tsurugisan", 894)]:
        x = OS.select_station(st, name).first()
        assert x.kanid == kid and x.elev_m > 1000


def test_lookup_station(spark):
    from skyframe.operators import stations as OS
    cat = spark.createDataFrame([("Tokyo", 662), ("Tokyo", 999), ("Naha", 936)], "name_en string, kanid int")
    assert OS.lookup_station(cat, "Tokyo").count() == 1
    assert OS.lookup_station(cat, "Nowhere").count() == 0


def test_cf_compat_mode(spark, archive):
    raw = H.read_hourly(spark, archive, ["Tokyo"], "2020-01-01 00:00:00", "2020-01-02 00:00:00", units="raw",
                        rmk_policy="none")
    d = {r.ts: r for r in to_cf(raw).collect()}
    c = {r.ts: r for r in to_cf(raw, compat=True).collect()}
    t = dt.datetime(2020, 1, 1, 2)     # code 2 (NE), precipitation 3 (0.3 mm/h)
    assert d[t].wind_from_direction == 45.0                      # from-direction of the code
    assert abs(c[t].wind_from_direction - 225.0) < 1e-6          # math angle passed through
    assert abs(c[t].precipitation_flux * 1000 - d[t].precipitation_flux) < 1e-9
    # code 12 (west) with a light speed: zeroed only by the literal calm rule
    w = [ts for ts, r in d.items() if r.wind_speed is not None and 0 < r.wind_speed <= 3.0
         and abs(c[ts].wind_from_direction) < 1e-6]
    assert all(c[ts].wind_speed == 0.0 for ts in w)


def test_hourly_circular_and_categorical(spark, archive):
    out = H.read_hourly(spark, archive, ["Tokyo"], "2020-01-01 00:00:00", "2020-01-02 00:00:00")
    plain = {r.ts: r for r in out["hourly"].collect()}
    from skyframe.plans.hourly import clean_hourly
    raw = H.read_hourly_raw(spark, archive, ["Tokyo"], "2020-01-01 00:00:00", "2020-01-02 00:00:00")
    alt = clean_hourly(raw.drop("year"), "2020-01-01 00:00:00", "2020-01-02 00:00:00",
                       circular=True, categorical=["tnki"])
    got = {r.ts: r for r in alt["hourly"].collect()}
    t = dt.datetime(2020, 1, 1, 6)      # inserted row between two valid samples
    assert got[t].tnki == got[dt.datetime(2020, 1, 1, 5)].tnki          # forward-filled code
    r = got[dt.datetime(2020, 1, 1, 3)]
    assert abs(r.muki - (math.degrees(math.atan2(r.v, r.u)) % 360.0)) < 1e-9
    assert plain[t].kion is not None


def test_cf_store_keeps_other_stations(spark, tmpdir_path):
    """Writing, adding and replacing one station leaves the others alone."""
    from skyframe.sources import sinks as SK
    def of(station, v):
        return spark.sql(f"SELECT '{station}' AS station, TIMESTAMP_NTZ'2024-01-01 01:00:00' AS ts, {v}D AS kion")
    path = f"{tmpdir_path}/store"
    SK.write_cf(of("A", 1), path)
    SK.write_cf(of("B", 2), path)
    SK.write_cf(of("B", 3), path, overwrite=True)
    with pytest.raises(FileExistsError):
        SK.write_cf(of("A", 4), path)
    assert {(r.station, r.kion) for r in SK.read_cf(spark, path, ["kion"]).collect()} == {("A", 1.0), ("B", 3.0)}
    assert spark.read.parquet(f"{path}/_global").count() == 2


def test_partitioned_station_keeps_leading_zeros_and_absent_years(spark, tmp_path):
    from skyframe.operators.stations import one_per_key, require_unique
    from skyframe.schema import HOURLY_COLUMNS
    from skyframe.sources import hourly as H
    row = {c: "8" if c.endswith("RMK") else "1" for c in HOURLY_COLUMNS}
    row.update(Kname="x", YYYY="2020", MM="1", DD="1", HH="24")
    df = spark.createDataFrame([{**row, "station": "0123", "year": 2020}])
    path = str(tmp_path / "archive")
    df.select("station", "year", *HOURLY_COLUMNS).write.partitionBy("station", "year").option("header", False).csv(path)
    back = H.read_hourly_raw(spark, path, ["0123"], layout="partitioned")
    assert [(r["station"], r["year"]) for r in back.select("station", "year").collect()] == [("0123", 2020)]
    asked = spark.createDataFrame([("0123", 2020), ("0123", 2021), ("9", 2020)], "station string, year int")
    absent = H.absent_station_years(spark, path, asked, layout="partitioned").collect()
    assert {tuple(r) for r in absent} == {("0123", 2021), ("9", 2020)}
    twice = spark.createDataFrame([("a", 1, 5), ("a", 1, 3), ("b", 1, None)], "k string, t int, v int")
    assert {tuple(r) for r in require_unique(one_per_key(twice, ["k", "t"]), ["k", "t"]).collect()} == {("a", 1, 3), ("b", 1, None)}
    with pytest.raises(ValueError):
        require_unique(twice, ["k", "t"])


def test_store_summary_covers_all_batches(spark, tmpdir_path):
    from pyspark.sql import types as T
    path = f"{tmpdir_path}/grown"

    def of(station, year, hours, value):
        return spark.createDataFrame([(station, f"{year}-03-01 {h:02d}:00:00", float(value + h) if h else None) for h in range(hours)],
                                     "station string, t string, kion double").select(
            "station", F.col("t").cast("timestamp_ntz").alias("ts"), F.col("kion").cast("float").alias("kion", metadata={"units": "K"}))

    def row(station):
        r = spark.read.schema("time_coverage_start timestamp_ntz, time_coverage_end timestamp_ntz, n_times long, lat double, title string, "
                              "Conventions string, history string, institution string, variables array<struct<variable:string,"
                              "n_valid:bigint,least:double,greatest:double>>, station string").parquet(f"{path}/_global").where(
            F.col("station") == station).collect()
        assert len(r) == 1
        return str(r[0].time_coverage_start)[:10], str(r[0].time_coverage_end), r[0].n_times, tuple(r[0].variables[0])[1:], r[0]
    places = spark.createDataFrame([("0123", 35.0), ("other", 1.0)], "station string, lat double")
    SK.write_cf(of("0123", 2020, 5, 10), path, global_attrs=places)
    SK.write_cf(of("0123", 2021, 3, 20), path, attributes={"institution": "the observatory"})
    got = row("0123")
    assert got[:4] == ("2020-03-01", "2021-03-01 02:00:00", 8, (6, 11.0, 22.0))
    assert got[4].lat == 35.0 and got[4].Conventions == "CF-1.10" and got[4].institution == "the observatory" and "0123" in got[4].title
    SK.write_cf(of("0123", 2020, 2, 90), path, overwrite=True)                 # replaces one year, its old summary counts no more
    assert row("0123")[:4] == ("2020-03-01", "2021-03-01 02:00:00", 5, (3, 21.0, 91.0))
    SK.write_cf(of("9", 2020, 4, 0), path)
    assert row("0123")[2] == 5 and row("9")[2] == 4
    # a writer that ended before its data: only a summary; one that ended before the global row: summary and data
    real, SK.refresh_global = SK.refresh_global, lambda *a, **k: None
    try:
        SK.write_cf(of("9", 2021, 6, 0), path)
        spark.read.parquet(f"{path}/_summary").limit(1).withColumn("batch", F.lit("unfinished")).withColumn("station", F.lit("9")).write.mode(
            "append").partitionBy("station").parquet(f"{path}/_summary")
    finally:
        SK.refresh_global = real
    assert row("9")[2] == 4
    SK.refresh_global(spark, path, {"station": T.StringType()})
    assert row("9")[2] == 10 and row("0123")[2] == 5
    back = SK.read_cf(spark, path)
    assert "batch" not in back.columns and back.schema["time"].metadata["units"].startswith("seconds since 1970")
    assert back.schema["kion"].metadata == {"units": "K"}
    assert spark.read.parquet(f"{path}/_attributes").schema["lat"].metadata["units"] == "degrees_north"


def test_lines_of_ordered_output(spark, tmpdir_path):
    df = spark.range(3000).select((F.col("id") % 2).cast("string").alias("station"),
                                  F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("ts"),
                                  F.col("id").cast("double").alias("x")).repartition(7)
    SK.export_forcing(df, "x", f"{tmpdir_path}/x")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")                  # parts of files are numbered as well
    try:
        got = {(r.station, r.line_no): float(r.line.split()[2]) for r in SK.read_ordered(spark, f"{tmpdir_path}/x").withColumn(
            "station", F.col("station").cast("string")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {(str(i % 2), i // 2 + 1): float(i) for i in range(3000)}


def test_only_requested_files_are_opened(spark, tmp_path):
    """One listing for any request; other stations' and years' files are dropped by their path."""
    root = str(tmp_path / "tree")
    for name in ("A", "B", "Bx"):
        for year in (1991, 1992, 1993):
            write_station_year(root, name, 7, year, 1)
    for stray in ("A/notes1992.csv", "A/A1992.csv.bak", "loose1992.csv"):
        with open(f"{root}/{stray}", "w") as f:
            f.write("no,archive,file\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")    # tasks follow the bytes read
    try:
        from skyframe.schema import hourly_raw_schema
        from skyframe.sources.files import scan_station_years

        def opened(stations, years):
            df = scan_station_years(spark, root, hourly_raw_schema(), stations, years)
            files = {(r["station"], r["year"]) for r in df.select("station", "year").distinct().collect()}
            return files, df.select("HH").rdd.getNumPartitions()
        files, tasks = opened(["B", "absent"], [1992, 1993])
        assert files == {("B", 1992), ("B", 1993)}
        every, all_tasks = opened(None, None)
        assert len(every) == 9 and tasks * 9 <= all_tasks * 2 + 9
        assert opened(None, [1991])[0] == {("A", 1991), ("B", 1991), ("Bx", 1991)}
        assert opened(["absent"], None)[0] == set()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert H.read_hourly_raw(spark, root, ["A"], "1992-03-01", "1992-04-01", pad=0).select("year").distinct().count() == 1
    assert H.read_hourly_raw(spark, str(tmp_path / "nothing"), ["A"]).count() == 0
