"""Station-series views derived from the driver's ``events`` table.

The observation archive itself is not available, so the catalogue queries run
the station operators on series that Spark derives from ``events``: every user
is a station and every user-hour with events is one observation. All derived
columns are integer arithmetic on per-hour aggregates, so the views are exact
and their size grows with the input.

The SQL fragments in this module are plain expressions valid both in Spark SQL
and in DuckDB; they are shared by the Spark views (``selectExpr``) and the
oracle SQL so both sides derive the same inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.grid import regularize
from ..schema import HOURLY_VARIABLES, NIGHT_RMK_VARIABLES, rmk_col

NIGHT_HOURS = "(hour(ts) >= 19 OR hour(ts) < 5)"

# Packed archive units derived from the per-hour aggregates.
VALUE_EXPRS = {
    "lhpa": "10000 + cs % 400",
    "shpa": "10100 + cmax % 300",
    "kion": "cmin % 350 - 50",
    "stem": "cs % 300",
    "rhum": "kmax",
    "muki": "ks % 17",
    "sped": "cmax % 120",
    "clod": "kmin % 11",
    "tnki": "kmax % 30",
    "humd": "cmin % 350 - 50 - kmin % 80",
    "lght": f"CASE WHEN {NIGHT_HOURS} THEN 0 ELSE ks % 11 END",
    "slht": f"CASE WHEN {NIGHT_HOURS} THEN 0 ELSE cs % 360 END",
    "kous": "cmin % 50",
}


def _rmk_expr(j: int, var: str) -> str:
    if var in NIGHT_RMK_VARIABLES:
        # night code 2; stations with station % 7 = 0 have no irradiance instrument
        no_instr = "station % 7 = 0" if var == "slht" else "1 = 0"
        return (f"CASE WHEN {NIGHT_HOURS} THEN 2 WHEN {no_instr} THEN 0 "
                f"WHEN (ks + cs + {j}) % 20 = 0 THEN 1 ELSE 8 END")
    return (f"CASE (ks * 7 + cs + {j} * 3) % 20 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 "
            f"WHEN 3 THEN 6 WHEN 4 THEN 5 ELSE 8 END")


WIDE_SELECT = (["station", "ts", "CAST(station AS INT) AS KanID", "'stn' || station AS Kname"]
               + [f"CAST({VALUE_EXPRS[v]} AS INT) AS {v}" for v in HOURLY_VARIABLES]
               + [f"CAST({_rmk_expr(j, v)} AS INT) AS {rmk_col(v)}"
                  for j, v in enumerate(HOURLY_VARIABLES, start=1)])

WIDE_COLUMNS = ["station", "ts", "KanID", "Kname"] + HOURLY_VARIABLES + \
    [rmk_col(v) for v in HOURLY_VARIABLES]


def hour_of(ts) -> "F.Column":
    """Truncate a TIMESTAMP_NTZ to the hour without passing through the session zone."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def day_of(ts) -> "F.Column":
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.lit(0), F.lit(0), F.lit(0))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``station, ts (hour), value, k, cents`` from ``events``."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(
        F.col("user_id").alias("station"),
        hour_of("ts").alias("ts"),
        F.col("value"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.round(F.col("value") * 100).cast("long").alias("cents"))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly series ``station, ts, v, rmk, code``: mean value of the hour
    (6 decimals), a quality code and a direction code per station-hour."""
    return events(spark, sf_dir).groupBy("station", "ts").agg(
        F.round(F.avg("value"), 6).alias("v"),
        F.max(F.col("k") % 10).alias("rmk"),
        F.max(F.col("k") % 17).alias("code"))


def mask_v(df: DataFrame) -> DataFrame:
    """Quality mask of the series: codes 0, 1, 2 null the value."""
    return df.withColumn("v", F.when(~F.col("rmk").isin(0, 1, 2), F.col("v")))


def obs_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 on :func:`obs`: complete hourly grid per station, inserted rows with
    quality code 0."""
    return regularize(obs(spark, sf_dir), ["station"], "ts", "1 hour", fill={"rmk": 0})


def wide_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive-shaped wide rows (13 packed values + 13 quality codes) per
    station-hour with events."""
    agg = events(spark, sf_dir).groupBy("station", "ts").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cs"),
        F.min("cents").alias("cmin"), F.max("cents").alias("cmax"),
        F.sum("k").alias("ks"), F.min("k").alias("kmin"), F.max("k").alias("kmax"))
    return agg.selectExpr(*WIDE_SELECT)


def wide_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 on :func:`wide_raw`: inserted rows get null values, quality 0 and the
    station identifiers of the first row."""
    w = wide_raw(spark, sf_dir)
    return regularize(w, ["station"], "ts", "1 hour",
                      fill={rmk_col(v): 0 for v in HOURLY_VARIABLES}, carry=["KanID", "Kname"])


# ---------------------------------------------------------------------------
# The same views in DuckDB SQL (oracle side)
# ---------------------------------------------------------------------------

SQL_EV = """ev AS (
  SELECT user_id AS station, date_trunc('hour', ts) AS ts, value,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM events)"""

SQL_OBS = """obs AS (
  SELECT station, ts, round(avg(value), 6) AS v, max(k % 10) AS rmk, max(k % 17) AS code
  FROM ev GROUP BY station, ts)"""

SQL_OBSM = """obsm AS (
  SELECT station, ts, CASE WHEN rmk IN (0, 1, 2) THEN NULL ELSE v END AS v, rmk, code FROM obs)"""

SQL_GRID = """obs_b AS (SELECT station, min(ts) AS lo, max(ts) AS hi FROM obs GROUP BY station),
obs_g AS (SELECT station, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM obs_b),
grid AS (
  SELECT g.station, g.ts, o.v, coalesce(o.rmk, 0) AS rmk, o.code
  FROM obs_g g LEFT JOIN obs o ON o.station = g.station AND o.ts = g.ts),
gridm AS (
  SELECT station, ts, CASE WHEN rmk IN (0, 1, 2) THEN NULL ELSE v END AS v, rmk, code FROM grid)"""

SQL_WIDE = ("""wagg AS (
  SELECT station, ts, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cs, min(cents) AS cmin,
         max(cents) AS cmax, CAST(sum(k) AS BIGINT) AS ks, min(k) AS kmin, max(k) AS kmax
  FROM ev GROUP BY station, ts),
wraw AS (SELECT """ + ",\n    ".join(WIDE_SELECT) + """ FROM wagg),
w_b AS (SELECT station, min(ts) AS lo, max(ts) AS hi, arg_min(KanID, ts) AS KanID,
               arg_min(Kname, ts) AS Kname FROM wraw GROUP BY station),
w_g AS (SELECT station, KanID, Kname, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM w_b),
wgrid AS (
  SELECT g.station, g.ts, coalesce(w.KanID, g.KanID) AS KanID, coalesce(w.Kname, g.Kname) AS Kname, """
            + ", ".join(f"w.{v}" for v in HOURLY_VARIABLES) + ", "
            + ", ".join(f"coalesce(w.{rmk_col(v)}, 0) AS {rmk_col(v)}" for v in HOURLY_VARIABLES)
            + """
  FROM w_g g LEFT JOIN wraw w ON w.station = g.station AND w.ts = g.ts)""")


def sql_with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def sql_neighbours(name: str, src: str, key: str = "station", val: str = "v") -> str:
    """CTE ``name`` over ``src`` adding rn, n, pt/pv/pr, nt/nv/nr (prev/next valid)."""
    return f"""{name}_rn AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ts) AS rn,
         count(*) OVER (PARTITION BY {key}) AS n FROM {src}),
{name} AS (
  SELECT *,
    last_value(CASE WHEN {val} IS NOT NULL THEN ts END IGNORE NULLS) OVER wa AS pt,
    last_value({val} IGNORE NULLS) OVER wa AS pv,
    last_value(CASE WHEN {val} IS NOT NULL THEN rn END IGNORE NULLS) OVER wa AS pr,
    first_value(CASE WHEN {val} IS NOT NULL THEN ts END IGNORE NULLS) OVER wf AS nt,
    first_value({val} IGNORE NULLS) OVER wf AS nv,
    first_value(CASE WHEN {val} IS NOT NULL THEN rn END IGNORE NULLS) OVER wf AS nr
  FROM {name}_rn
  WINDOW wa AS (PARTITION BY {key} ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wf AS (PARTITION BY {key} ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
