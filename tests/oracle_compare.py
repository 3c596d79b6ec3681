"""Run catalogue queries in Spark and their SQL twins in DuckDB and compare
row count, column types and values (order-insensitive)."""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE", "smallint": "SMALLINT",
    "tinyint": "TINYINT",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if type(v) is __import__("datetime").date:
        return __import__("datetime").datetime(v.year, v.month, v.day)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def _rows(pdf: pd.DataFrame, cols):
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    spdf = sdf.toPandas()
    t1 = time.time()
    rel = con.sql(sql)
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    dpdf = rel.df()
    t2 = time.time()
    problems = []
    if sorted(stypes) != sorted(dtypes):
        return [f"columns differ: spark={sorted(stypes)} duck={sorted(dtypes)}"], t1 - t0, t2 - t1
    for c in stypes:
        if SPARK_TO_DUCK.get(stypes[c], stypes[c]) != dtypes[c]:
            problems.append(f"type {c}: spark={stypes[c]} duck={dtypes[c]}")
    if len(spdf) != len(dpdf):
        problems.append(f"rows spark={len(spdf)} duck={len(dpdf)}")
    cols = sorted(stypes)
    a, b = _rows(spdf, cols), _rows(dpdf, cols)
    nbad = 0
    first = None
    for ra, rb in zip(a, b):
        if ra != rb:
            nbad += 1
            if first is None:
                first = (ra, rb)
    if nbad:
        problems.append(f"{nbad} differing rows, first: spark={first[0]} duck={first[1]}")
    return problems, t1 - t0, t2 - t1


def main(sf_dir: str, names=None):
    sys.path.insert(0, "/root/repo")
    from skyframe.session import get_spark
    import __spark_entry__ as E
    import os
    extra = {}
    if os.environ.get("ORACLE_SESSION_TZ"):          # check independence of the session zone
        extra["spark.sql.session.timeZone"] = os.environ["ORACLE_SESSION_TZ"]
    spark = get_spark("local[8]", shuffle_partitions=8, extra=extra)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n in names or sorted(qs):
        if n not in sqls:
            sdf = qs[n](spark, sf_dir)
            print(f"{n:28s} rows-only {sdf.count()} rows")
            continue
        try:
            probs, ts, td = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            probs, ts, td = [f"ERROR {type(e).__name__}: {str(e)[:600]}"], 0, 0
        status = "OK " if not probs else "BAD"
        bad += bool(probs)
        print(f"{status} {n:28s} spark {ts:6.2f}s duck {td:5.2f}s {'; '.join(probs)[:900]}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    sys.exit(1 if main(sf, names) else 0)
