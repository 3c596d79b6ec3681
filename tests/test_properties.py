"""Property test: the chunked neighbours core gives the same fills, gap lengths
and interpolation as a per-entity pandas computation, whatever the chunking."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skyframe.operators import gaps as GP
from skyframe.operators import series as SR

BASE = dt.datetime(2023, 12, 20)

series_st = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 24 * 90), st.one_of(st.none(), st.floats(-50, 50))),
    min_size=1, max_size=80)


def _expected(rows):
    out = {}
    df = pd.DataFrame(rows, columns=["k", "h", "v"]).drop_duplicates(["k", "h"]).sort_values(["k", "h"])
    for k, g in df.groupby("k"):
        idx = pd.DatetimeIndex([BASE + dt.timedelta(hours=int(h)) for h in g.h])
        s = pd.Series(g.v.astype("float64").to_numpy(), index=idx)
        isna = s.isna().to_numpy()
        run = np.zeros(len(s), dtype=int)
        i = 0
        while i < len(s):
            if isna[i]:
                j = i
                while j < len(s) and isna[j]:
                    j += 1
                run[i:j] = j - i
                i = j
            else:
                i += 1
        out[k] = pd.DataFrame({"ffill": s.ffill(), "bfill": s.bfill(), "time": s.interpolate(method="time"),
                               "gap": run}, index=idx)
    return df, out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=series_st, chunk=st.sampled_from(["day", "month"]))
def test_neighbours_match_pandas(spark, rows, chunk):
    df, exp = _expected(rows)
    sdf = spark.createDataFrame(
        [(int(k), BASE + dt.timedelta(hours=int(h)), None if pd.isna(v) else float(v))
         for k, h, v in df.itertuples(index=False)], "k long, ts timestamp_ntz, v double")
    got = {
        "ffill": SR.ffill(sdf, ["k"], "ts", ["v"], chunk),
        "bfill": SR.bfill(sdf, ["k"], "ts", ["v"], chunk),
        "time": SR.interpolate(sdf, ["k"], "ts", ["v"], "time", chunk=chunk),
    }
    for name, frame in got.items():
        for r in frame.collect():
            e = exp[r.k].loc[pd.Timestamp(r.ts), name]
            assert (r.v is None and pd.isna(e)) or abs(r.v - e) < 1e-9, (name, r, e)
    for r in GP.gap_info(sdf, ["k"], "ts", ["v"], chunk).collect():
        assert r.v_gap_len == exp[r.k].loc[pd.Timestamp(r.ts), "gap"]
