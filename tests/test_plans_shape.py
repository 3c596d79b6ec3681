"""Physical-plan shape of the core series primitive: windows sit on an
exchange partitioned by (entity, chunk), never by the entity alone, and no
window frame reaches UNBOUNDED FOLLOWING."""

import datetime as dt

from skyframe.operators import series as SR


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_neighbours_partitioning(spark):
    rows = [(1, dt.datetime(2020, 1, 1) + dt.timedelta(hours=h), float(h) if h % 5 else None)
            for h in range(24 * 90)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double")
    plan = _plan(SR.interpolate(df, ["k"], "ts", ["v"], "time"))
    assert "hashpartitioning(k#" in plan and "__chunk#" in plan
    part_lines = [ln for ln in plan.splitlines() if "hashpartitioning(k#" in ln]
    assert any("__chunk" in ln for ln in part_lines)
    assert "unboundedfollowing" not in plan.lower().replace(" ", "")
