"""Missing-value reports: per-variable summary (A1), missing-sample report with
nearest valid neighbours (W14) and the quality-code lookup (J3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .series import neighbours, next_col, prev_col, q


def missing_summary(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A1: per entity and variable: ``missing`` count, ``total`` rows and
    ``percent`` (0 for an empty entity). One aggregation pass, then unpivot."""
    keys = list(keys)
    cols = list(cols)
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    a = df.groupBy(*keys).agg(*aggs)
    long = a.unpivot([*keys, "total"], cols, "variable", "missing")
    pct = F.when(F.col("total") > 0, F.col("missing") / F.col("total") * 100.0).otherwise(F.lit(0.0))
    return long.select(*keys, "variable", F.col("missing").cast("long").alias("missing"),
                       F.col("total").cast("long").alias("total"), pct.alias("percent"))


def missing_report(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str],
                   limit: int | None = 20, rmk: dict | None = None, chunk="month") -> DataFrame:
    """Every missing sample of every variable with the previous and next
    valid time and value and its quality code; the first ``limit`` samples per
    entity and variable (all when ``limit`` is falsy), plus ``total_missing``.

    One pass over the wide frame gives the neighbours and the running count of
    missing samples of every variable; only the null samples within the limit
    become rows of their own, after the shuffle.
    """
    keys, cols, rmk = list(keys), list(cols), dict(rmk or {})
    wide = df.select(*keys, ts, *[F.col(c).cast("double").alias(c) for c in cols],
                     *dict.fromkeys(rmk[c] for c in cols if c in rmk))
    nb = neighbours(wide, keys, ts, cols, chunk, counts={f"__ord_{c}": f"{q(c)} IS NULL" for c in cols})
    samples = []
    for c in cols:
        wanted = F.col(c).isNull()
        if limit:
            wanted = wanted & (F.col(f"__ord_{c}") <= limit)
        p, n = F.col(prev_col(c)), F.col(next_col(c))
        samples.append(F.when(wanted, F.struct(
            F.lit(c).alias("variable"), (F.col(rmk[c]) if c in rmk else F.lit(None)).try_cast("int").alias("rmk"),
            p["t"].alias("prev_time"), p["v"].alias("prev_value"), n["t"].alias("next_time"), n["v"].alias("next_value"),
            F.col(f"__ord_{c}").alias("ordinal"), F.col(f"__ord_{c}_total").alias("total_missing"))))
    out = nb.select(*keys, ts, F.explode(F.array_compact(F.array(*samples))).alias("__s"))
    return out.select(*keys, "__s.variable", ts, *[f"__s.{c}" for c in (
        "rmk", "prev_time", "prev_value", "next_time", "next_value", "ordinal", "total_missing")])


def attach_rmk(report: DataFrame, rmk_long: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Left join report rows to a long quality table
    ``(keys, ts, variable, rmk)``."""
    on = list(keys) + [ts, "variable"]
    return report.drop("rmk").join(rmk_long.select(*on, "rmk").hint("merge"), on=on, how="left")
