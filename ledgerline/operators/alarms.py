"""Metric alarms over tumbling windows (STR8, STR9).

``metric_alarm`` aggregates a metric per tumbling event-time window and
raises an alarm when the statistic breaches the threshold in
``n_periods`` consecutive (adjacent) windows; windows without data break a
streak.  The streak check is a RANGE window partitioned by day: a window
alarms when the ``(n_periods - 1) * period`` seconds before it, itself
included, hold ``n_periods`` breaching windows (window starts are unique, so
that means all of them).  Windows in the last part of a day are also copied
into the next day's partition, so streaks across midnight are seen; no
single-partition window over the whole timeline and no self-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import count_when, div_round_half_away

_STATS = {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min, "count": F.count}


def _streak(g: DataFrame, breach: Column, period_s: int, n_periods: int, bucket_s: int = 86400) -> DataFrame:
    span = (n_periods - 1) * period_s
    bucket_s = max(bucket_s, span + period_s)
    cols = g.columns
    sec = F.unix_seconds("period_start")
    g = g.select("*", F.coalesce(breach, F.lit(False)).alias("breach"), sec.alias("_s"))
    g = g.withColumn("_bk", F.floor(F.col("_s") / F.lit(bucket_s)).cast("long"))
    halo = (F.col("_s") >= (F.col("_bk") + 1) * bucket_s - span) & F.lit(n_periods > 1)
    e = g.select("*", F.explode(F.when(halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    w = Window.partitionBy(F.col("_bk") + F.col("_copy")).orderBy("_s").rangeBetween(-span, 0)
    alarm = F.sum(F.col("breach").cast("int")).over(w) == n_periods
    return e.select(*cols, "breach", alarm.alias("alarm"), "_copy").where(F.col("_copy") == 0).drop("_copy")


def metric_alarm(
    df: DataFrame,
    ts_col: str,
    value_col: str,
    threshold: float,
    stat: str = "avg",
    period_s: int = 300,
    n_periods: int = 2,
) -> DataFrame:
    """Generic alarm: stat(value) per ``period_s`` window > threshold for ``n_periods`` in a row."""
    g = df.groupBy(F.window(F.col(ts_col).cast("timestamp"), f"{period_s} seconds").alias("w")).agg(
        _STATS[stat](F.col(value_col)).alias("value"), F.count(F.lit(1)).alias("n")
    )
    g = g.select(F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"), "value", "n")
    return _streak(g, F.col("value") > F.lit(threshold), period_s, n_periods)


def fraud_rate_alarm(
    scored: DataFrame,
    ts_col: str = "created_at",
    threshold_pct: float = 5.0,
    period_s: int = 300,
    n_periods: int = 2,
) -> DataFrame:
    """STR8: fraud rate % (is_fraud share, 3 dp exact) per window; alarm after
    ``n_periods`` consecutive windows above ``threshold_pct``."""
    g = scored.groupBy(F.window(F.col(ts_col).cast("timestamp"), f"{period_s} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("n"), count_when(F.col("is_fraud")).alias("fraud_count")
    )
    q = div_round_half_away(F.col("fraud_count").cast("decimal(38,0)") * F.lit(100000), F.col("n"))
    g = g.select(
        F.col("w.start").alias("period_start"),
        F.col("w.end").alias("period_end"),
        "n",
        "fraud_count",
        (q.cast("double") / F.lit(1000.0)).alias("fraud_rate_pct"),
        q.alias("_q"),
    )
    out = _streak(g, F.col("_q") > F.lit(int(round(threshold_pct * 1000))), period_s, n_periods)
    return out.drop("_q")


def dq_failure_alarm(metrics: DataFrame, period_s: int = 300) -> DataFrame:
    """STR9: Sum(FailedChecks) > 0 in a window (metrics rows: metric, value, ts)."""
    failed = metrics.where(F.col("metric") == "FailedChecks")
    return metric_alarm(failed, "ts", "value", 0.0, stat="sum", period_s=period_s, n_periods=1)
