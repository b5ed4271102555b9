"""The metric alarms as streams (STR8, STR9): closed periods judged once, a row per change of state.

Records are counted in watermarked windows; a window leaves the aggregation when
the watermark has passed its end (append mode), so that late rows within the
watermark count in their period.  Each micro-batch judges the periods that it
closes together with the periods just before them, which are read back from the
earlier batches' output: ``n_periods - 1`` periods, whatever the history.  The
folders ``periods`` and ``changes`` have one ``batch_id=N`` folder per batch,
which a replay overwrites.

Defined results: rows behind the watermark count in no period; a period without
rows breaks a streak, as in the batch alarm; no rows make no period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import div_round_half_away
from ..operators.alarms import _STATS, _streak


def fraud_rate_periods(scored: DataFrame, ts_col: str = "created_at", period_s: int = 300, watermark: str = "10 minutes") -> DataFrame:
    """n, fraud_count and fraud_rate_pct of each closed window of a stream of scored rows."""
    rows = scored.withWatermark(ts_col, watermark)
    g = rows.groupBy(F.window(ts_col, f"{period_s} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_fraud").alias("fraud_count")
    )
    q = div_round_half_away(F.col("fraud_count").cast("decimal(38,0)") * F.lit(100000), F.col("n"))
    rate = (q.cast("double") / F.lit(1000.0)).alias("fraud_rate_pct")
    return g.select(F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"), "n", "fraud_count", rate)


def metric_periods(metrics: DataFrame, stat: str = "sum", period_s: int = 300, watermark: str = "10 minutes") -> DataFrame:
    """value and n of each closed window of a stream of metric rows (ts, value)."""
    g = metrics.withWatermark("ts", watermark).groupBy(F.window("ts", f"{period_s} seconds").alias("w"))
    g = g.agg(_STATS[stat](F.col("value")).alias("value"), F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"), "value", "n")


def changes(judged: DataFrame) -> DataFrame:
    """period_start, period_end, state of each period in which the alarm went on or off; one row a period is ordered."""
    before = F.lag("alarm", 1, False).over(Window.orderBy("period_start"))
    moved = judged.withColumn("was", before).where(F.col("alarm") != F.col("was"))
    return moved.select("period_start", "period_end", F.when(F.col("alarm"), "ALARM").otherwise("OK").alias("state"))


def make_alarm_sink(out_dir: str, breach: Column, period_s: int, n_periods: int):
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.persist()
        try:
            first = new.agg(F.min("period_start").alias("t")).first()["t"]
            if first is None:
                return
            before = earlier(spark, batch_id, new.columns, first)
            judged = _streak(new.unionByName(before), breach, period_s, n_periods)
            judged.where(F.col("period_start") >= F.lit(first)).write.mode("overwrite").parquet(f"{out_dir}/periods/batch_id={batch_id}")
            # the state that the changes start from is that of the last period before
            known = spark.read.schema(judged.schema).parquet(f"{out_dir}/periods/batch_id={batch_id}")
            last = _read(spark, out_dir, "periods", batch_id)
            if last is not None:
                known = known.unionByName(last.where(F.col("period_start") < F.lit(first)).orderBy(F.desc("period_start")).limit(1).select(*known.columns))
            changes(known).where(F.col("period_start") >= F.lit(first)).write.mode("overwrite").parquet(f"{out_dir}/changes/batch_id={batch_id}")
        finally:
            new.unpersist()

    def earlier(spark: SparkSession, batch_id: int, columns: list[str], first) -> DataFrame:
        """The periods of earlier batches that a streak ending at ``first`` or later can reach."""
        last = _read(spark, out_dir, "periods", batch_id)
        if last is None:
            return spark.range(0).select(*(F.lit(None).alias(c) for c in columns))
        since = F.lit(first) - F.make_dt_interval(secs=F.lit(float((n_periods - 1) * period_s)))
        return last.where((F.col("period_start") >= since) & (F.col("period_start") < F.lit(first))).select(*columns)

    return sink


def _read(spark: SparkSession, out_dir: str, name: str, before: int | None = None) -> DataFrame | None:
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{name}")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    numbers = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root) if s.getPath().getName().startswith("batch_id=")]
    paths = [f"{out_dir}/{name}/batch_id={n}" for n in sorted(numbers) if before is None or n < before]
    return spark.read.parquet(*paths) if paths else None


def start_alarm(
    periods: DataFrame, breach: Column, out_dir: str, checkpoint_dir: str, period_s: int = 300, n_periods: int = 2, available_now: bool = True
):
    """The stream that judges ``periods``; its results are ``periods`` and ``changes`` below ``out_dir``."""
    w = periods.writeStream.outputMode("append").foreachBatch(make_alarm_sink(out_dir, breach, period_s, n_periods))
    w = w.option("checkpointLocation", checkpoint_dir)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{period_s} seconds")).start()


def read_alarm(spark: SparkSession, out_dir: str, name: str = "periods") -> DataFrame:
    found = _read(spark, out_dir, name)
    if found is None:
        raise FileNotFoundError(f"no period was closed yet in {out_dir}")
    return found
