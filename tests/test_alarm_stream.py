"""Alarms as streams against the batch alarm; bulk lookup of URI fragments."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import alarms, governance
from ledgerline.streaming import alarms as stream_alarms

START = dt.datetime(2024, 1, 1)
SCHEMA = "created_at timestamp, is_fraud boolean"


def minute(m, fraud):
    return (START + dt.timedelta(minutes=m), fraud)


def deliver(spark, root, rows, n=2):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/src")
    periods = stream_alarms.fraud_rate_periods(spark.readStream.schema(SCHEMA).parquet(f"{root}/src"), watermark="30 minutes")
    q = stream_alarms.start_alarm(periods, F.col("fraud_rate_pct") > 5.0, f"{root}/out", f"{root}/ck", n_periods=n)
    q.awaitTermination()


def test_late_rows_and_streaks_over_batches(spark, tmp_dir):
    deliveries = [
        [minute(m, m in (6, 12)) for m in range(0, 40, 3)],
        [minute(m, m % 2 == 0) for m in range(16, 80, 4)] + [minute(13, True)],  # 13: late, within the watermark
        [minute(m, False) for m in range(80, 200, 5)],
    ]
    for rows in deliveries:
        deliver(spark, tmp_dir, rows)
    batch = alarms.fraud_rate_alarm(spark.createDataFrame(sum(deliveries, []), SCHEMA))
    closed = START + dt.timedelta(minutes=195 - 30)
    want = sorted(map(tuple, batch.where(F.col("period_end") <= F.lit(closed)).collect()))
    got = stream_alarms.read_alarm(spark, f"{tmp_dir}/out").select(*batch.columns).collect()
    assert sorted(map(tuple, got)) == want and any(r[-1] for r in want)
    on, moves = False, []
    for r in want:
        if r[-1] != on:
            on = r[-1]
            moves.append((r[0], "ALARM" if on else "OK"))
    moved = stream_alarms.read_alarm(spark, f"{tmp_dir}/out", "changes").orderBy("period_start").collect()
    assert [(r.period_start, r.state) for r in moved] == moves and len(moves) >= 2


def test_rows_behind_the_watermark_count_nowhere(spark, tmp_dir):
    deliver(spark, tmp_dir, [minute(0, True), minute(100, False)], n=1)
    before = stream_alarms.read_alarm(spark, f"{tmp_dir}/out").collect()
    deliver(spark, tmp_dir, [minute(1, True), minute(101, False)], n=1)
    assert stream_alarms.read_alarm(spark, f"{tmp_dir}/out").collect() == before and len(before) == 1


def test_fragments_are_found_as_by_contains(spark):
    uris = [f"s3/silver/{t}/day={d}" for t in ("tx", "alerts") for d in range(15)] + ["a", "ab/éü", ""]
    rows = [(f"l{i}", "j", "r", [(u,), (u,)]) for i, u in enumerate(uris)] + [("none", "j", "r", [(None,)]), ("empty", "j", "r", [])]
    lineage = spark.createDataFrame(rows, "lineage_id string, job_name string, run_id string, outputs array<struct<uri:string>>")
    parts = ["day=1", "tx/day=14", "x", "a", "éü", "s3/silver/alerts/day=3", "no such part", "silver", "/day=", "", None, "x", "lerts/d"]
    got = governance.upstream_containing(lineage, spark.createDataFrame([(p,) for p in parts], "fragment string"))
    want = sorted((p, f"l{i}") for p in {p for p in parts if p} for i, u in enumerate(uris) if p in u)
    assert sorted((r.fragment, r.lineage_id) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
