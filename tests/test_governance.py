"""Audit events, lineage, retention, alarms and dimensions."""

import datetime as dt
import json

from pyspark.sql import types as T

from ledgerline.operators import alarms, dims, governance


def test_lineage_record_and_lookup(spark):
    rec = governance.lineage_record(
        spark, "ingest-job", "GLUE_JOB", [{"type": "S3_PATH", "uri": "s3://raw/x"}],
        [{"type": "S3_PATH", "uri": "s3://bronze/x"}], "run1", {"layer": "raw→bronze"},
    )
    other = governance.stage_lineage(spark, "transform", "run2", "s3://bronze/x", "s3://silver/x")
    lin = rec.unionByName(other)
    r = governance.get_lineage(lin, "ingest-job#run1").first()
    assert r.lineage_id == "ingest-job#run1" and r.metadata_map["layer"] == "raw→bronze"
    assert governance.get_lineage(lin, "nope#1").count() == 0
    assert [x.run_id for x in governance.upstream_runs(lin, "s3://silver/x").collect()] == ["run2"]
    # substring mode also returns prefixes; exact mode does not
    assert governance.upstream_runs(lin, "s3://bronze").count() == 1
    assert governance.upstream_runs(lin, "s3://bronze", mode="exact").count() == 0
    uris = spark.createDataFrame([("s3://bronze/x",), ("s3://silver/x",)], "uri string")
    assert governance.upstream_of(lin, uris).count() == 2
    assert r.ttl - int(r.recorded_at.replace(tzinfo=dt.timezone.utc).timestamp()) == 365 * 86400


def test_schema_change_events_and_fingerprint(spark):
    old = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    new = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    ev = {r.subject + ":" + json.loads(r.payload)["column"]: r for r in governance.schema_change_events(spark, "fact", old, new, "me").collect()}
    kinds = {k: json.loads(v.payload)["change_type"] for k, v in ev.items()}
    assert kinds == {"fact:a": "TYPE_CHANGE", "fact:c": "ADD_COLUMN", "fact:b": "DROP_COLUMN"}
    assert all(len(v.fingerprint) == 16 for v in ev.values())
    again = governance.schema_change_events(spark, "fact", old, new, "other")
    assert {r.fingerprint for r in again.collect()} == {v.fingerprint for v in ev.values()}


def test_single_row_events_and_rollup(spark):
    ts = dt.datetime(2024, 1, 2, 3, 4, 5)
    e1 = governance.etl_run_event(spark, "ingest", "r1", "SUCCEEDED", 10, 8, 2, "s3://a", "s3://b", ts=ts)
    e2 = governance.access_event(spark, "analyst", "fact", "SELECT", "ALLOWED", {"rows": 5}, ts=ts)
    p = json.loads(e1.first().payload)
    assert p["records_quarantined"] == 2 and e1.first().event_type == "ETL_RUN"
    roll = {(r.event_type, r.actor): r.event_count for r in governance.audit_by_actor_day(e1.unionByName(e2)).collect()}
    assert roll == {("ETL_RUN", "etl-service"): 1, ("DATA_ACCESS", "analyst"): 1}


def test_retention(spark):
    df = spark.createDataFrame([("a", 100), ("b", 2_000_000_000)], "id string, ttl long")
    assert [r.id for r in governance.compact_expired(df, "2024-01-01").collect()] == ["b"]


def test_fraud_rate_alarm_needs_consecutive_periods(spark):
    t = dt.datetime(2024, 1, 1)
    rows_ = [
        (t + dt.timedelta(minutes=1), True),
        (t + dt.timedelta(minutes=6), True),  # next window: two in a row -> alarm
        (t + dt.timedelta(minutes=16), True),  # gap window (10-15) without data: streak restarts
        (t + dt.timedelta(minutes=21), False),
    ]
    df = spark.createDataFrame(rows_, "created_at timestamp, is_fraud boolean")
    got = {r.period_start.minute: (r.breach, r.alarm) for r in alarms.fraud_rate_alarm(df).collect()}
    assert got == {0: (True, False), 5: (True, True), 15: (True, False), 20: (False, False)}


def test_dq_failure_alarm(spark):
    m = spark.createDataFrame(
        [("FailedChecks", 0.0, dt.datetime(2024, 1, 1, 0, 1)), ("FailedChecks", 2.0, dt.datetime(2024, 1, 1, 0, 7)), ("PassedChecks", 9.0, dt.datetime(2024, 1, 1, 0, 1))],
        "metric string, value double, ts timestamp",
    )
    got = {r.period_start.minute: r.alarm for r in alarms.dq_failure_alarm(m).collect()}
    assert got == {0: False, 5: True}


def test_dim_date(spark):
    b = spark.createDataFrame([(dt.date(2023, 12, 30), dt.date(2024, 1, 2))], "lo date, hi date")
    d = {r.full_date: r for r in dims.dim_date_between(b, fiscal_start_month=10, holidays=["2024-01-01"]).collect()}
    assert len(d) == 4
    r = d[dt.date(2024, 1, 1)]
    assert (r.date_key, r.month_name, r.day_name, r.is_us_holiday, r.fiscal_year, r.fiscal_quarter) == (20240101, "January", "Monday", True, 2024, 2)
    assert d[dt.date(2023, 12, 30)].fiscal_year == 2024 and d[dt.date(2023, 12, 30)].is_weekend


def test_a_repeated_append_is_read_once(spark, tmp_dir):
    at = dt.datetime(2024, 1, 1, 10, 0, 0, 123456, tzinfo=dt.timezone.utc)
    event = governance.etl_run_event(spark, "job", "r1", "SUCCEEDED", 1, 1, 0, "a", "b", ts=at)
    for _ in range(2):
        governance.append_audit(event, f"{tmp_dir}/audit")
    got = governance.read_audit(spark, f"{tmp_dir}/audit")
    assert [r.asDict() for r in got.collect()] == [r.asDict() for r in event.select(*got.columns).collect()]


def test_lineage_of_a_rerun_replaces_the_first(spark, tmp_dir):
    for day, uri in ((1, "s3://old"), (2, "s3://new")):
        rec = governance.lineage_record(
            spark, "job", "GLUE_JOB", [], [{"type": "S3_PATH", "uri": uri}], "r1", recorded_at=dt.datetime(2024, 1, day)
        )
        governance.append_lineage(rec, f"{tmp_dir}/lineage")
    assert [r.outputs[0].uri for r in governance.read_lineage(spark, f"{tmp_dir}/lineage").collect()] == ["s3://new"]
