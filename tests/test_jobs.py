"""End-to-end batch jobs on generated raw files, and the generator itself."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import jobs
from ledgerline.sources.generator import generate


def test_generator_is_deterministic_and_partition_independent(spark):
    a = generate(spark, 2000, 50, 30, seed=3, end_date="2024-01-31", partitions=1)
    b = generate(spark, 2000, 50, 30, seed=3, end_date="2024-01-31", partitions=7)
    assert a.count() == 2000
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    r = a.agg(
        F.min("transaction_date").alias("lo"),
        F.max("transaction_date").alias("hi"),
        F.count_distinct("account_id").alias("acc"),
        F.max("amount").alias("mx"),
        F.count_if(F.col("merchant_id").isNull() & (F.col("transaction_type") != "TRANSFER")).alias("bad_merchant"),
        F.count_if(F.col("merchant_id").rlike("^[0-9]{4}-")).alias("mcc"),
    ).first()
    assert str(r.lo) >= "2024-01-01" and str(r.hi) <= "2024-01-31"
    assert r.acc <= 50 and float(r.mx) <= 99999.99 and r.bad_merchant == 0 and r.mcc > 0
    st = {x.status: x["count"] for x in a.groupBy("status").count().collect()}
    assert st["SETTLED"] > 1500


def test_ingest_transform_load_validate(spark, tmp_dir):
    raw = generate(spark, 3000, 40, 20, seed=11, end_date="2024-01-31")
    bad = spark.createDataFrame([("x", None, "WIRE")], "transaction_id string, account_id string, transaction_type string")
    raw = raw.unionByName(bad, allowMissingColumns=True)
    raw.write.option("header", "true").csv(f"{tmp_dir}/raw")
    c = jobs.ingest(spark, f"{tmp_dir}/raw", f"{tmp_dir}/bronze", f"{tmp_dir}/quarantine")
    assert c == {"records_read": 3001, "records_written": 3000, "records_quarantined": 1}
    bronze = spark.read.parquet(f"{tmp_dir}/bronze")
    assert bronze.where(F.length("account_id") != 64).count() == 0
    assert bronze.where(F.col("source_file").isNull()).count() == 0
    assert jobs.transform(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver") == {"records_read": 3000, "records_written": 3000}
    assert jobs.load(spark, f"{tmp_dir}/silver", f"{tmp_dir}/fact1") == {"records_read": 3000, "records_written": 3000}
    # reloading the same silver into the fact is idempotent
    assert jobs.load(spark, f"{tmp_dir}/silver", f"{tmp_dir}/fact2", f"{tmp_dir}/fact1") == {"records_read": 3000, "records_written": 3000}
    f1 = spark.read.parquet(f"{tmp_dir}/fact1").drop("ingestion_timestamp")
    f2 = spark.read.parquet(f"{tmp_dir}/fact2").drop("ingestion_timestamp")
    assert f1.exceptAll(f2).count() == 0 and len(f1.columns) == 25
    s = jobs.validate_job(spark, f"{tmp_dir}/silver", f"{tmp_dir}/dq", run_date="2024-02-01")
    assert s["total"] == 18 and s["passed"] + s["failed"] == 18
    assert spark.read.json(f"{tmp_dir}/dq/results").count() == 18
    ev = spark.read.json(f"{tmp_dir}/dq/audit").first()
    assert ev.event_type == "DATA_QUALITY_RESULT" and '"checks_failed"' in ev.payload


def test_cli_pipeline_and_validation_exit_code(spark, tmp_dir, capsys):
    from ledgerline.plans.cli import main

    d = tmp_dir
    assert main(["generate", "--records", "500", "--accounts", "20", "--days", "10", "--output", f"{d}/raw"], stop_session=False) == 0
    assert main(["ingest", "--source", f"{d}/raw", "--bronze", f"{d}/b", "--quarantine", f"{d}/q"], stop_session=False) == 0
    assert main(["transform", "--bronze", f"{d}/b", "--silver", f"{d}/s"], stop_session=False) == 0
    code = main(["validate", "--input", f"{d}/s", "--output", f"{d}/dq", "--run-date", "2024-01-01"], stop_session=False)
    last = capsys.readouterr().out.strip().splitlines()[-1]
    import json

    summary = json.loads(last)
    assert code == (0 if summary["overall_success"] else 1)
    assert summary["total"] == 18


def test_incremental_ingest_stream_reads_only_new_files(spark, tmp_dir):
    raw, bronze, quar, ck = f"{tmp_dir}/raw", f"{tmp_dir}/bronze", f"{tmp_dir}/q", f"{tmp_dir}/ck"
    generate(spark, 400, 10, 5, seed=1, end_date="2024-01-31").coalesce(1).write.option("header", "true").csv(f"{raw}/a")
    for q in jobs.start_ingest_stream(spark, f"{raw}/*", bronze, quar, ck):
        q.awaitTermination()
    assert spark.read.parquet(bronze).count() == 400
    for q in jobs.start_ingest_stream(spark, f"{raw}/*", bronze, quar, ck):  # nothing new
        q.awaitTermination()
    assert spark.read.parquet(bronze).count() == 400
    generate(spark, 100, 10, 5, seed=2, end_date="2024-01-31").coalesce(1).write.option("header", "true").csv(f"{raw}/b")
    for q in jobs.start_ingest_stream(spark, f"{raw}/*", bronze, quar, ck):
        q.awaitTermination()
    got = spark.read.parquet(bronze)
    assert got.count() == 500 and got.select("transaction_id").distinct().count() == 500


def test_jobs_append_audit_and_lineage(spark, tmp_dir):
    d = tmp_dir
    generate(spark, 200, 10, 5, seed=4, end_date="2024-01-31").write.option("header", "true").csv(f"{d}/raw")
    jobs.ingest(spark, f"{d}/raw", f"{d}/b", f"{d}/q", run_id="r1", audit_path=f"{d}/audit", lineage_path=f"{d}/lin")
    jobs.transform(spark, f"{d}/b", f"{d}/s", run_id="r1", audit_path=f"{d}/audit", lineage_path=f"{d}/lin")
    audit = spark.read.json(f"{d}/audit")
    assert sorted(r.subject for r in audit.collect()) == ["ingest-job#r1", "transform-job#r1"]
    lin = spark.read.parquet(f"{d}/lin")
    from ledgerline.operators import governance

    up = governance.upstream_runs(lin, f"{d}/s", mode="exact").collect()
    assert [(r.job_name, r.job_type) for r in up] == [("financial-transform-job", "GLUE_JOB")]


def test_a_run_that_fails_has_an_event_with_the_counts_of_none(spark, tmp_dir):
    import json

    d = tmp_dir
    with pytest.raises(Exception):
        jobs.transform(spark, f"{d}/missing", f"{d}/s", run_id="r1", audit_path=f"{d}/audit", lineage_path=f"{d}/lin")
    event = spark.read.json(f"{d}/audit").collect()
    assert [json.loads(e.payload)["status"] for e in event] == ["FAILED"]
    assert not os.path.exists(f"{d}/lin")


def test_a_run_counts_what_it_read_and_wrote(spark, tmp_dir):
    import json

    d = tmp_dir
    generate(spark, 60, 5, 5, seed=4, end_date="2024-01-31").coalesce(1).write.option("header", "true").csv(f"{d}/raw")
    for _ in range(2):
        jobs.ingest(spark, f"{d}/raw", f"{d}/b", f"{d}/q")
    jobs.transform(spark, f"{d}/b", f"{d}/s", run_id="r1", audit_path=f"{d}/audit")
    payload = json.loads(spark.read.json(f"{d}/audit").first().payload)
    assert (payload["records_read"], payload["records_written"], payload["status"]) == (120, 60, "SUCCEEDED")


def test_further_attempts_of_an_ingest_append_nothing_twice(spark, tmp_dir, monkeypatch):
    raw = generate(spark, 500, 20, 10, seed=5, end_date="2024-01-31")
    raw.write.option("header", "true").csv(f"{tmp_dir}/raw")
    run = lambda i: jobs.ingest(spark, f"{tmp_dir}/raw", f"{tmp_dir}/bronze", f"{tmp_dir}/quarantine", run_id=i, by_run=True)
    write, calls = jobs._write_partitioned, []

    def fails_at_the_second(*args, **kw):
        calls.append(args[1])
        if len(calls) == 2:
            raise OSError("no space")
        write(*args, **kw)

    monkeypatch.setattr(jobs, "_write_partitioned", fails_at_the_second)
    with pytest.raises(OSError):
        run("day-1")
    monkeypatch.undo()
    assert run("day-1")["records_written"] == 500
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() == 500
    run("day-2")  # another run does append
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() == 1000
    jobs.transform(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver")
    silver = spark.read.parquet(f"{tmp_dir}/silver")
    assert silver.count() == 500 and "ingest_run" not in silver.columns
    for bad in (None, "", "a/b", "x=y"):
        with pytest.raises(ValueError):
            run(bad)


def test_rows_are_deduplicated_only_where_ids_repeat(spark, tmp_dir, monkeypatch):
    from ledgerline.operators import etl
    from ledgerline.plans.catalog import bronze_t

    one = bronze_t(spark, "/root/testdata/sf0.001").limit(20)
    one.write.parquet(f"{tmp_dir}/once")
    one.unionByName(one.limit(5)).write.parquet(f"{tmp_dir}/twice")
    calls, whole = [], etl.dedupe_latest
    monkeypatch.setattr(etl, "dedupe_latest", lambda *a, **k: calls.append(1) or whole(*a, **k))
    for layer, n in (("once", 0), ("twice", 1)):
        assert jobs.transform(spark, f"{tmp_dir}/{layer}", f"{tmp_dir}/silver-{layer}")["records_written"] == 20
        assert len(calls) == n
    silver = spark.read.parquet(f"{tmp_dir}/silver-once")
    silver.unionByName(silver.limit(5)).write.parquet(f"{tmp_dir}/silver-repeats")
    for layer, prev in (("silver-once", None), ("silver-once", "a"), ("silver-repeats", None), ("silver-repeats", "a")):
        calls.clear()
        out = f"{tmp_dir}/fact/" + (f"{layer}-{prev}" if prev or layer != "silver-once" else "a")
        counts = jobs.load(spark, f"{tmp_dir}/{layer}", out, prev and f"{tmp_dir}/fact/{prev}")
        assert counts["records_written"] == 20 and counts["records_read"] == (20 if layer == "silver-once" else 25)
        assert bool(calls) == (layer == "silver-repeats")
    none = spark.createDataFrame([(None,), ("a",)], "k string")
    assert not etl.has_repeats(none, "k") and etl.has_repeats(none.unionByName(none.where("k is null")), "k")
