"""End-to-end batch jobs (JOB1-JOB3, JOB5, JOB6) and the incremental ingest stream.

Each job is one DataFrame plan per sink; row counts come from
``DataFrame.observe`` on the write itself (AGG10), so no extra count jobs run.

Writes partitioned by date sort rows within each task by the partition
column first, so a task streams one file per date instead of keeping a
writer open per date, and ``maxRecordsPerFile`` caps file size; no
repartition by date is used (one hot date would otherwise land in one task).
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..config import load_suite
from ..operators import etl, governance, quality
from ..operators.fact_table import FactTable
from ..schemas import CORRUPT_COLUMN
from ..sources.files import read_layer, read_raw, read_raw_stream
from ..sources.generator import generate

MAX_RECORDS_PER_FILE = 5_000_000
#: Of the layers' Parquet files.
COMPRESSION = "zstd"
#: Partition column of layers that hold a folder per ingest run.
RUN_COLUMN = "ingest_run"


log = logging.getLogger(__name__)


def _aside(name: str, write) -> None:
    """A record about the run that can't be written is logged: the run's data stand without it."""
    try:
        write()
    except Exception as e:  # noqa: BLE001
        log.error("%s not written: %s", name, e)


@contextmanager
def _recorded(
    spark: SparkSession,
    stage: str,
    src: str,
    dst: str,
    run_id: str | None,
    audit_path: str | None,
    lineage_path: str | None,
) -> Iterator[dict[str, int]]:
    """AUD1 + LIN4: append the run's ETL_RUN event, with the counts that the job filled in, and its
    lineage row.  A run that raises has a FAILED event and no lineage."""
    run_id = run_id or uuid.uuid4().hex
    counts: dict[str, int] = {}
    status = "FAILED"
    try:
        yield counts
        status = "SUCCEEDED"
    finally:
        if audit_path:
            totals = [counts.get(k, 0) for k in ("records_read", "records_written", "records_quarantined")]
            event = governance.etl_run_event(spark, f"{stage}-job", run_id, status, *totals, src, dst)
            _aside("audit", lambda: governance.append_audit(event, audit_path))
    if lineage_path:
        _aside("lineage", lambda: governance.append_lineage(governance.stage_lineage(spark, stage, run_id, src, dst), lineage_path))


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _write_partitioned(df: DataFrame, path: str, col: str, mode: str, dynamic: bool = False) -> None:
    """``mode`` overwrite replaces the whole table; with ``dynamic`` only the partitions that df has."""
    (
        df.sortWithinPartitions(col)
        .write.mode(mode)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("compression", COMPRESSION)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(col)
        .parquet(path)
    )


def ingest(
    spark: SparkSession,
    source_path: str,
    bronze_path: str,
    quarantine_path: str,
    fmt: str = "csv",
    strict: bool = False,
    salt: str | None = None,
    run_id: str | None = None,
    audit_path: str | None = None,
    lineage_path: str | None = None,
    by_run: bool = False,
) -> dict[str, int]:
    """JOB1: raw files -> mask -> metadata -> valid to bronze / rest to quarantine.

    The files are read and masked once: the first write keeps the rows on the
    executors' disks for the second (lost blocks are read again).

    Rows are appended, so a run that is tried again appends them again.  With
    ``by_run`` both layers hold a folder ``ingest_run=<run_id>`` per run, which a
    further attempt of the run replaces, whatever an earlier one left there.  A
    layer is written in one of the two ways.
    """
    if by_run and not re.fullmatch(r"[\w.-]+", run_id or ""):
        raise ValueError(f"by_run needs a run_id of letters, digits, '_', '.' and '-', not {run_id!r}")
    mode, folder = ("overwrite", f"/{RUN_COLUMN}={run_id}") if by_run else ("append", "")
    with _recorded(spark, "ingest", source_path, bronze_path, run_id, audit_path, lineage_path) as counts:
        raw = read_raw(spark, source_path, fmt)
        raw = raw.withColumn("_src", F.col("_metadata.file_path"))
        df = etl.add_ingestion_metadata(etl.mask_pii(raw, salt), F.col("_src")).drop("_src")
        df = df.persist(StorageLevel.DISK_ONLY)
        try:
            valid, quarantine = etl.split_valid(df, strict)
            valid, ov = _observed(valid.drop(CORRUPT_COLUMN), "bronze")
            quarantine, oq = _observed(quarantine, "quarantine")
            _write_partitioned(valid, bronze_path + folder, "transaction_date", mode)
            _write_partitioned(quarantine, quarantine_path + folder, "ingestion_date", mode)
        finally:
            df.unpersist()
        w, q = int(ov.get["rows"]), int(oq.get["rows"])
        counts.update(records_read=w + q, records_written=w, records_quarantined=q)
    return counts


def transform(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    default_rate: str | None = None,
    run_id: str | None = None,
    audit_path: str | None = None,
    lineage_path: str | None = None,
    only_new_dates: bool = False,
) -> dict[str, int]:
    """JOB2: bronze -> normalise, enrich, dedupe, derive -> silver (full overwrite).

    ``only_new_dates`` replaces only the dates that bronze has; right only where
    no transaction's date moves and bronze holds each of its dates in full.
    """
    with _recorded(spark, "transform", bronze_path, silver_path, run_id, audit_path, lineage_path) as counts:
        layer = read_layer(spark, bronze_path).drop(RUN_COLUMN)
        bronze, read = _observed(layer, "bronze")
        repeats = etl.has_repeats(layer, "transaction_id")
        silver, obs = _observed(etl.to_silver(bronze, default_rate=default_rate, dedupe=repeats), "silver")
        _write_partitioned(silver, silver_path, "transaction_date", "overwrite", dynamic=only_new_dates)
        counts.update(records_read=int(read.get["rows"]), records_written=int(obs.get["rows"]))
    return counts


def load(
    spark: SparkSession,
    silver_path: str,
    fact_out: str,
    fact_prev: str | None = None,
    run_id: str | None = None,
    audit_path: str | None = None,
    lineage_path: str | None = None,
) -> dict[str, int]:
    """JOB3: conform silver to the fact layout and upsert it into the previous
    fact version, writing a new version folder (readers switch to it after the
    write succeeds; the previous version stays intact for rollback).  A version
    folder that exists is refused."""
    with _recorded(spark, "load", silver_path, fact_out, run_id, audit_path, lineage_path) as counts:
        target = spark._jvm.org.apache.hadoop.fs.Path(fact_out)
        if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
            raise FileExistsError(f"a fact version needs a folder of its own: {fact_out}")
        layer = read_layer(spark, silver_path)
        silver, read = _observed(layer, "silver")
        staging = etl.conform_fact(silver)
        repeats = etl.has_repeats(etl.conform_fact(layer), "transaction_id")
        if fact_prev:
            merged = etl.upsert(read_layer(spark, fact_prev).select(*staging.columns), staging, dedupe_staging=repeats)
        elif repeats:
            merged = etl.dedupe_latest(staging, ["transaction_id"], ["updated_at"], hash_tiebreak=True)
        else:
            merged = staging
        merged, obs = _observed(merged, "fact")
        _write_partitioned(merged, fact_out, "transaction_date", "errorifexists")
        counts.update(records_read=int(read.get["rows"]), records_written=int(obs.get["rows"]))
    return counts


def merge_fact(
    spark: SparkSession,
    silver_path: str,
    fact_path: str,
    buckets: int = 64,
    run_id: str | None = None,
    audit_path: str | None = None,
    lineage_path: str | None = None,
) -> dict[str, int]:
    """JOB3 into a ``FactTable``: only files that hold updated transactions are rewritten."""
    with _recorded(spark, "load", silver_path, fact_path, run_id, audit_path, lineage_path) as counts:
        silver, read = _observed(read_layer(spark, silver_path), "silver")
        row = FactTable(spark, fact_path, buckets=buckets).merge(etl.conform_fact(silver), run_id=run_id)
        counts.update(records_read=int(read.get["rows"]), records_written=row["staged"] + row["copied"])
    return counts


def validate_job(
    spark: SparkSession,
    path: str,
    out_dir: str,
    dataset: str = "transactions",
    suite_path: str | None = None,
    run_date: str | None = None,
) -> dict[str, Any]:
    """JOB5: Parquet -> suite -> results JSON under dataset/run_date, metrics rows; returns the summary."""
    import datetime as dt

    run_date = run_date or dt.datetime.now(dt.timezone.utc).date().isoformat()
    results = quality.validate_isolated(read_layer(spark, path), load_suite(suite_path))
    results = results.persist()
    try:
        # only this dataset's day is replaced: earlier results stay
        (
            results.withColumn("dataset", F.lit(dataset))
            .withColumn("run_date", F.lit(run_date))
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("dataset", "run_date")
            .json(f"{out_dir}/results")
        )
        summary = quality.summarize(results)
        quality.metrics_rows(summary, dataset).write.mode("append").parquet(f"{out_dir}/metrics")
        _aside("audit", lambda: governance.append_audit(governance.dq_result_events(results, dataset, run_date), f"{out_dir}/audit"))
        row = summary.first().asDict()  # one row: the suite summary
    finally:
        results.unpersist()
    row.update({"dataset": dataset, "run_date": run_date})
    return row


def exit_code(summary: dict[str, Any]) -> int:
    """DQ12: 0 where every expectation of a validation passed, else 1."""
    return 0 if summary.get("overall_success") else 1


def generate_job(spark: SparkSession, out: str, n: int = 10000, n_accounts: int = 1000, days_back: int = 90, fmt: str = "csv", **kw) -> None:
    """JOB6: write synthetic raw transactions (CSV with header, or JSON/Parquet)."""
    df = generate(spark, n, n_accounts, days_back, **kw)
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(out)
    elif fmt == "json":
        w.json(out)
    else:
        w.parquet(out)


def start_ingest_stream(
    spark: SparkSession,
    source_path: str,
    bronze_path: str,
    quarantine_path: str,
    checkpoint_dir: str,
    fmt: str = "csv",
    available_now: bool = True,
):
    """SRC3/STR10: incremental ingest — only new files, exactly-once file sinks."""
    raw = read_raw_stream(spark, source_path, fmt)
    raw = raw.withColumn("_src", F.col("_metadata.file_path"))
    df = etl.add_ingestion_metadata(etl.mask_pii(raw), F.col("_src")).drop("_src")
    valid, quarantine = etl.split_valid(df)

    def start(frame: DataFrame, path: str, part: str, name: str):
        w = (
            frame.writeStream.format("parquet")
            .option("path", path)
            .option("compression", COMPRESSION)
            .option("checkpointLocation", f"{checkpoint_dir}/{name}")
            .partitionBy(part)
        )
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        return w.start()

    return (
        start(valid.drop(CORRUPT_COLUMN), bronze_path, "transaction_date", "bronze"),
        start(quarantine, quarantine_path, "ingestion_date", "quarantine"),
    )
