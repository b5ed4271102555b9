"""Audit events, lineage records and retention (AUD1-AUD7, LIN1-LIN4, STR7).

Audit and lineage are append-only tables with a uniform schema; events are
projections of the DataFrames the jobs already produce (alerts, DQ results,
observed counts), so they scale with the data instead of per-row service
calls.  Single-row events (one job run, one schema change) are built from
driver-side metadata only.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from typing import Any, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from .etl import dedupe_latest

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("event_ts", T.TimestampType(), True),
        T.StructField("event_date", T.DateType(), True),
        T.StructField("actor", T.StringType(), True),
        T.StructField("subject", T.StringType(), True),
        T.StructField("payload", T.StringType(), True),
        T.StructField("fingerprint", T.StringType(), True),
    ]
)

ACTOR_ETL = "etl-service"
ACTOR_FRAUD = "fraud-scoring"
ACTOR_DQ = "dq-validator"


def fingerprint(payload_json: Column) -> Column:
    """AUD6: first 16 hex chars of SHA-256 over a JSON document (Spark's to_json)."""
    return F.substring(F.sha2(payload_json, 256), 1, 16)


def _event(event_type: str, ts: Column, actor: Column, subject: Column, payload: Column, with_fp: bool = True) -> list[Column]:
    return [
        F.sha2(
            F.concat_ws("|", F.lit(event_type), subject, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), payload), 256
        )
        .substr(1, 32)
        .alias("event_id"),
        F.lit(event_type).alias("event_type"),
        ts.cast("timestamp").alias("event_ts"),
        F.to_date(ts).alias("event_date"),
        actor.alias("actor"),
        subject.alias("subject"),
        payload.alias("payload"),
        (fingerprint(payload) if with_fp else F.lit(None).cast("string")).alias("fingerprint"),
    ]


def fraud_alert_events(alerts: DataFrame, actor: str = ACTOR_FRAUD) -> DataFrame:
    """AUD2: one FRAUD_ALERT event per alert row."""
    payload = F.to_json(
        F.struct(
            F.col("transaction_id"),
            F.col("account_id"),
            F.col("action"),
            F.col("risk_score").cast("double").alias("risk_score"),
            F.split(F.col("triggered_rules"), ",").alias("triggered_rules"),
        ),
        {"ignoreNullFields": "false"},
    )
    return alerts.select(*_event("FRAUD_ALERT", F.col("detected_at"), F.lit(actor), F.col("transaction_id"), payload))


def dq_result_events(results: DataFrame, dataset: str, run_date: str, by: Sequence[str] = (), actor: str = ACTOR_DQ) -> DataFrame:
    """AUD3: one DATA_QUALITY_RESULT event per validation (per ``by`` group)."""
    by = list(by)
    ok = F.coalesce(F.col("success"), F.lit(False))
    g = results.groupBy(*by).agg(
        F.count_if(ok).alias("checks_passed"),
        F.count_if(~ok).alias("checks_failed"),
        # failed check names: bounded by the suite size, not the data
        F.sort_array(F.collect_list(F.when(~ok, F.col("expectation")))).alias("failed_checks"),
    )
    total = F.col("checks_passed") + F.col("checks_failed")
    rate = F.round(F.col("checks_passed") * 100.0 / F.greatest(total, F.lit(1)), 2)
    payload = F.to_json(
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(run_date).alias("run_date"),
            *[F.col(b).cast("string").alias(b) for b in by],
            "checks_passed",
            "checks_failed",
            rate.alias("pass_rate_pct"),
            (F.col("checks_failed") == 0).alias("overall_success"),
            "failed_checks",
        )
    )
    subject = F.concat_ws("/", F.lit(dataset), *[F.col(b).cast("string") for b in by])
    return g.select(*_event("DATA_QUALITY_RESULT", F.to_timestamp(F.lit(run_date)), F.lit(actor), subject, payload))


def _one_row(spark: SparkSession, d: dict[str, Any]) -> DataFrame:
    return spark.createDataFrame([tuple(d.values())], ",".join(f"{k} string" for k in d))


def etl_run_event(
    spark: SparkSession,
    job_name: str,
    run_id: str,
    status: str,
    records_read: int,
    records_written: int,
    records_quarantined: int,
    source_path: str,
    target_path: str,
    actor: str = ACTOR_ETL,
    ts: datetime | None = None,
) -> DataFrame:
    """AUD1: ETL_RUN event from a job's observed counts (AGG10)."""
    ts = ts or datetime.now(timezone.utc)
    payload = json.dumps(
        {
            "job_name": job_name,
            "run_id": run_id,
            "status": status,
            "records_read": int(records_read),
            "records_written": int(records_written),
            "records_quarantined": int(records_quarantined),
            "source_path": source_path,
            "target_path": target_path,
        }
    )
    base = _one_row(spark, {"ts": ts.isoformat(), "actor": actor, "subject": f"{job_name}#{run_id}", "payload": payload})
    return base.select(*_event("ETL_RUN", F.to_timestamp("ts"), F.col("actor"), F.col("subject"), F.col("payload")))


def schema_change_events(
    spark: SparkSession, table: str, old: T.StructType, new: T.StructType, actor: str, ts: datetime | None = None
) -> DataFrame:
    """AUD4 (re-aimed): diff two schemas into ADD/DROP/TYPE_CHANGE events with fingerprints."""
    ts = ts or datetime.now(timezone.utc)
    o = {f.name: f.dataType.simpleString() for f in old.fields}
    n = {f.name: f.dataType.simpleString() for f in new.fields}
    rows = []
    for c in n:
        if c not in o:
            rows.append(("ADD_COLUMN", c, None, n[c]))
        elif o[c] != n[c]:
            rows.append(("TYPE_CHANGE", c, o[c], n[c]))
    for c in o:
        if c not in n:
            rows.append(("DROP_COLUMN", c, o[c], None))
    df = spark.createDataFrame(rows, "change_type string, column string, old string, new string")
    change = F.to_json(F.struct(F.col("new"), F.col("old")), {"ignoreNullFields": "false"})  # keys in sorted order
    payload = F.to_json(
        F.struct(F.lit(table).alias("table"), "change_type", "column", "old", "new"), {"ignoreNullFields": "false"}
    )
    cols = _event("SCHEMA_CHANGE", F.to_timestamp(F.lit(ts.isoformat())), F.lit(actor), F.lit(table), payload, with_fp=False)
    cols[-1] = fingerprint(change).alias("fingerprint")
    return df.select(*cols)


def access_event(
    spark: SparkSession, actor: str, resource: str, action: str, result: str, details: dict | None = None, ts: datetime | None = None
) -> DataFrame:
    """AUD5: DATA_ACCESS event."""
    ts = ts or datetime.now(timezone.utc)
    payload = json.dumps({"resource": resource, "action": action, "result": result, "details": details or {}})
    base = _one_row(spark, {"ts": ts.isoformat(), "actor": actor, "subject": resource, "payload": payload})
    return base.select(*_event("DATA_ACCESS", F.to_timestamp("ts"), F.col("actor"), F.col("subject"), F.col("payload")))


def audit_by_actor_day(audit: DataFrame) -> DataFrame:
    """AUD7: compliance rollup — events per type, actor and day."""
    return audit.groupBy("event_type", "actor", "event_date").agg(F.count(F.lit(1)).alias("event_count"))


# ---------------------------------------------------------------- lineage
ASSET = T.StructType([T.StructField("type", T.StringType()), T.StructField("uri", T.StringType())])
LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField("lineage_id", T.StringType(), False),
        T.StructField("job_name", T.StringType(), False),
        T.StructField("job_type", T.StringType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("recorded_at", T.TimestampType(), True),
        T.StructField("inputs", T.ArrayType(ASSET), True),
        T.StructField("outputs", T.ArrayType(ASSET), True),
        T.StructField("metadata", T.StringType(), True),
        T.StructField("ttl", T.LongType(), True),
    ]
)


def lineage_record(
    spark: SparkSession,
    job_name: str,
    job_type: str,
    inputs: Iterable[dict[str, str]],
    outputs: Iterable[dict[str, str]],
    run_id: str | None = None,
    metadata: dict[str, Any] | None = None,
    recorded_at: datetime | None = None,
) -> DataFrame:
    """LIN1: one lineage row, id ``job#run``, retention 365 days."""
    if job_type not in C.ASSET_TYPES:
        raise ValueError(f"unknown asset type {job_type}")
    run_id = run_id or uuid.uuid4().hex
    ts = recorded_at or datetime.now(timezone.utc)
    row = (
        f"{job_name}#{run_id}",
        job_name,
        job_type,
        run_id,
        ts,
        [(a["type"], a["uri"]) for a in inputs],
        [(a["type"], a["uri"]) for a in outputs],
        json.dumps(metadata or {}),
        int(ts.timestamp()) + C.TTL_LINEAGE_S,
    )
    return spark.createDataFrame([row], LINEAGE_SCHEMA)


def partition_lineage(
    df: DataFrame,
    part_col: str,
    job_name: str,
    job_type: str,
    input_root: str,
    output_root: str,
    run_id: str,
    recorded_at: str,
    metadata: dict[str, Any] | None = None,
) -> DataFrame:
    """LIN1 per partition: one lineage row for every partition value a job wrote
    (``input_root/col=v`` -> ``output_root/col=v``), derived from the data with
    a distinct — a file-per-partition lineage table for partitioned layers."""
    if job_type not in C.ASSET_TYPES:
        raise ValueError(f"unknown asset type {job_type}")
    v = F.col(part_col).cast("string")
    parts = df.select(v.alias("_v")).distinct().where(F.col("_v").isNotNull())
    ts = F.to_timestamp(F.lit(recorded_at))

    def asset(root: str) -> Column:
        return F.array(
            F.struct(F.lit("S3_PATH").alias("type"), F.concat(F.lit(f"{root.rstrip('/')}/{part_col}="), F.col("_v")).alias("uri"))
        )

    return parts.select(
        F.concat(F.lit(f"{job_name}#{run_id}#"), F.col("_v")).alias("lineage_id"),
        F.lit(job_name).alias("job_name"),
        F.lit(job_type).alias("job_type"),
        F.lit(run_id).alias("run_id"),
        ts.alias("recorded_at"),
        asset(input_root).alias("inputs"),
        asset(output_root).alias("outputs"),
        F.lit(json.dumps(metadata or {})).alias("metadata"),
        (F.unix_seconds(ts) + F.lit(C.TTL_LINEAGE_S)).alias("ttl"),
    )


def get_lineage(lineage: DataFrame, lineage_id: str) -> DataFrame:
    """LIN2: lookup by id (empty frame when absent); metadata parsed to a map."""
    return lineage.where(F.col("lineage_id") == lineage_id).withColumn(
        "metadata_map", F.from_json("metadata", "map<string,string>")
    )


def upstream_runs(lineage: DataFrame, uri: str, mode: str = "contains") -> DataFrame:
    """LIN3/JOIN8: runs whose outputs mention ``uri`` (substring) or name it exactly."""
    if mode == "exact":
        cond = F.exists("outputs", lambda o: o["uri"] == F.lit(uri))
    else:
        cond = F.to_json("outputs").contains(uri)
    return lineage.where(cond)


def upstream_of(lineage: DataFrame, uris: DataFrame) -> DataFrame:
    """JOIN8 in bulk: for each ``uris(uri)``, the runs that produced exactly that
    URI — outputs exploded, then an equi join on the URI (no nested-loop join;
    substring matching is offered for a single URI by ``upstream_runs``)."""
    outs = lineage.select("lineage_id", "job_name", "run_id", F.explode("outputs").alias("o")).select(
        "lineage_id", "job_name", "run_id", F.col("o.uri").alias("produced_uri")
    )
    return uris.join(outs, uris["uri"] == outs["produced_uri"], "inner")


#: Characters of the pieces by which URIs are found in bulk.
GRAM = 6


def _pieces(text: Column, n: Column) -> Column:
    """The distinct substrings of ``n`` characters."""
    last = F.length(text) - n + 1
    every = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(text, i, n))
    return F.when(last >= 1, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def upstream_containing(lineage: DataFrame, fragments: DataFrame, gram: int = GRAM) -> DataFrame:
    """JOIN8/LIN3 in bulk: for each ``fragments(fragment)``, the runs that wrote a URI that contains it.

    URIs are indexed by their pieces of ``gram`` characters.  A fragment joins
    the URIs of its rarest piece, so that a piece that all URIs share is used
    only where all pieces are such; the candidates are then tested for the whole
    fragment.  Shorter fragments join pieces of their own length.  All joins are
    on equal pieces or URIs.

    Defined results: repeated fragments count once; a null or empty fragment
    finds nothing; a URI that a run names twice is one.
    """
    outs = lineage.select("lineage_id", "job_name", "run_id", F.explode("outputs").alias("o")).select(
        "lineage_id", "job_name", "run_id", F.col("o.uri").alias("produced_uri")
    ).where("produced_uri is not null").distinct()
    wanted = fragments.select("fragment").where("length(fragment) > 0").distinct()
    wanted = wanted.withColumn("size", F.least(F.length("fragment"), F.lit(gram)))
    sizes = sorted(r["size"] for r in wanted.select("size").distinct().collect()) or [gram]  # at most ``gram`` numbers
    uris = outs.select("produced_uri").distinct().withColumn("size", F.explode(F.array(*map(F.lit, sizes))))
    postings = uris.select("produced_uri", "size", F.explode(_pieces(F.col("produced_uri"), F.col("size"))).alias("piece"))
    counts = postings.groupBy("piece").agg(F.count("*").alias("n"))
    pieces = wanted.select("fragment", F.explode(_pieces(F.col("fragment"), F.col("size"))).alias("piece"))
    rare = (
        pieces.join(counts, "piece", "left")
        .groupBy("fragment")
        .agg(F.min_by("piece", F.struct(F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), F.col("piece").alias("p"))).alias("piece"))
    )
    found = rare.join(postings, "piece").where(F.contains("produced_uri", "fragment")).select("fragment", "produced_uri")
    return found.join(outs, "produced_uri").select("fragment", "lineage_id", "job_name", "run_id", "produced_uri")


def stage_lineage(spark: SparkSession, stage: str, run_id: str, src: str, dst: str) -> DataFrame:
    """LIN4: the lineage row of one of the four pipeline stages."""
    job, job_type, (in_type, in_uri), (out_type, out_uri), metadata = C.STAGE_LINEAGE[stage]
    inputs = [{"type": in_type, "uri": in_uri + src}]
    outputs = [{"type": out_type, "uri": out_uri + dst}]
    return lineage_record(spark, job, job_type, inputs, outputs, run_id, metadata)


# ---------------------------------------------------------------- STR7 retention
def retention_status(df: DataFrame, as_of: str, ttl_col: str = "ttl") -> DataFrame:
    """STR7: mark rows whose epoch-second TTL has passed at ``as_of``."""
    cutoff = F.unix_seconds(F.to_timestamp(F.lit(as_of)))
    return df.withColumn("is_expired", F.col(ttl_col) <= cutoff)


def compact_expired(df: DataFrame, as_of: str, ttl_col: str = "ttl") -> DataFrame:
    """STR7 compaction: keep only rows still within their TTL."""
    return retention_status(df, as_of, ttl_col).where(~F.col("is_expired")).drop("is_expired")


# ---------------------------------------------------------------- SNK12 / SNK13 sinks
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def append_audit(events: DataFrame, path: str) -> None:
    """SNK12: append events to the audit table, one folder per event day.

    Event ids are content hashes: a retried append repeats ids, and
    ``read_audit`` takes each once.
    """
    out = events.sortWithinPartitions("event_date").write.mode("append").option("timestampFormat", TS_FORMAT)
    out.partitionBy("event_date").json(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit table, each event once however often it was appended."""
    events = spark.read.schema(AUDIT_SCHEMA).option("timestampFormat", TS_FORMAT).json(path)
    return events.dropDuplicates(["event_id"])


def append_lineage(records: DataFrame, path: str) -> None:
    """SNK13: append lineage rows (Parquet keeps the nested inputs/outputs arrays)."""
    records.write.mode("append").parquet(path)


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    """The lineage table as an upsert by ``lineage_id`` leaves it: the last record of each id."""
    return dedupe_latest(spark.read.parquet(path), ["lineage_id"], ["recorded_at"], hash_tiebreak=True)
