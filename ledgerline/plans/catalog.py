"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query wires a stand-in input (``sources.fixtures``) through the library's
operators over the whole input tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Thresholds, load_suite, load_thresholds
from ..operators import alarms, dims, etl, fraud, governance, quality, reports, schema_drift
from ..operators.fact_table import FactTable
from ..session import drop_at_exit, qualified, scratch_path, shared_table
from ..sources import fixtures as fx
from ..sources import shards
from ..streaming import alarms as alarm_stream
from ..streaming import fraud_stream
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- shared stages
def bronze_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T -> mask -> valid rows (bronze, without per-run metadata columns)."""
    valid, _ = etl.split_valid(etl.mask_pii(fx.transactions_raw(spark, sf_dir)))
    return valid


def silver_t(spark: SparkSession, sf_dir: str, materialize: bool = False, columns: Sequence[str] = ("*",)) -> DataFrame:
    """Silver T.  ``materialize=True`` writes its ``columns`` as a Parquet table in
    the shared checkpoint folder for plans that read silver in several branches,
    so the dedupe shuffle runs once and each branch reads only its columns."""
    df = etl.to_silver(bronze_t(spark, sf_dir)).select(*columns)
    return shared_table(df, "silver") if materialize else df


def q_mask_pii(spark, sf_dir):
    return etl.mask_pii(fx.transactions_raw(spark, sf_dir)).select("transaction_id", "account_id", "ip_address")


def q_null_profile(spark, sf_dir):
    return etl.null_profile(fx.transactions_raw(spark, sf_dir))


def q_valid_rows(spark, sf_dir):
    return bronze_t(spark, sf_dir)


def q_quarantine_rows(spark, sf_dir):
    _, q = etl.split_valid(etl.mask_pii(fx.transactions_raw(spark, sf_dir)))
    return q


def q_quarantine_distinct(spark, sf_dir):
    """SET1 as EXCEPT DISTINCT: each rejected row once."""
    _, q = etl.split_valid(etl.mask_pii(fx.transactions_raw(spark, sf_dir)), distinct_quarantine=True)
    return q


def q_normalize_currency(spark, sf_dir):
    return etl.normalize_currency(bronze_t(spark, sf_dir)).select(
        "transaction_id", "currency", "amount", "exchange_rate", "amount_usd"
    )


def q_enrich_category(spark, sf_dir):
    return etl.enrich_category(bronze_t(spark, sf_dir)).select("transaction_id", "merchant_id", "category")


def q_derived_columns(spark, sf_dir):
    df = etl.add_derived_columns(etl.normalize_currency(bronze_t(spark, sf_dir)))
    return df.select(
        "transaction_id", "day_of_week", "is_weekend", "transaction_hour", "is_international", "is_high_value"
    )


def q_silver_transactions(spark, sf_dir):
    return silver_t(spark, sf_dir)


def q_dedupe_latest(spark, sf_dir):
    return etl.dedupe_latest(fx.versions(spark, sf_dir), fx.V_KEYS, fx.V_ORDER)


# ---------------------------------------------------------------- reports (L = ledger, T = silver T)
def q_daily_flows(spark, sf_dir):
    return reports.daily_flows(fx.ledger(spark, sf_dir))


def q_daily_pnl(spark, sf_dir):
    return reports.daily_pnl(fx.ledger(spark, sf_dir))


def q_daily_pnl_calendar7(spark, sf_dir):
    return reports.daily_pnl_calendar7(fx.ledger(spark, sf_dir))


def q_net_flow_by_category(spark, sf_dir):
    return reports.net_flow_by_category(reports.daily_pnl(fx.ledger(spark, sf_dir)))


def q_pnl_detail(spark, sf_dir):
    return reports.pnl_detail(reports.daily_pnl(fx.ledger(spark, sf_dir)))


def q_monthly_balance_sheet(spark, sf_dir):
    return reports.balance_sheet_view(fx.ledger(spark, sf_dir), fact_unique=True)  # one row per order


def q_mom_change(spark, sf_dir):
    return reports.mom_change(fx.ledger(spark, sf_dir))


def q_daily_kpis(spark, sf_dir):
    return reports.daily_kpis(silver_t(spark, sf_dir), fx.T_AS_OF).drop("_fraud_q")


def q_top_category(spark, sf_dir):
    return reports.top_category(silver_t(spark, sf_dir), fx.T_AS_OF)


def q_transaction_summary(spark, sf_dir):
    return reports.transaction_summary(silver_t(spark, sf_dir), fx.T_AS_OF)


def q_executive_summary_30d(spark, sf_dir):
    return reports.executive_summary(silver_t(spark, sf_dir), fx.T_AS_OF, 30)


def q_executive_summary_10d(spark, sf_dir):
    """FLT6 where the trailing days leave rows out."""
    return reports.executive_summary(silver_t(spark, sf_dir), fx.T_AS_OF, 10)


def q_daily_kpis_later(spark, sf_dir):
    """FLT6 at a day that most of T is more than 90 days before."""
    return reports.daily_kpis(silver_t(spark, sf_dir), fx.T_LATER_AS_OF).drop("_fraud_q")


def q_kpi_vs_previous_period(spark, sf_dir):
    return reports.kpi_vs_previous_period(fx.ledger(spark, sf_dir), fx.L_AS_OF, 30)


# ---------------------------------------------------------------- fraud scoring (T)
# The test data never exceeds 10 transactions per hour (max 2-3), so the
# oracle-checked scoring runs with velocity_per_hour = 0 to exercise the rule.
ORACLE_THRESHOLDS = Thresholds(velocity_per_hour=0)


def scored_t(spark, sf_dir, thresholds: Thresholds = ORACLE_THRESHOLDS, more: Sequence[str] = ()) -> DataFrame:
    silver = silver_t(spark, sf_dir, materialize=True, columns=(*fraud.SCORE_INPUTS, *more))
    return fraud.score_transactions(silver, thresholds)


SCORE_COLUMNS = [
    "transaction_id",
    "account_id",
    "recent_count",
    "is_new_merchant",
    "score_points",
    "total_score",
    "is_fraud",
    "action",
]


def _scores(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*SCORE_COLUMNS, F.array_join("triggered_rules", ",").alias("triggered_rules"), *more)


def q_velocity_1h(spark, sf_dir):
    return fraud.velocity_counts(silver_t(spark, sf_dir)).select(
        "transaction_id", "account_id", "created_at", "recent_count"
    )


def q_new_merchant(spark, sf_dir):
    silver = silver_t(spark, sf_dir, materialize=True, columns=("transaction_id", "account_id", "merchant_id", "created_at"))
    return fraud.first_merchant_visits(silver).select("transaction_id", "account_id", "merchant_id", "is_new_merchant")


def _rule_query(idx: int) -> Query:
    def q(spark, sf_dir):
        s = F.col("signals")[idx]
        return scored_t(spark, sf_dir).select(
            "transaction_id",
            s["rule"].alias("rule"),
            s["triggered"].alias("triggered"),
            s["score"].alias("score"),
            s["reason"].alias("reason"),
        )

    return q


def q_fraud_scores(spark, sf_dir):
    return _scores(scored_t(spark, sf_dir))


def q_fraud_scores_from_file(spark, sf_dir):
    """SRC8: scores by thresholds of a JSON file in the shared folder."""
    path = scratch_path(spark, "thresholds")
    drop_at_exit(spark, path)
    spark.createDataFrame([(json.dumps({"velocity_per_hour": 0}),)], "value string").coalesce(1).write.text(path)
    return _scores(scored_t(spark, sf_dir, load_thresholds(qualified(spark, path))))


def q_fraud_scores_default(spark, sf_dir):
    return _scores(scored_t(spark, sf_dir, Thresholds()))


def q_fraud_alerts(spark, sf_dir):
    return fraud.fraud_alerts(scored_t(spark, sf_dir))


def q_fraud_notifications(spark, sf_dir):
    return fraud.fraud_notifications(fraud.fraud_alerts(scored_t(spark, sf_dir)))


def q_batch_outcomes(spark, sf_dir):
    return fraud.batch_outcomes(scored_t(spark, sf_dir))


def q_alerts_by_action(spark, sf_dir):
    return reports.alerts_by_action(fraud.fraud_alerts(scored_t(spark, sf_dir)))


# ---------------------------------------------------------------- data quality
def unvalidated_t(spark, sf_dir) -> DataFrame:
    """T masked and enriched but neither validated nor deduplicated (DQ on raw input)."""
    raw = etl.mask_pii(fx.transactions_raw(spark, sf_dir))
    return etl.add_derived_columns(etl.enrich_category(etl.normalize_currency(raw)))


def _dq_out(df: DataFrame) -> DataFrame:
    return df.withColumn("unexpected_values", F.array_join("unexpected_values", ","))


def q_dq_results(spark, sf_dir):
    return _dq_out(quality.validate(silver_t(spark, sf_dir, materialize=True), load_suite()))


def q_dq_results_raw(spark, sf_dir):
    return _dq_out(quality.validate(unvalidated_t(spark, sf_dir), load_suite()))


def q_dq_summary(spark, sf_dir):
    return quality.summarize(quality.validate(silver_t(spark, sf_dir), load_suite()))


def q_dq_by_date(spark, sf_dir):
    by = ["transaction_date"]
    return _dq_out(quality.validate(unvalidated_t(spark, sf_dir), load_suite(), by=by))


def q_dq_summary_by_date(spark, sf_dir):
    by = ["transaction_date"]
    return quality.summarize(quality.validate(unvalidated_t(spark, sf_dir), load_suite(), by=by), by=by)


UNKNOWN_CHECKS = {
    "expectations": [
        {"expectation_type": "expect_column_values_to_be_finite", "kwargs": {"column": "amount_usd"}},
        {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "no_such_column"}},
    ]
}


def q_dq_unknown_check(spark, sf_dir):
    """DQ9: a check of an unknown type is skipped, one of a missing column fails, and the others count."""
    return _dq_out(quality.validate(silver_t(spark, sf_dir), UNKNOWN_CHECKS))


DQ_RUN_DATE = "2024-01-31"


RUNTIME_SUITE = {
    "expectations": [
        {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1}},
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "per_nothing", "min_value": 0}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "transaction_id"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "per_nothing"}},
    ]
}


def q_dq_runtime_error(spark, sf_dir):
    """DQ10: checks whose column raises while they run fail alone, the others have their results."""
    silver = silver_t(spark, sf_dir).withColumn("per_nothing", F.col("amount") / (F.col("amount") - F.col("amount")))
    out = quality.validate_isolated(silver, RUNTIME_SUITE)
    return out.select(
        "idx", "expectation", "column", "success", "metric_name", "metric_value", F.regexp_extract("error", r"\[([A-Z_]+)", 1).alias("error")
    )


def q_dq_audit_events(spark, sf_dir):
    """AUD3: an event for each day's validation."""
    by = ["transaction_date"]
    results = quality.validate(unvalidated_t(spark, sf_dir), load_suite(), by=by)
    return governance.dq_result_events(results, "transactions", DQ_RUN_DATE, by=by)


# ---------------------------------------------------------------- upsert (T split by residue)
def _silver_of(raw: DataFrame) -> DataFrame:
    valid, _ = etl.split_valid(etl.mask_pii(raw))
    return etl.to_silver(valid)


def upsert_pair(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    target = _silver_of(fx.transactions_raw(spark, sf_dir, fx.UPSERT_TARGET_PRED))
    staging = _silver_of(fx.upsert_staging_raw(spark, sf_dir))
    return target, staging


def q_fact_upsert(spark, sf_dir):
    return etl.upsert(*upsert_pair(spark, sf_dir), dedupe_staging=False)  # silver has one row per transaction


def q_fact_update_half(spark, sf_dir):
    return etl.upsert_update_half(*upsert_pair(spark, sf_dir))


def q_fact_insert_half(spark, sf_dir):
    return etl.upsert_insert_half(*upsert_pair(spark, sf_dir))


FACT_BUCKETS = 64


def merged_fact(spark, sf_dir) -> FactTable:
    """Target, staging and a few corrections, merged one after another."""
    root = scratch_path(spark, "fact-table")
    drop_at_exit(spark, root)
    table = FactTable(spark, root, buckets=FACT_BUCKETS)
    target, staging = upsert_pair(spark, sf_dir)
    for k, silver in enumerate((target, staging, _silver_of(fx.corrections_raw(spark, sf_dir))), 1):
        table.merge(etl.conform_fact(silver).drop(*RUN_COLUMNS), run_id=f"run-{k}", dedupe=False)
    return table


def q_fact_merge(spark, sf_dir):
    """SNK5/JOIN1/JOIN2: the fact after three merges."""
    return merged_fact(spark, sf_dir).read()


def q_fact_merge_loads(spark, sf_dir):
    """A row per merge: rows, and files read, rewritten and kept under their names."""
    table = merged_fact(spark, sf_dir)
    kept = [table.manifest(v).join(table.manifest(v - 1).select("file"), "file").count() for v in (1, 2, 3)]
    kept = F.element_at(F.array(*map(F.lit, kept)), F.col("version")).cast("int")
    return table.loads().select(
        "version", "run_id", "staged", "updated", "inserted", "copied", "files_before", "files_rewritten", "files_written",
        kept.alias("files_kept"), (F.col("files_read") >= F.col("files_rewritten")).alias("no_file_missed"),
    )


# ---------------------------------------------------------------- dimensions, governance, alarms
def q_dim_date(spark, sf_dir):
    return dims.dim_date_for(fx.ledger(spark, sf_dir))


def q_dim_merchants(spark, sf_dir):
    return dims.dim_merchants(silver_t(spark, sf_dir))


def q_dim_fraud_alerts(spark, sf_dir):
    return dims.dim_fraud_alerts(fraud.fraud_alerts(scored_t(spark, sf_dir)))


def q_fact_join_dims(spark, sf_dir):
    s = silver_t(spark, sf_dir, materialize=True, columns=(*dims.MERCHANT_INPUTS, "transaction_date", "amount_usd"))
    return dims.fact_join_dims(s, dims.dim_date_for(s), dims.dim_merchants(s))


def q_audit_events(spark, sf_dir):
    return governance.fraud_alert_events(fraud.fraud_alerts(scored_t(spark, sf_dir)))


def q_audit_by_actor_day(spark, sf_dir):
    return governance.audit_by_actor_day(governance.fraud_alert_events(fraud.fraud_alerts(scored_t(spark, sf_dir))))


LINEAGE_RUN = ("transform-job", "GLUE_JOB", "bronze/transactions", "silver/transactions", "run-1", "2024-01-31 00:00:00")
LINEAGE_RERUN_AT = "2024-02-01 00:00:00"


def _silver_lineage(spark, sf_dir):
    job, jtype, src, dst, run, at = LINEAGE_RUN
    return governance.partition_lineage(silver_t(spark, sf_dir), "transaction_date", job, jtype, src, dst, run, at)


def _lineage_rows(df):
    return df.select(
        "lineage_id", "job_name", "job_type", "run_id", "recorded_at",
        F.col("inputs")[0]["uri"].alias("input_uri"), F.col("outputs")[0]["uri"].alias("output_uri"), "ttl",
    )


def q_lineage_records(spark, sf_dir):
    return _lineage_rows(_silver_lineage(spark, sf_dir))


def q_lineage_upstream(spark, sf_dir):
    """JOIN8/LIN3: for every written silver partition, the run that produced it."""
    lin = _silver_lineage(spark, sf_dir)
    uris = lin.select(F.explode("outputs").alias("o")).select(F.col("o.uri").alias("uri"))
    return governance.upstream_of(lin, uris)


def _lineage_columns(df):
    return df.select(
        "lineage_id", "job_name", "run_id", F.col("inputs")[0]["uri"].alias("input_uri"),
        F.col("outputs")[0]["uri"].alias("output_uri"), "metadata",
    )


def q_lineage_lookup(spark, sf_dir):
    """LIN2: one run by its id."""
    return _lineage_columns(governance.get_lineage(_silver_lineage(spark, sf_dir), "transform-job#run-1#2024-01-15"))


def q_lineage_contains(spark, sf_dir):
    """LIN3/JOIN8: runs whose outputs contain a part of a URI."""
    return _lineage_columns(governance.upstream_runs(_silver_lineage(spark, sf_dir), "transactions/transaction_date=2024-01-1"))


#: Parts of URIs of the events' days, a character to a whole URI long.
FRAGMENTS = (
    "concat('silver/transactions/transaction_date=', d)", "concat('date=', substring(d, 1, 9))", "substring(d, 6, 4)",
    "concat('-', substring(d, 9, 2))", "substring(d, 10, 1)", "concat(d, '/none')", "'transactions/transaction'",
)


def q_lineage_fragments(spark, sf_dir):
    """LIN3/JOIN8 in bulk: the runs whose outputs contain one of many fragments."""
    days = fx.transactions_raw(spark, sf_dir).selectExpr("cast(transaction_date as string) as d").distinct()
    return governance.upstream_containing(_silver_lineage(spark, sf_dir), days.selectExpr(f"explode(array({', '.join(FRAGMENTS)})) as fragment"))


def q_audit_after_retry(spark, sf_dir):
    """SNK12: events that were appended twice, read once each."""
    path = scratch_path(spark, "audit")
    drop_at_exit(spark, path)
    events = governance.fraud_alert_events(fraud.fraud_alerts(scored_t(spark, sf_dir)))
    for _ in range(2):
        governance.append_audit(events, path)
    return governance.read_audit(spark, path)


def q_lineage_after_rerun(spark, sf_dir):
    """SNK13: the lineage of a run that was repeated a day later, by its ids."""
    path = scratch_path(spark, "lineage")
    drop_at_exit(spark, path)
    job, jtype, src, dst, run, at = LINEAGE_RUN
    silver = silver_t(spark, sf_dir, materialize=True)
    for at in (at, LINEAGE_RERUN_AT):
        governance.append_lineage(
            governance.partition_lineage(silver, "transaction_date", job, jtype, src, dst, run, at), path
        )
    return _lineage_rows(governance.read_lineage(spark, path))


RETENTION_AS_OF = "2024-04-15"


def q_ttl_expiry(spark, sf_dir):
    return governance.retention_status(fraud.fraud_alerts(scored_t(spark, sf_dir)), RETENTION_AS_OF)


def q_fraud_rate_alarm(spark, sf_dir):
    return alarms.fraud_rate_alarm(scored_t(spark, sf_dir))


def q_dq_failure_alarm(spark, sf_dir):
    by = ["transaction_date"]
    summary = quality.summarize(quality.validate(unvalidated_t(spark, sf_dir), load_suite(), by=by), by=by)
    metrics = quality.metrics_rows(summary, "transactions", F.col("transaction_date").cast("timestamp"))
    return alarms.dq_failure_alarm(metrics)


# ---------------------------------------------------------------- jobs end to end (JOB1-JOB3, JOB5)
def write_raw(raw: DataFrame, path: str, fmt: str = "csv") -> None:
    raw.write.option("header", "true").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").format(fmt).save(path)


def job_layers(spark, sf_dir, last: str, fmt: str = "csv") -> str:
    """Raw T as files through the jobs up to ``last`` (ingest, transform or load); the folder of their outputs."""
    root = scratch_path(spark, "jobs")
    drop_at_exit(spark, root)
    write_raw(fx.transactions_raw(spark, sf_dir), f"{root}/raw", fmt)
    run = {"run_id": "run-1", "audit_path": f"{root}/audit", "lineage_path": f"{root}/lineage"}
    jobs.ingest(spark, f"{root}/raw", f"{root}/bronze", f"{root}/quarantine", fmt, **run)
    if last != "ingest":
        jobs.transform(spark, f"{root}/bronze", f"{root}/silver", **run)
    if last == "load":
        jobs.load(spark, f"{root}/silver", f"{root}/fact", **run)
    return root


def redelivered_layers(spark, sf_dir, last: str) -> str:
    """T and then its second delivery, each ingested as new files and put through the
    jobs up to ``last``; the folder of their outputs."""
    root = scratch_path(spark, "deliveries")
    drop_at_exit(spark, root)
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    for k, raw in enumerate((fx.transactions_raw(spark, sf_dir), fx.redelivered_raw(spark, sf_dir))):
        write_raw(raw, f"{root}/raw/{k}")
        for q in jobs.start_ingest_stream(spark, f"{root}/raw/*", bronze, f"{root}/quarantine", f"{root}/checkpoint"):
            q.awaitTermination()
        if last != "ingest":
            jobs.transform(spark, bronze, silver)
        if last == "load":
            jobs.load(spark, silver, f"{root}/fact/{k}", f"{root}/fact/{k - 1}" if k else None)
    return root


def q_job_bronze(spark, sf_dir):
    """JOB1's accepted rows, without the columns of the run."""
    root = job_layers(spark, sf_dir, "ingest")
    return jobs.read_layer(spark, f"{root}/bronze").select(*bronze_t(spark, sf_dir).columns)


def q_job_quarantine(spark, sf_dir):
    """JOB1's rejected rows, without the columns of the run."""
    root = job_layers(spark, sf_dir, "ingest")
    return jobs.read_layer(spark, f"{root}/quarantine").select(*q_quarantine_rows(spark, sf_dir).columns)


def q_job_bronze_after_retry(spark, sf_dir):
    """SNK1/SNK2: the rows of both layers after a run that was tried three times, once with half of the files."""
    root = scratch_path(spark, "ingest-retry")
    drop_at_exit(spark, root)
    raw = fx.transactions_raw(spark, sf_dir)
    half = F.xxhash64("transaction_id") % 2 == 0
    write_raw(raw.where(half), f"{root}/raw/0")
    write_raw(raw.where(~F.coalesce(half, F.lit(False))), f"{root}/raw/1")
    for files in ("0", "*", "*"):
        jobs.ingest(spark, f"{root}/raw/{files}", f"{root}/bronze", f"{root}/quarantine", run_id="run-1", by_run=True)
    layers = [jobs.read_layer(spark, f"{root}/{x}").select("transaction_id", F.lit(x).alias("layer")) for x in ("bronze", "quarantine")]
    return layers[0].unionByName(layers[1])


def q_schema_drift(spark, sf_dir):
    """AUD4: what changed between three deliveries of the events, by the footers of their files."""
    root = scratch_path(spark, "drift")
    drop_at_exit(spark, root)
    events = fx.table(spark, sf_dir, "events")
    second = events.drop("props").withColumn("value", F.col("value").cast("decimal(18,2)")).withColumn("channel", F.lit("web"))
    third = second.withColumn("value", F.col("value").cast("double")).withColumn("props", F.lit(1))
    for k, rows in enumerate((events, second, third)):
        rows.where(F.pmod("event_id", F.lit(3)) == k).write.parquet(f"{root}/delivery={k + 1}")
    files = schema_drift.footers(spark, root)
    return schema_drift.schema_changes(files, F.regexp_extract("path", "/delivery=([^/]+)/", 1))


def q_job_silver(spark, sf_dir):
    """JOB1 and JOB2: what silver holds after an ingest and a transform."""
    root = job_layers(spark, sf_dir, "transform")
    return jobs.read_layer(spark, f"{root}/silver").select(*silver_t(spark, sf_dir).columns)


#: Columns of the run itself, which differ each time.
RUN_COLUMNS = ("ingestion_timestamp", "source_file", "ingestion_date")


def q_job_fact(spark, sf_dir):
    """JOB1 to JOB3: the first fact version."""
    return jobs.read_layer(spark, f"{job_layers(spark, sf_dir, 'load')}/fact").drop(*RUN_COLUMNS)


def q_job_json_bronze(spark, sf_dir):
    """SRC2: JOB1's accepted rows of JSON files."""
    root = job_layers(spark, sf_dir, "ingest", "json")
    return jobs.read_layer(spark, f"{root}/bronze").select(*bronze_t(spark, sf_dir).columns)


def q_job_ingestion_metadata(spark, sf_dir):
    """PRJ2: the run's columns of every accepted row, as far as they don't differ each time."""
    bronze = jobs.read_layer(spark, f"{job_layers(spark, sf_dir, 'ingest')}/bronze")
    return bronze.select(
        "transaction_id",
        F.col("source_file").rlike("/raw/part-[^/]*[.]csv$").alias("names_its_file"),
        (F.to_date("ingestion_timestamp") == F.col("ingestion_date")).alias("has_the_day"),
    )


def run_events(events):
    counts = ("records_read", "records_written", "records_quarantined")
    payload = F.from_json("payload", "job_name string, run_id string, status string, " + ", ".join(f"{c} bigint" for c in counts))
    return events.select("event_type", "actor", "subject", payload.alias("p")).select("event_type", "actor", "subject", "p.*")


def q_job_run_events(spark, sf_dir):
    """AUD1/SNK12: the events of the three jobs, with their counts (AGG10)."""
    root = job_layers(spark, sf_dir, "load")
    return run_events(spark.read.json(f"{root}/audit"))


def q_job_lineage(spark, sf_dir):
    """LIN4: the lineage that the three jobs recorded, read back, with the rows that each run wrote."""
    root = job_layers(spark, sf_dir, "load")
    events = run_events(governance.read_audit(spark, f"{root}/audit"))
    written = events.select(F.concat(F.lit("financial-"), "job_name").alias("job_name"), "run_id", "records_written")
    uri = lambda side: F.replace(F.col(side)[0]["uri"], F.lit(root), F.lit("")).alias(f"{side[:-1]}_uri")
    return governance.read_lineage(spark, f"{root}/lineage").join(written, ["job_name", "run_id"]).select(
        "lineage_id", "job_name", "run_id", uri("inputs"), uri("outputs"), "records_written",
        (F.col("ttl") - F.unix_seconds("recorded_at")).alias("retention_s"),
    )


#: A user's suite: silver keeps one row of each id, bronze may hold more.
ONE_ROW_SUITE = {"suite": "one_row", "expectations": [
    {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "transaction_id"}},
    {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "transaction_date"}},
]}


def q_job_dq_exit(spark, sf_dir):
    """DQ12: the summaries of two validations by a user's suite, with the run date and the exit code of the job."""
    root = job_layers(spark, sf_dir, "transform")
    suite = qualified(spark, f"{root}/suite")
    spark.createDataFrame([(json.dumps(ONE_ROW_SUITE),)], "value string").coalesce(1).write.text(suite)
    runs = [
        jobs.validate_job(spark, f"{root}/{layer}", f"{root}/dq", layer, suite, day)
        for layer, day in (("bronze", "2024-01-30"), ("silver", "2024-01-31"))
    ]
    rows = [(r["dataset"], r["run_date"], r["total"], r["passed"], r["failed"], r["pass_rate"], r["overall_success"], jobs.exit_code(r)) for r in runs]
    schema = "dataset string, run_date string, total bigint, passed bigint, failed bigint, pass_rate double, overall_success boolean, exit_code int"
    return spark.createDataFrame(rows, schema).withColumn("run_date", F.to_date("run_date"))


def job_validation(spark, sf_dir) -> str:
    root = job_layers(spark, sf_dir, "transform")
    jobs.validate_job(spark, f"{root}/silver", f"{root}/dq", run_date=DQ_RUN_DATE)
    return f"{root}/dq"


def q_job_dq_results(spark, sf_dir):
    """JOB5/SNK10: the results file of silver's validation."""
    rows = spark.read.schema(
        "idx int, expectation string, `column` string, success boolean, metric_name string, metric_value double, "
        "skipped boolean, error string, unexpected_values array<string>, dataset string, run_date date"
    ).json(f"{job_validation(spark, sf_dir)}/results")
    return _dq_out(rows)


def q_job_dq_history(spark, sf_dir):
    """SNK10: the results of two datasets on two days, one of them run again."""
    root = job_layers(spark, sf_dir, "transform")
    runs = (("silver", "2024-01-30"), ("bronze", "2024-01-31"), ("silver", "2024-01-31"), ("silver", "2024-01-30"))
    for dataset, day in runs:
        jobs.validate_job(spark, f"{root}/{dataset}", f"{root}/dq", dataset, run_date=day)
    rows = spark.read.schema("idx int, expectation string, success boolean, dataset string, run_date date").json(f"{root}/dq/results")
    return rows.groupBy("dataset", "run_date").agg(
        F.count("*").alias("checks"), F.count_if("success").alias("passed"), F.count_distinct("idx").alias("distinct_checks")
    )


def q_job_dq_metrics(spark, sf_dir):
    """JOB5/SNK11: the metrics of silver's validation, without their time."""
    return spark.read.parquet(f"{job_validation(spark, sf_dir)}/metrics").drop("ts")


def q_job_incremental_bronze(spark, sf_dir):
    """SRC3/STR10: the accepted rows of two deliveries, each file taken once."""
    root = redelivered_layers(spark, sf_dir, "ingest")
    return jobs.read_layer(spark, f"{root}/bronze").select(*bronze_t(spark, sf_dir).columns)


def q_job_incremental_quarantine(spark, sf_dir):
    """SRC3/SNK2: the rejected rows of two deliveries."""
    root = redelivered_layers(spark, sf_dir, "ingest")
    return jobs.read_layer(spark, f"{root}/quarantine").select(*q_quarantine_rows(spark, sf_dir).columns)


def q_job_incremental_silver(spark, sf_dir):
    """JOB2/SNK3: the latest version of each transaction, also where its date moved or went."""
    root = redelivered_layers(spark, sf_dir, "transform")
    return jobs.read_layer(spark, f"{root}/silver").drop(*RUN_COLUMNS)


def q_job_incremental_fact(spark, sf_dir):
    """JOB3/SNK4/SNK5/DIM1: the second fact version, an upsert into the first."""
    root = redelivered_layers(spark, sf_dir, "load")
    return jobs.read_layer(spark, f"{root}/fact/1").drop(*RUN_COLUMNS)


# ---------------------------------------------------------------- streaming (JOB4)
def q_fraud_stream(spark, sf_dir):
    """Silver T encoded as stream records, scored by the Structured Streaming job
    (availableNow), read back from its sink."""
    root = scratch_path(spark, "fraud-stream")
    drop_at_exit(spark, root)
    src, out, ck = f"{root}/source", f"{root}/out", f"{root}/checkpoint"
    fraud_stream.encode_payloads(silver_t(spark, sf_dir)).write.json(src)
    fraud_stream.run_available_now(spark, src, out, ck, thresholds=ORACLE_THRESHOLDS)
    return _scores(fraud_stream.read_output(spark, out, "scored"))


def stream_deliveries(spark, sf_dir, long_after: bool = False, typed_state: bool = False) -> str:
    """Silver T in three deliveries with out-of-order, late, re-delivered and broken
    records, each one run of the scoring job; the folder of its outputs.

    With ``long_after`` the alerts are compacted then, and a fourth delivery brings rows of the first one again.
    """
    root = scratch_path(spark, "fraud-deliveries")
    drop_at_exit(spark, root)
    arrivals = (
        f"array(delivery + cast({fx.STREAM_DELAYED} as int), "
        f"if({fx.STREAM_TWICE}, delivery, null), if({fx.STREAM_AGAIN}, delivery + 1, null))"
    )
    silver = silver_t(spark, sf_dir).selectExpr("*", f"{fx.STREAM_DELIVERY} as delivery")
    rows = shared_table(silver.selectExpr("*", f"{arrivals} as arrivals"), "stream-rows")
    broken = F.expr(fx.STREAM_BROKEN_BY)
    data = F.concat(F.lit("!"), F.col("transaction_id"))  # no base64
    for rest, (_, text) in fx.STREAM_BROKEN.items():
        if text is not None:
            data = F.when(broken == rest, F.base64(F.lit(text).cast("binary"))).otherwise(data)
    for k in (1, 2, 3):
        copies = rows.select("*", F.explode(F.filter("arrivals", lambda x: x == k)))
        faults = rows.where((F.col("delivery") == k) & broken.isin(*fx.STREAM_BROKEN)).select(
            F.concat(F.lit("broken-"), F.col("transaction_id")).alias("sequence_number"),
            data.alias("data"),
            F.col("created_at").alias("arrival_ts"),
        )
        fraud_stream.encode_payloads(copies).unionByName(faults).write.mode("append").json(f"{root}/source")
        fraud_stream.run_available_now(
            spark, f"{root}/source", f"{root}/out", f"{root}/checkpoint",
            thresholds=ORACLE_THRESHOLDS, watermark=fx.STREAM_WATERMARK, typed_state=typed_state,
        )
    if long_after:
        fraud_stream.alert_store(spark, f"{root}/out").compact()
        again = fraud_stream.encode_payloads(rows.where(fx.STREAM_LONG_AFTER))
        again.write.mode("append").json(f"{root}/source")
        fraud_stream.run_available_now(
            spark, f"{root}/source", f"{root}/out", f"{root}/checkpoint",
            thresholds=ORACLE_THRESHOLDS, watermark=fx.STREAM_WATERMARK,
        )
    return f"{root}/out"


def q_fraud_stream_batches(spark, sf_dir):
    """Every transaction scored once, late ones with a flag (STR3-5, JOB4)."""
    return _scores(fraud_stream.read_output(spark, stream_deliveries(spark, sf_dir), "scored"), "is_late")


def q_fraud_stream_typed(spark, sf_dir):
    """STR3/STR4/STR7: the same from state variables that are read by key."""
    out = stream_deliveries(spark, sf_dir, typed_state=True)
    return _scores(fraud_stream.read_output(spark, out, "scored"), "is_late")


def q_fraud_stream_alerts(spark, sf_dir):
    """One alert per fraudulent transaction over all deliveries (SNK6, STR5)."""
    return fraud_stream.read_output(spark, stream_deliveries(spark, sf_dir), "alerts").drop("batch_id")


def q_alert_store(spark, sf_dir):
    """SNK6/STR5: one alert per transaction, also where it came again after its account's state forgot it."""
    return fraud_stream.alert_store(spark, stream_deliveries(spark, sf_dir, long_after=True)).read()


def q_alert_store_alive(spark, sf_dir):
    """STR7: the alerts that are left after a compaction that drops those past their time to live."""
    out = stream_deliveries(spark, sf_dir)
    store = fraud_stream.alert_store(spark, out)
    store.compact(RETENTION_AS_OF)
    store.vacuum()
    return store.read()


def refuses_some(message_id: str, payload: str, attempt: int) -> None:
    """A receiver that is down for some messages at first and never takes some others."""
    if int(message_id) % 9 == 0 or (attempt == 1 and int(message_id) % 3 == 0):
        raise ConnectionError(f"refused at attempt {attempt}")


def q_notification_outbox(spark, sf_dir):
    """SNK7: notifications after three rounds of sending, with their attempts and last errors."""
    root = scratch_path(spark, "outbox")
    drop_at_exit(spark, root)
    box = fraud_stream.Outbox(spark, root, most=3)
    box.put(fraud.fraud_notifications(fraud.fraud_alerts(scored_t(spark, sf_dir))), "transaction_id", 0)
    for _ in range(4):
        box.deliver(refuses_some)
    return box.state().select(
        "message_id", "attempts", "delivered", "last_error", F.get_json_object("payload", "$.subject").alias("subject"),
        F.get_json_object("payload", "$.attr_action").alias("action"),
    )


ALARM_WATERMARK = "3 days"


def alarm_deliveries(spark, rows: DataFrame, periods, breach, n_periods: int) -> str:
    """``rows`` (with ``arrival`` 1 to 3) as files of three deliveries, each one run of an alarm stream; the folder of its outputs."""
    root = scratch_path(spark, "alarm-stream")
    drop_at_exit(spark, root)
    rows = shared_table(rows, "alarm-rows")
    for k in (1, 2, 3):
        part = rows.where(F.col("arrival") == k).drop("arrival")
        part.write.mode("append").parquet(f"{root}/source")
        stream = spark.readStream.schema(part.schema).parquet(f"{root}/source")
        alarm_stream.start_alarm(
            periods(stream, watermark=ALARM_WATERMARK), breach, f"{root}/out", f"{root}/checkpoint", n_periods=n_periods
        ).awaitTermination()
    return f"{root}/out"


def fraud_rate_stream(spark, sf_dir) -> str:
    arrival = F.expr(f"{fx.STREAM_DELIVERY} + cast({fx.STREAM_DELAYED} as int)")
    scored = scored_t(spark, sf_dir, more=("transaction_date",)).select(
        F.col("created_at").cast("timestamp").alias("created_at"), "is_fraud", arrival.alias("arrival")
    )
    return alarm_deliveries(spark, scored, alarm_stream.fraud_rate_periods, F.col("fraud_rate_pct") > 5.0, 2)


def q_fraud_rate_alarm_stream(spark, sf_dir):
    """STR8 as a stream: the closed periods of three deliveries with late rows."""
    return alarm_stream.read_alarm(spark, fraud_rate_stream(spark, sf_dir))


def q_fraud_rate_alarm_changes(spark, sf_dir):
    """STR8: when the alarm went on and off."""
    return alarm_stream.read_alarm(spark, fraud_rate_stream(spark, sf_dir), "changes")


def q_dq_failure_alarm_stream(spark, sf_dir):
    """STR9 as a stream: the days' failed checks, in three deliveries."""
    by = ["transaction_date"]
    summary = quality.summarize(quality.validate(unvalidated_t(spark, sf_dir), load_suite(), by=by), by=by)
    metrics = quality.metrics_rows(summary, "transactions", F.col("transaction_date").cast("timestamp")).where("metric = 'FailedChecks'")
    rows = metrics.where("ts is not null").withColumn("transaction_date", F.to_date("ts"))
    rows = rows.select("ts", "value", F.expr(fx.STREAM_DELIVERY).alias("arrival"))
    return alarm_stream.read_alarm(spark, alarm_deliveries(spark, rows, alarm_stream.metric_periods, F.col("value") > 0, 1))


SHARDS, SHARD_BATCHES = 4, 12


def q_shard_batches(spark, sf_dir):
    """SRC7: silver T as records of four shards in three deliveries, each drained in batches of a limit by a query
    that resumes from its checkpoint; every record with its batch, shard and offset."""
    root = scratch_path(spark, "shards")
    drop_at_exit(spark, root)
    silver = shared_table(silver_t(spark, sf_dir).selectExpr("*", f"{fx.STREAM_DELIVERY} as delivery"), "shard-rows")
    limit = max(1, -(-silver.count() // SHARD_BATCHES))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    for k in (1, 2, 3):
        rows = silver.where(F.col("delivery") == k)
        records = fraud_stream.encode_payloads(rows)
        account = F.get_json_object(F.unbase64("data").cast("string"), "$.account_id")
        shards.append_records(records, f"{root}/source", k, account, SHARDS)
        stream = shards.read_shards(spark, f"{root}/source", f"{root}/progress.json", max_records_per_shard=limit)
        query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/checkpoint").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    read = spark.read.schema(f"{shards.SCHEMA.toDDL()}, batch bigint").option("basePath", f"{root}/out").parquet(f"{root}/out")
    payload = F.unbase64("data").cast("string")
    return read.select(
        "batch", "shard", "record_offset", "sequence_number", F.get_json_object(payload, "$.transaction_id").alias("transaction_id")
    )


def q_fraud_stream_rejects(spark, sf_dir):
    """Dead letters (SNK9), and the late and re-delivered records."""
    out = stream_deliveries(spark, sf_dir)
    dead = spark.read.parquet(f"{out}/rejects").select("sequence_number", F.col("reject_reason").alias("reason"), "payload")
    state = fraud_stream.read_output(spark, out, "rejects_state").select(
        "sequence_number", "reason", F.lit(None).cast("string").alias("payload")
    )
    return dead.unionByName(state)


QUERIES: dict[str, Query] = {
    "mask_pii": q_mask_pii,
    "null_profile": q_null_profile,
    "valid_rows": q_valid_rows,
    "quarantine_rows": q_quarantine_rows,
    "quarantine_distinct": q_quarantine_distinct,
    "normalize_currency": q_normalize_currency,
    "enrich_category": q_enrich_category,
    "derived_columns": q_derived_columns,
    "silver_transactions": q_silver_transactions,
    "dedupe_latest": q_dedupe_latest,
    "daily_flows": q_daily_flows,
    "daily_pnl": q_daily_pnl,
    "daily_pnl_calendar7": q_daily_pnl_calendar7,
    "net_flow_by_category": q_net_flow_by_category,
    "pnl_detail": q_pnl_detail,
    "monthly_balance_sheet": q_monthly_balance_sheet,
    "mom_change": q_mom_change,
    "daily_kpis": q_daily_kpis,
    "top_category": q_top_category,
    "transaction_summary": q_transaction_summary,
    "executive_summary_30d": q_executive_summary_30d,
    "executive_summary_10d": q_executive_summary_10d,
    "daily_kpis_later": q_daily_kpis_later,
    "kpi_vs_previous_period": q_kpi_vs_previous_period,
    "velocity_1h": q_velocity_1h,
    "new_merchant": q_new_merchant,
    "rule_high_amount": _rule_query(0),
    "rule_unusual_hour": _rule_query(1),
    "rule_international": _rule_query(2),
    "rule_velocity": _rule_query(3),
    "rule_new_merchant": _rule_query(4),
    "rule_card_not_present": _rule_query(5),
    "fraud_scores": q_fraud_scores,
    "fraud_scores_from_file": q_fraud_scores_from_file,
    "fraud_scores_default": q_fraud_scores_default,
    "fraud_alerts": q_fraud_alerts,
    "fraud_notifications": q_fraud_notifications,
    "batch_outcomes": q_batch_outcomes,
    "alerts_by_action": q_alerts_by_action,
    "dq_results": q_dq_results,
    "dq_results_raw": q_dq_results_raw,
    "dq_summary": q_dq_summary,
    "dq_by_date": q_dq_by_date,
    "dq_summary_by_date": q_dq_summary_by_date,
    "dq_unknown_check": q_dq_unknown_check,
    "dq_runtime_error": q_dq_runtime_error,
    "dq_audit_events": q_dq_audit_events,
    "fact_upsert": q_fact_upsert,
    "fact_update_half": q_fact_update_half,
    "fact_insert_half": q_fact_insert_half,
    "fact_merge": q_fact_merge,
    "fact_merge_loads": q_fact_merge_loads,
    "dim_date": q_dim_date,
    "dim_merchants": q_dim_merchants,
    "dim_fraud_alerts": q_dim_fraud_alerts,
    "fact_join_dims": q_fact_join_dims,
    "audit_events": q_audit_events,
    "audit_by_actor_day": q_audit_by_actor_day,
    "ttl_expiry": q_ttl_expiry,
    "lineage_records": q_lineage_records,
    "lineage_upstream": q_lineage_upstream,
    "lineage_lookup": q_lineage_lookup,
    "lineage_contains": q_lineage_contains,
    "lineage_fragments": q_lineage_fragments,
    "lineage_after_rerun": q_lineage_after_rerun,
    "audit_after_retry": q_audit_after_retry,
    "fraud_rate_alarm": q_fraud_rate_alarm,
    "dq_failure_alarm": q_dq_failure_alarm,
    "job_bronze": q_job_bronze,
    "job_quarantine": q_job_quarantine,
    "job_bronze_after_retry": q_job_bronze_after_retry,
    "schema_drift": q_schema_drift,
    "shard_batches": q_shard_batches,
    "job_silver": q_job_silver,
    "job_fact": q_job_fact,
    "job_json_bronze": q_job_json_bronze,
    "job_ingestion_metadata": q_job_ingestion_metadata,
    "job_run_events": q_job_run_events,
    "job_dq_results": q_job_dq_results,
    "job_dq_history": q_job_dq_history,
    "job_dq_exit": q_job_dq_exit,
    "job_lineage": q_job_lineage,
    "job_dq_metrics": q_job_dq_metrics,
    "job_incremental_bronze": q_job_incremental_bronze,
    "job_incremental_quarantine": q_job_incremental_quarantine,
    "job_incremental_silver": q_job_incremental_silver,
    "job_incremental_fact": q_job_incremental_fact,
    "fraud_stream": q_fraud_stream,
    "fraud_stream_batches": q_fraud_stream_batches,
    "fraud_stream_typed": q_fraud_stream_typed,
    "fraud_stream_alerts": q_fraud_stream_alerts,
    "fraud_stream_rejects": q_fraud_stream_rejects,
    "fraud_rate_alarm_stream": q_fraud_rate_alarm_stream,
    "fraud_rate_alarm_changes": q_fraud_rate_alarm_changes,
    "dq_failure_alarm_stream": q_dq_failure_alarm_stream,
    "alert_store": q_alert_store,
    "alert_store_alive": q_alert_store_alive,
    "notification_outbox": q_notification_outbox,
}
