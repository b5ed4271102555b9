"""Streaming fraud scoring (JOB4: SRC7 -> STR1/2 -> STR3/4/5 -> FR -> SNK6-9).

Records arrive as JSON lines ``{sequence_number, data(base64 JSON), arrival_ts}``
in a directory (a Kafka source plugs in the same way where its connector is
installed).  Two queries share the source:

* the **scoring** query: decode -> parse -> watermark on event time ->
  ``groupBy(account group).applyInPandasWithState`` keeping, per account, the
  last hour of event times (velocity), the merchants seen (new merchant) and
  recently seen transaction ids (re-delivery) -> the same Column rules as the
  batch path -> ``foreachBatch`` writing scored rows, alerts, notifications
  and late/duplicate rejects, each into a ``batch_id=N`` folder overwritten
  on replay (idempotent under at-least-once re-execution); alerts are a keyed
  store, in which a transaction's first alert stays;
* the **rejects** query: undecodable base64, malformed JSON and missing ids
  go to the dead-letter sink with their sequence number and reason.

State is bounded: event times older than the velocity window plus the watermark
and ids older than ``dedupe_horizon_s`` are pruned each batch; the state of an
idle account goes when all its horizons have passed in event time.  Late rows
are scored with a flag and also listed among the rejects.
Within a micro-batch an account's rows are ordered by (event time, id), so
results equal the batch scorer when events arrive in event-time order.
"""

from __future__ import annotations

import json
import logging
from contextlib import contextmanager
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import config as C
from ..config import Thresholds, load_thresholds
from ..operators import fraud, governance
from ..schemas import CORRUPT_COLUMN, STREAM_RECORD_SCHEMA, STREAM_TRANSACTION_SCHEMA
from ..session import CORE_CONF
from ..sources.shards import read_shards
from .account_state import AccountProcessor
from .keyed_store import KeyedStore
from .outbox import Outbox

log = logging.getLogger(__name__)

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
JSON_OPTS = {"timestampFormat": TS_FORMAT}

PAYLOAD_FIELDS = [f.name for f in STREAM_TRANSACTION_SCHEMA.fields if f.name != CORRUPT_COLUMN]


# ---------------------------------------------------------------- producer side (tests, replays)
def encode_payloads(txns: DataFrame) -> DataFrame:
    """Silver-shaped rows -> stream records (base64 JSON payload + sequence number)."""
    body = F.to_json(F.struct(*[F.col(c) for c in PAYLOAD_FIELDS]), JSON_OPTS)
    seq = F.concat(F.format_string("%020d", F.unix_micros(F.col("created_at").cast("timestamp"))), F.lit("-"), F.col("transaction_id"))
    return txns.select(
        seq.alias("sequence_number"),
        F.base64(F.encode(body, "UTF-8")).alias("data"),
        F.col("created_at").cast("timestamp").alias("arrival_ts"),
    )


# ---------------------------------------------------------------- STR1 / STR2
def decode_and_parse(records: DataFrame) -> DataFrame:
    """STR1+STR2: base64 -> UTF-8 -> JSON; adds ``reject_reason`` in {decode, json, missing_id}."""
    # explode() of one value is computed once: a filter on a column of select() would take its place there and decode and
    # parse the text again for each of its mentions
    raw = F.array(F.try_to_binary(F.col("data"), F.lit("base64")))
    text = F.transform(raw, lambda b: F.when(b.isNotNull() & F.is_valid_utf8(b), b.cast("string")))
    df = records.select("sequence_number", "arrival_ts", F.explode(text).alias("text"))
    parsed = F.from_json(
        "text", STREAM_TRANSACTION_SCHEMA, {**JSON_OPTS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    )
    df = df.select("sequence_number", "arrival_ts", "text", F.explode(F.array(parsed)).alias("t"))
    reason = (
        F.when(F.col("text").isNull(), F.lit("decode"))
        .when(F.col("t").isNull() | F.col(f"t.{CORRUPT_COLUMN}").isNotNull(), F.lit("json"))
        .when(F.col("t.transaction_id").isNull(), F.lit("missing_id"))
    )
    return df.select(
        "sequence_number", "arrival_ts", "text", *[F.col(f"t.{c}").alias(c) for c in PAYLOAD_FIELDS], reason.alias("reject_reason")
    )


# ---------------------------------------------------------------- STR3/STR4/STR5 keyed state
STATE_SCHEMA = T.StructType([T.StructField("state_json", T.StringType())])
STATEFUL_FIELDS = PAYLOAD_FIELDS + ["sequence_number"]


def _state_output_schema(in_schema: T.StructType) -> T.StructType:
    fields = [in_schema[c] for c in STATEFUL_FIELDS]
    return T.StructType(
        fields
        + [
            T.StructField("recent_count", T.IntegerType()),
            T.StructField("is_new_merchant", T.BooleanType()),
            T.StructField("is_late", T.BooleanType()),
            T.StructField("is_duplicate", T.BooleanType()),
        ]
    )


def make_state_fn(
    window_s: int = C.VELOCITY_WINDOW_SECONDS,
    dedupe_horizon_s: int = 86400,
    idle_timeout_ms: int = 3_600_000,
    merchant_horizon_s: int | None = None,
    watermark_s: int = 600,
    grouped: bool = False,
):
    """Per-account state: the event times that a row in time can still count (window
    plus ``watermark_s``, the stream's watermark), merchants seen (with last-seen
    time; forgotten after ``merchant_horizon_s``, or never) and recently
    processed ids (kept ``dedupe_horizon_s``).

    An idle account is pruned by these same horizons in event time, and goes
    only when nothing is left.  Rows behind the watermark are scored like the
    others, from the history that is still kept, and flagged ``is_late``.

    A key is an account or, if ``grouped``, a group of accounts, whose states are
    kept side by side: a call for a key costs some milliseconds, whatever its rows.
    """
    delay = watermark_s * 1_000_000
    W = window_s * 1_000_000
    H = dedupe_horizon_s * 1_000_000
    MH = merchant_horizon_s * 1_000_000 if merchant_horizon_s else None

    def prune(st: dict, since: int, top: int) -> dict:
        """``since``: no row in time is older; ``top``: the latest event time."""
        return {
            "t": [x for x in st["t"] if x > since - W],
            "m": {k: v for k, v in st["m"].items() if MH is None or v > top - MH},
            "s": {k: v for k, v in st["s"].items() if v > top - H},
        }

    def advance(st: dict, us: np.ndarray, ids: list, merchant_ids: list, wm_us: int) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """An account's rows of a batch, by (event time, id): its next state, and recent count, new merchant,
        late and live (no duplicate) of each."""
        seen, merchants = st["s"], st["m"]
        live, is_new = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        for i, (one, merchant, at) in enumerate(zip(ids, merchant_ids, us.tolist())):
            if one in seen:
                continue
            seen[one], live[i] = at, True
            if isinstance(merchant, str):
                # new: no sighting at this merchant so far (within the horizon, if set)
                before = merchants.get(merchant)
                is_new[i] = before is None or (MH is not None and before <= at - MH)
                merchants[merchant] = at if before is None else max(at, before)
        # a re-delivered id was already scored: report it as a duplicate even when it is also late
        late = live & (us < wm_us) & (wm_us > 0)
        # velocity: events of this account in (t - W, t), history + this batch
        cur = us[live]
        times = np.sort(np.concatenate([np.array(st["t"], dtype="int64"), cur]))
        recent = np.zeros(len(ids), dtype="int32")
        recent[live] = np.searchsorted(times, cur, side="left") - np.searchsorted(times, cur - W, side="right")
        top = int(times[-1]) if len(times) else 0
        st["t"] = times.tolist()
        return prune(st, max(wm_us, top - delay), top), recent, is_new, late, live

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        st = json.loads(state.get[0]) if state.exists else {"t": [], "m": {}, "s": {}}
        if state.hasTimedOut:
            wm_us = int(state.getCurrentWatermarkMs()) * 1000
            st = prune(st, wm_us, wm_us)
            if any(st.values()):
                state.update((json.dumps(st),))
                state.setTimeoutDuration(idle_timeout_ms)
            else:
                state.remove()
            return
        frames = [f for f in pdfs if len(f)]
        if not frames:
            return
        pdf = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        us = pdf["created_at"].to_numpy().astype("datetime64[us]").astype("int64")
        ids = pdf["transaction_id"].tolist()
        order = sorted(range(len(pdf)), key=lambda i: (us[i], ids[i]))
        pdf, us, ids = pdf.take(order), us[order], [ids[i] for i in order]
        wm_us = int(state.getCurrentWatermarkMs()) * 1000
        st, recent, is_new, late, live = advance(st, us, ids, pdf["merchant_id"].tolist(), wm_us)
        state.update((json.dumps(st),))
        state.setTimeoutDuration(idle_timeout_ms)
        yield pdf[STATEFUL_FIELDS].assign(recent_count=recent, is_new_merchant=is_new, is_late=late, is_duplicate=~live)

    def many(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """The same for a group of accounts: each has its state, and the time of its last rows or pruning, in one list."""
        saved = {a: (st, at) for a, st, at in json.loads(state.get[0])} if state.exists else {}
        wm_us, now = int(state.getCurrentWatermarkMs()) * 1000, int(state.getCurrentProcessingTimeMs())
        frames = [] if state.hasTimedOut else [f for f in pdfs if len(f)]
        present = set()
        if frames:
            pdf = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
            accounts = [a if isinstance(a, str) else None for a in pdf["account_id"].tolist()]
            us = pdf["created_at"].to_numpy().astype("datetime64[us]").astype("int64")
            ids, merchant_ids = pdf["transaction_id"].tolist(), pdf["merchant_id"].tolist()
            at = us.tolist()
            order = sorted(range(len(pdf)), key=lambda i: (accounts[i] is not None, accounts[i] or "", at[i], ids[i]))
            pdf, us = pdf.take(order), us[order]
            accounts, ids, merchant_ids = ([x[i] for i in order] for x in (accounts, ids, merchant_ids))
            cuts = [0, *(i for i in range(1, len(ids)) if accounts[i] != accounts[i - 1]), len(ids)]
            parts = []
            for lo, hi in zip(cuts, cuts[1:]):
                st = saved[accounts[lo]][0] if accounts[lo] in saved else {"t": [], "m": {}, "s": {}}
                st, *flags = advance(st, us[lo:hi], ids[lo:hi], merchant_ids[lo:hi], wm_us)
                saved[accounts[lo]] = st, now
                present.add(accounts[lo])
                parts.append(flags)
            recent, is_new, late, live = (np.concatenate(x) for x in zip(*parts))
        for a, (st, since) in list(saved.items()):
            if a not in present and now - since >= idle_timeout_ms:
                st = prune(st, wm_us, wm_us)
                saved[a] = st, now
                if not any(st.values()):
                    del saved[a]
        if saved:
            state.update((json.dumps([[a, *rest] for a, rest in saved.items()]),))
            state.setTimeoutDuration(max(1, min(since for _, since in saved.values()) + idle_timeout_ms - now))
        elif state.exists:
            state.remove()
        if frames:
            yield pdf[STATEFUL_FIELDS].assign(recent_count=recent, is_new_merchant=is_new, is_late=late, is_duplicate=~live)

    return many if grouped else fn


#: Groups of accounts, by a hash, that share a document of state.
ACCOUNT_GROUPS = 1024


def with_account_state(parsed: DataFrame, watermark: str = "10 minutes", typed: bool = False, groups: int = ACCOUNT_GROUPS, **kw) -> DataFrame:
    """Rows with velocity, new merchant, late and duplicate flags; ``typed`` keeps the state in variables that are
    read by key (``account_state``) instead of one document per group of accounts: for accounts with very many
    merchants.  The number of groups belongs to the checkpoint: as many as give each some hundred accounts."""
    good = parsed.where(F.col("reject_reason").isNull()).select(*STATEFUL_FIELDS)
    good = good.withWatermark("created_at", watermark)
    kw.setdefault("watermark_s", int(pd.Timedelta(watermark).total_seconds()))
    schema = _state_output_schema(good.schema)
    good = good.withColumn("account_group", F.pmod(F.xxhash64("account_id"), F.lit(groups)).cast("int"))
    if typed:
        return good.groupBy("account_group").transformWithStateInPandas(
            AccountProcessor(STATEFUL_FIELDS, **kw), schema, "Append", "ProcessingTime"
        )
    return good.groupBy("account_group").applyInPandasWithState(
        make_state_fn(grouped=True, **kw),
        schema,
        STATE_SCHEMA,
        "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )


# ---------------------------------------------------------------- sinks
def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


ALERT_SCHEMA = (
    "transaction_id string, detected_at timestamp, account_id string, amount_usd decimal(18,2), action string, "
    "risk_score decimal(5,4), signals string, triggered_rules string, ttl bigint"
)
#: Tries of a micro-batch before its records go to the dead letters.
BATCH_ATTEMPTS = 3


def alert_store(spark: SparkSession, out_dir: str) -> KeyedStore:
    """SNK6/STR5: the alerts of all batches, the first one of each transaction."""
    return KeyedStore(spark, f"{out_dir}/alert_store", ALERT_SCHEMA, "transaction_id", ["detected_at"], log=f"{out_dir}/alerts")


def outbox(spark: SparkSession, out_dir: str) -> Outbox:
    """SNK7: notifications and whether they were sent."""
    return Outbox(spark, f"{out_dir}/outbox")


def _record(spark: SparkSession, path: str, **row) -> None:
    text = {k: str(v)[:2000] for k, v in row.items()}
    spark.createDataFrame([tuple(text.values())], ", ".join(f"{k} string" for k in text)).write.mode("append").parquet(path)


def make_sink(
    out_dir: str,
    thresholds_path: str | None = None,
    thresholds: Thresholds | dict | None = None,
    publish=None,
    score=fraud.apply_rules,
    attempts: int = BATCH_ATTEMPTS,
    attempts_dir: str | None = None,
):
    """SNK6-SNK9 in one foreachBatch: scored, alerts, notifications, FRAUD_ALERT audit
    events (AUD2) and late/duplicate rejects.

    With ``thresholds_path`` the thresholds file is read again for every
    micro-batch (SRC8: thresholds change without a restart).

    Scored rows and alerts are the batch's result: if they fail, the batch fails.
    A batch that failed ``attempts`` times (counted in ``attempts_dir``, which a
    restart finds again) is given up: all its sequence numbers go to
    ``rejects_batch`` with the error, it has no other output, and the stream goes
    on (STR6).  Notifications go to the outbox and, with ``publish``, are sent
    from there; a failure there or in the audit is written to ``sink_failures``
    and leaves the batch whole (SNK7, SNK12).
    """

    last: Thresholds | None = None
    failures = attempts_dir or f"{out_dir}/attempts"

    def aside(spark: SparkSession, batch_id: int, name: str, act) -> None:
        try:
            act()
        except Exception as e:  # noqa: BLE001 - the batch's result stands without this sink
            log.warning("sink %s of batch %s: %s", name, batch_id, e)
            _record(spark, f"{out_dir}/sink_failures", batch_id=batch_id, sink=name, error=e)

    def results(batch: DataFrame, batch_id: int) -> DataFrame:
        nonlocal last
        if thresholds_path is not None:
            last = load_thresholds(thresholds_path, last)
        scored = score(batch.where(~F.col("is_duplicate")), thresholds if thresholds_path is None else last).persist()
        try:
            _write_batch(scored, f"{out_dir}/scored", batch_id)
            alerts = shared_alerts(scored, batch_id)
        finally:
            scored.unpersist()
        rej = batch.where(F.col("is_late") | F.col("is_duplicate")).select(
            "sequence_number",
            "transaction_id",
            F.when(F.col("is_late"), F.lit("late")).otherwise(F.lit("duplicate")).alias("reason"),
        )
        _write_batch(rej, f"{out_dir}/rejects_state", batch_id)
        return alerts

    def shared_alerts(scored: DataFrame, batch_id: int) -> DataFrame:
        spark = scored.sparkSession
        alert_store(spark, out_dir).put(fraud.fraud_alerts(scored), batch_id)
        return spark.read.schema(ALERT_SCHEMA).parquet(f"{out_dir}/alerts/batch_id={batch_id}")

    def give_up(batch: DataFrame, batch_id: int, error: Exception) -> None:
        spark = batch.sparkSession
        for name in ("scored", "rejects_state"):
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{name}/batch_id={batch_id}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        store = alert_store(spark, out_dir)
        store.put(spark.createDataFrame([], store.schema), batch_id)
        said = F.lit(str(error)[:2000])
        _write_batch(batch.select("sequence_number", "transaction_id", said.alias("error")), f"{out_dir}/rejects_batch", batch_id)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            try:
                alerts = results(batch, batch_id)
            except Exception as e:  # noqa: BLE001 - counted, and raised again until the attempts are used up
                tries = f"{failures}/batch_id={batch_id}"
                _record(spark, tries, error=e)
                if spark.read.schema("error string").parquet(tries).count() < attempts:
                    raise
                log.error("batch %s given up after %s attempts: %s", batch_id, attempts, e)
                give_up(batch, batch_id, e)
                return
            notes = fraud.fraud_notifications(alerts)
            aside(spark, batch_id, "notifications", lambda: _write_batch(notes, f"{out_dir}/notifications", batch_id))
            aside(spark, batch_id, "outbox", lambda: outbox(spark, out_dir).put(notes, "transaction_id", batch_id))
            if publish is not None:
                aside(spark, batch_id, "publish", lambda: outbox(spark, out_dir).deliver(publish))
            aside(spark, batch_id, "audit", lambda: _write_batch(governance.fraud_alert_events(alerts), f"{out_dir}/audit", batch_id))
        finally:
            batch.unpersist()

    return sink


STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
#: Spark's default store, which has one column family.
MEMORY_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@contextmanager
def _held(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """``conf`` while the block runs; then as it was."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_fraud_stream(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    thresholds: Thresholds | dict | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = 1000,
    watermark: str = "10 minutes",
    thresholds_path: str | None = None,
    typed_state: bool = False,
    state_options: dict | None = None,
    shards: dict | None = None,
    **sink,
):
    """Start the scoring and rejects queries; returns both StreamingQuery handles.

    ``source_dir`` holds JSON files or, with ``shards`` (options of
    ``sources.shards.read_shards``, {} for none), shards read by offset.
    """

    def parsed_records(query: str) -> DataFrame:
        if shards is not None:
            return decode_and_parse(read_shards(spark, source_dir, f"{checkpoint_dir}/progress/{query}.json", **shards))
        reader = spark.readStream.schema(STREAM_RECORD_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return decode_and_parse(reader.json(source_dir))

    parsed = parsed_records("scoring")
    featured = with_account_state(parsed, watermark, typed_state, **(state_options or {}))
    sink.setdefault("attempts_dir", f"{checkpoint_dir}/attempts")

    def trig(w):
        if available_now:
            return w.trigger(availableNow=True)
        return w.trigger(processingTime=processing_time or "10 seconds")

    # Processing-time timeouts would otherwise schedule an endless series of
    # no-data batches under availableNow; timeouts are handled on data batches.
    # Typed state needs a store with column families, whatever the session was built with.
    # The settings are captured when the query starts, then restored.
    conf = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    if typed_state and spark.conf.get(STORE_KEY, MEMORY_STORE) == MEMORY_STORE:
        conf[STORE_KEY] = CORE_CONF[STORE_KEY]
    with _held(spark, conf):
        q1 = trig(
            featured.writeStream.foreachBatch(make_sink(out_dir, thresholds_path, thresholds, **sink))
            .option("checkpointLocation", f"{checkpoint_dir}/scoring")
        ).start()
    rejects = parsed_records("rejects").where(F.col("reject_reason").isNotNull()).select(
        "sequence_number", "arrival_ts", "reject_reason", F.col("text").alias("payload")
    )
    q2 = trig(
        rejects.writeStream.format("parquet")
        .option("path", f"{out_dir}/rejects")
        .option("checkpointLocation", f"{checkpoint_dir}/rejects")
    ).start()
    return q1, q2


def run_available_now(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str, **kw) -> None:
    """Process everything currently in ``source_dir`` and stop (SRC3-style incremental run)."""
    qs = start_fraud_stream(spark, source_dir, out_dir, checkpoint_dir, available_now=True, **kw)
    for q in qs:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def read_output(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    reader = spark.read.option("basePath", f"{out_dir}/{name}")
    if name == "alerts":  # a batch without alerts has no file
        reader = reader.schema(ALERT_SCHEMA)
    return reader.parquet(f"{out_dir}/{name}/batch_id=*").drop("bucket")
