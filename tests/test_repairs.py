"""Behaviour at the edges: stream state over time, job outputs, failing checks, missing dates, sub-cent money."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.functions.columns import cents_long
from ledgerline.operators import dims, fraud, quality
from ledgerline.plans import jobs
from ledgerline.streaming import fraud_stream as fs

START = pd.Timestamp("2024-01-01")


class State:
    """The parts of GroupState that the state function uses."""

    def __init__(self):
        self.value, self.hasTimedOut, self.watermark_ms = None, False, 0

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentWatermarkMs(self):
        return self.watermark_ms

    def update(self, value):
        self.value = value

    def setTimeoutDuration(self, ms):
        pass

    def remove(self):
        self.value = None


def run(fn, state, *rows):
    """rows: (id, minute, merchant)."""
    data = [
        [str(i), "a", 1, "DEBIT", 0, False, "US", merchant, "d", START + pd.Timedelta(minutes=minute), f"s{i}"]
        for i, minute, merchant in rows
    ]
    frames = iter([pd.DataFrame(data, columns=fs.STATEFUL_FIELDS)]) if rows else iter([])
    return [r for out in fn(("a",), frames, state) for r in out.to_dict("records")]


def ms(minute):
    return int((START + pd.Timedelta(minutes=minute)).timestamp() * 1000)


def test_an_idle_account_keeps_its_ids_and_merchants():
    fn, state = fs.make_state_fn(), State()
    run(fn, state, (1, 0, "M1"))
    state.hasTimedOut, state.watermark_ms = True, ms(120)
    assert run(fn, state) == []
    state.hasTimedOut = False
    again, other = run(fn, state, (1, 0, "M1"), (2, 130, "M1"))
    assert again["is_duplicate"] and not other["is_duplicate"] and not other["is_new_merchant"]
    state.hasTimedOut, state.watermark_ms = True, ms(10_000)
    run(fn, state)
    assert json.loads(state.value[0])["s"] == {} and json.loads(state.value[0])["m"]


def test_an_idle_account_without_horizons_left_goes():
    fn, state = fs.make_state_fn(merchant_horizon_s=3600), State()
    run(fn, state, (1, 0, "M1"))
    state.hasTimedOut, state.watermark_ms = True, ms(10_000)
    run(fn, state)
    assert not state.exists


def test_a_row_within_the_watermark_counts_all_its_history():
    fn, state = fs.make_state_fn(), State()
    run(fn, state, (1, 0, "M1"), (2, 60, "M1"))
    state.watermark_ms = ms(50)
    (row,) = run(fn, state, (3, 55, "M1"))
    assert row["recent_count"] == 1 and not row["is_late"]


def test_late_rows_are_scored_with_a_flag():
    fn, state = fs.make_state_fn(), State()
    run(fn, state, (1, 300, "M1"))
    state.watermark_ms = ms(290)
    (row,) = run(fn, state, (2, 10, "M2"))
    assert row["is_late"] and not row["is_duplicate"] and row["is_new_merchant"]
    (row,) = run(fn, state, (2, 10, "M2"))
    assert row["is_duplicate"]


def _bronze(spark, rows):
    at = lambda h: f"TIMESTAMP'2024-01-01 0{h}:00:00'"
    each = [
        f"SELECT '{i}' transaction_id, 'acc' account_id, DATE'2024-01-0{d}' transaction_date, CAST(10 AS DECIMAL(15,2)) amount, "
        f"'USD' currency, 'DEBIT' transaction_type, 'COMPLETED' status, '5411-1' merchant_id, 'm' merchant_name, "
        f"CAST(NULL AS STRING) category, 'US' country_code, CAST(NULL AS STRING) ip_address, '01:00:00' transaction_time, 'dev' device_id, "
        f"{at(1)} created_at, {at(h)} updated_at, current_timestamp() ingestion_timestamp, 'f' source_file, "
        f"current_date() ingestion_date"
        for i, d, h in rows
    ]
    return spark.sql(" UNION ALL ".join(each))


def test_a_moved_date_leaves_one_silver_row_and_versions_are_not_reused(spark, tmp_dir):
    bronze, silver = f"{tmp_dir}/bronze", f"{tmp_dir}/silver"
    _bronze(spark, [("t1", 1, 1)]).write.partitionBy("transaction_date").parquet(bronze)
    jobs.transform(spark, bronze, silver)
    _bronze(spark, [("t1", 2, 2)]).write.mode("append").partitionBy("transaction_date").parquet(bronze)
    counts = jobs.transform(spark, bronze, silver)
    assert counts == {"records_read": 2, "records_written": 1}
    rows = spark.read.parquet(silver).collect()
    assert [(r.transaction_id, r.transaction_date.day) for r in rows] == [("t1", 2)]
    jobs.load(spark, silver, f"{tmp_dir}/fact")
    with pytest.raises(FileExistsError):
        jobs.load(spark, silver, f"{tmp_dir}/fact")


def test_a_broken_check_fails_alone(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    check = lambda kind, **kw: {"expectation_type": f"expect_{kind}", "kwargs": kw}
    suite = {
        "expectations": [
            check("column_values_to_match_regex", column="s", regex="["),
            check("column_values_to_be_in_set", column="n", value_set=["x", "1", 2]),
            check("column_values_to_be_between", column="n", min_value="low"),
            check("column_values_to_not_be_null", column="s"),
        ]
    }
    rows = {r.idx: r for r in quality.validate(df, suite).collect()}
    assert [rows[i].success for i in range(4)] == [False, True, False, True]
    assert rows[0].error and rows[2].error and not rows[3].error
    summary = quality.summarize(quality.validate(df, suite)).first()
    assert (summary.total, summary.passed) == (4, 2)


def test_an_empty_suite_has_no_rows_and_a_zero_rate(spark):
    df = spark.createDataFrame([(1,)], "n int")
    full = quality.validate(df, {"expectations": [{"expectation_type": "expect_column_to_exist", "kwargs": {"column": "n"}}]})
    empty = quality.validate(df, {"expectations": []})
    assert empty.columns == full.columns and empty.count() == 0
    assert quality.summarize(empty).first().pass_rate == 0.0


def test_a_fact_without_a_date_stays_and_calendars_are_bounded(spark):
    fact = spark.sql(
        "SELECT 't1' transaction_id, DATE'2024-01-01' transaction_date, 'm' merchant_id, 1.0 amount_usd "
        "UNION ALL SELECT 't2', NULL, 'm', 2.0"
    )
    merchants = spark.sql("SELECT 'm' merchant_id, '5411' mcc_code, false is_high_risk")
    out = dims.fact_join_dims(fact, dims.dim_date_for(fact), merchants).collect()
    assert sorted((r.transaction_id, r.year) for r in out) == [("t1", 2024), ("t2", None)]
    wild = spark.sql("SELECT explode(array(DATE'2024-01-01', DATE'9999-12-31')) transaction_date")
    with pytest.raises(Exception, match="days"):
        dims.dim_date_for(wild).collect()


def test_cents_are_rounded_not_cut(spark):
    df = spark.range(1).select(F.lit(1.15).alias("d"), F.expr("CAST(0.005 AS DECIMAL(10,3))").alias("fine"))
    assert tuple(df.select(cents_long("d"), cents_long("fine")).first()) == (115, 1)


def test_velocity_of_ties_and_borders(spark):
    minutes = [0, 0, 30, 60, 60, 61, 90]
    df = spark.createDataFrame(
        [(str(i), "a", (START + pd.Timedelta(minutes=m)).to_pydatetime()) for i, m in enumerate(minutes)],
        "transaction_id string, account_id string, created_at timestamp",
    )
    got = {int(r.transaction_id): r.recent_count for r in fraud.velocity_counts(df).collect()}
    want = {i: sum(m - 60 < x < m for x in minutes) for i, m in enumerate(minutes)}
    assert got == want
    plan = fraud.velocity_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert "RangeFrame, -" not in plan.replace("unboundedpreceding$(), -", "")


def test_a_second_incremental_ingest_takes_only_new_files_and_the_stream_has_a_command(spark, tmp_dir):
    from ledgerline.plans.cli import main
    from ledgerline.sources.generator import generate

    d = tmp_dir
    raw = generate(spark, 40, 5, 5, seed=3, end_date="2024-01-31")
    raw.coalesce(1).write.option("header", "true").csv(f"{d}/raw")
    again = ["ingest", "--source", f"{d}/raw", "--bronze", f"{d}/b", "--quarantine", f"{d}/q", "--checkpoint", f"{d}/ck"]
    for _ in range(2):
        assert main(again, stop_session=False) == 0
    assert spark.read.parquet(f"{d}/b").count() == 40
    jobs.transform(spark, f"{d}/b", f"{d}/s")
    fs.encode_payloads(spark.read.parquet(f"{d}/s")).write.json(f"{d}/records")
    assert main(["stream", "--source", f"{d}/records", "--output", f"{d}/out", "--checkpoint", f"{d}/ck2"], stop_session=False) == 0
    assert fs.read_output(spark, f"{d}/out", "scored").count() == 40


def test_thresholds_are_read_through_the_file_systems(spark, tmp_dir):
    from ledgerline.config import load_thresholds

    with open(f"{tmp_dir}/t.json", "w") as f:
        json.dump({"velocity_per_hour": 3}, f)
    for path in (f"{tmp_dir}/t.json", f"file:{tmp_dir}/t.json", f"file://{tmp_dir}/t.json"):
        assert load_thresholds(path).velocity_per_hour == 3


def test_ingest_reads_its_files_once(spark, tmp_dir):
    raw = spark.createDataFrame(
        [("t1", "a", "2024-01-01", "1.00", "DEBIT", "SETTLED"), ("t2", None, "2024-01-01", "1.00", "DEBIT", "SETTLED")],
        "transaction_id string, account_id string, transaction_date string, amount string, transaction_type string, status string",
    )
    cols = [c for c in jobs.read_raw(spark, tmp_dir).columns if c != jobs.CORRUPT_COLUMN]
    raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in cols]).write.option(
        "header", "true"
    ).csv(f"{tmp_dir}/raw")
    jobs.ingest(spark, f"{tmp_dir}/raw", f"{tmp_dir}/b", f"{tmp_dir}/q")
    b, q = (spark.read.parquet(f"{tmp_dir}/{x}").collect() for x in "bq")
    # both sinks hold rows of one reading: they share its time
    assert (b[0].transaction_id, q[0].transaction_id) == ("t1", "t2")
    assert b[0].ingestion_timestamp == q[0].ingestion_timestamp


class Clock(State):
    now = 0

    def getCurrentProcessingTimeMs(self):
        return self.now


def test_grouped_accounts_have_the_states_of_single_ones():
    """Three accounts (one without id) in one document give the rows that each gives alone, also after a time out."""
    batches = [
        [(1, "a", 0, "M1"), (2, "b", 5, "M1"), (3, None, 6, "M1"), (4, "a", 10, None), (1, "a", 0, "M1"), (5, "b", 4, "M2")],
        [(6, "a", 20, "M1"), (2, "b", 5, "M1"), (7, None, 30, "M1"), (8, "c", 1, "M9")],
        [(9, "b", 2000, "M2"), (3, None, 6, "M1"), (4, "a", 10, None)],
    ]

    def frame(rows):
        data = [[str(i), a, 1, "DEBIT", 0, False, "US", m, "d", START + pd.Timedelta(minutes=t), f"s{i}"] for i, a, t, m in rows]
        return pd.DataFrame(data, columns=fs.STATEFUL_FIELDS)

    together, group = fs.make_state_fn(grouped=True), Clock()
    apart, states = fs.make_state_fn(), {}
    for k, rows in enumerate(batches):
        group.now, group.watermark_ms = k * 4_000_000, ms(10 * k)
        got = pd.concat(together((1,), iter([frame(rows)]), group))
        want = []
        for account in dict.fromkeys(r[1] for r in rows):
            state = states.setdefault(account, State())
            state.watermark_ms = ms(10 * k)
            want += apart((account,), iter([frame([r for r in rows if r[1] == account])]), state)
        as_rows = lambda f: sorted(map(tuple, f.astype(str).to_numpy()))
        assert as_rows(got) == as_rows(pd.concat(want))
    group.hasTimedOut, group.now, group.watermark_ms = True, 20_000_000, ms(10_000)
    assert list(together((1,), iter([]), group)) == []
    left = {a: st for a, st, _ in json.loads(group.value[0])}
    assert set(left) == {"a", "b", "c", None} and not any(st["s"] or st["t"] for st in left.values())


def test_a_record_is_parsed_once(spark):
    records = spark.createDataFrame([("a", "b", None)], "sequence_number string, data string, arrival_ts timestamp")
    for rows in ("reject_reason is null", "reject_reason is not null"):
        plan = fs.decode_and_parse(records).where(rows)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1 and plan.count("unbase64") == 1


def test_a_batch_of_the_store_has_a_file_for_each_bucket(spark, tmp_dir):
    import glob

    from ledgerline.streaming.keyed_store import KeyedStore

    store = KeyedStore(spark, f"{tmp_dir}/store", "k string, ttl bigint", "k", buckets=4)
    store.put(spark.range(400).repartition(8).selectExpr("cast(id as string) k", "id ttl"), 0)
    assert len(glob.glob(f"{tmp_dir}/store/log/batch_id=0/bucket=*/*.parquet")) == 4 and store.read().count() == 400
