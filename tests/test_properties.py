"""Property tests (hypothesis): invariants that must hold for any input."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from ledgerline.operators import etl, fraud, quality

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

ROW = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from(["t1", "t2", "t3", "t4"])),
        st.one_of(st.none(), st.just("a")),
        st.one_of(st.none(), st.decimals(min_value=0, max_value=1000, places=2)),
        st.one_of(st.none(), st.sampled_from(["DEBIT", "CREDIT", "WIRE"])),
        st.one_of(st.none(), st.sampled_from(["SETTLED", "BOGUS", "FAILED"])),
        st.datetimes(min_value=dt.datetime(2024, 1, 1), max_value=dt.datetime(2024, 1, 2)),
    ),
    max_size=25,
)


@SETTINGS
@given(rows)
def test_split_is_a_partition_with_duplicates_kept(spark, data):
    df = spark.createDataFrame(data, ROW)
    valid, quarantine = etl.split_valid(df)
    assert valid.count() + quarantine.count() == len(data)
    assert valid.exceptAll(df).count() == 0 and quarantine.exceptAll(df).count() == 0


@SETTINGS
@given(rows)
def test_dedupe_is_idempotent_and_keeps_one_latest_row_per_key(spark, data):
    df = spark.createDataFrame(data, ROW)
    once = etl.dedupe_latest(df, ["transaction_id"], ["updated_at"], hash_tiebreak=True)
    twice = etl.dedupe_latest(once, ["transaction_id"], ["updated_at"], hash_tiebreak=True)
    got = once.collect()
    assert sorted(map(repr, got)) == sorted(map(repr, twice.collect()))
    keys = [r.transaction_id for r in got]
    assert len(keys) == len(set(keys)) == len({r[0] for r in data})
    latest = {}
    for r in data:
        latest[r[0]] = max(latest.get(r[0], r[5]), r[5])
    assert all(r.updated_at == latest[r.transaction_id] for r in got)


@SETTINGS
@given(rows, rows)
def test_upsert_is_idempotent(spark, a, b):
    uniq = lambda d: list({r[0]: r for r in d if r[0] is not None}.values())
    cols = ["transaction_id", "account_id", "amount", "transaction_type", "status", "updated_at"]
    tgt = spark.createDataFrame(uniq(a), ROW)
    stg = spark.createDataFrame(uniq(b), ROW)
    upd = ("amount", "status", "updated_at")
    once = etl.upsert(tgt, stg, update_columns=upd)
    twice = etl.upsert(once, stg, update_columns=upd)
    assert sorted(map(repr, once.select(*cols).collect())) == sorted(map(repr, twice.select(*cols).collect()))
    assert once.count() == len({r[0] for r in uniq(a)} | {r[0] for r in uniq(b)})


@SETTINGS
@given(rows)
def test_dq_totals_add_up(spark, data):
    suite = {
        "expectations": [
            {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "transaction_id"}},
            {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "transaction_id"}},
            {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "status", "value_set": ["SETTLED"]}},
            {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "amount", "min_value": 1}},
            {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "missing"}},
        ]
    }
    s = quality.summarize(quality.validate(spark.createDataFrame(data, ROW), suite)).first()
    assert s.total == 5 and s.passed + s.failed == s.total and s.overall_success == (s.failed == 0)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(min_value=0, max_value=3 * 3600 * 4)), max_size=30))
def test_velocity_matches_brute_force(spark, events):
    base = dt.datetime(2024, 1, 1, 3, 0)
    ev = [(str(i), acct, None, base + dt.timedelta(seconds=sec)) for i, (acct, sec) in enumerate(events)]
    df = spark.createDataFrame(ev, "transaction_id string, account_id string, merchant_id string, created_at timestamp")
    got = {r.transaction_id: r.recent_count for r in fraud.velocity_counts(df, bucket_s=2 * 3600).collect()}
    want = {
        i: sum(1 for _, a2, _, t2 in ev if a2 == a and t - dt.timedelta(hours=1) < t2 < t) for i, a, _, t in ev
    }
    assert got == want
