"""Alert store, outbox and failing sinks of the scoring stream."""

import os

import pytest
from pyspark.sql import functions as F
from test_streaming import _payload, _txn, _write

from ledgerline.operators import fraud
from ledgerline.streaming import fraud_stream as fs
from ledgerline.streaming.keyed_store import KeyedStore
from ledgerline.streaming.outbox import Outbox

SCHEMA = "k string, v int, ttl bigint"


def put(spark, store, batch, *rows):
    store.put(spark.createDataFrame(list(rows), SCHEMA), batch)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def base_files(store):
    _, _, folders = store._manifest()
    return {b: sorted(os.listdir(f"{store.path}/{f}/bucket={b}")) for b, f in folders}


def test_first_put_stays_and_last_put_wins(spark, tmp_dir):
    for keep, want in (("first", [("a", 1, 5), ("b", 2, 5), (None, 7, 5)]), ("last", [("a", 3, 5), ("b", 2, 5), (None, 7, 5)])):
        store = KeyedStore(spark, f"{tmp_dir}/{keep}", SCHEMA, "k", keep=keep, buckets=4)
        assert store.read().count() == 0
        put(spark, store, 0, ("a", 1, 5), (None, 7, 5))
        put(spark, store, 1, ("a", 9, 5), ("b", 2, 5))
        put(spark, store, 1, ("a", 3, 5), ("b", 2, 5))  # the batch again
        put(spark, store, 2)
        assert rows(store.read()) == sorted(want, key=repr)
        store.compact()
        put(spark, store, 3, ("b", 2, 5))
        assert rows(store.read()) == sorted(want, key=repr)
        assert rows(store.get(["a", "zz"])) == [want[0]]


def test_compaction_rewrites_only_buckets_with_changes(spark, tmp_dir):
    store = KeyedStore(spark, f"{tmp_dir}/s", SCHEMA, "k", buckets=8)
    put(spark, store, 0, *[(f"k{i}", i, 1_000_000 + i) for i in range(100)])
    assert store.compact()["rewritten"] == 8
    before = base_files(store)
    put(spark, store, 1, ("new", 1, 2_000_000))
    assert store.compact() == {"rewritten": 1, "left": 7, "through": 1}
    after = base_files(store)
    assert sum(after[b] == before[b] for b in before) == 7 and store.read().count() == 101
    # one row's time is over: its bucket alone is rewritten
    out = store.compact("1970-01-12 13:46:40")  # 1,000,000 s
    assert out["rewritten"] == 1 and store.read().count() == 100
    assert sum(base_files(store)[b] == after[b] for b in after) == 7
    want = rows(store.read())
    assert store.vacuum() > 0 and rows(store.read()) == want and not store._numbered(store.log, "batch_id")
    assert store.read("1970-01-12 13:46:50").count() == 90
    store.compact("2000-01-01")
    assert store.read().count() == 0
    put(spark, store, 2, ("late", 1, 3_000_000_000))
    assert store.read().count() == 1


def test_compaction_that_is_not_finished_is_not_seen(spark, tmp_dir):
    store = KeyedStore(spark, f"{tmp_dir}/s", SCHEMA, "k", buckets=2)
    put(spark, store, 0, ("a", 1, 5))
    store.compact()
    put(spark, store, 1, ("b", 1, 5))
    store.compact()
    os.remove(f"{tmp_dir}/s/manifests/v=2/_SUCCESS")
    assert store._manifest()[0] == 1 and rows(store.read()) == [("a", 1, 5), ("b", 1, 5)]


def receivers():
    """One that is down and one that takes all; made here, as tasks can't import the tests."""

    def always_down(message_id, payload, attempt):
        raise TimeoutError("down")

    def ok(message_id, payload, attempt):
        assert payload.startswith("{") and attempt >= 1

    return always_down, ok


always_down, ok = receivers()


def test_outbox_keeps_what_is_not_sent(spark, tmp_dir):
    box = Outbox(spark, f"{tmp_dir}/o", most=2)
    assert box.state().count() == 0
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 3)], "id string, n int")
    box.put(df, "id", 0)
    box.put(df.where("id = 'a'"), "id", 1)
    box.deliver(always_down)
    assert {(r.message_id, r.attempts, r.delivered, r.last_error) for r in box.state().collect()} == {
        ("a", 1, False, "TimeoutError: down"), ("b", 1, False, "TimeoutError: down")
    }
    box.put(spark.createDataFrame([("c", 1)], "id string, n int"), "id", 2)
    box.deliver(ok)
    assert box.pending().count() == 0
    assert {(r.message_id, r.attempts, r.delivered) for r in box.state().collect()} == {("a", 2, True), ("b", 2, True), ("c", 1, True)}


def fraud_txn(i, minute):
    return _txn(i, f"acct{i}", minute, amount="90000.00", merchant=f"M{i}", hour=3)


def test_failing_receiver_and_audit_leave_the_batch_whole(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _write(src, "part1", [(f"s{i}", _payload(fraud_txn(i, i))) for i in range(4)])
    os.makedirs(out)
    open(f"{out}/audit", "w").close()  # a file where the audit's folder should be
    fs.run_available_now(spark, src, out, ck, publish=always_down)
    assert fs.read_output(spark, out, "scored").count() == 4
    alerts = fs.alert_store(spark, out).read().count()
    assert alerts == 4 and fs.outbox(spark, out).pending().count() == 4
    failed = spark.read.parquet(f"{out}/sink_failures").collect()
    assert [r.sink for r in failed] == ["audit"] and failed[0].batch_id == "0"
    fs.outbox(spark, out).deliver(ok)
    assert fs.outbox(spark, out).pending().count() == 0


def poisoned(batch, thresholds):
    bad = F.when(F.col("transaction_id") == "2", F.raise_error(F.lit("poison")).cast("string")).otherwise(F.col("transaction_id"))
    return fraud.apply_rules(batch.withColumn("transaction_id", bad), thresholds)


def test_poisoned_batch_is_reported_in_full_and_the_next_one_scored(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _write(src, "part1", [(f"s{i}", _payload(fraud_txn(i, i))) for i in range(4)])
    for _ in range(2):  # the stream stops, and is started again
        with pytest.raises(Exception):  # noqa: B017
            fs.run_available_now(spark, src, out, ck, score=poisoned, attempts=3)
    assert not os.path.exists(f"{out}/rejects_batch")
    fs.run_available_now(spark, src, out, ck, score=poisoned, attempts=3)
    rejected = fs.read_output(spark, out, "rejects_batch").collect()
    assert sorted(r.sequence_number for r in rejected) == ["s0", "s1", "s2", "s3"] and "poison" in rejected[0].error
    _write(src, "part2", [("s9", _payload(fraud_txn(9, 9)))])
    fs.run_available_now(spark, src, out, ck, score=poisoned, attempts=3)
    assert [r.transaction_id for r in fs.read_output(spark, out, "scored").collect()] == ["9"]
    assert [r.transaction_id for r in fs.alert_store(spark, out).read().collect()] == ["9"]


def test_unwritable_audit_does_not_fail_a_job(spark, tmp_dir):
    from ledgerline.plans import jobs
    from ledgerline.plans.catalog import silver_t

    silver_t(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_dir}/silver")
    open(f"{tmp_dir}/audit", "w").close()
    run = {"audit_path": f"{tmp_dir}/audit", "lineage_path": f"{tmp_dir}/audit"}
    assert jobs.load(spark, f"{tmp_dir}/silver", f"{tmp_dir}/fact", **run)["records_written"] > 0
    with pytest.raises(FileExistsError):  # the job's own error, not the audit's
        jobs.load(spark, f"{tmp_dir}/silver", f"{tmp_dir}/fact", **run)
