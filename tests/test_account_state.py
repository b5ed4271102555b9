"""Typed per-account state: equal to the one-document state, read by key, with times to live."""

import time

from test_streaming import _payload, _txn, _write

from ledgerline.streaming import fraud_stream as fs

COLUMNS = ["transaction_id", "recent_count", "is_new_merchant", "is_late"]


def scored(spark, out):
    return sorted(map(tuple, fs.read_output(spark, out, "scored").select(*COLUMNS).collect()))


def reasons(spark, out):
    return sorted((r.sequence_number, r.reason) for r in fs.read_output(spark, out, "rejects_state").collect())


def test_equals_the_document_state(spark, tmp_dir):
    batches = [
        [_txn(i, "ab"[i % 2], 7 * i, merchant=f"M{i % 4}") for i in range(12)] + [_txn(3, "b", 21)],
        [_txn(20, "a", 100), _txn(2, "a", 14, merchant="M2"), _txn(21, "c", 90, merchant=None), _txn(22, "b", 30, merchant="M1", hour=9)],
        [_txn(30, "a", 150, merchant="M9"), _txn(22, "b", 30, hour=9), _txn(31, "b", 140, merchant="M1")],
    ]
    for kind in (False, True):
        for k, txns in enumerate(batches):
            _write(f"{tmp_dir}/{kind}/src", f"p{k}", [(f"{k}-{i}", _payload(t)) for i, t in enumerate(txns)])
            fs.run_available_now(spark, f"{tmp_dir}/{kind}/src", f"{tmp_dir}/{kind}/out", f"{tmp_dir}/{kind}/ck", typed_state=kind)
    one, other = (f"{tmp_dir}/{kind}/out" for kind in (False, True))
    assert scored(spark, one) == scored(spark, other) and len(scored(spark, one)) == 17
    assert reasons(spark, one) == reasons(spark, other) and len(reasons(spark, one)) >= 3


def test_a_merchant_is_forgotten_after_its_time_to_live(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    run = {"typed_state": True, "state_options": {"merchant_ttl_s": 20}}
    _write(src, "p0", [("s0", _payload(_txn(0, "a", 0, merchant="M1")))])
    fs.run_available_now(spark, src, out, ck, **run)
    _write(src, "p1", [("s1", _payload(_txn(1, "a", 5, merchant="M1")))])
    fs.run_available_now(spark, src, out, ck, **run)
    time.sleep(21)
    _write(src, "p2", [("s2", _payload(_txn(2, "a", 10, merchant="M1")))])
    fs.run_available_now(spark, src, out, ck, **run)
    assert [r[2] for r in scored(spark, out)] == [True, False, True]


def test_an_account_with_many_merchants_is_read_by_key(spark, tmp_dir):
    """The document of such an account has to be read and written whole; a batch of one row reads one merchant here."""
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    many = [_txn(i, "a", i / 1000, merchant=f"M{i}") for i in range(1500)]
    _write(src, "p0", [(f"s{i}", _payload(t)) for i, t in enumerate(many)])
    fs.run_available_now(spark, src, out, ck, typed_state=True, state_options={"dedupe_horizon_s": 1})
    start = time.time()
    _write(src, "p1", [("x", _payload(_txn(9000, "a", 60, merchant="M17"))), ("y", _payload(_txn(9001, "a", 61, merchant="new")))])
    fs.run_available_now(spark, src, out, ck, typed_state=True, state_options={"dedupe_horizon_s": 1})
    got = {r[0]: r[2] for r in scored(spark, out)}
    assert got["9000"] is False and got["9001"] is True and time.time() - start < 60


def test_typed_state_in_a_session_with_the_default_store(spark, tmp_dir):
    """The session that runs a query may have been built without ledgerline's settings."""
    plain = spark.newSession()
    for k, v in {fs.STORE_KEY: fs.MEMORY_STORE, "spark.sql.shuffle.partitions": "2", "spark.sql.session.timeZone": "UTC"}.items():
        plain.conf.set(k, v)
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    for k in range(2):  # the second run restarts from the first one's checkpoint
        _write(src, f"p{k}", [(f"s{k}", _payload(_txn(k, "a", k, merchant="M1")))])
        fs.run_available_now(plain, src, out, f"{tmp_dir}/ck", typed_state=True)
    assert [r[2] for r in scored(plain, out)] == [True, False]
    assert plain.conf.get(fs.STORE_KEY) == fs.MEMORY_STORE
