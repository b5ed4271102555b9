"""Structured Streaming scorer: bad payloads, re-delivery, late rows, batch parity."""

import base64
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ledgerline.operators import fraud
from ledgerline.streaming import fraud_stream as fs


def _payload(txn):
    return base64.b64encode(json.dumps(txn).encode()).decode()


def _txn(i, acct, minute, amount="50.00", merchant="M1", hour=12):
    ts = dt.datetime(2024, 1, 1, hour, 0) + dt.timedelta(minutes=minute)
    return {
        "transaction_id": str(i),
        "account_id": acct,
        "amount_usd": amount,
        "transaction_type": "DEBIT",
        "transaction_hour": ts.hour,
        "is_international": False,
        "country_code": "US",
        "merchant_id": merchant,
        "device_id": "d",
        "created_at": ts.strftime("%Y-%m-%dT%H:%M:%S.000000Z"),
    }


def _write(path, name, records):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        for seq, data in records:
            f.write(json.dumps({"sequence_number": seq, "data": data, "arrival_ts": "2024-01-01T12:00:00.000000Z"}) + "\n")


def test_stream_rejects_duplicates_and_parity(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    txns = [_txn(1, "a", 0), _txn(2, "a", 10, amount="900.00", merchant="M2"), _txn(3, "a", 30), _txn(4, "b", 5)]
    recs = [(f"s{i}", _payload(t)) for i, t in enumerate(txns)]
    recs += [
        ("bad-b64", "!!!not-base64!!!"),
        ("bad-json", base64.b64encode(b"not-json").decode()),
        ("no-id", _payload({k: v for k, v in _txn(9, "a", 1).items() if k != "transaction_id"})),
        ("again", _payload(txns[0])),  # re-delivered record
    ]
    _write(src, "part1", recs)
    fs.run_available_now(spark, src, out, ck)
    scored = {r.transaction_id: r for r in fs.read_output(spark, out, "scored").collect()}
    assert set(scored) == {"1", "2", "3", "4"}
    assert scored["3"].recent_count == 2 and scored["2"].is_new_merchant is True and scored["3"].is_new_merchant is False
    rej = {r.sequence_number: r.reject_reason for r in spark.read.parquet(f"{out}/rejects").collect()}
    assert rej == {"bad-b64": "decode", "bad-json": "json", "no-id": "missing_id"}
    dup = [r.reason for r in fs.read_output(spark, out, "rejects_state").collect()]
    assert dup == ["duplicate"]
    alerts = {r.transaction_id for r in fs.read_output(spark, out, "alerts").collect()}
    audit = {r.subject for r in fs.read_output(spark, out, "audit").collect()}
    assert audit == alerts

    # second micro-batch: state carries over; a re-delivery of an old id is skipped again
    _write(src, "part2", [("s9", _payload(_txn(5, "a", 40))), ("again2", _payload(txns[1]))])
    fs.run_available_now(spark, src, out, ck)
    scored = {r.transaction_id: r for r in fs.read_output(spark, out, "scored").collect()}
    assert scored["5"].recent_count == 3 and scored["5"].is_new_merchant is False
    assert sorted(r.reason for r in fs.read_output(spark, out, "rejects_state").collect()) == ["duplicate", "duplicate"]

    # batch parity on the same (in-order) events
    batch = spark.createDataFrame([(t["transaction_id"], t["account_id"], t["merchant_id"], t["created_at"]) for t in txns + [_txn(5, "a", 40)]],
                                  "transaction_id string, account_id string, merchant_id string, created_at string")
    batch = batch.withColumn("created_at", F.to_timestamp("created_at"))
    b = {r.transaction_id: (r.recent_count, r.is_new_merchant) for r in fraud.first_merchant_visits(fraud.velocity_counts(batch)).collect()}
    assert b == {k: (v.recent_count, v.is_new_merchant) for k, v in scored.items()}


def test_late_rows_are_rejected(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _write(src, "p1", [("s1", _payload(_txn(1, "a", 0, hour=12)))])
    fs.run_available_now(spark, src, out, ck, watermark="10 minutes")
    _write(src, "p2", [("s2", _payload(_txn(2, "a", 0, hour=13)))])  # advances the watermark to 12:50
    fs.run_available_now(spark, src, out, ck, watermark="10 minutes")
    _write(src, "p3", [("s3", _payload(_txn(3, "a", 5, hour=11)))])  # 11:05 < watermark
    fs.run_available_now(spark, src, out, ck, watermark="10 minutes")
    reasons = {r.transaction_id: r.reason for r in fs.read_output(spark, out, "rejects_state").collect()}
    assert reasons == {"3": "late"}


def test_thresholds_reloaded_per_micro_batch(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    th = f"{tmp_dir}/thresholds.json"
    with open(th, "w") as f:
        json.dump({"high_amount_usd": 10000}, f)
    _write(src, "p1", [("s1", _payload(_txn(1, "a", 0, amount="15000.00")))])
    fs.run_available_now(spark, src, out, ck, thresholds_path=th)
    with open(th, "w") as f:
        json.dump({"high_amount_usd": 20000}, f)
    _write(src, "p2", [("s2", _payload(_txn(2, "a", 5, amount="15000.00")))])
    fs.run_available_now(spark, src, out, ck, thresholds_path=th)
    got = {r.transaction_id: r.action for r in fs.read_output(spark, out, "scored").collect()}
    assert got == {"1": "FLAG", "2": "ALLOW"}


def test_state_function_merchant_horizon():
    import pandas as pd

    class FakeState:
        def __init__(self):
            self.exists, self.hasTimedOut, self.value = False, False, None

        @property
        def get(self):
            return self.value

        def getCurrentWatermarkMs(self):
            return 0

        def update(self, v):
            self.value, self.exists = v, True

        def setTimeoutDuration(self, ms):
            pass

        def remove(self):
            self.exists = False

    fn = fs.make_state_fn(merchant_horizon_s=3600)
    st = FakeState()

    def batch(rows):
        pdf = pd.DataFrame(rows, columns=fs.STATEFUL_FIELDS)
        return next(fn(("a",), iter([pdf]), st))

    def row(i, minute, merchant):
        ts = pd.Timestamp("2024-01-01 00:00") + pd.Timedelta(minutes=minute)
        return [str(i), "a", 1, "DEBIT", 0, False, "US", merchant, "d", ts, f"s{i}"]

    out = batch([row(1, 0, "M1"), row(2, 30, "M1")])
    assert out["is_new_merchant"].tolist() == [True, False]
    assert out["recent_count"].tolist() == [0, 1]
    out = batch([row(3, 200, "M1")])  # M1 last seen 170 minutes ago > 1 h horizon
    assert out["is_new_merchant"].tolist() == [True]
    assert out["recent_count"].tolist() == [0]
    saved = json.loads(st.value[0])
    assert saved["t"] == [int(pd.Timestamp("2024-01-01 03:20").value // 1000)]
    assert sorted(saved["s"]) == ["1", "2", "3"] and sorted(saved["m"]) == ["M1"]
