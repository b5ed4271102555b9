"""ETL operators: masking, validity split, currency, categories, derived columns, dedupe, upsert."""

import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import etl
from ledgerline.schemas import RAW_TRANSACTION_SCHEMA

D = Decimal


def raw_row(**kw):
    base = dict(
        transaction_id="t1",
        account_id="ACC-000001",
        transaction_date=dt.date(2024, 1, 6),  # a Saturday
        transaction_time="02:15:00",
        amount=D("100.00"),
        currency="USD",
        transaction_type="DEBIT",
        merchant_id="5411-77",
        merchant_name=None,
        category=None,
        status="SETTLED",
        country_code="US",
        device_id="dev-1",
        ip_address="10.0.0.1",
        created_at=dt.datetime(2024, 1, 6, 2, 15),
        updated_at=dt.datetime(2024, 1, 6, 2, 15),
    )
    base.update(kw)
    return tuple(base[f.name] for f in RAW_TRANSACTION_SCHEMA.fields)


NULLABLE_RAW = T.StructType([T.StructField(f.name, f.dataType, True) for f in RAW_TRANSACTION_SCHEMA.fields])


def frame(spark, *rows_):
    return spark.createDataFrame(list(rows_), NULLABLE_RAW)


def test_mask_pii_hashes_account_and_ip(spark):
    df = etl.mask_pii(frame(spark, raw_row(), raw_row(transaction_id="t2", ip_address=None)))
    got = {r.transaction_id: r for r in df.collect()}
    assert got["t1"].account_id == hashlib.sha256(b"ACC-000001").hexdigest()
    assert got["t1"].ip_address == hashlib.sha256(b"10.0.0.1").hexdigest()
    assert got["t2"].ip_address is None
    assert len(got["t1"].account_id) == 64


def test_validity_split_keeps_duplicates_and_partitions_input(spark):
    rows_ = [
        raw_row(),
        raw_row(transaction_id=None),
        raw_row(transaction_id="t3", transaction_type="WIRE"),
        raw_row(transaction_id="t4", status="UNKNOWN"),
        raw_row(transaction_id="t5", status=None),
        raw_row(transaction_id="t6", amount=None),
        raw_row(transaction_id="t3", transaction_type="WIRE"),  # duplicate reject
    ]
    df = frame(spark, *rows_)
    valid, quarantine = etl.split_valid(df)
    assert [r.transaction_id for r in valid.collect()] == ["t1"]
    assert quarantine.count() == 6  # duplicates kept
    assert valid.count() + quarantine.count() == df.count()
    _, q_distinct = etl.split_valid(df, distinct_quarantine=True)
    assert q_distinct.count() == 5


def test_validity_strict_requires_date_and_currency(spark):
    df = frame(spark, raw_row(currency=None), raw_row(transaction_id="t2", transaction_date=None))
    assert etl.split_valid(df)[0].count() == 2
    assert etl.split_valid(df, strict=True)[0].count() == 0


def test_null_profile(spark):
    df = frame(spark, raw_row(), raw_row(transaction_id=None, currency=None))
    r = etl.null_profile(df).first()
    assert (r.null_transaction_id, r.null_account_id, r.null_currency) == (1, 0, 1)


def test_normalize_currency(spark):
    df = frame(
        spark,
        raw_row(transaction_id="a", currency="USD", amount=D("100.00")),
        raw_row(transaction_id="b", currency="EUR", amount=D("100.00")),
        raw_row(transaction_id="c", currency="GBP", amount=D("50.00")),
        raw_row(transaction_id="d", currency="XYZ", amount=D("100.00")),
        raw_row(transaction_id="e", currency="JPY", amount=D("12345.67")),
    )
    got = {r.transaction_id: (r.exchange_rate, r.amount_usd) for r in etl.normalize_currency(df).collect()}
    assert got["a"] == (D("1.000000"), D("100.00"))
    assert got["b"][1] == D("108.00")
    assert got["c"][1] == D("63.50")
    assert got["d"] == (None, None)
    assert got["e"][1] == D("82.72")  # 12345.67 * 0.0067 = 82.715989, exact decimal rounding
    with_default = {r.transaction_id: r.amount_usd for r in etl.normalize_currency(df, default_rate="1.0").collect()}
    assert with_default["d"] == D("100.00")


def test_enrich_category(spark):
    df = frame(
        spark,
        raw_row(transaction_id="a", category="Travel", merchant_id="5411-1"),
        raw_row(transaction_id="b", category=None, merchant_id="5812-9"),
        raw_row(transaction_id="c", category=None, merchant_id="MERCHANT_0001"),
        raw_row(transaction_id="d", category=None, merchant_id=None),
    )
    got = {r.transaction_id: r.category for r in etl.enrich_category(df).collect()}
    assert got == {"a": "Travel", "b": "Restaurants", "c": "Uncategorized", "d": "Uncategorized"}


def test_derived_columns(spark):
    df = frame(
        spark,
        raw_row(transaction_id="a", amount=D("10000.00")),
        raw_row(transaction_id="b", amount=D("10000.01"), country_code="GB", transaction_date=dt.date(2024, 1, 8)),
        raw_row(transaction_id="c", transaction_time="25:99:00", country_code=None, transaction_date=dt.date(2024, 1, 7)),
    )
    got = {r.transaction_id: r for r in etl.add_derived_columns(etl.normalize_currency(df)).collect()}
    assert got["a"].day_of_week == 7 and got["a"].is_weekend is True
    assert got["c"].day_of_week == 1 and got["c"].is_weekend is True  # Sunday
    assert got["b"].day_of_week == 2 and got["b"].is_weekend is False
    assert got["a"].transaction_hour == 2
    assert got["c"].transaction_hour is None  # malformed time -> NULL, no error
    assert got["a"].is_international is False and got["b"].is_international is True
    assert got["c"].is_international is None
    assert got["a"].is_high_value is False and got["b"].is_high_value is True


def test_dedupe_keeps_latest_and_is_idempotent(spark):
    df = frame(
        spark,
        raw_row(transaction_id="t1", amount=D("1.00"), updated_at=dt.datetime(2024, 1, 1, 10)),
        raw_row(transaction_id="t1", amount=D("2.00"), updated_at=dt.datetime(2024, 1, 1, 12)),
        raw_row(transaction_id="t2", amount=D("3.00")),
    )
    once = etl.deduplicate_transactions(df)
    got = {r.transaction_id: r.amount for r in once.collect()}
    assert got == {"t1": D("2.00"), "t2": D("3.00")}
    twice = etl.deduplicate_transactions(once)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_dedupe_ties_are_deterministic(spark):
    rows_ = [raw_row(transaction_id="t1", amount=D(f"{i}.00")) for i in range(1, 6)]
    a = etl.deduplicate_transactions(frame(spark, *rows_)).first().amount
    b = etl.deduplicate_transactions(frame(spark, *reversed(rows_)).repartition(3)).first().amount
    assert a == b


def test_dedupe_hot_key_many_copies(spark):
    # one key holding most rows: still one row out, the latest version
    base = spark.range(5000).select(
        F.lit("hot").alias("k"), (F.col("id") % 977).alias("v"), F.col("id").alias("ts")
    ).union(spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(0).cast("long"), F.lit(0).cast("long")))
    out = etl.dedupe_latest(base, ["k"], ["ts"])
    assert out.count() == 101
    assert out.where("k = 'hot'").first().ts == 4999


def _silver(spark, rows_):
    return etl.to_silver(frame(spark, *rows_))


def test_upsert_update_insert_untouched_and_idempotent(spark):
    target = _silver(spark, [raw_row(transaction_id="a"), raw_row(transaction_id="b")])
    staging = _silver(
        spark,
        [
            raw_row(transaction_id="b", amount=D("200.00"), status="REVERSED", merchant_id="X", updated_at=dt.datetime(2024, 1, 7)),
            raw_row(transaction_id="c", amount=D("5.00")),
        ],
    )
    out = etl.upsert(target, staging)
    got = {r.transaction_id: r for r in out.collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["b"].amount == D("200.00") and got["b"].status == "REVERSED" and got["b"].amount_usd == D("200.00")
    assert got["b"].merchant_id == "5411-77"  # not an update column: target value kept
    assert got["a"].amount == D("100.00")
    again = etl.upsert(out, staging)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
    assert etl.upsert_update_half(target, staging).count() == 1
    assert [r.transaction_id for r in etl.upsert_insert_half(target, staging).collect()] == ["c"]


def test_upsert_null_in_staging_overwrites(spark):
    target = _silver(spark, [raw_row(transaction_id="a")])
    staging = _silver(spark, [raw_row(transaction_id="a", currency="XYZ")])  # amount_usd NULL
    got = etl.upsert(target, staging).first()
    assert got.amount_usd is None and got.exchange_rate is None


def test_conform_fact_has_26_columns(spark):
    fact = etl.conform_fact(_silver(spark, [raw_row()]))
    assert len(fact.columns) == 26
    assert dict(fact.dtypes)["day_of_week"] == "smallint"
