"""Stand-in inputs built from the shared test tables.

* T — raw 16-column transactions derived from ``events``.
* L — a ledger of settled/other transactions derived from ``orders``.
* V — row versions from ``lineitem`` for the dedupe-latest operator.

Each stand-in is a list of ``(column, sql_expression)`` pairs written in the
SQL subset shared by Spark SQL and DuckDB, so the same definition feeds the
Spark pipeline (``selectExpr``) and the DuckDB oracle (``SELECT ... FROM``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import use_utc

# ---- T: transactions from `events` ---------------------------------------------------------
T_EXPRS: list[tuple[str, str]] = [
    ("transaction_id", "cast(event_id as string)"),
    ("account_id", "concat('ACC-', lpad(cast(user_id as string), 6, '0'))"),
    ("transaction_date", "cast(ts as date)"),
    ("transaction_time", "substring(cast(ts as string), 12, 8)"),
    ("amount", "cast(cast(value as decimal(18,2)) * 100 as decimal(18,2))"),
    (
        "currency",
        "case when event_id % 10 < 5 then 'USD' when event_id % 10 = 5 then 'EUR' "
        "when event_id % 10 = 6 then 'GBP' when event_id % 10 = 7 then 'JPY' "
        "when event_id % 10 = 8 then 'CAD' else 'XYZ' end",
    ),
    (
        "transaction_type",
        "case event_type when 'signup' then 'CREDIT' when 'purchase' then 'DEBIT' "
        "when 'click' then 'TRANSFER' when 'view' then 'REFUND' else 'WIRE' end",
    ),
    (
        "merchant_id",
        "case when event_type = 'click' then null "
        "when event_id % 4 = 0 then concat('5411-', cast(event_id % 40 as string)) "
        "when event_id % 4 = 1 then concat('5812-', cast(event_id % 40 as string)) "
        "else concat('MERCHANT_', cast(event_id % 40 as string)) end",
    ),
    ("merchant_name", "cast(null as string)"),
    ("category", "case when event_id % 3 = 0 then 'Retail' else null end"),
    (
        "status",
        "case when event_id % 50 = 0 then 'PENDING' when event_id % 50 in (1, 2) then 'FLAGGED' "
        "when event_id % 50 = 3 then 'REVERSED' when event_id % 50 = 4 then 'FAILED' "
        "when event_id % 50 = 5 then 'BOGUS' else 'SETTLED' end",
    ),
    (
        "country_code",
        "case when event_id % 20 < 13 then 'US' when event_id % 20 < 16 then 'GB' "
        "when event_id % 20 = 16 then 'NG' when event_id % 20 = 17 then null else 'DE' end",
    ),
    ("device_id", "case when event_id % 20 = 0 then null else concat('dev-', cast(event_id % 97 as string)) end"),
    (
        "ip_address",
        "case when event_id % 11 = 0 then null else concat('10.0.', cast(event_id % 200 as string), '.', "
        "cast(user_id % 200 as string)) end",
    ),
    ("created_at", "cast(ts as timestamp)"),
    ("updated_at", "cast(ts as timestamp)"),
]
T_AS_OF = "2024-01-30"
T_LATER_AS_OF = "2024-04-14"

# ---- L: ledger from `orders` ---------------------------------------------------------------
L_EXPRS: list[tuple[str, str]] = [
    ("transaction_id", "cast(o_orderkey as string)"),
    ("account_id", "cast(o_custkey as string)"),
    ("transaction_date", "cast(o_orderdate as date)"),
    (
        "transaction_type",
        "case o_orderpriority when '1-URGENT' then 'CREDIT' when '2-HIGH' then 'DEBIT' "
        "when '3-MEDIUM' then 'REFUND' else 'TRANSFER' end",
    ),
    (
        "amount_usd",
        "cast(case when o_orderpriority = '5-LOW' then -o_totalprice else o_totalprice end as decimal(18,2))",
    ),
    (
        "category",
        "case when o_orderkey % 4 = 0 then 'Groceries' when o_orderkey % 4 = 1 then 'Hotels' "
        "when o_orderkey % 4 = 2 then 'Retail' else null end",
    ),
    ("merchant_id", "case when o_orderkey % 9 = 0 then null else concat('M', cast(o_orderkey % 37 as string)) end"),
    ("currency", "case when o_orderkey % 5 = 0 then 'EUR' else 'USD' end"),
    (
        "status",
        "case when o_orderstatus = 'F' and o_orderkey % 10 = 0 then 'FLAGGED' "
        "when o_orderstatus = 'O' and o_orderkey % 10 = 1 then 'REVERSED' "
        "when o_orderkey % 25 = 2 then 'FAILED' when o_orderkey % 25 = 3 then 'PENDING' else 'SETTLED' end",
    ),
    ("is_international", "o_orderkey % 3 = 0"),
    ("is_high_value", "o_totalprice > 10000"),
]
L_AS_OF = "2001-08-01"

# ---- V: lineitem row versions --------------------------------------------------------------
V_KEYS = ("l_orderkey", "l_linenumber")
V_ORDER = ("l_shipdate", "l_partkey", "l_suppkey")  # all descending

# ---- upsert pair: target residues and staging residues of event_id % 5 -------------------
UPSERT_TARGET_PRED = "event_id % 5 <> 0"
UPSERT_STAGING_PRED = "event_id % 5 in (0, 1)"

# ---- corrections of few rows, after the upsert pair --------------------------------------
CORRECTED = "event_id % 499 = 1"
_CORRECTED = {
    "amount": "cast(cast(value as decimal(18,2)) * 100 + 3.50 as decimal(18,2))",
    "updated_at": "cast(ts as timestamp) + interval 2 hour",
}
T_CORRECTED_EXPRS = [(c, _CORRECTED.get(c, e)) for c, e in T_EXPRS]

# ---- second delivery of T for the jobs: later versions on another date or none, and rows as they were ----
REDELIVERED_LATER = "event_id % 7 = 2"
REDELIVERED_SAME = "event_id % 7 = 3"
_LATER = {
    "transaction_date": "case when event_id % 3 = 0 then cast(null as date) else cast(ts as date) + 1 end",
    "amount": "cast(cast(value as decimal(18,2)) * 100 + 1.25 as decimal(18,2))",
    "status": "'SETTLED'",
    "updated_at": "cast(ts as timestamp) + interval 1 day",
}
T_LATER_EXPRS = [(c, _LATER.get(c, e)) for c, e in T_EXPRS]


# ---- stream deliveries of silver T: ten days each, with out-of-order, late and re-delivered rows ----
STREAM_WATERMARK = "1 day"
_N = "cast(transaction_id as bigint)"
STREAM_DELIVERY = (
    "case when transaction_date < date '2024-01-11' then 1 when transaction_date < date '2024-01-21' then 2 else 3 end"
)
#: Rows of a delivery's last two days that come with the next one: those of the day before last are late.
STREAM_DELAYED = (
    "(transaction_date in (date '2024-01-09', date '2024-01-10', date '2024-01-19', date '2024-01-20') "
    f"and {_N} % 7 = 3)"
)
#: Rows that come twice in their delivery.
STREAM_TWICE = f"({_N} % 19 = 1 and not {STREAM_DELAYED})"
#: Rows of a delivery's last day that come again with the next one.
STREAM_AGAIN = (
    f"({_N} % 19 = 2 and transaction_date in (date '2024-01-10', date '2024-01-20') and not {STREAM_DELAYED})"
)
#: Rows of the first delivery that come once more after the last, when no account's state knows their ids any longer.
STREAM_LONG_AFTER = f"({STREAM_DELIVERY} = 1 and {_N} % 5 = 2 and not {STREAM_DELAYED})"
#: Broken records that come besides a row, by the remainder of its id: reason and text (none: no base64).
STREAM_BROKEN = {
    5: ("decode", None),
    6: ("json", '{"transaction_id": '),
    7: ("missing_id", '{"account_id": "ACC-000001"}'),
}
STREAM_BROKEN_BY = f"{_N} % 23"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _select(df: DataFrame, exprs: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {c}" for c, e in exprs])


def transactions_raw(spark: SparkSession, sf_dir: str, where: str | None = None) -> DataFrame:
    """T: raw 16-column transactions (unmasked, not validated)."""
    use_utc(spark)
    ev = table(spark, sf_dir, "events")
    if where:
        ev = ev.where(where)
    return _select(ev, T_EXPRS)


def upsert_staging_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed copies for the upsert: amount doubled, updated one hour later."""
    from pyspark.sql import functions as F

    raw = transactions_raw(spark, sf_dir, UPSERT_STAGING_PRED)
    return raw.withColumn("amount", (F.col("amount") * 2).cast("decimal(18,2)")).withColumn(
        "updated_at", F.col("updated_at") + F.expr("INTERVAL 1 HOUR")
    )


def corrections_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrected versions of a few rows of T."""
    use_utc(spark)
    return _select(table(spark, sf_dir, "events").where(CORRECTED), T_CORRECTED_EXPRS)


def redelivered_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later versions of some rows of T, and some rows as they were."""
    events = table(spark, sf_dir, "events")
    later = _select(events.where(REDELIVERED_LATER), T_LATER_EXPRS)
    return later.unionByName(transactions_raw(spark, sf_dir, REDELIVERED_SAME))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L: fact-shaped ledger rows from orders."""
    use_utc(spark)
    return _select(table(spark, sf_dir, "orders"), L_EXPRS)


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return table(spark, sf_dir, "lineitem")


# ---- DuckDB twins (used by the oracle SQL) ---------------------------------------------------
def sql_select(exprs: list[tuple[str, str]], source: str, where: str | None = None) -> str:
    cols = ",\n  ".join(f"{e} AS {c}" for c, e in exprs)
    w = f"\nWHERE {where}" if where else ""
    return f"SELECT\n  {cols}\nFROM {source}{w}"
