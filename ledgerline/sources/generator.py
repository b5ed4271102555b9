"""Synthetic raw transactions (SRC10), generated on the executors.

Every random draw is a seeded hash of (seed, row id, draw number), so the
output does not depend on partitioning, and ``spark.range(n)`` splits the
work across the cluster.  Rows follow the raw 16-column schema, unhashed
(ingest does the masking), with some merchants carrying an MCC prefix so
category enrichment has work to do.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C

# ---------------------------------------------------------------------------
# Fixed values — generator distributions.
# ---------------------------------------------------------------------------
STATUS_WEIGHTS = [("PENDING", 0.05), ("SETTLED", 0.88), ("FLAGGED", 0.04), ("REVERSED", 0.02), ("FAILED", 0.01)]
CURRENCY_WEIGHTS = [("USD", 0.60), ("EUR", 0.15), ("GBP", 0.10), ("JPY", 0.05), ("CAD", 0.05), ("AUD", 0.05)]
COUNTRY_WEIGHTS = [
    ("US", 0.65), ("GB", 0.08), ("DE", 0.06), ("FR", 0.05), ("CA", 0.06),
    ("AU", 0.04), ("JP", 0.03), ("NG", 0.02), ("RO", 0.01),
]
HOUR_WEIGHTS = [1, 2, 3, 2, 1, 1, 2, 5, 8, 10, 12, 14, 15, 14, 13, 12, 11, 10, 9, 8, 7, 5, 3, 2]
CATEGORIES = [
    "Groceries", "Restaurants", "Gas Stations", "Transit", "Hotels", "Airlines", "Retail",
    "ATM", "Pharmacy", "Software", "Electronics", "Healthcare", "Uncategorized",
]
N_MERCHANTS = 500
LOGNORMAL_MU, LOGNORMAL_SIGMA, AMOUNT_CAP = 4.5, 1.5, 99999.99
REFUND_RANGE = (5.0, 500.0)
TRANSFER_RANGE = (100.0, 50000.0)
DEVICE_PRESENT = 0.95
DEVICE_POOL = 10000


def _u(seed: int, k: int) -> Column:
    """Uniform [0, 1) from a 53-bit slice of xxhash64(seed, id, k)."""
    h = F.xxhash64(F.lit(seed), F.col("id"), F.lit(k))
    return (F.abs(h) % F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def _choice(u: Column, weighted: list[tuple[str, float]]) -> Column:
    total = sum(w for _, w in weighted)
    acc, expr = 0.0, None
    for v, w in weighted[:-1]:
        acc += w / total
        expr = (expr if expr is not None else F).when(u < F.lit(acc), F.lit(v))
    return expr.otherwise(F.lit(weighted[-1][0]))


def generate(
    spark: SparkSession,
    n: int,
    n_accounts: int = 1000,
    days_back: int = 90,
    seed: int = 42,
    end_date: str | None = None,
    mcc_share: float = 0.3,
    partitions: int | None = None,
) -> DataFrame:
    """JOB6: ``n`` raw transactions over ``n_accounts`` accounts and ``days_back`` days."""
    end = dt.date.fromisoformat(end_date) if end_date else dt.date.today()
    base = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    day = F.date_sub(F.lit(end), F.floor(_u(seed, 1) * (days_back + 1)).cast("int"))
    hour = _choice(_u(seed, 2), [(str(h), float(w)) for h, w in enumerate(HOUR_WEIGHTS)]).cast("int")
    minute = F.floor(_u(seed, 3) * 60).cast("int")
    second = F.floor(_u(seed, 4) * 60).cast("int")
    ttype = F.element_at(F.array(*[F.lit(t) for t in C.TRANSACTION_TYPES]), (F.floor(_u(seed, 5) * 4) + 1).cast("int"))
    acct = F.format_string("ACC-%06d", (F.floor(_u(seed, 6) * n_accounts) + 1).cast("int"))
    # Box-Muller normal -> lognormal, capped
    z = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - _u(seed, 7))) * F.cos(F.lit(2 * 3.141592653589793) * _u(seed, 8))
    lognormal = F.least(F.exp(F.lit(LOGNORMAL_MU) + F.lit(LOGNORMAL_SIGMA) * z), F.lit(AMOUNT_CAP))
    u9 = _u(seed, 9)
    amount = (
        F.when(F.col("transaction_type") == "REFUND", F.lit(REFUND_RANGE[0]) + u9 * (REFUND_RANGE[1] - REFUND_RANGE[0]))
        .when(F.col("transaction_type") == "TRANSFER", F.lit(TRANSFER_RANGE[0]) + u9 * (TRANSFER_RANGE[1] - TRANSFER_RANGE[0]))
        .otherwise(lognormal)
    )
    mnum = (F.floor(_u(seed, 10) * N_MERCHANTS) + 1).cast("int")
    mccs = list(C.MCC_CATEGORIES)
    mcc = F.element_at(F.array(*[F.lit(m) for m in mccs]), (F.floor(_u(seed, 11) * len(mccs)) + 1).cast("int"))
    merchant = F.when(F.col("transaction_type") == "TRANSFER", F.lit(None).cast("string")).otherwise(
        F.when(_u(seed, 12) < F.lit(mcc_share), F.concat(mcc, F.lit("-"), mnum.cast("string"))).otherwise(
            F.format_string("MERCHANT_%04d", mnum)
        )
    )
    category = F.when(_u(seed, 13) < 0.5, F.lit(None).cast("string")).otherwise(
        F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (F.floor(_u(seed, 14) * len(CATEGORIES)) + 1).cast("int"))
    )
    device = F.when(
        _u(seed, 15) < F.lit(DEVICE_PRESENT),
        F.substring(F.sha2(F.concat(F.lit("device-"), (F.floor(_u(seed, 16) * DEVICE_POOL) + 1).cast("string")), 256), 1, 16),
    )
    octet = lambda k, lo: (F.floor(_u(seed, k) * (256 - lo)) + lo).cast("int").cast("string")
    ip = F.concat_ws(".", octet(17, 1), octet(18, 0), octet(19, 0), octet(20, 0))
    h = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string")), 256)
    txn_id = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    df = base.select(
        "id",
        day.alias("transaction_date"),
        hour.alias("_h"),
        minute.alias("_m"),
        second.alias("_s"),
        ttype.alias("transaction_type"),
    )
    ts = F.make_timestamp(
        F.year("transaction_date"), F.month("transaction_date"), F.dayofmonth("transaction_date"), F.col("_h"), F.col("_m"), F.col("_s")
    )
    return df.select(
        txn_id.alias("transaction_id"),
        acct.alias("account_id"),
        "transaction_date",
        F.format_string("%02d:%02d:%02d", "_h", "_m", "_s").alias("transaction_time"),
        F.round(amount, 2).cast("decimal(18,2)").alias("amount"),
        _choice(_u(seed, 21), CURRENCY_WEIGHTS).alias("currency"),
        "transaction_type",
        merchant.alias("merchant_id"),
        F.lit(None).cast("string").alias("merchant_name"),
        category.alias("category"),
        _choice(_u(seed, 22), STATUS_WEIGHTS).alias("status"),
        _choice(_u(seed, 23), COUNTRY_WEIGHTS).alias("country_code"),
        device.alias("device_id"),
        ip.alias("ip_address"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
    )
