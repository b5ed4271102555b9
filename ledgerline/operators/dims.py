"""Dimension tables (DIM2-DIM4) and star joins (JOIN7)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C

# A calendar dimension holds one row per day, at most this many (three centuries):
# dim_date_between fails beyond it, so broadcasting it is safe.
DIM_DATE_MAX_DAYS = 3 * 36525


def dim_date_between(df_bounds: DataFrame, fiscal_start_month: int = 1, holidays: Iterable[str] = ()) -> DataFrame:
    """DIM4: one row per day from ``lo`` to ``hi`` (a one-row frame with those two date columns)."""
    fits = F.coalesce(F.datediff("hi", "lo") < DIM_DATE_MAX_DAYS, F.lit(True))
    every_day = F.sequence(F.col("lo"), F.col("hi"), F.expr("INTERVAL 1 DAY"))
    too_long = F.raise_error(F.lit(f"a date dimension has at most {DIM_DATE_MAX_DAYS} days; check the dates"))
    days = df_bounds.select(F.explode(F.when(fits, every_day).otherwise(too_long)).alias("full_date"))
    m = F.month("full_date")
    fy_shift = F.when(F.lit(fiscal_start_month) > 1, F.when(m >= F.lit(fiscal_start_month), 1).otherwise(0)).otherwise(0)
    hol = list(holidays)
    is_hol = F.col("full_date").isin(*[F.to_date(F.lit(h)) for h in hol]) if hol else F.lit(False)
    return days.select(
        (F.year("full_date") * 10000 + m * 100 + F.dayofmonth("full_date")).cast("int").alias("date_key"),
        "full_date",
        F.year("full_date").cast("smallint").alias("year"),
        F.quarter("full_date").cast("smallint").alias("quarter"),
        m.cast("smallint").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.weekofyear("full_date").cast("smallint").alias("week_of_year"),
        F.dayofweek("full_date").cast("smallint").alias("day_of_week"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        F.dayofweek("full_date").isin(1, 7).alias("is_weekend"),
        is_hol.alias("is_us_holiday"),
        (F.year("full_date") + fy_shift).cast("smallint").alias("fiscal_year"),
        (F.floor(F.pmod(m - F.lit(fiscal_start_month), F.lit(12)) / 3) + 1).cast("smallint").alias("fiscal_quarter"),
    )


def dim_date_for(df: DataFrame, date_col: str = "transaction_date", **kw) -> DataFrame:
    """DIM4 spanning the dates present in ``df`` (bounds computed by one aggregate)."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return dim_date_between(bounds, **kw)


#: The columns that the merchant dimension reads.
MERCHANT_INPUTS = ("transaction_id", "merchant_id", "merchant_name", "category", "country_code", "created_at", "updated_at")


def dim_merchants(silver: DataFrame, high_risk_countries: Iterable[str] | None = None) -> DataFrame:
    """DIM3: latest attributes per merchant (map-side-combined max(struct)), first/last seen."""
    hr = list(high_risk_countries if high_risk_countries is not None else C.DEFAULT_THRESHOLDS["high_risk_countries"])
    latest = F.struct(
        F.col("updated_at").alias("u"),
        F.col("created_at").alias("c"),
        F.col("transaction_id").alias("i"),
        F.col("merchant_name").alias("merchant_name"),
        F.col("category").alias("category"),
        F.col("country_code").alias("country_code"),
    )
    g = (
        silver.where(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(F.max(latest).alias("_l"), F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"))
    )
    kv = []
    for k in C.MCC_CATEGORIES:
        kv.append(k)
    prefix = F.substring("merchant_id", 1, 4)
    return g.select(
        "merchant_id",
        F.col("_l.merchant_name").alias("merchant_name"),
        F.when(prefix.isin(*kv), prefix).alias("mcc_code"),
        F.col("_l.category").alias("category"),
        F.col("_l.country_code").alias("country_code"),
        F.coalesce(F.col("_l.country_code").isin(*hr), F.lit(False)).alias("is_high_risk") if hr else F.lit(False).alias("is_high_risk"),
        "created_at",
        "updated_at",
    )


def alert_id(transaction_id) -> "F.Column":
    """Deterministic UUID-shaped id per transaction (re-delivery keeps the same id)."""
    h = F.sha2(F.concat(F.lit("alert:"), transaction_id), 256)
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)
    )


def dim_fraud_alerts(alerts: DataFrame) -> DataFrame:
    """DIM2: warehouse alert table from the alert rows (resolution columns empty)."""
    return alerts.select(
        alert_id(F.col("transaction_id")).alias("alert_id"),
        "transaction_id",
        "account_id",
        "detected_at",
        "action",
        F.col("risk_score").cast("decimal(5,4)").alias("risk_score"),
        "triggered_rules",
        F.lit(None).cast("timestamp").alias("resolved_at"),
        F.lit(None).cast("string").alias("resolved_by"),
        F.lit(None).cast("string").alias("resolution_notes"),
    )


def fact_join_dims(fact: DataFrame, dim_date: DataFrame, merchants: DataFrame) -> DataFrame:
    """JOIN7: fact x date (broadcast: DIM_DATE_MAX_DAYS rows) x merchants (size left to AQE).

    Both joins are left joins: a fact without a date or merchant stays.
    """
    d = F.broadcast(dim_date.select("full_date", "year", "quarter", "month_name", F.col("is_weekend").alias("date_is_weekend")))
    m = merchants.select("merchant_id", "mcc_code", "is_high_risk")
    j = fact.join(d, fact["transaction_date"] == d["full_date"], "left").join(m, "merchant_id", "left")
    return j.select(
        "transaction_id",
        "transaction_date",
        "year",
        "quarter",
        "month_name",
        "date_is_weekend",
        "merchant_id",
        "mcc_code",
        F.coalesce(F.col("is_high_risk"), F.lit(False)).alias("is_high_risk"),
        "amount_usd",
    )
