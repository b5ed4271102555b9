"""Fraud scoring: per-account history features and the six rules as Columns.

Batch forms of the stream's keyed state:

* ``velocity_counts`` (WIN8/JOIN6): number of the account's transactions in
  the open interval (t - 1 h, t).  Computed as a difference of running counts partitioned
  by (account, time bucket); each bucket also receives a narrow "halo" copy of
  the previous bucket's last hour (emitted in the same pass with ``explode``),
  so the window never needs a whole account in one task — a hot account is
  split into many buckets.
* ``first_merchant_visits`` (JOIN5): first (ts, id) per (account, merchant)
  via a map-side-combined ``min(struct)``, joined back on all four keys
  (the hash spreads on the unique transaction id, so no key skews the join).
* ``apply_rules`` (FR1-FR9): integer points (hundredths), capped at 100,
  decisions at the flag/block thresholds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import Thresholds
from ..functions.columns import count_when, intdiv


# ---------------------------------------------------------------- WIN8 / JOIN6 velocity
def velocity_counts(
    df: DataFrame,
    account_col: str = "account_id",
    ts_col: str = "created_at",
    window_s: int = C.VELOCITY_WINDOW_SECONDS,
    bucket_s: int = 4 * C.VELOCITY_WINDOW_SECONDS,
    out_col: str = "recent_count",
) -> DataFrame:
    """Add ``out_col`` = rows of the same account with ts in (t - window, t).

    Rows at exactly the same instant and the row itself are not counted.
    ``bucket_s`` (>= window_s) bounds the rows one window partition holds to
    one account's ``bucket_s + window_s`` of history; only the last
    ``window_s`` of each bucket is copied (narrow: key + ts) into the next.
    """
    if bucket_s < window_s:
        raise ValueError("bucket_s must be >= window_s")
    W = window_s * 1_000_000
    B = bucket_s * 1_000_000
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    cols = df.columns
    base = df.select("*", us.alias("_us")).withColumn(
        "_b", intdiv(F.col("_us") - F.pmod(F.col("_us"), F.lit(B)), F.lit(B))
    )
    # One pass: rows in the last `window` of their bucket are emitted twice,
    # the copy (key + time only) landing in the next bucket as history.
    in_halo = F.col("_us") >= (F.col("_b") + 1) * B - W
    copies = F.when(in_halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    e = base.select("*", F.explode(copies).alias("_copy"))
    primary = F.col("_copy") == 0
    e = e.select(
        *[F.col(c) if c == account_col else F.when(primary, F.col(c)).alias(c) for c in cols],
        "_us",
        (F.col("_b") + F.col("_copy")).alias("_b"),
        primary.alias("_primary"),
    )
    # Rows before t less rows up to t - window: two running counts over one sort, linear
    # in the partition, where a sliding frame re-reads its rows for every row.
    w = Window.partitionBy(account_col, "_b").orderBy("_us")
    upto = lambda d: F.count(F.lit(1)).over(w.rangeBetween(Window.unboundedPreceding, d))
    cnt = F.when(F.col("_us").isNull(), F.lit(0)).otherwise(upto(-1) - upto(-W))
    return e.withColumn(out_col, cnt.cast("int")).where("_primary").drop("_us", "_b", "_primary")


# ---------------------------------------------------------------- JOIN5 new merchant
def first_merchant_visits(
    df: DataFrame,
    account_col: str = "account_id",
    merchant_col: str = "merchant_id",
    ts_col: str = "created_at",
    id_col: str = "transaction_id",
    out_col: str = "is_new_merchant",
    history: DataFrame | None = None,
) -> DataFrame:
    """Add ``out_col``: true iff no earlier (ts, id) exists for the same
    (account, merchant).  NULL merchant -> false.

    ``history`` (default ``df``) is the frame the first visits are computed
    from — pass the raw input when ``df`` carries expensive derived columns.
    """
    src = history if history is not None else df
    firsts = (
        src.where(F.col(merchant_col).isNotNull() & F.col(account_col).isNotNull())
        .groupBy(account_col, merchant_col)
        .agg(F.min(F.struct(F.col(ts_col).alias("t"), F.col(id_col).alias("i"))).alias("_f"))
        .select(
            F.col(account_col).alias("_fa"),
            F.col(merchant_col).alias("_fm"),
            F.col("_f.t").alias("_ft"),
            F.col("_f.i").alias("_fi"),
        )
    )
    cond = (
        (F.col(account_col) == F.col("_fa"))
        & (F.col(merchant_col) == F.col("_fm"))
        & (F.col(ts_col) == F.col("_ft"))
        & (F.col(id_col) == F.col("_fi"))
    )
    return (
        df.join(firsts, cond, "left")
        .withColumn(out_col, F.col("_fa").isNotNull())
        .drop("_fa", "_fm", "_ft", "_fi")
    )


# ---------------------------------------------------------------- FR1-FR6 rules
def _signal(rule: str, triggered: Column, score: Column, reason: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        triggered.alias("triggered"),
        score.cast("double").alias("score"),
        reason.alias("reason"),
    )


def rule_high_amount(th: Thresholds) -> tuple[Column, Column, Column]:
    """FR1: amount_usd (missing -> 0) > high_amount_usd -> 40 points."""
    amt = F.coalesce(F.col("amount_usd").cast("double"), F.lit(0.0))
    trig = amt > F.lit(float(th.high_amount_usd))
    reason = F.when(
        trig,
        F.concat(F.lit("Amount $"), F.col("amount_usd").cast("string"), F.lit(f" exceeds ${th.high_amount_usd}")),
    ).otherwise(F.lit(""))
    return trig, F.when(trig, F.lit(C.POINTS_HIGH_AMOUNT)).otherwise(F.lit(0)), reason


def rule_unusual_hour(th: Thresholds) -> tuple[Column, Column, Column]:
    """FR2: 1 <= hour <= 4 (missing -> 12) -> 20 points."""
    hour = F.coalesce(F.col("transaction_hour").cast("int"), F.lit(C.MISSING_HOUR))
    trig = hour.between(C.UNUSUAL_HOUR_FIRST, C.UNUSUAL_HOUR_LAST)
    reason = F.when(
        trig, F.concat(F.lit("Transaction at "), F.lpad(hour.cast("string"), 2, "0"), F.lit(":00 UTC (high-risk window)"))
    ).otherwise(F.lit(""))
    return trig, F.when(trig, F.lit(C.POINTS_UNUSUAL_HOUR)).otherwise(F.lit(0)), reason


def _high_risk(th: Thresholds) -> Column:
    if not th.high_risk_countries:
        return F.lit(False)
    return F.coalesce(F.col("country_code").isin(*th.high_risk_countries), F.lit(False))


def rule_international(th: Thresholds) -> tuple[Column, Column, Column]:
    """FR3: triggered = is_international; weight 50 for a high-risk country, else 15.

    A high-risk country with is_international = false reports its weight
    but is not triggered, so it adds nothing.
    """
    trig = F.coalesce(F.col("is_international"), F.lit(False))
    hr = _high_risk(th)
    weight = F.when(hr, F.lit(C.POINTS_HIGH_RISK_COUNTRY)).otherwise(
        F.when(trig, F.lit(C.POINTS_INTERNATIONAL)).otherwise(F.lit(0))
    )
    reason = (
        F.when(hr, F.concat(F.lit("Transaction from high-risk country "), F.col("country_code")))
        .when(trig, F.lit("International transaction"))
        .otherwise(F.lit(""))
    )
    return trig, weight, reason


def rule_velocity(th: Thresholds, recent_col: str = "recent_count") -> tuple[Column, Column, Column]:
    """FR4: recent_count > velocity_per_hour -> 60 points."""
    n = F.coalesce(F.col(recent_col), F.lit(0))
    trig = n > F.lit(int(th.velocity_per_hour))
    reason = F.when(
        trig,
        F.concat(n.cast("string"), F.lit(f" transactions in 1 hour (limit: {th.velocity_per_hour})")),
    ).otherwise(F.lit(""))
    return trig, F.when(trig, F.lit(C.POINTS_VELOCITY)).otherwise(F.lit(0)), reason


def rule_new_merchant(th: Thresholds, new_col: str = "is_new_merchant") -> tuple[Column, Column, Column]:
    """FR5: new merchant and amount_usd > 500 -> 35 points."""
    amt = F.coalesce(F.col("amount_usd").cast("double"), F.lit(0.0))
    trig = F.coalesce(F.col(new_col), F.lit(False)) & (amt > F.lit(float(C.NEW_MERCHANT_MIN_USD)))
    reason = F.when(trig, F.lit("Large transaction at previously unseen merchant")).otherwise(F.lit(""))
    return trig, F.when(trig, F.lit(C.POINTS_NEW_MERCHANT)).otherwise(F.lit(0)), reason


def rule_card_not_present(th: Thresholds) -> tuple[Column, Column, Column]:
    """FR6: no device_id on a DEBIT -> 25 points."""
    trig = F.col("device_id").isNull() & F.coalesce(F.col("transaction_type") == "DEBIT", F.lit(False))
    reason = F.when(trig, F.lit("Debit with no device_id (card-not-present)")).otherwise(F.lit(""))
    return trig, F.when(trig, F.lit(C.POINTS_CARD_NOT_PRESENT)).otherwise(F.lit(0)), reason


def rule_set(th: Thresholds, recent_col: str = "recent_count", new_col: str = "is_new_merchant"):
    """The six rules in evaluation order: name -> (triggered, weight points, reason)."""
    return {
        "HIGH_AMOUNT": rule_high_amount(th),
        "UNUSUAL_HOUR": rule_unusual_hour(th),
        "INTERNATIONAL": rule_international(th),
        "VELOCITY": rule_velocity(th, recent_col),
        "NEW_MERCHANT_HIGH_VALUE": rule_new_merchant(th, new_col),
        "CARD_NOT_PRESENT": rule_card_not_present(th),
    }


# ---------------------------------------------------------------- FR7-FR9 evaluate / decide
def apply_rules(
    df: DataFrame,
    thresholds: Thresholds | dict | None = None,
    recent_col: str = "recent_count",
    new_col: str = "is_new_merchant",
) -> DataFrame:
    """Add signals (array<struct<rule,triggered,score,reason>>), score_points,
    total_score (0..1, 4 dp), is_fraud, action and triggered_rules."""
    th = thresholds if isinstance(thresholds, Thresholds) else Thresholds.from_dict(thresholds)
    rules = rule_set(th, recent_col, new_col)
    signals = F.array(*[_signal(name, t, w / F.lit(100.0), r) for name, (t, w, r) in rules.items()])
    pts = sum((F.when(t, w).otherwise(F.lit(0)) for (t, w, _) in rules.values()), F.lit(0))
    pts = F.least(pts, F.lit(C.MAX_POINTS))
    action = (
        F.when(pts >= F.lit(th.block_points), F.lit("BLOCK"))
        .when(pts >= F.lit(th.flag_points), F.lit("FLAG"))
        .otherwise(F.lit("ALLOW"))
    )
    out = df.withColumns(
        {
            "signals": signals,
            "score_points": pts.cast("int"),
            "total_score": pts.cast("double") / F.lit(100.0),
            "is_fraud": pts >= F.lit(th.flag_points),
            "action": action,
        }
    )
    return out.withColumn(
        "triggered_rules", F.transform(F.filter("signals", lambda s: s["triggered"]), lambda s: s["rule"])
    )


#: The columns that scoring and alerts read: a narrower copy than the layer's serves both.
SCORE_INPUTS = (
    "transaction_id", "account_id", "merchant_id", "created_at", "amount_usd", "transaction_type", "transaction_hour",
    "country_code", "device_id", "is_international",
)


def score_transactions(
    txns: DataFrame,
    thresholds: Thresholds | dict | None = None,
    ts_col: str = "created_at",
    bucket_s: int = 4 * C.VELOCITY_WINDOW_SECONDS,
) -> DataFrame:
    """FR10 (batch): velocity -> new merchant -> rules, over whole tables."""
    v = velocity_counts(txns, ts_col=ts_col, bucket_s=bucket_s)
    n = first_merchant_visits(v, ts_col=ts_col, history=txns)
    return apply_rules(n, thresholds)


# ---------------------------------------------------------------- SNK6-SNK8, AGG9
def fraud_alerts(scored: DataFrame, detected_at_col: str = "created_at") -> DataFrame:
    """SNK6/SNK8: one alert row per fraudulent transaction (is_fraud).

    ``detected_at`` defaults to the transaction's event time so re-runs are
    reproducible; ``ttl`` = detected_at + 90 days (epoch seconds).
    """
    triggered = F.filter("signals", lambda s: s["triggered"])
    sig_json = F.to_json(F.transform(triggered, lambda s: F.struct(s["rule"].alias("rule"), s["reason"].alias("reason"))))
    det = F.col(detected_at_col).cast("timestamp")
    return scored.where("is_fraud").select(
        "transaction_id",
        det.alias("detected_at"),
        "account_id",
        F.col("amount_usd").cast("decimal(18,2)").alias("amount_usd"),
        "action",
        (F.col("score_points").cast("decimal(5,0)") / F.lit(100)).cast("decimal(5,4)").alias("risk_score"),
        sig_json.alias("signals"),
        F.array_join("triggered_rules", ",").alias("triggered_rules"),
        (F.unix_seconds(det) + F.lit(C.TTL_ALERT_S)).alias("ttl"),
    )


def fraud_notifications(alerts: DataFrame) -> DataFrame:
    """SNK7: notification rows for FLAG/BLOCK alerts (subject, JSON body, attributes)."""
    body = F.to_json(
        F.struct(
            F.col("transaction_id"),
            F.col("account_id"),
            F.col("action"),
            F.col("risk_score").cast("double").alias("risk_score"),
            F.col("amount_usd").cast("string").alias("amount_usd"),
            F.split(F.col("triggered_rules"), ",").alias("triggered_rules"),
            F.date_format("detected_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("detected_at"),
        ),
        {"ignoreNullFields": "false"},
    )
    return alerts.where(F.col("action").isin("FLAG", "BLOCK")).select(
        "transaction_id",
        F.concat(F.lit("["), F.col("action"), F.lit("] Fraud Alert — "), F.col("transaction_id")).alias("subject"),
        body.alias("body"),
        F.col("action").alias("attr_action"),
        F.col("risk_score").cast("double").alias("attr_risk_score"),
    )


def batch_outcomes(scored: DataFrame) -> DataFrame:
    """AGG9: processed / blocked / flagged / allowed counts."""
    a = F.col("action")
    return scored.agg(
        F.count(F.lit(1)).alias("processed"),
        count_when(a == "BLOCK").alias("blocked"),
        count_when(a == "FLAG").alias("flagged"),
        count_when(a == "ALLOW").alias("allowed"),
    )
