"""Reporting views over the fact table (P&L, balance sheet, KPIs, dashboards).

Inputs are fact-shaped DataFrames (``transaction_id, account_id,
transaction_date, transaction_type, amount_usd, category, merchant_id,
currency, status, is_international, is_high_value``).

Scale notes.  Every view starts with a grouped aggregate (partial
aggregation map-side, so a hot account or day never ships its raw rows to
one task).  Account-partitioned windows run on the aggregated rows, whose
count per account is bounded by days (or months) x categories.  The two
un-partitioned windows (7-row rolling KPI averages and period-over-period)
run over one row per day / per period, bounded by the calendar, not the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (
    cents_long,
    cents_to_money,
    count_when,
    div_round_half_away,
    pct_round,
    sum_cents_when,
    units_to_decimal,
)



class _Cols:
    """Column shorthands, resolved lazily (a Column needs an active session)."""

    amt = property(lambda self: F.col("amount_usd"))
    type = property(lambda self: F.col("transaction_type"))
    status = property(lambda self: F.col("status"))


_c = _Cols()


def _as_of(as_of) -> Column:
    return F.to_date(F.lit(str(as_of))) if as_of is not None else F.current_date()


# ---------------------------------------------------------------- AGG1 / AGG2
def daily_flows(fact: DataFrame) -> DataFrame:
    """AGG1+AGG2: per (account, date, category) flows, counts, net flow and debit ratio %."""
    return _flows_cents(fact).drop("_net_c")


def _flows_cents(fact: DataFrame) -> DataFrame:
    """daily_flows plus the net flow in bigint cents (``_net_c``).

    FLT4: FAILED and PENDING rows are excluded.  Sums run in exact bigint
    cents and are turned back into decimal(.,2) money at the end.
    """
    g = (
        fact.where(~_c.status.isin("FAILED", "PENDING"))
        .groupBy("account_id", "transaction_date", "category")
        .agg(
            sum_cents_when(_c.type == "CREDIT", _c.amt).alias("_cr"),
            sum_cents_when(_c.type == "DEBIT", _c.amt).alias("_db"),
            sum_cents_when(_c.type == "REFUND", _c.amt).alias("_rf"),
            sum_cents_when(_c.type == "TRANSFER", _c.amt).alias("_tr"),
            F.count(F.lit(1)).alias("transaction_count"),
            count_when(_c.status == "FLAGGED").alias("flagged_count"),
            count_when(_c.status == "REVERSED").alias("reversed_count"),
        )
    )
    net = F.col("_cr") - F.col("_db") + F.col("_rf")
    return g.select(
        "account_id",
        "transaction_date",
        "category",
        cents_to_money("_cr").alias("total_credits"),
        cents_to_money("_db").alias("total_debits"),
        cents_to_money("_rf").alias("total_refunds"),
        cents_to_money("_tr").alias("total_transfers"),
        "transaction_count",
        "flagged_count",
        "reversed_count",
        net.alias("_net_c"),
        cents_to_money(net).alias("net_flow_usd"),
        pct_round(F.col("_db"), F.col("_cr") + F.col("_db"), 2).alias("debit_ratio_pct"),
    )


PNL_COLUMNS = [
    "account_id",
    "transaction_date",
    "category",
    "total_credits",
    "total_debits",
    "total_refunds",
    "total_transfers",
    "net_flow_usd",
    "debit_ratio_pct",
    "transaction_count",
    "flagged_count",
    "reversed_count",
    "rolling_7d_net_flow",
    "pnl_status",
]


def pnl_status(net: Column) -> Column:
    """PRJ10: three-way sign label."""
    return F.when(net > 0, "NET_POSITIVE").when(net < 0, "NET_NEGATIVE").otherwise("BREAKEVEN")


# ---------------------------------------------------------------- REP1 (AGG3, WIN2, JOIN3)
def daily_pnl(fact: DataFrame) -> DataFrame:
    """REP1, faithful: rolling sum over the 7 previous *rows* of distinct
    (account, date, net_flow) values, joined back on (account, date) — so a
    day with k categories fans out (K10).  Rows within a day are ordered by
    net flow, which makes the frame deterministic.

    Plan: one aggregate (partial, shuffle 1), then the aggregated rows are
    hash-partitioned by account once (shuffle 2) and everything else is
    windows inside those partitions — no second scan and no join:
    one representative row per distinct (account, date, net); a running
    count of representatives gives each its index; a RANGE frame of 7 on that
    index (non-representatives contribute 0) is the rolling sum; each row
    then takes the list of its day's rolling values (at most one per
    category) and explodes it, which is the join's fan-out.
    """
    flows = _flows_cents(fact).repartition("account_id")
    acct = Window.partitionBy("account_id")
    order = [F.col("transaction_date").asc(), F.col("_net_c").asc_nulls_first(), F.col("category").asc_nulls_first()]
    is_rep = F.row_number().over(
        Window.partitionBy("account_id", "transaction_date", "_net_c").orderBy(F.col("category").asc_nulls_first())
    ) == 1
    f = flows.withColumn("_rep", is_rep)
    f = f.withColumn(
        "_ri", F.sum(F.col("_rep").cast("long")).over(acct.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    )
    roll = F.sum(F.when(F.col("_rep"), F.col("_net_c")).otherwise(F.lit(0).cast("bigint"))).over(
        acct.orderBy("_ri").rangeBetween(-6, 0)
    )
    # a NULL net still forms its own distinct row; a NULL in its frame makes no difference to SUM
    f = f.withColumn("_roll", F.when(F.col("_rep"), F.struct(roll.alias("v"))))
    day = Window.partitionBy("account_id", "transaction_date")
    f = f.withColumn("_rolls", F.collect_list("_roll").over(day))
    return (
        f.select("*", F.explode("_rolls").alias("_r"))
        .withColumn("rolling_7d_net_flow", cents_to_money(F.col("_r.v")))
        .withColumn("pnl_status", pnl_status(F.col("_net_c")))
        .select(*PNL_COLUMNS)
    )


def daily_pnl_calendar7(fact: DataFrame) -> DataFrame:
    """REP1 variant without fan-out: net flow per account-day and its sum over
    the trailing 7 calendar days (RANGE frame on the day number)."""
    d = (
        fact.where(~_c.status.isin("FAILED", "PENDING"))
        .groupBy("account_id", "transaction_date")
        .agg(
            sum_cents_when(_c.type == "CREDIT", _c.amt).alias("_c"),
            sum_cents_when(_c.type == "DEBIT", _c.amt).alias("_d"),
            sum_cents_when(_c.type == "REFUND", _c.amt).alias("_r"),
            F.count(F.lit(1)).alias("transaction_count"),
        )
        .select(
            "account_id",
            "transaction_date",
            "transaction_count",
            (F.col("_c") - F.col("_d") + F.col("_r")).alias("_net"),
            F.unix_date("transaction_date").alias("_day"),
        )
    )
    w = Window.partitionBy("account_id").orderBy("_day").rangeBetween(-6, 0)
    return d.select(
        "account_id",
        "transaction_date",
        cents_to_money("_net").alias("net_flow_usd"),
        "transaction_count",
        cents_to_money(F.sum("_net").over(w)).alias("rolling_7d_net_flow"),
        pnl_status(F.col("_net")).alias("pnl_status"),
    )


# ---------------------------------------------------------------- REP2 (AGG4/5, WIN3/4, SRT1)
def _account_months(fact: DataFrame, fact_unique: bool) -> DataFrame:
    """One row per (account, month) of settled flows, in cents.

    With ``fact_unique`` (a fact that the load job wrote has one row per
    transaction) ids are counted, and the merchants by a first aggregation per
    merchant, so that no row is expanded; otherwise both are distinct counts.
    """
    keys = ["account_id", "report_month"]
    rows = fact.where(_c.status == "SETTLED").withColumn("report_month", F.trunc("transaction_date", "MM"))
    flows = {
        "_inc": sum_cents_when(_c.type == "CREDIT", _c.amt),
        "_exp": sum_cents_when(_c.type == "DEBIT", _c.amt),
        "_tin": sum_cents_when((_c.type == "TRANSFER") & (_c.amt > 0), _c.amt),
        "_tout": sum_cents_when((_c.type == "TRANSFER") & (_c.amt < 0), F.abs(_c.amt)),
        "_ref": sum_cents_when(_c.type == "REFUND", _c.amt),
        "_sum_amt": F.sum(cents_long(_c.amt)),
        "_n_amt": F.count(_c.amt),
    }
    sums = [c.alias(name) for name, c in flows.items()]
    top = "largest_single_transaction"
    if not fact_unique:
        ids = F.count_distinct("transaction_id").alias("total_transactions")
        merchants = F.count_distinct("merchant_id").alias("unique_merchants")
        return rows.groupBy(*keys).agg(*sums, F.max(_c.amt).alias(top), ids, merchants)
    ids = F.count("transaction_id").alias("total_transactions")
    per_merchant = rows.groupBy(*keys, "merchant_id").agg(*sums, F.max(_c.amt).alias(top), ids)
    return per_merchant.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in (*flows, "total_transactions")],
        F.max(top).alias(top),
        F.count("merchant_id").alias("unique_merchants"),
    )


def monthly_balance_sheet(fact: DataFrame, ordered: bool = True, fact_unique: bool = False) -> DataFrame:
    """REP2: settled flows per (account, month), net position, month-over-month %."""
    m = _account_months(fact, fact_unique)
    net = (F.col("_inc") + F.col("_tin") + F.col("_ref")) - (F.col("_exp") + F.col("_tout"))
    w = Window.partitionBy("account_id").orderBy("report_month")
    m = m.select("*", net.alias("_net")).select(
        "*", F.lag("_net").over(w).alias("_pnet"), F.lag("_exp").over(w).alias("_pexp")
    )
    base_n = F.coalesce(F.col("_pnet"), F.col("_net"))
    base_e = F.coalesce(F.col("_pexp"), F.col("_exp"))
    out = m.select(
        "account_id",
        "report_month",
        cents_to_money("_inc").alias("gross_income"),
        cents_to_money("_exp").alias("gross_expenses"),
        cents_to_money("_tin").alias("transfers_in"),
        cents_to_money("_tout").alias("transfers_out"),
        cents_to_money("_ref").alias("refunds_received"),
        cents_to_money("_net").alias("net_position"),
        cents_to_money(F.col("_inc") - F.col("_exp")).alias("operating_net"),
        "total_transactions",
        "unique_merchants",
        "largest_single_transaction",
        units_to_decimal(div_round_half_away(F.col("_sum_amt"), F.col("_n_amt")), 2).alias("avg_transaction_amount"),
        pct_round(F.col("_net") - base_n, F.abs(base_n), 2).alias("mom_net_position_change_pct"),
        pct_round(F.col("_exp") - base_e, base_e, 2).alias("mom_expense_change_pct"),
        cents_to_money("_pnet").alias("prev_month_net_position"),
        cents_to_money("_pexp").alias("prev_month_expenses"),
    )
    if ordered:
        out = out.orderBy(F.col("account_id").asc(), F.col("report_month").desc())
    return out


BALANCE_SHEET_COLUMNS = [
    "account_id",
    "report_month",
    "gross_income",
    "gross_expenses",
    "transfers_in",
    "transfers_out",
    "refunds_received",
    "net_position",
    "operating_net",
    "total_transactions",
    "unique_merchants",
    "largest_single_transaction",
    "avg_transaction_amount",
    "mom_net_position_change_pct",
    "mom_expense_change_pct",
]


def balance_sheet_view(fact: DataFrame, fact_unique: bool = False) -> DataFrame:
    """REP2 with exactly the view's 15 columns."""
    return monthly_balance_sheet(fact, fact_unique=fact_unique).select(*BALANCE_SHEET_COLUMNS)


def mom_change(fact: DataFrame) -> DataFrame:
    """WIN3/WIN4 detail: current vs previous present month."""
    return monthly_balance_sheet(fact, ordered=False).select(
        "account_id",
        "report_month",
        "net_position",
        "prev_month_net_position",
        "mom_net_position_change_pct",
        "gross_expenses",
        "prev_month_expenses",
        "mom_expense_change_pct",
    )


# ---------------------------------------------------------------- REP3 (AGG6/7, WIN5/6, JOIN4, SRT2)
def _fraud_rate_units(flagged: Column, total: Column) -> Column:
    """fraud rate % in thousandths of a percent (3 dp), exact."""
    return div_round_half_away(flagged.cast("decimal(38,0)") * F.lit(100000), total)


def _trailing(fact: DataFrame, as_of, lookback_days: int) -> DataFrame:
    return fact.where(F.col("transaction_date") >= F.date_sub(_as_of(as_of), lookback_days))


def _day_category(base: DataFrame) -> DataFrame:
    """The one scan of REP3: per (date, category) partial measures.  Per-day
    KPIs and the top category are both derived from this small aggregate; the
    distinct-currency count travels as a per-group currency set (bounded by the
    number of currencies)."""
    return base.groupBy("transaction_date", "category").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(cents_long(_c.amt)).alias("_vol_c"),
        F.count(_c.amt).alias("_n_amt"),
        F.max(_c.amt).alias("_max"),
        count_when(_c.status == "FLAGGED").alias("_fl"),
        count_when(_c.status == "REVERSED").alias("_rv"),
        count_when(F.col("is_international")).alias("_in"),
        count_when(F.col("is_high_value")).alias("_hv"),
        F.collect_set("currency").alias("_cur"),
    )


def _kpis_from(dc: DataFrame) -> DataFrame:
    """Per-day KPI aggregates; money kept in cents (``_vol_c``) and the fraud rate in
    thousandths of a percent (``_fraud_q``) for exact downstream rounding."""
    k = dc.groupBy("transaction_date").agg(
        F.sum("_n").alias("total_count"),
        F.sum("_vol_c").alias("_vol_c"),
        F.sum("_n_amt").alias("_n_amt"),
        F.max("_max").alias("max_amount_usd"),
        F.sum("_fl").alias("flagged_count"),
        F.sum("_rv").alias("reversed_count"),
        F.sum("_in").alias("international_count"),
        F.sum("_hv").alias("high_value_count"),
        F.size(F.array_distinct(F.flatten(F.collect_list("_cur")))).cast("long").alias("currency_count"),
    )
    q = _fraud_rate_units(F.col("flagged_count"), F.col("total_count"))
    return k.select(
        "transaction_date",
        "total_count",
        cents_to_money("_vol_c").alias("total_volume_usd"),
        units_to_decimal(div_round_half_away(F.col("_vol_c"), F.col("_n_amt")), 2).alias("avg_amount_usd"),
        "max_amount_usd",
        "flagged_count",
        "reversed_count",
        "international_count",
        "high_value_count",
        "currency_count",
        (q.cast("double") / F.lit(1000.0)).alias("fraud_rate_pct"),
        "_vol_c",
        q.alias("_fraud_q"),
    )


def _kpis(base: DataFrame) -> DataFrame:
    return _kpis_from(_day_category(base))


def daily_kpis(fact: DataFrame, as_of=None, lookback_days: int = 90) -> DataFrame:
    """AGG6: per-day KPIs over the trailing window (FLT6)."""
    return _kpis(_trailing(fact, as_of, lookback_days)).drop("_vol_c")


def _top(base: DataFrame, tie_break: bool) -> DataFrame:
    return _top_from(_day_category(base), tie_break)


def _top_from(dc: DataFrame, tie_break: bool) -> DataFrame:
    if tie_break:
        w = Window.partitionBy("transaction_date").orderBy(F.col("_vol_c").desc_nulls_last(), F.col("category").asc_nulls_last())
        rk = F.row_number().over(w)
    else:
        rk = F.rank().over(Window.partitionBy("transaction_date").orderBy(F.col("_vol_c").desc_nulls_last()))
    return (
        dc.select("transaction_date", "category", "_vol_c", rk.alias("_rnk"))
        .where(F.col("_rnk") == 1)
        .select(
            "transaction_date", F.col("category").alias("top_category"), cents_to_money("_vol_c").alias("top_category_volume")
        )
    )


def top_category(fact: DataFrame, as_of=None, lookback_days: int = 90, tie_break: bool = False) -> DataFrame:
    """AGG7+WIN5+SRT3: the highest-volume category per day (RANK, so ties repeat a day).

    ``tie_break=True`` keeps one row per day (volume desc, then category).
    """
    return _top(_trailing(fact, as_of, lookback_days), tie_break)


SUMMARY_COLUMNS = [
    "transaction_date",
    "total_count",
    "total_volume_usd",
    "avg_amount_usd",
    "max_amount_usd",
    "flagged_count",
    "reversed_count",
    "international_count",
    "high_value_count",
    "currency_count",
    "fraud_rate_pct",
    "top_category",
    "top_category_volume",
    "rolling_7d_avg_volume",
    "rolling_7d_fraud_rate",
]


def transaction_summary(
    fact: DataFrame, as_of=None, lookback_days: int = 90, tie_break: bool = False, ordered: bool = True
) -> DataFrame:
    """REP3: daily KPIs + top category + 7-row rolling averages, newest first."""
    # Single chain: (date, category) aggregate -> windows over each date give
    # the day's KPIs on every category row and the category rank; keeping the
    # rank-1 rows is the KPI x top-category join (rank ties fan out the same way).
    dc = _day_category(_trailing(fact, as_of, lookback_days))
    day = Window.partitionBy("transaction_date")
    if tie_break:
        rk = F.row_number().over(day.orderBy(F.col("_vol_c").desc_nulls_last(), F.col("category").asc_nulls_last()))
    else:
        rk = F.rank().over(day.orderBy(F.col("_vol_c").desc_nulls_last()))
    per_day = dc.select(
        "transaction_date",
        F.col("category").alias("top_category"),
        cents_to_money("_vol_c").alias("top_category_volume"),
        rk.alias("_rnk"),
        F.sum("_n").over(day).alias("total_count"),
        F.sum("_vol_c").over(day).alias("_day_vol_c"),
        F.sum("_n_amt").over(day).alias("_n_amt"),
        F.max("_max").over(day).alias("max_amount_usd"),
        F.sum("_fl").over(day).alias("flagged_count"),
        F.sum("_rv").over(day).alias("reversed_count"),
        F.sum("_in").over(day).alias("international_count"),
        F.sum("_hv").over(day).alias("high_value_count"),
        F.size(F.array_distinct(F.flatten(F.collect_list("_cur").over(day)))).cast("long").alias("currency_count"),
    ).where(F.col("_rnk") == 1)
    q = _fraud_rate_units(F.col("flagged_count"), F.col("total_count"))
    j = per_day.select(
        "*",
        cents_to_money("_day_vol_c").alias("total_volume_usd"),
        units_to_decimal(div_round_half_away(F.col("_day_vol_c"), F.col("_n_amt")), 2).alias("avg_amount_usd"),
        (q.cast("double") / F.lit(1000.0)).alias("fraud_rate_pct"),
        F.col("_day_vol_c").alias("_vol_c"),
        q.alias("_fraud_q"),
    )
    # One row per day (plus rank ties): a single ordered partition is bounded by the calendar.
    w = Window.orderBy(F.col("transaction_date").asc(), F.col("top_category").asc_nulls_first()).rowsBetween(-6, 0)
    roll_vol = units_to_decimal(div_round_half_away(F.sum("_vol_c").over(w), F.count("_vol_c").over(w)), 2)
    roll_fr = div_round_half_away(F.sum("_fraud_q").over(w), F.count("_fraud_q").over(w)).cast("double") / F.lit(1000.0)
    out = j.select(
        *SUMMARY_COLUMNS[:-2],
        roll_vol.alias("rolling_7d_avg_volume"),
        roll_fr.alias("rolling_7d_fraud_rate"),
    )
    if ordered:
        out = out.orderBy(F.col("transaction_date").desc())
    return out


# ---------------------------------------------------------------- REP4 (AGG8)
def executive_summary(fact: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """REP4: single-row summary of the trailing ``days`` (FAILED excluded)."""
    f = _trailing(fact, as_of, days).where(_c.status != "FAILED")
    g = f.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(cents_long(_c.amt)).alias("_vol_c"),
        F.count(_c.amt).alias("_n_amt"),
        count_when(_c.status == "FLAGGED").alias("total_flagged"),
        count_when(_c.status == "REVERSED").alias("total_reversed"),
        count_when(F.col("is_international")).alias("international_transactions"),
        F.count_distinct("account_id").alias("active_accounts"),
    )
    return g.select(
        "total_transactions",
        cents_to_money("_vol_c").alias("total_volume_usd"),
        units_to_decimal(div_round_half_away(F.col("_vol_c"), F.col("_n_amt")), 2).alias("avg_transaction_usd"),
        "total_flagged",
        "total_reversed",
        (_fraud_rate_units(F.col("total_flagged"), F.col("total_transactions")).cast("double") / F.lit(1000.0)).alias(
            "fraud_rate_pct"
        ),
        "international_transactions",
        "active_accounts",
    )


# ---------------------------------------------------------------- WIN7 (KPI vs previous period)
def kpi_vs_previous_period(fact: DataFrame, as_of=None, period_days: int = 30) -> DataFrame:
    """WIN7: KPIs per ``period_days`` bucket counted back from ``as_of``
    (period 0 ends on as_of), each compared with the period before it."""
    asof = _as_of(as_of)
    p = F.floor(F.datediff(asof, F.col("transaction_date")) / F.lit(period_days)).cast("int")
    g = fact.groupBy(p.alias("period_index")).agg(
        F.count(F.lit(1)).alias("total_count"),
        F.sum(cents_long(_c.amt)).alias("_vol_c"),
        count_when(_c.status == "FLAGGED").alias("flagged_count"),
    )
    # One row per period: a single ordered partition is bounded by the time span.
    w = Window.orderBy(F.col("period_index").desc())
    q = _fraud_rate_units(F.col("flagged_count"), F.col("total_count"))
    g = g.select("*", q.alias("_q")).select(
        "*",
        F.lag("total_count").over(w).alias("prev_total_count"),
        F.lag("_vol_c").over(w).alias("_pvol"),
        F.lag("_q").over(w).alias("_pq"),
    )
    return g.select(
        "period_index",
        F.date_sub(asof, F.col("period_index") * period_days + (period_days - 1)).alias("period_start"),
        F.date_sub(asof, F.col("period_index") * period_days).alias("period_end"),
        "total_count",
        cents_to_money("_vol_c").alias("total_volume_usd"),
        (F.col("_q").cast("double") / F.lit(1000.0)).alias("fraud_rate_pct"),
        "prev_total_count",
        cents_to_money("_pvol").alias("prev_total_volume_usd"),
        (F.col("_pq").cast("double") / F.lit(1000.0)).alias("prev_fraud_rate_pct"),
        pct_round(F.col("_vol_c") - F.col("_pvol"), F.col("_pvol"), 2).alias("volume_change_pct"),
        pct_round(F.col("total_count") - F.col("prev_total_count"), F.col("prev_total_count"), 2).alias(
            "count_change_pct"
        ),
    )


# ---------------------------------------------------------------- REP5 / REP6 (dashboard datasets)
def net_flow_by_category(pnl: DataFrame) -> DataFrame:
    """AGG12: net flow by category x pnl_status over the daily P&L view rows."""
    return pnl.groupBy("category", "pnl_status").agg(
        F.sum("net_flow_usd").alias("net_flow_usd"), F.count(F.lit(1)).alias("row_count")
    )


def pnl_detail(pnl: DataFrame) -> DataFrame:
    """REP5: P&L detail table projection."""
    return pnl.select(
        "transaction_date", "category", "total_credits", "total_debits", "net_flow_usd", "rolling_7d_net_flow"
    )


def alerts_by_action(alerts: DataFrame) -> DataFrame:
    """AGG13: alert count by action."""
    return alerts.groupBy("action").agg(F.count(F.lit(1)).alias("alert_count"))
