"""Reporting views on small hand-checked ledgers."""

import datetime as dt
from decimal import Decimal

from ledgerline.operators import reports

D = Decimal
SCHEMA = (
    "transaction_id string, account_id string, transaction_date date, transaction_type string, amount_usd decimal(18,2), "
    "category string, merchant_id string, currency string, status string, is_international boolean, is_high_value boolean"
)


def L(i, acct, day, ttype, amt, cat="Retail", status="SETTLED", merchant="M1", currency="USD", intl=False):
    return (str(i), acct, dt.date(2024, 1, day), ttype, D(amt), cat, merchant, currency, status, intl, D(amt) > 10000)


def test_daily_flows_and_debit_ratio(spark):
    df = spark.createDataFrame(
        [
            L(1, "a", 1, "CREDIT", "100.00"),
            L(2, "a", 1, "DEBIT", "50.00"),
            L(3, "a", 1, "REFUND", "5.00", status="FLAGGED"),
            L(4, "a", 1, "TRANSFER", "7.00"),
            L(5, "a", 1, "DEBIT", "999.00", status="FAILED"),
        ],
        SCHEMA,
    )
    r = reports.daily_flows(df).first()
    assert (r.total_credits, r.total_debits, r.total_refunds, r.total_transfers) == (D("100.00"), D("50.00"), D("5.00"), D("7.00"))
    assert r.net_flow_usd == D("55.00") and r.transaction_count == 4 and r.flagged_count == 1
    assert r.debit_ratio_pct == 33.33


def test_daily_pnl_fans_out_and_rolls_seven_rows(spark):
    rows_ = [L(i, "a", i, "CREDIT", "10.00") for i in range(1, 10)]
    rows_ += [L(100, "a", 9, "CREDIT", "1.00", cat="Hotels")]  # two categories on day 9
    pnl = reports.daily_pnl(spark.createDataFrame(rows_, SCHEMA))
    day9 = pnl.where("transaction_date = '2024-01-09'").collect()
    assert len(day9) == 4  # 2 categories x 2 distinct net flows
    day8 = pnl.where("transaction_date = '2024-01-08'").first()
    assert day8.rolling_7d_net_flow == D("70.00") and day8.pnl_status == "NET_POSITIVE"
    cal = {r.transaction_date.day: r.rolling_7d_net_flow for r in reports.daily_pnl_calendar7(spark.createDataFrame(rows_, SCHEMA)).collect()}
    assert cal[9] == D("71.00") and cal[1] == D("10.00")


def test_balance_sheet_mom_change(spark):
    rows_ = [
        ("1", "a", dt.date(2024, 1, 5), "CREDIT", D("100.00"), None, "M1", "USD", "SETTLED", False, False),
        ("2", "a", dt.date(2024, 1, 6), "TRANSFER", D("-30.00"), None, "M2", "USD", "SETTLED", False, False),
        ("3", "a", dt.date(2024, 3, 1), "CREDIT", D("140.00"), None, "M1", "USD", "SETTLED", False, False),
        ("4", "a", dt.date(2024, 3, 2), "DEBIT", D("20.00"), None, None, "USD", "SETTLED", False, False),
        ("5", "a", dt.date(2024, 3, 3), "DEBIT", D("1.00"), None, None, "USD", "PENDING", False, False),
    ]
    bs = {r.report_month.month: r for r in reports.balance_sheet_view(spark.createDataFrame(rows_, SCHEMA)).collect()}
    jan, mar = bs[1], bs[3]
    assert jan.transfers_out == D("30.00") and jan.net_position == D("70.00")
    assert jan.mom_net_position_change_pct == 0.0 and jan.mom_expense_change_pct is None  # base 0 -> NULL
    assert mar.net_position == D("120.00") and mar.mom_net_position_change_pct == 71.43  # gaps ignored (K16)
    assert mar.unique_merchants == 1 and mar.total_transactions == 2
    assert jan.avg_transaction_amount == D("35.00")


def test_transaction_summary_ties_and_rolling(spark):
    rows_ = [
        L(1, "a", 29, "CREDIT", "10.00", cat="Retail", status="FLAGGED"),
        L(2, "a", 29, "CREDIT", "10.00", cat="Hotels"),
        L(3, "b", 30, "DEBIT", "30.00", cat="Retail", currency="EUR"),
    ]
    df = spark.createDataFrame(rows_, SCHEMA)
    out = reports.transaction_summary(df, "2024-01-30").collect()
    d29 = [r for r in out if r.transaction_date.day == 29]
    assert len(d29) == 2  # rank tie on top category repeats the day
    assert d29[0].fraud_rate_pct == 50.0 and d29[0].currency_count == 1
    assert len(reports.transaction_summary(df, "2024-01-30", tie_break=True).collect()) == 2
    d30 = [r for r in out if r.transaction_date.day == 30][0]
    assert d30.rolling_7d_avg_volume == D("23.33")  # (20 + 20 + 30) / 3 rows incl. the tie row
    assert out[0].transaction_date.day == 30  # newest first
    ex = reports.executive_summary(df, "2024-01-30", 30).first()
    assert (ex.total_transactions, ex.active_accounts, ex.total_flagged) == (3, 2, 1)


def test_kpi_vs_previous_period(spark):
    rows_ = [L(1, "a", 30, "CREDIT", "200.00"), L(2, "a", 1, "CREDIT", "100.00")]
    out = {r.period_index: r for r in reports.kpi_vs_previous_period(spark.createDataFrame(rows_, SCHEMA), "2024-01-30", 15).collect()}
    assert out[0].volume_change_pct == 100.0 and out[1].prev_total_count is None


def test_a_unique_fact_gives_the_same_balance_sheet_without_expanding_rows(spark):
    rows_ = [L(i, f"a{i % 3}", 1 + i % 20, t, "7.25", merchant=m) for i, (t, m) in enumerate(
        (t, m) for t in ("CREDIT", "DEBIT", "TRANSFER", "REFUND") for m in ("M1", "M2", None) for _ in range(3)
    )]
    df = spark.createDataFrame(rows_, SCHEMA)
    fast = reports.balance_sheet_view(df, fact_unique=True)
    assert fast.collect() == reports.balance_sheet_view(df).collect()
    assert "Expand" not in fast._jdf.queryExecution().executedPlan().toString()
