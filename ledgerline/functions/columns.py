"""Column-level helpers shared by the operators.

Exact rounding: averages and percentages are rounded half away from zero on
the exact rational value, computed with integer division in integer units
(cents, thousandths), so results never depend on floating-point formatting
and agree with any SQL engine that does the same integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def intdiv(a: Column, b: Column) -> Column:
    """Integral division (truncates toward zero), exact for integers."""
    return F.call_function("div", a, b)


def div_round_half_away(num: Column, den: Column) -> Column:
    """round(num / den) half away from zero for integers; NULL when den = 0."""
    # decimal(38,0) keeps the doubled numerator exact even for warehouse-scale sums.
    num = num.cast("decimal(38,0)")
    den = den.cast("decimal(38,0)")
    sgn = F.when((num < 0) != (den < 0), F.lit(-1)).otherwise(F.lit(1))
    q = intdiv(F.abs(num) * 2 + F.abs(den), F.abs(den) * 2)
    return F.when(den == 0, F.lit(None).cast("bigint")).otherwise(sgn * q)


def units_to_decimal(q: Column, dp: int, precision: int = 18) -> Column:
    """Integer 10^-dp units -> decimal(precision, dp)."""
    return (q.cast("decimal(20,0)") / F.lit(10**dp)).cast(f"decimal({precision},{dp})")


def pct_round(num: Column, den: Column, dp: int) -> Column:
    """ROUND(num / NULLIF(den, 0) * 100, dp), exact, for integer num/den, as double."""
    scaled = num.cast("decimal(38,0)") * F.lit(10 ** (dp + 2)).cast("decimal(38,0)")
    return div_round_half_away(scaled, den).cast("double") / F.lit(float(10**dp))


def count_when(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END) — NULL conditions count as false."""
    return F.count(F.when(cond, F.lit(1)))


def div_round_half_even(num: Column, den: Column) -> Column:
    """round(num / den) half to even for non-negative integers; NULL when den = 0."""
    num = num.cast("decimal(38,0)")
    den = den.cast("decimal(38,0)")
    q0 = intdiv(num, den)
    r2 = (num - q0 * den) * 2
    q = F.when(r2 > den, q0 + 1).when((r2 == den) & (F.pmod(q0, F.lit(2)) == 1), q0 + 1).otherwise(q0)
    return F.when(den == 0, F.lit(None).cast("bigint")).otherwise(q.cast("bigint"))


def cents_long(c: str | Column) -> Column:
    """Money -> bigint cents (fast fixed-width aggregation buffers), exact for decimal(.,2).

    Doubles and finer decimals round half up to the cent first, never truncate.
    bigint cents hold sums up to ~9.2e16 dollars; ANSI mode raises on
    overflow rather than wrapping.
    """
    return (col_(c).cast("decimal(18,2)") * F.lit(100)).cast("bigint")


def sum_cents_when(cond: Column, value: Column) -> Column:
    """SUM(CASE WHEN cond THEN money ELSE 0 END) in bigint cents (NULL money ignored)."""
    return F.sum(F.when(cond, cents_long(value)).otherwise(F.lit(0).cast("bigint")))


def cents_to_money(c: str | Column) -> Column:
    """bigint cents -> exact decimal(.,2)."""
    from decimal import Decimal

    return col_(c).cast("decimal(20,0)") * F.lit(Decimal("0.01"))
