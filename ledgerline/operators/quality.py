"""Data-quality expectations as one Spark aggregate job (DQ1-DQ13).

``validate(df, suite)`` plans every expectation of a suite into aggregate
expressions, evaluates them in a single ``agg`` (or ``groupBy(by).agg`` for
per-partition validation), and turns the one metrics row into one result row
per expectation with ``explode`` — the driver never sees the data.

Unexpected-value samples for in-set checks (at most five per check, sorted)
come from a bounded side plan: distinct bad values -> rank <= 5 per check
(Catalyst pushes the group limit below the shuffle) -> joined to the results.

Semantics follow the pandas reference behaviour: NULL (and NaN) are missing;
in-set and regex shares ignore missing values; between counts missing and
non-numeric values as failing; uniqueness treats repeated NULLs as
duplicates; shares over zero rows are undefined and fail.  Reported shares are
rounded half-to-even on the exact ratio.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from typing import Any, Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import div_round_half_even
from ..session import shared_table

log = logging.getLogger(__name__)

RESULT_TYPE = T.StructType(
    [
        T.StructField("idx", T.IntegerType(), False),
        T.StructField("expectation", T.StringType(), False),
        T.StructField("column", T.StringType(), True),
        T.StructField("success", T.BooleanType(), True),
        T.StructField("metric_name", T.StringType(), True),
        T.StructField("metric_value", T.DoubleType(), True),
        T.StructField("skipped", T.BooleanType(), False),
        T.StructField("error", T.StringType(), True),
    ]
)

KNOWN = {
    "expect_table_row_count_to_be_between",
    "expect_column_to_exist",
    "expect_column_values_to_not_be_null",
    "expect_column_values_to_be_unique",
    "expect_column_values_to_be_in_set",
    "expect_column_values_to_be_between",
    "expect_column_values_to_match_regex",
    "expect_column_proportion_of_unique_values_to_be_between",
}


@dataclass
class _Planned:
    aggs: list[Column]
    result: Column  # struct of RESULT_TYPE, over the metrics row
    sample: Column | None = None  # struct (idx, v) of a bad value of an in-set check, else null
    distinct: str | None = None  # column whose distinct values the result needs, as ``_d_<column>``


def _is_missing(types: dict, c: str) -> Column:
    dt = types[c]
    m = F.col(c).isNull()
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        m = m | F.isnan(F.col(c))
    return m


def _res(idx, exp, col, success, metric_name=None, metric_value=None, skipped=False, error=None) -> Column:
    return F.struct(
        F.lit(idx).cast("int").alias("idx"),
        F.lit(exp).alias("expectation"),
        F.lit(col).cast("string").alias("column"),
        (success if isinstance(success, Column) else F.lit(success)).cast("boolean").alias("success"),
        F.lit(metric_name).cast("string").alias("metric_name"),
        (metric_value if isinstance(metric_value, Column) else F.lit(metric_value)).cast("double").alias("metric_value"),
        F.lit(skipped).alias("skipped"),
        F.lit(error).cast("string").alias("error"),
    )


def _share(num: Column, den: Column) -> Column:
    """num/den as double; NULL when den = 0 (pandas NaN)."""
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def _ge(share: Column, mostly: float) -> Column:
    return F.coalesce(share >= F.lit(float(mostly)), F.lit(False))


def _rounded(num: Column, den: Column, dp: int) -> Column:
    return div_round_half_even(num, den).cast("double") / F.lit(float(10**dp))


def _plan_one(df: DataFrame, types: dict, idx: int, exp: str, kw: dict[str, Any], by: Sequence[str]) -> _Planned:
    col = kw.get("column")
    p = f"_m{idx}_"
    n = F.col("_n")

    if exp == "expect_table_row_count_to_be_between":
        lo = kw.get("min_value", 0)
        hi = kw.get("max_value")
        ok = n >= F.lit(lo)
        if hi is not None:
            ok = ok & (n <= F.lit(hi))
        return _Planned([], _res(idx, exp, col, ok, "observed_value", n))
    if exp == "expect_column_to_exist":
        return _Planned([], _res(idx, exp, col, col in types))
    if exp not in KNOWN:
        return _Planned([], _res(idx, exp, col, True, skipped=True))
    if col is None or col not in types:
        return _Planned([], _res(idx, exp, col, False, error=f"column '{col}' missing"))

    c = F.col(col)
    mostly = float(kw.get("mostly", 1.0))
    if exp == "expect_column_values_to_not_be_null":
        aggs = [F.count_if(_is_missing(types, col)).alias(p + "null")]
        nulls = F.col(p + "null")
        ok = _ge(F.lit(1.0) - _share(nulls, n), mostly)
        return _Planned(aggs, _res(idx, exp, col, ok, "null_percent", _rounded(nulls * 10000, n, 2)))
    if exp == "expect_column_values_to_be_unique":
        aggs = [F.coalesce(F.max(F.when(_is_missing(types, col), F.lit(1)).otherwise(F.lit(0))), F.lit(0)).alias(p + "hn")]
        dup = n - F.col(f"`_d_{col}`") - F.col(p + "hn")
        return _Planned(aggs, _res(idx, exp, col, dup == 0, "duplicate_count", dup), distinct=col)
    if exp == "expect_column_values_to_be_in_set":
        vals = list(kw.get("value_set", []))
        present = ~_is_missing(types, col)
        # a value that the column's type cannot hold is no member, not a failed cast
        member = c.isin(*[F.lit(v).try_cast(types[col]) for v in vals]) if vals else F.lit(False)
        bad = present & ~F.coalesce(member, F.lit(False))
        aggs = [F.count_if(present).alias(p + "nn"), F.count_if(present & F.coalesce(member, F.lit(False))).alias(p + "in")]
        share = _share(F.col(p + "in"), F.col(p + "nn"))
        sample = F.when(bad, F.struct(F.lit(idx).cast("int").alias("idx"), c.cast("string").alias("v")))
        return _Planned(aggs, _res(idx, exp, col, _ge(share, mostly), "valid_share", share), sample)
    if exp == "expect_column_values_to_be_between":
        num = c.try_cast("double") if not isinstance(types[col], T.NumericType) else c.cast("double")
        ok = F.lit(True)
        if kw.get("min_value") is not None:
            ok = ok & (num >= F.lit(float(kw["min_value"])))
        if kw.get("max_value") is not None:
            ok = ok & (num <= F.lit(float(kw["max_value"])))
        ok = F.coalesce(ok & num.isNotNull() & ~F.isnan(num), F.lit(False))
        aggs = [F.count_if(ok).alias(p + "ok")]
        share = _share(F.col(p + "ok"), n)
        return _Planned(aggs, _res(idx, exp, col, _ge(share, mostly), "pass_rate", _rounded(F.col(p + "ok") * 10000, n, 4)))
    if exp == "expect_column_values_to_match_regex":
        pattern = kw.get("regex", "")
        try:
            df.sparkSession._jvm.java.util.regex.Pattern.compile(f"^(?:{pattern})")
        except Py4JError:
            raise ValueError(f"invalid regex '{pattern}'") from None
        present = ~_is_missing(types, col)
        m = F.coalesce(c.cast("string").rlike(f"^(?:{pattern})"), F.lit(False))
        aggs = [F.count_if(present).alias(p + "nn"), F.count_if(present & m).alias(p + "mt")]
        nn, mt = F.col(p + "nn"), F.col(p + "mt")
        return _Planned(aggs, _res(idx, exp, col, _ge(_share(mt, nn), mostly), "pass_rate", _rounded(mt * 10000, nn, 4)))
    # expect_column_proportion_of_unique_values_to_be_between
    nd = F.col(f"`_d_{col}`")
    den = F.greatest(n, F.lit(1))
    prop = nd.cast("double") / den.cast("double")
    ok = (prop >= F.lit(float(kw.get("min_value", 0.0)))) & (prop <= F.lit(float(kw.get("max_value", 1.0))))
    return _Planned([], _res(idx, exp, col, ok, "observed_proportion", _rounded(nd * 1000000, den, 6)), distinct=col)


def _plan_safely(df: DataFrame, types: dict, idx: int, exp: str, kw: dict[str, Any], by: Sequence[str]) -> _Planned:
    """A check that cannot be planned (bad regex, bound or value) fails alone, with its error."""
    try:
        return _plan_one(df, types, idx, exp, kw, by)
    except (TypeError, ValueError, PySparkException) as e:
        return _Planned([], _res(idx, exp, kw.get("column"), False, error=str(e).split("\n")[0]))


def _with_distinct(df: DataFrame, by: list[str], metrics: DataFrame, columns: list[str]) -> DataFrame:
    """``metrics`` with the number of distinct values of each column.

    Each column is counted by itself, by value and then over the values: several
    distinct counts in one aggregate would copy every row for each of them.
    """
    for c in columns:
        # of the metrics row and the count's row, each column has a value in one
        name = f"_d_{c}"
        both = metrics.unionByName(df.groupBy(*by).agg(F.count_distinct(F.col(f"`{c}`")).alias(name)), allowMissingColumns=True)
        metrics = both.groupBy(*by).agg(*(F.max(F.col(f"`{m}`")).alias(m) for m in both.columns if m not in by))
    return metrics


def validate(df: DataFrame, suite: dict[str, Any], by: Sequence[str] = (), sample_size: int = 5) -> DataFrame:
    """DQ10: one result row per expectation (per ``by`` group), in one aggregate job.

    Columns: *by, idx, expectation, column, success, metric_name,
    metric_value, skipped, error, unexpected_values (array<string>).
    """
    by = list(by)
    types = {f.name: f.dataType for f in df.schema.fields}  # one schema round-trip
    plans = [
        _plan_safely(df, types, i, e.get("expectation_type", ""), e.get("kwargs", {}) or {}, by)
        for i, e in enumerate(suite.get("expectations", []))
    ]
    if not plans:  # DQ11: no rows, of the full schema
        none = _plan_one(df, types, 0, "expect_table_row_count_to_be_between", {}, by)
        n = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")) if by else df.agg(F.count(F.lit(1)).alias("_n"))
        empty = n.select(*by, none.result.alias("r")).select(*by, "r.*")
        return empty.withColumn("unexpected_values", F.lit(None).cast("array<string>")).where("false")
    aggs = [F.count(F.lit(1)).alias("_n")] + [a for pl in plans for a in pl.aggs]
    metrics = _with_distinct(df, by, df.groupBy(*by).agg(*aggs), sorted({pl.distinct for pl in plans if pl.distinct}))
    rows = metrics.select(*by, F.explode(F.array(*[pl.result for pl in plans])).alias("r")).select(*by, "r.*")
    samples = [pl.sample for pl in plans if pl.sample is not None]
    if samples:
        # one pass over the input for all in-set checks
        bad = F.explode(F.filter(F.array(*samples), lambda x: x.isNotNull()))
        s = df.select(*by, bad.alias("b")).select("b.idx", *by, "b.v").distinct()
        w = Window.partitionBy("idx", *by).orderBy("v")
        s = (
            s.withColumn("_rk", F.row_number().over(w))
            .where(F.col("_rk") <= sample_size)
            .groupBy("idx", *by)
            .agg(F.sort_array(F.collect_list("v")).alias("unexpected_values"))
        )
        rows = rows.join(s, ["idx", *by], "left")
        rows = rows.withColumn(
            "unexpected_values",
            F.when(F.col("expectation") == "expect_column_values_to_be_in_set", F.coalesce("unexpected_values", F.array().cast("array<string>"))),
        )
    else:
        rows = rows.withColumn("unexpected_values", F.lit(None).cast("array<string>"))
    return rows


def validate_isolated(df: DataFrame, suite: dict[str, Any], by: Sequence[str] = (), sample_size: int = 5) -> DataFrame:
    """DQ10 with run-time isolation: the results as a table; a check that raises while it runs fails alone, with its error.

    All checks run in one job.  Only if that raises does each run by itself.  The
    row of a check that raised has no ``by`` values, as its groups are not known.
    """
    try:
        return shared_table(validate(df, suite, by, sample_size), "dq-results")
    except (PySparkException, Py4JError) as e:
        log.warning("validation failed as a whole, its checks run one by one: %s", str(e).split("\n")[0])
    schema = validate(df.limit(0), suite, by, sample_size).schema
    out = df.sparkSession.createDataFrame([], schema)
    for i, e in enumerate(suite.get("expectations", [])):
        try:
            one = validate(df, {**suite, "expectations": [e]}, by, sample_size).withColumn("idx", F.lit(i))
            out = out.unionByName(shared_table(one, f"dq-check-{i}"))
        except (PySparkException, Py4JError) as err:
            row = {"idx": i, "expectation": e.get("expectation_type", ""), "column": (e.get("kwargs") or {}).get("column"), "success": False}
            row |= {"skipped": False, "error": str(err).split("\n")[0][:500]}
            out = out.unionByName(df.sparkSession.createDataFrame([tuple(row.get(c) for c in schema.names)], T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])))
    return out


def summarize(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """DQ11: total, passed, failed, pass_rate (2 dp, 0 for an empty suite), overall_success."""
    by = list(by)
    ok = F.coalesce(F.col("success"), F.lit(False))
    aggs = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("passed"),
        F.count_if(~ok).alias("failed"),
    ]
    g = results.groupBy(*by).agg(*aggs) if by else results.agg(*aggs)
    return g.withColumn(
        "pass_rate", _rounded(F.col("passed") * 10000, F.greatest(F.col("total"), F.lit(1)), 2)
    ).withColumn("overall_success", F.col("failed") == 0)


def metrics_rows(summary: DataFrame, dataset: str, ts: Column | None = None) -> DataFrame:
    """SNK11: PassedChecks / FailedChecks / PassRatePct rows with a Dataset dimension."""
    ts = ts if ts is not None else F.current_timestamp()
    return summary.select(
        F.explode(
            F.array(
                F.struct(F.lit("PassedChecks").alias("metric"), F.col("passed").cast("double").alias("value"), F.lit("Count").alias("unit")),
                F.struct(F.lit("FailedChecks").alias("metric"), F.col("failed").cast("double").alias("value"), F.lit("Count").alias("unit")),
                F.struct(F.lit("PassRatePct").alias("metric"), F.col("pass_rate").alias("value"), F.lit("Percent").alias("unit")),
            )
        ).alias("m"),
        ts.alias("ts"),
    ).select("m.*", F.lit(dataset).alias("dataset"), "ts")
