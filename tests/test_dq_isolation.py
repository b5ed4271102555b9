"""DQ checks that raise while they run, and distinct counts without copied rows."""

from pyspark.sql import functions as F

from ledgerline.config import load_suite
from ledgerline.operators import quality


def check(kind, column=None, **kw):
    return {"expectation_type": kind, "kwargs": {"column": column, **kw} if column else kw}


def test_a_check_that_raises_at_run_time_fails_alone(spark):
    df = spark.range(10).selectExpr("id", "id % 3 as k")
    df = df.withColumn("bad", F.when(F.col("id") == 7, F.raise_error(F.lit("broken value")).cast("int")).otherwise(1))
    suite = {
        "expectations": [
            check("expect_column_values_to_be_unique", "id"),
            check("expect_column_values_to_be_in_set", "bad", value_set=[1]),
            check("expect_column_values_to_be_in_set", "k", value_set=[0, 1]),
            check("expect_column_values_to_be_finite", "bad"),
        ]
    }
    rows = {r.idx: r for r in quality.validate_isolated(df, suite).collect()}
    assert {i: r.success for i, r in rows.items()} == {0: True, 1: False, 2: False, 3: True}
    assert "broken value" in rows[1].error and rows[0].error is None and rows[3].skipped
    assert rows[2].unexpected_values == ["2"]
    good = quality.validate_isolated(df.drop("bad"), {"expectations": suite["expectations"][::2]})
    assert [r.success for r in good.orderBy("idx").collect()] == [True, False]
    assert quality.validate_isolated(df, {"expectations": []}).count() == 0


def test_distinct_counts_copy_no_rows(spark):
    df = spark.sql("select id % 7 as a, id % 5 as b, if(id % 2 = 0, null, id) as c, id % 2 as g from range(100)")
    suite = {"expectations": [check("expect_column_values_to_be_unique", x) for x in "abc"]}
    suite["expectations"] += [check("expect_column_proportion_of_unique_values_to_be_between", x, min_value=0.5) for x in "ac"]
    for by in ([], ["g"]):
        out = quality.validate(df, suite, by=by)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan
        got = {(r.g if by else None, r.idx): (r.metric_value, r.success) for r in out.collect()}
        for g in (0, 1) if by else (None,):
            rows = [r for r in df.collect() if g is None or r.g == g]
            for i, x in enumerate("abc"):
                values = [r[x] for r in rows]
                distinct = len({v for v in values if v is not None})
                duplicates = len(values) - distinct - (None in values)
                assert got[g, i] == (duplicates, duplicates == 0)
                if x in "ac":
                    share = got[g, 3 + "ac".index(x)][0]
                    assert abs(share - distinct / len(values)) < 1e-6


def test_the_shipped_suite_copies_no_rows(spark):
    from ledgerline.plans.catalog import silver_t

    plan = quality.validate(silver_t(spark, "/root/testdata/sf0.001"), load_suite())._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "NestedLoopJoin" not in plan
