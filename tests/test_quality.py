"""Data-quality expectations (one aggregate job per suite)."""

from ledgerline.config import load_suite
from ledgerline.operators import quality

SUITE4 = {
    "expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "transaction_id"}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "transaction_id"}},
        {
            "expectation_type": "expect_column_values_to_be_in_set",
            "kwargs": {"column": "status", "value_set": ["PENDING", "SETTLED", "FLAGGED", "REVERSED", "FAILED"]},
        },
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "amount", "min_value": 0}},
    ]
}


def results(spark, data, schema, suite):
    df = spark.createDataFrame(data, schema)
    return {r.idx: r for r in quality.validate(df, suite).collect()}


SCHEMA = "transaction_id string, status string, amount double"


def test_valid_frame_passes(spark):
    r = results(spark, [("a", "SETTLED", 10.0), ("b", "PENDING", 5.0)], SCHEMA, SUITE4)
    assert all(x.success for x in r.values())
    s = quality.summarize(quality.validate(spark.createDataFrame([("a", "SETTLED", 1.0)], SCHEMA), SUITE4)).first()
    assert (s.total, s.passed, s.failed, s.pass_rate, s.overall_success) == (4, 4, 0, 100.0, True)


def test_invalid_frame_fails_each_check(spark):
    data = [(None, "SETTLED", 1.0), ("a", "UNKNOWN", 1.0), ("a", "SETTLED", -5.0), ("b", "BOGUS", 2.0)]
    r = results(spark, data, SCHEMA, SUITE4)
    assert [r[i].success for i in range(4)] == [False, False, False, False]
    assert r[0].metric_value == 25.0  # null percent
    assert r[1].metric_value == 1.0  # one duplicate
    assert list(r[2].unexpected_values) == ["BOGUS", "UNKNOWN"]
    assert r[3].metric_value == 0.75
    s = quality.summarize(quality.validate(spark.createDataFrame(data, SCHEMA), SUITE4)).first()
    assert (s.passed, s.failed, s.pass_rate, s.overall_success) == (0, 4, 0.0, False)


def test_mostly_thresholds(spark):
    suite = {
        "expectations": [
            {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "v", "mostly": 0.7}},
            {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "v", "value_set": ["x"], "mostly": 0.7}},
            {"expectation_type": "expect_column_values_to_match_regex", "kwargs": {"column": "v", "regex": "x", "mostly": 0.8}},
        ]
    }
    data = [("x",), ("x",), ("x",), ("y",), (None,)]
    r = results(spark, data, "v string", suite)
    assert r[0].success is True and r[0].metric_value == 20.0  # 80% present >= 70%
    assert r[1].success is True and r[1].metric_value == 0.75  # NULLs ignored: 3/4
    assert r[2].success is False and r[2].metric_value == 0.75


def test_unique_treats_repeated_nulls_as_duplicates(spark):
    suite = {"expectations": [{"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "v"}}]}
    r = results(spark, [("a",), (None,), (None,)], "v string", suite)
    assert r[0].success is False and r[0].metric_value == 1.0
    r = results(spark, [("a",), (None,)], "v string", suite)
    assert r[0].success is True


def test_between_counts_null_and_non_numeric_as_failing(spark):
    suite = {
        "expectations": [
            {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "v", "min_value": 0, "max_value": 10}}
        ]
    }
    r = results(spark, [("1",), ("abc",), (None,), ("11",)], "v string", suite)
    assert r[0].success is False and r[0].metric_value == 0.25


def test_regex_is_anchored_at_start_only(spark):
    suite = {"expectations": [{"expectation_type": "expect_column_values_to_match_regex", "kwargs": {"column": "v", "regex": "ab"}}]}
    r = results(spark, [("abc",), ("xab",)], "v string", suite)
    assert r[0].metric_value == 0.5


def test_missing_column_unknown_type_and_row_count(spark):
    suite = {
        "expectations": [
            {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "nope"}},
            {"expectation_type": "expect_something_new", "kwargs": {}},
            {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1, "max_value": 2}},
            {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "v"}},
            {"expectation_type": "expect_column_proportion_of_unique_values_to_be_between", "kwargs": {"column": "v", "min_value": 0.5}},
        ]
    }
    r = results(spark, [("a",), ("a",), ("b",)], "v string", suite)
    assert r[0].success is False and r[0].error == "column 'nope' missing"
    assert r[1].success is True and r[1].skipped is True
    assert r[2].success is False and r[2].metric_value == 3.0
    assert r[3].success is True
    assert r[4].success is True and r[4].metric_value == 0.666667


def test_empty_frame_fails_share_checks(spark):
    r = results(spark, [], SCHEMA, SUITE4)
    assert r[0].success is False  # NaN share in the pandas reference
    assert r[1].success is True
    assert r[3].success is False


def test_grouped_validation_and_shipped_suite(spark):
    suite = load_suite()
    assert len(suite["expectations"]) == 18
    df = spark.createDataFrame([("d1", "a", "SETTLED", 1.0), ("d2", "b", "BOGUS", 1.0)], "day string, transaction_id string, status string, amount double")
    out = quality.validate(df, SUITE4, by=["day"])
    got = {(r.day, r.idx): r.success for r in out.collect()}
    assert got[("d1", 2)] is True and got[("d2", 2)] is False
    summ = {r.day: r.failed for r in quality.summarize(out, by=["day"]).collect()}
    assert summ == {"d1": 0, "d2": 1}


def test_metrics_rows(spark):
    s = quality.summarize(quality.validate(spark.createDataFrame([("a", "SETTLED", 1.0)], SCHEMA), SUITE4))
    m = {r.metric: r.value for r in quality.metrics_rows(s, "ds").collect()}
    assert m == {"PassedChecks": 4.0, "FailedChecks": 0.0, "PassRatePct": 100.0}


def test_bad_values_of_many_sets_come_from_one_pass(spark, tmp_dir):
    spark.createDataFrame([("a", "X", 1.0), ("b", "Y", 2.0), (None, "X", 3.0)], SCHEMA).write.parquet(f"{tmp_dir}/t")
    in_set = "expect_column_values_to_be_in_set"
    suite = {"expectations": [
        {"expectation_type": in_set, "kwargs": {"column": c, "value_set": v}}
        for c, v in (("transaction_id", ["a"]), ("status", ["Y"]), ("amount", [1, 2, 3]))
    ]}
    out = quality.validate(spark.read.parquet(f"{tmp_dir}/t"), suite)
    assert {r.idx: r.unexpected_values for r in out.collect()} == {0: ["b"], 1: ["X"], 2: []}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
