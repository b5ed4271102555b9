"""Merges into a bucketed fact: results equal plain upserts, and only files with updated keys are rewritten."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import etl
from ledgerline.operators.fact_table import FactTable, key_filters, might_hold

SCHEMA = "transaction_id string, amount int, status string, category string, updated_at int"
UPDATED = ("amount", "status", "updated_at")


def frame(spark, ids, amount, at=1):
    return spark.createDataFrame([(i, amount, "S", f"c{amount}", at) for i in ids], SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(table, version):
    return {r.file: r.bucket for r in table.manifest(version).collect()}


def test_merges_equal_upserts_and_leave_other_files(spark, tmp_dir):
    table = FactTable(spark, f"{tmp_dir}/fact", buckets=8, sort_by=None)
    loads = [frame(spark, map(str, range(200)), 1), frame(spark, ["3", "77", "new"], 2, 2), frame(spark, ["3"], 3, 3)]
    want = loads[0]
    for k, staging in enumerate(loads):
        if k:
            want = etl.upsert(want, staging, update_columns=UPDATED, dedupe_staging=False)
        row = table.merge(staging, UPDATED)
        assert rows(table.read()) == rows(want)
    assert (row["staged"], row["updated"], row["inserted"], row["files_rewritten"]) == (1, 1, 0, 1)
    one, two, three = (files(table, v) for v in (1, 2, 3))
    assert len(one) == 8 and len(set(one) - set(two)) <= 2 and len(set(two) - set(three)) == 1
    assert rows(table.read(1)) == rows(loads[0])  # earlier versions stay
    assert [r.version for r in table.loads().orderBy("version").collect()] == [1, 2, 3]


def test_odd_keys(spark, tmp_dir):
    table = FactTable(spark, f"{tmp_dir}/fact", buckets=4, sort_by=None)
    with pytest.raises(FileNotFoundError):
        table.read()
    first = frame(spark, ["a", None, ""], 1)
    table.merge(first, UPDATED)
    table.merge(frame(spark, ["a", "a", None], 2, 5).unionByName(frame(spark, ["a"], 9, 7)), UPDATED)
    got = rows(table.read().select("transaction_id", "amount"))
    assert got == rows(spark.createDataFrame([("a", 9), (None, 1), (None, 2), ("", 1)], "k string, n int"))
    before = files(table, 2)
    row = table.merge(frame(spark, [], 0), UPDATED)
    assert row["staged"] == row["files_written"] == 0 and files(table, 3) == before
    assert rows(table.read().select("transaction_id", "amount")) == got


def test_empty_first_merge(spark, tmp_dir):
    table = FactTable(spark, f"{tmp_dir}/fact", buckets=4, sort_by=None)
    table.merge(frame(spark, [], 0), UPDATED)
    assert table.read().count() == 0 and table.read().columns == frame(spark, [], 0).columns
    table.merge(frame(spark, ["a"], 1), UPDATED)
    assert table.read().count() == 1


def test_merge_that_fails_changes_nothing(spark, tmp_dir):
    table = FactTable(spark, f"{tmp_dir}/fact", buckets=4, sort_by=None)
    table.merge(frame(spark, ["a", "b"], 1), UPDATED)
    broken = frame(spark, ["a"], 2, 2).withColumn("amount", F.when(F.col("amount") == 2, F.raise_error(F.lit("broken")).cast("int")))
    with pytest.raises(Exception):  # noqa: B017
        table.merge(broken, UPDATED)
    assert table.version() == 1 and {r.amount for r in table.read().collect()} == {1}
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{tmp_dir}/fact/manifests/v=2")  # one that was not finished
    import os

    os.remove(f"{tmp_dir}/fact/manifests/v=2/_SUCCESS")
    assert table.version() == 1
    table.merge(frame(spark, ["a"], 2, 2), UPDATED)
    assert table.version() == 2 and {r.amount for r in table.read().collect()} == {1, 2}


def test_many_small_files_are_merged(spark, tmp_dir):
    table = FactTable(spark, f"{tmp_dir}/fact", buckets=1, sort_by=None, most_files=3)
    for k in range(6):
        table.merge(frame(spark, [f"id{k}"], k), UPDATED)
        assert len(files(table, None)) <= 4
    assert table.read().count() == 6


def test_filters_miss_no_key(spark):
    keys = spark.sql("select concat('f', id % 3) as file, cast(id % 3 as int) as bucket, cast(id as string) as key from range(3000)")
    filters = key_filters(keys)
    assert {(r.file, r.rows) for r in filters.collect()} == {("f0", 1000), ("f1", 1000), ("f2", 1000)}
    own = keys.join(filters, ["file", "bucket"]).where(might_hold(F.col("bits"), F.col("filter"), F.col("key")))
    assert own.count() == 3000
    other = keys.select("key").crossJoin(filters.where("file = 'f0'")).where("cast(key as int) % 3 > 0")
    assert other.where(might_hold(F.col("bits"), F.col("filter"), F.col("key"))).count() < 60


def test_merge_fact_job(spark, tmp_dir):
    from ledgerline.plans import jobs
    from ledgerline.plans.catalog import silver_t

    silver_t(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_dir}/silver")
    run = {"run_id": "r", "audit_path": f"{tmp_dir}/audit", "lineage_path": f"{tmp_dir}/lineage"}
    first = jobs.merge_fact(spark, f"{tmp_dir}/silver", f"{tmp_dir}/fact", buckets=4, **run)
    again = jobs.merge_fact(spark, f"{tmp_dir}/silver", f"{tmp_dir}/fact", buckets=4, **run)
    n = spark.read.parquet(f"{tmp_dir}/silver").count()
    assert first["records_written"] == again["records_written"] == n
    assert FactTable(spark, f"{tmp_dir}/fact").read().count() == n


def test_filters_are_built_without_a_lookup_for_each_word(spark):
    """A lookup in a map of a filter's words goes through them: a file of n rows took n * n steps."""
    keys = spark.range(20000).selectExpr("'f' file", "0 bucket", "cast(id as string) key").unionByName(
        spark.createDataFrame([("g", 1, None)], "file string, bucket int, key string")
    )
    filters = key_filters(keys)
    assert "element_at" not in filters._jdf.queryExecution().optimizedPlan().toString()
    f, g = sorted(filters.collect(), key=lambda r: r.file)
    assert (f.rows, f.bits, len(f.filter)) == (20000, 200000, 3125) and (g.rows, g.bits, g.filter) == (1, 64, [0])
    own = keys.join(filters, ["file", "bucket"]).where(might_hold(F.col("bits"), F.col("filter"), F.col("key")))
    assert own.count() == 20000
