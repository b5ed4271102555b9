"""Schema drift read from footers, and its audit events."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerline.operators import schema_drift as sd

VERSION = r"/v=([^/]+)/"


def changes(spark, root):
    rows = sd.schema_changes(sd.footers(spark, root), F.regexp_extract("path", VERSION, 1)).collect()
    return sorted((r.version, r.change_type, r.column, r.old, r.new, r.n_rows) for r in rows)


def test_added_dropped_retyped_and_back(spark, tmp_dir):
    a = spark.range(10).select("id", F.lit("x").alias("gone"), F.lit(1).alias("n"))
    b = spark.range(4).select("id", F.lit(1).cast("bigint").alias("n"), F.array(F.lit(1)).alias("more"))
    for k, df in enumerate((a, b, b, a)):
        df.write.parquet(f"{tmp_dir}/v={k}")
    assert changes(spark, tmp_dir) == [
        ("1", "ADD_COLUMN", "more", None, "array<int>", 4),
        ("1", "DROP_COLUMN", "gone", "string", None, 4),
        ("1", "TYPE_CHANGE", "n", "int", "bigint", 4),
        ("3", "ADD_COLUMN", "gone", None, "string", 10),
        ("3", "DROP_COLUMN", "more", "array<int>", None, 10),
        ("3", "TYPE_CHANGE", "n", "bigint", "int", 10),
    ]


def test_files_of_one_version_that_differ_and_files_of_others(spark, tmp_dir):
    import os

    for v in "012":
        os.makedirs(f"{tmp_dir}/v={v}")
    pq.write_table(pa.table({"a": pa.array([1, 2], pa.int32())}), f"{tmp_dir}/v=0/x.parquet")
    pq.write_table(pa.table({"a": pa.array([1], pa.int32()), "A": ["s"]}), f"{tmp_dir}/v=1/x.parquet")
    pq.write_table(pa.table({"a": pa.array([], pa.float64())}), f"{tmp_dir}/v=1/y.parquet")
    pq.write_table(pa.table({"a": pa.array([], pa.float64())}), f"{tmp_dir}/v=2/y.parquet")
    pq.write_table(pa.table({"z": [1]}), f"{tmp_dir}/stray.parquet")
    assert changes(spark, tmp_dir) == [
        ("1", "ADD_COLUMN", "A", None, "string", 1),
        ("1", "TYPE_CHANGE", "a", "int", "double|int", 1),
        ("2", "DROP_COLUMN", "A", "string", None, 0),
        ("2", "TYPE_CHANGE", "a", "double|int", "double", 0),
    ]


def test_layer_without_files(spark, tmp_dir):
    assert changes(spark, tmp_dir) == []


def test_drift_events(spark, tmp_dir):
    for k, n in enumerate(("a", "b")):
        spark.range(3).select(F.col("id").alias(n)).write.parquet(f"{tmp_dir}/v={k}")
    found = sd.schema_changes(sd.footers(spark, tmp_dir), F.regexp_extract("path", VERSION, 1))
    events = sd.drift_events(found, "bronze", "etl", F.to_timestamp(F.lit("2024-01-31"))).collect()
    assert {e.event_type for e in events} == {"SCHEMA_CHANGE"} and len({e.event_id for e in events}) == 2
    assert sorted(e.payload for e in events) == [
        '{"table":"bronze","version":"1","change_type":"ADD_COLUMN","column":"b","old":null,"new":"bigint","n_rows":3}',
        '{"table":"bronze","version":"1","change_type":"DROP_COLUMN","column":"a","old":"bigint","new":null,"n_rows":3}',
    ]
