"""Schema drift of a layer (AUD4), read from the footers of its Parquet files.

Each file's footer is read in a task; the fields of a version's files are one
schema, and each version is compared with the one before it by equi-joins on
(version, column), so that no schema passes through the driver.  Footers are
opened by ``pyarrow.fs``, so the layer's path is one that it knows.

Defined results: a column whose type differs between files of one version has
all its types, sorted, joined by "|"; a version without files does not count,
one whose files hold no rows does; the first version has no changes; a layer
without files gives no rows; names are compared as written, with their case.
"""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from ..sources.shards import open_uri
from . import governance

_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def _fields(schema: pa.Schema) -> dict[str, str]:
    """Column names and Spark types of a file: as Spark wrote them, or else as it would read them."""
    said = (schema.metadata or {}).get(_SPARK_SCHEMA)
    struct = StructType.fromJson(json.loads(said)) if said else from_arrow_schema(schema)
    return {f.name: f.dataType.simpleString() for f in struct.fields}


def _footers(batches):
    for b in batches:
        rows = []
        for path in b.column(0).to_pylist():
            fs, name = open_uri(path)
            with fs.open_input_file(name) as f:
                footer = pq.read_metadata(f)
            rows.append((path, footer.num_rows, list(_fields(footer.schema.to_arrow_schema()).items())))
        yield pa.record_batch(
            [
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.map_(pa.string(), pa.string())),
            ],
            names=["path", "n_rows", "fields"],
        )


def footers(spark: SparkSession, path: str) -> DataFrame:
    """path, n_rows and fields (name to type) of every Parquet file below ``path``; no data page is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path")  # the column of contents is not read
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n).mapInArrow(_footers, "path string, n_rows bigint, fields map<string,string>")


def schema_changes(files: DataFrame, version: Column) -> DataFrame:
    """What changed between the versions of ``footers``: version, change_type, column, old, new, n_rows.

    ``version`` is an expression over ``path``; versions are ordered by it, and
    files for which it is null or empty don't count.  n_rows are the version's.
    """
    files = files.withColumn("version", version.cast("string")).where("version != ''")
    sizes = files.groupBy("version").agg(F.sum("n_rows").alias("n_rows"))
    # one row per version: bounded by deliveries, not by data
    versions = sizes.withColumn("at", F.row_number().over(Window.orderBy("version")))
    fields = files.select("version", F.explode("fields").alias("column", "type")).distinct()
    fields = fields.groupBy("version", "column").agg(F.array_join(F.sort_array(F.collect_set("type")), "|").alias("type"))
    numbered = fields.join(versions, "version").select("at", "column", "type")
    before = numbered.select((F.col("at") + 1).alias("at"), "column", F.col("type").alias("old"))
    both = before.join(numbered.withColumnRenamed("type", "new"), ["at", "column"], "full")
    change = (
        F.when(F.col("old").isNull(), "ADD_COLUMN").when(F.col("new").isNull(), "DROP_COLUMN").otherwise("TYPE_CHANGE")
    )
    # the version after the last one is none, and the first has none before it
    return (
        both.where("at > 1 and not old <=> new")
        .join(versions, "at")
        .select("version", change.alias("change_type"), "column", "old", "new", "n_rows")
    )


def drift_events(changes: DataFrame, table: str, actor: str, ts: Column) -> DataFrame:
    """One SCHEMA_CHANGE audit event per row of ``schema_changes``."""
    keep = {"ignoreNullFields": "false"}
    payload = F.to_json(F.struct(F.lit(table).alias("table"), "version", "change_type", "column", "old", "new", "n_rows"), keep)
    return changes.select(*governance._event("SCHEMA_CHANGE", ts, F.lit(actor), F.lit(table), payload))
