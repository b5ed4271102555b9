"""A fact table that a merge rewrites only where it changes (SNK5, JOB3, JOIN1/2).

Rows lie in files by a hash bucket of their key.  A manifest per version lists
the files with their bucket, rows and a Bloom filter of their keys.  A merge

1. tests staging's keys against the filters of the files in their bucket (a semi
   join, of which the filter is a condition, so that it is never copied),
2. reads the key column of the files that may hold some, and keeps those that do,
3. upserts staging into those files' rows only, and writes the result, with the
   inserted rows, as new files,
4. writes the next manifest, which is the merge's only visible act.

All other files stay as they are, under their names.  A merge that fails leaves
files that no manifest lists; running it again takes a folder of its own.  Two
merges at once write the same manifest, of which the second one fails.

Buckets are fixed when the table is created: as many as give each some files of
a few hundred MB.  A bucket with more than ``most_files`` files is merged whole,
so that keys are tested against a bounded number of filters.

Defined results: rows with a null key are inserted by each merge that brings
them, as in ``etl.upsert``; equal keys in staging count once, the latest row; an
empty staging makes a version with the same files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import UPSERT_UPDATE_COLUMNS
from ..session import shared_table
from . import etl

#: Bits of a filter for each row, and bits that each key sets: about one key in 120 is taken for another file's.
BITS_PER_ROW = 10
PROBES = 7
MAX_ROWS_PER_FILE = 1_000_000
MANIFEST = "file string, bucket int, rows bigint, since int, bits bigint, filter array<bigint>"
LOADS = "version int, run_id string, staged bigint, updated bigint, inserted bigint, copied bigint, files_before int, files_read int, files_rewritten int, files_written int, table_schema string"


def _hashes(key: Column, bits: Column) -> tuple[Column, Column]:
    return F.pmod(F.xxhash64(key), bits), F.pmod(F.xxhash64(key, F.lit(1)), bits)


def _position(h1: Column, h2: Column, i, bits: Column) -> Column:
    return (h1 + i * h2) % bits


def might_hold(bits: Column, words: Column, key: Column) -> Column:
    """Are all of a key's bits set in a filter?"""
    h1, h2 = _hashes(key, bits)
    at = [_position(h1, h2, i, bits) for i in range(PROBES)]
    tests = [F.getbit(F.get(words, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1 for p in at]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def key_filters(keys: DataFrame) -> DataFrame:
    """``keys`` (file, bucket, key) -> file, bucket, rows, bits, filter; null keys set no bit."""
    sizes = keys.groupBy("file", "bucket").agg(F.count("*").alias("rows"))
    sizes = sizes.withColumn("bits", F.ceil(F.col("rows") * BITS_PER_ROW / 64) * 64)
    h1, h2 = _hashes(F.col("key"), F.col("bits"))
    each = F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda i: _position(h1, h2, i, F.col("bits")))
    positions = keys.where("key is not null").join(sizes.select("file", "bits"), "file").select("file", F.explode(each).alias("at"))
    word = F.floor(F.col("at") / 64).cast("int")
    one = F.expr("shiftleft(1L, cast(at % 64 as int))")
    # every word of a filter comes once as zero, so that a file's array is its words in order
    count = (F.col("bits") / 64).cast("int")
    zeros = sizes.select("file", F.explode(F.sequence(F.lit(0), count - 1)).alias("word"), F.lit(0).cast("bigint").alias("b"))
    words = positions.select("file", word.alias("word"), one.alias("b")).unionByName(zeros)
    words = words.groupBy("file", "word").agg(F.bit_or("b").alias("b"))
    filled = words.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("word", "b"))).alias("set"))  # rows of a file: bounded
    return sizes.join(filled, "file").select("file", "bucket", "rows", "bits", F.col("set.b").alias("filter"))


class FactTable:
    def __init__(
        self, spark: SparkSession, path: str, key: str = "transaction_id", buckets: int = 64, sort_by: str | None = "transaction_date",
        most_files: int = 8,
    ):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.buckets, self.sort_by, self.most_files = buckets, sort_by, most_files

    # ------------------------------------------------------------ versions
    def _folders(self, name: str) -> dict[int, bool]:
        """Version -> is it complete?"""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        root = hadoop(f"{self.path}/{name}")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return {}
        found = {s.getPath().getName(): s.getPath() for s in fs.listStatus(root)}
        return {int(k[2:]): fs.exists(hadoop(p, "_SUCCESS")) for k, p in found.items() if k.startswith("v=")}

    def version(self) -> int:
        """The last complete version, 0 if there is none."""
        return max((v for v, done in self._folders("manifests").items() if done), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests/v={version}")

    def loads(self) -> DataFrame:
        """One row per merge: its rows, and the files that it read and rewrote."""
        done = [v for v, complete in self._folders("manifests").items() if complete]
        if not done:
            return self.spark.createDataFrame([], LOADS)
        return self.spark.read.schema(LOADS).parquet(*[f"{self.path}/loads/v={v}" for v in sorted(done)])

    def _files(self, names: Iterable[str], schema: StructType) -> DataFrame:
        paths = [f"{self.path}/{f}" for f in sorted(names)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _names(self, df: DataFrame) -> list[str]:
        return [r["file"] for r in df.select("file").collect()]  # a file's name each

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            raise FileNotFoundError(f"no version of a fact in {self.path}")
        stored = self.spark.read.schema(LOADS).parquet(f"{self.path}/loads/v={version}").first()["table_schema"]
        return self._files(self._names(self.manifest(version)), StructType.fromJson(json.loads(stored)))

    # ------------------------------------------------------------ merge
    def _bucket(self) -> Column:
        first = F.conv(F.substring(F.md5(F.coalesce(F.col(self.key).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("bigint")
        return (first % self.buckets).cast("int")

    def _holding(self, manifest: DataFrame, keys: DataFrame) -> list[str]:
        """Files whose filter may hold one of ``keys`` (bucket, key)."""
        m, k = manifest.alias("m"), keys.where("key is not null").alias("k")
        both = (F.col("m.bucket") == F.col("k.bucket")) & might_hold(F.col("m.bits"), F.col("m.filter"), F.col("k.key"))
        return self._names(m.join(k, both, "left_semi"))

    def merge(self, staging: DataFrame, update_columns: Iterable[str] = UPSERT_UPDATE_COLUMNS, run_id: str | None = None, dedupe: bool = True) -> dict[str, int]:
        """Upsert ``staging`` as the next version; returns the row of ``loads``."""
        version = self.version()
        if dedupe:
            nulls = staging.where(F.col(self.key).isNull())
            staging = etl.dedupe_latest(staging.where(F.col(self.key).isNotNull()), [self.key], ["updated_at"], hash_tiebreak=True).unionByName(nulls)
        staging = shared_table(staging, "fact-staging")
        schema, columns = staging.schema, staging.columns
        keys = staging.select(self._bucket().alias("bucket"), F.col(self.key).alias("key"))
        manifest = self.manifest(version)
        before = {r["file"]: r["bucket"] for r in manifest.select("file", "bucket").collect()}
        candidates = self._holding(manifest, keys) if before else []
        # the key column of the candidates tells which hold some, and how many rows are updated
        name = F.regexp_extract(F.col("_metadata.file_path"), r"(data/[^/]+/bucket=[^/]+/[^/]+)$", 1)
        held = self._files(candidates, schema).select(name.alias("file"), F.col(self.key).alias("key")) if candidates else None
        hit = held.join(keys.select("key").where("key is not null"), "key").groupBy("file").agg(F.count("*").alias("n")).collect() if candidates else []
        rewritten, updated = {r["file"] for r in hit}, sum(r["n"] for r in hit)
        files: dict[int, list[str]] = {}
        for f, b in before.items():
            files.setdefault(b, []).append(f)
        rewritten |= {f for fs in files.values() if len(fs) > self.most_files for f in fs}
        target = self._files(rewritten, schema) if rewritten else None
        merged = etl.upsert(target, staging, self.key, update_columns, dedupe_staging=False) if target is not None else staging
        folder = f"data/{uuid.uuid4().hex}"
        order = ["bucket", *([self.sort_by] if self.sort_by else [])]
        (
            merged.select(*columns, self._bucket().alias("bucket"))
            .repartition(self.buckets, "bucket")
            .sortWithinPartitions(*order)
            .write.option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
            .partitionBy("bucket")
            .parquet(f"{self.path}/{folder}")
        )
        staged = staging.count()
        if staged or rewritten:
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
            new = key_filters(shared_table(rows.select(name.alias("file"), self._bucket().alias("bucket"), F.col(self.key).alias("key")), "fact-keys"))
        else:
            new = self.spark.createDataFrame([], MANIFEST).drop("since")
        gone = self.spark.createDataFrame([(f,) for f in sorted(rewritten)], "file string")
        new = shared_table(new.withColumn("since", F.lit(version + 1)), "fact-manifest")
        kept = manifest.join(gone, "file", "left_anti")
        sizes = new.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
        row = {
            "version": version + 1, "run_id": run_id or uuid.uuid4().hex, "staged": staged, "updated": updated,
            "inserted": staged - updated, "copied": int(sizes[1]) - staged, "files_before": len(before), "files_read": len(candidates),
            "files_rewritten": len(rewritten), "files_written": int(sizes[0]), "table_schema": schema.json(),
        }
        self.spark.createDataFrame([row], LOADS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/loads/v={version + 1}")
        mode = "errorifexists" if self._folders("manifests").get(version + 1, False) else "overwrite"  # one that failed half-way is replaced
        kept.unionByName(new).select(*kept.columns).write.mode(mode).parquet(f"{self.path}/manifests/v={version + 1}")
        return {k: v for k, v in row.items() if k != "table_schema"}
