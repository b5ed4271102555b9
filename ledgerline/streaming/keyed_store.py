"""A keyed table that micro-batches put rows into, merged on read and compacted by bucket (SNK6, STR5, STR7).

``put`` writes a batch's rows to ``log/batch_id=N/bucket=B`` and replaces what an
earlier try of the same batch wrote.  ``read`` merges the log with the compacted
base to one row per key: the first that was put (a conditional put: re-delivered
keys change nothing), or the last one.  ``compact`` folds the log into the base
and drops rows whose time to live has passed; only buckets with new or expired
rows are rewritten, the others keep their files.  The manifest that lists each
bucket's folder is written last, so that a compaction happens as a whole or not
at all.

Defined results: rows with a null key are one key; a batch without rows puts
nothing; among equal keys of a batch the ``order`` columns decide, then a hash
of the row.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

BUCKET, BATCH = "bucket", "batch_id"
MANIFEST = "bucket int, folder string, through bigint"


class KeyedStore:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str | StructType,
        key: str,
        order: Sequence[str] = (),
        keep: str = "first",
        ttl: str | None = "ttl",
        buckets: int = 16,
        log: str | None = None,
    ):
        if keep not in ("first", "last"):
            raise ValueError("keep is 'first' or 'last'")
        self.spark, self.path, self.key, self.keep, self.ttl, self.buckets = spark, path.rstrip("/"), key, keep, ttl, buckets
        self.order = list(order)
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.log = log or f"{self.path}/log"

    # ------------------------------------------------------------ files
    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def _fs(self):
        return self._path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbered(self, root: str, prefix: str) -> list[int]:
        """Numbers of the complete folders ``prefix=N`` of ``root``."""
        fs = self._fs()
        if not fs.exists(self._path(root)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(self._path(root))]
        found = [n for n in names if n.startswith(f"{prefix}=") and fs.exists(self._path(root, n, "_SUCCESS"))]
        return sorted(int(n.split("=")[1]) for n in found)

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def put(self, rows: DataFrame, batch_id: int) -> None:
        named = rows.select(*self.schema.names).withColumn(BUCKET, self._bucket(F.col(self.key)))
        # a task writes whole buckets: a file for each, not one for each task and bucket
        named.repartition(self.buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.log}/{BATCH}={batch_id}")

    # ------------------------------------------------------------ reading
    def _manifest(self) -> tuple[int, int, list]:
        """Version, last batch that the base has, and the base's (bucket, folder)."""
        versions = self._numbered(f"{self.path}/manifests", "v")
        if not versions:
            return 0, -1, []
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests/v={versions[-1]}").collect()  # one row a bucket
        return versions[-1], max(r["through"] for r in rows), [(r["bucket"], r["folder"]) for r in rows if r["folder"]]

    def _rows(self, paths: list[str], base: str) -> DataFrame:
        """The rows of folders, with their bucket and batch (-1: of the base)."""
        schema = StructType([*self.schema.fields]).add(BUCKET, IntegerType()).add(BATCH, LongType())
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)
        return rows.withColumn(BATCH, F.coalesce(BATCH, F.lit(-1).cast("bigint")))

    def _all(self, manifest) -> DataFrame:
        _, through, folders = manifest
        new = [f"{self.log}/{BATCH}={n}" for n in self._numbered(self.log, BATCH) if n > through]
        base = self._rows(sorted(f"{self.path}/{f}/{BUCKET}={b}" for b, f in folders), f"{self.path}/base")
        return base.unionByName(self._rows(new, self.log))

    def _merged(self, rows: DataFrame) -> DataFrame:
        names = self.schema.names
        place = F.struct(BATCH, *self.order, F.xxhash64(*names).alias("h"))
        if self.keep == "last":
            place = F.struct(*self.order, BATCH, F.xxhash64(*names).alias("h"))
        pick = F.min_by if self.keep == "first" else F.max_by
        one = rows.groupBy(BUCKET, self.key).agg(pick(F.struct(*names), place).alias("row"))
        return one.select("row.*", BUCKET)

    def _alive(self, as_of: str | None) -> Column:
        if as_of is None or self.ttl is None:
            return F.lit(True)
        return F.coalesce(F.col(self.ttl) > F.unix_seconds(F.to_timestamp(F.lit(as_of))), F.lit(True))

    def read(self, as_of: str | None = None) -> DataFrame:
        """One row per key; with ``as_of`` without those whose time to live has passed then."""
        return self._merged(self._all(self._manifest())).drop(BUCKET).where(self._alive(as_of))

    def get(self, keys: Sequence) -> DataFrame:
        """The rows of some keys: only their buckets' files are read."""
        frame = self.spark.createDataFrame([(k,) for k in keys], StructType([self.schema[self.key]]))
        buckets = [r[0] for r in frame.select(self._bucket(F.col(self.key))).distinct().collect()]
        rows = self._all(self._manifest()).where(F.col(BUCKET).isin(buckets) & F.col(self.key).isin(list(keys)))
        return self._merged(rows).drop(BUCKET)

    # ------------------------------------------------------------ compaction
    def compact(self, as_of: str | None = None) -> dict[str, int]:
        """Fold the log into the base; returns the buckets that were rewritten and left, and the last batch."""
        version, through, folders = manifest = self._manifest()
        batches = self._numbered(self.log, BATCH)
        last = max([through, *batches])
        rows = self._all(manifest)
        changed = (F.col(BATCH) >= 0) | ~self._alive(as_of)
        touched = {r[BUCKET] for r in rows.where(changed).select(BUCKET).distinct().collect()}
        folder = f"base/written={uuid.uuid4().hex}"
        kept = self._merged(rows.where(F.col(BUCKET).isin(sorted(touched)))).where(self._alive(as_of))
        kept.write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        written = {b for b in touched if self._fs().exists(self._path(self.path, folder, f"{BUCKET}={b}"))}
        entries = [(b, f, last) for b, f in folders if b not in touched] + [(b, folder, last) for b in sorted(written)]
        entries = entries or [(0, None, last)]
        self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifests/v={version + 1}")
        return {"rewritten": len(touched), "left": len(entries) - len(written) if folders else 0, "through": last}

    def vacuum(self) -> int:
        """Delete logs that the base has, base folders that no bucket uses, and earlier manifests; returns how many."""
        version, through, folders = self._manifest()
        used = {f.split("/")[1] for _, f in folders}
        fs, gone = self._fs(), []
        gone += [self._path(self.log, f"{BATCH}={n}") for n in self._numbered(self.log, BATCH) if n <= through]
        if fs.exists(self._path(self.path, "base")):
            gone += [s.getPath() for s in fs.listStatus(self._path(self.path, "base")) if s.getPath().getName() not in used]
        gone += [self._path(self.path, "manifests", f"v={v}") for v in self._numbered(f"{self.path}/manifests", "v") if v < version]
        for p in gone:
            fs.delete(p, True)
        return len(gone)
