"""A stream source addressed by offsets (SRC7): records in shards, read in batches of a limit.

A shard is what the files ``<root>/delivery=<n>/shard=<k>/*.parquet`` of all
deliveries hold, in the order of deliveries, file names and rows; a record's
offset is its place there, from 0.  A delivery counts once its write is
complete, and only when all earlier ones are.  ``append_records`` writes a
delivery; ``read_shards`` is a streaming DataFrame over all of them::

    records = read_shards(spark, root, progress=..., max_records_per_shard=10_000)

The query's checkpoint holds the offset of each shard.  The offsets from which
the next batch is planned, which the limit and the start at the latest record
need, are also in the small file ``progress``; each query has its own.

Files are opened by ``pyarrow.fs``, in the planner for their row counts and in
tasks for the rows, so the root is a path or URI that it knows.  A batch's rows
of a file are read in slices of ``slice_rows``, each a task, so that a shard
that holds most of the records is read by many.

Defined results: an empty delivery adds no record; a root without a complete
delivery gives no record; a record without key is in shard 0; records of equal
``order`` in one delivery have either order; a shard that a delivery lacks
stays where it is.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..schemas import STREAM_RECORD_SCHEMA

FORMAT = "ledgerline_shards"
#: Of a reading task, whatever the size of a file: bytes of a column read at once, and rows handed on at once.
READ_BYTES, BATCH_ROWS = 1 << 20, 8192
#: Bytes of a row group that ``append_records`` writes.
ROW_GROUP_BYTES = 16 << 20
SCHEMA = StructType(
    [StructField("shard", IntegerType()), StructField("record_offset", LongType()), *STREAM_RECORD_SCHEMA.fields]
)


# ---------------------------------------------------------------- producer side
def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key: the first 32 bits of its MD5 modulo their number; null keys are in shard 0."""
    head = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(head % shards, F.lit(0)).cast("int")


def append_records(records: DataFrame, root: str, delivery: int, key: Column, shards: int, order: str = "sequence_number") -> None:
    """Write ``records`` as the delivery of that number; within a shard they are in ``order``.

    Ranges of (shard, order) make the files, so that a shard that most records go to has many.
    A delivery that is written again replaces its former attempt.
    """
    placed = records.withColumn("shard", shard_of(key, shards)).select("shard", *STREAM_RECORD_SCHEMA.names)
    (
        placed.repartitionByRange("shard", order)
        .sortWithinPartitions("shard", order)
        .write.mode("overwrite")
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .partitionBy("shard")
        .parquet(f"{root}/delivery={delivery:08d}")
    )


# ---------------------------------------------------------------- files of a root
def open_uri(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    return pafs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


class Shards:
    """The files of each shard with their row counts, looked up once per file."""

    def __init__(self, root: str):
        self.fs, self.root = open_uri(root)
        self._deliveries: dict[str, dict[int, list[tuple[str, int]]]] = {}

    def _names(self, folder: str) -> list[pafs.FileInfo]:
        found = self.fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return sorted(found, key=lambda f: f.base_name)

    def _delivery(self, folder: str) -> dict[int, list[tuple[str, int]]]:
        out: dict[int, list[tuple[str, int]]] = {}
        for shard in self._names(folder):
            if shard.type == pafs.FileType.Directory and shard.base_name.startswith("shard="):
                files = [f.path for f in self._names(shard.path) if f.base_name.endswith(".parquet")]
                counts = [(f, pq.read_metadata(f, filesystem=self.fs).num_rows) for f in files]
                out[int(shard.base_name.split("=")[1])] = counts
        return out

    def files(self) -> dict[int, list[tuple[str, int]]]:
        """Per shard, its files in order with their rows, of all deliveries up to the first incomplete one."""
        out: dict[int, list[tuple[str, int]]] = {}
        for d in self._names(self.root):
            if not d.base_name.startswith("delivery="):
                continue
            if d.path not in self._deliveries:
                if self.fs.get_file_info(f"{d.path}/_SUCCESS").type != pafs.FileType.File:
                    break
                self._deliveries[d.path] = self._delivery(d.path)
            for shard, files in self._deliveries[d.path].items():
                out.setdefault(shard, []).extend(files)
        return out

    def ends(self) -> dict[str, int]:
        return {str(k): sum(n for _, n in files) for k, files in sorted(self.files().items())}


# ---------------------------------------------------------------- the source
class Slice(InputPartition):
    """Rows ``lo`` to ``hi`` of a file, whose row 0 has the offset ``first``."""

    def __init__(self, shard: int, path: str, first: int, lo: int, hi: int):
        self.shard, self.path, self.first, self.lo, self.hi = shard, path, first, lo, hi


class ShardReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.start = options.get("startingposition", "earliest").lower()
        if self.start not in ("earliest", "latest"):
            raise ValueError(f"startingPosition is earliest or latest, not {self.start}")
        self.limit = int(options.get("maxrecordspershard", 0))
        self.slice_rows = int(options.get("slicerows", 1_000_000))
        self.progress = options.get("progress")
        if (self.limit or self.start == "latest") and not self.progress:
            raise ValueError("a limit or a start at the latest record needs the option progress")
        self._shards: Shards | None = None

    @property
    def shards(self) -> Shards:
        if self._shards is None:
            self._shards = Shards(self.root)
        return self._shards

    # what the next batch starts from
    def _known(self) -> dict | None:
        fs, path = open_uri(self.progress)
        if fs.get_file_info(path).type != pafs.FileType.File:
            return None
        with fs.open_input_stream(path) as f:
            return json.loads(f.read())

    def _note(self, offsets: dict[str, int], start: dict[str, int]) -> None:
        fs, path = open_uri(self.progress)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(path + ".next") as f:
            f.write(json.dumps({"start": start, "planned": offsets}).encode())
        fs.move(path + ".next", path)

    def _state(self) -> dict:
        known = self._known()
        if known is None:
            start = self.shards.ends() if self.start == "latest" else {}
            self._note(start, start)
            known = {"start": start, "planned": start}
        return known

    def initialOffset(self) -> dict:
        return self._state()["start"] if self.progress else {}

    def latestOffset(self) -> dict:
        ends = self.shards.ends()
        if not self.progress:
            return ends
        planned = self._state()["planned"]
        if self.limit:
            ends = {k: min(n, planned.get(k, 0) + self.limit) for k, n in ends.items()}
        return {**planned, **ends}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        out = []
        back = {k: (n, end.get(k, 0)) for k, n in start.items() if end.get(k, 0) < n}
        if back:
            raise ValueError(f"offsets go back, is the file progress of another run? {back}")
        files = self.shards.files()
        for k, to in sorted(end.items()):
            first, at = 0, start.get(k, 0)
            for path, n in files.get(int(k), []):
                lo, hi = max(at, first), min(to, first + n)
                for x in range(lo, hi, self.slice_rows):
                    out.append(Slice(int(k), path, first, x - first, min(hi, x + self.slice_rows) - first))
                first += n
            if first < to:
                raise ValueError(f"shard {k} ends at {first}, but the batch at {to}: were files deleted?")
        if self.progress:
            self._note(end, self._state()["start"])
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        fs = open_uri(self.root)[0]
        names = STREAM_RECORD_SCHEMA.names
        with fs.open_input_file(partition.path) as f:
            file = pq.ParquetFile(f, buffer_size=READ_BYTES)  # column chunks are streamed, not held whole
            row = 0
            for g in range(file.num_row_groups):
                n = file.metadata.row_group(g).num_rows
                if row < partition.hi and row + n > partition.lo:
                    at = row
                    for b in file.iter_batches(BATCH_ROWS, row_groups=[g], columns=names):
                        lo, hi = max(partition.lo, at), min(partition.hi, at + b.num_rows)
                        if lo < hi:
                            yield self._placed(b.slice(lo - at, hi - lo), partition, partition.first + lo)
                        at += b.num_rows
                row += n

    @staticmethod
    def _placed(b: pa.RecordBatch, s: Slice, offset: int) -> pa.RecordBatch:
        utc = pa.timestamp("us", tz="UTC")
        columns = [b.column(n) for n in STREAM_RECORD_SCHEMA.names]
        columns = [c.cast(utc) if pa.types.is_timestamp(c.type) else c.cast(pa.string()) for c in columns]
        place = [pa.repeat(pa.scalar(s.shard, pa.int32()), b.num_rows), pa.array(np.arange(offset, offset + b.num_rows))]
        return pa.RecordBatch.from_arrays(place + columns, names=SCHEMA.names)

    def commit(self, end: dict) -> None:
        """Files stay: other queries read them."""


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return SCHEMA

    def streamReader(self, schema: StructType) -> ShardReader:
        return ShardReader({k.lower(): v for k, v in dict(self.options).items()})


def read_shards(
    spark: SparkSession,
    root: str,
    progress: str | None = None,
    max_records_per_shard: int | None = None,
    starting_position: str = "earliest",
    slice_rows: int | None = None,
) -> DataFrame:
    """The records of ``root`` as a stream: shard, record_offset, and the columns of a stream record.

    A batch has at most ``max_records_per_shard`` records of each shard.
    """
    spark.dataSource.register(ShardSource)
    r = spark.readStream.format(FORMAT).option("startingPosition", starting_position)
    for name, value in {"progress": progress, "maxRecordsPerShard": max_records_per_shard, "sliceRows": slice_rows}.items():
        if value is not None:
            r = r.option(name, str(value))
    return r.load(root)
