"""Shared helpers: materialising intermediate tables, and text columns in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

#: Bytes of text that the numpy kernels work on at a time (a longer text is one chunk).
CHUNK_BYTES = 1 << 20


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the session's shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a re-computation.
    The files go when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (bigint) and the text of a documents table, whatever else it holds."""
    return docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text")
    )


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (rows + 1) of a string array; nulls count as empty."""
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_string())
    _, offsets, data = array.buffers()
    n = len(array)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64)[array.offset : array.offset + n + 1]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one row at least)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array whose row i has the next ``counts[i]`` values."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def sampled(key, share: float):
    """A condition that holds for ``share`` of all values of a 64-bit hash column."""
    return key <= min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64)))
