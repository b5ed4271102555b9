"""File sources: raw CSV/JSON transaction scans (SRC1/SRC2), Parquet layers
(SRC4-SRC6) and incremental file ingest as a stream (SRC3/STR10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RAW_WITH_CORRUPT_SCHEMA


def read_raw(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """SRC1/SRC2: explicit 16-column schema, PERMISSIVE; malformed rows keep
    their text in ``_corrupt_record`` and unparsable fields become NULL."""
    r = spark.read.schema(RAW_WITH_CORRUPT_SCHEMA).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_corrupt_record"
    )
    if fmt == "csv":
        return r.option("header", "true").csv(path)
    if fmt == "json":
        return r.json(path)
    raise ValueError(f"unsupported raw format {fmt}")


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """SRC4/SRC5/SRC6: a Parquet layer; partition columns are discovered from
    ``name=value`` folders (no recursiveFileLookup, which would disable that)."""
    return spark.read.parquet(path)


def read_raw_stream(spark: SparkSession, path: str, fmt: str = "csv", max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC3: only files not yet recorded in the query checkpoint are read."""
    r = spark.readStream.schema(RAW_WITH_CORRUPT_SCHEMA).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_corrupt_record"
    )
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "csv":
        return r.option("header", "true").csv(path)
    return r.json(path)
