"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every ledgerline job relies on.  ANSI stays on (Spark 4 default);
# parse edges use try_* functions instead.
CORE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Per-Column call-site capture (for error messages) costs several JVM
    # round-trips per expression while plans are built; batch jobs skip it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Reliable checkpoints written by checkpoint() are deleted once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerline",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    event_log_dir: str | None = None,
) -> SparkSession:
    """Create (or reuse) a session with ledgerline's settings.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (roughly input bytes / 128 MB); locally it defaults to the core count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if event_log_dir:  # stage/task timings for offline analysis (no UI server)
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """Event-time logic and the DuckDB comparison assume UTC session time."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (e.g. Spark Connect)
        return spark.conf.get("spark.checkpoint.dir", None)
    d = sc.getCheckpointDir()
    if d:
        return d
    return sc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Only a local session that has none (tests) gets a fresh folder of its own;
    on a cluster an unset ``spark.checkpoint.dir`` is an error.
    """
    d = checkpoint_dir(spark)
    if d:
        try:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(d)
        except Exception:
            pass
        return d
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    d = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("LEDGERLINE_LOCAL_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/ledgerline/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that it is in."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system delete ``path`` when the driver ends."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def shared_table(df, name: str):
    """``df`` as a Parquet table in the shared checkpoint folder: cuts the lineage, and
    readers of it still prune columns and push filters down.  Gone when the driver ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    drop_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def suggest_shuffle_partitions(input_bytes: int, target_bytes: int = 128 * 1024 * 1024, cores: int | None = None) -> int:
    """Initial shuffle partitions for a job reading ``input_bytes``: about one
    ``target_bytes`` partition each, at least the core count.  AQE then
    coalesces small partitions and splits skewed ones at run time."""
    n = max(1, -(-int(input_bytes) // int(target_bytes)))
    return max(n, cores or 1)
