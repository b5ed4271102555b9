"""Messages that are kept until they are sent (SNK7): a failing receiver leaves the batch whole.

A micro-batch writes its messages to ``messages/batch_id=N`` first.  ``deliver``
has tasks call a publisher for every pending message and appends one attempt per
message, with its error if it failed; a message is pending until an attempt
succeeded or ``most`` attempts failed.  A task that is run again after a lost
executor publishes again: at least once, by message id.

Defined results: messages with equal ids are one message (their payloads are
equal where ids are content-derived); a null id is not a message.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGES = "message_id string, payload string, batch_id bigint"
ATTEMPTS = "message_id string, attempt int, error string"


def _sender(publish: Callable[[str, str, int], None]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            errors = []
            for message_id, payload, attempt in zip(f["message_id"], f["payload"], f["attempt"]):
                try:
                    publish(message_id, payload, int(attempt))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - whatever the receiver raises is recorded
                    errors.append(f"{type(e).__name__}: {e}"[:500])
            yield f[["message_id", "attempt"]].assign(error=errors)

    return run


class Outbox:
    def __init__(self, spark: SparkSession, path: str, most: int = 5):
        self.spark, self.path, self.most = spark, path.rstrip("/"), most

    def put(self, rows: DataFrame, id_col: str, batch_id: int) -> None:
        """A batch's messages: ``rows`` as JSON, by id; replaces what an earlier try of the batch wrote."""
        message = rows.where(F.col(id_col).isNotNull()).select(
            F.col(id_col).cast("string").alias("message_id"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("payload")
        )
        message.write.mode("overwrite").parquet(f"{self.path}/messages/batch_id={batch_id}")

    def _read(self, name: str, schema: str) -> DataFrame:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def state(self) -> DataFrame:
        """message_id, payload, attempts, delivered, last_error of every message."""
        messages = self._read("messages", MESSAGES).groupBy("message_id").agg(F.min_by("payload", "batch_id").alias("payload"))
        tries = self._read("attempts", ATTEMPTS).groupBy("message_id").agg(
            F.max("attempt").alias("attempts"),
            F.bool_or(F.col("error").isNull()).alias("delivered"),
            F.max_by("error", F.when(F.col("error").isNotNull(), F.col("attempt"))).alias("last_error"),
        )
        return messages.join(tries, "message_id", "left").select(
            "message_id", "payload", F.coalesce("attempts", F.lit(0)).alias("attempts"),
            F.coalesce("delivered", F.lit(False)).alias("delivered"), "last_error",
        )

    def pending(self) -> DataFrame:
        return self.state().where(~F.col("delivered") & (F.col("attempts") < self.most))

    def deliver(self, publish: Callable[[str, str, int], None]) -> None:
        """One attempt for every pending message; ``publish(message_id, payload, attempt)`` raises if it fails."""
        tried = self.pending().withColumn("attempt", F.col("attempts") + 1).select("message_id", "payload", "attempt")
        tried.mapInPandas(_sender(publish), ATTEMPTS).write.parquet(f"{self.path}/attempts/run={uuid.uuid4().hex}")
