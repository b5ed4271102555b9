"""Sharding by a permutation-filled lookup table, in DataFrame operations only.

Each shard has a preference order of the slots of a prime-sized table (an
offset and a step from its name's hash).  Shards take turns; in its turn a
shard claims the first slot of its order that is still free, until the table is
full.  Shards differ by one slot at most, and a change of the shards moves few
slots.  The table has as many rows as slots, whatever the data, and is
broadcast: a row's shard is one lookup of its hashed id.

Defined results: a null id is placed like the empty string; repeated rows go
to the same shard; texts are not read; an empty table gives no rows; other
columns stay as they are.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARDS = 256
SLOTS = 65537


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Slot -> index of its shard."""
    if not 0 < len(shards) <= slots or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime that is no smaller than the number of shards")
    at, step = [], []
    for name in shards:
        digest = hashlib.md5(name.encode()).digest()
        at.append(int.from_bytes(digest[:8], "big") % slots)
        step.append(int.from_bytes(digest[8:], "big") % (slots - 1) + 1 if slots > 2 else 1)
    table, free, turn = [-1] * slots, slots, 0
    while free:
        shard = turn % len(shards)
        while table[at[shard]] >= 0:
            at[shard] = (at[shard] + step[shard]) % slots
        table[at[shard]] = shard
        free, turn = free - 1, turn + 1
    return table


def slot_of(c, slots: int = SLOTS):
    """Slot of an id: 60 bits of its text's MD5, modulo the table's size."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint") % slots).cast("int")


def place(rows: DataFrame, id_col: str = "doc_id", shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """``row`` (all columns of rows), slot and shard (a name) of every row."""
    shards = shards or shard_names()
    table = rows.sparkSession.createDataFrame(
        [(slot, shards[i]) for slot, i in enumerate(lookup_table(shards, slots))], "slot int, shard string"
    )
    placed = rows.select(F.struct("*").alias("row"), slot_of(rows[id_col], slots).alias("slot"))
    return placed.join(F.broadcast(table), "slot").select("row", "slot", "shard")  # `slots` rows


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def write_shards(rows: DataFrame, path: str, id_col: str = "doc_id", shards: list[str] | None = None, slots: int = SLOTS) -> None:
    """Write the rows as Parquet, one folder a shard.

    Rows are gathered by shard; at run time Spark splits a shard that one id
    makes much larger than the others over several tasks.
    """
    placed = place(rows, id_col, shards, slots).select("row", "shard").hint("rebalance", "shard")
    placed.write.partitionBy("shard").parquet(path)
