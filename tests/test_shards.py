"""The stream source addressed by offsets: order, limits, resumption, start at the latest record."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import shards


def records(spark, lo, hi):
    return spark.range(lo, hi).select(
        F.format_string("%08d", "id").alias("sequence_number"),
        F.concat(F.lit("d"), F.col("id")).alias("data"),
        F.timestamp_seconds("id").alias("arrival_ts"),
    )


def deliver(spark, root, n, lo, hi, key=None):
    shards.append_records(records(spark, lo, hi), f"{root}/in", n, F.col("data") if key is None else key, 4)


def drain(spark, root, name="q", **kw):
    """All that is there, in batches; the rows read so far with their batch."""

    def sink(batch, k):
        batch.withColumn("batch", F.lit(k)).write.mode("overwrite").parquet(f"{root}/out-{name}/batch_id={k}")

    stream = shards.read_shards(spark, f"{root}/in", f"{root}/progress/{name}.json", **kw)
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/ck-{name}").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.parquet(f"{root}/out-{name}").drop("batch_id").collect() if os.path.exists(f"{root}/out-{name}") else []


def test_offsets_are_gapless_and_in_order(spark, tmp_dir):
    deliver(spark, tmp_dir, 1, 0, 500)
    deliver(spark, tmp_dir, 2, 500, 700)
    rows = drain(spark, tmp_dir, slice_rows=7)
    assert sorted(r.sequence_number for r in rows) == [f"{i:08d}" for i in range(700)]
    for s in {r.shard for r in rows}:
        mine = sorted((r for r in rows if r.shard == s), key=lambda r: r.record_offset)
        assert [r.record_offset for r in mine] == list(range(len(mine)))
        assert [r.sequence_number for r in mine] == sorted(r.sequence_number for r in mine)
    assert all(r.data == f"d{int(r.sequence_number)}" and r.arrival_ts.timestamp() >= 0 for r in rows)


def test_limit_and_resumption(spark, tmp_dir):
    deliver(spark, tmp_dir, 1, 0, 300)
    first = drain(spark, tmp_dir, max_records_per_shard=20)
    per = {}
    for r in first:
        per[r.batch, r.shard] = per.get((r.batch, r.shard), 0) + 1
    assert len(first) == 300 and max(per.values()) == 20 and len({b for b, _ in per}) >= 4
    deliver(spark, tmp_dir, 2, 300, 400)
    again = drain(spark, tmp_dir, max_records_per_shard=20)
    assert sorted(r.sequence_number for r in again) == [f"{i:08d}" for i in range(400)]
    assert {r.batch for r in again if int(r.sequence_number) >= 300}.isdisjoint({r.batch for r in first})


def test_start_at_the_latest_record(spark, tmp_dir):
    deliver(spark, tmp_dir, 1, 0, 100)
    assert drain(spark, tmp_dir, starting_position="latest") == []
    deliver(spark, tmp_dir, 2, 100, 130)
    rows = drain(spark, tmp_dir, starting_position="latest")
    assert sorted(r.sequence_number for r in rows) == [f"{i:08d}" for i in range(100, 130)]


def test_incomplete_and_empty_deliveries(spark, tmp_dir):
    assert drain(spark, tmp_dir) == []  # no root yet
    deliver(spark, tmp_dir, 1, 0, 50)
    deliver(spark, tmp_dir, 2, 0, 0)
    deliver(spark, tmp_dir, 3, 50, 60, key=F.lit(None))  # all in shard 0
    done = f"{tmp_dir}/in/delivery={2:08d}/_SUCCESS"
    os.rename(done, done + ".later")
    assert len(drain(spark, tmp_dir)) == 50
    os.rename(done + ".later", done)
    rows = drain(spark, tmp_dir)
    assert len(rows) == 60 and {r.shard for r in rows if int(r.sequence_number) >= 50} == {0}


def test_repeated_batch_reads_the_same_rows(tmp_dir, spark):
    deliver(spark, tmp_dir, 1, 0, 100)
    reader = shards.ShardReader({"path": f"{tmp_dir}/in", "progress": f"{tmp_dir}/p/x.json", "maxrecordspershard": "10"})
    start, end = reader.initialOffset(), reader.latestOffset()
    rows = lambda r: [b.to_pylist() for s in r.partitions(start, end) for b in r.read(s)]
    once = rows(reader)
    deliver(spark, tmp_dir, 2, 100, 200)
    after_loss = shards.ShardReader({"path": f"{tmp_dir}/in", "progress": f"{tmp_dir}/p/x.json", "maxrecordspershard": "10"})
    assert rows(after_loss) == once
    nxt = after_loss.latestOffset()
    assert all(nxt[k] == min(end[k] + 10, after_loss.shards.ends()[k]) for k in end)
    assert json.load(open(f"{tmp_dir}/p/x.json"))["planned"] == end
    with pytest.raises(ValueError, match="go back"):
        after_loss.partitions(nxt, start)
    with pytest.raises(ValueError, match="progress"):
        shards.ShardReader({"path": "x", "maxrecordspershard": "10"})


def test_fraud_stream_over_shards(spark, tmp_dir):
    """The scorer's rows are the same from shards in small batches as from files."""
    from ledgerline.plans.catalog import silver_t
    from ledgerline.streaming import fraud_stream

    rows = silver_t(spark, "/root/testdata/sf0.001")
    records = fraud_stream.encode_payloads(rows).cache()
    records.write.json(f"{tmp_dir}/files")
    key = F.get_json_object(F.unbase64("data").cast("string"), "$.account_id")
    shards.append_records(records, f"{tmp_dir}/in", 1, key, 3)
    fraud_stream.run_available_now(spark, f"{tmp_dir}/files", f"{tmp_dir}/a", f"{tmp_dir}/cka")
    fraud_stream.run_available_now(spark, f"{tmp_dir}/in", f"{tmp_dir}/b", f"{tmp_dir}/ckb", shards={})
    read = lambda x: sorted(map(str, fraud_stream.read_output(spark, f"{tmp_dir}/{x}", "scored").drop("batch_id").collect()))
    assert read("a") == read("b") and len(read("a")) == records.count()


def test_a_large_row_group_is_streamed(tmp_dir):
    """A task holds some batches of a file, not its columns."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    n = 150_000
    noise = os.urandom(n * 200).hex()
    table = pa.table({
        "sequence_number": [f"{i:09d}" for i in range(n)], "data": [noise[400 * i : 400 * i + 400] for i in range(n)],
        "arrival_ts": pa.array(range(n), pa.timestamp("us", tz="UTC")),
    })
    os.makedirs(f"{tmp_dir}/in")
    pq.write_table(table, f"{tmp_dir}/in/f.parquet", row_group_size=n, use_dictionary=False, compression="none")
    del table, noise
    reader = shards.ShardReader({"path": f"{tmp_dir}/in"})
    before, most, seen = pa.total_allocated_bytes(), 0, []
    for b in reader.read(shards.Slice(2, f"{tmp_dir}/in/f.parquet", 1000, 10, n - 10)):
        most = max(most, pa.total_allocated_bytes() - before)
        seen.append((b.num_rows, b.column(1)[0].as_py(), b.column(0)[0].as_py(), b.column(2)[0].as_py()))
    assert sum(r[0] for r in seen) == n - 20 and seen[0][1:] == (1010, 2, "000000010") and most < 30 << 20
