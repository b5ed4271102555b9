"""Importance resampling against a plain-Python definition."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import importance, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def buckets(text, size=10_000):
    w = words(text)
    runs = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return [zlib.crc32(r.encode()) % size for r in runs]


def brute(rows, target, percent=5):
    """[(doc_id, n_features, weight, score)], and the drawn ids in order."""
    s, t = np.zeros(10_000, np.int64), np.zeros(10_000, np.int64)
    for _, text in rows:
        np.add.at(s, buckets(text), 1)
    for text in target:
        np.add.at(t, buckets(text), 1)
    S, T = int(s.sum()), int(t.sum())
    gain = [math.floor(1000 * math.log((int(t[b]) + 1) * (S + 10000) / ((int(s[b]) + 1) * (T + 10000)))) for b in range(10_000)]
    out, fit = [], []
    for i, text in rows:
        f = buckets(text)
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(f), weight, score))
        if len(words(text)) >= 20:
            fit.append((-score, i is None, i or 0))
    return out, [None if none else i for _, none, i in sorted(fit)[: percent * len(fit) // 100]]


def check(rows, found, target, percent=5):
    want, drawn = brute(rows, target, percent)
    assert sorted([(r.doc_id, r.n_features, r.weight, r.score) for r in found], key=repr) == sorted(want, key=repr)
    ranked = sorted((r.rank, r.doc_id) for r in found if r["rank"] is not None)
    assert [k for k, _ in ranked] == list(range(1, len(drawn) + 1))
    assert [i for _, i in ranked] == drawn


def test_given_rows(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
        check(rows, queries.QUERIES["op12_importance_resampling"](spark, sf).collect(), target)


def test_odd_rows(odd, empty, items):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    target = [r.text for r in items.collect()]
    check(rows, importance.resample(odd, items).collect(), target)
    check(rows, importance.resample(odd, items, percent=70).collect(), target, 70)
    check(rows, importance.resample(odd, items.limit(0), percent=70).collect(), [], 70)
    assert importance.resample(empty, items).count() == 0


def test_many_partitions_and_equal_rows(spark, items):
    rows = [(i, f"{i % 3} " + "word of the text " * 10) for i in range(200)] + [(5, "same row " * 20)] * 100
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    check(rows, importance.resample(df, items, percent=50).collect(), [r.text for r in items.collect()], 50)


PARTS = st.sampled_from(["a", "b", "the", "The", "é漢", "0", "long" * 12, " ", "  ", "-", "\n", "_", "x" * 33])


@settings(deadline=None, max_examples=150)
@given(st.lists(st.lists(PARTS, max_size=30).map("".join), max_size=6), st.integers(1, 40), st.booleans())
def test_head_and_blocks_never_change_a_bucket(texts, limit, with_head):
    frequent = ["a", "b", "the", "é漢", "0"] if with_head else []
    pairs = np.array([(0, 1), (2, 0), (1, 1)]) if with_head else np.zeros((0, 2))
    head = importance.Head([w.encode() for w in frequent], pairs)
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    found = [[] for _ in texts]
    for rows, lists, old in importance.blocks(batch, limit):
        for of, b in zip(*(x.tolist() for x in head.features(lists, old))):
            found[rows[of]].append(b)
    assert [sorted(f) for f in found] == [sorted(buckets(t)) for t in texts]


def test_head_is_of_bounded_size_and_whole_octaves(spark):
    rows = spark.sql("select id as word, cast(pow(2, id % 9) as bigint) as n from range(90)")
    kept = importance._frequent(rows, 35).collect()
    assert sorted({r.n for r in kept}) == [64, 128, 256] and len(kept) == 30
    assert importance._frequent(rows, 5).count() == 0
    assert importance._frequent(rows, 1000).count() == 90
