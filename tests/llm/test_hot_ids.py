"""Fingerprints where one id, or no id, holds a third of all rows."""

import hashlib
import random

from pyspark.sql import functions as F

from ledgerline.llm import fingerprints


def expected(rows):
    """Per row, in the defined order: its id, and the digest of its edit with the next row's text."""
    low = -(1 << 63)
    order = sorted(rows, key=lambda r: (-(low if r[0] is None else r[0]), (r[1] is not None, (r[1] or "").encode())))
    out = []
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        out.append((key, len(text), hashlib.sha256(fingerprints.edited(text, following).encode()).hexdigest()))
    return sorted(out, key=str)


def compared(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprints.compare_with_next(df).collect()), key=str)


def corpus(n, hot, same_start=""):
    rng = random.Random(7)
    words = ["alpha", "bete", "cœur", "d", "é", "zz", "Q"]
    text = lambda: same_start + " ".join(rng.choices(words, k=rng.randint(1, 30)))
    rows = [(i if i % 3 else hot, text()) for i in range(1, n)]
    return rows + [(hot, None), (hot, ""), (hot, ""), (5, "twice"), (5, "twice"), (n + 9, None)]


def test_null_and_repeated_ids_follow_the_defined_order(spark):
    for hot in (None, 400, 10**6):
        rows = corpus(900, hot)
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        assert compared(df) == expected(rows)


def test_hot_id_whose_texts_begin_alike_or_are_equal(spark):
    for rows in (corpus(600, None, "x" * 100), [(None, "one text")] * 300 + [(i, "t") for i in range(40)]):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        assert compared(df) == expected(rows)


def test_rows_of_a_null_id_are_spread_over_tasks(spark):
    rows = corpus(4000, None)
    df = fingerprints.with_next(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    halo = df.where("halo").count()
    assert sum(sizes) == len(rows) + halo and halo <= 100
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)
