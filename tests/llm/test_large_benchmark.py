"""Benchmarks beyond one block are searched by joins, with the same results."""

import random

from pyspark.sql import functions as F

from ledgerline.llm import decontaminate as dc

FIELDS = "doc_id bigint, text string, item_id string, key int, _found binary, h int"


def tables(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["É", "ß"]
    item = lambda n: rng.choices(words, k=n)
    items = [(i, item(rng.randint(3, 120))) for i in range(60)] + [(7, item(30))]
    docs = []
    for i, (_, w) in enumerate(items * 3):
        part = w[: rng.choice([len(w), len(w), int(0.9 * len(w)), len(w) // 2])]
        docs.append((i, " ".join(item(rng.randint(0, 200)) + [x.upper() for x in part] + item(5))))
    docs += [(500, None), (501, ""), (None, " ".join(items[9][1])), (502, " \t\n"), (503, " ".join(items[9][1] * 300))]
    docs += [(503, "another text"), (504, " ".join(items[8][1]))] + [(505, " ".join(items[11][1]))] * 200
    d = spark.createDataFrame([(i, t, "x", 1, b"1", 2) for i, t in docs], FIELDS).repartition(3)
    every = [(i, " ".join(w)) for i, w in items] + [(3, " ".join(items[3][1])), (80, None), (None, "a b c d e f"), (81, ""), (9, " ".join(items[9][1]))]
    return d, spark.createDataFrame(every + [(82, " ".join(items[9][1]))], "item_id bigint, text string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_joins_find_what_one_block_finds(spark):
    docs, items = tables(spark)
    one = rows(dc.contamination_pairs(docs, items))
    assert len(one) > 60 and rows(dc.contamination_pairs(docs, items, block_bytes=1)) == one
    assert rows(dc.contamination_pairs(docs, items, threshold=0.5, block_bytes=1)) == rows(dc.contamination_pairs(docs, items, threshold=0.5))
    kept = rows(dc.drop_contaminated(docs, items))
    assert 0 < len(kept) < docs.count() and rows(dc.drop_contaminated(docs, items, block_bytes=1)) == kept


def test_joins_and_empty_tables(spark):
    docs, items = tables(spark)
    assert dc.contamination_pairs(docs.limit(0), items, block_bytes=1).count() == 0
    assert dc.contamination_pairs(docs, items.limit(0), block_bytes=1).count() == 0
    assert dc.drop_contaminated(docs, items.limit(0)).count() == docs.count()
    assert dc.drop_contaminated(docs.limit(0), items, block_bytes=1).columns == docs.columns


def test_item_texts_stay_out_of_the_driver(spark, monkeypatch):
    docs, items = tables(spark)
    monkeypatch.setattr(type(items), "toLocalIterator", lambda *a, **k: (_ for _ in ()).throw(AssertionError("collected")))
    assert dc.drop_contaminated(docs, items, block_bytes=1).where(F.col("doc_id") == 505).count() == 0
