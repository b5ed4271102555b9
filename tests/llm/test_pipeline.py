"""The pipeline against brute force, stage by stage, and on odd rows."""

import numpy as np
from pyspark.sql import functions as F
from test_line_dedup_short import brute as brute_lines
from test_operators import brute_components

import corpus_pipeline
from ledgerline.llm import decontaminate, line_dedup, quality
from ledgerline.llm.common import utf8

SF = "/root/testdata/sf0.001"


def test_run_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scorer = quality.fit(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    import pyarrow as pa

    data, off = utf8(pa.array([t for _, t in rows], pa.string()))
    rows = [r for r, s in zip(rows, scorer(data, off)[0]) if s >= quality.KEEP]
    kept = brute_lines(rows, line_dedup.WINDOW, line_dedup.SHORT_WORDS)
    rows = [(i, kept[i, t]) for i, t in rows]
    _, root = brute_components(rows)
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min(least.get(r, i), i)
    rows = [r for r in rows if r[0] in least.values()]
    items = [decontaminate._shingles(r.text.encode(), 5) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = []
    for i, t in rows:
        has = decontaminate._shingles(t.encode(), 5)
        if not any(x and len(x & has) >= np.ceil(0.8 * len(x) - 1e-9) for x in items):
            clean.append(i)
    out = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in out.select("doc_id").distinct().collect()) == sorted(clean)
    full = out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert full <= 1024


def test_stages_keep_the_columns_on_odd_rows(spark, odd, empty, tmp_dir):
    items = f"{tmp_dir}/benchmark.parquet"
    spark.createDataFrame([(1, "some words of an item that stands nowhere")], "item_id bigint, text string").write.parquet(items)
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, empty):
            out = stage(spark, docs, tmp_dir)
            rows = out.collect()
            if name != "best_fit_packing":
                assert out.columns == docs.columns, name
            assert bool(rows) == (docs is odd), name
