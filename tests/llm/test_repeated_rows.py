"""Fits on tables with many equal rows: the driver gets each once, with the number of its rows."""

import numpy as np
import pytest

from ledgerline.llm import linear, quality, toxicity


@pytest.fixture()
def fits(monkeypatch):
    """(rows, their counts) of each call of linear.fit."""
    seen, fit = [], linear.fit

    def spy(rows, *a, **k):
        counts = k.get("counts")
        seen.append((len(rows), len(rows) if counts is None else int(counts.sum())))
        return fit(rows, *a, **k)

    monkeypatch.setattr(linear, "fit", spy)
    return seen


def toxic_docs(spark, copies):
    texts = [(i, f"stupid idiot number{i} says" if i % 2 else f"calm words number{i} here") for i in range(60)]
    return spark.createDataFrame(texts + [texts[1]] * copies, "doc_id bigint, text string")


def test_counts_stand_for_equal_rows():
    rng = np.random.default_rng(3)
    index, target, counts = rng.integers(0, 5, 20), rng.random(10), rng.integers(1, 5, 10)
    at = np.arange(0, 21, 2)
    again = np.repeat(np.arange(10), counts)
    many = linear.Rows(np.arange(0, 2 * len(again) + 1, 2), index.reshape(10, 2)[again].ravel(), np.ones(2 * len(again)))
    one = linear.fit(linear.Rows(at, index, np.ones(20)), target, 5, 1e-3, counts=counts.astype(float))
    two = linear.fit(many, target[again], 5, 1e-3)
    assert np.allclose(one[0], two[0], atol=1e-6) and abs(one[1] - two[1]) < 1e-6


def test_quality_collects_equal_rows_once(spark, fits):
    docs = toxic_docs(spark, 300).unionByName(spark.createDataFrame([(None, "the same words without id")] * 200, "doc_id bigint, text string"))
    quality.fit(docs)
    assert fits == [(61, 560)]


def test_toxicity_collects_equal_rows_once(spark, fits):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 1)] * 40, "doc_id bigint, toxic int")
    docs = toxic_docs(spark, 300)
    train = toxicity.training_texts(docs, labels)
    n = train.count()
    assert n <= 60
    toxicity.fit(docs, labels)
    total = train.selectExpr("sum(n)").first()[0]
    assert fits == [(n, total)] and total > 40


def test_toxicity_bounds_ids_that_many_texts_share(spark, fits):
    docs = toxic_docs(spark, 0).unionByName(spark.range(2000).selectExpr("1L as doc_id", "concat('stupid idiot text ', id) as text"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    toxicity.fit(docs, labels, train_rows=200)
    assert [100 < n < 300 for n, _ in fits] == [True]
