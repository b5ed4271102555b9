"""Language identification: held-out accuracy, brute-force features and scores, gradients by differences."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import language, queries
from ledgerline.llm.common import utf8


def brute_subwords(text):
    """Keys (size, bytes) of a text's subwords."""
    line = bytes(language._NORMAL[b] for b in b" " + text.encode() + b" ")
    out = []
    for n in language.SIZES:
        for i in range(len(line) - n + 1):
            run = line[i : i + n]
            if b" " not in run[1:-1] and run.strip():
                out.append((n, run))
    return sorted(out)


def brute_bucket(n, run):
    x = (int.from_bytes(run, "big") + n) * 0x9E3779B1 % 2**32
    return (x ^ x >> 15) * 0x9E3779B1 % 2**32 >> 32 - language.BITS


def texts_of(texts):
    return utf8(pa.array(texts, pa.string()))


@settings(deadline=None, max_examples=100)
@given(st.lists(st.lists(st.sampled_from([*"abZé漢 \n-.1"]), max_size=15).map("".join), max_size=5), st.integers(1, 12))
def test_subwords_equal_the_definition(texts, limit):
    data, off = texts_of(texts)
    at, index, n = language.counted(data, off, limit)
    for i, t in enumerate(texts):
        want = {}
        for k in brute_subwords(t):
            want[brute_bucket(*k)] = want.get(brute_bucket(*k), 0) + 1
        assert dict(zip(index[at[i] : at[i + 1]].tolist(), n[at[i] : at[i + 1]].tolist())) == want


def small_model():
    texts = ["the cat and the hat", "le chat et la souris", "der hund und die katze", "the dog", "la vache", "ein haus"]
    label = np.array([0, 1, 2, 0, 1, 2])
    rows = language.counted(*texts_of(texts))
    return language.Model(["de", "en", "fr"]), rows, label


def test_gradients_equal_differences():
    model, (at, index, n), label = small_model()
    model.weights = np.random.default_rng(0).normal(size=model.weights.shape)
    loss = lambda: -np.log(language.softmax(model.logits(at, index, n))[np.arange(6), label]).mean()
    to_weights, to_bias, to_average = model.gradients(at, index, n, label)
    for array, place, want in ((model.weights, (3, 1), to_weights[3, 1]), (model.bias, (2,), to_bias[2])):
        array[place] += 1e-5
        up = loss()
        array[place] -= 2e-5
        down = loss()
        array[place] += 1e-5
        assert abs((up - down) / 2e-5 - want) < 1e-6
    row, bucket = 2, index[at[2]]
    share = n[at[2]] / n[at[2] : at[3]].sum()
    others = sum(n[at[r] : at[r + 1]][index[at[r] : at[r + 1]] == bucket].sum() / n[at[r] : at[r + 1]].sum() * to_average[r, 0] for r in range(6) if r != row)
    model.embedding[bucket, 0] += 1e-5
    up = loss()
    model.embedding[bucket, 0] -= 2e-5
    assert abs((up - loss()) / 2e-5 - share * to_average[row, 0] - others) < 1e-6


@pytest.mark.parametrize("limit", [1 << 20, 7])
def test_scores_equal_the_definition(limit):
    model, (at, index, n), label = small_model()
    model.fit(at, index, n, label, steps=200).calibrate(model.logits(at, index, n), label)
    assert (model.logits(at, index, n).argmax(axis=1) == label).all()
    predict = language.Predictor(model, limit)
    texts = ["the cat", "", " 12 ", "¿¡", "la souris et " * 20, "漢"]
    lang, score = predict(*texts_of(texts))
    for t, k, s in zip(texts, lang, score):
        if not any(c.isalpha() for c in t):
            assert (k, s) == (-1, 0)
            continue
        buckets = [brute_bucket(*x) for x in brute_subwords(t)]
        z = (model.embedding[buckets].mean(axis=0) @ model.weights + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert k == p.argmax() and abs(s - p.max()) < 1e-9


def test_calibration_fits_temperature_and_threshold():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3))
    label = np.array([rng.choice(3, p=p) for p in language.softmax(logits)])
    model = language.Model(["a", "b", "c"]).calibrate(4 * logits, label, precision=0.7)
    assert 3 < model.temperature < 5.5
    p = language.softmax(4 * logits / model.temperature)
    taken = p.max(axis=1) >= model.least
    assert 0.69 < (p.argmax(axis=1) == label)[taken].mean() < 0.72 and taken.any() and not taken.all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.QUERIES["op11_language_id"](spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.99
    accepted = [r for r in held if r.accepted]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in accepted]) > 0.99 and len(accepted) > 0.9 * len(held)


def test_odd_rows(spark, odd, empty):
    none = language.identify(odd).collect()  # no language to learn from
    assert len(none) == odd.count() and {(r.lang_pred, r.score, r.accepted) for r in none} == {("und", 0.0, False)}
    rows = [(i, t, x) for i in range(40) for t, x in ((f"the cat number {i} is here", "en"), (f"le chat numéro {i} est là", "fr"))]
    rows += [(None, "the cat", None), (None, None, "en"), (3, "", "fr"), (4, "?! 12", "en"), (5, "the cat is here", None), (5, "the cat is here", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    out = language.identify(df).collect()
    assert len(out) == len(rows) and {r.lang_pred for r in out} == {"en", "fr", "und"}
    assert {r.lang_pred for r in out if r.doc_id in (3, 4, 5) and r.score == 0} == {"und"}
    assert all(0 <= r.score <= 1 for r in out)
    assert language.identify(empty).count() == 0
    with pytest.raises(ValueError):
        language.fit(spark.sql("select id * 5 as doc_id, 'a' as text, concat('l', id) as lang from range(4000)"))


def test_no_held_out_row_is_learned_from(spark):
    rows = [(i, "the cat", "en" if zlib.crc32(str(i).encode()) % 4 != 2 else "xx") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {r.lang for r in language.training_rows(df).collect()} == {"en"}
