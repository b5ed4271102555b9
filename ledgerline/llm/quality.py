"""Quality classifier: weak labels from overlapping heuristics train a hashed linear scorer.

Heuristic labellers vote good, bad or abstain on whole texts.  Expectation-
maximisation over the counts of their vote combinations, of all documents,
estimates their accuracies; posterior labels of a bounded sample (SAMPLE_ROWS)
train a logistic regression on hashed word shapes, which scores every
document.  No labels are read.

Defined results: a null or empty text, like any of fewer than FEW_WORDS words,
gives no evidence: its votes abstain, its score is 0.5 by definition, and it is
kept.  Repeated rows are scored each on its own; a null doc_id is an id like
any other; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from . import linear
from .common import chunks, column, id_text, lists, sampled, utf8
from .label_model import LabelModel, decode, encode

#: Distinct documents (expected number at most) that the scorer is fitted on, each with the number of its rows.
SAMPLE_ROWS = 8000
BUCKETS = 1 << 16
FEW_WORDS = 5
L2 = 1e-5
#: A document is kept if its score is at least this: below even odds, so that unusual clean texts stay.
KEEP = 0.35

#: Labeller: its measure is good at or below the first bound (if any), bad at or above the second.
LABELLERS = [
    ("symbol_words", None, 0.25),
    ("shouted_letters", None, 0.5),
    ("repeated_neighbours", None, 0.25),
    ("bar_words", None, 0.15),
    ("double_marks", None, 0.2),
    ("repeated_runs", 0.1, 0.4),
    ("odd_words", 0.1, 0.35),
    ("few_distinct", 0.6, 0.75),
]

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True
_LETTER[0xC0:] = True  # first bytes of letters beyond ASCII
#: Of each byte, the class that word shapes are made of; runs of one class count once.
_SHAPE = np.arange(256, dtype=np.uint64) + K.U(8)
_SHAPE[0x61:0x7B] = 1
_SHAPE[0x80:] = 1
_SHAPE[0x41:0x5B] = 2
_SHAPE[0x30:0x3A] = 3
_RUN = 8


def _counted(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return (sums[first[1:]] - sums[first[:-1]]).astype(float)


def _distinct(values: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    order = np.lexsort((values, text))
    v, t = values[order], text[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (t[1:] != t[:-1])
    return np.bincount(t[new], minlength=texts).astype(float)


def measures(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: number of words, and a column for each labeller."""
    start, end, first = K.words(data, off)
    texts = len(off) - 1
    n = np.diff(first).astype(float)
    per = np.maximum(n, 1)
    if not len(start):
        return n, np.zeros((texts, len(LABELLERS)))
    text = np.repeat(np.arange(texts), np.diff(first))
    last = data[end - 1]
    before = np.where(end - start > 1, data[np.maximum(end - 2, 0)], 0)
    hashes = K.word_hashes(data, start, end)
    same = np.zeros(len(start), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    runs = K.window_hashes(hashes, _RUN)
    inside = np.flatnonzero(K.inside(first, _RUN))
    run_text = text[inside]
    n_runs = np.maximum(np.bincount(run_text, minlength=texts), 1)
    distinct_runs = _distinct(runs[inside], run_text, texts)
    letters = np.maximum(_counted(_LETTER[data], off), 1)
    # a plain word: letters, of which the second is not a capital, and one mark at the end at most
    letter = _LETTER[data] | (data >= 0x80)
    inner = np.concatenate(([0], np.cumsum(letter)))
    marked = np.isin(last, np.frombuffer(b".,;:?!", np.uint8))
    second = data[np.minimum(start + 1, len(data) - 1)]
    plain = (inner[end] - inner[start] >= end - start - marked) & (inner[end] > inner[start])
    plain &= ~(_UPPER[second] & (end - start > 1 + marked))
    symbol = np.isin(last, np.frombuffer(b"#$%&*", np.uint8)) & (end - start > 1)
    cols = [
        _counted(symbol, first) / per,
        _counted(_UPPER[data], off) / letters,
        _counted(same, first) / per,
        _counted((last == ord("|")) & (end - start == 1), first) / per,
        _counted((last == ord("!")) & (before == ord("!")), first) / per,
        np.where(distinct_runs > 0, 1 - distinct_runs / n_runs, 0),
        1 - _counted(plain, first) / per,
        np.where(n >= 40, np.maximum(0, 1 - _distinct(hashes, text, texts) / np.minimum(per, 400)), 0),
    ]
    return n, np.stack(cols, axis=1)


def votes(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """-1, 0 (bad) or 1 (good) of each labeller on each text."""
    n, m = measures(data, off)
    good = np.array([-1.0 if x[1] is None else x[1] for x in LABELLERS])  # measures are never negative
    bad = np.array([x[2] for x in LABELLERS])
    out = np.where(m <= good, 1, np.where(m >= bad, 0, -1)).astype(np.int8)
    out[n < FEW_WORDS] = -1
    return out


def features(data: np.ndarray, off: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of hashed word shapes and pairs of neighbouring shapes: offsets, buckets, values."""
    texts = len(off) - 1
    start, end, first = K.words(data, off)
    if not len(start):
        return np.zeros(texts + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
    shape = _SHAPE[data]
    head = np.zeros(len(data), bool)
    head[start] = True
    kept = np.flatnonzero(head | (shape != np.concatenate(([0], shape[:-1]))))
    sums = K.prefix_sums(shape[kept], K.BYTE_BASES[1])
    own = K.range_hash(sums, np.searchsorted(kept, start), np.searchsorted(kept, end), K.BYTE_BASES[1])
    words = K.word_hashes(data, start, end)
    text = np.repeat(np.arange(texts), np.diff(first))
    follows = np.zeros(len(start), bool)
    follows[1:] = text[1:] == text[:-1]
    pair = K.mix(own + K.U(1))
    pair[1:] = K.mix(own[1:] * K.U(3) + own[:-1])
    # a word that repeats the one before has a pair feature of its own
    pair[1:][words[1:] == words[:-1]] = K.mix(np.array([7], K.U))[0]
    index = np.concatenate((own, pair[follows])) % K.U(buckets)
    rows = np.concatenate((text, text[follows]))
    key, count = np.unique(rows * buckets + index.astype(np.int64), return_counts=True)
    row = key // buckets
    value = np.sqrt(count / np.maximum(np.diff(first), 1)[row])
    return np.searchsorted(row, np.arange(texts + 1)), key % buckets, value


def _codes(batches):
    total: dict[int, int] = {}
    for b in batches:
        data, off = utf8(column(b, "text"))
        for lo, hi in chunks(off):
            codes, n = np.unique(encode(votes(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])), return_counts=True)
            for c, k in zip(codes.tolist(), n.tolist()):
                total[c] = total.get(c, 0) + k
    yield pa.record_batch([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["code", "n"])


def _sample_rows(batches):
    for b in batches:
        data, off = utf8(column(b, "text"))
        for lo, hi in chunks(off):
            d, o = data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
            at, index, value = features(d, o)
            n = np.diff(at)
            yield pa.record_batch(
                [
                    *(column(b, k).slice(lo, hi - lo) for k in ("key", "n")),
                    pa.array(encode(votes(d, o))), lists(index, n, pa.int64()), lists(value, n, pa.float64()),
                ],
                names=["key", "n", "code", "index", "value"],
            )


class Scorer:
    def __init__(self, weights: np.ndarray, bias: float, model: LabelModel):
        self.weights, self.bias, self.model = weights, bias, model

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and posterior label of each text."""
        at, index, value = features(data, off)
        score = linear.sigmoid(linear.Rows(at, index, value).dot(self.weights) + self.bias)
        few = np.diff(K.words(data, off)[2]) < FEW_WORDS
        return np.where(few, 0.5, score), self.model.posterior(votes(data, off).astype(np.int64))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Scorer:
    texts = id_text(docs)
    counted = texts.select("text").mapInArrow(_codes, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    combos = np.array([(r["code"], r["n"]) for r in counted.collect()], np.int64).reshape(-1, 2)  # 3**8 at most
    model = LabelModel(len(LABELLERS), correlated=False)
    if not len(combos):
        return Scorer(np.zeros(BUCKETS), 0.0, model)
    combos = combos[np.argsort(combos[:, 0])]
    model.fit(decode(combos[:, 0], model.voters), combos[:, 1])
    key = F.xxhash64("doc_id", "text")
    share = min(1.0, sample_rows / int(combos[:, 1].sum()))
    sample = texts.select("text", key.alias("key")).where(sampled(F.col("key"), share))
    sample = sample.groupBy("key", "text").agg(F.count("*").alias("n"))  # equal rows are one with their number
    rows = sample.mapInArrow(_sample_rows, "key bigint, n bigint, code bigint, index array<bigint>, value array<double>").collect()
    rows.sort(key=lambda r: (r["key"], r["code"]))
    at = np.concatenate(([0], np.cumsum([len(r["index"]) for r in rows]))).astype(np.int64)
    sparse = linear.Rows(
        at,
        np.array([i for r in rows for i in r["index"]], np.int64),
        np.array([v for r in rows for v in r["value"]], float),
    )
    target = model.posterior(decode(np.array([r["code"] for r in rows], np.int64), model.voters).astype(np.int64))
    weights, bias = linear.fit(sparse, target, BUCKETS, L2, counts=np.array([r["n"] for r in rows], float))
    return Scorer(weights, bias, model)


def _score(scorer):
    def run(batches):
        for b in batches:
            data, off = utf8(column(b, "text"))
            for lo, hi in chunks(off):
                score, label = scorer(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                yield pa.record_batch(
                    [column(b, "doc_id").slice(lo, hi - lo), pa.array(score), pa.array(label)],
                    names=["doc_id", "score", "posterior"],
                )

    return run


def score_documents(docs: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """doc_id, score (0 to 1, higher: better), posterior label, keep, of every row."""
    scorer = scorer or fit(docs)
    scored = id_text(docs).mapInArrow(_score(scorer), "doc_id bigint, score double, posterior double")
    return scored.withColumn("keep", F.col("score") >= KEEP)


def _keep(scorer, text_col):
    def run(batches):
        for b in batches:
            data, off = utf8(column(b, text_col))
            keep = [scorer(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])[0] >= KEEP for lo, hi in chunks(off)]
            yield b.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, bool)))

    return run


def drop_poor(docs: DataFrame, scorer: Scorer | None = None, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that the classifier keeps."""
    return docs.mapInArrow(_keep(scorer or fit(docs), text_col), docs.schema)
