"""Toxicity: weak supervision by lexicon and pattern voters.

1. Words and word beginnings (stems) that mark toxic texts are counted over a
   bounded sample (TRAIN_ROWS) of the labelled documents outside the held-out
   fold; the strongest form the lexicon.
2. The lexicon's words are dealt to four voters, its stems to one for each
   length; patterns of spelling vote too.  A generative label model estimates
   each voter's accuracy and the joint votes of dependent pairs of voters from
   the vote combinations of all documents, without labels.
3. Its posterior labels of the sample train a logistic regression on the
   lexicon's features, which scores every whole text.

A score depends on the text alone.  Defined results: a null or empty text has
no features and gets the score of the bias; every row is scored, repeated ones
and those without id (not held out) too; duplicate labels count once each,
null labels not at all; without any labelled row the lexicon is empty and all
scores are equal; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from . import linear
from .common import chunks, column, cut, id_text, lists, sampled, utf8
from .label_model import LabelModel, decode, encode

#: Distinct labelled documents (expected number at most) that the lexicon and the classifier are fitted on.
TRAIN_ROWS = 20_000
FOLDS = 5
#: Features in the lexicon at most; a feature needs LEAST_ROWS toxic rows and LEAST_SHARE of its rows toxic.
LEXICON = 4000
LEAST_ROWS = 8
LEAST_SHARE = 0.9
#: Bytes at a word's beginning that are features of their own.
STEMS = (4, 5, 6, 7, 8)
WORD_VOTERS = 4
VOTERS = WORD_VOTERS + len(STEMS) + 3
L2 = 1e-4

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Words are runs of letters: all other ASCII separates them.
_NO_LETTER = np.ones(256, bool)
_NO_LETTER[0x41:0x5B] = _NO_LETTER[0x61:0x7B] = _NO_LETTER[0x80:] = False


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of rows, and each row's distinct features with their kind (0: word, else the stem's bytes)."""
    start, end, first = K.words(data, off, _NO_LETTER)
    texts = len(off) - 1
    sums = K.prefix_sums(_LOWER[data].astype(K.U) + K.U(1), K.BYTE_BASES[0])
    text = np.repeat(np.arange(texts), np.diff(first))
    hashes, rows, kinds = [], [], []
    for size in (0, *STEMS):
        take = np.flatnonzero(end - start > size)
        stop = end[take] if size == 0 else start[take] + size
        h = K.mix(K.range_hash(sums, start[take], stop, K.BYTE_BASES[0]) + K.U(size))
        order = np.lexsort((h, text[take]))
        h, t = h[order], text[take][order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
        hashes.append(h[new])
        rows.append(t[new])
        kinds.append(np.full(int(new.sum()), size, np.int64))
    h, t, k = map(np.concatenate, (hashes, rows, kinds))
    order = np.argsort(t, kind="stable")
    return np.searchsorted(t[order], np.arange(texts + 1)), h[order], k[order]


class Lexicon:
    """Sorted feature hashes, with the number of the voter that each belongs to."""

    def __init__(self, hashes: np.ndarray, kinds: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, kinds = hashes[order], kinds[order]
        stem = {size: WORD_VOTERS + i for i, size in enumerate(STEMS)}
        by_kind = np.array([stem.get(int(k), 0) for k in kinds], np.int64)
        self.voter = np.where(kinds == 0, (self.hashes % K.U(WORD_VOTERS)).astype(np.int64), by_kind)

    def find(self, at, h) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and lexicon numbers of the rows' features that are in the lexicon."""
        if not len(self.hashes):
            return np.zeros(len(at), np.int64), np.zeros(0, np.int64)
        n = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = self.hashes[n] == h
        return np.concatenate(([0], np.cumsum(hit)))[at], n[hit]


def votes(data: np.ndarray, off: np.ndarray, at: np.ndarray, found: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """-1, 0 (clean) or 1 (toxic) of each voter on each text.

    Lexicon voters vote toxic where one of their entries occurs and else
    abstain.  The patterns: no entry of any voter and a fair number of words
    (clean), entries of three voters or more (toxic), and shouting (toxic) or
    sentence spelling (clean).
    """
    texts = len(off) - 1
    out = np.full((texts, VOTERS), -1, np.int8)
    row = np.repeat(np.arange(texts), np.diff(at))
    out[row, lexicon.voter[found]] = 1
    named = (out[:, : VOTERS - 3] == 1).sum(axis=1)
    length = np.diff(off)
    out[(named == 0) & (length >= 40), VOTERS - 3] = 0
    out[named >= 3, VOTERS - 2] = 1
    upper = np.concatenate(([0], np.cumsum((data >= 0x41) & (data < 0x5B))))
    share = (upper[off[1:]] - upper[off[:-1]]) / np.maximum(length, 1)
    out[(share > 0.4) & (length >= 40), VOTERS - 1] = 1
    out[(share > 0) & (share < 0.1) & (length >= 40), VOTERS - 1] = 0
    return out


def _parts(batch):
    data, off = utf8(column(batch, "text"))
    for lo, hi in chunks(off):
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]


def _label_counts(batches):
    """Features of labelled texts, counted per task before they are shuffled."""
    for b in batches:
        rows, toxic = (column(b, k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("n", "toxic"))
        for lo, hi, data, off in _parts(b):
            at, h, k = features(data, off)
            x, y = (np.repeat(c[lo:hi], np.diff(at)) for c in (rows, toxic))
            u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            n, ones = (np.bincount(inverse, c).astype(np.int64) for c in (x, y))
            yield pa.record_batch(
                [pa.array(u.view(np.int64)), pa.array(k[first]), pa.array(n), pa.array(ones)], names=["h", "kind", "n", "toxic"]
            )


def _codes(lexicon):
    def run(batches):
        total: dict[int, int] = {}
        for b in batches:
            for _, _, data, off in _parts(b):
                at, found = lexicon.find(*features(data, off)[:2])
                codes, n = np.unique(encode(votes(data, off, at, found, lexicon)), return_counts=True)
                for c, k in zip(codes.tolist(), n.tolist()):
                    total[c] = total.get(c, 0) + k
        yield pa.record_batch(
            [pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["code", "n"]
        )

    return run


def _train_rows(lexicon):
    def run(batches):
        for b in batches:
            for lo, hi, data, off in _parts(b):
                at, found = lexicon.find(*features(data, off)[:2])
                codes = encode(votes(data, off, at, found, lexicon))
                yield pa.record_batch(
                    [*(column(b, k).slice(lo, hi - lo) for k in ("key", "n")), pa.array(codes), lists(found, np.diff(at), pa.int64())],
                    names=["key", "n", "code", "index"],
                )

    return run


class Scorer:
    def __init__(self, lexicon: Lexicon, model: LabelModel, weights: np.ndarray, bias: float):
        self.lexicon, self.model, self.weights, self.bias = lexicon, model, weights, bias

    def __call__(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        at, found = self.lexicon.find(*features(data, off)[:2])
        return linear.sigmoid(linear.Rows(at, found, np.ones(len(found))).dot(self.weights) + self.bias)


def held_out(doc_id):
    """Is a row in the fold whose labels are never read?"""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """key, text, n, toxic of a sample of the labelled rows outside the held-out fold: equal ones are one row that stands for n,
    of which ``toxic`` are toxic."""
    mine = labels.select(labels["doc_id"].cast("bigint").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    mine = mine.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    key = F.xxhash64("doc_id")
    n = mine.count()
    share = min(1.0, train_rows / max(1, n))
    sample = mine.withColumn("key", key).where(sampled(F.col("key"), share))
    sample = sample.groupBy("doc_id", "key").agg(F.count("*").alias("labels"), F.sum("toxic").alias("ones"))
    joined = id_text(docs).join(F.broadcast(sample), "doc_id").groupBy("key", "labels", "ones", "text").agg(F.count("*").alias("rows"))
    return joined.select("key", "text", (F.col("labels") * F.col("rows")).alias("n"), (F.col("ones") * F.col("rows")).alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Scorer:
    train = cut(training_texts(docs, labels, train_rows), "toxicity-train")
    n = train.count()
    if n > train_rows * 1.1:  # ids that many different texts share: sampled by text too (1.1: chance alone stays below)
        train = train.where(sampled(F.xxhash64("key", "text"), train_rows / n))
    counted = (
        train.mapInArrow(_label_counts, "h bigint, kind bigint, n bigint, toxic bigint")
        .groupBy("h")
        .agg(F.min("kind").alias("kind"), F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") >= LEAST_ROWS) & (F.col("toxic") >= LEAST_SHARE * F.col("n")))
        .orderBy(F.desc(F.col("toxic") * F.col("toxic") / F.col("n")), "h")
        .limit(LEXICON)
        .collect()
    )
    lexicon = Lexicon(
        np.array([r["h"] for r in counted], np.int64).view(np.uint64), np.array([r["kind"] for r in counted], np.int64)
    )
    codes = (
        id_text(docs).select("text").mapInArrow(_codes(lexicon), "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    )
    combos = np.array([(r["code"], r["n"]) for r in codes.collect()], np.int64).reshape(-1, 2)  # 3**VOTERS at most
    model = LabelModel(VOTERS, correlated=True)
    if not len(combos) or not len(counted):
        return Scorer(lexicon, model, np.zeros(len(counted)), -4.0)
    combos = combos[np.argsort(combos[:, 0])]
    model.fit(decode(combos[:, 0], VOTERS), combos[:, 1])
    rows = train.mapInArrow(_train_rows(lexicon), "key bigint, n bigint, code bigint, index array<bigint>").collect()
    rows.sort(key=lambda r: (r["key"], r["code"], r["index"], r["n"]))
    at = np.concatenate(([0], np.cumsum([len(r["index"]) for r in rows]))).astype(np.int64)
    index = np.array([i for r in rows for i in r["index"]], np.int64)
    target = model.posterior(decode(np.array([r["code"] for r in rows], np.int64), VOTERS).astype(np.int64))
    weights, bias = linear.fit(linear.Rows(at, index, np.ones(len(index))), target, len(counted), L2, counts=np.array([r["n"] for r in rows], float))
    return Scorer(lexicon, model, weights, bias)


def _score(scorer):
    def run(batches):
        for b in batches:
            for lo, hi, data, off in _parts(b):
                yield pa.record_batch(
                    [column(b, "doc_id").slice(lo, hi - lo), pa.array(scorer(data, off))], names=["doc_id", "score"]
                )

    return run


def score_documents(docs: DataFrame, labels: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: toxic), predicted, of every row."""
    scorer = scorer or fit(docs, labels)
    scored = id_text(docs).mapInArrow(_score(scorer), "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
