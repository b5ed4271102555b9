"""Language identification: averaged hashed subword embeddings with a linear softmax, and calibrated rejection.

1. A bounded sample (TRAIN_ROWS) of the learnable rows, as many of each language
   as there are, is turned into counts of hashed subwords: runs of 2 to 4 bytes
   of a word and the marks at its ends.
2. Stochastic gradient descent in numpy fits an embedding per bucket and a linear
   softmax over the average embedding of a text, on four fifths of the sample.
3. The last fifth fits a temperature, so that the softmax of the best language is
   the share of right answers, and the score from which a prediction is accepted.
4. Average and softmax's linear part commute, so that scoring sums one number a
   subword and language over the whole text, block by block.

A prediction depends on the text alone.  Defined results: a null text or one
without a letter is ``und`` with score 0, not accepted; every row is predicted,
repeated ones and those without id (learnable, as no fold holds them) too; rows
with a null lang or no letter teach nothing; equal texts of one language teach once;
equal scores go to the language that sorts first; without a learnable row all
predictions are ``und``; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, chunks, column, cut, lists, sampled, utf8

UNKNOWN = "und"
#: Distinct texts (expected number at most) that the model and its calibration are fitted on, shared equally by the languages.
TRAIN_ROWS = 3000
#: Languages that a table may have; more are an error in the table.
MOST_LANGUAGES = 1000
FOLDS, HELD_FOLD = 4, 2
SIZES = (2, 3, 4)
BITS = 16
BUCKETS = 1 << BITS
DIMENSION = 16
#: Batches that the descent takes, whatever the size of the sample, and rows in each.
STEPS = 600
BATCH = 16
RATE = 5.0
CLIP = 0.25
SEED = 42
#: Share of right answers that accepted predictions have on the calibration rows.
PRECISION = 0.99

_SPACE = 0x20
#: Lower case for A to Z; ASCII that is no letter becomes a space.
_NORMAL = np.full(256, _SPACE, np.uint8)
_NORMAL[0x41:0x5B] = _NORMAL[0x61:0x7B] = np.arange(0x61, 0x7B)
_NORMAL[0x80:] = np.arange(0x80, 0x100)
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_MULTIPLIER = np.uint32(0x9E3779B1)


def has_letter(raw: bytes) -> bool:
    return bool(_ASCII_LETTER.search(raw)) or any(map(str.isalpha, raw.decode()))


def subwords(data: np.ndarray, off: np.ndarray):
    """Per size: text and bucket of each subword, by text.

    A subword is a run of bytes of one word; the space before or after the word may be its first or last byte.
    """
    texts = len(off) - 1
    size = len(data) + texts + 1
    line = np.full(size, _SPACE, np.uint8)  # a space before, between and after the texts
    text_of = np.repeat(np.arange(texts), np.diff(off))
    line[np.arange(len(data)) + text_of + 1] = _NORMAL[data]
    # a space belongs to the text before it; subwords that start with one take the text of their second byte
    owner = np.zeros(size, np.int64)
    owner[1:] = np.repeat(np.arange(texts), np.diff(off) + 1)
    letter = line != _SPACE
    key = line.astype(np.uint32)
    whole = np.ones(size, bool)  # bytes between the first and the last are letters
    for n in range(2, max(SIZES) + 1):
        key = (key[:-1] << np.uint32(8)) | line[n - 1 :]
        whole = whole[: size - n + 1] if n == 2 else whole[: size - n + 1] & letter[n - 2 : size - 1]
        if n not in SIZES:
            continue
        some = whole & (letter[: size - n + 1] | letter[1 : size - n + 2])
        at = np.flatnonzero(some)
        mixed = (key[at] + np.uint32(n)) * _MULTIPLIER
        bucket = (mixed ^ (mixed >> np.uint32(15))) * _MULTIPLIER >> np.uint32(32 - BITS)
        yield np.where(letter[at], owner[at], owner[at + 1]), bucket.astype(np.int64)


def pieces(data: np.ndarray, off: np.ndarray, limit: int = CHUNK_BYTES):
    """Text numbers, bytes and offsets of blocks of about ``limit`` bytes; longer texts are cut where no word stands."""
    at, text = [0], []
    for t, (x, y) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        while y - x > limit:
            cut_at = x + limit + int(np.argmax(np.append(_NORMAL[data[x + limit : y]] == _SPACE, True)))
            at.append(cut_at)
            text.append(t)
            x = cut_at
        at.append(y)
        text.append(t)
    at, text = np.array(at), np.array(text, np.int64)
    for lo, hi in chunks(at, limit):
        yield text[lo:hi], data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]


def counted(data: np.ndarray, off: np.ndarray, limit: int = CHUNK_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of the texts: offsets, buckets, counts."""
    parts = [
        np.unique(np.concatenate([text[t] * BUCKETS + b for t, b in subwords(d, o)]), return_counts=True)
        for text, d, o in pieces(data, off, limit)
    ]
    key, place = np.unique(np.concatenate([k for k, _ in parts] or [np.zeros(0, np.int64)]), return_inverse=True)
    n = np.bincount(place, np.concatenate([n for _, n in parts] or [np.zeros(0)]), minlength=len(key)).astype(np.int64)
    return np.searchsorted(key // BUCKETS, np.arange(len(off))), key % BUCKETS, n


class Model:
    """Embeddings, softmax weights and bias, temperature and the score from which a prediction is accepted."""

    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.embedding = rng.uniform(-1, 1, (BUCKETS, DIMENSION)) / DIMENSION
        self.weights = np.zeros((DIMENSION, len(languages)))
        self.bias = np.zeros(len(languages))
        self.temperature, self.least = 1.0, 0.0

    def average(self, at, index, count) -> np.ndarray:
        total = np.concatenate((np.zeros((1, DIMENSION)), np.cumsum(self.embedding[index] * count[:, None], axis=0)))
        n = np.concatenate(([0], np.cumsum(count)))
        return (total[at[1:]] - total[at[:-1]]) / np.maximum(n[at[1:]] - n[at[:-1]], 1)[:, None]

    def logits(self, at, index, count) -> np.ndarray:
        return self.average(at, index, count) @ self.weights + self.bias

    def gradients(self, at, index, count, label):
        """Of the mean cross entropy: weights, bias, and the error that each row's average embedding gets."""
        h = self.average(at, index, count)
        p = softmax(h @ self.weights + self.bias)
        p[np.arange(len(label)), label] -= 1
        p /= len(label)
        return h.T @ p, p.sum(axis=0), p @ self.weights.T

    def step(self, at, index, count, label, rate: float) -> None:
        to_weights, to_bias, to_average = self.gradients(at, index, count, label)
        to_weights, to_average = clipped(to_weights), clipped(to_average)
        share = count / np.maximum(np.add.reduceat(np.append(count, 0), at[:-1]), 1)[np.repeat(np.arange(len(label)), np.diff(at))]
        error = share[:, None] * to_average[np.repeat(np.arange(len(label)), np.diff(at))]
        used, place = np.unique(index, return_inverse=True)
        change = np.stack([np.bincount(place, error[:, d], minlength=len(used)) for d in range(DIMENSION)], axis=1)
        self.embedding[used] -= rate * len(label) * change
        self.weights -= rate * to_weights
        self.bias -= rate * to_bias

    def fit(self, at, index, count, label, steps: int = STEPS, seed: int = SEED) -> Model:
        """Rows of at least one subword, in batches of a new shuffle whenever all rows had their turn, with a falling rate."""
        rng = np.random.default_rng(seed)
        order = np.zeros(0, np.int64)
        for done in range(steps):
            if not len(order):
                order = rng.permutation(len(label))
            rows, order = order[:BATCH], order[BATCH:]
            sizes = at[rows + 1] - at[rows]
            starts = np.concatenate(([0], np.cumsum(sizes)))
            take = np.arange(starts[-1]) + np.repeat(at[rows] - starts[:-1], sizes)
            self.step(starts, index[take], count[take].astype(float), label[rows], RATE * (1 - done / steps))
        return self

    def calibrate(self, logits: np.ndarray, label: np.ndarray, precision: float = PRECISION) -> Model:
        """The temperature of least cross entropy, and the least score above which at least ``precision`` are right.

        The right language counts 1 less 1 / (rows + 2), so that few rows without an error don't make every score 1.
        """
        if not len(label):
            return self
        doubt = 1 / (len(label) + 2)
        wanted = np.full(logits.shape, doubt / max(1, logits.shape[1] - 1))
        wanted[np.arange(len(label)), label] = 1 - doubt
        loss = lambda t: -(wanted * np.log(np.maximum(softmax(logits / t), 1e-12))).sum(axis=1).mean()
        self.temperature = float(min(np.geomspace(0.05, 20, 241), key=loss))
        p = softmax(logits / self.temperature)
        score, right = p.max(axis=1), p.argmax(axis=1) == label
        order = np.argsort(-score, kind="stable")
        share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(share >= precision)
        self.least = float(score[order][good[-1]]) if len(good) else 1.0
        return self

    def table(self) -> np.ndarray:
        """What a subword of each bucket adds to the sum of each language."""
        return np.ascontiguousarray((self.embedding @ self.weights).T)


def clipped(gradient: np.ndarray) -> np.ndarray:
    """Of norm CLIP at most, so that no batch makes embeddings and weights drive each other up."""
    return gradient * min(1.0, CLIP / max(float(np.linalg.norm(gradient)), 1e-12))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Predictor:
    """Language number (-1: none) and score of whole texts, from a model's table."""

    def __init__(self, model: Model, limit: int = CHUNK_BYTES):
        self.limit = limit
        self.languages, self.bias, self.temperature, self.least = model.languages, model.bias, model.temperature, model.least
        self.table = model.table()

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts, at = len(off) - 1, off.tolist()
        letters = np.array([has_letter(data[x:y].tobytes()) for x, y in zip(at[:-1], at[1:])], bool)
        if not self.languages:
            return np.full(texts, -1), np.zeros(texts)
        total, n = np.zeros((texts, len(self.languages))), np.zeros(texts)
        for of, d, o in pieces(data, off, self.limit):
            for text, bucket in subwords(d, o):
                np.add.at(n, of, np.bincount(text, minlength=len(of)))
                for k, row in enumerate(self.table):
                    np.add.at(total[:, k], of, np.bincount(text, row[bucket], minlength=len(of)))
        p = softmax((total / np.maximum(n, 1)[:, None] + self.bias) / self.temperature)
        return np.where(letters, p.argmax(axis=1), -1), np.where(letters, p.max(axis=1), 0.0)


def _parts(batch):
    data, off = utf8(column(batch, "text"))
    for lo, hi in chunks(off):
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]


def _train_rows(batches):
    for b in batches:
        for lo, hi, data, off in _parts(b):
            at, index, n = counted(data, off)
            yield pa.record_batch(
                [*(column(b, k).slice(lo, hi - lo) for k in ("key", "lang")), lists(index, np.diff(at), pa.int32()), lists(n, np.diff(at), pa.int32())],
                names=["key", "lang", "index", "n"],
            )


def held_out(doc_id):
    """Is a row in the fold whose language is never read?"""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_FOLD, F.lit(False))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))


def training_rows(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """key, lang, text of the sample: equal texts of a language are one."""
    lang = docs["lang"].cast("string")
    mine = docs.where(lang.isNotNull() & (F.length(docs["text"]) > 0) & ~held_out(docs["doc_id"])).select(
        lang.alias("lang"), docs["text"].cast("string").alias("text")
    )
    sizes = mine.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} different values of lang")
    key = F.xxhash64("text")
    wanted = F.lit(False)
    for r in sizes:
        share = min(1.0, train_rows / len(sizes) / r["count"])
        wanted = wanted | ((F.col("lang") == r["lang"]) & sampled(F.col("key"), share))
    return mine.withColumn("key", key).where(wanted).dropDuplicates(["key", "lang"])


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Predictor:
    """A predictor fitted on ``docs`` (doc_id, text, lang) outside the held-out fold."""
    sample = cut(training_rows(docs, train_rows), "language-train")
    rows = sample.mapInArrow(_train_rows, "key bigint, lang string, index array<int>, n array<int>").toArrow()
    rows = rows.filter(pc.greater(pc.list_value_length(rows["index"]), 0)).sort_by([("key", "ascending"), ("lang", "ascending")])
    names = rows["lang"].to_pylist()
    languages = sorted(set(names))
    model = Model(languages)
    if not names:
        return Predictor(model)
    number = {x: i for i, x in enumerate(languages)}
    label = np.array([number[x] for x in names], np.int64)
    fold = rows["key"].to_numpy() % 1_000_003 % 5 == 0
    if fold.all():
        fold[:] = False

    def sparse(chosen):
        some = rows.filter(pa.array(chosen))
        at = np.concatenate(([0], np.cumsum(pc.list_value_length(some["index"]).to_numpy()))).astype(np.int64)
        index, n = (pc.list_flatten(some[k]).to_numpy().astype(np.int64) for k in ("index", "n"))
        return at, index, n, label[chosen]

    model.fit(*sparse(~fold))
    at, index, n, label = sparse(fold)
    model.calibrate(model.logits(at, index, n), label)
    return Predictor(model)


def _predict(predictor):
    def run(batches):
        names = np.array([*predictor.languages, UNKNOWN], object)
        for b in batches:
            for lo, hi, data, off in _parts(b):
                lang, score = predictor(data, off)
                yield pa.record_batch(
                    [
                        column(b, "doc_id").slice(lo, hi - lo), pa.array(names[lang], pa.string()), pa.array(score),
                        pa.array((lang >= 0) & (score >= predictor.least)),
                    ],
                    names=["doc_id", "lang_pred", "score", "accepted"],
                )

    return run


def identify(docs: DataFrame, predictor: Predictor | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1, calibrated), accepted of every row."""
    out = _rows(docs).mapInArrow(_predict(predictor or fit(docs)), "doc_id bigint, lang_pred string, score double, accepted boolean")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
