"""Target-distribution importance resampling over hashed runs of one to three words, with a head-tail vocabulary.

A document's weight is the sum over its features (all runs of 1 to 3 words,
repeats counted) of its bucket's gain, the logarithm of how much likelier the
bucket is among the target texts than among all documents.  Gumbel noise from a
hash of the id turns the weights into a draw without replacement.

A feature's bucket is the CRC-32 of its bytes modulo ``buckets``:

1. Words are counted over all documents, and pairs of the most frequent words too.
   The head is every word down to the count at which at most HEAD_WORDS are left
   (HEAD_PAIRS for pairs): a table of bounded size goes to every task.
2. CRC-32 is linear, so that the state of "u v" is the state of "u" moved on by
   the bytes of " v", exclusive-or the state of " v".  For head words both states
   and the move are looked up, for frequent pairs the whole state and the bucket;
   numpy does so for all positions of a block of texts at once.
3. A feature with a word of the tail takes the CRC of its bytes, one zlib call
   that goes on from the feature without its last word.

Which words are in the head changes how a bucket is found, never which.  All
bucket totals are exact and over all texts; they and the gains have ``buckets``
entries, whatever the documents.

Texts are read in blocks of at most BLOCK bytes; of a longer text, each block
starts with the two words before it.  Ranks come from one range partitioned
sort and the rows counted per partition.

Defined results: a null or empty text has no words, no features and weight 0,
and cannot be drawn; a null doc_id hashes as the empty string and comes last
among equal scores; repeated rows count, and are drawn, each on its own; an empty target
leaves t and T at 0; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, cut, id_text, utf8

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Words and pairs in the head at most; pairs are counted among the first PAIR_WORDS words of it; longer words are never in it.
HEAD_WORDS = 1 << 16
HEAD_PAIRS = 1 << 16
PAIR_WORDS = 1 << 10
HEAD_BYTES = 32
#: Distinct words that a task counts before it passes the counts on.
COUNTED = 400_000
#: Bytes of text that are looked up at a time.
BLOCK = 1 << 20

_WORD_BYTE = [0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)]
#: Lower case for A to Z; a space for each byte that is of no word.
_NORMAL = bytes((b + 0x20 if 0x41 <= b <= 0x5A else b) if w else 0x20 for b, w in enumerate(_WORD_BYTE))
_SEPARATOR = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")


def word_list(raw: bytes) -> list[bytes]:
    return raw.translate(_NORMAL).split()


def blocks(batch, limit: int = BLOCK):
    """(row, words, how many of them the block before had already) lists of about ``limit`` bytes, of a batch's texts."""
    data, off = utf8(column(batch, "text"))
    at = off.tolist()
    rows, lists, old, size = [], [], [], 0
    for row, (x, y) in enumerate(zip(at[:-1], at[1:])):
        raw, before = data[x:y].tobytes(), []
        start = 0
        while start < len(raw) or start == 0:
            end = len(raw)
            if end - start > limit:  # at the next byte that is of no word
                found = _SEPARATOR.search(raw, start + limit)
                end = found.start() if found else end
            words = before + word_list(raw[start:end])
            rows.append(row)
            lists.append(words)
            old.append(len(before))
            before, size = words[-2:], size + end - start
            start = max(end, 1)
            if size >= limit:
                yield rows, lists, old
                rows, lists, old, size = [], [], [], 0
    if rows:
        yield rows, lists, old


# ---------------------------------------------------------------- CRC-32 as a linear map
_POLYNOMIAL = 0xEDB88320


def _shift_tables(longest: int) -> np.ndarray:
    """[n, i, b]: what byte i of a state becomes after n zero bytes, for n up to ``longest``."""
    byte = np.arange(256, dtype=np.uint32)
    step = byte.copy()
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(_POLYNOMIAL), step >> 1).astype(np.uint32)
    state = np.stack([byte << np.uint32(8 * i) for i in range(4)])
    out = [state]
    for _ in range(longest):
        state = step[state & 0xFF] ^ (state >> np.uint32(8))
        out.append(state)
    return np.stack(out)


_SHIFT = _shift_tables(HEAD_BYTES + 1).reshape(-1)


def moved(state: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC states after ``n`` further bytes, to which the CRC of those bytes is to be added by exclusive or."""
    base = n.astype(np.int64) << 10
    out = _SHIFT[base + (state & 0xFF)]
    out ^= _SHIFT[base + 256 + (state >> np.uint32(8) & 0xFF)]
    out ^= _SHIFT[base + 512 + (state >> np.uint32(16) & 0xFF)]
    out ^= _SHIFT[base + 768 + (state >> np.uint32(24))]
    return out


class Head:
    """CRC states of the frequent words, and states and buckets of frequent pairs of them."""

    def __init__(self, words: list[bytes], pairs: np.ndarray, buckets: int = BUCKETS):
        """``pairs``: rows of two word numbers."""
        self.buckets = buckets
        self.number = {w: i for i, w in enumerate(words)}
        self.state = np.array([zlib.crc32(w) for w in words] + [0], np.uint32)  # the last entry stands for the tail
        self.spaced = np.array([zlib.crc32(b" " + w) for w in words] + [0], np.uint32)
        self.bytes = np.array([len(w) + 1 for w in words] + [0], np.uint8)
        self.bucket = (self.state % np.uint32(buckets)).astype(np.int32)
        pairs = pairs.reshape(-1, 2).astype(np.int64)
        self.wide = int(pairs.max()) + 1 if len(pairs) else 0  # at most PAIR_WORDS
        self.pair = np.full(self.wide * self.wide, -1, np.int32)
        self.pair[pairs[:, 0] * self.wide + pairs[:, 1]] = np.arange(len(pairs))
        self.pair_state = moved(self.state[pairs[:, 0]], self.bytes[pairs[:, 1]]) ^ self.spaced[pairs[:, 1]]
        self.pair_bucket = (self.pair_state % np.uint32(buckets)).astype(np.int32)

    def numbers(self, flat: list[bytes]) -> np.ndarray:
        """Of each word its number in the head, or -1."""
        return np.fromiter(map(self.number.get, flat, repeat(-1)), np.int64, len(flat))

    def features(self, lists: list[list[bytes]], old: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """List and bucket of every feature whose last word isn't among the first ``old`` ones of its list."""
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = list(chain.from_iterable(lists))
        n = len(flat)
        number = self.numbers(flat)
        first = np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(len(lists)), sizes)
        place = np.arange(n) - first[of]
        new = place >= np.array(old, np.int64)[of]
        crc = zlib.crc32
        tail = np.flatnonzero(number < 0)
        # one word
        state, bucket = self.state[number], self.bucket[number]
        if len(tail):
            state[tail] = [crc(flat[i]) for i in tail.tolist()]
            bucket[tail] = state[tail] % np.uint32(self.buckets)
        out_of, out = [of[new]], [bucket[new]]
        # two words
        at = np.flatnonzero(place >= 1)
        head = (number[at] >= 0) & (number[at - 1] >= 0)
        two = np.zeros(n, np.uint32)
        known = np.full(len(at), -1, np.int32)
        if self.wide:
            u, v = number[at - 1], number[at]
            close = np.flatnonzero(head & (u < self.wide) & (v < self.wide))
            known[close] = self.pair[u[close] * self.wide + v[close]]
        hit = known >= 0
        two[at[hit]] = self.pair_state[known[hit]]
        free = at[head & ~hit]
        two[free] = moved(state[free - 1], self.bytes[number[free]]) ^ self.spaced[number[free]]
        direct = at[~head]
        two[direct] = [crc(b" " + flat[i], s) for i, s in zip(direct.tolist(), state[direct - 1].tolist())]
        bucket = two % np.uint32(self.buckets)
        bucket[at[hit]] = self.pair_bucket[known[hit]]
        take = at[new[at]]
        out_of.append(of[take])
        out.append(bucket[take].astype(np.int32))
        # three words
        at = at[(place[at] >= 2) & new[at]]
        head = (number[at] >= 0) & (number[at - 1] >= 0) & (number[at - 2] >= 0)
        three = np.zeros(len(at), np.uint32)
        free = at[head]
        three[head] = moved(two[free - 1], self.bytes[number[free]]) ^ self.spaced[number[free]]
        direct = at[~head]
        three[~head] = [crc(b" " + flat[i], s) for i, s in zip(direct.tolist(), two[direct - 1].tolist())]
        out_of.append(of[at])
        out.append((three % np.uint32(self.buckets)).astype(np.int32))
        return np.concatenate(out_of), np.concatenate(out)


# ---------------------------------------------------------------- the head, from counts over all documents
def _word_counts(batches):
    counts: Counter = Counter()

    def out():
        # of a word too long for the head nothing is asked
        kept = [(w, n) for w, n in counts.items() if len(w) <= HEAD_BYTES]
        counts.clear()
        return pa.record_batch([pa.array([w for w, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    for b in batches:
        for _, lists, old in blocks(b):
            for words, k in zip(lists, old):
                counts.update(words[k:])
            if len(counts) > COUNTED:
                yield out()
    yield out()


def _pair_counts(words: list[bytes]):
    number = {w: i for i, w in enumerate(words)}
    wide = len(words)

    def run(batches):
        counts = np.zeros(wide * wide, np.int64)
        for b in batches:
            for _, lists, _ in blocks(b):
                flat = list(chain.from_iterable(lists))
                n = np.fromiter(map(number.get, flat, repeat(-1)), np.int64, len(flat))
                sizes = np.array([len(x) for x in lists], np.int64)
                inner = np.ones(len(flat), bool)
                inner[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
                u, v = n[:-1], n[1:]
                pair = np.flatnonzero((u >= 0) & (v >= 0) & inner[1:])
                key, k = np.unique(u[pair] * wide + v[pair], return_counts=True)
                counts[key] += k
        some = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(some), pa.array(counts[some])], names=["pair", "n"])

    return run


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """Rows of (.., n) whose n is at least a bound, the least power of the fourth root of 2 that leaves at most ``most``."""
    octave = F.floor(4 * F.log2("n"))
    sizes = {r["o"]: r["k"] for r in counts.groupBy(octave.alias("o")).agg(F.count("*").alias("k")).collect()}  # 252 at most
    total, bound = 0, None
    for o in sorted(sizes, reverse=True):
        total += sizes[o]
        if total > most:
            break
        bound = o
    return counts.where(F.lit(False) if bound is None else octave >= bound)


def learn_head(docs: DataFrame, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS, buckets: int = BUCKETS) -> Head:
    """The head vocabulary of ``docs`` (doc_id, text): of each kind at most so many rows come to the driver."""
    text = docs.select("text")
    counted = cut(text.mapInArrow(_word_counts, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "importance-words")
    rows = sorted((-r["n"], bytes(r["word"])) for r in _frequent(counted, words).collect())
    frequent = [w for _, w in rows]
    if not frequent:
        return Head([], np.zeros((0, 2)), buckets)
    wide = frequent[:PAIR_WORDS]
    paired = cut(text.mapInArrow(_pair_counts(wide), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")), "importance-pairs")
    key = np.sort(np.array([r["pair"] for r in _frequent(paired, pairs).collect()], np.int64))
    return Head(frequent, np.stack((key // len(wide), key % len(wide)), axis=1), buckets)


# ---------------------------------------------------------------- totals and gains
def _totals(head):
    def run(batches):
        total = np.zeros(head.value.buckets, np.int64)
        for b in batches:
            for _, lists, old in blocks(b):
                total += np.bincount(head.value.features(lists, old)[1], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return run


def bucket_totals(docs: DataFrame, head) -> np.ndarray:
    """How many features of ``docs`` are in each bucket; ``head`` is a broadcast Head."""
    out = np.zeros(head.value.buckets, np.int64)
    counted = docs.select("text").mapInArrow(_totals(head), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in counted.collect():  # one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source."""
    S, T, k = int(source.sum()), int(target.sum()), len(source)
    ratio = lambda s, t: float((t + 1) * (S + k)) / float((s + 1) * (T + k))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weights(head, gain):
    def run(batches):
        for b in batches:
            n_words, n_features, weight = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for rows, lists, old in blocks(b):
                row = np.array(rows)
                of, bucket = head.value.features(lists, old)
                np.add.at(n_words, row, [len(x) - k for x, k in zip(lists, old)])
                np.add.at(n_features, row, np.bincount(of, minlength=len(rows)))
                np.add.at(weight, row, np.bincount(of, gain[bucket], minlength=len(rows)).astype(np.int64))
            yield pa.record_batch(
                [column(b, "doc_id"), *map(pa.array, (n_words, n_features, weight))], names=["doc_id", "n_words", "n_features", "weight"]
            )

    return run


def importance(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight of every row of docs; ``target`` has a ``text``."""
    spark = docs.sparkSession
    texts = id_text(docs, id_col, text_col)
    head = spark.sparkContext.broadcast(learn_head(texts, buckets=buckets))
    gain = gains(bucket_totals(texts, head), bucket_totals(target.select(target["text"].cast("string").alias("text")), head))
    return texts.mapInArrow(_weights(head, gain), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


# ---------------------------------------------------------------- the draw
def draw(weighted: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``weighted`` plus score and rank: 1, 2, 3, ... of the drawn rows, null of the others."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    fit = F.col("n_words") >= least_words
    scored = cut(weighted.withColumns({"score": F.col("weight") + noise, "unfit": ~fit}), "importance-scores")
    # the last key parts equal rows, which would be one task's work
    order = ["unfit", F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features"), F.rand(seed)]
    number = F.monotonically_increasing_id()  # the sorted partition's number above 33 bits of the row's
    ordered = cut(scored.orderBy(*order).withColumn("number", number), "importance-order")
    part = F.shiftright("number", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), F.count(F.when(~F.col("unfit"), 1)).alias("fit"))
    before, drawn, starts = 0, 0, []
    for r in sorted(counts.collect()):  # one row a partition
        starts.append((r["part"], before))
        before, drawn = before + r["rows"], drawn + r["fit"]
    drawn = percent * drawn // 100
    starts = weighted.sparkSession.createDataFrame(starts, "part bigint, before bigint")
    rank = F.col("before") + F.col("number").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    placed = ordered.withColumn("part", part).join(F.broadcast(starts), "part")  # one row a partition
    return placed.select(*weighted.columns, "score", F.when(~F.col("unfit") & (rank <= drawn), rank).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, **columns: str) -> DataFrame:
    """Every row's doc_id, n_words, n_features, weight, score and rank."""
    return draw(importance(docs, target, **columns), percent)
