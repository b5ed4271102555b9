"""Document fingerprints: improbable-feature digests of whole texts.

Features are all windows of 16 bytes.  A window's precedence is how rare its
entropy is among the windows of all documents (a histogram of 1001 numbers,
summed in Spark).  In each run of 16 neighbouring windows the rarest gets a
vote, the leftmost on ties; windows with enough votes are selected, hashed and
put into a chain of Bloom filters of 2048 bits, a new one after every 160.
Likeness of two digests: each filter of the shorter one against its best match
in the other, by common bits above what chance gives, over the most possible.

Defined results: a null or empty text has the empty digest, like itself (1)
and unlike others (0); a text that selects no window has all its windows of 4 bytes
as features, or itself if it is shorter; rows are fingerprinted each on its own, in descending doc_id, equal
ids by ascending text, a null id after all others; an empty table gives no
rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import chunks, column, id_text, partitions, sampled, utf8

WINDOW = 16
NEIGHBOURS = 16
VOTES = 5
#: A text that selects no window has all its windows of this size as features.
SHORT_WINDOW = 4
#: Windows of a lower entropy (of 1000) are never selected: runs of one byte are no mark of a document.
LEAST_ENTROPY = 100
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
BINS = 1001
MAX_BUCKETS = 4096
#: Characters of a text by which the rows of one id are parted, and rows that are looked at per part.
HEAD_CHARS = 64
PART_SAMPLE = 20
_CHUNK = 1 << 18

# Growth of the sum of c*log2(c) when a byte's count in the window goes from c to c+1, as integers.
_UNIT = 1 << 16
_F = [round(c * math.log2(c) * _UNIT) if c else 0 for c in range(WINDOW + 1)]
_GROWTH = np.diff(np.array(_F, np.int64))


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy, from 0 to 1000, of each window."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    earlier, later = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        earlier[d:] += same
        later[:-d] += same
    enter, leave = _GROWTH[earlier], _GROWTH[later]
    total = np.empty(n, np.int64)
    total[0] = enter[:WINDOW].sum()
    np.cumsum(enter[WINDOW:] - leave[: n - 1], out=total[1:])
    total[1:] += total[0]
    most = int(math.log2(WINDOW) * WINDOW * _UNIT)
    return (most - total) * (BINS - 1) // most


def _histogram(batches):
    total = np.zeros(BINS, np.int64)
    for b in batches:
        data, off = utf8(column(b, "text"))
        for lo, hi in chunks(off, _CHUNK):
            o = off[lo : hi + 1] - off[lo]
            e = entropies(data[off[lo] : off[hi]])
            total += np.bincount(e[K.inside(o, WINDOW)], minlength=BINS)
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["entropy", "n"])


def precedence(docs: DataFrame) -> list[int]:
    """Rank of each entropy from 0 to 1000, rarest first, over all windows of all texts."""
    counts = id_text(docs).select("text").mapInArrow(_histogram, "entropy int, n bigint")
    n = {r["entropy"]: r["n"] for r in counts.groupBy("entropy").agg({"n": "sum"}).toDF("entropy", "n").collect()}
    order = sorted(range(BINS), key=lambda e: (n.get(e, 0), e))
    rank = [0] * BINS
    for i, e in enumerate(order):
        rank[e] = i if e >= LEAST_ENTROPY else BINS
    return rank


class Digest:
    """Features and Bloom filters (rows of 32 words) of a text."""

    __slots__ = ("features", "filters", "ones")

    def __init__(self, features: int, filters: np.ndarray):
        self.features, self.filters = features, filters
        self.ones = np.bitwise_count(filters).sum(axis=1, dtype=np.int64)

    def text(self) -> str:
        return f"{self.features}:{self.filters.tobytes().hex()}" if self.features else ""


def _digest(features: np.ndarray) -> Digest:
    n = len(features)
    filters = -(-n // FILTER_FEATURES)
    bits = np.zeros(filters * FILTER_BITS, np.uint8)
    base = np.arange(n) // FILTER_FEATURES * FILTER_BITS
    width = FILTER_BITS.bit_length() - 1
    for k in range(HASHES):
        bits[base + ((features >> K.U(k * width)) & K.U(FILTER_BITS - 1)).astype(np.int64)] = 1
    return Digest(n, np.packbits(bits, bitorder="little").view(np.uint64).reshape(filters, FILTER_BITS // 64))


def likeness(a: Digest, b: Digest) -> float:
    if not a.features or not b.features:
        return float(a.features == b.features)
    if (len(a.filters), a.features) > (len(b.filters), b.features):
        a, b = b, a
    score = 0.0
    for i, f in enumerate(a.filters):
        common = np.bitwise_count(b.filters & f).sum(axis=1, dtype=np.int64)
        chance = a.ones[i] * b.ones / FILTER_BITS
        most = np.minimum(a.ones[i], b.ones) - chance
        own = np.where(most > 0, (common - chance) / np.where(most > 0, most, 1), common == a.ones[i])
        score += max(0.0, float(own.max())) * min(FILTER_FEATURES, a.features - i * FILTER_FEATURES)
    return min(1.0, score / a.features)


def digests(texts: list[bytes], rank: np.ndarray) -> list[Digest]:
    """Digests of many texts at once."""
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    out: list[Digest] = []
    for lo, hi in chunks(off, _CHUNK):
        o = off[lo : hi + 1] - off[lo]
        d = data[off[lo] : off[hi]]
        ranks = rank[entropies(d)]
        n = len(ranks)
        valid = K.inside(o, WINDOW) if n else np.zeros(0, bool)
        # rank and place in one number: the least is the rarest, leftmost; windows across texts come last
        place = np.where(valid, ranks, 2 * BINS).astype(np.int64) << 40 | np.arange(n)
        least = K.sliding_min(place, NEIGHBOURS)
        run = K.inside(o, WINDOW + NEIGHBOURS - 1)[: len(least)]
        votes = np.bincount(least[run] & ((1 << 40) - 1), minlength=n) if run.any() else np.zeros(n, np.int64)
        chosen = np.flatnonzero((votes >= VOTES) & valid & (ranks < BINS)) if n else np.zeros(0, np.int64)
        sums = K.prefix_sums(d.astype(K.U) + K.U(1), K.BYTE_BASES[0])
        hashes = K.range_hash(sums, chosen, chosen + WINDOW, K.BYTE_BASES[0])
        edges = np.searchsorted(chosen, o)
        for i in range(hi - lo):
            if o[i] == o[i + 1]:
                out.append(_digest(hashes[:0]))
                continue
            own = hashes[edges[i] : edges[i + 1]]
            if not len(own):
                at = np.arange(o[i], max(o[i] + 1, o[i + 1] - SHORT_WINDOW + 1))
                own = K.range_hash(sums, at, np.minimum(at + SHORT_WINDOW, o[i + 1]), K.BYTE_BASES[0])
            first = np.unique(own, return_index=True)[1]
            out.append(_digest(own[np.sort(first)]))
    return out


# ---------------------------------------------------------------- a text, its edit and the next text
def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the next one's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(rank):
    def run(batches):
        ranks = np.array(rank, np.int64)
        last = None  # (doc_id, text, digest) that waits for the next one
        for b in batches:
            ids, halo = column(b, "doc_id").to_pylist(), column(b, "halo").to_pylist()
            data, off = utf8(column(b, "text"))
            for lo, hi in chunks(off, 4 * _CHUNK):
                raw = [data[x:y].tobytes() for x, y in zip(off[lo:hi], off[lo + 1 : hi + 1])]
                own = list(zip(ids[lo:hi], halo[lo:hi], [r.decode() for r in raw], digests(raw, ranks)))
                pairs = []
                for row in own:
                    if last is not None:
                        pairs.append((last, row))
                    last = None if row[1] else row
                edits = [edited(x[2], y[2]).encode() for x, y in pairs]
                new = digests(edits, ranks)
                yield pa.record_batch(
                    [
                        pa.array([x[0] for x, _ in pairs], pa.int64()),
                        pa.array([len(x[2]) for x, _ in pairs], pa.int64()),
                        pa.array([hashlib.sha256(e).hexdigest() for e in edits], pa.string()),
                        pa.array([x[3].text() for x, _ in pairs], pa.string()),
                        pa.array([n.text() for n in new], pa.string()),
                        pa.array([likeness(x[3], n) for (x, _), n in zip(pairs, new)], pa.float64()),
                        pa.array([likeness(x[3], y[3]) for x, y in pairs], pa.float64()),
                    ],
                    names=_COMPARED,
                )

    return run


_COMPARED = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _bucket(key, bounds: list[int]):
    """How many of the ascending ``bounds`` are below ``key``, looked up in two steps."""
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda a: F.size(F.filter(a, lambda x: x < key))
    literal = lambda v: F.array(*[F.lit(x).cast("bigint") for x in v])
    whole = below(literal([g[-1] for g in groups]))  # groups that are below as a whole
    rest = F.element_at(F.array(*map(literal, [*groups, []])), (whole + 1).cast("int"))
    return (whole * step + below(rest)).cast("int")


def _heads(keyed: DataFrame, hot: dict[int, int], share: float) -> dict[int, list[str]]:
    """For each hot id, ascending beginnings of texts that part its rows into about so many even parts.

    They come from the sampled rows' distinct beginnings with their counts: about
    ``PART_SAMPLE`` rows per part, however often a row is repeated.
    """
    rows = keyed.where(F.col("key").isin(*hot) & sampled(F.xxhash64("key", "head"), share))
    found: dict[int, list[tuple[str, int]]] = {}
    for r in rows.groupBy("key", "head").count().collect():
        found.setdefault(r["key"], []).append((r["head"], r["count"]))
    out = {}
    for key, heads in found.items():
        heads.sort()  # by code points, as Spark orders UTF-8
        part = max(1, sum(n for _, n in heads) / hot[key])
        cuts, seen = [], 0.0
        for head, n in heads:
            seen += n
            if seen >= part:
                cuts.append(head)
                seen = 0.0
        out[key] = cuts
    return out


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in buckets of neighbouring ids, each bucket with the first row of the next lower one (``halo``) at its end.

    Texts move once, to their bucket; buckets are even because their bounds are
    approximate quantiles of the ids.  An id that fills several buckets (null
    ids, say) has its rows parted by the beginnings of their texts; rows that share
    the id and the first ``HEAD_CHARS`` characters stay together.
    """
    spark = docs.sparkSession
    lowest = F.lit(-(1 << 63)).cast("bigint")
    head = F.substring(F.coalesce("text", F.lit("")), 1, HEAD_CHARS)
    keyed = id_text(docs).withColumn("key", F.coalesce("doc_id", lowest))
    n = min(MAX_BUCKETS, 8 * partitions(spark))
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    of_ids = keyed.select(F.percentile_approx("key", shares, F.lit(20 * n)).alias("b"), F.count("*").alias("n")).first()
    bounds = of_ids["b"] or []
    hot = {k: times + 1 for k, times in Counter(bounds).items() if times > 1 and of_ids["n"] > n}
    bucket = _bucket(F.col("key"), sorted(set(bounds)) or [0]).cast("bigint")
    if hot:
        many = of_ids["n"] * sum(hot.values()) / n
        cuts = _heads(keyed.withColumn("head", head), hot, min(1.0, PART_SAMPLE * n / many))
        parts = 2 + max(map(len, cuts.values()), default=0)
        # the top id of a bucket comes first, by ascending text; the bucket's other ids are its last part
        own = F.lit(None).cast("array<string>")
        for k, c in cuts.items():
            own = F.when(F.col("key") == k, F.array(*map(F.lit, c)).cast("array<string>")).otherwise(own)
        part = F.coalesce(F.size(F.filter(own, lambda x: x < head)), F.lit(-1))
        bucket = bucket * parts + F.when(part >= 0, parts - 1 - part).otherwise(0)
    placed = keyed.withColumn("bucket", bucket)
    first = {r["bucket"]: r["top"] for r in placed.groupBy("bucket").agg(F.max("key").alias("top")).collect()}
    used = sorted(first)
    to = [(b, first[b], used[i + 1] if i + 1 < len(used) else used[0]) for i, b in enumerate(used)]
    tops = spark.createDataFrame(to, "bucket bigint, key bigint, target bigint")  # at most 2 * MAX_BUCKETS rows
    halo = (
        placed.join(F.broadcast(tops), ["bucket", "key"])
        .groupBy(F.col("target").alias("bucket"))
        .agg(F.max("doc_id").alias("doc_id"), F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("key").alias("key"))
    )
    both = placed.withColumn("halo", F.lit(False)).unionByName(halo.withColumn("halo", F.lit(True)))
    return (
        both.repartition(partitions(spark), "bucket")
        .sortWithinPartitions("bucket", "halo", F.desc("key"), "text")
        .select("doc_id", "text", "halo")
    )


def compare_with_next(docs: DataFrame, rank: list[int] | None = None) -> DataFrame:
    """Per row: its digest, that of its edit with the next row's text, and its likeness to both."""
    rank = rank or precedence(docs)
    return with_next(docs).mapInArrow(
        _compare(rank),
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
