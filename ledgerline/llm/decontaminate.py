"""Benchmark decontamination: size-partitioned MinHash containment search.

Items and documents are sets of word shingles (five words, A-Z lower-cased).
A document is contaminated by an item if it holds at least ``threshold`` of the
item's distinct shingles.  Items are partitioned by size (powers of two); a
partition whose largest item has u shingles represents each item by its
floor((1 - threshold) * u) + 1 least hashes.  A document that lacks no more
than (1 - threshold) of the item's shingles must hold one of those, so that no
match is lost, however long the document; partitions whose items are too large
for a document are skipped.  Candidates are verified by exact containment of
the shingles' texts.

Items of up to ``block_bytes`` of text go to the tasks as they are.  A larger
benchmark stays in Spark: sketch hashes join the documents' distinct shingle
hashes, and the candidates' shingles are joined as texts and counted.  Both ways
give the same pairs; no limit on the benchmark's size, its items or matches.

Defined results: null ids match nothing and are not reported; a null or empty
text has no shingles; items of fewer than ``shingle`` words match nothing
(``unsearchable`` returns their ids);
items that share an id are one item each, repeated rows count once; empty
tables give no rows; columns other than ids and texts are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import chunks, column, cut, id_text, utf8

SHINGLE = 5
THRESHOLD = 0.8
#: Bytes of item texts that are sent to every task; more are searched by joins.
BLOCK_BYTES = 16 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _shingle_hashes(data: np.ndarray, off: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every shingle."""
    start, end, first = K.words(data, off)
    h = K.window_hashes(K.word_hashes(_LOWER[data], start, end), shingle)
    at = np.flatnonzero(K.inside(first, shingle))
    return h[at], np.searchsorted(first, at, side="right") - 1


def _shingles(text: bytes, shingle: int) -> set[bytes]:
    w = text.lower().split()
    return {b" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)}


class Block:
    """Sketches of a block of items, by size partition."""

    def __init__(self, items: list[tuple[int, bytes]], shingle: int, threshold: float):
        self.items, self.shingle, self.threshold = items, shingle, threshold
        self._texts: dict[int, set[bytes]] = {}
        raw = [t for _, t in items]
        off = np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64)
        h, owner = _shingle_hashes(np.frombuffer(b"".join(raw), np.uint8), off, shingle)
        edges = np.searchsorted(owner, np.arange(len(items) + 1))
        sets = {int(i): np.unique(h[edges[i] : edges[i + 1]]) for i in np.unique(owner)}
        groups: dict[int, list[int]] = {}
        for i, s in sets.items():
            groups.setdefault(len(s).bit_length(), []).append(i)
        #: (least shingles that a matching document has, sorted sketch hashes, their items)
        self.parts = []
        for _, members in sorted(groups.items()):
            sizes = [len(sets[i]) for i in members]
            keep = max(sizes) - self._needed(max(sizes)) + 1
            sketch = [(x, i) for i in members for x in sets[i][:keep].tolist()]
            sketch.sort()
            hashes = np.array([x for x, _ in sketch], np.uint64)
            self.parts.append((self._needed(min(sizes)), hashes, np.array([i for _, i in sketch], np.int64)))

    def shingles(self, i: int) -> set[bytes]:
        """Texts of an item's shingles."""
        if i not in self._texts:
            self._texts[i] = _shingles(self.items[i][1], self.shingle)
        return self._texts[i]

    def _needed(self, size: int) -> int:
        """Shingles of an item of ``size`` that a match has."""
        return max(1, math.ceil(self.threshold * size - 1e-9))

    def candidates(self, h: np.ndarray, text: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs that share a sketch hash."""
        out: set[tuple[int, int]] = set()
        sizes = np.bincount(text) if len(text) else np.zeros(0, np.int64)
        for least, hashes, items in self.parts:
            lo = np.searchsorted(hashes, h)
            hit = np.flatnonzero((lo < len(hashes)) & (hashes[np.minimum(lo, len(hashes) - 1)] == h) & (sizes[text] >= least))
            hi = np.searchsorted(hashes, h[hit], side="right")
            for t, x, y in zip(text[hit].tolist(), lo[hit].tolist(), hi.tolist()):
                out.update((t, int(i)) for i in items[x:y])
        return out


def _matches(block: Block, data: np.ndarray, off: np.ndarray):
    """(text, item, common shingles, the item's shingles) of every match in a chunk of texts."""
    by_text: dict[int, list[int]] = {}
    for t, i in block.candidates(*_shingle_hashes(data, off, block.shingle)):
        by_text.setdefault(t, []).append(i)
    for t, candidates in sorted(by_text.items()):
        has = _shingles(data[off[t] : off[t + 1]].tobytes(), block.shingle)
        for i in candidates:
            want = block.shingles(i)
            common = len(want & has)
            if common >= block._needed(len(want)):
                yield t, i, common, len(want)


def _search(items, shingle, threshold):
    def run(batches):
        block = Block(items, shingle, threshold)
        for b in batches:
            ids = column(b, "doc_id")
            data, off = utf8(column(b, "text"))
            for lo, hi in chunks(off):
                found = [
                    (ids[lo + t].as_py(), block.items[i][0], common, n)
                    for t, i, common, n in _matches(block, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                ]
                if found:
                    yield pa.record_batch(
                        [pa.array(c, pa.int64()) for c in zip(*found)],
                        names=["doc_id", "item_id", "n_common", "n_shingles"],
                    )

    return run


def _clean(items, shingle, threshold, text_col):
    def run(batches):
        block = Block(items, shingle, threshold)
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            data, off = utf8(column(b, text_col))
            for lo, hi in chunks(off):
                for t, *_ in _matches(block, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]):
                    keep[lo + t] = False
            yield b.filter(pa.array(keep))

    return run


def _probes(items: DataFrame) -> DataFrame:
    """The distinct items, written once."""
    return cut(id_text(items, "item_id").where("doc_id is not null and text is not null").distinct(), "benchmark-items")


def _block(probes: DataFrame, block_bytes: int) -> list[tuple[int, bytes]] | None:
    """All items for the tasks, or None where they have more than ``block_bytes`` of text."""
    size = probes.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return sorted((r["doc_id"], r["text"].encode()) for r in probes.toLocalIterator()) if size <= block_bytes else None


# ---------------------------------------------------------------- benchmarks beyond one block
def _needed(n, threshold: float):
    """Shingles of an item of ``n`` that a match has."""
    return F.greatest(F.lit(1), F.ceil(n * threshold - 1e-9))


def _hash_rows(shingle: int, threshold: float | None = None):
    """key, hash and number n of the distinct shingles of each text, or only of its sketch (``threshold``)."""

    def run(batches):
        for b in batches:
            keys = column(b, "key")
            data, off = utf8(column(b, "text"))
            for lo, hi in chunks(off):
                h, owner = _shingle_hashes(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], shingle)
                edges = np.searchsorted(owner, np.arange(hi - lo + 1))
                sets = [np.unique(h[x:y]) for x, y in zip(edges[:-1], edges[1:])]
                sizes = np.array([len(x) for x in sets], np.int64)
                if threshold is not None:
                    most = [len(x) - max(1, math.ceil(threshold * len(x) - 1e-9)) + 1 if len(x) else 0 for x in sets]
                    sets = [x[:m] for x, m in zip(sets, most)]
                kept = np.array([len(x) for x in sets], np.int64)
                at = pa.array(np.repeat(np.arange(lo, hi), kept))
                hashes = np.concatenate(sets).view(np.int64)
                for x in range(0, len(hashes), _ROWS):
                    yield pa.record_batch(
                        [keys.take(at[x : x + _ROWS]), pa.array(hashes[x : x + _ROWS]), pa.array(np.repeat(sizes, kept)[x : x + _ROWS])],
                        names=["key", "h", "n"],
                    )

    return run


def _text_rows(shingle: int):
    """key and text of the distinct shingles of each text."""

    def run(batches):
        for b in batches:
            for key, text in zip(column(b, "key").to_pylist(), column(b, "text").to_pylist()):
                found = sorted(_shingles(text.encode(), shingle))
                for x in range(0, len(found), _ROWS):
                    part = found[x : x + _ROWS]
                    yield pa.record_batch([pa.array([key] * len(part), pa.binary()), pa.array(part, pa.binary())], names=["key", "shingle"])

    return run


#: Rows of a batch that a task hands on.
_ROWS = 1 << 16


def _key(text):
    """A text's key: its MD5, null for a null text."""
    return F.unhex(F.md5(text.cast("binary")))


def _joined_pairs(texts: DataFrame, probes: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """key of a text, item_id, n_common, n_shingles of every match, by joins of hashes; items in any number.

    Sketches join the texts' distinct shingle hashes; the candidates' shingles
    are then joined and counted as texts.  Equal texts are one.
    """
    hashes, strings = "key binary, h bigint, n bigint", "key binary, shingle binary"
    items = probes.select(_key(F.col("text")).alias("key"), F.col("doc_id").alias("item_id"), "text")
    single = items.groupBy("key").agg(F.first("text").alias("text"))
    sketch = single.mapInArrow(_hash_rows(shingle, threshold), hashes).toDF("item", "h", "size")
    texts = texts.where(F.octet_length("text") > 0).select(_key(F.col("text")).alias("key"), "text")
    near = texts.mapInArrow(_hash_rows(shingle), hashes).join(sketch, "h").where(F.col("n") >= _needed(F.col("size"), threshold))
    candidates = cut(near.select("key", "item").distinct(), "contamination-candidates")
    wanted = single.mapInArrow(_text_rows(shingle), strings).toDF("item", "shingle")
    sizes = wanted.groupBy("item").agg(F.count("*").alias("n_shingles"))
    searched = texts.join(candidates.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    has = searched.mapInArrow(_text_rows(shingle), strings)
    common = candidates.join(wanted, "item").join(has, ["key", "shingle"]).groupBy("key", "item").agg(F.count("*").alias("n_common"))
    found = common.join(sizes, "item").where(F.col("n_common") >= _needed(F.col("n_shingles"), threshold))
    ids = items.select(F.col("key").alias("item"), "item_id")
    return found.join(ids, "item").select("key", "item_id", "n_common", "n_shingles")


def contamination_pairs(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, item_id, n_common, n_shingles, containment of every contaminated pair."""
    texts = id_text(docs).where(F.col("doc_id").isNotNull())
    probes = _probes(items)
    block = _block(probes, block_bytes)
    if block is not None:
        schema = "doc_id bigint, item_id bigint, n_common bigint, n_shingles bigint"
        pairs = texts.mapInArrow(_search(block, shingle, threshold), schema)
    else:
        found = _joined_pairs(texts, probes, shingle, threshold)
        pairs = texts.select("doc_id", _key(F.col("text")).alias("key")).distinct().join(found, "key").drop("key")
    return (
        pairs.groupBy("doc_id", "item_id")
        .agg(F.max_by(F.struct("n_common", "n_shingles"), F.col("n_common") / F.col("n_shingles")).alias("m"))
        .select("doc_id", "item_id", "m.*", (F.col("m.n_common") / F.col("m.n_shingles")).alias("containment"))
    )


def unsearchable(items: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Distinct item_id of the items that match nothing, as their texts have fewer than ``shingle`` words or are null."""
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    found = id_text(items, "item_id").where(F.col("doc_id").isNotNull() & (words < shingle))
    return found.select(F.col("doc_id").alias("item_id")).distinct()


def contaminated(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """Per contaminated document: doc_id, sorted item_ids, and the best containment."""
    return (
        contamination_pairs(docs, items, shingle, threshold)
        .groupBy("doc_id")
        .agg(
            F.sort_array(F.collect_list("item_id")).alias("item_ids"),
            F.max("containment").alias("containment"),
        )
    )



def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of docs, all columns, that no item contaminates (also rows without id)."""
    probes = _probes(items)
    block = _block(probes, block_bytes)
    if block is not None:
        return docs.mapInArrow(_clean(block, shingle, threshold, text_col), docs.schema) if block else docs
    text = docs[text_col].cast("string")
    found = _joined_pairs(docs.select(text.alias("text")), probes, shingle, threshold).select(F.col("key").alias("_found")).distinct()
    return docs.join(found, _key(text) == found["_found"], "left_anti")
