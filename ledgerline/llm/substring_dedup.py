"""Substring dedup: Rabin-Karp hashes of every window of ``window`` words, counted in Spark.

A word goes if a window that covers it also starts in a document with a
smaller doc_id.  Steps, all over whole texts:

1. Documents with the same word sequence: all but the smallest doc_id are
   repeats as a whole, so only one text of each such group goes on.
2. Every window has a fingerprint, the least hash of the short word pieces in
   it (winnowing); equal windows have equal fingerprints.  Fingerprints are
   counted; a window whose fingerprint occurs in one document only cannot be
   repeated and is not shuffled.
3. The 128-bit Rabin-Karp hashes of all other windows are counted, and each
   repeated one gets its first document.
4. Later occurrences merge into maximal removal spans of words.

Defined results: a null text has no words; a null doc_id is never a source and
its row stays whole; rows that share a doc_id are one document for the rule
"smaller doc_id" and each keeps its own row; an empty table gives no rows;
columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import chunks, column, cut, id_text, lists, utf8

WINDOW = 50
#: Words in the pieces whose least hash is a window's fingerprint.
PIECE = 8

SPAN = "array<struct<start:bigint,end:bigint>>"


def _texts(batch, name="text"):
    """(first row, offsets, bytes) of each chunk of a batch's texts."""
    data, off = utf8(column(batch, name))
    for lo, hi in chunks(off):
        yield lo, hi, off[lo : hi + 1] - off[lo], data[off[lo] : off[hi]]


def _fingerprints(hashes, text_starts, window, piece):
    """Per window inside a text: its position, text and least piece hash."""
    least = K.sliding_min(K.window_hashes(hashes, piece), window - piece + 1)
    at = np.flatnonzero(K.inside(text_starts, window))
    return at, np.searchsorted(text_starts, at, side="right") - 1, least[at]


def _scan(window, piece):
    def run(batches):
        for b in batches:
            ids = column(b, "doc_id")
            for lo, hi, off, data in _texts(b):
                start, end, first = K.words(data, off)
                _, text, least = _fingerprints(K.word_hashes(data, start, end), first, window, piece)
                new = np.ones(len(least), bool)
                new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
                raw = data.tobytes()
                sha = [hashlib.sha256(b" ".join(raw[x:y].split())).digest() for x, y in zip(off[:-1], off[1:])]
                yield pa.record_batch(
                    [
                        ids.slice(lo, hi - lo),
                        pa.array([int.from_bytes(x[:8], "little", signed=True) for x in sha], pa.int64()),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(sha, pa.binary()),
                        lists(least[new].view(np.int64), np.bincount(text[new], minlength=hi - lo), pa.int64()),
                    ],
                    names=["doc_id", "row_key", "n_words", "sha", "fingerprints"],
                )

    return run


def _windows(window, piece):
    """Hashes of the windows whose fingerprint is in the row's ``shared``."""

    def run(batches):
        for b in batches:
            ids, keys = column(b, "doc_id").to_numpy(zero_copy_only=False), column(b, "row_key").to_numpy(zero_copy_only=False)
            shared = column(b, "shared")
            s_off = np.asarray(shared.offsets) - np.asarray(shared.offsets)[0]
            s_val = np.asarray(shared.flatten()).view(K.U)
            for lo, _hi, off, data in _texts(b):
                start, end, first = K.words(data, off)
                h = K.word_hashes(data, start, end)
                at, text, least = _fingerprints(h, first, window, piece)
                take = np.zeros(len(at), bool)
                edges = np.searchsorted(text, np.arange(len(off)))
                for i in np.unique(text):
                    x, y = edges[i], edges[i + 1]
                    take[x:y] = np.isin(least[x:y], s_val[s_off[lo + i] : s_off[lo + i + 1]])
                at, text = at[take], text[take]
                if len(at):
                    w0 = K.window_hashes(h, window)[at]
                    w1 = K.window_hashes(K.word_hashes(data, start, end, 1), window, 1)[at]
                    yield pa.record_batch(
                        [
                            pa.array(w0.view(np.int64)),
                            pa.array(w1.view(np.int64)),
                            pa.array(ids[lo + text], pa.int64()),
                            pa.array(keys[lo + text], pa.int64()),
                            pa.array((at - first[text]).astype(np.int32)),
                        ],
                        names=["w0", "w1", "doc_id", "row_key", "at"],
                    )

    return run


def merge_spans(at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans covered by the windows that start at ``at``."""
    at = np.unique(at)
    if not len(at):
        return at, at
    gap = np.flatnonzero(np.diff(at) > window)
    return at[np.concatenate(([0], gap + 1))], at[np.concatenate((gap, [len(at) - 1]))] + window


def _remove(window):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                word = (row["text"] or "").encode().split()
                lo, hi = merge_spans(np.array(row["repeats"], np.int64), window)
                kept, last = [], 0
                for x, y in zip(lo.tolist(), hi.tolist()):
                    kept += word[last:x]
                    last = y
                kept += word[last:]
                yield pa.record_batch(
                    [
                        pa.array([row["doc_id"]], pa.int64()),
                        pa.array([row["row_key"]], pa.int64()),
                        pa.array([[{"start": x, "end": y} for x, y in zip(lo.tolist(), hi.tolist())]],
                                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array([hashlib.sha256(b" ".join(kept)).hexdigest()]),
                    ],
                    names=["doc_id", "row_key", "spans", "kept_sha256"],
                )

    return run


def removal_spans(docs: DataFrame, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """Per row: doc_id, row_key (of the word sequence), n_words, spans of removed words, kept_sha256."""
    piece = min(piece, window)
    texts = id_text(docs)
    rows = cut(
        texts.mapInArrow(
            _scan(window, piece),
            "doc_id bigint, row_key bigint, n_words bigint, sha binary, fingerprints array<bigint>",
        ),
        "windows-rows",
    )
    long_rows = rows.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    first = cut(long_rows.groupBy("sha").agg(F.min("doc_id").alias("first")), "windows-copies")
    marked = rows.join(first, "sha", "left").withColumn(
        "copy", (F.col("n_words") >= window) & F.col("doc_id").isNotNull() & (F.col("doc_id") > F.col("first"))
    )
    one = (
        long_rows.join(first, "sha")
        .where("doc_id = first")
        .select("doc_id", "row_key", F.explode("fingerprints").alias("fp"))
    )
    shared = cut(
        one.groupBy("fp").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("fp"),
        "windows-fingerprints",
    )
    by_doc = one.join(shared, "fp").groupBy("doc_id").agg(F.collect_set("fp").alias("shared"))
    candidates = cut(
        texts.join(by_doc, "doc_id").mapInArrow(
            _with_key, "doc_id bigint, row_key bigint, text string, shared array<bigint>"
        ),
        "windows-texts",
    )
    hashes = candidates.mapInArrow(_windows(window, piece), "w0 bigint, w1 bigint, doc_id bigint, row_key bigint, at int")
    repeated = cut(
        hashes.groupBy("w0", "w1")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("w0", "w1", "first"),
        "windows-repeated",
    )
    later = (
        hashes.join(repeated, ["w0", "w1"])
        .where("doc_id > first")
        .groupBy("doc_id", "row_key")
        .agg(F.collect_set("at").alias("repeats"))
    )
    cleaned = (
        candidates.drop("shared")
        .join(later, ["doc_id", "row_key"])
        .dropDuplicates(["doc_id", "row_key"])
        .mapInArrow(_remove(window), f"doc_id bigint, row_key bigint, spans {SPAN}, kept_sha256 string")
    )
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("end")))
    none = F.array().cast(SPAN)
    copy = F.coalesce(F.col("copy"), F.lit(False))
    return marked.join(cleaned, ["doc_id", "row_key"], "left").select(
        "doc_id",
        "row_key",
        "n_words",
        F.when(copy, everything).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha"))))
        .alias("kept_sha256"),
    )


def _key_of(raw: bytes) -> int:
    return int.from_bytes(hashlib.sha256(b" ".join(raw.split())).digest()[:8], "little", signed=True)


def _with_key(batches):
    """Give each row the key that _scan gives it."""
    for b in batches:
        keys = [_key_of((x or "").encode()) for x in column(b, "text").to_pylist()]
        yield pa.record_batch(
            [column(b, "doc_id"), pa.array(keys, pa.int64()), column(b, "text"), column(b, "shared")],
            names=["doc_id", "row_key", "text", "shared"],
        )


def kept_texts(docs: DataFrame, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """Per row: doc_id and its kept words joined by one space."""
    texts = id_text(docs)
    spans = removal_spans(docs, window, piece).dropDuplicates(["doc_id", "row_key"]).select("doc_id", "row_key", "spans")
    word = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    keyed = texts.withColumn("shared", F.array().cast("array<bigint>")).mapInArrow(
        _with_key, "doc_id bigint, row_key bigint, text string, shared array<bigint>"
    )
    on = keyed["doc_id"].eqNullSafe(spans["doc_id"]) & (keyed["row_key"] == spans["row_key"])
    joined = keyed.join(spans, on).select(keyed["doc_id"], F.coalesce("text", F.lit("")).alias("text"), "spans")
    kept = F.filter(
        word, lambda w, i: ~F.exists("spans", lambda s: (s["start"] <= i) & (i < s["end"]))
    )
    return joined.select("doc_id", F.array_join(kept, " ").alias("text"))


def substring_dedup(docs: DataFrame, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """removal_spans with the number of removed words."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return removal_spans(docs, window, piece).withColumn("n_removed", removed)
