"""Filter interaction audit: what five filters remove together, alone, and in every order.

Each document becomes a 32-bit truth-table word: bit S is 1 if the document
survives the subset S of the filters, which is the case if it fails none of
them.  Positional popcounts of the words give, for each part and label, how
many documents survive each subset; all orders, overlaps and Shapley sums follow
from those 32 numbers by subtraction.

1. Arrow tasks read whole texts once and keep four failure bits and 128 bits of
   the text's SHA-256.
2. Exact copies: the least doc_id of each repeated digest joins back to its
   documents; labels join by doc_id.  Both tables hold one row per key, and Spark
   splits the documents' side where one key has many of them.
3. Carry-save adders reduce each batch of words, per part and label, to two words
   a weight before any bit is looked at; Spark sums the partial counts.

Defined results: a null text is an empty one, so that the two are copies of each
other; a null lang is the part ""; a null doc_id has no label, is no copy and
makes none; rows that share a doc_id count each, and none of them is a copy of
another; repeated labels count once (1 if any of them is 1), null labels as 0;
an empty table gives no rows; columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
import json
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, cut, utf8

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
LEAST_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10
SYMBOLS = b"#$%&*|"
_CAPITALS = bytes(range(0x41, 0x5B))
_INNER = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that start no code point
DUPLICATE = 1 << FILTERS.index("E")

#: Of each set of failed filters, the word whose bit S says that no filter of S is among them.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & fails) for fails in range(SUBSETS)], np.uint32)


def text_failures(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails; words end at 0x20 and 0x09 to 0x0D, as bytes.split() has it."""
    words = raw.split()
    n, distinct = len(words), len(set(words))
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    points = len(raw.translate(None, _INNER))
    return (
        (n < LEAST_WORDS)
        | (100 * distinct < DISTINCT_PERCENT * n) << 1
        | (100 * capitals > CAPITAL_PERCENT * points) << 2
        | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3
    )


def _scan(batches):
    for b in batches:
        data, off = utf8(column(b, "text"))
        at = off.tolist()
        raws = [data[x:y].tobytes() for x, y in zip(at[:-1], at[1:])]
        sha = np.frombuffer(b"".join(hashlib.sha256(r).digest()[:16] for r in raws), "<i8").reshape(-1, 2)
        fails = np.array([text_failures(r) for r in raws], np.int32)
        yield pa.record_batch(
            [column(b, "doc_id"), column(b, "part"), pa.array(fails), pa.array(sha[:, 0]), pa.array(sha[:, 1])],
            names=["doc_id", "part", "fails", "h1", "h2"],
        )


def document_failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part, fails of every row: bit i of ``fails`` is filter i of FILTERS, exact copies included."""
    rows = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"),
        F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
        docs[text_col].cast("string").alias("text"),
    )
    scanned = cut(rows.mapInArrow(_scan, "doc_id bigint, part string, fails int, h1 bigint, h2 bigint"), "audit-texts")
    first = scanned.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copied = cut(first.where("first < last").drop("last"), "audit-copies")
    fails = F.col("fails") + F.when(F.col("doc_id") > F.col("first"), DUPLICATE).otherwise(0)
    return scanned.join(copied, ["h1", "h2"], "left").select("doc_id", "part", fails.alias("fails"))


def survival_words(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part, word (unsigned 32 bits), good, toxic of every row."""
    flag = lambda c: F.max(F.coalesce(labels[c] == 1, F.lit(False)))
    marks = (
        labels.where(labels["doc_id"].isNotNull())
        .groupBy(labels["doc_id"].cast("bigint").alias("doc_id"))
        .agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    )
    failures = cut(document_failures(docs, id_col, text_col, part_col), "audit-failures")
    none = F.lit(False)
    known = failures.where("doc_id is not null").join(marks.where("good or toxic"), "doc_id", "left")
    unknown = failures.where("doc_id is null").withColumns({"good": none, "toxic": none})  # no join key, not one task's rows
    rows = known.select("doc_id", "part", "fails", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic"))
    table = F.array(*(F.lit(int(w)).cast("bigint") for w in WORDS))
    return rows.unionByName(unknown).select("doc_id", "part", F.get(table, "fails").alias("word"), "good", "toxic")


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """For each of the 32 bits, how many words have it, by a tree of carry-save adders."""
    counts, weight, level = np.zeros(32, np.int64), 1, words.astype(np.uint32)
    while len(level):
        carries = [level[:0]]
        while len(level) > 2:  # three words of one weight become a sum of that weight and a carry of twice as much
            k = len(level) // 3
            a, b, c = level[:k], level[k : 2 * k], level[2 * k : 3 * k]
            half = a ^ b
            carries.append(a & b | half & c)
            level = np.concatenate((half ^ c, level[3 * k :]))
        counts += weight * (level[:, None] >> np.arange(32, dtype=np.uint32) & 1).sum(axis=0, dtype=np.int64)
        level, weight = np.concatenate(carries), 2 * weight
    return counts


def _popcounts(batches):
    for b in batches:
        word = column(b, "word").to_numpy().astype(np.uint32)
        good, toxic = (column(b, k).to_numpy(zero_copy_only=False) for k in ("good", "toxic"))
        coded = column(b, "part").dictionary_encode()
        code, parts = coded.indices.to_numpy(), coded.dictionary
        out = []
        for k in range(len(parts)):
            mine = code == k
            out.append([positional_popcounts(word[mine & m]) for m in (True, good, toxic)])
        n = np.array(out, np.int64).reshape(len(parts), 3, SUBSETS)
        yield pa.record_batch(
            [
                parts.take(np.repeat(np.arange(len(parts)), SUBSETS)),
                pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), len(parts))),
                *(pa.array(n[:, i].ravel()) for i in range(3)),
            ],
            names=["part", "subset", "n", "good", "toxic"],
        )


def survivors(words: DataFrame) -> DataFrame:
    """part, subset (bit i: filter i of FILTERS), n, good, toxic: the documents of ``words`` that survive the subset."""
    counted = words.select("part", "word", "good", "toxic").mapInArrow(
        _popcounts, "part string, subset int, n bigint, good bigint, toxic bigint"
    )
    return counted.groupBy("part", "subset").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))


def _steps() -> list[tuple[str, int, int, int]]:
    """Order, step, and the subsets before it and of its filter, of all steps of all orders."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(FILTERS[i] for i in order), step, before, 1 << f))
            before |= 1 << f
    return out


STEPS = "array<struct<filter_order:string,step:int,before:int,own:int>>"


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order and step, from ``survivors``."""
    by_subset = lambda c: F.array_sort(F.collect_list(F.struct("subset", F.col(c).alias("k"))))["k"]
    table = counts.groupBy("part").agg(*(by_subset(c).alias(c) for c in ("n", "good", "toxic")))  # 32 numbers a part
    at = lambda c, subset: F.get(F.col(c), subset)
    before, own = F.col("before"), F.col("own")
    after, rest = before.bitwiseOR(own), F.lit(SUBSETS - 1) - own
    lost = lambda c: at(c, before) - at(c, after)
    every = Window.partitionBy("part", "own")
    steps = F.from_json(F.lit(json.dumps([dict(zip(("filter_order", "step", "before", "own"), s)) for s in _steps()])), STEPS)
    rows = table.withColumn("s", F.explode(steps)).select("part", "n", "good", "toxic", "s.*")
    return rows.select(
        "part",
        "filter_order",
        "step",
        at("n", after).alias("kept"),
        lost("n").alias("removed"),
        (at("n", F.lit(0)) - at("n", own) - lost("n")).alias("redundant"),
        (at("n", rest) - at("n", F.lit(SUBSETS - 1))).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.sum(lost("n")).over(every).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The interactions of all orders over the documents of each part."""
    return interactions(survivors(survival_words(docs, labels, id_col, text_col, part_col)))
