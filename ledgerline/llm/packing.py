"""Best-fit packing of tokenized documents into sequences, by minimum bin slack.

Documents are tokenized once, in Spark tasks; a document longer than a
sequence is cut into pieces of the full length, of which the first may be
shorter.  The plan needs only how many pieces there are of each length (at
most ``capacity`` numbers): for each sequence, the longest remaining piece is
taken and a bitset subset-sum over the available lengths finds the fullest
combination with it.  The combination is repeated as often as the counts
allow, so that the plan's size depends on the capacity, not on the documents.
Pieces are then numbered within their length, and their number gives sequence
and offset by arithmetic.  Numbering is dealt over (length, salt), so that a
length that a third of all pieces have is not one task's work.

Defined results: a null or empty text is its end token alone; rows are packed
each on its own, also repeated ones; an empty table gives no rows; columns
other than the id and the text are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import chunks, column, cut, id_text, partitions, utf8

CAPACITY = 1024
END_ID = 2
#: Characters of a text that are tokenized at a time.
BLOCK = 1 << 20

#: A space between two plain letters starts a pre-token, whatever stands around them: a text can be cut there.
_SAFE_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
#: Fixed value: the pattern of byte-level pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[int, str]:
    """The character that a byte-level vocabulary writes for each byte: itself if it is visible, else the next from U+0100 on."""
    visible = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


def _by_rank(spec: dict) -> tiktoken.Encoding | None:
    """The vocabulary as one that merges by rank, if its merges are in the order of the ids that they make."""
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    odd = [spec["normalizer"], *(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))]
    if model["type"] != "BPE" or any(odd) or pre.get("type") != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"][x + y] for x, y in merges]
    if made != sorted(made):
        return None
    byte = {c: b for b, c in _byte_letters().items()}
    added = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in piece): i for piece, i in model["vocab"].items() if piece not in added}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class RankTokenizer:
    """Ids of whole texts, equal to the tokenizer's own.

    Byte-pair merges in the order of their ids are merges by rank, which take a
    fraction of the time.  A text that holds the string of an added token goes
    to the tokenizer itself, as does every text if the vocabulary is of another
    kind.  Long texts are tokenized block by block.
    """

    def __init__(self, path: str, block: int = BLOCK):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_rank = _by_rank(spec)
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.block = block

    def _blocks(self, text: str):
        start = 0
        while len(text) - start > self.block:
            found = _SAFE_CUT.search(text, start + self.block)
            if not found:
                break
            yield text[start : found.start()]
            start = found.start()
        yield text[start:]

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if self.by_rank is None or any(a in text for a in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(np.array(self.by_rank.encode_ordinary(x), "<u4").tobytes() for x in self._blocks(text))

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [self.encode(t) for t in texts]


_tokenizers: dict[str, RankTokenizer] = {}


def _pieces(path, end_id, capacity):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        if path not in _tokenizers:
            _tokenizers[path] = RankTokenizer(path)
        encode = _tokenizers[path]
        for b in batches:
            data, off = utf8(column(b, "text"))
            ids = column(b, "doc_id").to_pylist()
            for lo, hi in chunks(off):
                raw = data[off[lo] : off[hi]].tobytes()
                texts = [raw[x - off[lo] : y - off[lo]].decode() for x, y in zip(off[lo:hi], off[lo + 1 : hi + 1])]
                rows = []
                for doc_id, tokens in zip(ids[lo:hi], encode(texts)):
                    tokens += end
                    n = len(tokens) // 4
                    start, length = 0, n % capacity or capacity
                    piece = 0
                    while start < n:
                        crc = zlib.crc32(tokens[4 * start : 4 * (start + length)])
                        rows.append((doc_id, piece, start, length, crc))
                        piece, start, length = piece + 1, start + length, capacity
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def fullest(available: list[tuple[int, int]], capacity: int) -> list[tuple[int, int]]:
    """(length, how many) of a combination with the largest sum up to ``capacity``.

    Bit s of the bitset says that some combination of the lengths so far sums to s.
    """
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length, count in available:
        steps.append((length, reach))
        more = reach
        for _ in range(min(count, capacity // length)):
            more = (more << length) & mask
            if not more:
                break
            reach |= more
        if reach >> capacity:
            break
    target, out = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        used = 0
        while not before >> target & 1:
            target, used = target - length, used + 1
        if used:
            out.append((length, used))
    return out[::-1]


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(sequences, [(length, how many in each)]) until no piece is left."""
    left = {k: n for k, n in sorted(counts.items(), reverse=True) if n}
    plan = []
    while left:
        longest = next(iter(left))
        left[longest] -= 1
        rest = fullest([(k, n) for k, n in left.items() if n and k <= capacity - longest], capacity - longest)
        left[longest] += 1
        used = {longest: 1}
        for k, n in rest:
            used[k] = used.get(k, 0) + n
        times = min(left[k] // n for k, n in used.items())
        for k, n in used.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]
        plan.append((times, sorted(used.items(), reverse=True)))
    return plan


def _slots(plan) -> list[tuple]:
    """Per length: where its pieces' numbers start in each combination, and what follows from it."""
    out: dict[int, list[tuple]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for times, used in plan:
        offset = 0
        for length, n in used:
            out.setdefault(length, []).append((taken.get(length, 0), n, sequence, offset))
            taken[length] = taken.get(length, 0) + times * n
            offset += length * n
        sequence += times
    return [(length, *map(list, zip(*rows))) for length, rows in out.items()]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    return id_text(docs).mapInArrow(
        _pieces(tokenizer_path, end_id, capacity),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint",
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length`` of at most ``capacity``) plus sequence_id and offset."""
    spark = pieces.sparkSession
    salts = partitions(spark)
    salted = cut(
        pieces.withColumn("salt", F.pmod(F.xxhash64(*pieces.columns), F.lit(salts)).cast("int")), "pack-pieces"
    )
    counts = cut(salted.groupBy("length", "salt").count(), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    slots = spark.createDataFrame(
        _slots(minimum_bin_slack(histogram, capacity)),
        "length bigint, starts array<bigint>, each array<bigint>, sequences array<bigint>, offsets array<bigint>",
    )
    before = counts.selectExpr(
        "length", "salt", "sum(count) over (partition by length order by salt) - count as before"
    )
    order = ", ".join(f"`{c}`" for c in pieces.columns)
    numbered = salted.withColumn("number", F.expr(f"row_number() over (partition by length, salt order by {order}) - 1"))
    at = numbered.join(before, ["length", "salt"]).withColumn("number", F.col("before") + F.col("number"))
    # at most `capacity` rows, whatever the documents
    found = at.join(F.broadcast(slots), "length").withColumn(
        "slot", F.size(F.filter("starts", lambda s: s <= F.col("number"))) - 1
    )
    return found.selectExpr(
        *[f"`{c}`" for c in pieces.columns],
        "sequences[slot] + (number - starts[slot]) div each[slot] as sequence_id",
        "offsets[slot] + (number - starts[slot]) % each[slot] * length as offset",
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(token_pieces(docs, tokenizer_path, capacity, end_id), capacity)
