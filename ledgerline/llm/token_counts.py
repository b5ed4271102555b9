"""Token counts: unigram segmentation of pre-tokens, shared over a trie.

Pre-tokens are the words ``[^\\x20\\x09-\\x0D]+``, each after one space.  The
distinct pre-tokens of a task, in order, are a trie in depth-first order: the
prefix that a pre-token shares with the one before it is the same path.  Each
trie node gets its forward score (of the best segmentation of its prefix) and
that segmentation's number of tokens once, from the nodes above it; the number
at a pre-token's last node is kept, and a document's count is the sum over its
words.  Workers keep numbers between batches, up to a bound, after which they
start anew; results don't depend on it.

The pieces are those of a public vocabulary, whose ids stand in the order of
frequency; piece number r has the Zipf-Mandelbrot log probability
-log(r + ZIPF_SHIFT).  Equal scores prefer fewer tokens.

Defined results: a null or empty text has no words and no tokens; every row is
counted, also repeated ones and those without id; an empty table gives no
rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import math

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, column, id_text, utf8

ZIPF_SHIFT = 2.7
#: Pre-tokens that a Python worker remembers before it starts anew.
REMEMBERED = 400_000


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a rank file (base64 and rank in each line), most frequent first."""
    with open(path, "rb") as f:
        ranked = [(int(rank), base64.b64decode(piece)) for piece, rank in map(bytes.split, f) if rank]
    return [p for _, p in sorted(ranked)]


class TrieCounter:
    def __init__(self, pieces: list[bytes], remembered: int = REMEMBERED):
        #: The vocabulary as a trie: (node, byte) -> node, and a node's score where a piece ends.
        self.child: dict[int, int] = {}
        self.score: list[float | None] = [None]
        for rank, piece in enumerate(pieces):
            node = 0
            for byte in piece:
                key = node << 8 | byte
                node = self.child.get(key) or self._add(key)
            if self.score[node] is None:
                self.score[node] = -math.log(rank + ZIPF_SHIFT)
        self.remembered = remembered
        self.known: dict[bytes, int] = {}

    def _add(self, key: int) -> int:
        self.child[key] = len(self.score)
        self.score.append(None)
        return self.child[key]

    def learn(self, words: list[bytes]) -> None:
        """Terminal counts of new words, in one walk of their trie."""
        child, score, known = self.child.get, self.score, self.known
        # by depth of the current path: best score, its tokens, and the pieces begun (their start's best score, tokens and node)
        best, tokens = [0.0], [0]
        begun: list[list[tuple[float, int, int]]] = [[(0.0, 0, 0)]]
        last = b""
        for word in sorted(words):
            shared, path = 0, b" " + word
            for x, y in zip(last, path):
                if x != y:
                    break
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :], begun[shared + 1 :]
            for byte in path[shared:]:
                top, fewest, on = -math.inf, 0, []
                for s, n, node in begun[-1]:
                    node = child(node << 8 | byte)
                    if node:
                        on.append((s, n, node))
                        own = score[node]
                        if own is not None:
                            own += s
                            if own > top or (own == top and n < fewest):
                                top, fewest = own, n
                best.append(top)
                tokens.append(fewest + 1)
                on.append((top, fewest + 1, 0))
                begun.append(on)
            known[word] = tokens[-1]
            last = path

    def __call__(self, texts: list[bytes]) -> tuple[list[int], list[int]]:
        """Words and tokens of each text."""
        if len(self.known) > self.remembered:
            self.known.clear()
        split = [t.split() for t in texts]
        self.learn(list(set().union(*split).difference(self.known)))
        get = self.known.__getitem__
        return [len(w) for w in split], [sum(map(get, w)) for w in split]


_counters: dict[str, TrieCounter] = {}


def _count(path):
    def run(batches):
        if path not in _counters:
            _counters[path] = TrieCounter(read_pieces(path))
        counter = _counters[path]
        for b in batches:
            data, off = utf8(column(b, "text"))
            for lo, hi in chunks(off, 8 << 20):
                raw, o = data[off[lo] : off[hi]].tobytes(), (off[lo : hi + 1] - off[lo]).tolist()
                words, tokens = counter([raw[x:y] for x, y in zip(o[:-1], o[1:])])
                yield pa.record_batch(
                    [column(b, "doc_id").slice(lo, hi - lo), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    return run


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_words, n_tokens of every row."""
    return id_text(docs).mapInArrow(_count(vocabulary_path), "doc_id bigint, n_words bigint, n_tokens bigint")
