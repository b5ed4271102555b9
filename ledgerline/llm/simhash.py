"""SimHash near-dedup: tiled exact comparison of 64-bit fingerprints.

Distinct fingerprints are dealt into tiles in the order of their population
counts (of the whole and of its 16-bit quarters).  Tile pairs whose counts
differ by more than the radius are skipped: every differing bit moves one
count by one, so the sum of the quarters' differences is at most the Hamming
distance.  Each remaining pair of tiles is one row and is compared in full
with numpy exclusive-or and bit counts, again skipping sub-tiles by the counts
of the eight bytes.  A pair of tiles gives the edges of a spanning forest of
its links, never all links, so a large group of near copies costs as many
edges as it has members.

The number of comparisons grows as the square of the distinct fingerprints,
less what the counts skip; that is this method's nature.

Defined results: null and empty texts have fingerprint zero; repeated rows are
linked like other equal fingerprints; component_id is the smallest non-null
doc_id of the component (null if it has none); an empty table gives no rows;
columns other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, column, cut, id_text, utf8
from .components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints in a tile (512 KB), and in the sub-tiles that are compared at a time.
TILE = 1 << 16
SUB_TILE = 512


def simhash(raw: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text: bit set where over half of the shingles' XXH64 have it."""
    text = b" ".join(raw.lower().split())
    if not text:
        return 0
    gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
    start = np.concatenate(([0], gaps + 1))
    end = np.concatenate((gaps, [len(text)]))
    n = max(1, len(start) - shingle + 1)
    start, end = start[:n], end[-n:]
    h = np.fromiter(
        (xxhash.xxh64_intdigest(text[x:y], SEED) for x, y in zip(start.tolist(), end.tolist())), np.uint64, n
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):
        bits = np.unpackbits(h[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprint(shingle):
    def run(batches):
        for b in batches:
            data, off = utf8(column(b, "text"))
            for lo, hi in chunks(off):
                raw, o = data[off[lo] : off[hi]].tobytes(), (off[lo : hi + 1] - off[lo]).tolist()
                fp = np.array([simhash(raw[x:y], shingle) for x, y in zip(o[:-1], o[1:])], np.uint64)
                yield pa.record_batch(
                    [*[column(b, c).slice(lo, hi - lo) for c in ("doc_id", "row_key")], pa.array(fp.view(np.int64))],
                    names=["doc_id", "row_key", "fp"],
                )

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row_key (a hash of the text), fp (bigint with the fingerprint's bits) of every row."""
    texts = id_text(docs).withColumn("row_key", F.xxhash64("text"))
    return texts.mapInArrow(_fingerprint(shingle), "doc_id bigint, row_key bigint, fp bigint")


# ---------------------------------------------------------------- tiles
def _quarter(k):
    return F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("int").alias(f"q{k}")


QUARTERS = ["q0", "q1", "q2", "q3"]


def tiles(distinct: DataFrame, size: int = TILE) -> DataFrame:
    """tile, fps array, lo/hi arrays of the population counts (whole, then quarters).

    The tile of a fingerprint follows from a histogram of its quarters'
    counts, which has at most 17**4 rows however many fingerprints there are.
    """
    spark = distinct.sparkSession
    keyed = distinct.select("fp", *[_quarter(k) for k in range(4)])
    histogram = sorted(
        ((sum(r[:4]), *r[:4], r["count"]) for r in keyed.groupBy(*QUARTERS).count().collect()), key=lambda r: r[:5]
    )
    plan, tile, room = [], 0, size
    for _, *q, n in histogram:
        parts = -(-n // size)
        if parts > 1 or n > room:
            tile, room = tile + 1, size
        plan.append((*q, tile, parts))
        if parts > 1:
            tile, room = tile + parts, size
        else:
            room -= n
    where = spark.createDataFrame(plan, "q0 int, q1 int, q2 int, q3 int, first int, parts int")
    total = F.expr("q0 + q1 + q2 + q3")
    placed = keyed.join(F.broadcast(where), QUARTERS).withColumn(
        "tile", (F.col("first") + F.pmod(F.xxhash64("fp"), F.col("parts"))).cast("int")
    )
    counts = [total, *map(F.col, QUARTERS)]
    return placed.groupBy("tile").agg(
        F.collect_list("fp").alias("fps"),
        F.array(*[F.min(c) for c in counts]).alias("lo"),
        F.array(*[F.max(c) for c in counts]).alias("hi"),
    )


def tile_pairs(tiled: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (x <= y) of tiles that can hold a link; the others are skipped."""
    stats = tiled.select("tile", "lo", "hi")
    x = stats.select(F.col("tile").alias("x"), F.col("lo").alias("xlo"), F.col("hi").alias("xhi"))
    y = stats.select(F.col("tile").alias("y"), F.col("lo").alias("ylo"), F.col("hi").alias("yhi"))
    # Tiles stand in the order of the whole count (0 to 64), so the partners of a tile are
    # the next ones, up to the last that starts at a count within the radius.
    last = {r["count"]: r["tile"] for r in stats.groupBy(F.col("lo")[0].alias("count")).agg(F.max("tile").alias("tile")).collect()}
    ends = [max((t for c, t in last.items() if c <= top + max_bits), default=-1) for top in range(65)]
    end = F.element_at(F.array(*map(F.lit, ends)), (F.col("xhi")[0] + 1).cast("int"))
    pairs = x.withColumn("y", F.explode(F.sequence(F.col("x"), end))).join(y, "y")
    apart = lambda i: F.greatest(F.lit(0), F.col("ylo")[i] - F.col("xhi")[i], F.col("xlo")[i] - F.col("yhi")[i])
    quarters = sum((apart(i) for i in range(2, 5)), apart(1))
    return pairs.where((apart(0) <= max_bits) & (quarters <= max_bits)).select("x", "y")


class _Forest:
    """Components of the fingerprints of a tile pair, and the edges that join them."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        up = self.root
        for a, b in zip(i.tolist(), j.tolist()):
            while up[a] != a:
                up[a] = up[up[a]]
                a = int(up[a])
            while up[b] != b:
                up[b] = up[up[b]]
                b = int(up[b])
            if a != b:
                up[max(a, b)] = min(a, b)
                self.edges.append((a, b))

    def flatten(self) -> np.ndarray:
        while True:
            up = self.root[self.root]
            if (up == self.root).all():
                return up
            self.root = up


def _signature(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8)).astype(np.int16)


def _ordered(fp: np.ndarray) -> np.ndarray:
    s = _signature(fp)
    q = s[:, ::2] + s[:, 1::2]
    return fp[np.lexsort((fp, q[:, 3], q[:, 2], q[:, 1], q[:, 0], q.sum(axis=1)))]


def compare(x: np.ndarray, y: np.ndarray | None, max_bits: int, sub: int = SUB_TILE) -> np.ndarray:
    """Edges (pairs of fingerprints) of a spanning forest of all links within x and y, or within x.

    With ``y``, links are those between x and y.
    """
    x = _ordered(x)
    y = x if y is None else _ordered(y)
    same = y is x
    offset = 0 if same else len(x)
    forest = _Forest(len(x) + (0 if same else len(y)))

    def boxes(fp):
        s = _signature(fp)
        edges = np.arange(0, len(fp), sub)
        return edges, np.minimum.reduceat(s, edges), np.maximum.reduceat(s, edges)

    xe, xlo, xhi = boxes(x)
    ye, ylo, yhi = boxes(y)
    for i, lo in enumerate(xe.tolist()):
        gap = np.maximum(0, np.maximum(ylo - xhi[i], xlo[i] - yhi)).sum(axis=1)
        for j in np.flatnonzero(gap <= max_bits).tolist():
            if same and j < i:
                continue
            a, b = x[lo : lo + sub], y[ye[j] : ye[j] + sub]
            near = np.bitwise_count(a[:, None] ^ b[None, :]) <= max_bits
            while near.any():
                roots = forest.flatten()
                near &= roots[lo : lo + len(a), None] != roots[None, offset + ye[j] : offset + ye[j] + len(b)]
                hit = np.flatnonzero(near.any(axis=1))
                forest.join(lo + hit, offset + ye[j] + near[hit].argmax(axis=1))
    both = x if same else np.concatenate((x, y))
    return both[np.array(forest.edges, np.int64).reshape(-1, 2)]


def _links(max_bits):
    def run(batches):
        for b in batches:
            for row in range(b.num_rows):
                x, y = (column(b, c)[row].as_py() for c in ("x", "y"))
                fx = np.asarray(column(b, "fx")[row].values).view(np.uint64)
                fy = None if x == y else np.asarray(column(b, "fy")[row].values).view(np.uint64)
                e = compare(fx, fy, max_bits).view(np.int64)
                yield pa.record_batch([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["a", "b"])

    return run


def link_components(prints: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """``prints`` (doc_id, fp) -> (fp, root, component_id), one row per distinct fingerprint."""
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    tiled = cut(tiles(distinct, tile), "simhash-tiles")
    pairs = cut(tile_pairs(tiled, max_bits), "simhash-pairs")
    left = tiled.select(F.col("tile").alias("x"), F.col("fps").alias("fx"))
    right = tiled.select(F.col("tile").alias("y"), F.col("fps").alias("fy"))
    edges = pairs.join(left, "x").join(right, "y").mapInArrow(_links(max_bits), "a bigint, b bigint")
    roots = connected_components(edges)
    linked = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = cut(linked.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    return cut(linked.join(least, "root").select("fp", "root", "component_id"), "simhash-components")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, tile: int = TILE
) -> DataFrame:
    """Per row of ``docs``: doc_id, fp, component_id."""
    prints = cut(fingerprints(docs, shingle), "simhash-prints")
    return prints.join(link_components(prints, max_bits, tile), "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, tile: int = TILE
) -> DataFrame:
    """The rows of docs, all columns, less all but one of each component.

    The row with the smallest doc_id stays (a null id comes last); of rows with
    that id, the one with the least hash of its text; of equal rows, one.
    """
    prints = cut(fingerprints(docs, shingle), "simhash-prints")
    components = link_components(prints, max_bits, tile)
    named = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "row_key")
    # the component's number need not be unique where ids are missing or repeated: its root is
    kept = prints.join(components, "fp").groupBy("root").agg(F.min(named).alias("k")).select("k.*")
    rows = docs.select(
        F.struct("*").alias("row"),
        docs["doc_id"].isNull().alias("no_id"),
        F.coalesce(docs["doc_id"].cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64(docs["text"].cast("string")).alias("row_key"),
    )
    key = ["no_id", "id", "row_key"]
    return rows.join(kept.dropDuplicates(key), key).dropDuplicates(key).select("row.*")
