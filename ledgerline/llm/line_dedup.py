"""Line dedup: winnowing over line hashes, in DataFrame operations only.

A run of ``window`` or more consecutive lines that also stands earlier (in a
document with a smaller doc_id, or further up in the same one) is deleted; the
earliest occurrence stays.

1. Of every ``window`` consecutive lines the least line hash (the last on
   ties) is a fingerprint with its position; equal runs select equal ones, so
   that every repeated run of ``window`` lines is found.
2. Fingerprints are counted by position; the positions of those that occur at
   two places or more are joined back to their documents.
3. Around each such position, the runs of ``window`` lines that selected it
   are compared by all their line hashes, and each distinct run gets its first
   place.
4. A match extends both ways as long as neighbouring runs match as well: later
   runs that overlap or touch merge into maximal spans, and their lines go.

With ``short_words``, runs of fewer than ``window`` lines are fingerprinted too
if they hold at least so many words or are a whole document (compared with
whole documents), and go through the same steps.

Nothing is joined pairwise: every occurrence is compared with the first one of
its content.  Defined results: a null text stays null and has no lines; an
empty text is one empty line; rows with a null doc_id come after all others;
rows that share a doc_id are ordered by a hash of their text, and rows with
equal id and text keep the same lines; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

WINDOW = 3
#: Words from which a run of fewer than WINDOW lines counts as a passage.
SHORT_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["no_id", "id", "row_key"]


def _keys(id_col, text_col):
    return [
        id_col.isNull().alias("no_id"),
        F.coalesce(id_col.cast("bigint"), F.lit(0).cast("bigint")).alias("id"),
        F.xxhash64(text_col).alias("row_key"),
    ]


def _lines(text):
    return F.split(text, "\n", -1)


def _starts(n: int, window: int, short_words: int | None):
    """(start, n) of the runs of ``n`` lines that are fingerprinted: all of ``window`` lines; of the shorter ones those of
    ``short_words`` words or more with a line of fewer (else the lines are found by themselves), and whole documents."""
    starts = F.sequence(F.lit(0), F.size("hashes") - n)
    if n < window:
        words = lambda i: F.slice("words", i + 1, n)
        total = lambda i: F.aggregate(words(i), F.lit(0), lambda a, x: a + x)
        needed = lambda i: F.exists(words(i), lambda x: x < short_words) if n > 1 else F.lit(True)
        whole = (F.size("hashes") == n) & ~F.col("blank")
        starts = F.filter(starts, lambda i: whole | ((total(i) >= short_words) & needed(i)))
    found = F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(n).alias("n")))
    return F.when(F.size("hashes") >= n, found).otherwise(F.array().cast("array<struct<start:int,n:int>>"))


def line_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, short_words: int | None = None
) -> DataFrame:
    """Every run of ``window`` lines: its row's key, first line (from 0), line hashes, and fingerprint with position.

    With ``short_words`` also the shorter runs of so many words and the whole documents of fewer lines.
    """
    text = docs[text_col]
    lines = {"hashes": F.transform(_lines(text), lambda x: F.xxhash64(x))}
    if short_words is not None:
        lines |= {"words": F.transform(_lines(text), lambda x: F.regexp_count(x, F.lit(WORD))), "blank": text == ""}
    hashed = docs.where(text.isNotNull()).select(*_keys(docs[id_col], text), *(c.alias(k) for k, c in lines.items()))
    sizes = [window] if short_words is None else range(1, window + 1)
    runs = (
        hashed.select(*KEY, "hashes", F.explode(F.concat(*(_starts(n, window, short_words) for n in sizes))).alias("at"))
        .select(*KEY, "at.start", F.slice("hashes", F.col("at.start") + 1, F.col("at.n")).alias("run"))
    )
    least = F.array_min("run")
    last = F.lit(window) - F.array_position(F.reverse("run"), least)
    short = F.size("run") < window
    return runs.withColumns({
        "fingerprint": F.when(short, F.xxhash64("run")).otherwise(least),
        "position": F.when(short, F.col("start")).otherwise((F.col("start") + last).cast("int")),
    })


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, short_words: int | None = None
) -> DataFrame:
    """Per row with deleted lines: its key and ``spans``, ascending (start, end) of lines from 0, end exclusive."""
    runs = cut(line_runs(docs, id_col, text_col, window, short_words), "line-runs")
    places = runs.select("fingerprint", *KEY, "position").distinct()
    repeated = cut(places.groupBy("fingerprint").count().where("count > 1").select("fingerprint"), "line-fingerprints")
    candidates = runs.join(repeated, "fingerprint")
    place = F.struct(*KEY, "start")
    first = cut(
        candidates.groupBy("run").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last"),
        "line-first",
    )
    later = (
        candidates.join(first, "run")
        .where(place > F.col("first"))
        .groupBy(*KEY, "start")
        .agg((F.col("start") + F.max(F.size("run"))).alias("end"))
    )
    by_row = Window.partitionBy(*KEY).orderBy("start")
    reached = F.max("end").over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    spans = (
        later.withColumn("new", F.when(F.col("start") > reached, 1).otherwise(0))
        .withColumn("island", F.sum("new").over(by_row))
        .groupBy(*KEY, "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    return spans.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _kept(lines, spans):
    """The lines outside the spans: slices between one span's end and the next one's start."""
    before = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.element_at(spans, k)["end"])
    until = lambda k: F.when(k == F.size(spans), F.size(lines)).otherwise(F.get(spans, k)["start"])
    gaps = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda k: F.slice(lines, before(k) + 1, until(k) - before(k)))
    return F.array_join(F.flatten(gaps), "\n")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, short_words: int | None = None
) -> DataFrame:
    """``row`` (all columns of docs, with the text's kept lines), n_lines and n_removed of every row."""
    spans = repeated_spans(docs, id_col, text_col, window, short_words)
    rows = docs.select(F.struct("*").alias("row"), *_keys(docs[id_col], docs[text_col]))
    joined = rows.join(spans, KEY, "left")
    text = F.col(f"row.`{text_col}`")
    found = F.col("spans").isNotNull()
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return joined.select(
        F.col("row").withField(f"`{text_col}`", F.when(found, _kept(_lines(text), F.col("spans"))).otherwise(text)).alias("row"),
        F.when(text.isNull(), 0).otherwise(F.size(_lines(text))).alias("n_lines"),
        F.coalesce(removed, F.lit(0)).alias("n_removed"),
    )
