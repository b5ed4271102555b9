"""Line dedup with runs of fewer lines than the window."""

import re

import pytest
from test_operators import SF

from ledgerline.llm import line_dedup, queries
from ledgerline.llm.oracle import VARIANT_ORACLE

SCHEMA = "doc_id bigint, text string"


def brute(rows, window, short_words):
    """Row -> kept text, of rows (doc_id, text); equal rows are one document."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    seen, kept = set(), {}
    for r in docs:
        lines = r[1].split("\n")
        gone = set()
        for n in range(1, window + 1):
            for i in range(len(lines) - n + 1):
                run = tuple(lines[i : i + n])
                n_words = len(re.findall(r"[^\x20\x09-\x0D]+", "\n".join(run)))
                if n == window or n_words >= short_words or (n == len(lines) and r[1]):
                    if run in seen:
                        gone.update(range(i, i + n))
                    seen.add(run)
        kept[r] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return kept


def check(df, window, short_words):
    out = line_dedup.dedup_lines(df, window=window, short_words=short_words).select("row.*")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute(rows, window, short_words)
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert out.columns == df.columns
    assert got == sorted([(i, t if t is None else want[i, t]) for i, t in rows], key=repr)


@pytest.mark.parametrize("window,short_words", [(3, 50), (3, 3), (2, 5), (4, 2)])
def test_short_runs_match_brute_force(spark, odd, empty, window, short_words):
    check(odd, window, short_words)
    a, b = " ".join(f"w{i}" for i in range(30)), " ".join(f"v{i}" for i in range(30))
    texts = ["two words", "two words\nmore", a, a, f"{a}\n{b}", f"x\n{a}\n{b}\ny", f"{a} {b}\nz", f"q\n{a} {b}", "\n", "\n", "", "", "a\nb", "a\nb"]
    check(spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3), window, short_words)
    assert line_dedup.dedup_lines(empty, window=window, short_words=short_words).count() == 0


def test_copies_of_one_and_two_lines_go(spark):
    texts = ["a short note", "a short note", "first\nsecond", "first\nsecond", "other"]
    out = queries.line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), SCHEMA), short_words=50)
    assert {r.row.doc_id: r.row.text for r in out.collect()} == {0: "a short note", 1: "", 2: "first\nsecond", 3: "", 4: "other"}


def test_parity_with_duckdb(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cur = con.execute(VARIANT_ORACLE["op1_line_dedup_short"])
    got = queries.VARIANTS["op1_line_dedup_short"](spark, SF).select(*(d[0] for d in cur.description))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    want = sorted(cur.fetchall())
    assert sorted(map(tuple, got.collect())) == want
    assert sum(r[2] > 0 for r in want) > line_dedup.dedup_lines(spark.read.parquet(f"{SF}/documents.parquet")).where("n_removed > 0").count()


def test_no_exact_copy_of_a_document_stays(spark):
    sf = "/root/testdata/sf0.1"
    first, kept = {}, {r.doc_id: r.text for r in queries.QUERIES["op1_line_dedup"](spark, sf).collect()}
    copies = [
        r.doc_id
        for r in sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r.doc_id)
        if r.text and first.setdefault(r.text, r.doc_id) != r.doc_id
    ]
    assert len(copies) > 500 and all(kept[i] == "" for i in copies)
