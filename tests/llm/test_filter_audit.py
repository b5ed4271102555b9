"""Filter interaction audit against brute force, order by order."""

from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import filter_audit, queries

COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def failures(rows):
    """Set of failed filters of each (doc_id, part, text)."""
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    out = []
    for i, _, t in rows:
        w, points = t.encode().split(), len(t)
        f = set()
        if len(w) < 100:
            f.add("A")
        if 100 * len(set(w)) < 80 * len(w):
            f.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 10 * points:
            f.add("C")
        if any(c in "#$%&*|" for c in t):
            f.add("D")
        if i is not None and i > first[t]:
            f.add("E")
        out.append(f)
    return out


def brute(rows, good, toxic):
    """{(part, order, step): numbers} by running every order over every document."""
    out = {}
    fails = failures(rows)
    for part in {p for _, p, _ in rows}:
        mine = [(i, f) for (i, p, _), f in zip(rows, fails) if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                before = len(left)
                left = [x for x in left if letter not in x[1]]
                shapley[letter] += len(gone)
                out[part, order, step] = [
                    len(left), before - len(left), sum(letter in f for _, f in mine) - len(gone), sum(f == {letter} for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), numbers in out.items():
            if p == part:
                numbers.append(shapley[order[step - 1]])
    return out


def got(df):
    rows = df.collect()
    found = {(r.part, r.filter_order, r.step): [r[c] for c in [*COLUMNS, "shapley"]] for r in rows}
    assert len(found) == len(rows)
    return found


def marks(labels):
    rows = [r for r in labels.collect() if r.doc_id is not None]
    return {r.doc_id for r in rows if r.quality == 1}, {r.doc_id for r in rows if r.toxic == 1}


def test_odd_rows(odd, empty, labels):
    rows = [(r.doc_id, r.lang or "", r.text or "") for r in odd.collect()]
    want = brute(rows, *marks(labels))
    assert got(filter_audit.audit(odd, labels)) == want and len(want) == 600
    assert filter_audit.audit(empty, labels).count() == 0
    unlabelled = got(filter_audit.audit(odd, labels.limit(0)))
    assert all(v[:4] == want[k][:4] and v[4:6] == [0, 0] for k, v in unlabelled.items())


def test_given_rows(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.lang or "", r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows, *marks(spark.read.parquet(f"{sf}/labels.parquet")))
    assert got(queries.QUERIES["op13_filter_interaction_audit"](spark, sf)) == want


def test_large_group_of_copies_and_one_hot_id(spark, labels):
    rows = [(i, "en", "the same text") for i in range(300)] + [(7, "de", f"text {i} of one id") for i in range(100)]
    rows += [(None, None, None)] * 50 + [(None, "", "")] * 50 + [(400, "", "")] * 2 + [(401, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").repartition(5)
    plain = [(i, p or "", t or "") for i, p, t in rows]
    assert got(filter_audit.audit(df, labels)) == brute(plain, *marks(labels))


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=200))
def test_carry_save_counts_equal_plain_ones(words):
    want = [sum(w >> b & 1 for w in words) for b in range(32)]
    assert filter_audit.positional_popcounts(np.array(words, np.uint32)).tolist() == want


@pytest.mark.parametrize("fails", range(32))
def test_words_are_truth_tables(fails):
    word = int(filter_audit.WORDS[fails])
    assert [word >> s & 1 for s in range(32)] == [int(not s & fails) for s in range(32)]
