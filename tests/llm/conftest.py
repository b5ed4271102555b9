"""A small documents table with every odd case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, row string, spans string, root int"
PROSE = " ".join(f"word{i} and then thing{i % 7}" for i in range(40)) + "."
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ITEM = "the quick brown fox jumps over the lazy dog and runs far away from here"


def odd_rows():
    long = " ".join(f"tok{i}" for i in range(30_000)) + "\n" + "\n".join(f"line {i}" for i in range(500))
    texts = [
        (1, PROSE), (2, PROSE), (3, PROSE + " end"), (4, None), (5, ""), (6, "   \n\t "), (7, "a"),
        (8, long), (9, f"before {PASSAGE} after"), (10, f"other {PASSAGE} more words"), (11, f"He said: {ITEM.upper()}"),
        (12, "x\ny\nz\nown line"), (13, "x\ny\nz\nother line"), (13, "x\ny\nz\nother line"), (None, PROSE), (None, None),
        (14, "é漢字 🙂 naïve  double  spaces \n\n end "), (15, "stupid idiot " * 30), (16, "a\na\na\na\na\na"),
        (17, "one <|endoftext|> two"), (18, " ".join(f"longer-word-{i % 5000}" for i in range(75_000))),
    ]
    return [(i, t, None, "s", None if t is None else len(t), 0, "r", "x", 1) for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, ITEM, 0), (1, ITEM, 0), (2, "too short", 0), (3, None, 0), (None, ITEM, 0), (4, "", 0)]
    return spark.createDataFrame(rows, "item_id bigint, text string, doc_id int")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, 1, int(i == 15)) for i in range(1, 17)] + [(3, 1, 0), (None, 1, 1), (2, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
