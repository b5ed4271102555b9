"""Items that the benchmark search leaves out are reported."""

from ledgerline.llm import decontaminate


def test_short_items_are_reported(spark, items):
    assert sorted(r.item_id for r in decontaminate.unsearchable(items).collect()) == [2, 3, 4]
    rows = [(5, "four words\tare\nhere"), (6, "now there are five words"), (5, "four words\tare\nhere")]
    more = spark.createDataFrame(rows, "item_id bigint, text string")
    assert [r.item_id for r in decontaminate.unsearchable(more).collect()] == [5]
