"""A window that many benchmark items share."""

from __future__ import annotations

from keyferry.llm import decontaminate


def test_hits_carry_no_item_lists(spark):
    template = "answer the question below with one of the four letters"
    items = spark.createDataFrame([(i, f"{template} q{i}") for i in range(60)] + [(None, template)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"x {template} y {template}"), (None, f"{template} q7"), (3, "nothing"), (4, None)],
                                 "doc_id bigint, text string")
    hits, owners = decontaminate.find_hits(docs, items)
    assert "array" not in hits.schema["hits"].dataType.elementType.simpleString()
    assert owners.groupBy("window").count().agg({"count": "max"}).first()[0] == 60
    got = {r["row"]["doc_id"]: (r["n_items"], r["n_hit"], r["contaminated"]) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (60, 20, True), None: (60, 11, True), 3: (0, 0, False), 4: (0, 0, False)}
