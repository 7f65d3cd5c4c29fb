"""Folds down trees and the label rules, with nulls, ties and empty input."""

from lexmill.operators import trees
from pyspark.sql import functions as F


def test_labels_follow_their_parents(spark):
    toc = spark.createDataFrame([("d", i, lv, t) for i, (lv, t) in enumerate([(1, "第一章甲"), (2, "一緒言"), (3, "甲一序"), (2, "二正文")])], "doc_id string, seq int, level int, text string")
    got = [(r.seq, r.parent_seq, r.label) for r in trees.labelled(toc).orderBy("seq").collect()]
    assert got == [(0, None, "章"), (1, 0, "節"), (2, 1, "小節"), (3, 0, "節")]
    assert trees.labelled(toc.limit(0)).collect() == []
    odd = spark.createDataFrame([(None, 1, 1, None), (None, 2, 2, "緒論"), ("e", 1, None, "緒論"), ("e", 2, 1, "緒論")], toc.schema)
    assert {(r.doc_id, r.seq, r.parent_seq, r.label) for r in trees.labelled(odd).collect()} == {(None, 1, None, "部"), (None, 2, 1, "章"), ("e", 1, None, "部"), ("e", 2, None, "部")}


def test_plan_does_not_grow_with_levels(spark):
    rows = spark.range(400).select((F.col("id") % 3).alias("doc_id"), F.col("id").alias("seq"), (1 + F.col("id") % 60).cast("int").alias("level"), F.lit("緒論").alias("text"))
    plan = trees.labelled(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Range") == 1
    assert trees.labelled(rows).count() == 400


def test_walk(spark):
    schema = "doc int, seq int, depth int, level int, heading string, kind string, block string"
    rows = [
        (1, 1, 1, 1, "部類", None, None), (1, 2, 9, None, None, None, "unseen"), (1, 3, 2, 3, "甲論", None, None), (1, 4, 9, None, None, None, "p"), (1, 5, 3, 4, "前言", None, None),
        (1, 6, 3, 4, "目次", None, None), (1, 7, 4, 5, "gone", None, None), (1, 8, 9, None, None, None, "gone too"), (1, 9, 2, 3, "附：補遺", None, None), (1, 10, 3, 4, "丙", None, None),
        (1, 11, 3, None, None, "orig", None), (1, 12, 9, None, None, None, "q"), (1, 13, 4, 6, "丁", None, None), (1, 14, 9, None, None, None, "r"), (None, 1, 1, 3, "甲", None, None),
    ]
    got = trees.walked(spark.createDataFrame(rows, schema), "doc", "seq", "depth", "level", "heading", "kind", "block")
    lines = {(r.doc, r.seq): (r.toc_line, r.body_line, r.dropped) for r in got.collect()}
    assert [lines[1, i] for i in range(1, 15)] == [
        (None, None, False), (None, None, True), ("- 甲論", "### 甲論", False), (None, "p", False), ("    - 前言", None, False), (None, None, True), (None, None, True), (None, None, True),
        ("- 附：補遺", "### 附：\n# 補遺", False), ("    - 丙", "## 丙", False), (None, None, False), (None, "> **q**", False), ("            - 丁", "#### 　　　　丁", False), (None, "r", False),
    ]
    assert lines[None, 1] == ("- 甲", "### 甲", False)
