"""Trees of nodes are told in one pass: no joins that could be broadcast, and rows dealt over all tasks."""

import pytest
from lexmill.operators import documents
from lexmill.plans import texts
from lexmill.sources import xml_nodes
from pyspark.sql import functions as F

_DOC = (
    '<t><div id="a"><head>一<anchor id="nkr_note_orig_1"/></head><head>二<anchor id="nkr_note_orig_2"/></head><p>文<note>外<note place="inline">內</note></note></p></div>'
    '<div><head>三</head><head>四<anchor id="nkr_note_orig_3"/></head><byline>記<note place="inline" type="add" rend="hide">藏</note><note place="inline">見</note>尾</byline><p>後<byline>晚</byline></p></div>'
    '<div><mulu>附一</mulu><div><mulu>附二</mulu><p>非</p><div><byline>十年作</byline></div></div></div><note target="#nkr_note_orig_2">原載甲</note><note target="#nkr_note_orig_2">原載乙</note></t>'
)


def test_trees(spark):
    nodes = xml_nodes.shred(spark.createDataFrame([(str(i), _DOC) for i in range(3)], "path string, content string"))
    of = lambda rows, *names: sorted(tuple(r[n] for n in names) for r in rows.filter("doc_id = '1'").collect())
    headings = documents.headings(nodes)
    assert {(r.text, r.anchor) for r in headings.filter("doc_id = '1'").collect()} == {("一", "nkr_note_orig_1"), ("三", None), ("附一", None), ("附二", None), ("", None)}
    assert [(r.title, r.date_place) for r in documents.appendixes(nodes).filter("doc_id = '1'").collect()] == [("附：二", "（1921 年，作）")]
    assert of(documents.inline_notes(nodes), "text") == [("見",)]
    assert of(documents.inline_notes(nodes, None), "text") == [("內",), ("見",)]
    assert of(documents.first_bylines(nodes), "text") == [("十年作",), ("晚",), ("記藏見尾",)]
    notes = {(r.seq, r.target, r.text) for r in documents.anchored_notes(nodes).filter("doc_id = '1'").collect()}
    assert notes == {(1, "nkr_note_orig_1", None), (2, "nkr_note_orig_2", "原載甲"), (3, "nkr_note_orig_3", None)}


@pytest.mark.parametrize("operator", ["headings", "appendixes", "anchored_notes", "inline_notes", "end_matter", "first_bylines"])
def test_trees_are_not_joined(spark, operator):
    nodes = xml_nodes.shred(spark.createDataFrame([("1", _DOC)], "path string, content string"))
    plan = getattr(documents, operator)(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan and plan.count("MapInArrow") == 2


def test_documents_of_one_row_group_are_dealt_out(spark):
    for nodes in (texts._nodes, texts._appended):
        parts = nodes(spark, "/root/testdata/sf0.01").select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 8
