"""Reports on periodicals with nulls, ties and nothing at all."""

import json

from lexmill.operators import periodicals
from lexmill.sources import files

REFS = "pub string, vol int, issue string, date string, state string"


def test_issue_report(spark):
    rows = [("a", 2, "3", "1920-01-02", "dated"), ("a", 2, "3", "1920-01-02", "dated"), ("a", None, "x", None, "unmatched"), ("a", 1, "10-11", "", "matched"), ("a", 1, "9", "1919", "dated"), ("b", None, "1", None, "unmatched"), ("b", None, "1", None, "unmatched")]
    kinds = spark.createDataFrame([("a", "volumes"), ("b", None), ("c", "issues")], "pub string, kind string")
    got = periodicals.issue_report(periodicals.issue_entries(spark.createDataFrame(rows, REFS), kinds), "T").orderBy("nth").collect()
    assert [(r.part, r.name) for r in got] == [("totals", "T"), ("kinds", ""), ("publication", "a"), ("publication", "b"), ("missing", "")]
    assert got[0].markdown.endswith("| 2 | 5 | 2 | 1 | 2 |")
    assert "| 1 | 1卷9期 | 1919 | dated |\n| 2 | 1卷10-11期 | matched | matched |\n| 3 | 2卷3期 | 1920.01.02 | dated |\n| 4 | 第x期 | unmatched | unmatched |" in got[2].markdown
    assert "> ?\n" in got[3].markdown and got[4].markdown.endswith("- c")
    none = periodicals.issue_report(periodicals.issue_entries(spark.createDataFrame([], REFS), kinds.limit(0)), "T").collect()
    assert [r.part for r in none][:1] == ["totals"] and "| 0 | 0 | 0 | 0 | 0 |" in none[0].markdown


def test_calendar(spark, tmp_path):
    pubs = {"b": {"category": "x", "ref_count": 2, "volume_to_year": {"10": 1930, "2": 1921, "1": 1920, "3": 1922}}, "a": {"category": "x", "ref_count": 2, "aliases": ["q", "r"], "confidence": "low"}, "c": {"category": "unheard of"}}
    (tmp_path / "c.json").write_text(json.dumps({"publications": pubs, "heuristics": {"z": "1", "y": "2"}}, ensure_ascii=False))
    found, rules = files.read_calendar(spark, str(tmp_path))
    got = {r.nth: r.markdown for r in periodicals.calendar_report(found, rules, ["x", "y"], "T", "y", "low").collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert got[1] == "# T\n\n3\n\n| category | publications |\n|---|---|\n| x | 2 |\n| y | 1 |"
    assert got[2].index("### a") < got[2].index("### b") and "| aliases | q / r |" in got[2] and "| 1 | 1920 | 2 | 1921 | 3 | 1922 |\n| 10 | 1930 |" in got[2]
    assert "### c" in got[3] and "| references | 0 |" in got[3]
    assert got[4].endswith("- **y**：2\n- **z**：1") and got[5].endswith("- a（x）")
    (tmp_path / "none").mkdir()
    (tmp_path / "none/c.json").write_text("{}")
    empty = periodicals.calendar_report(*files.read_calendar(spark, str(tmp_path / "none")), ["x"], "T", "x", "low").collect()
    assert len(empty) == 4


def test_batches_and_labels(spark, tmp_path):
    entries = spark.createDataFrame([(1, "p"), (2, "q"), (3, None), (None, "p")], "seq int, path string")
    articles = spark.createDataFrame([("p", "t"), ("r", "u")], "path string, text string")
    got = {(r.seq, r.text, r.missing) for r in periodicals.in_batch(entries, articles, 2).collect()}
    assert got == {(2, None, True), (3, None, True)}
    assert periodicals.in_batch(entries, articles).filter("not missing").count() == 1
    (tmp_path / "l.json").write_text('{"functions": ["x", "x", "y"], "other": 1}')
    assert sorted(map(tuple, files.read_labels(spark, str(tmp_path)).collect())) == [("functions", "x"), ("functions", "y")]


def test_review_text(spark):
    report = spark.createDataFrame([("concepts", 3, 2)], "dimension string, false_positives long, gaps long")
    more = spark.createDataFrame([("concepts", "b", 2, "d"), ("functions", "a", 5, None)], "dimension string, term string, n long, domain string")
    assert periodicals.review_text(report, more).first().markdown == "# gaps\n\n- concepts: 3 false, 2 gaps\n\n- functions a ×5\n- concepts b ×2 → d"
    assert periodicals.review_text(report.limit(0), more.limit(0)).first().markdown == "# gaps\n\n\n\n"
