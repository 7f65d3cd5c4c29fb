"""Operators on small inputs."""

import random
import re

from lexmill.functions.text import CJK_WIDE
from lexmill.operators import documents, gaps, lookups, matching, rendering, sequences
from lexmill.sources import files, xml_nodes
from lexmill.streaming import gap_stream
from pyspark.sql import functions as F

TREE = """<TEI xmlns="http://www.tei-c.org/ns/1.0" xmlns:cb="http://example.org/ns"><text><cb:div><cb:mulu level="2">第一章緒言</cb:mulu><head>第一章緒言</head>
<p>前<note place="inline">注</note>後<lb/>行<anchor id="a1"/></p><cb:div type="orig"><p>原文</p></cb:div><cb:div><head>目次</head><p>丟</p></cb:div></cb:div>
<byline>——十九年<note place="inline">甲記</note>——</byline><back><note target="#a1">尾注</note></back></text></TEI>"""


def greedy(text, terms):
    out, i = [], 0
    while i < len(text):
        for size in range(min(len(text) - i, 6), 0, -1):
            if text[i : i + size] in terms:
                out.append((text[i : i + size], i))
                i += size
                break
        else:
            i += 1
    return out


def test_greedy_matching(spark, monkeypatch):
    rng = random.Random(3)
    terms = sorted({"".join(rng.choices("abc", k=rng.randint(2, 4))) for _ in range(12)})
    texts = ["".join(rng.choices("abc", k=rng.randint(0, 40))) for _ in range(60)]
    lines = spark.createDataFrame(list(enumerate(texts)), "k int, line string")
    want = sorted((k, s, p) for k, t in enumerate(texts) for s, p in greedy(t, set(terms)))
    assert re.fullmatch(matching.trie(["a.b", "a", "a.bc"]), "a.bc") and not re.search(matching.trie(["a.b"]), "axb") and not re.search(matching.trie([""]), "a")
    for most in (200, 0):
        monkeypatch.setattr(matching, "MOST_ALTERNATIVES", most)
        assert sorted((r.k, r.surface, r.position) for r in matching.positions(lines, terms, ["k"]).collect()) == want
        assert sorted((r.k, r.surface) for r in matching.hits(lines, terms).collect()) == sorted((k, s) for k, s, _ in want)


def test_candidates(spark):
    docs = spark.createDataFrame([(1, "# 佛法學\n佛法 x法學 佛法學"), (2, None)], "doc_id int, text string")
    vocabulary = spark.createDataFrame([(1, "佛法學", ["佛法"]), (2, "法學", ["佛法"]), (3, "學", [])], "seq int, standard string, variants array<string>")
    keys = matching.match_keys(vocabulary)
    assert {(r.surface, r.standard) for r in keys.collect()} == {("佛法學", "佛法學"), ("佛法", "佛法學"), ("法學", "法學")}
    found = matching.hits(matching.lines_of(docs), [r.surface for r in keys.collect()], chars=CJK_WIDE)
    got = [(r.standard, r.occurrences, r.heading_hits, r.score, r.nth, r.surfaces) for r in matching.candidates(found, keys).orderBy("nth").collect()]
    assert got == [("佛法學", 3, 1, 6, 1, "佛法、佛法學"), ("法學", 1, 0, 1, 2, "法學")]


def test_cascade_stops_at_empty_value(spark):
    table = spark.createDataFrame([(1, "a", "x"), (None, "a", "y"), (0, "b", "z"), (2, "b", "")], "vol int, issue string, v string")
    left = spark.createDataFrame([(1, 1, "a"), (2, 9, "a"), (3, 9, "b"), (4, 2, "b"), (5, 1, "c")], "k int, vol int, issue string")
    tries = [{"vol": v, "issue": left["issue"]} for v in (left["vol"], F.lit(None).cast("int"), F.lit(0))]
    got = {r.k: (r.found, r.found_by) for r in lookups.cascade(left, table.withColumnsRenamed({}), tries, "v").collect()}
    assert got == {1: ("x", 1), 2: ("y", 2), 3: ("z", 3), 4: ("", 1), 5: (None, None)}


def test_spans_and_votes(spark):
    rows = spark.createDataFrame([("a", "3", "5"), ("b", "5", "3"), ("c", "x", "4")], "k string, lo string, hi string")
    assert [(r.k, r.issue) for r in lookups.expand_spans(rows, "lo", "hi").collect()] == [("a", 3), ("a", 4), ("a", 5)]
    votes = spark.createDataFrame([("k", "x", 2), ("k", "y", 1), ("l", None, 3)], "k string, v string, o int")
    assert {(r.k, r.v) for r in lookups.vote(votes, "k", "v", "o", "none").collect()} == {("k", "y"), ("l", "none")}


def test_fold_and_outline(spark):
    rows = spark.createDataFrame([(1, 1, "（附）z", 1), (1, 2, "a", 2), (1, 3, "（附）b", 3), (1, 4, "（附）c", 4), (1, 5, "d", 5)], "g int, seq int, name string, byte_end int")
    got = sequences.fold(rows, F.col("name").startswith("（附）"), ["seq"], ["g"], ["name"], "byte_end", "name").orderBy("last_byte_end").collect()
    assert [(r.name, r.last_byte_end, r.folded) for r in got] == [("（附）z", 1, ""), ("a", 4, "（附）b；（附）c"), ("d", 5, "")]
    toc = spark.createDataFrame([("d", i, lv, t) for i, (lv, t) in enumerate([(1, "第一章甲"), (2, "一緒言"), (3, "甲一序"), (2, "二正文")])], "doc_id string, seq int, level int, text string")
    got = [(r.seq, r.parent_seq, r.is_last) for r in sequences.outline(toc, "doc_id").orderBy("seq").collect()]
    assert got == [(0, None, True), (1, 0, False), (2, 1, True), (3, 0, True)]
    assert [r.line for r in documents.toc_lines(sequences.outline(toc, "doc_id"), "csv").orderBy("seq").collect()][0] == '1,"第一章甲"'


def test_shredding_and_rendering(spark):
    docs = spark.createDataFrame([("a.xml", bytearray(TREE.encode())), ("bad.xml", bytearray(b"<a><b></a>")), ("none.xml", None)], "path string, content binary")
    nodes = xml_nodes.shred(docs).cache()
    assert {r.doc_id for r in nodes.select("doc_id").distinct().collect()} == {"a.xml"}
    p = next(r for r in documents.tree_text(nodes, ["p"]).orderBy("node_id").collect())
    assert p.text == "前注後行"
    md = documents.render_articles(nodes).first().markdown
    assert "前（注）後行[1]" in md and "> **原文**" in md and "丟" not in md and "# 第一章緒言" in md
    assert [(r.target, r.text) for r in documents.anchored_notes(nodes).collect()] == [("a1", "尾注")]
    assert [r.text for r in documents.inline_notes(nodes).collect()] == ["甲記"]
    kinds = {(r.type, r.raw_text) for r in documents.end_matter(nodes).collect()}
    assert ("inline_note", "甲記") in kinds
    whole = xml_nodes.articles(docs).first()
    assert bytes(whole.chunk).startswith(b"<cb:div>") and bytes(whole.chunk).endswith(b"</cb:div>")
    assert xml_nodes.parse(b"junk <p>x</p>") is not None and xml_nodes.parse(b"<a><b></a>") is None


def test_front_matter(spark, column):
    text = "---\ntitle: a: b\nn: 1\n---\n# H [2]\nbody\n\n## 目錄\n- x\n\n## 正文\ny"
    assert column([text], files.front_matter) == [{"title": "a: b", "n": "1"}]
    assert column([text], lambda x: files.title(x, F.lit("?"))) == ["H"]
    assert "- x" not in column([text], files.body)[0] and "## 正文" in column([text], files.body)[0]
    once = column([text], lambda x: rendering.upsert_list(x, "concepts", F.array(F.lit("甲"), F.lit("乙"))))[0]
    assert "concepts:\n  - 甲\n  - 乙" in once and column([once], files.front_matter)[0]["n"] == "1"
    again = column([once], lambda x: rendering.upsert_list(x, "concepts", F.array(F.lit("丙"))))[0]
    assert "  - 丙" in again and "甲" not in again
    assert column([text], lambda x: rendering.upsert_list(x, "concepts", F.lit(None).cast("array<string>"))) == [text]


def test_markdown_tables(spark):
    text = "# 1、甲刊\n## 卷期对照表\n| 期 | 日 |\n|---|---|\n| 1卷1期 | 1920.01.01 |\n# 2、乙刊\n## 卷期对照表\n| 期 | 日 |\n|---|---|\n| 2期 | |\n"
    rows = files.markdown_tables(spark.createDataFrame([("f", text)], "path string, text string")).orderBy("line_no").collect()
    assert [(r.section, r.cells) for r in rows] == [("甲刊", ["1卷1期", "1920.01.01"]), ("乙刊", ["2期", ""])]


def test_dump(spark, tmp_path):
    dump = '<d><table_structure name="t"><field Field="id" Type="int(11)" Null="NO" Key="PRI" Extra=""/><field Field="n" Type="varchar(9)" Null="YES" Key="" Extra=""/></table_structure><table_data name="t"><row><field name="id">7</field><field name="n">x</field></row></table_data></d>'
    (tmp_path / "d.xml").write_text(dump)
    assert [tuple(r) for r in files.typed_dump(spark, str(tmp_path / "d.xml")).collect()] == [(7, "x")]
    assert "PRIMARY KEY" in files.create_statement("t", files.dump_columns(spark, str(tmp_path / "d.xml")))


def test_gap_log_batch_and_stream(spark, tmp_path):
    lines = ['{"article_path": "../a1", "functions": ["經典講釋", "三無性"]}', '{"article_path": "a2", "functions": ["經典講釋"], "gap_terms": ["因緣（生）"]}', "not json", '{"article_path": "/tmp/x", "functions": ["經典講釋"]}', '{"article_path": "a1", "functions": ["經典講釋"]}']
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text("\n".join(lines[:2]))
    (tmp_path / "in/2.json").write_text("\n".join(lines[2:]))
    log = files.read_log(spark, str(tmp_path / "in"), gap_stream.SCHEMA)
    want = {("functions", "经典講释", 2), ("functions", "三無性", 1), ("concepts", "因緣", 1)}
    assert {tuple(r) for r in gaps.gap_frequency(gaps.gap_terms(log), 1).collect()} == want
    counts = gap_stream.gap_counts(gap_stream.read_gap_stream(spark, str(tmp_path / "in")))
    assert {tuple(r) for r in gap_stream.counted(counts).select("dimension", "term", "n").collect()} == want
