"""Small literal inputs of text functions with what must come out beside them, checked like queries."""

from __future__ import annotations

import json

import duckdb
import pytest
from lexmill.functions import bylines, classify, issues, numerals
from lexmill.functions import text as tx
from lexmill.operators import documents, gaps, lookups, rendering, reports, sequences
from lexmill.plans.catalogue import _rows, _values
from lexmill.session import shared_folder
from lexmill.sources import files, writers, xml_nodes
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOUND: dict = {}


def query(oracle):
    def add(f):
        FOUND[f.__name__] = (f, oracle)
        return f

    return add


_NUMERALS = [("十九", 19, 19), ("二十六", 26, 26), ("十", 10, 10), ("二十", 20, 20), ("一九", 9, None), ("七八", 8, None), ("１２", 12, 12), ("百", None, 100), ("廿", None, 20), ("零", None, 0), ("", None, None), ("一四一", 1, 141), ("一百三十三", None, 133), ("一百零五", None, 100), ("廿三", None, None)]


@query(f"SELECT t AS numeral, a AS small, b AS wide FROM {_values(_NUMERALS)} x(t, a, b)")
def numeral_parse(spark: SparkSession, d: str) -> DataFrame:
    """Numerals by the narrow and by the wide rule."""
    rows = _rows(spark, "numeral string", [(t,) for t, _, _ in _NUMERALS])
    return rows.select("numeral", numerals.small_numeral(F.col("numeral")).alias("small"), numerals.wide_numeral(F.col("numeral")).alias("wide"))


_BYLINES = [
    ("——十九年一月在閩南佛學院編述——", "（1930 年 1 月，在閩南佛學院編述）", "1930", "01", "閩南佛學院", "編述"), ("——民國四年春作於普陀——", "（1915 年春，作於普陀）", "1915", "03", "普陀", "作"),
    ("——宣統二年作——", "（1910 年，作）", "1910", "", "", "作"), ("——二十一年十二月在閩南佛學院講——", "（1932 年 12 月，在閩南佛學院講）", "1932", "12", "閩南佛學院", "講"),
    ("（碧松記）", "（碧松記）", "", "", "碧松", "記"), ("見海刊九卷九期", "", "", "", "", ""), ("", "", "", "", "", ""),
]


@query(f"SELECT raw, normal, y AS create_y, m AS create_m, loc AS location, ctx AS context FROM {_values(_BYLINES)} x(raw, normal, y, m, loc, ctx)")
def byline_fields(spark: SparkSession, d: str) -> DataFrame:
    """Bylines in common years, and their parts."""
    rows = _rows(spark, "raw string", [(r[0],) for r in _BYLINES]).withColumn("normal", bylines.normalize_byline(F.col("raw")))
    rows = rows.withColumn("f", bylines.byline_fields(F.col("normal")))
    return rows.select("raw", "normal", "f.create_y", "f.create_m", "f.location", "f.context")


_HEADINGS = [("一緒言", "一　緒言", "部", "章"), ("第一章釋尊略傳", "第一章　釋尊略傳", "部", "章"), ("甲一序分", "甲一　序分", "章", "節"), ("甲色蘊", "甲　色蘊", "章", "節"), ("十一結論", "十　一結論", "章", "節"), ("百法明門論", "百　法明門論", "節", "小節"), ("１十善業", "１十善業", "篇", "部"), ("第一章", "第一章", "", "章"), ("緒論", "緒論", "", "?")]


@query(f"SELECT heading, spaced, parent, label FROM {_values(_HEADINGS)} x(heading, spaced, parent, label)")
def heading_spacing(spark: SparkSession, d: str) -> DataFrame:
    """Headings with a space behind their ordinal, and their labels under a parent."""
    rows = _rows(spark, "heading string, parent string", [(h, p) for h, _, p, _ in _HEADINGS]).withColumn("spaced", tx.space_heading(F.col("heading")))
    return rows.withColumn("label", tx.semantic_label(F.col("spaced"), F.col("parent")))


_ISSUES = [
    ("二卷三至五期", [(2, "3"), (2, "4"), (2, "5")]), ("二卷十一期至三卷五期", [(2, "11"), (2, "12"), *((3, str(i)) for i in range(1, 6))]),
    ("四卷七八期", [(4, "7"), (4, "8"), (4, "7-8"), (None, "7"), (None, "8")]), ("第三期", [(None, "3")]), ("十、十一各期", [(None, "10"), (None, "11"), (None, "10-11")]),
]


@query(f"SELECT ref, vol, issue, label FROM {_values([(t, v, i, f'{v}卷{i}期' if v else f'第{i}期') for t, found in _ISSUES for v, i in found])} x(ref, vol, issue, label)")
def vol_issue_extract(spark: SparkSession, d: str) -> DataFrame:
    """References expanded to one row per volume and issue."""
    rows = _rows(spark, "ref string", [(t,) for t, _ in _ISSUES]).select("ref", F.explode(issues.parse_issues(F.col("ref"))).alias("p"))
    return rows.select("ref", "p.vol", "p.issue", issues.issue_label(F.col("p.vol"), F.col("p.issue")).alias("label"))


_GAPS = [("a1", ["經典講釋", "三無性"], None), ("../a2", ["經典講釋"], ["因緣（因緣生法）"]), ("a3", ["经典讲释"], ["因緣"]), ("a3", ["經典講釋"], None), ("/tmp/x", ["三無性"], None)]


@query("SELECT * FROM (VALUES ('concepts', '因緣', 2), ('functions', '经典講释', 3)) x(dimension, term, n)")
def label_normalize_gap(spark: SparkSession, d: str) -> DataFrame:
    """Unknown labels of two or more articles, in normal form."""
    log = _rows(spark, "article_path string, functions array<string>, gap_terms array<string>", _GAPS)
    known = _rows(spark, "dimension string, label string", [("functions", "三無性")])
    return gaps.gap_frequency(gaps.unknown_terms(gaps.gap_terms(log), known)).withColumn("n", F.col("n").cast("int"))


@query("SELECT i::INT AS vol, (1919 + i)::INT AS year, (i + 8)::INT AS era_year FROM range(1, 31) r(i)")
def year_table(spark: SparkSession, d: str) -> DataFrame:
    """Thirty volumes with their years."""
    return sequences.year_table(spark)


_FIXTURE = [('<d xmlns:cb="urn:x"><cb:div><cb:mulu level="2">一緒言</cb:mulu><p>前<note place="inline">注</note>後</p></cb:div></d>',), ("<bad><x></bad>",), (None,)]


@query("SELECT * FROM (VALUES ('0', 0, -1, 'd', ''), ('0', 1, 0, 'div', ''), ('0', 2, 1, 'mulu', ''), ('0', 3, 1, 'p', ''), ('0', 4, 3, 'note', '後')) x(doc_id, node_id, parent_id, tag, tail)")
def shred_xml_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of a document with mixed content; malformed ones have none."""
    rows = _rows(spark, "id string, content string", [(str(i), t[0]) for i, t in enumerate(_FIXTURE)])
    return xml_nodes.shred(rows, "id").select("doc_id", "node_id", "parent_id", "tag", "tail")


_LINES = [
    ("一切法空。（見海刊九卷）", "一切法空。", "（見海刊九卷）", None), ("無出處。", "無出處。", None, None), ("附：略說", "附：略說", None, "略說"), ("附錄", "附錄", None, "錄"), ("附 記", "附 記", None, "記"), ("正文", "正文", None, None),
]


@query(f"SELECT line, body, source, appendix FROM {_values(_LINES)} x(line, body, source, appendix)")
def line_splits(spark: SparkSession, d: str) -> DataFrame:
    """Closing sources cut off lines; subtitles of appendixes."""
    rows = _rows(spark, "line string", [(x[0],) for x in _LINES]).withColumn("s", tx.split_trailing_source(F.col("line")))
    return rows.select("line", "s.body", "s.source", tx.split_appendix_heading(F.col("line")).alias("appendix"))


_BLANKS = [("a\n\n\nb", "a\n\nb"), ("a\n \n\t\n\nb\nc", "a\n\nb\nc"), ("a\n\nb", "a\n\nb"), ("", "")]


@query(f"SELECT a.text, a.made FROM {_values(_BLANKS)} a(text, made)")
def blank_lines(spark: SparkSession, d: str) -> DataFrame:
    """Runs of blank lines as one."""
    return _rows(spark, "text string", [(x[0],) for x in _BLANKS]).select("text", sequences.collapse_blank(F.col("text")).alias("made"))


_DATED = [("發表於1930-01-02。", "1930", "01", "02"), ("1930.01.02", "1930", "01", "02"), ("民國十九年", None, None, None), ("", None, None, None)]


@query(f"SELECT t, y, m, dd, CASE t WHEN '1930-05-06' THEN '1930.05.06' ELSE t END AS dotted FROM {_values([*_DATED, ('1930-05-06', '1930', '05', '06')])} x(t, y, m, dd)")
def dates_in_text(spark: SparkSession, d: str) -> DataFrame:
    """Full dates and their parts; hyphens as dots."""
    rows = _rows(spark, "t string", [*((x[0],) for x in _DATED), ("1930-05-06",)])
    p = bylines.date_parts(F.col("t"))
    return rows.select("t", p["y"].alias("y"), p["m"].alias("m"), p["d"].alias("dd"), bylines.dotted_date(F.col("t")).alias("dotted"))


_WRITTEN = [
    ("民國十九年，見第三期", ["民國十九年"], ["第三期"]), ("十九，五，三講", ["十九，五，三"], []), ("見海刊九卷第九期與第二期", [], ["九卷九期", "第二期"]), ("無", [], []),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{'|'.join(a)}', '{'|'.join(b)}')" for t, a, b in _WRITTEN) + ") x(t, dates, patterns)")
def written_references(spark: SparkSession, d: str) -> DataFrame:
    """Era years, dates and issues as they are written."""
    rows = _rows(spark, "t string", [(x[0],) for x in _WRITTEN])
    return rows.select("t", F.array_join(issues.embedded_dates(F.col("t")), "|").alias("dates"), F.array_join(issues.raw_patterns(F.col("t")), "|").alias("patterns"))


_QUOTED = [("（見海刊九卷九期）載佛教月報，餘文", "海刊九卷九期|佛教月報"), ("錄自正信三卷。後", "正信三卷"), ("無", "")]


@query("SELECT * FROM " + _values(_QUOTED) + " x(line, refs)")
def introduced_references(spark: SparkSession, d: str) -> DataFrame:
    """References that verbs of quotation introduce."""
    return _rows(spark, "line string", [(x[0],) for x in _QUOTED]).select("line", F.array_join(issues.references(F.col("line")), "|").alias("refs"))


_CELLS = [("1卷1期", 1, 1), ("8卷4-5期", 8, 4), ("8卷11-2期", 8, 11), ("1期", None, 1), ("六卷3-4期（合刊）", 6, 3), ("一卷11期至三卷5期", 1, 11)]


@query(f"SELECT cell, vol, issue FROM {_values(_CELLS)} x(cell, vol, issue)")
def issue_cells(spark: SparkSession, d: str) -> DataFrame:
    """Volume and issue of table cells."""
    rows = _rows(spark, "cell string", [(x[0],) for x in _CELLS]).withColumn("c", issues.issue_cell(F.col("cell")))
    return rows.select("cell", "c.vol", "c.issue")


#: Names of periodicals in the fixtures, with their canonical ones.
_PERIODICALS = {"海潮音月刊": "海潮音", "見海刊": "海潮音", "海刊": "海潮音", "正信": "正信", "覺社叢書": "覺社叢書"}


_PARSED = [
    ("原見海潮音月刊十八卷十一期", "海潮音", 18, "11", "1937", "11", "15", None), ("見海刊九卷第九及十期", "海潮音", 9, "9,10", "", "", "", "見海刊九卷第九及十期"), ("散見正信二卷十一期至三卷五期", "正信", 2, "11", "1933", "02", "01", None),
    ("見覺社叢書第一期", "覺社叢書", None, "1", "1918", "10", "01", None), ("上海佛學書局印行", "上海佛學書局", None, None, "", "", "", None),
]


_DATES = [("海潮音", 18, 11, "1937-11-15"), ("海潮音", 9, 10, "1928-10-15"), ("正信", None, 11, "1933-02-01"), ("覺社叢書", 0, 1, "1918-10-01"), ("海潮音", 9, 9, "")]


def _references(spark: SparkSession) -> DataFrame:
    rows = _rows(spark, "text string", [(x[0],) for x in _PARSED])
    # bound once: as one expression per field it would outgrow generated code
    return rows.withColumn("r", tx.let(F.col("text"), lambda t: issues.parse_reference(t, _PERIODICALS))).select("text", "r.*")


@query(f"SELECT text, pub, vol, issues FROM {_values([x[:4] for x in _PARSED])} x(text, pub, vol, issues)")
def reference_parse(spark: SparkSession, d: str) -> DataFrame:
    """References to periodicals: name, volume, issues."""
    return _references(spark).select("text", "pub", "vol", F.array_join(F.transform("issues", lambda x: x.cast("string")), ",").alias("issues"))


@query(f"SELECT text, pub, y AS publish_y, m AS publish_m, dd AS publish_d, unmatched FROM {_values([(*x[:2], *x[4:]) for x in _PARSED])} x(text, pub, y, m, dd, unmatched)")
def resolve_dates(spark: SparkSession, d: str) -> DataFrame:
    """References resolved to dates by a cascade of keys; what fails is told."""
    return lookups.resolved_dates(_references(spark), _rows(spark, "pub string, vol int, issue int, date string", _DATES))


_KINDS = [("（見海刊九卷）", 0), ("——十九年一月在閩南佛學院講——", 2), ("（碧松記）", 3), ("太虛識", 4), ("", None), ("登載佛教月報", "several"), ("原載佛教月報", "other")]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{ {None: classify.EMPTY, 'other': classify.OTHER, 'several': classify.SEVERAL}.get(k) or classify.KINDS[k] }')" for t, k in _KINDS) + ") x(raw, kind)")
def byline_kinds(spark: SparkSession, d: str) -> DataFrame:
    """The kinds of bylines and notes."""
    return _rows(spark, "raw string", [(t,) for t, _ in _KINDS]).select("raw", classify.classify_byline(F.col("raw")).alias("kind"))


_LOG = [
    ("a1", ["三無性", "因緣"], ["經典講釋"]), ("../a2", ["三無性"], ["經典講釋"]), ("a2", ["三無性"], None), ("a3", ["因緣"], ["论理"]), ("/tmp/x", ["三無性"], ["經典講釋"]), ("a4", ["因緣", "新詞"], None),
]


_KNOWN = [("concepts", "因緣"), ("concepts", "法性"), ("functions", "論理")]


def _review(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    log = _rows(spark, "article_path string, concepts array<string>, functions array<string>", _LOG)
    known, words = _rows(spark, "dimension string, label string", _KNOWN), _rows(spark, "standard string, domain string", [("因緣", "緣起")])
    return reports.gap_review(log, known, words)


@query("SELECT * FROM (VALUES ('concepts', 3, 2), ('functions', 1, 1)) x(dimension, false_positives, gaps)")
def gap_report(spark: SparkSession, d: str) -> DataFrame:
    """False positives and real gaps of a log."""
    return _review(spark)[0].select("dimension", *(F.col(c).cast("int").alias(c) for c in ("false_positives", "gaps")))


@query("SELECT * FROM (VALUES ('concepts', '三無性', 2, '緣起'), ('functions', '经典講释', 2, NULL)) x(dimension, term, n, domain)")
def gap_additions(spark: SparkSession, d: str) -> DataFrame:
    """Terms that several articles miss, with the domain their company has."""
    return _review(spark)[1].select("dimension", "term", F.col("n").cast("int").alias("n"), "domain")


@query("SELECT * FROM (VALUES ('a1', '三無性', '經典講釋'), ('a2', '三無性', '經典講釋'), ('a2', '三無性', ''), ('/tmp/x', '三無性', '經典講釋'), ('a4', '新詞', '')) x(article_path, concepts, functions)")
def log_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """A log written, appended to, rewritten without false positives, and read back."""
    path, kind = shared_folder(spark, "log"), "article_path string, concepts array<string>, functions array<string>"
    log = _rows(spark, kind, _LOG)
    writers.append_log(log.limit(3), path)
    writers.append_log(log.exceptAll(log.limit(3)), path)
    back = writers.read_back(spark, path, "json", kind)
    writers.rewrite_log(reports.cleaned_log(back, _rows(spark, "dimension string, label string", _KNOWN)), path)
    done = writers.read_back(spark, path, "json", kind)
    return done.select("article_path", *(F.coalesce(F.array_join(c, ","), F.lit("")).alias(c) for c in ("concepts", "functions")))


_CATALOGUE = {"編": "法藏", "entries": [{"seq": 1, "name": "甲"}, {"seq": 2, "name": "乙"}]}


@query("SELECT * FROM (VALUES ('01_法藏', 0, 1, '甲'), ('01_法藏', 1, 2, '乙'), ('02_制藏', 0, 1, '甲'), ('02_制藏', 1, 2, '乙')) x(folder, entry_index, seq, name)")
def catalogue_folders(spark: SparkSession, d: str) -> DataFrame:
    """Entries of the catalogues in numbered folders."""
    path = shared_folder(spark, "catalogues")
    for folder, name in (("01_法藏", "法藏_編目錄.json"), ("02_制藏", "制藏_編目錄.json"), ("03_論藏", "other.json")):
        _rows(spark, "value string", [(json.dumps(_CATALOGUE, ensure_ascii=False),)]).coalesce(1).write.text(f"{path}/{folder}/{name}")
    found = files.read_catalogues(spark, path, "entries", "part-*")
    names = F.split(F.url_decode("file_name"), "/")
    rows = found.withColumn("folder", F.element_at(names, -3)).filter(F.element_at(names, -2).rlike("_編目錄\\.json$") & F.col("folder").rlike(r"^\d{2}_"))
    return rows.select("folder", F.col("entry_index").cast("int").alias("entry_index"), F.col("seq").cast("int").alias("seq"), "name")


_FRONTED = [
    ("---\na: 1\nthemes:\n  - x\n---\nconcepts: these matter\n", "---\na: 1\nconcepts:\n  - p\n  - q\nthemes:\n  - x\n---\nconcepts: these matter\n"),
    ("---\nconcepts:\n  - old\nb: 2\n---\nt", "---\nconcepts:\n  - p\n  - q\nb: 2\n---\nt"), ("---\na: 1\n---\n", "---\na: 1\nconcepts:\n  - p\n  - q\n---\n"), ("concepts: none\n", "concepts: none\n"),
]


@query(f"SELECT before, made FROM {_values(_FRONTED)} x(before, made)")
def front_matter_lists(spark: SparkSession, d: str) -> DataFrame:
    """Lists put into front matter and nowhere else."""
    items = F.array(F.lit("p"), F.lit("q"))
    return _rows(spark, "before string", [(a,) for a, _ in _FRONTED]).select("before", rendering.annotated(F.col("before"), {"concepts": items, "domains": F.lit(None).cast("array<string>")}).alias("made"))


_TEI = (
    '<text xmlns:cb="urn:x"><cb:div id="d1"><head>一緒言</head><byline>——十九年作——<note place="inline">見海刊</note></byline><p>本文<anchor id="n1"/>。</p><byline>（後記）</byline></cb:div>'
    '<cb:div id="d2"><head>附錄</head><p>附註：原載海潮音月刊</p><byline>晚</byline></cb:div><back><note target="#n1">原載正信三卷</note></back></text>'
)


def _nodes(spark: SparkSession) -> DataFrame:
    return xml_nodes.shred(_rows(spark, "id string, content string", [("t", _TEI)]), "id")


_APPENDED = (
    '<text xmlns:cb="urn:x"><cb:div><cb:mulu>講題</cb:mulu><head>講　題<anchor xml:id="nkr_note_orig_7"/></head><p>正文</p>'
    '<cb:div><cb:mulu>附　原文</cb:mulu><head>附　原文<anchor xml:id="beg_1"/></head><p>文</p><p>（附註）「原文」，二十四年七月講於莫干山；今附於此</p><byline>某記</byline></cb:div>'
    '<cb:div><cb:mulu>附：記</cb:mulu><byline>見海刊</byline><div><byline>民國十九年春作</byline></div></cb:div>'
    '<cb:div><cb:mulu>附二</cb:mulu><p>附註：無日</p></cb:div><cb:div><cb:mulu>結論</cb:mulu><byline>十年作</byline></cb:div></cb:div><cb:div/></text>'
)


@query("SELECT * FROM (VALUES ('附：原文', '（1935 年 7 月，在莫干山講）'), ('附：記', '（1930 年春，作）'), ('附：二', '')) x(title, date_place)")
def appendix_discovery(spark: SparkSession, d: str) -> DataFrame:
    """Appendixes of articles with date and place, of a dating note or a byline."""
    return documents.appendixes(xml_nodes.shred(_rows(spark, "id string, content string", [("t", _APPENDED)]), "id")).select("title", "date_place")


@query(
    "SELECT * FROM (VALUES ('講題', 'nkr_note_orig_7'), ('附原文', NULL), ('附：記', NULL), ('附二', NULL), ('結論', NULL), ('', NULL), ('', NULL)) x(text, anchor)"
)
def heading_anchors(spark: SparkSession, d: str) -> DataFrame:
    """Headings of divisions with the notes that their anchors name."""
    return documents.headings(xml_nodes.shred(_rows(spark, "id string, content string", [("t", _APPENDED)]), "id")).select("text", "anchor")


@query("SELECT * FROM (VALUES ('t', '——十九年作——見海刊')) x(doc_id, text)")
def bylines_before_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Bylines that stand before any paragraph of their division."""
    return documents.first_bylines(_nodes(spark)).select("doc_id", "text")


@query("SELECT * FROM (VALUES ('t', 'byline', '——十九年作——見海刊'), ('t', 'byline', '（後記）'), ('t', 'byline', '晚'), ('t', 'inline_note', '見海刊'), ('t', 'paragraph', '附註：原載海潮音月刊'), ('t', 'back_note', '原載正信三卷')) x(doc_id, type, raw_text)")
def end_matter(spark: SparkSession, d: str) -> DataFrame:
    """Bylines, inline notes, paragraphs and back notes on publication."""
    return documents.end_matter(_nodes(spark)).select("doc_id", "type", "raw_text")


@query("SELECT * FROM (VALUES ('t', 1, 'n1', '原載正信三卷')) x(doc_id, seq, target, text)")
def anchored_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes in the order of their anchors."""
    return documents.anchored_notes(_nodes(spark))


_MD = "# 第1章\n\n| a | b |\n|---|---|\n| 1 | 2 |\n| 3 | 4 |\n\n## 節\n\n| c |\n|---|\n| 5 |\n"


@query("SELECT * FROM (VALUES ('m', 4, '第1章', NULL, '1,2'), ('m', 5, '第1章', NULL, '3,4'), ('m', 11, '第1章', '節', '5')) x(path, line_no, section, heading, cells)")
def markdown_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of Markdown tables with their section and heading."""
    return files.markdown_tables(_rows(spark, "path string, text string", [("m", _MD)])).select("path", "line_no", "section", "heading", F.array_join("cells", ",").alias("cells"))


@query("SELECT * FROM (VALUES ('m', 0, '第1章', NULL), ('m', 1, '第1章', NULL), ('m', 2, '第1章', '節')) x(path, n, section, heading)")
def report_read_back(spark: SparkSession, d: str) -> DataFrame:
    """A report read back: the headings that each line stands under."""
    lines = _rows(spark, "path string, n int, line string", [("m", 0, "# 第1章"), ("m", 1, "- x"), ("m", 2, "## 節")])
    return files.carried(lines, "path", "n", "line", {"section": r"^# (.*)$", "heading": r"^## (.*)$"}).select("path", "n", "section", "heading")


_ARTICLE = "---\nk: v\n---\n# 題目 [3]\n\n## 目錄\n- a\n\n## 一\n正文\n"


@query("SELECT * FROM (VALUES ('題目', 'v', 'x')) t(title, k, fallback)")
def article_read(spark: SparkSession, d: str) -> DataFrame:
    """Title, front matter and body of an article."""
    rows = _rows(spark, "text string, book string", [(_ARTICLE, "x")]).withColumn("body", files.body(F.col("text"))).filter("not contains(body, '目錄') and contains(body, '正文')")
    return rows.select(files.title(F.col("body"), F.col("book")).alias("title"), files.front_matter(F.col("text"))["k"].alias("k"), files.title(F.lit("no heading"), F.col("book")).alias("fallback"))


@pytest.mark.parametrize("name", sorted(FOUND))
def test_fixture(spark, name):
    run, oracle = FOUND[name]
    got = run(spark, "")
    columns = sorted(got.columns)
    r = duckdb.connect().execute(oracle)
    names = [x[0] for x in r.description]
    at = [names.index(c) for c in columns]
    assert sorted(repr(tuple(x[c] for c in columns)) for x in got.collect()) == sorted(repr(tuple(x[i] for i in at)) for x in r.fetchall())
