"""Queries of text functions over texts that are made of the tables' numbers, so that SQL knows from the numbers what must come out.

Inputs are written in the SQL that both engines share; what is expected of a text never reads the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import bylines, classify, issues, numerals
from lexmill.functions import text as tx
from lexmill.operators import documents, gaps, lookups, rendering, reports, sequences
from lexmill.plans.catalogue import query
from lexmill.plans.ordered import _sql_label
from lexmill.session import shared_folder, spread, table
from lexmill.sources import files, versions, writers, xml_nodes


def num(n: str) -> str:
    """The numeral of a number from 1 to 99."""
    digit = lambda x: f"substr('一二三四五六七八九', CAST({x} AS INT), 1)"
    tens = f"CASE WHEN {n} >= 20 THEN {digit(f'floor({n} / 10)')} ELSE '' END"
    ones = f"CASE WHEN {n} % 10 > 0 THEN {digit(f'{n} % 10')} ELSE '' END"
    return f"(CASE WHEN {n} < 10 THEN {digit(n)} ELSE concat({tens}, '十', {ones}) END)"


def text(n: str) -> str:
    return f"CAST({n} AS STRING)"


def of(by: str, *choices: str) -> str:
    """One of some expressions, by a number's remainder."""
    return f"(CASE {by} % {len(choices)} " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(choices)) + " END)"


# -- numerals, dates, bylines -----------------------------------------------------------------

_N = "(p_partkey % 99 + 1)"
_D = "(p_partkey % 9 + 1)"
_NUMERAL = of("p_size", num(_N), f"translate({text(_N)}, '0123456789', '０１２３４５６７８９')", f"concat('廿', {num(_D)})", f"concat({num(_D)}, '百', {num(_N)})", f"concat({num(_D)}, '四', {num('(p_partkey % 7 + 1)')})", f"concat('x', {num(_D)})")


@query(
    f"""SELECT p_partkey, {_NUMERAL} AS numeral, (CASE p_size % 6 WHEN 0 THEN {_N} WHEN 1 THEN {_N} WHEN 4 THEN p_partkey % 7 + 1 END)::INT AS small,
      (CASE p_size % 6 WHEN 0 THEN {_N} WHEN 1 THEN {_N} WHEN 3 THEN {_D} * 100 + {_N} WHEN 4 THEN {_D} * 100 + 40 + p_partkey % 7 + 1 END)::INT AS wide FROM part"""
)
def numeral_parse(spark: SparkSession, d: str) -> DataFrame:
    """Numerals of six forms by the narrow and by the wide rule."""
    rows = table(spark, d, "part").selectExpr("p_partkey", f"{_NUMERAL} AS numeral")
    return rows.select("p_partkey", "numeral", numerals.small_numeral(F.col("numeral")).alias("small"), numerals.wide_numeral(F.col("numeral")).alias("wide"))


def _orders(spark: SparkSession, d: str) -> DataFrame:
    """Keys of orders over all tasks, for texts whose reading costs far more than the keys."""
    return spread(table(spark, d, "orders").select("o_orderkey", "o_custkey"))


_Y, _M = "(o_custkey % 60 + 1)", "(o_orderkey % 12 + 1)"
_PLACE, _SEASON, _VERB = of("o_custkey", "'閩南佛學院'", "'普陀'", "'武昌'"), of("o_orderkey", "'春'", "'夏'", "'秋'", "'冬'"), of("o_custkey", "'講'", "'編述'")
_BYLINE = of(
    "o_orderkey", f"concat('——', {num(_Y)}, '年', {num(_M)}, '月在', {_PLACE}, {_VERB}, '——')", f"concat('——民國', {num(_Y)}, '年', {_SEASON}, '作於', {_PLACE}, '——')",
    f"concat('——宣統', {num('(o_custkey % 3 + 1)')}, '年作——')", f"concat('（', {_PLACE}, '記）')", f"concat('見海刊', {num(_Y)}, '卷')",
)
_KIND = "o_orderkey % 5"


@query(
    f"""SELECT o_orderkey, {_BYLINE} AS raw, CASE {_KIND} WHEN 0 THEN concat('（', 1911 + {_Y}, ' 年 ', {_M}, ' 月，在', {_PLACE}, {_VERB}, '）') WHEN 1 THEN concat('（', 1911 + {_Y}, ' 年', {_SEASON}, '，作於', {_PLACE}, '）')
      WHEN 2 THEN concat('（', 1909 + o_custkey % 3, ' 年，作）') WHEN 3 THEN concat('（', {_PLACE}, '記）') ELSE '' END AS normal,
      CASE {_KIND} WHEN 0 THEN {text(f'1911 + {_Y}')} WHEN 1 THEN {text(f'1911 + {_Y}')} WHEN 2 THEN {text('1909 + o_custkey % 3')} ELSE '' END AS create_y,
      CASE {_KIND} WHEN 0 THEN lpad({text(_M)}, 2, '0') WHEN 1 THEN {of('o_orderkey', "'03'", "'06'", "'09'", "'12'")} ELSE '' END AS create_m,
      CASE WHEN {_KIND} IN (0, 1, 3) THEN {_PLACE} ELSE '' END AS location, CASE {_KIND} WHEN 0 THEN {_VERB} WHEN 1 THEN '作' WHEN 2 THEN '作' WHEN 3 THEN '記' ELSE '' END AS context FROM orders"""
)
def byline_fields(spark: SparkSession, d: str) -> DataFrame:
    """Bylines of five forms in common years, and their parts."""
    rows = _orders(spark, d).selectExpr("o_orderkey", f"{_BYLINE} AS raw").withColumn("normal", bylines.normalize_byline(F.col("raw")))
    rows = rows.withColumn("f", bylines.byline_fields(F.col("normal")))
    return rows.select("o_orderkey", "raw", "normal", "f.create_y", "f.create_m", "f.location", "f.context")


_DATE = of("o_orderkey", "concat('發表於', date_text, '。')", "replace(date_text, '-', '.')", "date_text", "concat('民國', substr(date_text, 3, 2), '年')")


@query(
    f"""SELECT o_orderkey, t, CASE WHEN o_orderkey % 4 < 3 THEN substr(date_text, 1, 4) END AS y, CASE WHEN o_orderkey % 4 < 3 THEN substr(date_text, 6, 2) END AS m,
      CASE WHEN o_orderkey % 4 < 3 THEN substr(date_text, 9, 2) END AS dd, CASE WHEN o_orderkey % 4 = 2 THEN replace(date_text, '-', '.') ELSE t END AS dotted
    FROM (SELECT *, {_DATE} AS t FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_text FROM orders))"""
)
def dates_in_text(spark: SparkSession, d: str) -> DataFrame:
    """Full dates and their parts; hyphens as dots."""
    rows = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text")).selectExpr("o_orderkey", f"{_DATE} AS t")
    p = bylines.date_parts(F.col("t"))
    return rows.select("o_orderkey", "t", p["y"].alias("y"), p["m"].alias("m"), p["d"].alias("dd"), bylines.dotted_date(F.col("t")).alias("dotted"))


# -- headings and lines -----------------------------------------------------------------------

_HN = "(p_partkey % 20 + 1)"
_HEADING = of("p_size", f"concat('第', {num(_HN)}, '章緒論')", f"concat('甲', {num(_HN)}, '序分')", "'乙色蘊'", f"concat({num(_HN)}, '結論')", "'子、總說'", "'緒論'")
_SPACED = (
    f"CASE p_size % 6 WHEN 0 THEN concat('第', {num(_HN)}, '章　緒論') WHEN 1 THEN concat('甲', {num(_HN)}, '　序分') WHEN 2 THEN '乙　色蘊' "
    f"WHEN 3 THEN concat(substr({num(_HN)}, 1, 1), '　', substr({num(_HN)}, 2), '結論') WHEN 4 THEN '子、總說' ELSE '緒論' END"
)
_PARENT = of("p_partkey", "'篇'", "'部'", "'章'", "'節'", "'小節'", "'小小節'", "''")


@query(f"SELECT p_partkey, heading, spaced, parent, {_sql_label('spaced', 'parent')} AS label FROM (SELECT p_partkey, {_HEADING} AS heading, {_SPACED} AS spaced, {_PARENT} AS parent FROM part)")
def heading_spacing(spark: SparkSession, d: str) -> DataFrame:
    """Headings with a space behind their ordinal, and their labels under a parent."""
    rows = table(spark, d, "part").selectExpr("p_partkey", f"{_HEADING} AS heading", f"{_PARENT} AS parent").withColumn("spaced", tx.space_heading(F.col("heading")))
    return rows.withColumn("label", tx.semantic_label(F.col("spaced"), F.col("parent")))


_LINE = of("p_size", "concat(p_name, '。（見', p_brand, '）')", "concat(p_name, '（見', p_brand, '）。')", "concat('附：', p_name)", "concat('附', p_name)", "p_name")


@query(
    f"""SELECT p_partkey, {_LINE} AS line, CASE p_size % 5 WHEN 0 THEN p_name || '。' ELSE {_LINE} END AS body, CASE p_size % 5 WHEN 0 THEN '（見' || p_brand || '）' END AS source,
      CASE WHEN p_size % 5 IN (2, 3) THEN p_name END AS appendix FROM part"""
)
def line_splits(spark: SparkSession, d: str) -> DataFrame:
    """Closing sources cut off lines; subtitles of appendixes."""
    rows = table(spark, d, "part").selectExpr("p_partkey", f"{_LINE} AS line").withColumn("s", tx.split_trailing_source(F.col("line")))
    return rows.select("p_partkey", "line", "s.body", "s.source", tx.split_appendix_heading(F.col("line")).alias("appendix"))


_K = "(p_size % 5 + 1)"
_BLANK = f"concat(p_name, repeat({of('p_partkey', 'chr(10)', 'concat(chr(10), chr(32))', 'concat(chr(10), chr(9))')}, CAST({_K} - 1 AS INT)), chr(10), p_brand)"


@query(f"SELECT p_partkey, {_BLANK} AS text, CASE WHEN {_K} >= 3 THEN p_name || chr(10) || chr(10) || p_brand ELSE {_BLANK} END AS made FROM part")
def blank_lines(spark: SparkSession, d: str) -> DataFrame:
    """Runs of blank lines as one."""
    return table(spark, d, "part").selectExpr("p_partkey", f"{_BLANK} AS text").withColumn("made", sequences.collapse_blank(F.col("text")))


@query("SELECT p_size AS vol, 1919 + p_size AS year, 8 + p_size AS era_year, count(*)::BIGINT AS n FROM part GROUP BY p_size")
def year_table(spark: SparkSession, d: str) -> DataFrame:
    """Volumes with their years, and the parts of that size."""
    part = table(spark, d, "part").groupBy("p_size").agg(F.count(F.lit(1)).alias("n"))
    return sequences.year_table(spark, 60).join(part, F.col("vol") == F.col("p_size")).select("vol", "year", "era_year", "n")


# -- references to periodicals ------------------------------------------------------------------

_V, _I = "(o_custkey % 20 + 1)", "(o_orderkey % 8 + 1)"
_J = f"({_I} + 1)"
_REF = of(
    "o_orderkey", f"concat({num(_V)}, '卷', {num(_I)}, '至', {num(_J)}, '期')", f"concat({num(_V)}, '卷', {num(_I)}, '期至', {num(f'({_V} + 1)')}, '卷', {num(_J)}, '期')", f"concat({num(_V)}, '卷', {num(_I)}, {num(_J)}, '期')",
    f"concat('第', {num(_I)}, '期')", f"concat({num(_I)}, '、', {num(_J)}, '各期')", f"concat('第', {num(_V)}, '卷第', {num(_I)}, '號')", "'無卷期'",
)


@query(
    f"""WITH o AS (SELECT o_orderkey, {_V}::INT AS v, {_I}::INT AS i, {_J}::INT AS j, o_orderkey % 7 AS f, {_REF} AS ref FROM orders),
    p AS (
      SELECT o_orderkey, ref, v AS vol, {text('i')} AS issue FROM o WHERE f IN (0, 2, 5) UNION ALL SELECT o_orderkey, ref, v, {text('j')} FROM o WHERE f IN (0, 2)
      UNION ALL SELECT o_orderkey, ref, v, {text('x')} FROM (SELECT *, unnest(range(i, 13)) AS x FROM o WHERE f = 1) UNION ALL SELECT o_orderkey, ref, v + 1, {text('x')} FROM (SELECT *, unnest(range(1, j + 1)) AS x FROM o WHERE f = 1)
      UNION ALL SELECT o_orderkey, ref, v, i || '-' || j FROM o WHERE f = 2 UNION ALL SELECT o_orderkey, ref, NULL, {text('i')} FROM o WHERE f IN (2, 3, 4)
      UNION ALL SELECT o_orderkey, ref, NULL, {text('j')} FROM o WHERE f IN (2, 4) UNION ALL SELECT o_orderkey, ref, NULL, i || '-' || j FROM o WHERE f = 4)
    SELECT o_orderkey, ref, vol, issue, CASE WHEN vol IS NULL THEN '第' || issue || '期' ELSE vol || '卷' || issue || '期' END AS label FROM p"""
)
def vol_issue_extract(spark: SparkSession, d: str) -> DataFrame:
    """References of seven forms expanded to one row per volume and issue."""
    rows = _orders(spark, d).selectExpr("o_orderkey", f"{_REF} AS ref").select("o_orderkey", "ref", F.explode(issues.parse_issues(F.col("ref"))).alias("p"))
    return rows.select("o_orderkey", "ref", "p.vol", "p.issue", issues.issue_label(F.col("p.vol"), F.col("p.issue")).alias("label"))


_WRITTEN = of("o_orderkey", f"concat('民國', {num(_Y)}, '年，見第', {num(_I)}, '期')", f"concat({num(_Y)}, '，', {num(_I)}, '，', {num(_J)}, '講')", f"concat('見海刊', {num(_V)}, '卷第', {num(_I)}, '期與第', {num(_J)}, '期')", "'無'")


@query(
    f"""SELECT o_orderkey, {_WRITTEN} AS t, CASE o_orderkey % 4 WHEN 0 THEN '民國' || {num(_Y)} || '年' WHEN 1 THEN {num(_Y)} || '，' || {num(_I)} || '，' || {num(_J)} ELSE '' END AS dates,
      CASE o_orderkey % 4 WHEN 0 THEN '第' || {num(_I)} || '期' WHEN 2 THEN {num(_V)} || '卷' || {num(_I)} || '期|第' || {num(_J)} || '期' ELSE '' END AS patterns FROM orders WHERE {_Y} <> 40"""
)
def written_references(spark: SparkSession, d: str) -> DataFrame:
    """Era years, dates and issues as they are written."""
    rows = table(spark, d, "orders").filter(f"{_Y} <> 40").selectExpr("o_orderkey", f"{_WRITTEN} AS t")
    return rows.select("o_orderkey", "t", F.array_join(issues.embedded_dates(F.col("t")), "|").alias("dates"), F.array_join(issues.raw_patterns(F.col("t")), "|").alias("patterns"))


_QUOTED = of("o_orderkey", f"concat('（見海刊', {num(_V)}, '卷）載佛教月報，餘文')", f"concat('錄自正信', {num(_I)}, '期。後')", "'無'", f"concat('見海刊', {num(_V)}, '卷')")


@query(f"SELECT o_orderkey, {_QUOTED} AS line, CASE o_orderkey % 4 WHEN 0 THEN '海刊' || {num(_V)} || '卷|佛教月報' WHEN 1 THEN '正信' || {num(_I)} || '期' WHEN 3 THEN '海刊' || {num(_V)} || '卷' ELSE '' END AS refs FROM orders")
def introduced_references(spark: SparkSession, d: str) -> DataFrame:
    """References that verbs of quotation introduce."""
    rows = table(spark, d, "orders").selectExpr("o_orderkey", f"{_QUOTED} AS line")
    return rows.select("o_orderkey", "line", F.array_join(issues.references(F.col("line")), "|").alias("refs"))


_CELL = of(
    "o_orderkey", f"concat({_V}, '卷', {_I}, '期')", f"concat({_V}, '卷', {_I}, '-', {_J}, '期')", f"concat({_I}, '期')", f"concat({num(_V)}, '卷', {_I}, '-', {_J}, '期（合刊）')",
    f"concat({num(_V)}, '卷', {_I}, '期至', {num(f'({_V} + 1)')}, '卷', {_J}, '期')", "'無'",
)


@query(f"SELECT o_orderkey, {_CELL} AS cell, (CASE WHEN o_orderkey % 6 NOT IN (2, 5) THEN {_V} END)::INT AS vol, (CASE WHEN o_orderkey % 6 <> 5 THEN {_I} END)::INT AS issue FROM orders")
def issue_cells(spark: SparkSession, d: str) -> DataFrame:
    """Volume and issue of table cells."""
    rows = table(spark, d, "orders").selectExpr("o_orderkey", f"{_CELL} AS cell").withColumn("c", issues.issue_cell(F.col("cell")))
    return rows.select("o_orderkey", "cell", "c.vol", "c.issue")


#: Names of periodicals, with their canonical ones: a parameter of the parser.
_PERIODICALS = {"海潮音月刊": "海潮音", "見海刊": "海潮音", "海刊": "海潮音", "正信": "正信", "覺社叢書": "覺社叢書"}
_PUB = of("o_orderkey", "'海潮音'", "'海潮音'", "'正信'", "'覺社叢書'", "'上海佛學書局'")
_REFERENCE = of(
    "o_orderkey", f"concat('原見海潮音月刊', {num(_V)}, '卷', {num(_I)}, '期')", f"concat('見海刊', {num(_V)}, '卷第', {num(_I)}, '及', {num(_J)}, '期')", f"concat('散見正信', {num(_V)}, '卷', {_I}, '期至', {num(f'({_V} + 1)')}, '卷', {_J}, '期')",
    f"concat('見覺社叢書第', {num(_I)}, '期')", "'上海佛學書局印行'",
)
_VOL = f"(CASE WHEN o_orderkey % 5 < 3 THEN {_V} END)::INT"


def _references(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d).selectExpr("o_orderkey", f"concat({_REFERENCE}, '') AS text")
    # bound once: as one expression per field it would outgrow generated code
    return rows.withColumn("r", tx.let(F.col("text"), lambda t: issues.parse_reference(t, _PERIODICALS))).select("o_orderkey", "text", "r.*")


@query(f"SELECT o_orderkey, {_REFERENCE} AS text, {_PUB} AS pub, {_VOL} AS vol, CASE o_orderkey % 5 WHEN 1 THEN {_I} || ',' || {_J} WHEN 4 THEN NULL ELSE {text(_I)} END AS issues FROM orders")
def reference_parse(spark: SparkSession, d: str) -> DataFrame:
    """References to periodicals: name, volume, issues."""
    return _references(spark, d).select("o_orderkey", "text", "pub", "vol", F.array_join(F.transform("issues", lambda x: x.cast("string")), ",").alias("issues"))


#: Of the periodicals' dates: some issues with volume, some with none or zero, some whose date is empty.
_DATED = f"""SELECT DISTINCT pub, vol, issue, date FROM (SELECT {_PUB} AS pub, CAST(CASE WHEN {_V} % 3 = 0 THEN NULL WHEN o_orderkey % 5 = 3 THEN 0 ELSE {_V} END AS INT) AS vol, CAST({_I} AS INT) AS issue,
  CASE WHEN {_V} % 3 = 0 THEN concat('19', 20 + {_I}, '.01.01') WHEN {_V} % 4 = 0 THEN '' WHEN o_orderkey % 5 = 3 THEN concat('1918-0', {_I}, '-01') ELSE concat('19', 10 + {_V}, '-0', {_I}, '-15') END AS date FROM orders WHERE o_orderkey % 5 < 4 AND {_I} % 4 < 3) x
  WHERE NOT (pub = '覺社叢書' AND vol = 0 AND date = '')"""


@query(
    f"""WITH t AS (SELECT pub, vol, issue, min(date) AS date FROM ({_DATED}) GROUP BY ALL),
    q AS (SELECT o_orderkey, {_REFERENCE} AS text, {_PUB} AS pub, {_VOL} AS vol, (CASE WHEN o_orderkey % 5 < 4 THEN {_I} END)::INT AS issue FROM orders),
    f AS (SELECT q.*, CASE WHEN a.date IS NOT NULL THEN a.date WHEN b.date IS NOT NULL THEN b.date ELSE c.date END AS date FROM q
      LEFT JOIN t a ON a.pub = q.pub AND a.vol IS NOT DISTINCT FROM q.vol AND a.issue = q.issue LEFT JOIN t b ON b.pub = q.pub AND b.vol IS NULL AND b.issue = q.issue LEFT JOIN t c ON c.pub = q.pub AND c.vol = 0 AND c.issue = q.issue)
    SELECT text, pub, coalesce(substr(date, 1, 4), '') AS publish_y, coalesce(substr(date, 6, 2), '') AS publish_m, coalesce(substr(date, 9, 2), '') AS publish_d,
      CASE WHEN issue IS NOT NULL AND coalesce(date, '') = '' THEN text END AS unmatched FROM f"""
)
def resolve_dates(spark: SparkSession, d: str) -> DataFrame:
    """References resolved to dates by a cascade of keys; what fails is told."""
    table(spark, d, "orders").createOrReplaceTempView("lexmill_dated_orders")
    dates = spark.sql(_DATED.replace("FROM orders", "FROM lexmill_dated_orders")).groupBy("pub", "vol", "issue").agg(F.min("date").alias("date"))
    return lookups.resolved_dates(_references(spark, d), dates)


_NOTE = of(
    "o_orderkey", f"concat('（見海刊', {num(_V)}, '卷）')", f"concat('——', {num(_Y)}, '年', {num(_M)}, '月在', {_PLACE}, '講——')", f"concat('（', {_PLACE}, '記）')", "'太虛識'", "''", "'登載佛教月報'", "'原載佛教月報'", "'佛學書局印行'",
)


@query(f"SELECT o_orderkey, {_NOTE} AS raw, {of('o_orderkey', *(repr(k) for k in (classify.KINDS[0], classify.KINDS[2], classify.KINDS[3], classify.KINDS[4], classify.EMPTY, classify.SEVERAL, classify.OTHER, classify.KINDS[1])))} AS kind FROM orders")
def byline_kinds(spark: SparkSession, d: str) -> DataFrame:
    """The kinds of bylines and notes."""
    return table(spark, d, "orders").selectExpr("o_orderkey", f"{_NOTE} AS raw").withColumn("kind", classify.classify_byline(F.col("raw")))


# -- gaps ---------------------------------------------------------------------------------------

_GK = "CAST(substr(props, 7, length(props) - 7) AS INT)"
_RAW = of(_GK, "'因緣（因緣生法）'", "'三無性'", "'經論'", "'观行'", "'法性'", "'緣起'", "'新詞'")
_NORMAL = of(_GK, "'因緣'", "'三無性'", "'经论'", "'观行'", "'法性'", "'緣起'", "'新詞'")
_FUNCTION = of("user_id", "'經論講釋'", "'说法'", "'應世'")
_FUNCTION_NORMAL = of("user_id", "'经论講释'", "'说法'", "'应世'")
_PATH = of("event_id", "concat('../a', user_id)", "concat('a', user_id)", "concat('/tmp/a', user_id)", "concat('a', user_id)")
_KNOWN = [("concepts", "因緣"), ("concepts", "法性"), ("functions", "說法")]
_VOCABULARY = [("因緣", "緣起"), ("法性", "性相")]
_TERMS = f"""e AS (SELECT event_id, user_id AS a, event_id % 4 AS f, event_id % 3 AS g, {_NORMAL} AS c, {_RAW} AS raw, {_FUNCTION_NORMAL} AS fn, {_GK} AS k FROM events),
    t AS (SELECT 'a' || a AS article, 'concepts' AS dimension, CASE WHEN g = 0 THEN c WHEN k % 7 = 0 THEN '因緣（因緣生法）' ELSE c END AS term FROM e WHERE f <> 2
      UNION ALL SELECT 'a' || a, 'functions', fn FROM e WHERE f <> 2 AND g = 1),
    u AS (SELECT * FROM t WHERE (dimension, term) NOT IN (('concepts', '因緣'), ('concepts', '法性'), ('functions', '说法')))"""


def _gap_log(spark: SparkSession, d: str) -> DataFrame:
    """A log of both generations: every third row lists gap_terms, the others dimensions."""
    rows = table(spark, d, "events").selectExpr("event_id", f"{_PATH} AS article_path", f"{_RAW} AS raw", f"{_FUNCTION} AS fn", "event_id % 3 AS g")
    one = lambda c, when: F.when(when, F.array(c))
    return rows.select("article_path", one("raw", F.col("g") != 0).alias("concepts"), one("fn", F.col("g") == 1).alias("functions"), one("raw", F.col("g") == 0).alias("gap_terms"))


def _known(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_KNOWN, "dimension string, label string")


@query(f"WITH {_TERMS} SELECT dimension, term, count(DISTINCT article)::BIGINT AS n FROM u GROUP BY dimension, term HAVING count(DISTINCT article) >= 2")
def label_normalize_gap(spark: SparkSession, d: str) -> DataFrame:
    """Unknown labels of two or more articles, in normal form, of both generations of a log."""
    return gaps.gap_frequency(gaps.unknown_terms(gaps.gap_terms(_gap_log(spark, d)), _known(spark)))


@query(f"WITH {_TERMS} SELECT dimension, count(*)::BIGINT - coalesce(max(n), 0)::BIGINT AS false_positives, coalesce(max(m), 0)::BIGINT AS gaps FROM t LEFT JOIN (SELECT dimension, count(*) AS n, count(DISTINCT term) AS m FROM u GROUP BY dimension) USING (dimension) GROUP BY dimension")
def gap_report(spark: SparkSession, d: str) -> DataFrame:
    """False positives and real gaps of a log."""
    report, _, _ = reports.gap_review(_gap_log(spark, d), _known(spark), spark.createDataFrame(_VOCABULARY, "standard string, domain string"))
    return report


#: The additions that a review finds, behind _TERMS.
ORACLE_ADDITIONS = f"""WITH c AS (SELECT article, term FROM t WHERE dimension = 'concepts'), v AS (SELECT * FROM (VALUES ('因緣', '緣起'), ('法性', '性相')) v(other, domain)),
    m AS (SELECT x.term, x.article, v.domain FROM (SELECT DISTINCT article, term FROM c) x JOIN c y ON x.article = y.article AND y.term <> x.term JOIN v ON v.other = y.term),
    w AS (SELECT term, domain FROM m GROUP BY term, domain QUALIFY row_number() OVER (PARTITION BY term ORDER BY count(*) DESC, min(article), domain) = 1)
    SELECT dimension, u.term, count(DISTINCT article)::BIGINT AS n, CASE WHEN dimension = 'concepts' THEN coalesce(max(domain), '教理') END AS domain FROM u LEFT JOIN w ON w.term = u.term GROUP BY dimension, u.term HAVING count(DISTINCT article) >= 2"""


@query(f"WITH {_TERMS}, g AS ({ORACLE_ADDITIONS}) SELECT * FROM g")
def gap_additions(spark: SparkSession, d: str) -> DataFrame:
    """Terms that several articles miss, with the domain their company has."""
    _, additions, _ = reports.gap_review(_gap_log(spark, d), _known(spark), spark.createDataFrame(_VOCABULARY, "standard string, domain string"))
    return additions.select("dimension", "term", "n", "domain")


@query(
    f"""SELECT CASE WHEN f = 2 THEN '/tmp/a' || a ELSE 'a' || a END AS article_path, CASE WHEN g = 0 OR (f <> 2 AND (k % 7 = 0 OR k % 7 = 4)) THEN '' ELSE raw END AS concepts,
      CASE WHEN g = 1 AND (f = 2 OR fn <> '说法') THEN rawf ELSE '' END AS functions, CASE WHEN g = 0 AND (f = 2 OR (k % 7 <> 0 AND k % 7 <> 4)) THEN raw ELSE '' END AS gap_terms
    FROM (SELECT event_id, user_id AS a, event_id % 4 AS f, event_id % 3 AS g, {_GK} AS k, {_RAW} AS raw, {_FUNCTION} AS rawf, {_FUNCTION_NORMAL} AS fn FROM events)
    WHERE f = 2 OR (g = 1 AND fn <> '说法') OR k % 7 NOT IN (0, 4)"""
)
def log_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """A log written, appended to, and replaced by a version without false positives; test rows stay as they are."""
    base, kind = shared_folder(spark, "gaplog"), "article_path string, concepts array<string>, functions array<string>, gap_terms array<string>"
    versions.replace_log(_gap_log(spark, d), base)
    versions.replace_log(reports.cleaned_log(versions.read_log_version(spark, base, kind), _known(spark)), base)
    done = versions.read_log_version(spark, base, kind)
    return done.select("article_path", *(F.coalesce(F.array_join(c, ","), F.lit("")).alias(c) for c in ("concepts", "functions", "gap_terms")))


# -- trees of elements -----------------------------------------------------------------------------

_TEI = f"""concat('<text xmlns:cb="urn:x"><cb:div id="d', c_custkey, '"><head>', {num('(c_custkey % 90 + 1)')}, '緒言</head><byline>——', {num('(c_custkey % 60 + 1)')}, '年作——<note place="inline">見海刊', c_custkey, '</note></byline><p>本文<anchor id="n', c_custkey, '"/>。</p>',
  CASE WHEN c_custkey % 2 = 0 THEN '<byline>（後記）</byline>' ELSE '' END, '</cb:div><cb:div><head>附錄</head><p>附註：原載海潮音月刊', c_nationkey, '</p><byline>晚</byline></cb:div><back><note target="#n', c_custkey, '">', CASE WHEN c_custkey % 3 = 0 THEN '無關' ELSE '原載正信' END, c_nationkey, '</note></back></text>')"""


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    rows = spread(table(spark, d, "customer").select("c_custkey", "c_nationkey")).selectExpr("CAST(c_custkey AS STRING) AS id", f"{_TEI} AS content")
    return xml_nodes.shred(rows, "id")


@query(
    """SELECT tag, count(*)::BIGINT AS n, max(depth)::INT AS deepest FROM (SELECT c_custkey, unnest(['text', 'div', 'head', 'byline', 'note', 'p', 'anchor', 'div', 'head', 'p', 'byline', 'back', 'note']) AS tag, unnest([0, 1, 2, 2, 3, 2, 3, 1, 2, 2, 2, 1, 2]) AS depth FROM customer
      UNION ALL SELECT c_custkey, 'byline', 2 FROM customer WHERE c_custkey % 2 = 0) GROUP BY tag"""
)
def shred_xml_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of a document for every customer, by tag."""
    return _nodes(spark, d).groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("deepest"))


@query(f"SELECT {text('c_custkey')} AS doc_id, concat('——', {num('(c_custkey % 60 + 1)')}, '年作——見海刊', c_custkey) AS text FROM customer")
def bylines_before_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Bylines that stand before any paragraph of their division."""
    return documents.first_bylines(_nodes(spark, d)).select("doc_id", "text")


@query(
    f"""SELECT {text('c_custkey')} AS doc_id, type, raw_text, byline_type FROM (
      SELECT c_custkey, 'byline' AS type, concat('——', {num('(c_custkey % 60 + 1)')}, '年作——見海刊', c_custkey) AS raw_text, '讲演信息' AS byline_type FROM customer
      UNION ALL SELECT c_custkey, 'byline', '（後記）', '记録者' FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'byline', '晚', '其他' FROM customer
      UNION ALL SELECT c_custkey, 'inline_note', concat('見海刊', c_custkey), '刊载出处' FROM customer UNION ALL SELECT c_custkey, 'paragraph', concat('附註：原載海潮音月刊', c_nationkey), '出处说明' FROM customer
      UNION ALL SELECT c_custkey, 'back_note', concat('原載正信', c_nationkey), '其他' FROM customer WHERE c_custkey % 3 <> 0)"""
)
def end_matter(spark: SparkSession, d: str) -> DataFrame:
    """Bylines, inline notes, paragraphs and back notes on publication, with their kinds."""
    return documents.end_matter(_nodes(spark, d)).select("doc_id", "type", "raw_text", "byline_type")


@query(f"SELECT {text('c_custkey')} AS doc_id, 1 AS seq, concat('n', c_custkey) AS target, concat(CASE WHEN c_custkey % 3 = 0 THEN '無關' ELSE '原載正信' END, c_nationkey) AS text FROM customer")
def anchored_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes in the order of their anchors."""
    return documents.anchored_notes(_nodes(spark, d))


_AY, _AM = "(c_custkey % 60 + 1)", "(c_nationkey % 12 + 1)"
_APPENDED = f"""concat('<text xmlns:cb="urn:x"><cb:div><cb:mulu>講題', c_custkey, '</cb:mulu><head>講　題', c_custkey, '<anchor xml:id="nkr_note_orig_', c_custkey, '"/></head><p>正文</p>',
  '<cb:div><cb:mulu>附　原文</cb:mulu><head>附　原文<anchor xml:id="beg_1"/></head><p>文</p><p>（附註）「原文」，', {num(_AY)}, '年', {num(_AM)}, '月講於莫干山；今附於此</p><byline>某記</byline></cb:div>',
  '<cb:div><cb:mulu>附：記', c_nationkey, '</cb:mulu><byline>見海刊</byline><div><byline>民國', {num(_AY)}, '年春作</byline></div></cb:div>',
  '<cb:div><cb:mulu>附二</cb:mulu><p>附註：無日</p></cb:div><cb:div><cb:mulu>結論</cb:mulu><byline>十年作</byline></cb:div></cb:div></text>')"""


def _appended(spark: SparkSession, d: str) -> DataFrame:
    return xml_nodes.shred(spread(table(spark, d, "customer").select("c_custkey", "c_nationkey")).selectExpr("CAST(c_custkey AS STRING) AS id", f"{_APPENDED} AS content"), "id")


@query(
    f"""SELECT {text('c_custkey')} AS doc_id, '附：原文' AS title, concat('（', 1911 + {_AY}, ' 年 ', {_AM}, ' 月，在莫干山講）') AS date_place FROM customer
    UNION ALL SELECT {text('c_custkey')}, concat('附：記', c_nationkey), concat('（', 1911 + {_AY}, ' 年春，作）') FROM customer UNION ALL SELECT {text('c_custkey')}, '附：二', '' FROM customer"""
)
def appendix_discovery(spark: SparkSession, d: str) -> DataFrame:
    """Appendixes of articles with date and place, of a dating note or a byline."""
    return documents.appendixes(_appended(spark, d)).select("doc_id", "title", "date_place")


@query(
    f"""SELECT {text('c_custkey')} AS doc_id, concat('講題', c_custkey) AS text, concat('nkr_note_orig_', c_custkey) AS anchor FROM customer
    UNION ALL SELECT {text('c_custkey')}, t, NULL FROM (SELECT c_custkey, unnest(['附原文', concat('附：記', c_nationkey), '附二', '結論', '']) AS t FROM customer)"""
)
def heading_anchors(spark: SparkSession, d: str) -> DataFrame:
    """Headings of divisions with the notes that their anchors name."""
    return documents.headings(_appended(spark, d)).select("doc_id", "text", "anchor")


# -- files that are written and read back -------------------------------------------------------

_MD = "concat('# 第', n_nationkey, '章', chr(10), chr(10), '| a | b |', chr(10), '|---|---|', chr(10), '| ', n_name, ' | ', n_regionkey, ' |', chr(10), chr(10), '## ', n_name, chr(10), chr(10), '| c |', chr(10), '|---|', chr(10), '| ', n_nationkey, ' |')"


@query("SELECT n_nationkey, 4 AS line_no, '第' || n_nationkey || '章' AS section, NULL AS heading, n_name || ',' || n_regionkey AS cells FROM nation UNION ALL SELECT n_nationkey, 10, '第' || n_nationkey || '章', n_name, n_nationkey::VARCHAR FROM nation")
def markdown_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of Markdown tables with their section and heading."""
    rows = table(spark, d, "nation").selectExpr("n_nationkey", f"{_MD} AS text")
    return files.markdown_tables(rows, "n_nationkey").select("n_nationkey", "line_no", "section", "heading", F.array_join("cells", ",").alias("cells"))


@query(
    """SELECT o_custkey, o_orderkey, last_value(CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority END IGNORE NULLS) OVER w AS section, last_value(CASE WHEN o_orderkey % 5 = 1 THEN o_orderstatus END IGNORE NULLS) OVER w AS heading
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)"""
)
def report_read_back(spark: SparkSession, d: str) -> DataFrame:
    """Reports read back: the headings that each line stands under."""
    line = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("# "), "o_orderpriority")).when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("## "), "o_orderstatus")).otherwise("- x")
    lines = table(spark, d, "orders").select("o_custkey", "o_orderkey", line.alias("line"))
    return files.carried(lines, "o_custkey", "o_orderkey", "line", {"section": r"^# (.*)$", "heading": r"^## (.*)$"}).select("o_custkey", "o_orderkey", "section", "heading")


_ARTICLE = "concat('---', chr(10), 'k: ', c_mktsegment, chr(10), '---', chr(10), CASE WHEN c_custkey % 3 > 0 THEN concat('# ', c_name, ' [3]', chr(10), chr(10)) ELSE '' END, '## 目錄', chr(10), '- a', chr(10), chr(10), '## 一', chr(10), '正文', c_custkey)"


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_name ELSE 'book' END AS title, c_mktsegment AS k, CASE WHEN c_custkey % 3 > 0 THEN '# ' || c_name || ' [3]' || chr(10) || chr(10) ELSE '' END || '## 一' || chr(10) || '正文' || c_custkey AS body FROM customer")
def article_read(spark: SparkSession, d: str) -> DataFrame:
    """Title, front matter and body of articles; one without a heading is named by its book."""
    rows = table(spark, d, "customer").selectExpr("c_custkey", f"{_ARTICLE} AS text").withColumn("body", files.body(F.col("text")))
    return rows.select("c_custkey", files.title(F.col("body"), F.lit("book")).alias("title"), files.front_matter(F.col("text"))["k"].alias("k"), "body")


_FRONTED = of(
    "c_custkey", "concat('---', chr(10), 'a: ', c_name, chr(10), 'themes:', chr(10), '  - x', chr(10), '---', chr(10), 'concepts: these matter', chr(10))", "concat('---', chr(10), 'concepts:', chr(10), '  - old', chr(10), 'b: ', c_name, chr(10), '---', chr(10), 't')",
    "concat('concepts: ', c_name, chr(10))",
)
_LISTED = "'concepts:', chr(10), '  - p', chr(10), '  - ', c_mktsegment, chr(10)"


@query(
    f"""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN concat('---', chr(10), 'a: ', c_name, chr(10), {_LISTED}, 'themes:', chr(10), '  - x', chr(10), '---', chr(10), 'concepts: these matter', chr(10))
      WHEN 1 THEN concat('---', chr(10), {_LISTED}, 'b: ', c_name, chr(10), '---', chr(10), 't') ELSE concat('concepts: ', c_name, chr(10)) END AS made FROM customer WHERE c_mktsegment <> ''"""
)
def front_matter_lists(spark: SparkSession, d: str) -> DataFrame:
    """Lists put into front matter and nowhere else."""
    rows = table(spark, d, "customer").filter("c_mktsegment <> ''").selectExpr("c_custkey", f"{_FRONTED} AS before", "c_mktsegment")
    return rows.select("c_custkey", rendering.annotated(F.col("before"), {"concepts": F.array(F.lit("p"), F.col("c_mktsegment")), "domains": F.lit(None).cast("array<string>")}).alias("made"))


@query("SELECT lpad(r_regionkey::VARCHAR, 2, '0') || '_' || r_name AS folder, (row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey) - 1)::INT AS entry_index, n_nationkey::BIGINT AS seq, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey")
def catalogue_folders(spark: SparkSession, d: str) -> DataFrame:
    """Entries of the catalogues that were written to numbered folders; folders without a number and other files hold none."""
    base = shared_folder(spark, "catalogues")
    met = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    folder = F.concat(F.lpad(F.col("r_regionkey").cast("string"), 2, "0"), F.lit("_"), "r_name")
    entry = F.struct(F.col("n_nationkey").cast("long").alias("seq"), F.col("n_name").alias("name"))
    made = met.groupBy(folder.alias("folder"), "r_name").agg(F.to_json(F.struct(F.array_sort(F.collect_list(entry)).alias("entries"))).alias("text"))
    mine = F.concat("folder", F.lit("/"), "r_name", F.lit("_編目錄.json"))
    others = (F.concat(F.lit("x"), mine), F.concat("folder", F.lit("/other.json")))
    for name in (mine, *others):
        writers.write_named(made.select(name.alias("name"), "text"), base)
    return files.catalogue_entries(spark, base).select("folder", F.col("entry_index").cast("int").alias("entry_index"), "seq", "name")
