"""Queries over whole tables in one order: scans that go on from task to task, and folds down trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.text import BRANCHES, NUMERALS, STEMS, STRUCTURAL
from lexmill.operators import sequences, trees
from lexmill.operators.scan import scan
from lexmill.plans.catalogue import query
from lexmill.session import table


@query(
    """SELECT l_orderkey, l_linenumber, row_number() OVER w AS seq, lag(l_partkey) OVER w AS prev_part, lead(l_partkey) OVER w AS next_part,
      sum(l_linenumber) OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
    FROM lineitem WINDOW w AS (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey)"""
)
def global_numbers(spark: SparkSession, d: str) -> DataFrame:
    """All lines of all orders in one numbering, with their neighbours and a running sum."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    found = scan(rows, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], sums={"upto": "l_linenumber"}, prev={"prev_part": "l_partkey"}, following={"next_part": "l_partkey"})
    return found.drop("l_partkey", "l_suppkey")


@query(
    """SELECT event_id, last_value(section IGNORE NULLS) OVER w AS section, sum(CASE WHEN section IS NOT NULL THEN 1 ELSE 0 END) OVER w AS section_no,
      event_id - coalesce(last_value(section IGNORE NULLS) OVER w, event_id) AS behind
    FROM (SELECT event_id, ts, CASE WHEN event_type = 'purchase' AND value > 20 THEN event_id END AS section FROM events)
    WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""
)
def running_sections(spark: SparkSession, d: str) -> DataFrame:
    """Every event with the section it stands in; a section begins at a purchase and runs on over users, files and tasks."""
    mark = F.when((F.col("event_type") == "purchase") & (F.col("value") > 20), F.col("event_id"))
    rows = table(spark, d, "events").select("event_id", "ts", mark.alias("begins"), mark.isNotNull().cast("long").alias("one"))
    found = scan(rows, ["ts", "event_id"], fills={"section": "begins"}, sums={"section_no": "one"})
    return found.select("event_id", "section", "section_no", (F.col("event_id") - F.coalesce("section", "event_id")).alias("behind"))


@query(
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq,
      last_value(CASE WHEN value > 40 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_high,
      lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events"""
)
def numbers_within_keys(spark: SparkSession, d: str) -> DataFrame:
    """Each user's events numbered and filled without a window, so that no user's events need fit a task."""
    rows = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", F.when(F.col("value") > 40, F.col("value")).alias("high"))
    return scan(rows, ["ts", "event_id"], ["user_id"], fills={"last_high": "high"}, prev={"before": "event_type"}, keep=["event_id", "user_id"])


@query(
    """SELECT ((rn - 1) // 3)::BIGINT AS line, max(CASE WHEN rn % 3 = 1 THEN o_orderkey END) AS o_orderkey_1, max(CASE WHEN rn % 3 = 2 THEN o_orderkey END) AS o_orderkey_2,
      max(CASE WHEN rn % 3 = 0 THEN o_orderkey END) AS o_orderkey_3 FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) GROUP BY ALL"""
)
def wide_orders(spark: SparkSession, d: str) -> DataFrame:
    """All orders three to a line, in order of date."""
    return sequences.wide(table(spark, d, "orders").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], ["o_orderkey"])


#: Headings of eight patterns, with what SQL writes for them.
_HEADS = ["第三章甲論", "第二節乙論", "１　丙論", "甲一丁論", "乙戊論", "子、己論", "三庚論", "辛論"]


def _sql_list(texts: list[str]) -> str:
    return "[" + ", ".join(f"'{t}'" for t in texts) + "]"



def _sql_label(heading: str, parent: str) -> str:
    """The label rules in DuckDB's SQL, over a spaced heading."""
    under = lambda pairs, other: f"CASE {parent} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs) + f" ELSE '{other}' END"
    n = f"[{NUMERALS}]+"
    rules = [
        (f"^第{n}章", "'章'"), (f"^第{n}[节節]", "'節'"), ("^[０-９]+[　、．]", "'小節'"),
        (f"^[{STEMS}]{n}", under([("部", "章"), ("章", "節"), ("節", "小節"), ("小節", "小小節")], "節")),
        (f"^[{STEMS}][　、]", under([("章", "節"), ("節", "小節"), ("小節", "小小節")], "節")), (f"^[{BRANCHES}][　、]", under([("節", "小節")], "小小節")),
        (f"^{n}[　、]", under([("部", "章"), ("章", "節"), ("節", "小節")], "小節")),
    ]
    other = under([("篇", "部"), ("部", "章"), ("章", "節"), ("節", "小節")], "?")
    return "CASE " + " ".join(f"WHEN regexp_matches({heading}, '{p}') THEN {label}" for p, label in rules) + f" ELSE {other} END"


def _sql_spaced(x: str) -> str:
    n, han = NUMERALS, "([一-鿿])"
    for pattern, to in ((f"^(第[{n}]+[章節节篇部]){han}", r"\1　\2"), (f"^([{STEMS}][{n}]+){han}", r"\1　\2"), (f"^([{STEMS}])([一-鿿])", None), (f"^([{n}]){han}", r"\1　\2")):
        x = f"regexp_replace({x}, '{pattern}', '{to}')" if to else f"CASE WHEN regexp_matches({x}, '^[{STEMS}][{n}]') THEN {x} ELSE regexp_replace({x}, '{pattern}', '\\1　\\2') END"
    return x


_TREE = """p AS (
  SELECT h.*, (SELECT max(q.seq) FROM h q WHERE q.doc_id = h.doc_id AND q.seq < h.seq AND q.level < h.level
    AND NOT EXISTS (SELECT 1 FROM h r WHERE r.doc_id = h.doc_id AND r.seq > q.seq AND r.seq < h.seq AND r.level <= q.level)) AS parent_seq FROM h)"""


@query(
    f"""WITH RECURSIVE h AS (SELECT o_custkey AS doc_id, o_orderkey AS seq, (1 + (o_orderkey // 3) % 4)::INT AS level, {_sql_spaced("list_extract(" + _sql_list(_HEADS) + ", (o_orderkey % 8 + 1)::INT)")} AS heading FROM orders),
    {_TREE},
    t AS (
      SELECT doc_id, seq, level, heading, parent_seq, {_sql_label("heading", "'篇'")} AS label FROM p WHERE parent_seq IS NULL
      UNION ALL SELECT p.doc_id, p.seq, p.level, p.heading, p.parent_seq, {_sql_label("p.heading", "t.label")} FROM p JOIN t ON p.doc_id = t.doc_id AND p.parent_seq = t.seq)
    SELECT doc_id, seq, level, heading, parent_seq, label FROM t"""
)
def inherited_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of headings down the outline of every customer's orders: each follows from its pattern and its parent's label."""
    text = F.element_at(F.array(*map(F.lit, _HEADS)), (F.col("o_orderkey") % 8 + 1).cast("int"))
    level = (1 + F.floor(F.col("o_orderkey") / 3) % 4).cast("int").alias("level")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("seq"), level, text.alias("text"))
    return trees.labelled(rows).drop("text")


@query(
    rf"""WITH RECURSIVE h AS (
      SELECT page_id AS doc_id, i - 1 AS seq, CASE WHEN marks[i] = 'h1' THEN 1 ELSE 2 END AS level, {_sql_spaced("txt[i]")} AS heading
      FROM (SELECT page_id, marks, txt, unnest(range(1, len(marks) + 1)) AS i FROM (
        SELECT page_id, regexp_extract_all(html, '<(h1|p><b)>([^<]*)<', 1) AS marks, regexp_extract_all(html, '<(h1|p><b)>([^<]*)<', 2) AS txt FROM pages))),
    {_TREE},
    t AS (
      SELECT doc_id, seq, level, heading, parent_seq, {_sql_label("heading", "'篇'")} AS label FROM p WHERE parent_seq IS NULL
      UNION ALL SELECT p.doc_id, p.seq, p.level, p.heading, p.parent_seq, {_sql_label("p.heading", "t.label")} FROM p JOIN t ON p.doc_id = t.doc_id AND p.parent_seq = t.seq)
    SELECT doc_id AS page_id, seq::INT AS seq, level::INT AS level, heading, parent_seq::INT AS parent_seq, label, repeat('  ', level - 1) || heading AS line FROM t"""
)
def page_contents(spark: SparkSession, d: str) -> DataFrame:
    """The contents of every web page: titles, and paragraphs that begin in bold, below them, with labels."""
    pattern = F.lit("<(h1|p><b)>([^<]*)<")
    zipped = F.arrays_zip(F.regexp_extract_all("html", pattern, F.lit(1)).alias("m"), F.regexp_extract_all("html", pattern, F.lit(2)).alias("t"))
    rows = table(spark, d, "pages").select("page_id", F.posexplode(zipped).alias("seq", "h"))
    rows = rows.select("page_id", "seq", F.when(F.col("h.m") == "h1", 1).otherwise(2).alias("level"), F.col("h.t").alias("text"))
    found = trees.labelled(rows, "page_id")
    return found.select("page_id", "seq", "level", "heading", "parent_seq", "label", F.concat(F.expr("repeat('  ', level - 1)"), "heading").alias("line"))


_NAMES = ["目次", "附：補遺", "附錄文", "前言", "甲論", "乙論"]
_NAME = f"list_extract({_sql_list(_NAMES)}, (o_orderkey % 9 + 1)::INT)"
_SKIP = "|".join(STRUCTURAL)
_BLOCK = "o_orderstatus = 'F' AND o_orderkey % 5 < 2"


@query(
    f"""WITH RECURSIVE h AS (
      SELECT o_custkey AS doc_id, o_orderkey AS seq, CASE WHEN {_BLOCK} THEN 9 ELSE 1 + (o_orderkey // 3) % 4 END AS level,
        CASE WHEN {_BLOCK} THEN 'p' || o_orderdate::VARCHAR END AS block, {_NAME} AS full_name,
        CASE WHEN regexp_matches({_NAME}, '^附[：　].|^附[一-鿿]') THEN '附：' ELSE coalesce({_NAME}, '') END AS own,
        CASE WHEN regexp_matches({_NAME}, '^附[：　].|^附[一-鿿]') THEN regexp_extract({_NAME}, '^附[：　]?(.+)$', 1) END AS sub, CASE WHEN o_orderkey % 2 = 0 THEN 'orig' END AS kind, (o_orderkey % 7 % 5)::INT AS lv
      FROM orders),
    {_TREE},
    t AS (
      SELECT doc_id, seq, level, lv, own, full_name, sub, kind, block, parent_seq, 0::BIGINT AS off_, FALSE AS dropped, FALSE AS silent, FALSE AS quoted FROM p WHERE parent_seq IS NULL
      UNION ALL SELECT p.doc_id, p.seq, p.level, p.lv, p.own, p.full_name, p.sub, p.kind, p.block, p.parent_seq,
        CASE WHEN t.dropped OR t.own = '' OR t.lv = 1 OR t.sub IS NULL OR regexp_matches(t.full_name, '{_SKIP}') THEN t.off_ ELSE 1 - t.lv END,
        t.dropped OR coalesce(regexp_matches(t.full_name, '{_SKIP}'), FALSE),
        NOT t.dropped AND t.own <> '' AND t.lv = 1, NOT t.dropped AND t.own = '' AND coalesce(t.kind = 'orig', FALSE)
      FROM p JOIN t ON p.doc_id = t.doc_id AND p.parent_seq = t.seq)
    SELECT doc_id, seq,
      CASE WHEN block IS NULL AND NOT gone AND own <> '' AND lv <> 1 THEN repeat('    ', greatest(0, lv - 3)) || '- ' || own || coalesce(sub, '') END AS toc_line,
      CASE WHEN gone OR (block IS NOT NULL AND silent) THEN NULL
        WHEN block IS NOT NULL THEN CASE WHEN quoted THEN '> **' || block || '**' ELSE block END
        WHEN own = '' OR lv = 1 OR own = '前言' THEN NULL
        ELSE repeat('#', least(6, greatest(CASE WHEN off_ < 0 THEN 2 ELSE 3 END, lv + off_))) || ' ' || repeat('　　', greatest(0, lv + off_ - CASE WHEN off_ < 0 THEN 2 ELSE 3 END)) || own || coalesce(chr(10) || '# ' || sub, '') END AS body_line,
      gone OR (block IS NOT NULL AND silent) AS dropped
    FROM (SELECT *, dropped OR (block IS NULL AND coalesce(regexp_matches(full_name, '{_SKIP}'), FALSE)) AS gone FROM t)"""
)
def division_walk(spark: SparkSession, d: str) -> DataFrame:
    """Every customer's orders as a tree of divisions and paragraphs: contents and body lines with inherited offsets, quoting, silence and omission."""
    name = F.get(F.array(*map(F.lit, _NAMES)), (F.col("o_orderkey") % 9).cast("int"))
    is_block = (F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 5 < 2)
    rows = table(spark, d, "orders").select(
        F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("seq"), F.when(is_block, 9).otherwise(1 + F.floor(F.col("o_orderkey") / 3) % 4).cast("int").alias("depth"),
        (F.col("o_orderkey") % 7 % 5).cast("int").alias("level"), F.when(~is_block, name).alias("heading"), F.when(F.col("o_orderkey") % 2 == 0, "orig").alias("kind"),
        F.when(is_block, F.concat(F.lit("p"), F.col("o_orderdate").cast("string"))).alias("block"),
    )
    return trees.walked(rows, "doc_id", "seq", "depth", "level", "heading", "kind", "block").select("doc_id", "seq", "toc_line", "body_line", "dropped")
