"""Queries of the document engine and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import classify
from lexmill.functions import text as tx
from lexmill.operators import dictionary, documents, lookups, matching, sequences
from lexmill.session import register_tables, run_sql, table
from lexmill.sources import xml_nodes
from lexmill.streaming import gap_stream

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable:
    """Register a function as a query under its own name."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _values(rows: list[tuple]) -> str:
    lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, int | float) else "'" + v.replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows) + ")"


# -- dictionary matching ------------------------------------------------------------------

#: (seq, standard, variants, domain) of a small dictionary for the synthetic prose.
VOCABULARY = [(1, "the", ["there", "them"], "en"), (2, "der", ["die", "das"], "de"), (3, "que", ["qui"], "fr"), (4, "tion", ["ation"], "any"), (5, "mente", [], "es"), (6, "with", ["which"], "en"), (7, "erst", ["er"], "de")]
_SURFACES = sorted({(s, std, dom) for _, std, vs, dom in VOCABULARY for s in [std, *vs]})
_ALT = matching.alternation([s for s, _, _ in _SURFACES])
_KEYS = _values(_SURFACES)
_PER_LINE = f"""
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
h AS (SELECT doc_id, regexp_matches(line, '^#{{1,3}}(\\s|$)') AS hd, unnest(regexp_extract_all(line, '{_ALT}')) AS surface FROM l),
c AS (SELECT doc_id, standard, count(*) AS occurrences, sum(CASE WHEN hd THEN 1 ELSE 0 END) AS heading_hits,
      string_agg(DISTINCT surface, '、' ORDER BY surface) AS surfaces, bool_or(surface = standard) AS is_standard, min(domain) AS domain
      FROM h JOIN {_KEYS} k(surface, standard, domain) USING (surface) GROUP BY doc_id, standard)"""


def _found(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = _rows(spark, "seq int, standard string, variants array<string>, domain string", VOCABULARY)
    keys = matching.match_keys(vocabulary, chars=None)
    found = matching.hits(matching.lines_of(table(spark, d, "documents")), [s for s, _, _ in _SURFACES])
    return matching.candidates(found, F.broadcast(keys))


@query(
    f"""WITH {_PER_LINE}, p AS (SELECT doc_id, surface, min(i) AS i FROM (SELECT doc_id, unnest(s) AS surface, generate_subscripts(s, 1) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, '{_ALT}') AS s FROM documents)) GROUP BY ALL),
    f AS (SELECT doc_id, standard, min(i) AS i FROM p JOIN {_KEYS} k(surface, standard, domain) USING (surface) GROUP BY ALL),
    r AS (SELECT c.*, occurrences + 3 * heading_hits AS score, row_number() OVER (PARTITION BY c.doc_id ORDER BY occurrences + 3 * heading_hits DESC, i) AS nth
      FROM c JOIN f USING (doc_id, standard))
    SELECT doc_id, standard, domain, surfaces, is_standard, occurrences::BIGINT AS occurrences, heading_hits::BIGINT AS heading_hits, score::BIGINT AS score, nth::BIGINT AS nth
    FROM r WHERE nth <= 5"""
)
def dict_match_topk(spark: SparkSession, d: str) -> DataFrame:
    """The five best dictionary terms of every document."""
    top = _found(spark, d).filter("nth <= 5")
    long = [F.col(c).cast("long").alias(c) for c in ("occurrences", "heading_hits", "score", "nth")]
    return top.select("doc_id", "standard", "domain", "surfaces", "is_standard", *long)


@query(
    f"""WITH {_PER_LINE.replace("unnest(string_split(text, chr(10))) AS line", "unnest(string_split('# ' || text, chr(10))) AS line")}
    SELECT standard, sum(occurrences)::BIGINT AS occurrences, sum(heading_hits)::BIGINT AS heading_hits,
      (sum(occurrences) + 3 * sum(heading_hits))::BIGINT AS score FROM c GROUP BY standard"""
)
def dict_match_heading_weighted(spark: SparkSession, d: str) -> DataFrame:
    """Terms over all documents, the first line taken as a heading."""
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("# "), "text").alias("text"))
    found = matching.hits(matching.lines_of(docs), [s for s, _, _ in _SURFACES])
    keys = _rows(spark, "surface string, standard string, domain string", _SURFACES)
    per = found.groupBy("surface").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_heading").cast("long")).alias("h"))
    out = per.join(F.broadcast(keys), "surface").groupBy("standard").agg(F.sum("n").alias("occurrences"), F.sum("h").alias("heading_hits"))
    return out.withColumn("score", matching.score(F.col("occurrences"), F.col("heading_hits")))


@query(
    f"""WITH {_PER_LINE}
    SELECT doc_id, count(*)::BIGINT AS concepts, sum(occurrences)::BIGINT AS hits,
      (count(*) FILTER (WHERE occurrences = 1))::VARCHAR || '/' || count(*)::VARCHAR AS single FROM c GROUP BY doc_id"""
)
def dict_match_summary(spark: SparkSession, d: str) -> DataFrame:
    """Concepts, hits and the share of single ones of every document."""
    return matching.summary(_found(spark, d)).select("doc_id", "concepts", "hits", "single")


@query(
    """SELECT doc_id, CASE WHEN p > 40 THEN '…' ELSE '' END || replace(substr(text, greatest(p - 40, 0) + 1, least(length(text), p + 42) - greatest(p - 40, 0)), chr(10), ' ')
      || CASE WHEN least(length(text), p + 42) < length(text) THEN '…' ELSE '' END AS context
    FROM (SELECT doc_id, text, strpos(text, ' the ') - 1 AS p FROM documents) WHERE p >= 0"""
)
def context_snippet(spark: SparkSession, d: str) -> DataFrame:
    """The surroundings of the first `` the `` of every document that has one."""
    docs = table(spark, d, "documents").withColumn("p", F.instr("text", " the ") - 1).filter("p >= 0")
    return docs.select("doc_id", tx.snippet(F.col("text"), F.col("p")).alias("context"))


# -- scalar functions ---------------------------------------------------------------------


@query(
    """SELECT doc_id, length(regexp_replace(text, '[^A-Za-zÀ-ÿ]', '', 'g'))::BIGINT AS letters,
      CASE WHEN n_chars <= 5000 THEN '5-8' WHEN n_chars <= 15000 THEN '8-12' WHEN n_chars <= 30000 THEN '10-15' ELSE '12-18' END AS recommended,
      (n_chars // 1000)::BIGINT AS thousands FROM documents"""
)
def char_class_count(spark: SparkSession, d: str) -> DataFrame:
    """Letters, the recommended number of keywords, and thousands of characters."""
    return table(spark, d, "documents").select(
        "doc_id", tx.count_class(F.col("text"), "A-Za-zÀ-ÿ").cast("long").alias("letters"),
        tx.bucket(F.col("n_chars")).alias("recommended"), tx.thousands(F.col("n_chars")).alias("thousands"),
    )


#: Word lists of the classifier's six kinds for Western prose.
_FLAGS = {"link": "https?://", "mail": "@", "licence": "[Ll]icen[sc]e", "table": r" \| ", "shout": "!!", "noise": r"(\*\*\*|%%%|\$\$\$)"}
_SUM = " + ".join(f"regexp_matches(text, '{p}')::INT" for p in _FLAGS.values())


@query(
    f"""SELECT kind, count(*)::BIGINT AS n FROM (SELECT CASE WHEN text = '' THEN '空' WHEN {_SUM} >= 2 THEN '综合'
      {" ".join(f"WHEN regexp_matches(text, '{p}') THEN '{k}'" for k, p in _FLAGS.items())}
      WHEN contains(text, ' the ') THEN 'prose' ELSE '其他' END AS kind FROM documents) GROUP BY kind"""
)
def text_classifier(spark: SparkSession, d: str) -> DataFrame:
    """Documents by kind: one flag, several, or a fallback."""
    t = F.col("text")
    kind = classify.kind_label(t, [t.rlike(p) for p in _FLAGS.values()], [(t.contains(" the "), "prose")], kinds=tuple(_FLAGS))
    return table(spark, d, "documents").select(kind.alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


# -- lookups ------------------------------------------------------------------------------

_ALIASES = [("example.com", "com", 1), ("example.org", "org", 2), ("blog.", "blog", 3), ("example", "any", 4), ("blog.th", "blog-th", 5), ("www.th", "www-th", 6)]


@query(
    f"""SELECT page_id, alias, canonical FROM (SELECT page_id, alias, canonical, row_number() OVER (PARTITION BY page_id ORDER BY length(alias) DESC, ord) AS rn
    FROM pages JOIN {_values(_ALIASES)} a(alias, canonical, ord) ON contains(url, alias)) WHERE rn = 1"""
)
def alias_longest_match(spark: SparkSession, d: str) -> DataFrame:
    """The longest alias in every url."""
    return dictionary.longest_contained(table(spark, d, "pages"), "page_id", "url", _rows(spark, "alias string, canonical string, ord int", _ALIASES))


@query(
    """SELECT p_brand, issue, min(p_partkey)::BIGINT AS first_part, count(*)::BIGINT AS n FROM
    (SELECT p_brand, p_partkey, unnest(generate_series(p_size, p_size + p_partkey % 4)) AS issue FROM part) GROUP BY ALL"""
)
def issue_range_explode(spark: SparkSession, d: str) -> DataFrame:
    """Spans of sizes exploded to one row per size."""
    parts = table(spark, d, "part").select("p_brand", "p_partkey", "p_size", (F.col("p_size") + F.col("p_partkey") % 4).cast("int").alias("upto"))
    spans = lookups.expand_spans(parts, "p_size", "upto").groupBy("p_brand", "issue")
    return spans.agg(F.min("p_partkey").alias("first_part"), F.count(F.lit(1)).alias("n"))


@query(
    """WITH t AS (SELECT CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE p_size END AS vol, p_brand AS issue,
      min(CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_type END) AS v FROM part GROUP BY ALL),
    q AS (SELECT p_partkey, p_size, p_brand FROM part)
    SELECT p_partkey, CASE WHEN a.v IS NOT NULL THEN a.v WHEN b.v IS NOT NULL THEN b.v ELSE c.v END AS found,
      CASE WHEN a.v IS NOT NULL THEN 1 WHEN b.v IS NOT NULL THEN 2 WHEN c.v IS NOT NULL THEN 3 END AS found_by,
      CASE WHEN coalesce(a.v, b.v, c.v) <> '' THEN 'dated' WHEN coalesce(a.v, b.v, c.v) = '' THEN 'matched' ELSE 'unmatched' END AS status
    FROM q LEFT JOIN t a ON a.vol = p_size AND a.issue = p_brand LEFT JOIN t b ON b.vol IS NULL AND b.issue = p_brand LEFT JOIN t c ON c.vol = 0 AND c.issue = p_brand"""
)
def cascade_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A lookup by (vol, issue), then (null, issue), then (0, issue); an empty value stops it."""
    part = table(spark, d, "part")
    vol = F.when(F.col("p_size") % 3 == 0, F.lit(None)).when(F.col("p_size") % 3 == 1, F.lit(0)).otherwise(F.col("p_size"))
    value = F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.col("p_type"))
    t = part.select(vol.alias("vol"), F.col("p_brand").alias("issue"), value.alias("v")).groupBy("vol", "issue").agg(F.min("v").alias("v"))
    left = part.select("p_partkey", "p_size", "p_brand")
    tries = [{"vol": v, "issue": F.col("p_brand")} for v in (F.col("p_size"), F.lit(None).cast("int"), F.lit(0))]
    out = lookups.cascade(left, t, tries, "v")
    return out.select("p_partkey", "found", "found_by", lookups.match_status(F.col("found"), F.col("found_by"), F.lit(False)).alias("status"))


@query(
    """SELECT p_brand AS jnum, count(*)::BIGINT AS n, coalesce(min(CASE WHEN p_type <> '' THEN p_type END), '') AS first_type
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 10 GROUP BY p_brand"""
)
def mapped_inner_join(spark: SparkSession, d: str) -> DataFrame:
    """Rows joined to their mapped names; unmapped ones drop out."""
    part = table(spark, d, "part").filter("p_size <= 10").select("p_partkey", "p_brand", "p_type")
    met = table(spark, d, "lineitem").select("l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return met.groupBy(F.col("p_brand").alias("jnum")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.min(F.when(F.col("p_type") != "", F.col("p_type"))), F.lit("")).alias("first_type"))


@query(
    """WITH v AS (SELECT l_suppkey, p_brand, count(*) AS n, min(l_orderkey) AS o FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
    SELECT l_suppkey, p_brand, n::BIGINT AS n FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, o, p_brand) AS rn FROM v) WHERE rn = 1"""
)
def cooccurrence_vote(spark: SparkSession, d: str) -> DataFrame:
    """The brand that each supplier ships most often."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    met = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey").join(part, "l_partkey")
    return lookups.vote(met, "l_suppkey", "p_brand", "l_orderkey")


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000")
def no_reference_entities(spark: SparkSession, d: str) -> DataFrame:
    """Customers without a large open order."""
    large = table(spark, d, "orders").filter("o_orderstatus = 'O' and o_totalprice > 200000")
    return table(spark, d, "customer").select("c_custkey").exceptAll(large.select("o_custkey").distinct())


@query("SELECT item, max(kind) AS kind FROM (SELECT p_brand AS item, 'brand' AS kind FROM part UNION SELECT p_type, 'type' FROM part UNION SELECT c_mktsegment, 'segment' FROM customer) GROUP BY item")
def label_union(spark: SparkSession, d: str) -> DataFrame:
    """Labels of several dimensions as one set."""
    part = table(spark, d, "part")
    sets = [(part, "p_brand", "brand"), (part, "p_type", "type"), (table(spark, d, "customer"), "c_mktsegment", "segment")]
    out = [t.select(F.col(c).alias("item"), F.lit(k).alias("kind")).distinct() for t, c, k in sets]
    return out[0].union(out[1]).union(out[2]).groupBy("item").agg(F.max("kind").alias("kind"))


# -- aggregations -------------------------------------------------------------------------


@query(
    """SELECT r_name, n_name, count(*)::BIGINT AS total, (count(*) FILTER (WHERE o_orderstatus = 'F'))::BIGINT AS dated,
      (count(*) FILTER (WHERE o_orderstatus = 'O'))::BIGINT AS matched, (count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')))::BIGINT AS unmatched
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY GROUPING SETS ((), (r_name), (r_name, n_name))"""
)
def status_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    """Orders by status at three grains."""
    names = ("orders", "customer", "nation", "region")
    register_tables(spark, d, list(names))
    return run_sql(
        spark,
        """SELECT r_name, n_name, count(*) AS total, count_if(o_orderstatus = 'F') AS dated, count_if(o_orderstatus = 'O') AS matched,
          count_if(o_orderstatus NOT IN ('F', 'O')) AS unmatched
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY GROUPING SETS ((), (r_name), (r_name, n_name))""",
    )


@query("SELECT n_name, c_mktsegment, count(*)::BIGINT AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_name, c_mktsegment)")
def section_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Customers by nation and segment with totals."""
    nation = table(spark, d, "nation")
    met = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return met.rollup("n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type, count(*)::BIGINT AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM events GROUP BY event_type")
def type_percentages(spark: SparkSession, d: str) -> DataFrame:
    """Events by type with their share."""
    return sequences.shares(table(spark, d, "events"), "event_type")


@query(
    """SELECT o_orderpriority, count(*)::BIGINT AS refs, count(DISTINCT (o_custkey, o_orderstatus))::BIGINT AS distinct_refs,
    min(o_orderkey)::BIGINT AS first_ref, max(o_orderkey)::BIGINT AS last_ref FROM orders GROUP BY o_orderpriority"""
)
def reference_counts(spark: SparkSession, d: str) -> DataFrame:
    """Raw and distinct references, the first and the last of each group."""
    refs = table(spark, d, "orders").groupBy("o_orderpriority")
    return refs.agg(F.count(F.lit(1)).alias("refs"), F.count_distinct("o_custkey", "o_orderstatus").alias("distinct_refs"), F.min("o_orderkey").alias("first_ref"), F.max("o_orderkey").alias("last_ref"))


@query("SELECT user_id % 50 AS tag, count(*)::BIGINT AS n, sum((json_extract_string(props, '$.k'))::BIGINT)::BIGINT AS k FROM events GROUP BY ALL HAVING count(*) >= 2")
def tag_explode_count(spark: SparkSession, d: str) -> DataFrame:
    """A JSON property summed by tag."""
    rows = table(spark, d, "events").select((F.col("user_id") % 50).alias("tag"), F.get_json_object("props", "$.k").cast("long").alias("k"))
    return rows.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k")).filter("n >= 2")


@query(
    """SELECT c_mktsegment, count(*)::BIGINT AS n, string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey) FILTER (WHERE rn <= 10) AS first_ten
    FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS rn FROM customer) GROUP BY c_mktsegment"""
)
def capped_lists(spark: SparkSession, d: str) -> DataFrame:
    """Group sizes with the first ten members listed; all are counted."""
    rows = table(spark, d, "customer")
    counts = rows.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    ten = sequences.top(rows, 10, ["c_custkey"], ["c_mktsegment"]).groupBy("c_mktsegment")
    listed = ten.agg(F.array_join(F.transform(F.sort_array(F.collect_list("c_custkey")), lambda x: x.cast("string")), ",").alias("first_ten"))
    return counts.join(listed, "c_mktsegment")


# -- ordered rows -------------------------------------------------------------------------


@query(
    """SELECT o_custkey, o_orderkey, row_number() OVER w AS seq, lag(o_orderkey) OVER w AS prev_o_orderkey, lead(o_orderkey) OVER w AS next_o_orderkey
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""
)
def catalog_linked_list(spark: SparkSession, d: str) -> DataFrame:
    """Orders of a customer numbered and linked."""
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return sequences.linked(rows, ["o_orderdate", "o_orderkey"], ["o_custkey"], "o_orderkey").drop("o_orderdate")


@query(
    """SELECT l_orderkey, l_linenumber, gap, coalesce(gap < 0 OR gap > 20, false) AS suspicious FROM (
      SELECT *, lead(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) - l_quantity AS gap FROM lineitem)"""
)
def adjacent_gap_check(spark: SparkSession, d: str) -> DataFrame:
    """Gaps between neighbouring lines, and which are out of bounds."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return sequences.gaps(rows, "l_quantity", "l_quantity", ["l_linenumber", "l_quantity"], ["l_orderkey"], 20).drop("l_quantity")


@query(
    """WITH m AS (SELECT *, role = 'assistant' AS a, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
    g AS (SELECT *, sum(CASE WHEN NOT a OR n = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS g FROM m)
    SELECT conv_id, min(turn) AS turn, arg_min(role, n) AS role, max(turn) AS last_turn,
      coalesce(string_agg(role, '；' ORDER BY n) FILTER (WHERE a AND n > 1), '') AS folded, (count(*) - 1)::BIGINT AS n_folded FROM g GROUP BY conv_id, g"""
)
def appendix_fold(spark: SparkSession, d: str) -> DataFrame:
    """Answers folded into the turn before them."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role")
    return sequences.fold(rows, F.col("role") == "assistant", ["turn"], ["conv_id"], ["turn", "role"], "turn", "role")


@query(
    """SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' OR event_id % 7 = 0 THEN event_id END IGNORE NULLS)
      OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS section_filled FROM events"""
)
def forward_fill(spark: SparkSession, d: str) -> DataFrame:
    """The last marked event of a user, carried on."""
    mark = F.when((F.col("event_type") == "purchase") | (F.col("event_id") % 7 == 0), F.col("event_id"))
    rows = table(spark, d, "events").select("event_id", "user_id", "ts", mark.alias("section"))
    return sequences.forward_fill(rows, "section", ["ts", "event_id"], ["user_id"]).select("event_id", "user_id", "section_filled")


@query("SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def ordered_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """The first document of each text; texts meet by a digest of 256 bits and travel with it."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    first = docs.groupBy(F.sha2("text", 256).alias("h")).agg(F.min(F.struct("doc_id", "text")).alias("f"))
    return first.select("f.doc_id", "f.text")


@query(
    """SELECT page_id, (i - 1)::INT AS seq, lvl[i]::INT AS level, regexp_replace(txt[i], '<[^>]*>', '', 'g') AS heading,
      (SELECT max(j) - 1 FROM unnest(range(1, i)) r(j) WHERE lvl[j]::INT < lvl[i]::INT)::INT AS parent_seq
    FROM (SELECT page_id, lvl, txt, unnest(range(1, len(lvl) + 1)) AS i FROM (
      SELECT page_id, regexp_extract_all(html, '(?s)<h([1-6])[^>]*>(.*?)</h[1-6]>', 1) AS lvl, regexp_extract_all(html, '(?s)<h([1-6])[^>]*>(.*?)</h[1-6]>', 2) AS txt FROM pages))"""
)
def html_heading_levels(spark: SparkSession, d: str) -> DataFrame:
    """Headings of web pages with levels and parents."""
    pattern = F.lit(r"(?s)<h([1-6])[^>]*>(.*?)</h[1-6]>")
    zipped = F.arrays_zip(F.regexp_extract_all("html", pattern, F.lit(1)).alias("l"), F.regexp_extract_all("html", pattern, F.lit(2)).alias("t"))
    rows = table(spark, d, "pages").select("page_id", F.posexplode(zipped).alias("seq", "h"))
    rows = rows.select("page_id", "seq", F.col("h.l").cast("int").alias("level"), F.regexp_replace("h.t", "<[^>]*>", "").alias("heading"))
    return sequences.outline(rows, "page_id").select("page_id", "seq", "level", "heading", "parent_seq")


@query(
    """SELECT n_regionkey, n_name, part FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS rn, count(*) OVER (PARTITION BY n_regionkey) AS m FROM nation),
    (VALUES ('head'), ('tail')) p(part) WHERE (part = 'head' AND rn <= 2) OR (part = 'tail' AND m > 2 AND rn > m - 2)"""
)
def head_and_tail(spark: SparkSession, d: str) -> DataFrame:
    """The first and last two nations of each region."""
    rows = table(spark, d, "nation").select("n_regionkey", "n_name")
    return sequences.head_and_tail(rows, ["n_name"], ["n_regionkey"], 2, 2)


@query(
    """SELECT ((rn - 1) // 3)::BIGINT AS line, max(CASE WHEN rn % 3 = 1 THEN n_name END) AS n_name_1, max(CASE WHEN rn % 3 = 2 THEN n_name END) AS n_name_2,
      max(CASE WHEN rn % 3 = 0 THEN n_name END) AS n_name_3 FROM (SELECT n_name, row_number() OVER (ORDER BY n_name) AS rn FROM nation) GROUP BY ALL"""
)
def pivot3(spark: SparkSession, d: str) -> DataFrame:
    """Nations three to a line."""
    return sequences.wide(table(spark, d, "nation"), ["n_name"], ["n_name"])


@query(
    """SELECT doc_id, lang, source, CASE WHEN n_chars > 1000 THEN lang || '-' || source ELSE lang END AS created FROM documents
    WHERE source IS NOT NULL AND source <> '' AND n_chars <> 0 ORDER BY n_chars, doc_id LIMIT 50"""
)
def dashboard_view(spark: SparkSession, d: str) -> DataFrame:
    """A table view with a conditional column, truthy filters, and a sort."""
    rows = table(spark, d, "documents").filter("source is not null and source <> '' and n_chars <> 0").orderBy("n_chars", "doc_id").limit(50)
    return rows.select("doc_id", "lang", "source", F.when(F.col("n_chars") > 1000, F.concat_ws("-", "lang", "source")).otherwise(F.col("lang")).alias("created"))


@query("SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n, sum(l_quantity) AS quantity FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def free_sql(spark: SparkSession, d: str) -> DataFrame:
    """Free-form SQL with a named parameter."""
    register_tables(spark, d, ["lineitem"])
    return run_sql(spark, "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem WHERE l_shipdate <= timestamp(:upto) GROUP BY ALL", {"upto": "1998-09-02"})


# -- documents ----------------------------------------------------------------------------


_PLAIN = "replace(replace(replace(replace(replace(regexp_replace({}, '<[^>]*>', '', 'g'), '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&'), '&amp', '&')"
_PARAGRAPHS = f"""b AS (SELECT page_id, html, list_transform(string_split(html, '<p>')[2:], lambda x: {_PLAIN.format("regexp_extract(x, '^(?s)(.*?)(</p>|</article>|$)', 1)")}) AS ps FROM pages)"""


def _page_nodes(spark: SparkSession, d: str) -> DataFrame:
    return xml_nodes.shred(table(spark, d, "pages").select(F.col("page_id").cast("string").alias("id"), "html"), "id", "html", html=True)


@query(f"WITH {_PARAGRAPHS} SELECT page_id, i::INT AS nth, ps[i] AS text FROM (SELECT page_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM b)")
def html_text(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of web pages, read leniently, in order; scripts and styles hold none."""
    found = documents.tree_text(_page_nodes(spark, d), ["p"])
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("node_id"))
    return found.select(F.col("doc_id").cast("long").alias("page_id"), nth.alias("nth"), "text")


@query("SELECT tag, count(*)::BIGINT AS n, count(DISTINCT page_id)::BIGINT AS pages FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-z0-9]+)[ >]', 1)) AS tag FROM pages) GROUP BY tag")
def shred_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of all pages by tag."""
    return _page_nodes(spark, d).filter("parent_id >= 0").groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("pages"))


_TIDY = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"


@query(
    f"""WITH {_PARAGRAPHS}, t AS (SELECT page_id, ps, {_TIDY.format(_PLAIN.format("regexp_extract(html, '<title>([^<]*)<', 1)"))} AS title, {_TIDY.format(_PLAIN.format("regexp_extract(html, '<h1>([^<]*)<', 1)"))} AS h1,
      {_TIDY.format(_PLAIN.format("array_to_string(regexp_extract_all(html, '<a[^>]*>([^<]*)</a>', 1), '')"))} AS nav, {_TIDY.format(_PLAIN.format("regexp_extract(html, '<footer>([^<]*)<', 1)"))} AS foot FROM b)
    SELECT page_id, array_to_string(list_filter(['- ' || title, '## ' || title, nav, h1] || list_transform(ps, lambda x: {_TIDY.format("x")}) || [foot], lambda x: x <> ''), chr(10) || chr(10)) AS markdown FROM t"""
)
def render_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Every page as Markdown."""
    nodes = _page_nodes(spark, d).withColumn("text", F.when(F.col("tag").isin("script", "style"), "").otherwise(F.col("text")))  # what follows them stays
    return documents.render_articles(nodes, skip_words=(), gap=" ").select(F.col("doc_id").cast("long").alias("page_id"), "markdown")


# -- streams ------------------------------------------------------------------------------


@query("SELECT event_type, count(DISTINCT user_id)::BIGINT AS n FROM events GROUP BY event_type")
def stream_counts(spark: SparkSession, d: str) -> DataFrame:
    """Users per type of event, counted by a stream that reads what is there and ends; results in files."""
    rows = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*")
    return gap_stream.counted(gap_stream.distinct_counts(rows, "event_type", "user_id"))
