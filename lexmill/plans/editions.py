"""Queries of reports on periodicals, of batches over a catalogue, and of readers of labels and calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as tx
from lexmill.operators import documents, matching, periodicals, reports, sequences
from lexmill.plans import texts
from lexmill.plans.catalogue import query
from lexmill.session import shared_folder, table
from lexmill.sources import files, writers

_REFS = """r AS (SELECT o_orderpriority AS pub, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE (o_custkey % 12 + 1)::INT END AS vol, CASE WHEN o_orderkey % 6 = 0 THEN (o_orderkey % 9 + 1) || '-' || (o_orderkey % 9 + 2) ELSE (o_orderkey % 9 + 1)::VARCHAR END AS issue,
      CASE WHEN (o_custkey % 12 + o_orderkey % 9) % 3 = 0 THEN '19' || (20 + o_custkey % 12) || '-0' || (o_orderkey % 9 + 1) || '-01' WHEN (o_custkey % 12 + o_orderkey % 9) % 3 = 1 THEN '' END AS date FROM orders WHERE o_orderpriority <> '1-URGENT'),
    q AS (SELECT *, CASE WHEN date <> '' THEN 'dated' WHEN date = '' THEN 'matched' ELSE 'unmatched' END AS state FROM r),
    k AS (SELECT DISTINCT o_orderpriority AS pub, CASE WHEN o_orderpriority < '3' THEN 'volumes' ELSE 'issues' END AS kind FROM orders),
    e AS (SELECT pub, vol, issue, min(date) AS date, min(state) AS state FROM q GROUP BY ALL),
    n AS (SELECT *, row_number() OVER (PARTITION BY pub ORDER BY vol NULLS LAST, string_split(issue, '-')[1]::INT, issue) AS nth FROM e),
    p AS (SELECT pub, kind, refs, count(*) AS n, count(*) FILTER (state = 'dated') AS dated, count(*) FILTER (state = 'matched') AS matched, count(*) FILTER (state = 'unmatched') AS unmatched FROM n JOIN k USING (pub) JOIN (SELECT pub, count(*) AS refs FROM q GROUP BY pub) USING (pub) GROUP BY ALL)"""


@query(
    f"""WITH {_REFS},
    t AS (SELECT pub, string_agg('| ' || nth || ' | ' || CASE WHEN vol IS NULL THEN '第' || issue || '期' ELSE vol || '卷' || issue || '期' END || ' | ' || CASE WHEN coalesce(date, '') <> '' THEN replace(date, '-', '.') ELSE state END || ' | ' || state || ' |', chr(10) ORDER BY nth) AS rows FROM n GROUP BY pub)
    SELECT 1 AS nth, 'totals' AS part, 'Issues' AS name, '# Issues' || chr(10) || chr(10) || '| publications | issues | dated | matched | unmatched |' || chr(10) || '|---|---|---|---|---|' || chr(10) || concat('| ', count(*), ' | ', sum(n)::BIGINT, ' | ', sum(dated)::BIGINT, ' | ', sum(matched)::BIGINT, ' | ', sum(unmatched)::BIGINT, ' |') AS markdown FROM p
    UNION ALL SELECT 2, 'kinds', '', '| kind | publications | issues | dated | matched | unmatched |' || chr(10) || '|---|---|---|---|---|---|' || chr(10) || string_agg(line, chr(10) ORDER BY kind) FROM
      (SELECT kind, concat('| ', kind, ' | ', count(*), ' | ', sum(n)::BIGINT, ' | ', sum(dated)::BIGINT, ' | ', sum(matched)::BIGINT, ' | ', sum(unmatched)::BIGINT, ' |') AS line FROM p GROUP BY kind)
    UNION ALL SELECT (row_number() OVER (ORDER BY refs DESC, pub) + 2)::INT, 'publication', pub, concat('## ', pub, '（', refs, '）', chr(10), chr(10), '> ', kind, chr(10), '>', chr(10), '> | dated | ', dated, ' |', chr(10), '> | matched | ', matched, ' |', chr(10), '> | unmatched | ', unmatched, ' |',
      chr(10), chr(10), '| # | issue | date | state |', chr(10), '|---|---|---|---|', chr(10), rows) FROM p JOIN t USING (pub)
    UNION ALL SELECT 1073741824, 'missing', '', '## without references' || chr(10) || chr(10) || string_agg('- ' || pub, chr(10) ORDER BY pub) FROM k WHERE pub NOT IN (SELECT pub FROM q)"""
)
def issue_tables(spark: SparkSession, d: str) -> DataFrame:
    """The report on issues: totals, kinds, every publication's table, and publications without references."""
    orders = table(spark, d, "orders")
    issue, both = (F.col("o_orderkey") % 9 + 1), (F.col("o_custkey") % 12 + F.col("o_orderkey") % 9) % 3
    date = F.when(both == 0, F.concat(F.lit("19"), 20 + F.col("o_custkey") % 12, F.lit("-0"), issue, F.lit("-01"))).when(both == 1, "")
    refs = orders.filter("o_orderpriority <> '1-URGENT'").select(
        F.col("o_orderpriority").alias("pub"), F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey") % 12 + 1).cast("int").alias("vol"),
        F.when(F.col("o_orderkey") % 6 == 0, F.concat(issue, F.lit("-"), issue + 1)).otherwise(issue.cast("string")).alias("issue"), date.alias("date"),
    )
    refs = refs.withColumn("state", F.when(F.col("date") != "", "dated").when(F.col("date") == "", "matched").otherwise("unmatched"))
    kinds = orders.select(F.col("o_orderpriority").alias("pub"), F.when(F.col("o_orderpriority") < "3", "volumes").otherwise("issues").alias("kind")).distinct()
    return periodicals.issue_report(periodicals.issue_entries(refs, kinds), "Issues")


_CATEGORIES = ["volumes", "issues", "dated", "papers", "books", "houses"]
_OF = "CASE substr(p_brand, 7)::INT % 7 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CATEGORIES)) + " END"


@query(
    f"""WITH v AS (SELECT p_brand AS name, coalesce({_OF}, 'books') AS category, p_type, p_size, p_partkey FROM part WHERE p_brand <> 'Brand#1'),
    b AS (SELECT name, category, count(*) AS refs, string_agg(DISTINCT p_type, ' / ' ORDER BY p_type) AS aliases, CASE max(p_partkey) % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'high' ELSE '?' END AS confidence FROM v GROUP BY ALL),
    s AS (SELECT name, p_size, row_number() OVER (PARTITION BY name ORDER BY p_size) AS rn FROM (SELECT DISTINCT name, p_size FROM v)),
    l AS (SELECT name, (rn - 1) // 3 AS line, '| ' || string_agg(p_size || ' | ' || (1919 + p_size), ' | ' ORDER BY p_size) || ' |' AS cells FROM s GROUP BY ALL),
    t AS (SELECT name, '| volume | year | volume | year | volume | year |' || chr(10) || '|---|---|---|---|---|---|' || chr(10) || string_agg(cells, chr(10) ORDER BY line) AS volumes FROM l GROUP BY name),
    m AS (SELECT category, count(*) AS n, string_agg(concat('### ', name, chr(10), chr(10), '| item | value |', chr(10), '|---|---|', chr(10), '| references | ', refs, ' |', chr(10), '| aliases | ', aliases, ' |', chr(10), '| confidence | ', confidence, ' |', chr(10), chr(10), volumes, chr(10)), chr(10) ORDER BY refs DESC, name) AS body FROM b JOIN t USING (name) GROUP BY category),
    c AS (SELECT unnest({_CATEGORIES}) AS category, unnest(range(2, 8)) AS nth)
    SELECT 1 AS nth, 'overview' AS section, concat('# Calendar', chr(10), chr(10), (SELECT count(*) FROM b), chr(10), chr(10), '| category | publications |', chr(10), '|---|---|', chr(10), string_agg(concat('| ', category, ' | ', coalesce(n, 0), ' |'), chr(10) ORDER BY nth)) AS markdown FROM c LEFT JOIN m USING (category)
    UNION ALL SELECT nth::INT, category, concat('## ', category, chr(10), chr(10), body) FROM c LEFT JOIN m USING (category)
    UNION ALL SELECT 8, 'rules of thumb', '## rules of thumb' || chr(10) || chr(10) || string_agg('- **' || r_name || '**：' || r_regionkey || ' a year', chr(10) ORDER BY r_name) FROM region
    UNION ALL SELECT 9, 'uncertain', '## uncertain' || chr(10) || chr(10) || coalesce(string_agg('- ' || name || '（' || category || '）', chr(10) ORDER BY name), '') FROM b WHERE confidence = 'low'"""
)
def calendar_sections(spark: SparkSession, d: str) -> DataFrame:
    """The nine sections of a calendar that was written as JSON, one file a brand, and read again."""
    base, brand = shared_folder(spark, "calendar"), F.substring("p_brand", 7, 9).cast("int") % 7
    category = F.get(F.array(*map(F.lit, _CATEGORIES)), brand)
    part = table(spark, d, "part").filter("p_brand <> 'Brand#1'")
    years = F.map_from_entries(F.collect_set(F.struct(F.col("p_size").cast("string"), (F.col("p_size") + 1919).cast("int"))))
    pub = F.struct(category.alias("category"), F.col("aliases"), F.col("ref_count"), F.col("volume_to_year"), F.col("confidence"))
    made = part.groupBy("p_brand").agg(
        F.array_sort(F.collect_set("p_type")).alias("aliases"), F.count(F.lit(1)).alias("ref_count"), years.alias("volume_to_year"),
        F.when(F.max("p_partkey") % 3 == 0, "low").when(F.max("p_partkey") % 3 == 1, "high").alias("confidence"),
    )
    writers.write_named(made.select(F.concat("p_brand", F.lit(".json")).alias("name"), F.to_json(F.struct(F.create_map("p_brand", pub).alias("publications"))).alias("text")), base)
    rule = F.to_json(F.struct(F.create_map("r_name", F.concat(F.col("r_regionkey").cast("string"), F.lit(" a year"))).alias("heuristics")))
    writers.write_named(table(spark, d, "region").select(F.concat(F.lit("rules/"), "r_name", F.lit(".json")).alias("name"), rule.alias("text")), base)
    pubs, rules = files.read_calendar(spark, f"{base}/*.json")
    _, rules = files.read_calendar(spark, f"{base}/rules/*.json")
    return periodicals.calendar_report(pubs, rules, _CATEGORIES, "Calendar", "books", "low")


@query(
    """SELECT n_nationkey AS seq, doc_id IS NULL AS missing, coalesce(len(regexp_extract_all(text, 'the|tion')), 0)::BIGINT AS hits
    FROM nation LEFT JOIN (SELECT doc_id, text FROM documents WHERE doc_id % 4 <> 0) ON doc_id = n_nationkey * 3 WHERE n_nationkey BETWEEN 3 AND 20"""
)
def batch_over_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Hits in the articles of a catalogue's entries 3 to 20; entries whose article is not there are told."""
    entries = table(spark, d, "nation").select(F.col("n_nationkey").alias("seq"), (F.col("n_nationkey") * 3).cast("long").alias("path"))
    articles = table(spark, d, "documents").filter("doc_id % 4 <> 0").select(F.col("doc_id").alias("path"), "text")
    chosen = periodicals.in_batch(entries, articles, 3, 20)
    n = matching.hits(chosen.select("seq", "text"), ["the", "tion"], "text").groupBy("seq").agg(F.count(F.lit(1)).alias("hits"))
    return chosen.join(n, "seq", "left").select("seq", "missing", F.coalesce("hits", F.lit(0)).alias("hits"))


@query(
    f"""WITH {texts._TERMS}, p AS (SELECT dimension, count(*) - coalesce(max(n), 0) AS wrong, coalesce(max(m), 0) AS gaps FROM t LEFT JOIN (SELECT dimension, count(*) AS n, count(DISTINCT term) AS m FROM u GROUP BY dimension) USING (dimension) GROUP BY dimension),
    g AS ({texts.ORACLE_ADDITIONS})
    SELECT '# gaps' || chr(10) || chr(10) || (SELECT string_agg(concat('- ', dimension, ': ', wrong, ' false, ', gaps, ' gaps'), chr(10) ORDER BY dimension) FROM p) || chr(10) || chr(10)
      || (SELECT string_agg(concat('- ', dimension, ' ', term, ' ×', n, CASE WHEN domain IS NOT NULL THEN ' → ' || domain ELSE '' END), chr(10) ORDER BY n DESC, dimension, term) FROM g) AS markdown"""
)
def review_as_text(spark: SparkSession, d: str) -> DataFrame:
    """The text of a review of gaps."""
    report, additions, _ = reports.gap_review(texts._gap_log(spark, d), texts._known(spark), spark.createDataFrame(texts._VOCABULARY, "standard string, domain string"))
    return periodicals.review_text(report, additions)


@query("SELECT DISTINCT 'functions' AS dimension, p_type AS label FROM part UNION SELECT 'bearings', p_brand FROM part WHERE p_size > 3")
def labels_read(spark: SparkSession, d: str) -> DataFrame:
    """Labels of two dimensions, written as JSON documents and read again."""
    base, part = shared_folder(spark, "labels"), table(spark, d, "part")
    lists = part.groupBy((F.col("p_partkey") % 5).alias("k")).agg(F.collect_set("p_type").alias("functions"), F.collect_set(F.when(F.col("p_size") > 3, F.col("p_brand"))).alias("bearings"))
    writers.write_named(lists.select(F.concat(F.lit("labels-"), "k", F.lit(".json")).alias("name"), F.to_json(F.struct("functions", "bearings")).alias("text")), base)
    return files.read_labels(spark, base)


@query(
    """SELECT name, kind FROM (SELECT name, kind, row_number() OVER (PARTITION BY name ORDER BY kind DESC) AS rn FROM
      (SELECT p_type AS name, 'type' AS kind FROM part UNION ALL SELECT p_brand, 'brand' FROM part UNION ALL SELECT p_name, 'name' FROM part UNION ALL SELECT p_type, 'again' FROM part)) WHERE rn = 1"""
)
def union_deduplicated(spark: SparkSession, d: str) -> DataFrame:
    """Names of several sources in one table, each once, of the source that comes first."""
    part = table(spark, d, "part")
    sources = [part.select(F.col(c).alias("name"), F.lit(k).alias("kind")) for c, k in (("p_type", "type"), ("p_brand", "brand"), ("p_name", "name"), ("p_type", "again"))]
    rows = sources[0]
    for s in sources[1:]:
        rows = rows.unionByName(s)
    return sequences.first_of_each(rows.distinct(), ["name"], [F.desc("kind")])


_CJK = texts.of("p_size", texts.num("(p_partkey % 99 + 1)"), "concat('因緣', p_name)", "'緣起'", "p_name", "'目次'", "'科分一'", "'\U00020000漢'")


@query(f"SELECT p_partkey, p_size % 7 IN (0, 2, 4, 5, 6) AS only_cjk, p_size % 7 NOT IN (4, 5) AS kept FROM part")
def headings_kept(spark: SparkSession, d: str) -> DataFrame:
    """Headings wholly of CJK characters of the wide class, and those that are not purely structural."""
    rows = table(spark, d, "part").selectExpr("p_partkey", f"{_CJK} AS text")
    kept = documents.kept_headings(rows).select("p_partkey", F.lit(True).alias("kept"))
    return rows.join(kept, "p_partkey", "left").select("p_partkey", tx.is_only(F.col("text"), tx.CJK_WIDE).alias("only_cjk"), F.coalesce("kept", F.lit(False)).alias("kept"))


@query("SELECT p_partkey, p_name, p_size::BIGINT AS p_size, p_retailprice FROM part WHERE p_size BETWEEN 5 AND 30 AND p_type IN ('ECONOMY', 'SMALL', 'LARGE') AND p_partkey % 5 <> 0")
def dump_read(spark: SparkSession, d: str) -> DataFrame:
    """Parts written as an XML dump that declares its columns, read in declared types, and filtered by range, type and name of a level."""
    base = shared_folder(spark, "dump")
    field = lambda c: F.concat(F.lit(f'<field name="{c}">'), F.replace(F.col(c).cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("</field>"))
    row = F.concat(F.lit("<row>"), *(field(c) for c in ("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")), F.lit("</row>"))
    kinds = (("p_partkey", "int(11)", "PRI"), ("p_name", "varchar(55)", ""), ("p_type", "varchar(25)", ""), ("p_size", "int(11)", ""), ("p_retailprice", "double", ""))
    head = '<table_structure name="part">' + "".join(f'<field Field="{n}" Type="{t}" Null="NO" Key="{k}" Extra=""/>' for n, t, k in kinds) + "</table_structure>"
    writers.write_named(spark.range(1).select(F.lit("structure.xml").alias("name"), F.lit(f"<d>{head}</d>").alias("text")), base)
    by = table(spark, d, "part").withColumn("row", row).groupBy(F.floor(F.col("p_partkey") / 500).alias("k")).agg(F.array_join(F.collect_list("row"), "\n").alias("rows"))
    writers.write_named(by.select(F.concat(F.lit("data-"), "k", F.lit(".xml")).alias("name"), F.concat(F.lit("<d><table_data>"), "rows", F.lit("</table_data></d>")).alias("text")), base)
    rows = files.typed_dump(spark, base)
    return rows.filter(F.col("p_size").between(5, 30) & F.col("p_type").isin("ECONOMY", "SMALL", "LARGE") & (F.col("p_partkey") % 5 != 0)).select("p_partkey", "p_name", "p_size", "p_retailprice")
