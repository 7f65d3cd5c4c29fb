"""More queries: one or more operators each, over the tables, with the SQL that must give the same rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import bylines, classify, registry
from lexmill.functions import text as tx
from lexmill.operators import documents, gaps, lookups, matching, rendering, reports, sequences
from lexmill.plans.catalogue import _FLAGS, _PER_LINE, _found, _rows, _values, query
from lexmill.session import register_tables, run_sql, shared_folder, spread, table
from lexmill.sources import files, sqlite, writers, xml_nodes
from lexmill.streaming import gap_stream

# -- joins ----------------------------------------------------------------------------------


@query(
    """SELECT e.event_id, e.user_id, p.event_id AS last_purchase FROM events e ASOF LEFT JOIN
      (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) p ON e.user_id = p.user_id AND e.ts >= p.ts"""
)
def asof_join(spark: SparkSession, d: str) -> DataFrame:
    """Every event with its user's last purchase up to then."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    bought = events.filter("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("event_id").alias("last_purchase"))
    return lookups.asof_join(events.drop("event_type"), bought, "user_id", "ts", ["last_purchase"]).select("event_id", "user_id", "last_purchase")


_BANDS = [(i, 37.0 * i, 37.0 * i + 55.0) for i in range(60)]


@query(f"SELECT band, count(*)::BIGINT AS n, min(p_partkey)::BIGINT AS first_part FROM part JOIN {_values(_BANDS)} b(band, lo, hi) ON p_retailprice BETWEEN lo AND hi GROUP BY band")
def interval_join(spark: SparkSession, d: str) -> DataFrame:
    """Parts in overlapping bands of prices."""
    bands = _rows(spark, "band int, lo double, hi double", _BANDS)
    met = lookups.interval_join(table(spark, d, "part").select("p_partkey", "p_retailprice"), bands, "p_retailprice", "lo", "hi", 50.0)
    return met.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_part"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL)")
def entities_without_reference(spark: SparkSession, d: str) -> DataFrame:
    """Customers without a finished order: an anti join that leaves rows over."""
    orders = table(spark, d, "orders").filter("o_orderstatus = 'F'")
    return lookups.missing(table(spark, d, "customer").select("c_custkey"), orders, F.col("c_custkey"), F.col("o_custkey"))


@query("SELECT l_partkey FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT p_partkey FROM part WHERE p_size < 25")
def set_intersect(spark: SparkSession, d: str) -> DataFrame:
    """Parts that are small and were shipped in large lots."""
    register_tables(spark, d, ["lineitem", "part"])
    return run_sql(spark, "SELECT l_partkey FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT p_partkey FROM part WHERE p_size < 25")


_NAMES = [("AUTOMOBILE", "car"), ("BUILDING", "house"), ("MACHINERY", "machine")]


@query(f"SELECT c_custkey, coalesce(b.c, nullif(trim(c_mktsegment), '')) AS canonical FROM customer LEFT JOIN {_values(_NAMES)} b(a, c) ON trim(c_mktsegment) = b.a")
def alias_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Segments by their canonical names, others as they are."""
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return lookups.canonical_name(rows, "c_mktsegment", _rows(spark, "alias string, canonical string", _NAMES)).select("c_custkey", "canonical")


@query(
    """SELECT p_brand, coalesce(arg_min(v, p_partkey) FILTER (WHERE v <> ''), '') AS p_type FROM
    (SELECT *, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '0000-00-00' ELSE p_type END AS w, CASE WHEN p_partkey % 4 IN (0, 1) THEN '' ELSE p_type END AS v FROM part) GROUP BY p_brand"""
)
def best_date(spark: SparkSession, d: str) -> DataFrame:
    """The first real value of each brand; empty and zero dates are none."""
    at = F.col("p_partkey") % 4
    rows = table(spark, d, "part").select("p_brand", "p_partkey", F.when(at == 0, "").when(at == 1, "0000-00-00").otherwise(F.col("p_type")).alias("p_type"))
    return lookups.best_dates(rows, ["p_brand"], "p_type", "p_partkey")


@query("SELECT o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders WHERE o_orderkey % 5 = 0) WHERE rank <= 20")
def anchors_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Rows that anchors point to, with the anchors' order."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    best = sequences.top(orders.filter("o_orderkey % 5 = 0"), 20, [F.desc("o_totalprice"), "o_orderkey"])
    anchors = sequences.linked(best.withColumn("g", F.lit(0)), [F.desc("o_totalprice"), "o_orderkey"], ["g"], "o_orderkey").select("o_orderkey", F.col("seq").cast("long").alias("rank"))
    return lookups.in_order_of(orders, anchors, "o_orderkey", "rank").select("o_orderkey", "o_totalprice", "rank")


# -- aggregates -----------------------------------------------------------------------------


@query("SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_counts(spark: SparkSession, d: str) -> DataFrame:
    """Lines by flag and status, each alone, and all."""
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("SELECT event_type, true AS close, count(*)::BIGINT AS n FROM events GROUP BY event_type")
def approximate_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Whether approximate numbers of users and medians are within their error."""
    exact, near = F.count_distinct("user_id"), F.approx_count_distinct("user_id", 0.02)
    low, mid, high = (F.expr(f"percentile(value, {p})") for p in (0.45, 0.5, 0.55))
    close = (F.abs(exact - near) <= 0.1 * exact + 1) & F.approx_percentile("value", 0.5, 1000).between(F.least(low, mid), F.greatest(high, mid))
    return table(spark, d, "events").groupBy("event_type").agg(close.alias("close"), F.count(F.lit(1)).alias("n"))


@query(
    """SELECT o_orderkey, avg(o_totalprice) OVER w AS moving, sum(o_totalprice) OVER r AS in_range FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), r AS (PARTITION BY o_custkey ORDER BY o_orderkey RANGE BETWEEN 1000 PRECEDING AND 1000 FOLLOWING)"""
)
def window_frames(spark: SparkSession, d: str) -> DataFrame:
    """Moving averages by rows, sums by range."""
    register_tables(spark, d, ["orders"])
    return run_sql(
        spark,
        """SELECT o_orderkey, avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving,
          sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey RANGE BETWEEN 1000 PRECEDING AND 1000 FOLLOWING) AS in_range FROM orders""",
    )


@query("SELECT domain, count(*)::BIGINT AS n FROM (WITH " + _PER_LINE.strip() + " SELECT domain FROM c) GROUP BY domain")
def domain_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Candidates by domain."""
    return matching.histogram(_found(spark, d), "domain")


@query("SELECT p_brand AS domain, string_agg(DISTINCT p_type, '、' ORDER BY p_type) AS subdomains FROM part WHERE p_brand <> '' AND p_type <> '' GROUP BY p_brand")
def domain_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """Types of each brand, sorted."""
    return matching.taxonomy(table(spark, d, "part").select(F.col("p_brand").alias("domain"), F.col("p_type").alias("subdomain")))


@query("SELECT count(DISTINCT source)::BIGINT AS articles, count(DISTINCT source) > 0 AND count(DISTINCT source) % 5 = 0 AS due FROM documents")
def review_due(spark: SparkSession, d: str) -> DataFrame:
    """Whether a review falls due at this number of sources."""
    return gaps.due_for_review(table(spark, d, "documents").select(F.col("source").alias("article_path")))


@query(
    f"""SELECT count(*)::BIGINT AS relevant, count(a)::BIGINT AS matched, (count(*) FILTER (WHERE a IS NULL AND regexp_matches(text, '[0-9]{{4}}')))::BIGINT AS unmatched, count(DISTINCT a)::BIGINT AS names
    FROM (SELECT text, CASE WHEN contains(text, 'https://') THEN 'web' WHEN contains(text, '@') THEN 'mail' END AS a FROM documents)"""
)
def match_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Texts with a known name, and unknown ones that look like references."""
    t = F.col("text")
    rows = table(spark, d, "documents").select("text", F.when(t.contains("https://"), "web").when(t.contains("@"), "mail").alias("a"))
    return lookups.match_statistics(rows, "text", "a", "[0-9]{4}")


@query(
    r"""SELECT tag, count(*)::BIGINT AS n, min(doc_id)::BIGINT AS first_doc FROM
    (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{3} ')) AS tag FROM documents) GROUP BY tag HAVING count(*) >= 2"""
)
def tag_frequency(spark: SparkSession, d: str) -> DataFrame:
    """Capitalised words that end in three small letters, exploded and counted."""
    rows = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{3} "), F.lit(0))).alias("tag"))
    return rows.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")).filter("n >= 2")


# -- functions on texts -----------------------------------------------------------------------


@query(
    """SELECT doc_id, substr(text, 1, 120) AS head, regexp_matches(text, 'https?://') AS structural, trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' AS blank,
      list_position(['en', 'de', 'fr'], lang)::BIGINT AS place FROM documents"""
)
def truncation_and_filters(spark: SparkSession, d: str) -> DataFrame:
    """Texts cut short, structural and blank ones marked, languages by their place in a list."""
    t, langs = F.col("text"), F.array(*map(F.lit, ("en", "de", "fr")))
    return table(spark, d, "documents").select(
        "doc_id", tx.truncated(t, 120).alias("head"), tx.is_structural(t, ("https?://",)).alias("structural"), (F.trim(F.regexp_replace(t, r"\s+", " ")) == "").alias("blank"),
        tx.directory_index(F.col("lang"), langs).alias("place"),
    )


@query("SELECT p_brand, string_agg('[' || p_type || '](' || p_partkey || ')', ' / ' ORDER BY p_partkey) AS links, string_agg(p_type, '、' ORDER BY p_partkey) AS names FROM part WHERE p_size <= 3 GROUP BY p_brand")
def link_lists(spark: SparkSession, d: str) -> DataFrame:
    """Markdown links and joined names."""
    listed = F.sort_array(F.collect_list(F.struct("p_partkey", "p_type")))
    rows = table(spark, d, "part").filter("p_size <= 3").groupBy("p_brand").agg(listed.alias("x"))
    names, targets = F.col("x.p_type"), F.transform("x.p_partkey", lambda k: k.cast("string"))
    return rows.select("p_brand", tx.link_list(names, targets).alias("links"), tx.joined(names).alias("names"))


@query("""SELECT p_partkey, '"' || replace(replace(p_name || CASE WHEN p_size % 2 = 0 THEN '"\\' ELSE '' END, '\\', '\\\\'), '"', '\\"') || '"' AS quoted FROM part""")
def yaml_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Names as quoted scalars."""
    odd = F.when(F.col("p_size") % 2 == 0, '"\\').otherwise("")
    return table(spark, d, "part").select("p_partkey", tx.yaml_quoted(F.concat("p_name", odd)).alias("quoted"))


@query("SELECT conv_id, list(r ORDER BY f) AS roles FROM (SELECT conv_id, role || (turn // 2)::VARCHAR AS r, min(turn) AS f FROM conversations GROUP BY ALL) GROUP BY conv_id")
def distinct_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Items of a list without repeats, in order."""
    item = F.concat("role", F.floor(F.col("turn") / 2).cast("long").cast("string"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("turn", item.alias("r")))), lambda x: x["r"])
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(listed.alias("rs"))
    return rows.select("conv_id", sequences.distinct_in_order(F.col("rs")).alias("roles"))


@query(f"SELECT doc_id, regexp_matches(text, '{_FLAGS['link']}|{_FLAGS['mail']}') AS about, concat('某在', coalesce(lang, '何處'), left(text, 3), '講，今附') AS placed FROM (SELECT doc_id, lang, replace(replace(text, ',', ''), '，', '') AS text FROM documents) WHERE left(text, 3) NOT SIMILAR TO '.*[，。,].*'")
def publication_predicate(spark: SparkSession, d: str) -> DataFrame:
    """Whether a text tells of given words, and places put before verbs."""
    docs = table(spark, d, "documents").select("doc_id", "lang", F.translate("text", ",，", "").alias("text")).filter(~F.left("text", F.lit(3)).rlike("[，。,]"))
    line = F.concat(F.lit("某講於"), F.coalesce("lang", F.lit("何處")), F.left("text", F.lit(3)), F.lit("，今附"))
    return docs.select("doc_id", classify.about_publication(F.col("text"), ["http://", "https://", "@"]).alias("about"), bylines.appendix_place(line).alias("placed"))


# -- candidates and prompts -------------------------------------------------------------------


@query(
    f"""WITH {_PER_LINE}, p AS (SELECT doc_id, standard, domain, occurrences, heading_hits, occurrences + 3 * heading_hits AS score FROM c)
    SELECT doc_id, chr(10) || '| ' || string_agg(standard || ' | ' || occurrences::BIGINT::VARCHAR || ' | ' || domain || ' | ' || CASE WHEN heading_hits > 0 THEN '✓' ELSE '' END || ' |', chr(10) || '| ' ORDER BY standard) AS rows,
      count(*)::BIGINT AS n FROM p GROUP BY doc_id"""
)
def candidate_tables(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of every document as a Markdown table, rows by name."""
    found = _found(spark, d)
    made = reports.candidate_context(found.withColumn("nth", F.dense_rank().over(sequences.Window.partitionBy("doc_id").orderBy("standard"))))
    head = "| 術語 | 頻次 | 知識域/子域 | 標題命中 |\n|------|:--:|------|:--:|"
    n = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return made.select("doc_id", F.substring("context", len(head) + 1, 1 << 30).alias("rows")).join(n, "doc_id")


@query(f"WITH {_PER_LINE} SELECT doc_id, sum(occurrences)::BIGINT AS raw_hits, count(*)::BIGINT AS after_dedup, max(standard) AS last_standard FROM c GROUP BY doc_id")
def candidate_documents(spark: SparkSession, d: str) -> DataFrame:
    """Candidates as JSON, written and read back."""
    path = shared_folder(spark, "candidates")
    writers.write_json(reports.candidate_json(_found(spark, d)).select("doc_id", "json"), path)
    back = writers.read_back(spark, path, "json", "doc_id long, json string")
    kind = "match_stats struct<raw_hits:long,after_dedup:long>, candidates array<struct<standard:string>>"
    return back.select("doc_id", F.from_json("json", kind).alias("j")).select("doc_id", "j.match_stats.*", F.array_max("j.candidates.standard").alias("last_standard"))


@query(
    f"""WITH {_PER_LINE} SELECT doc_id, standard, CASE WHEN p > 40 THEN '…' ELSE '' END || replace(substr(text, greatest(p - 40, 0) + 1, least(length(text), p + 42) - greatest(p - 40, 0)), chr(10), ' ')
      || CASE WHEN least(length(text), p + 42) < length(text) THEN '…' ELSE '' END AS context FROM (SELECT doc_id, standard, text, min(strpos(text, s)) - 1 AS p FROM
      (SELECT doc_id, standard, unnest(string_split(surfaces, '、')) AS s FROM c) JOIN documents USING (doc_id) GROUP BY ALL)"""
)
def candidate_contexts(spark: SparkSession, d: str) -> DataFrame:
    """Each candidate with the text around its first surface."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return matching.with_context(_found(spark, d), docs).select("doc_id", "standard", "context")


@query("SELECT n_nationkey, 'Name: ' || n_name || '; region ' || n_regionkey || '; {rest}' AS prompt, 'N=' || n_name || '!' AS filled FROM nation")
def filled_prompts(spark: SparkSession, d: str) -> DataFrame:
    """Templates filled; unknown names stay."""
    key = F.col("n_regionkey").cast("string")
    rows = table(spark, d, "nation")
    made = matching.prompt(F.lit("Name: {name}; region {region}; {rest}"), {"name": F.col("n_name"), "region": key})
    return rows.select("n_nationkey", made.alias("prompt"), rendering.filled_template("N={n}!", {"n": F.col("n_name")}).alias("filled"))


# -- gaps -------------------------------------------------------------------------------------


_SHELVES = [("click", "web", "page"), ("purchase", "shop", ""), ("view", "web", "list"), ("signup", "", "form")]


@query(
    f"""WITH v AS (SELECT * FROM {_values(_SHELVES)} v(standard, domain, subdomain)), t AS (SELECT DISTINCT user_id, event_type AS term FROM events WHERE event_type IS NOT NULL),
      m AS (SELECT t.term, t.user_id, v.domain, v.subdomain FROM t JOIN events e ON t.user_id = e.user_id AND e.event_type <> t.term JOIN v ON v.standard = e.event_type),
      d AS (SELECT term, domain FROM m WHERE domain <> '' GROUP BY term, domain QUALIFY row_number() OVER (PARTITION BY term ORDER BY count(*) DESC, min(user_id), domain) = 1),
      s AS (SELECT term, subdomain FROM m WHERE subdomain <> '' GROUP BY term, subdomain QUALIFY row_number() OVER (PARTITION BY term ORDER BY count(*) DESC, min(user_id), subdomain) = 1)
      SELECT term, coalesce(domain, 'none') AS domain, coalesce(subdomain, '') AS subdomain FROM (SELECT DISTINCT term FROM t) LEFT JOIN d USING (term) LEFT JOIN s USING (term)"""
)
def company_votes(spark: SparkSession, d: str) -> DataFrame:
    """Domain and subdomain of each type of event by votes of what the same users did."""
    terms = table(spark, d, "events").filter("event_type is not null").select(F.col("user_id").alias("article"), F.col("event_type").alias("term"))
    return gaps.inferred_domains(terms, _rows(spark, "standard string, domain string, subdomain string", _SHELVES), "none")


# -- sinks and sources ------------------------------------------------------------------------


@query("SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'view'")
def append_events(spark: SparkSession, d: str) -> DataFrame:
    """Events appended to a log type by type, and read back."""
    path, rows = shared_folder(spark, "events"), table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    writers.append_log(rows.filter("event_type = 'purchase'"), path)
    writers.append_log(rows.filter("event_type not in ('purchase', 'view')"), path)
    return writers.read_back(spark, path, "json", rows._jdf.schema().toDDL())


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def batched_insert(spark: SparkSession, d: str) -> DataFrame:
    """Lines written as a table in batches, and read back."""
    path, rows = shared_folder(spark, "table"), table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    writers.write_table(rows, path, 5000)
    return writers.read_back(spark, path, "parquet", rows._jdf.schema().toDDL())


@query("SELECT lang, count(*)::BIGINT AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY lang")
def article_files(spark: SparkSession, d: str) -> DataFrame:
    """Texts written to a folder per language, and read back."""
    path = shared_folder(spark, "articles")
    docs = table(spark, d, "documents").select("lang", F.concat(F.lit("\x01"), "text").alias("text"))
    writers.write_articles(docs, path, by="lang")
    back = spark.read.option("lineSep", "\x01").text(path).filter("value <> ''")
    return back.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value") - 2).alias("chars"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer WHERE c_acctbal IS NOT NULL")
def sqlite_scan(spark: SparkSession, d: str) -> DataFrame:
    """Customers written as SQLite files, one a nation and thousand, and scanned again from their folder."""
    base, kind = shared_folder(spark, "sqlite"), "c_custkey long, c_name string, c_nationkey int, c_acctbal double"
    rows = table(spark, d, "customer").filter("c_acctbal is not null").select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"), F.col("c_acctbal").cast("double").alias("c_acctbal"))
    sqlite.write_sqlite(rows, base, "customer", F.concat_ws("-", "c_nationkey", F.floor(F.col("c_custkey") / 1000)))
    return sqlite.read_sqlite(spark, base, "customer", kind)


# -- reports ----------------------------------------------------------------------------------


@query(
    """SELECT r_name AS section, count(*)::BIGINT AS n, '## ' || r_name || '（' || count(*) || '）' || chr(10) || chr(10) || '| n_name | n_nationkey |' || chr(10) || '|---|---|' || chr(10)
      || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) ORDER BY n_name) AS markdown FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"""
)
def report_sections(spark: SparkSession, d: str) -> DataFrame:
    """Nations of each region as sections of a report."""
    met = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).withColumnRenamed("r_name", "section")
    return reports.sectioned(met, "section", ["n_name", "n_nationkey"], ["n_name"])


@query(
    """WITH s AS (SELECT c_mktsegment, count(*) AS n, '## ' || c_mktsegment || '（' || count(*) || '）' || chr(10) || chr(10) || '| c_custkey |' || chr(10) || '|---|' || chr(10) || string_agg('| ' || c_custkey || ' |', chr(10) ORDER BY c_custkey) AS m
      FROM customer WHERE c_custkey <= 40 GROUP BY c_mktsegment)
    SELECT '# Customers' || chr(10) || chr(10) || '共 ' || t || chr(10) || chr(10) || x AS markdown FROM (SELECT sum(n)::BIGINT AS t, string_agg(m, chr(10) || chr(10) ORDER BY c_mktsegment) AS x FROM s)"""
)
def whole_report(spark: SparkSession, d: str) -> DataFrame:
    """A report of all segments."""
    sections = reports.sectioned(table(spark, d, "customer").filter("c_custkey <= 40"), "c_mktsegment", ["c_custkey"], ["c_custkey"])
    return reports.document_of(sections, "Customers", ["c_mktsegment"])


@query(
    """WITH e AS (SELECT r_name, n_name, s_name, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    p AS (SELECT r_name, n_name, min(s_suppkey) AS f, count(*) AS n, string_agg('   - ' || s_suppkey || '. ' || s_name, chr(10) ORDER BY s_suppkey) AS names FROM e GROUP BY ALL)
    SELECT r_name, string_agg('- ' || n_name || chr(10) || names, chr(10) ORDER BY f) || chr(10) || chr(10) || '| 類 | 篇數 |' || chr(10) || '|---|---|' || chr(10)
      || string_agg('| ' || n_name || ' | ' || n || ' |', chr(10) ORDER BY f) || chr(10) || '| 合計 | ' || sum(n)::BIGINT || ' |' AS markdown FROM p GROUP BY r_name"""
)
def catalogue_lists(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers of each region as a nested list with a table of counts."""
    met = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return reports.catalogue_markdown(met.select("r_name", "n_name", "s_name", "s_suppkey"), "r_name", "n_name", "s_name", "s_suppkey")


@query("SELECT n_regionkey, '| n_name | n_nationkey |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) ORDER BY n_name) AS markdown FROM nation GROUP BY n_regionkey")
def markdown_tables_out(spark: SparkSession, d: str) -> DataFrame:
    """Nations of each region as Markdown tables."""
    return rendering.markdown_table(table(spark, d, "nation"), ["n_name", "n_nationkey"], ["n_name"], ["n_regionkey"])


@query(
    """SELECT c_custkey, '---' || chr(10) || 'name: "' || c_name || '"' || chr(10) || 'segment: ' || c_mktsegment || chr(10) || '---' || chr(10) || chr(10) || 'body' AS article, c_name AS name_back, c_mktsegment AS segment_back FROM customer WHERE c_mktsegment <> ''"""
)
def front_matter_written(spark: SparkSession, d: str) -> DataFrame:
    """Front matter written before texts, and read back."""
    block = rendering.front_matter_block({"name": F.col("c_name"), "segment": F.col("c_mktsegment"), "none": F.lit(None)}, quoted=("name",))
    rows = table(spark, d, "customer").filter("c_mktsegment <> ''").select("c_custkey", rendering.with_front_matter(F.lit("body"), block).alias("article"))
    back = files.front_matter(F.col("article"))
    return rows.select("c_custkey", "article", F.trim(back["name"], F.lit('"')).alias("name_back"), back["segment"].alias("segment_back"))


@query("SELECT n_regionkey, count(*)::BIGINT AS total, string_agg(n_name, ',' ORDER BY n_nationkey) AS names FROM nation GROUP BY n_regionkey")
def catalogue_as_json(spark: SparkSession, d: str) -> DataFrame:
    """Catalogues as JSON, parsed again."""
    made = rendering.catalogue_json(table(spark, d, "nation").select("n_regionkey", "n_nationkey", "n_name"), "n_regionkey", "n_nationkey")
    j = F.from_json("json", "total long, entries array<struct<n_nationkey:int,n_name:string>>")
    return made.select("n_regionkey", j.alias("j")).select("n_regionkey", "j.total", F.array_join("j.entries.n_name", ",").alias("names"))


@query(
    """SELECT c_custkey, c_name, CASE WHEN c_custkey = first THEN o_orderpriority END AS appendix, CASE WHEN c_custkey = first THEN n END AS n_chars FROM
    (SELECT c_custkey, c_mktsegment AS c_name, min(c_custkey) OVER (PARTITION BY c_mktsegment) AS first FROM customer) c
    LEFT JOIN (SELECT ['AUTOMOBILE', 'BUILDING', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE'][(o_orderkey % 5 + 1)::INT] AS k, min(o_orderpriority) AS o_orderpriority, max(o_custkey)::BIGINT AS n FROM orders GROUP BY 1) o ON k = c_name"""
)
def catalogue_upserts(spark: SparkSession, d: str) -> DataFrame:
    """Appendixes and lengths put to the first entry of each name."""
    segments = F.array(*map(F.lit, ("AUTOMOBILE", "BUILDING", "MACHINERY", "HOUSEHOLD", "FURNITURE")))
    entries = table(spark, d, "customer").select(F.col("c_custkey").alias("seq"), F.col("c_mktsegment").alias("name"))
    more = table(spark, d, "orders").select(F.get(segments, (F.col("o_orderkey") % 5).cast("int")).alias("name"), F.col("o_orderpriority").alias("appendix"), F.col("o_custkey").alias("n_chars"))
    return documents.with_appendixes(entries, more).select(F.col("seq").alias("c_custkey"), F.col("name").alias("c_name"), "appendix", "n_chars")


# -- trees ------------------------------------------------------------------------------------

_H = "'(?s)<h([1-6])[^>]*>(.*?)</h[1-6]>'"
_OUTLINE = f"""h AS (SELECT page_id, lvl, txt, i, lvl[i]::INT AS level FROM (SELECT page_id, lvl, txt, unnest(range(1, len(lvl) + 1)) AS i FROM (
  SELECT page_id, regexp_extract_all(html, {_H}, 1) AS lvl, regexp_extract_all(html, {_H}, 2) AS txt FROM pages))),
n AS (SELECT *, (SELECT min(j) FROM unnest(range(i + 1, len(lvl) + 1)) r(j) WHERE lvl[j]::INT <= level) AS nxt FROM h),
l AS (SELECT *, nxt IS NULL OR lvl[nxt]::INT < level AS is_last FROM n)"""


def _toc(spark: SparkSession, d: str) -> DataFrame:
    pattern = F.lit(r"(?s)<h([1-6])[^>]*>(.*?)</h[1-6]>")
    zipped = F.arrays_zip(F.regexp_extract_all("html", pattern, F.lit(1)).alias("l"), F.regexp_extract_all("html", pattern, F.lit(2)).alias("t"))
    rows = table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), F.posexplode(zipped).alias("seq", "h"))
    return rows.select("doc_id", "seq", F.col("h.l").cast("int").alias("level"), F.regexp_replace("h.t", "<[^>]*>", "").alias("text"))


@query(
    f"""WITH {_OUTLINE}, m AS (SELECT page_id, i, slot, (SELECT max(k.i) FROM l k WHERE k.page_id = s.page_id AND k.i < s.i AND k.level <= slot) AS k FROM (SELECT page_id, i, unnest(range(1, level)) AS slot FROM l) s),
    b AS (SELECT m.page_id, m.i, string_agg(CASE WHEN l.level = slot AND l.is_last THEN '    ' ELSE '|   ' END, '' ORDER BY slot) AS bars FROM m LEFT JOIN l ON l.page_id = m.page_id AND l.i = m.k GROUP BY ALL)
    SELECT l.page_id AS doc_id, (l.i - 1)::INT AS seq, coalesce(bars, '') || CASE WHEN is_last THEN '`-- ' ELSE '|-- ' END || regexp_replace(txt[l.i], '<[^>]*>', '', 'g') || ' (level ' || level || ')' AS line
    FROM l LEFT JOIN b ON l.page_id = b.page_id AND l.i = b.i"""
)
def toc_tree(spark: SparkSession, d: str) -> DataFrame:
    """Headings of pages as a tree with branches."""
    return documents.toc_lines(sequences.outline(_toc(spark, d), "doc_id"), "tree")


@query(
    f"""WITH {_OUTLINE} SELECT page_id AS doc_id, (i - 1)::INT AS seq, repeat('  ', level - 1) || regexp_replace(txt[i], '<[^>]*>', '', 'g') AS flat, level || ',"' || regexp_replace(txt[i], '<[^>]*>', '', 'g') || '"' AS csv, is_last FROM l"""
)
def toc_flat_csv(spark: SparkSession, d: str) -> DataFrame:
    """Headings of pages indented, and as CSV, with the last of their siblings marked."""
    toc = sequences.outline(_toc(spark, d), "doc_id")
    flat, csv = documents.toc_lines(toc), documents.toc_lines(toc, "csv").withColumnRenamed("line", "csv")
    return flat.withColumnRenamed("line", "flat").join(csv, ["doc_id", "seq"]).join(toc.select("doc_id", "seq", "is_last"), ["doc_id", "seq"])


@query(f"WITH {_OUTLINE} SELECT page_id AS doc_id, count(*)::BIGINT AS n, (count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM unnest(range(1, i)) r(j) WHERE lvl[j]::INT < level)))::BIGINT AS roots FROM l GROUP BY page_id")
def toc_nested(spark: SparkSession, d: str) -> DataFrame:
    """Headings of pages as nested JSON: how many there are, and how many at the top."""
    toc = documents.nested_toc(sequences.outline(_toc(spark, d), "doc_id"))
    n = F.regexp_count("toc", F.lit('"children"'))
    return toc.select("doc_id", n.cast("long").alias("n"), F.size(F.from_json("toc", "array<struct<text:string>>")).cast("long").alias("roots"))


@query(
    """SELECT p_partkey::VARCHAR AS old_path, CASE WHEN p_size % 2 = 0 THEN p_partkey::VARCHAR ELSE 'n' || p_partkey END AS new_path,
      CASE WHEN p_partkey % 5 = 0 THEN 'missing' WHEN p_partkey % 3 = 0 THEN 'kept' WHEN p_size % 2 = 0 THEN 'written' ELSE 'renamed' END AS action,
      CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 3 <> 0 THEN 'title: ' || p_brand || chr(10) || p_name END AS text FROM part"""
)
def front_matter_migration(spark: SparkSession, d: str) -> DataFrame:
    """What a migration does with every file: missing, kept, written, renamed."""
    part, path = table(spark, d, "part"), F.col("p_partkey").cast("string")
    new = F.when(F.col("p_size") % 2 == 0, path).otherwise(F.concat(F.lit("n"), path))
    entries = part.select(path.alias("old_path"), new.alias("new_path"), F.concat(F.lit("title: "), "p_brand").alias("block"))
    text = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("---"), "p_name")).otherwise(F.col("p_name"))
    return rendering.migrated(entries, part.filter("p_partkey % 5 <> 0").select(path.alias("path"), text.alias("text")))


_MANY = [f"{a}{b}" for a in "abcdefghijklmnopqrstuvwxyz" for b in ("e", "er", "en", "ing", "i", "io", "ion", "a", "at", "o", "ou", "s")]


@query(
    f"""SELECT surface, count(*)::BIGINT AS n, count(DISTINCT doc_id)::BIGINT AS documents FROM
      (SELECT doc_id, unnest(regexp_extract_all(text, '{matching.alternation(_MANY)}')) AS surface FROM documents) GROUP BY surface"""
)
def large_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Hits of a dictionary of 312 terms in whole texts."""
    found = matching.hit_counts(spread(table(spark, d, "documents").select("doc_id", "text")), _MANY, "text")
    return found.groupBy("surface").agg(F.sum("n").alias("n"), F.count_distinct("doc_id").alias("documents"))


@query("SELECT page_id, trim(regexp_replace(regexp_extract(substr(html, 1, 5000), '(?s)<title[^>]*>(.*?)</title>', 1), '<[^>]+>', '', 'g')) AS byline FROM pages")
def byline_in_first_bytes(spark: SparkSession, d: str) -> DataFrame:
    """The first title in the first bytes of a page."""
    content = F.col("html").cast("binary")
    return table(spark, d, "pages").select("page_id", documents.byline_in_bytes(content, F.lit(0), F.length(content), "title").alias("byline"))


@query(
    """SELECT doc_id, 'F' || chr(10) || chr(10) || '# ' || source || chr(10) || chr(10) || text || '因緣' || lang || '觀' || CASE WHEN lang = 'de' THEN chr(10) || chr(10) || '## 附' || chr(10) || chr(10) || 'x' ELSE '' END
      || chr(10) || chr(10) || '## 註' || chr(10) || chr(10) || '[1] ' || lang || chr(10) || '[2] ' || source AS text, 3 + length(regexp_replace(text, '[^一-龥]', '', 'g'))::BIGINT AS n_chars FROM documents WHERE text <> '' AND source IS NOT NULL AND lang IS NOT NULL"""
)
def assembled_articles(spark: SparkSession, d: str) -> DataFrame:
    """Whole articles put together: front matter, title, body, appendix, notes."""
    rows = table(spark, d, "documents").filter("text <> '' and source is not null and lang is not null")
    parts = rows.select("doc_id", F.lit("F").alias("front"), F.col("source").alias("title"), F.concat("text", F.lit("因緣"), "lang", F.lit("觀")).alias("markdown"), F.array("lang", "source").alias("notes"), F.when(F.col("lang") == "de", "x").alias("appendix"))
    return documents.assembled(parts)


@query("SELECT page_id, count(*)::BIGINT AS n, min(length(regexp_replace(t, '<[^>]*>', '', 'g')))::BIGINT AS shortest FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)) AS t FROM (SELECT page_id, regexp_replace(html, '<h1', '<h1 level=\"2\"', 'g') AS html FROM pages)) GROUP BY page_id")
def headings_by_pattern(spark: SparkSession, d: str) -> DataFrame:
    """Headings with a level, found by pattern."""
    marked = table(spark, d, "pages").select("page_id", F.explode(xml_nodes.headings_of(F.regexp_replace("html", "<h1", '<h1 level="2"'), "h1")).alias("h"))
    return marked.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.length("h.text")).cast("long").alias("shortest"))


# -- ordered rows, user-defined functions, streams ----------------------------------------------


@query(
    """SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY vol NULLS LAST, issue, p_partkey) AS nth FROM
    (SELECT *, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END AS vol, p_partkey % 13 AS issue FROM part)"""
)
def issue_order(spark: SparkSession, d: str) -> DataFrame:
    """Rows by volume, missing ones last, then by the number of the issue."""
    rows = table(spark, d, "part").select("p_partkey", "p_brand", F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("vol"), F.concat((F.col("p_partkey") % 13).cast("string"), F.lit("-x")).alias("issue"))
    return rows.select("p_partkey", F.row_number().over(sequences.Window.partitionBy("p_brand").orderBy(*sequences.issue_order(), "p_partkey")).cast("long").alias("nth"))


@query("SELECT n_nationkey, n_nationkey * 2 + 1 AS doubled FROM nation")
def user_function(spark: SparkSession, d: str) -> DataFrame:
    """A vectorised function in SQL text."""

    def twice(x: pd.Series) -> pd.Series:
        return x * 2 + 1

    registry.register_function(spark, "lexmill_twice", twice, "int")
    register_tables(spark, d, ["nation"])
    return run_sql(spark, "SELECT n_nationkey, lexmill_twice(n_nationkey) AS doubled FROM nation")


@query("SELECT n_regionkey, sum(n_nationkey * n_nationkey)::DOUBLE AS squares FROM nation GROUP BY n_regionkey")
def user_aggregate(spark: SparkSession, d: str) -> DataFrame:
    """An aggregate of one's own in SQL text."""
    registry.register_aggregate(spark, "lexmill_squares", lambda x: float((x * x).sum()), "double")
    register_tables(spark, d, ["nation"])
    return run_sql(spark, "SELECT n_regionkey, lexmill_squares(n_nationkey) AS squares FROM nation GROUP BY n_regionkey")


class _Letters:
    def eval(self, text: str):
        for i, c in enumerate(text or ""):
            yield i, c


@query("SELECT n_nationkey, (i - 1)::INT AS place, substr(n_name, i, 1) AS letter FROM (SELECT *, unnest(range(1, length(n_name) + 1))::INT AS i FROM nation)")
def user_table_function(spark: SparkSession, d: str) -> DataFrame:
    """A table function of one's own, joined laterally."""
    registry.register_table_function(spark, "lexmill_letters", _Letters, "place int, letter string")
    register_tables(spark, d, ["nation"])
    return run_sql(spark, "SELECT n_nationkey, place, letter FROM nation, LATERAL lexmill_letters(n_name)")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events per day and type, by a stream with a watermark that keeps all windows of one pass."""
    rows = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    found = gap_stream.counted(gap_stream.windowed_counts(rows, "ts", "event_type", "3650 days", "1 day"))
    return found.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query(
    """SELECT user_id, min(ts) AS start, count(*)::BIGINT AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM
    (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s"""
)
def session_windows(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of users, ended by half a day of silence."""
    rows = table(spark, d, "events").groupBy("user_id", F.session_window("ts", "12 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select("user_id", F.col("w.start").alias("start"), "n")
