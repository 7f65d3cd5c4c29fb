"""Queries over files that are written from the tables first: byte ranges, versions, logs of several shapes, stored sketches, large dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import dictionary, gaps, matching, sketches
from lexmill.plans.catalogue import query
from lexmill.session import shared_folder, spread, table
from lexmill.sources import byte_ranges, shapes, versions

_OPEN = "'<cb:div type=\"a\"><cb:mulu level=\"2\">' || doc_id || '</cb:mulu>' || CASE WHEN doc_id % 3 = 0 THEN '<cb:div><cb:mulu level=\"3\">x</cb:mulu></cb:div>' ELSE '' END"


@query(f"SELECT doc_id, octet_length(encode(c))::BIGINT AS n_bytes, sha256(c) AS sha FROM (SELECT doc_id, {_OPEN} || replace(text, '<', '&lt;') || '</cb:div>' AS c FROM documents)")
def elements_by_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Every document as a division of large files, found again by byte ranges that cut divisions and headings anywhere."""
    base = shared_folder(spark, "elements")
    docs = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.replace("text", F.lit("<"), F.lit("&lt;")).alias("t"))
    inner = F.when(F.col("doc_id") % 3 == 0, '<cb:div><cb:mulu level="3">x</cb:mulu></cb:div>').otherwise("")
    docs.select(F.concat(F.lit('<cb:div type="a"><cb:mulu level="2">'), "doc_id", F.lit("</cb:mulu>"), inner, "t", F.lit("</cb:div>"))).write.text(base)
    found = byte_ranges.read_elements(spark, base, split_bytes=100_003)
    again = byte_ranges.chunks_of(found.select("path", "byte_start", "byte_end"))  # the ranges as a catalogue, each read by itself
    text = F.col("chunk").cast("string")
    return again.select(F.regexp_extract(text, ">([0-9]+)<", 1).cast("long").alias("doc_id"), (F.col("byte_end") - F.col("byte_start")).alias("n_bytes"), F.sha2("chunk", 256).alias("sha"))


_HEADS = "list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^#{1,3}(\\s|$)') OR length(x) > 60)"


@query(
    f"""SELECT doc_id::VARCHAR AS name, length(text)::BIGINT AS n_chars, sha256(text) AS sha, array_to_string(list_transform({_HEADS}, lambda x: '- ' || left(x, 20)), chr(10)) AS toc,
      len({_HEADS})::BIGINT AS headings FROM documents"""
)
def article_pairs(spark: SparkSession, d: str) -> DataFrame:
    """One file per document with its contents as Markdown and JSON; a second set replaces the first at once and is read back."""
    base = shared_folder(spark, "articles")
    heads = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"^#{1,3}(\s|$)") | (F.length(x) > 60))
    rows = table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("name"), "text", F.array_join(F.transform(heads, lambda x: F.concat(F.lit("- "), F.left(x, F.lit(20)))), "\n").alias("toc"), F.to_json(heads).alias("toc_json")
    )
    versions.write_article_files(rows.filter("length(text) > 500"), base)
    versions.write_article_files(rows, base)
    found = versions.read_article_files(spark, base)
    return found.select("name", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("sha"), "toc", F.json_array_length("toc_json").cast("long").alias("headings"))


@query("SELECT event_id, event_type, user_id FROM events WHERE value > 10 AND event_type <> 'error'")
def log_replaced(spark: SparkSession, d: str) -> DataFrame:
    """A log that is cleaned twice: each time it is read, filtered and replaced by a new version of itself."""
    base, schema = shared_folder(spark, "log"), "event_id long, event_type string, user_id long, value double"
    versions.replace_log(table(spark, d, "events").select("event_id", "event_type", "user_id", "value"), base)
    versions.replace_log(versions.read_log_version(spark, base, schema).filter("value > 10"), base)
    versions.replace_log(versions.read_log_version(spark, base, schema).filter("event_type <> 'error'"), base)
    versions.vacuum(base)
    return versions.read_log_version(spark, base, schema).drop("value")


_K = "(props->>'k')::INT"


@query(
    f"""WITH e AS (SELECT event_id % 7 AS s, 'a' || user_id AS a, {_K} AS k FROM events),
    t AS (
      SELECT a, 'concepts' AS d, 't' || k AS term FROM e WHERE s IN (0, 1, 2) UNION ALL SELECT a, 'concepts', 'u' || k % 7 FROM e WHERE s = 0
      UNION ALL SELECT a, 'functions', 'f' || k % 5 FROM e WHERE s = 1 UNION ALL SELECT a, 'concepts', 'w' || k FROM e WHERE s = 6)
    SELECT 'term' AS kind, d AS dimension, term AS name, count(DISTINCT a)::BIGINT AS n FROM t GROUP BY d, term
    UNION ALL SELECT 'malformed', NULL, NULL, count(*) FROM e WHERE s = 3
    UNION ALL SELECT 'shape', NULL, CASE s WHEN 0 THEN 'OBJECT<article_path: STRING, gap_terms: ARRAY<STRING>>' WHEN 1 THEN 'OBJECT<article_path: STRING, concepts: ARRAY<STRING>, functions: ARRAY<STRING>>'
      WHEN 2 THEN 'OBJECT<article_path: STRING, concepts: STRING>' WHEN 4 THEN 'OBJECT<k: BIGINT>' ELSE 'OBJECT<article_path: STRING, keywords: ARRAY<STRING>>' END, count(*)
      FROM e WHERE s NOT IN (3, 5) GROUP BY s"""
)
def log_of_shapes(spark: SparkSession, d: str) -> DataFrame:
    """A log whose lines have two generations, lone texts, foreign objects, broken and blank lines: terms, shapes, and how many lines are malformed."""
    base = shared_folder(spark, "shapes")
    k, s = F.get_json_object("props", "$.k").cast("int"), F.col("event_id") % 7
    path = F.concat(F.lit('{"article_path":"a'), "user_id", F.lit('"'))
    line = (
        F.when(s == 0, F.concat(path, F.lit(',"gap_terms":["t'), k, F.lit('","u'), k % 7, F.lit('"]}'))).when(s == 1, F.concat(path, F.lit(',"concepts":["t'), k, F.lit('"],"functions":["f'), k % 5, F.lit('"]}')))
        .when(s == 2, F.concat(path, F.lit(',"concepts":"t'), k, F.lit('"}'))).when(s == 3, F.concat(path, F.lit(',"gap_ter'))).when(s == 4, F.col("props")).when(s == 5, F.lit("  "))
        .otherwise(F.concat(path, F.lit(',"keywords":["w'), k, F.lit('"]}')))
    )
    table(spark, d, "events").select(line.alias("value")).write.text(base)
    lines = shapes.read_variant_lines(spark, base)
    terms = gaps.gap_frequency(gaps.gap_terms(shapes.log_rows(lines)), 1)
    none = F.lit(None).cast("string")
    broken = lines.agg(F.count_if("malformed").alias("n")).select(F.lit("malformed").alias("kind"), none.alias("dimension"), none.alias("name"), "n")
    seen = lines.filter("not malformed").groupBy(shapes.shape(F.col("v")).alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("shape").alias("kind"), none.alias("dimension"), "name", "n")
    return terms.select(F.lit("term").alias("kind"), "dimension", F.col("term").alias("name"), "n").unionByName(broken).unionByName(seen)


_RANGES = [("first day", 1, 1), ("week one", 1, 7), ("week two", 8, 14), ("nine to twenty", 9, 20), ("all", 1, 31)]
_IN = "FROM (VALUES " + ", ".join(map(str, _RANGES)) + ") r(name, lo, hi) JOIN events ON ts::DATE BETWEEN DATE '2023-12-31' + lo AND DATE '2023-12-31' + hi"


@query(
    f"""SELECT name, count(*)::BIGINT AS n, count(DISTINCT ts::DATE)::BIGINT AS days, count(DISTINCT event_id)::BIGINT AS distinct_exact, quantile_disc(value, 0.5) AS median_exact,
      TRUE AS distinct_within, TRUE AS median_within, TRUE AS error_below_a_tenth {_IN} GROUP BY name"""
)
def sketches_over_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Distinct counts and medians of ranges of days from stored sketches, with exact values beside them and whether the bounds hold those."""
    base = shared_folder(spark, "sketches")
    events = table(spark, d, "events").select("event_id", "value", F.to_date("ts").alias("date"))
    sketches.daily_sketches(events, F.col("date"), "event_id", "value").write.parquet(base)
    day = lambda c: F.date_add(F.lit("2023-12-31").cast("date"), F.col(c))
    ranges = spark.createDataFrame(_RANGES, "name string, lo int, hi int").select("name", day("lo").alias("first"), day("hi").alias("last"))
    found = sketches.merged(spark.read.parquet(base), ranges)
    rows = events.join(ranges.select("name", F.explode(F.sequence("first", "last")).alias("date")), "date")
    exact = rows.groupBy("name").agg(F.count_distinct("event_id").alias("distinct_exact"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY value)").alias("median_exact"))
    off = F.abs(F.col("distinct_estimate") / F.col("distinct_exact") - 1)
    return found.join(exact, "name").select(
        "name", "n", "days", "distinct_exact", "median_exact", F.col("distinct_exact").between(F.col("distinct_low"), F.col("distinct_high")).alias("distinct_within"),
        F.col("median_exact").between(F.col("low"), F.col("high")).alias("median_within"), (off < 0.1).alias("error_below_a_tenth"),
    )


@query(
    r"""WITH a AS (SELECT alias, min(doc_id) AS ord FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[a-z]{7,9} [a-z]{2,6}'))) AS alias FROM documents WHERE doc_id % 5 = 0) GROUP BY alias),
    m AS (SELECT page_id, alias, ord, row_number() OVER (PARTITION BY page_id ORDER BY length(alias) DESC, ord, alias) AS rn FROM pages JOIN a ON contains(html, alias))
    SELECT page_id, length(alias)::INT AS n, count(*)::BIGINT AS one FROM m WHERE rn = 1 GROUP BY ALL"""
)
def aliases_by_grams(spark: SparkSession, d: str) -> DataFrame:
    """The longest of many thousands of names, pairs of words of some documents, that each web page holds."""
    found = F.array_distinct(F.regexp_extract_all("text", F.lit("[a-z]{7,9} [a-z]{2,6}"), F.lit(0)))
    names = table(spark, d, "documents").filter("doc_id % 5 = 0").select("doc_id", F.explode(found).alias("alias")).groupBy("alias").agg(F.min("doc_id").alias("ord"))
    names = names.withColumn("canonical", F.col("alias"))
    met = dictionary.longest_contained(spread(table(spark, d, "pages").select("page_id", "html")), "page_id", "html", names)
    return met.groupBy("page_id", F.length("alias").alias("n")).agg(F.count(F.lit(1)).alias("one"))


@query(
    """WITH t AS (SELECT DISTINCT left(p_name, 5) AS term FROM part WHERE length(p_name) >= 5 UNION SELECT DISTINCT 'Customer#' || right(c_name, 4) FROM customer UNION SELECT DISTINCT substr(c_name, 1, 9) || lpad((c_custkey % 1000)::VARCHAR, 9, '0') FROM customer)
    SELECT c_custkey, len(regexp_extract_all(c_name, (SELECT string_agg(regexp_escape(term), '|' ORDER BY length(term) DESC, term) FROM t)))::BIGINT AS hits FROM customer"""
)
def dictionary_of_names(spark: SparkSession, d: str) -> DataFrame:
    """Greedy matches of a dictionary that grows with the tables, in the names of customers."""
    part, customer = table(spark, d, "part"), table(spark, d, "customer")
    terms = (
        part.filter("length(p_name) >= 5").select(F.left("p_name", F.lit(5)).alias("t")).union(customer.select(F.concat(F.lit("Customer#"), F.right("c_name", F.lit(4)))))
        .union(customer.select(F.concat(F.substring("c_name", 1, 9), F.lpad((F.col("c_custkey") % 1000).cast("string"), 9, "0")))).distinct()
    )
    listed = [r.t for r in terms.collect()]  # a dictionary is the caller's, and sent to every task
    found = matching.hits(customer.select("c_custkey", F.col("c_name").alias("line")), listed)
    n = found.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("hits"))
    return customer.select("c_custkey").join(n, "c_custkey", "left").select("c_custkey", F.coalesce("hits", F.lit(0)).alias("hits"))
