"""Reports, and the review of logged gaps: what is counted, added, cleaned and told."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import normal_label
from lexmill.operators.gaps import DIMENSIONS, clean_path, gap_frequency, gap_terms, inferred_domains, unknown_terms


def candidate_context(found: DataFrame, key: str = "doc_id", most: int = 30) -> DataFrame:
    """key, context: the best candidates (candidates() rows) of each document as a Markdown table for a prompt."""
    domain = F.col("domain") if "domain" in found.columns else F.lit(None).cast("string")
    place = F.concat_ws("/", domain, F.col("subdomain")) if "subdomain" in found.columns else domain
    cells = [F.col("standard"), F.col("occurrences").cast("string"), F.coalesce(F.nullif(place, F.lit("")), F.lit("—")), F.when(F.col("heading_hits") > 0, "✓").otherwise("")]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    listed = F.sort_array(F.collect_list(F.when(F.col("nth") <= most, F.struct("nth", line.alias("line")))))
    head = "| 術語 | 頻次 | 知識域/子域 | 標題命中 |\n|------|:--:|------|:--:|"
    return found.groupBy(key).agg(F.concat_ws("\n", F.lit(head), F.transform(listed, lambda x: x["line"])).alias("context"))


def candidate_json(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, json: match statistics, domains and candidates of each document as one JSON text."""
    fields = [c for c in ("standard", "domain", "surfaces", "occurrences", "heading_hits", "score") if c in found.columns]
    stats = F.struct(F.sum("occurrences").alias("raw_hits"), F.count(F.lit(1)).alias("after_dedup"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("nth", *fields))), lambda x: x.dropFields("nth"))
    return found.groupBy(key).agg(F.to_json(F.struct(stats.alias("match_stats"), listed.alias("candidates"))).alias("json"))


def gap_review(log: DataFrame, known: DataFrame, vocabulary: DataFrame, least: int = 2, prefix: str = "", default: str = "教理") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(report, additions, cleaned) of a gap log.

    ``known`` (dimension, label) has all labels there are; terms in it are false positives. report: dimension, false_positives, gaps
    (distinct). additions: dimension, term, n of gaps in ``least`` articles or more, for concepts with the domain and
    subdomain that known terms of the same articles mostly have. cleaned: the log without false positives; rows left without any
    gap go, test rows stay.
    """
    terms = gap_terms(log, prefix)
    real = unknown_terms(terms, known)
    report = terms.groupBy("dimension").agg(F.count(F.lit(1)).alias("n")).join(
        real.groupBy("dimension").agg(F.count(F.lit(1)).alias("left"), F.count_distinct("term").alias("gaps")), "dimension", "left"
    )
    report = report.select("dimension", (F.col("n") - F.coalesce("left", F.lit(0))).alias("false_positives"), F.coalesce("gaps", F.lit(0)).alias("gaps"))
    domains = inferred_domains(terms.filter("dimension = 'concepts'"), vocabulary, default)
    counted = gap_frequency(real, least)
    placed = lambda column, other: F.when(F.col("dimension") == "concepts", F.coalesce(column, F.lit(other))).alias(column)
    additions = counted.join(domains, "term", "left").select("dimension", "term", "n", placed("domain", default), placed("subdomain", ""))
    return report, additions, cleaned_log(log, known, prefix)


def cleaned_log(log: DataFrame, known: DataFrame, prefix: str = "", test_marker: str = "/tmp/") -> DataFrame:
    """The log without known labels; rows left without any go, test rows stay as they are, equal rows stay as many.

    Labels are taken out of their lists, meet the known ones by an anti join, and what is left is put back in order.
    """
    lists = [(d, d) for d in DIMENSIONS if d in log.columns] + ([("gap_terms", "concepts")] if "gap_terms" in log.columns else [])
    none, test = F.array().cast("array<string>"), F.coalesce(F.col("article_path").contains(test_marker), F.lit(False))
    once = log.groupBy(*log.columns).agg(F.count(F.lit(1)).alias("__n")).withColumn("__h", F.sha2(F.to_json(F.struct(*log.columns)), 256))
    placed = lambda c, d: F.transform(F.coalesce(c, none), lambda x, i: F.struct(F.lit(c).alias("c"), F.lit(d).alias("dimension"), i.alias("i"), x.alias("raw")))
    each = once.filter(~test).select("__h", F.explode(F.concat(*(placed(c, d) for c, d in lists))).alias("x")).select("__h", "x.*").withColumn("label", normal_label(F.col("raw")))
    of_list = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col("c") == c, F.struct("i", "raw")))), lambda x: x["raw"])
    labels = known.select("dimension", normal_label(F.col("label")).alias("label")).distinct()
    left = each.join(labels, ["dimension", "label"], "left_anti").groupBy("__h").agg(*(of_list(c).alias(f"__{c}") for c, _ in lists))
    met = once.join(left.withColumn("__some", F.lit(True)), "__h", "left").filter(test | F.col("__some"))
    path = F.when(test, F.col("article_path")).otherwise(clean_path(F.col("article_path"), prefix))
    kept = {c: F.when(test, F.col(c)).otherwise(F.coalesce(f"__{c}", none)).alias(c) for c, _ in lists}
    rows = met.select(*(kept.get(c, path.alias(c) if c == "article_path" else F.col(c)) for c in log.columns), F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))).alias("__i"))
    return rows.drop("__i")


def sectioned(rows: DataFrame, section: str, columns: list[str], order: list[str], level: int = 2) -> DataFrame:
    """section, n, markdown: a heading with the number of rows, and their table; sections must be of report size."""
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), F.lit(" |"))
    nth = F.row_number().over(Window.partitionBy(section).orderBy(*order))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("__n", "__line"))), lambda x: x["__line"])
    made = rows.withColumn("__n", nth).withColumn("__line", cells).groupBy(section).agg(F.count(F.lit(1)).alias("n"), F.concat_ws("\n", listed).alias("lines"))
    head = F.concat(F.lit("#" * level + " "), F.col(section), F.lit("（"), F.col("n").cast("string"), F.lit("）\n\n| " + " | ".join(columns) + " |\n|" + "---|" * len(columns) + "\n"))
    return made.select(section, "n", F.concat(head, "lines").alias("markdown"))


def document_of(sections: DataFrame, title: str, order: list[str], total: str = "n") -> DataFrame:
    """One row, ``markdown``: a title, the total, and sections in order; a report fits one row."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct(*order, "markdown"))), lambda x: x["markdown"])
    return sections.agg(F.concat_ws("\n\n", F.lit(f"# {title}"), F.concat(F.lit("共 "), F.sum(total).cast("string")), listed).alias("markdown"))


def catalogue_markdown(entries: DataFrame, group: str, section: str, name: str, order: str) -> DataFrame:
    """group, markdown: a nested list of sections and numbered names, then a table of counts with a total."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct(order, name))), lambda x: F.concat(F.lit("   - "), x[order].cast("string"), F.lit(". "), x[name]))
    each = entries.groupBy(group, section).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"), F.concat_ws("\n", listed).alias("names"))
    parts = F.sort_array(F.collect_list(F.struct("first", section, "n", "names")))
    lines = F.transform(parts, lambda x: F.concat(F.lit("- "), x[section], F.lit("\n"), x["names"]))
    counts = F.transform(parts, lambda x: F.concat(F.lit("| "), x[section], F.lit(" | "), x["n"].cast("string"), F.lit(" |")))
    return each.groupBy(group).agg(
        F.concat(F.concat_ws("\n", lines), F.lit("\n\n| 類 | 篇數 |\n|---|---|\n"), F.concat_ws("\n", counts), F.lit("\n| 合計 | "), F.sum("n").cast("string"), F.lit(" |")).alias("markdown")
    )
