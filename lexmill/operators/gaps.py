"""Review of a log of terms that annotators used but the vocabulary lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import normal_label, simplified
from lexmill.operators.lookups import vote

DIMENSIONS = ("concepts", "domains", "functions", "bearings")


def clean_path(path: Column, prefix: str = "") -> Column:
    """A path without ../ steps and without a common prefix."""
    out = F.regexp_replace(path, r"^(\.\./)+", "")
    return F.regexp_replace(out, f"^\\Q{prefix}\\E", "") if prefix else out


def gap_terms(log: DataFrame, prefix: str = "", test_marker: str = "/tmp/") -> DataFrame:
    """article, dimension, term, raw of every logged gap, in both generations of the log.

    Old rows list ``gap_terms``: concepts in standard_term() and simplified form. New rows list
    dimensions: simplified only. Test rows are left out. Columns that a log lacks count as null.
    """
    have = set(log.columns)
    lists = [(d, d, simplified) for d in DIMENSIONS if d in have] + ([("gap_terms", "concepts", normal_label)] if "gap_terms" in have else [])
    rows = log.filter(~F.col("article_path").contains(test_marker)).withColumn("article", clean_path(F.col("article_path"), prefix))
    parts = [rows.select("article", F.lit(d).alias("dimension"), F.explode(c).alias("raw")).withColumn("term", f(F.col("raw"))) for c, d, f in lists]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("article", "dimension", "term", "raw")


def unknown_terms(terms: DataFrame, known: DataFrame) -> DataFrame:
    """Terms not in ``known`` (dimension, label), labels compared in normal form."""
    k = known.select("dimension", normal_label(F.col("label")).alias("term")).distinct()
    return terms.join(k, ["dimension", "term"], "left_anti")


def gap_frequency(terms: DataFrame, least: int = 2) -> DataFrame:
    """dimension, term, n: distinct articles, at least ``least``."""
    return terms.select("article", "dimension", "term").distinct().groupBy("dimension", "term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def inferred_domains(terms: DataFrame, vocabulary: DataFrame, default: str) -> DataFrame:
    """term, domain, subdomain of each gap term: what known terms of the same articles most often have, voted on each by itself; else ``default`` and ''."""
    entries = terms.select("article", F.col("term").alias("other"))
    subdomain = F.col("subdomain") if "subdomain" in vocabulary.columns else F.lit(None).cast("string")
    known = vocabulary.select(normal_label(F.col("standard")).alias("other"), F.nullif("domain", F.lit("")).alias("domain"), F.nullif(subdomain, F.lit("")).alias("subdomain"))
    met = terms.select("article", "term").distinct().join(entries.join(known, "other"), "article", "left").filter("other is null or other <> term")
    voted = lambda column: vote(met, "term", column, "article").drop("n")
    each = terms.select("term").distinct().join(voted("domain"), "term", "left").join(voted("subdomain"), "term", "left")
    return each.select("term", F.coalesce("domain", F.lit(default)).alias("domain"), F.coalesce("subdomain", F.lit("")).alias("subdomain"))


def due_for_review(log: DataFrame, every: int = 5) -> DataFrame:
    """articles (distinct) and due: whether a review falls due at this count."""
    return log.agg(F.count_distinct("article_path").alias("articles")).withColumn("due", (F.col("articles") > 0) & (F.col("articles") % every == 0))
