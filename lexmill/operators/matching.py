"""Dictionary matching: greedy, leftmost-longest, without overlaps, and ranking by heading hits."""

from __future__ import annotations

import os
import re
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import CJK_WIDE, is_heading_line, snippet
from lexmill.operators.dictionary import trie_counts, trie_hits

#: Up to so many terms the pattern is matched in the JVM, which tries branches one by one; beyond, in Arrow batches.
MOST_ALTERNATIVES = 200
HEADING_WEIGHT = 3


def match_keys(vocabulary: DataFrame, chars: str | None = CJK_WIDE, least: int = 2) -> DataFrame:
    """surface, standard, domain, subdomain, note of every term and variant; of conflicting surfaces the first entry's.

    ``vocabulary`` has seq (order of entries), standard, variants and optionally the rest. Surfaces
    shorter than ``least`` characters of the class go; with ``chars`` null all characters count.
    """
    rest = [c for c in ("domain", "subdomain", "note") if c in vocabulary.columns]
    surfaces = F.concat(F.array("standard"), F.coalesce("variants", F.array().cast("array<string>")))
    each = vocabulary.select("seq", "standard", *rest, F.posexplode(surfaces).alias("nth", "surface"))
    size = F.length("surface") if chars is None else F.length(F.regexp_replace("surface", f"[^{chars}]", ""))
    first = Window.partitionBy("surface").orderBy("seq", "nth")
    return each.filter(size >= least).withColumn("rn", F.row_number().over(first)).filter("rn = 1").drop("rn", "nth", "seq")


def alternation(terms: list[str]) -> str:
    """A regular expression, for Java and RE2, that takes the longest term at each place."""
    return "|".join(re.escape(t) for t in sorted(set(terms), key=lambda t: (-len(t), t)))


def trie(terms: list[str]) -> str:
    """A regular expression, for Java and Python, with the matches of alternation(): common beginnings are read once, longer endings first."""

    def tails(group: list[str]) -> str:
        begin = os.path.commonprefix([group[0], group[-1]])
        longer = [t[len(begin) :] for t in group if len(t) > len(begin)]
        branches = "|".join(tails(list(g)) for _, g in groupby(longer, key=lambda t: t[0]))
        ends = len(longer) < len(group)
        return re.escape(begin) + (f"(?:{branches}){'?' if ends else ''}" if longer else "")

    every = sorted({t for t in terms if t})
    return "(?:" + "|".join(tails(list(g)) for _, g in groupby(every, key=lambda t: t[0])) + ")" if every else "(?!)"


def hits(lines: DataFrame, terms: list[str], text: str = "line", chars: str | None = None) -> DataFrame:
    """``lines`` exploded to one row per hit: ``surface`` and ``ordinal``, its number in the text from 0.

    At each place the longest term wins and matching goes on behind it. With ``chars``
    only terms wholly of the class match. Few terms stay in the JVM as one pattern; many run in Arrow
    batches through a trie in arrays, with the same rows. ``terms`` are the caller's dictionary.
    """
    terms = [t for t in terms if _only(t, chars)]
    if len(terms) > MOST_ALTERNATIVES:
        return trie_hits(lines, terms, text).drop("position")
    found = F.regexp_extract_all(F.col(text), F.lit(trie(terms)), F.lit(0))
    return lines.select(*(c for c in lines.columns if c != text), F.posexplode(found).alias("ordinal", "surface"))


def hit_counts(lines: DataFrame, terms: list[str], text: str = "line", chars: str | None = None) -> DataFrame:
    """hits() counted where they are found: a line's columns, ``surface`` and ``n``, whose sums over equal rows count."""
    terms = [t for t in terms if _only(t, chars)]
    if len(terms) > MOST_ALTERNATIVES:
        return trie_counts(lines, terms, text)
    found = hits(lines, terms, text)
    return found.groupBy(*(c for c in found.columns if c != "ordinal")).agg(F.count(F.lit(1)).alias("n"))


def _only(term: str, chars: str | None) -> bool:
    return bool(term) and (chars is None or bool(re.match("^[" + chars.replace("\\x{20000}-\\x{2a6df}", "\U00020000-\U0002a6df") + "]+$", term)))


def positions(lines: DataFrame, terms: list[str], keys: list[str], text: str = "line", chars: str | None = None) -> DataFrame:
    """hits() with ``position``, 0-based in the text; ``keys`` name a line, whose hits are added up in one task."""
    terms = [t for t in terms if _only(t, chars)]
    if len(terms) > MOST_ALTERNATIVES:
        return trie_hits(lines, terms, text)
    pattern = F.lit(f"(?s)(.*?)({trie(terms)})")
    both = F.arrays_zip(F.regexp_extract_all(F.col(text), pattern, F.lit(1)).alias("b"), F.regexp_extract_all(F.col(text), pattern, F.lit(2)).alias("s"))
    each = lines.select(*(c for c in lines.columns if c != text), F.posexplode(both).alias("ordinal", "h"))
    upto = Window.partitionBy(*keys).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    at = F.sum(F.length("h.b") + F.length("h.s")).over(upto) - F.length("h.s")
    return each.withColumn("position", at.cast("int")).withColumn("surface", F.col("h.s")).drop("h")


def lines_of(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, line_no, line and is_heading of every line."""
    each = docs.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n", -1)).alias("line_no", "line"))
    return each.withColumn("is_heading", is_heading_line(F.col("line")))


def score(occurrences: Column, heading_hits: Column, weight: int = HEADING_WEIGHT) -> Column:
    """Occurrences, and each hit in a heading ``weight`` times more."""
    return occurrences + weight * heading_hits


def candidates(found: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document and standard term: occurrences, heading_hits, score, first_hit (line and ordinal), surfaces, is_standard, nth.

    ``found``: hits() in lines_of(); ``keys``: match_keys(). nth ranks by score, ties by
    first occurrence. Surfaces are counted before their join with the dictionary.
    """
    per = found.groupBy(key, "surface").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_heading").cast("int")).alias("h"), F.min(F.struct("line_no", "ordinal")).alias("p")
    )
    rest = [c for c in ("domain", "subdomain", "note") if c in keys.columns]
    out = per.join(keys, "surface").groupBy(key, "standard").agg(
        F.sum("n").alias("occurrences"), F.sum("h").alias("heading_hits"), F.min("p").alias("first_hit"),
        F.array_join(F.sort_array(F.collect_set("surface")), "、").alias("surfaces"),
        F.max(F.col("surface") == F.col("standard")).alias("is_standard"), *(F.min(c).alias(c) for c in rest),
    )
    out = out.withColumn("score", score(F.col("occurrences"), F.col("heading_hits")))
    order = Window.partitionBy(key).orderBy(F.desc("score"), "first_hit")
    return out.withColumn("nth", F.row_number().over(order))


def with_context(found: DataFrame, docs: DataFrame, key: str = "doc_id", window: int = 40) -> DataFrame:
    """Candidates with ``context``: the text around the first of the term's surfaces in it."""
    texts = docs.select(F.col(key).alias("__k"), F.col("text").alias("__t"))
    met = found.join(texts, found[key].eqNullSafe(texts["__k"]))
    at = F.array_min(F.filter(F.transform(F.split("surfaces", "、"), lambda s: F.position(s, F.col("__t"))), lambda p: p > 0)) - 1
    return met.withColumn("context", snippet(F.col("__t"), at, window)).drop("__k", "__t")


def summary(found: DataFrame, key: str = "doc_id", often: int = 10) -> DataFrame:
    """Per document: concepts, hits, the share of concepts that occur once as ``single/total``, and frequent ones."""
    frequent = F.collect_list(F.when(F.col("occurrences") >= often, F.struct("nth", "standard")))
    return found.groupBy(key).agg(
        F.count(F.lit(1)).alias("concepts"), F.sum("occurrences").alias("hits"),
        F.concat_ws("/", F.count_if(F.col("occurrences") == 1).cast("string"), F.count(F.lit(1)).cast("string")).alias("single"),
        F.array_join(F.transform(F.sort_array(frequent), lambda x: x["standard"]), "、").alias("frequent"),
    )


def histogram(found: DataFrame, *by: str) -> DataFrame:
    """Rows per group, most common first."""
    return found.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *by)


def taxonomy(vocabulary: DataFrame) -> DataFrame:
    """Subdomains of each domain, both given, sorted."""
    pairs = vocabulary.filter("domain <> '' and subdomain <> ''").select("domain", "subdomain").distinct()
    return pairs.groupBy("domain").agg(F.array_join(F.sort_array(F.collect_set("subdomain")), "、").alias("subdomains"))


def prompt(template: Column, parts: dict[str, Column]) -> Column:
    """A template with ``{name}`` replaced by each part."""
    for name, value in parts.items():
        template = F.replace(template, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return template
