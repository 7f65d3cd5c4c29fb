"""Reports on periodicals: tables of issues with the state of their dates, and a calendar of volumes and years.

What a publication or a section holds is gathered in one row, so reports are of report size; all counts are made before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATES = ("dated", "matched", "unmatched")


def _lines(order: list[str], line: str = "line") -> Column:
    """The lines of a group in order, as one text."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, line))), lambda x: x[line]), "\n")


def _row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(c.cast("string"), F.lit("")) for c in cells)), F.lit(" |"))


def issue_entries(references: DataFrame, kinds: DataFrame) -> DataFrame:
    """pub, kind, vol, issue, date, state, refs, nth of each distinct issue of references (pub, vol, issue, date, state).

    ``kinds`` (pub, kind) has all publications there are; those without any reference come back with nulls. Issues are in order of
    volume, missing ones last, and of the number that the issue begins with, ones without last. Of equal issues the least date counts.
    """
    once = references.groupBy("pub", "vol", "issue").agg(F.min("date").alias("date"), F.min("state").alias("state"))
    refs = references.groupBy("pub").agg(F.count(F.lit(1)).alias("refs"))
    order = [F.col("vol").asc_nulls_last(), F.split("issue", "-")[0].try_cast("int").asc_nulls_last(), "issue"]
    nth = once.withColumn("nth", F.row_number().over(Window.partitionBy("pub").orderBy(*order)))
    return kinds.join(nth, "pub", "left").join(refs, "pub", "left")


def issue_report(entries: DataFrame, title: str) -> DataFrame:
    """nth, part, name, markdown of a report on issue_entries(): totals, a line for each kind, each publication (most references first), and those without references."""
    had = entries.filter("state is not null")
    states = [F.count_if(F.col("state") == s).alias(s) for s in STATES]
    of_pub = had.groupBy("pub", "kind", "refs").agg(F.count(F.lit(1)).alias("n"), *states)
    counts = [F.col(c) for c in ("n", *STATES)]
    totals = of_pub.agg(F.count(F.lit(1)).alias("pubs"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *STATES)))
    head = "| publications | issues | dated | matched | unmatched |\n|---|---|---|---|---|\n"
    first = totals.select(F.lit(1).alias("nth"), F.lit("totals").alias("part"), F.lit(title).alias("name"), F.concat(F.lit(f"# {title}\n\n{head}"), _row(F.col("pubs"), *counts)).alias("markdown"))
    kinds = of_pub.groupBy("kind").agg(F.count(F.lit(1)).alias("pubs"), *(F.sum(c).alias(c) for c in ("n", *STATES))).withColumn("line", _row(F.col("kind"), F.col("pubs"), *counts))
    second = kinds.groupBy().agg(_lines(["kind"]).alias("rows")).select(
        F.lit(2).alias("nth"), F.lit("kinds").alias("part"), F.lit("").alias("name"), F.concat(F.lit("| kind " + head.replace("|\n|---", "|\n|---|---", 1)), "rows").alias("markdown")
    )
    label = F.when(F.col("vol").isNull(), F.concat(F.lit("第"), "issue", F.lit("期"))).otherwise(F.concat(F.col("vol").cast("string"), F.lit("卷"), "issue", F.lit("期")))
    shown = F.when(F.coalesce("date", F.lit("")) != "", F.regexp_replace("date", r"^(\d{4})-(\d{2})-(\d{2})$", "$1.$2.$3")).otherwise(F.col("state"))
    listed = had.withColumn("line", _row(F.col("nth"), label, shown, F.col("state"))).groupBy("pub").agg(_lines(["nth"]).alias("rows"))
    ranked = of_pub.join(listed, "pub").withColumn("rank", F.row_number().over(Window.orderBy(F.desc("refs"), "pub")))  # publications are as many as a report has sections
    state = F.concat_ws("\n", *(F.concat(F.lit(f"> | {s} | "), F.col(s).cast("string"), F.lit(" |")) for s in STATES))
    body = F.concat(F.lit("## "), "pub", F.lit("（"), F.col("refs").cast("string"), F.lit("）\n\n> "), F.coalesce("kind", F.lit("?")), F.lit("\n>\n"), state, F.lit("\n\n| # | issue | date | state |\n|---|---|---|---|\n"), "rows")
    third = ranked.select((F.col("rank") + 2).alias("nth"), F.lit("publication").alias("part"), F.col("pub").alias("name"), body.alias("markdown"))
    none = entries.filter("state is null").withColumn("line", F.concat(F.lit("- "), "pub")).groupBy().agg(_lines(["pub"]).alias("rows"))
    last = none.filter("rows <> ''").select(F.lit(1 << 30).alias("nth"), F.lit("missing").alias("part"), F.lit("").alias("name"), F.concat(F.lit("## without references\n\n"), "rows").alias("markdown"))
    return first.unionByName(second).unionByName(third).unionByName(last)


def volume_table(volumes: Column, columns: int = 3) -> Column:
    """A Markdown table of a map from volume to year, ``columns`` pairs to a line, in order of volume."""
    pairs = F.array_sort(F.transform(F.map_entries(volumes), lambda e: F.struct(e["key"].cast("int").alias("k"), e["value"].alias("v"))))
    starts = F.sequence(F.lit(1), F.size(pairs), F.lit(columns))
    line = lambda i: F.concat(F.lit("| "), F.array_join(F.flatten(F.transform(F.slice(pairs, i, columns), lambda p: F.array(p["k"].cast("string"), p["v"].cast("string")))), " | "), F.lit(" |"))
    head = "|" + " volume | year |" * columns + "\n|" + "---|---|" * columns + "\n"
    return F.when(F.size(volumes) > 0, F.concat(F.lit(head), F.array_join(F.transform(starts, line), "\n"))).otherwise("")


def calendar_report(publications: DataFrame, heuristics: DataFrame, categories: list[str], title: str, default: str, low: str) -> DataFrame:
    """nth, section, markdown: an overview, one section for each of the ``categories``, the rules of thumb, and what is uncertain.

    ``publications``: name, category, aliases (array), ref_count, volume_to_year (map), confidence; those of an unknown or null category
    are of ``default``. ``heuristics``: name, rule. Publications stand by references, most first, then by name. Sections without any
    publication are there and empty. Whose confidence is ``low`` is listed at the end.
    """
    spark = publications.sparkSession
    known = F.col("category").isin(*categories)
    pubs = publications.withColumn("category", F.when(known, F.col("category")).otherwise(F.lit(default)))
    info = F.concat_ws("\n", _row(F.lit("references"), F.col("ref_count")), F.when(F.size("aliases") > 0, _row(F.lit("aliases"), F.array_join("aliases", " / "))), _row(F.lit("confidence"), F.coalesce("confidence", F.lit("?"))))
    volumes = volume_table(F.col("volume_to_year"))
    block = F.concat(F.lit("### "), "name", F.lit("\n\n| item | value |\n|---|---|\n"), info, F.when(volumes != "", F.concat(F.lit("\n\n"), volumes)).otherwise(""))
    by = ["less", "name"]
    blocks = pubs.withColumn("less", -F.col("ref_count")).withColumn("line", F.concat(block, F.lit("\n")))
    made = blocks.groupBy(F.col("category").alias("section")).agg(_lines(by).alias("body"), F.count(F.lit(1)).alias("n"))
    order = spark.createDataFrame([(i, c) for i, c in enumerate(categories, 2)], "nth int, section string")
    middle = order.join(F.broadcast(made), "section", "left").select("nth", "section", F.concat(F.lit("## "), "section", F.lit("\n\n"), F.coalesce("body", F.lit(""))).alias("markdown"))
    lines = order.join(F.broadcast(made), "section", "left").withColumn("line", _row(F.col("section"), F.coalesce("n", F.lit(0)))).groupBy().agg(_lines(["nth"]).alias("rows"))
    total = pubs.agg(F.count(F.lit(1)).alias("all"))
    first = lines.withColumn("k", F.lit(1)).join(total.withColumn("k", F.lit(1)), "k").select(
        F.lit(1).alias("nth"), F.lit("overview").alias("section"), F.concat(F.lit(f"# {title}\n\n"), F.col("all").cast("string"), F.lit("\n\n| category | publications |\n|---|---|\n"), "rows").alias("markdown")
    )
    n = len(categories) + 2
    rules = heuristics.withColumn("line", F.concat(F.lit("- **"), "name", F.lit("**："), "rule")).groupBy().agg(_lines(["name"]).alias("rows"))
    doubt = pubs.filter(F.col("confidence") == low).withColumn("line", F.concat(F.lit("- "), "name", F.lit("（"), "category", F.lit("）"))).groupBy().agg(_lines(["name"]).alias("rows"))
    tail = lambda rows, nth, name: rows.select(F.lit(nth).alias("nth"), F.lit(name).alias("section"), F.concat(F.lit(f"## {name}\n\n"), "rows").alias("markdown"))
    return first.unionByName(middle).unionByName(tail(rules, n, "rules of thumb")).unionByName(tail(doubt, n + 1, "uncertain"))


def in_batch(catalogue: DataFrame, articles: DataFrame, first: int | None = None, last: int | None = None, key: str = "path") -> DataFrame:
    """Entries of a catalogue whose seq is in a range, open where null, with the columns of their article and ``missing``: whether there is none."""
    chosen = catalogue.filter(F.col("seq").between(first if first is not None else -(1 << 62), last if last is not None else 1 << 62))
    return chosen.join(articles.withColumn("__there", F.lit(True)), key, "left").withColumn("missing", F.col("__there").isNull()).drop("__there")


def review_text(report: DataFrame, additions: DataFrame, title: str = "gaps") -> DataFrame:
    """markdown: one row, the text of a review: false positives and gaps of each dimension, then what is to be added, most frequent first."""
    counts = report.withColumn("line", F.format_string("- %s: %d false, %d gaps", "dimension", F.col("false_positives").cast("long"), F.col("gaps").cast("long"))).groupBy().agg(_lines(["dimension"]).alias("a"))
    told = F.concat(F.format_string("- %s %s ×%d", "dimension", "term", F.col("n").cast("long")), F.coalesce(F.concat(F.lit(" → "), "domain"), F.lit("")))
    more = additions.withColumn("line", told).withColumn("less", -F.col("n")).groupBy().agg(_lines(["less", "dimension", "term"]).alias("b"))
    return counts.withColumn("k", F.lit(1)).join(more.withColumn("k", F.lit(1)), "k").select(F.concat(F.lit(f"# {title}\n\n"), "a", F.lit("\n\n"), "b").alias("markdown"))
