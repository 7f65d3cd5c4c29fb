"""Front matter, annotations and reports as text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import yaml_quoted


def front_matter_block(fields: dict[str, Column], quoted: tuple[str, ...] = ()) -> Column:
    """A --- block of ``key: value`` lines; null and empty values are left out."""
    lines = [
        F.when(F.coalesce(v.cast("string"), F.lit("")) != "", F.concat(F.lit(f"{k}: "), yaml_quoted(v.cast("string")) if k in quoted else v.cast("string")))
        for k, v in fields.items()
    ]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n"))


def with_front_matter(text: Column, block: Column) -> Column:
    """``block`` before a text that has none yet; others as they are."""
    return F.when(text.startswith("---"), text).otherwise(F.concat(block, F.lit("\n"), text))


def migrated(entries: DataFrame, files: DataFrame) -> DataFrame:
    """One row per entry (old_path, new_path, block) of a front-matter migration over files (path, text): its action and the new text.

    ``missing`` where no file has the old path, ``kept`` where the text has front matter, else ``written`` or, to
    another path, ``renamed``; only the last two have a text. A dry run reads the actions, a real one writes the texts.
    """
    there = files.select(F.col("path").alias("old_path"), F.coalesce("text", F.lit("")).alias("__text"))
    moves = F.when(F.col("old_path") == F.col("new_path"), "written").otherwise("renamed")
    action = F.when(F.col("__text").isNull(), "missing").when(F.col("__text").startswith("---"), "kept").otherwise(moves)
    text = F.when(action.isin("written", "renamed"), with_front_matter(F.col("__text"), F.col("block")))
    return entries.join(there, "old_path", "left").select("old_path", "new_path", action.alias("action"), text.alias("text"))


def upsert_list(text: Column, field: str, items: Column, before: str = "themes:") -> Column:
    """A YAML list field of the front matter replaced, or inserted before ``before`` or the closing line.

    Only the block between the first two --- lines is looked at. Null items, and texts
    without such a block, are left as they are.
    """
    head = F.regexp_extract(text, r"(?s)\A(---\n(?:.*?\n)??)---[ \t]*(?:\n|\z)", 1)
    block = F.concat(F.lit(f"{field}:\n"), F.array_join(F.transform(items, lambda x: F.concat(F.lit("  - "), x)), "\n"), F.lit("\n"))
    safe = F.regexp_replace(block, r"([\\$])", r"\\$1")
    there = rf"(?m)^{re.escape(field)}:[^\n]*\n(?:[ \t]+-[^\n]*\n)*"
    at_mark = rf"(?m)^(?={re.escape(before)})"
    changed = (
        F.when(head.rlike(there), F.regexp_replace(head, F.lit(there), safe))
        .when(head.rlike(at_mark), F.regexp_replace(head, F.lit(at_mark), safe))
        .otherwise(F.concat(head, block))
    )
    return F.when(items.isNull() | (head == ""), text).otherwise(F.concat(changed, F.substring(text, F.length(head) + 1, F.lit(1 << 30))))


def annotated(text: Column, dimensions: dict[str, Column]) -> Column:
    """upsert_list() of several fields; null ones are left alone."""
    for field, items in dimensions.items():
        text = upsert_list(text, field, items)
    return text


def markdown_table(rows: DataFrame, columns: list[str], order: list, within: list[str] | None = None) -> DataFrame:
    """One text per group: a Markdown table of its rows in order. Groups must be of report size."""
    keys = within or []
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), F.lit(" |"))
    n = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).withColumn("__line", cells)
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__n", "__line"))), lambda x: x["__line"]), "\n")
    head = "| " + " | ".join(columns) + " |\n|" + "---|" * len(columns) + "\n"
    return n.groupBy(*keys).agg(F.concat(F.lit(head), body).alias("markdown"))


def filled_template(template: str, parts: dict[str, Column]) -> Column:
    """A text with {name} replaced."""
    out = F.lit(template)
    for name, value in parts.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def catalogue_json(entries: DataFrame, group: str, order: str) -> DataFrame:
    """One JSON document per group with its entries in order and their number."""
    row = F.struct(order, *[c for c in entries.columns if c not in (group, order)])
    listed = F.sort_array(F.collect_list(row))
    return entries.groupBy(group).agg(F.to_json(F.struct(F.first(group).alias(group), F.count(F.lit(1)).alias("total"), listed.alias("entries"))).alias("json"))
