"""Operators over ordered rows: numbering, links, filling, folding, gaps, outlines, pivots."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.operators.scan import scan


def linked(rows: DataFrame, order: list, within: list[str], name: str) -> DataFrame:
    """Rows with seq (in ``within``), prev_ and next_ of ``name``. ``within`` bounds what one task orders."""
    w = Window.partitionBy(*within).orderBy(*order)
    return rows.select("*", F.row_number().over(w).alias("seq"), F.lag(name).over(w).alias(f"prev_{name}"), F.lead(name).over(w).alias(f"next_{name}"))


def forward_fill(rows: DataFrame, column: str, order: list, within: list[str]) -> DataFrame:
    """Nulls replaced by the last value before them."""
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(f"{column}_filled", F.last(column, ignorenulls=True).over(w))


def fold(rows: DataFrame, is_appendix: Column, order: list, within: list[str], head: list[str], last: str, listed: str, note: str = "；") -> DataFrame:
    """Runs of appendix rows folded into the row before them.

    Each group keeps its head's columns, takes ``last`` from its last row, and lists
    ``listed`` of the folded rows, joined by ``note``. A leading appendix stands for itself.
    """
    w = Window.partitionBy(*within).orderBy(*order)
    marked = rows.withColumn("__a", is_appendix).withColumn("__n", F.row_number().over(w))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    grouped = marked.withColumn("__g", F.sum(F.when(~F.col("__a") | (F.col("__n") == 1), 1).otherwise(0)).over(upto))
    names = F.transform(F.sort_array(F.collect_list(F.when(F.col("__a") & (F.col("__n") > 1), F.struct("__n", listed)))), lambda x: x[listed])
    return grouped.groupBy(*within, "__g").agg(
        *(F.min_by(c, "__n").alias(c) for c in head if c not in within), F.max_by(last, "__n").alias(f"last_{last}"),
        F.array_join(names, note).alias("folded"), (F.count(F.lit(1)) - 1).alias("n_folded"),
    ).drop("__g")


def gaps(rows: DataFrame, start: str, end: str, order: list, within: list[str], most: int = 500) -> DataFrame:
    """Rows with the gap to the next row, and whether it is negative or above ``most``."""
    w = Window.partitionBy(*within).orderBy(*order)
    gap = F.lead(start).over(w) - F.col(end)
    return rows.withColumn("gap", gap).withColumn("suspicious", F.coalesce((F.col("gap") < 0) | (F.col("gap") > most), F.lit(False)))


def outline(headings: DataFrame, key: str, seq: str = "seq", level: str = "level") -> DataFrame:
    """Headings with parent_seq (the last before of smaller level), is_last (no later sibling) and bars (the branches of a tree above it).

    Each document's headings pass once, in order, through a stack of open levels; a document's
    outline stays in its task.
    """
    names = headings.columns
    at, depth = names.index(seq), names.index(level)
    kinds = {f.name: f.dataType.simpleString() for f in headings.schema}

    def told(rows: list[list]) -> None:
        last, stack = [True] * len(rows), []
        for i, r in enumerate(rows):
            while stack and rows[stack[-1]][depth] > r[depth]:
                stack.pop()
            if stack and rows[stack[-1]][depth] == r[depth]:
                last[stack.pop()] = False
            r.append(rows[stack[-1]][at] if stack else None)
            stack.append(i)
        ends: list[bool] = []  # whether the open node of each level is the last of its siblings
        for r, end in zip(rows, last, strict=True):
            above = max(r[depth] - 1, 0)
            ends = (ends + [False] * above)[:above]
            r += [end, "".join("    " if e else "|   " for e in ends)]
            ends.append(end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        document, rows, schema = None, [], None

        def finished() -> pa.RecordBatch:
            told(rows)
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            schema = pa.schema([*b.schema, pa.field("parent_seq", b.schema.field(seq).type), pa.field("is_last", pa.bool_()), pa.field("bars", pa.string())])
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if rows and row[names.index(key)] != document:
                    yield finished()
                    rows = []
                document = row[names.index(key)]
                rows.append(list(row))
        if rows:
            yield finished()

    out = ", ".join(f"`{n}` {k}" for n, k in kinds.items()) + f", parent_seq {kinds[seq]}, is_last boolean, bars string"
    return headings.repartition(key).sortWithinPartitions(key, seq).mapInArrow(run, out)


def collapse_blank(text: Column) -> Column:
    """Runs of blank lines as one."""
    return F.regexp_replace(text, r"\n[ \t]*(\n[ \t]*)+\n", "\n\n")


def distinct_in_order(items: Column) -> Column:
    """Items of an array without repeats, first ones kept."""
    return F.array_distinct(items)


def head_and_tail(rows: DataFrame, order: list, within: list[str], first: int = 5, last: int = 2) -> DataFrame:
    """The first and the last rows of each group, with ``part``; short groups give rows once for each part."""
    w, v = Window.partitionBy(*within).orderBy(*order), Window.partitionBy(*within)
    n = rows.withColumn("__n", F.row_number().over(w)).withColumn("__m", F.count(F.lit(1)).over(v))
    parts = F.filter(F.array(F.when(F.col("__n") <= first, F.lit("head")), F.when((F.col("__m") > first) & (F.col("__n") > F.col("__m") - last), F.lit("tail"))), lambda x: x.isNotNull())
    return n.withColumn("part", F.explode(parts)).drop("__n", "__m")


def wide(rows: DataFrame, order: list, values: list[str], columns: int = 3) -> DataFrame:
    """Rows dealt into lines of ``columns``, in one order over the whole table, numbered by a scan and not in one task."""
    n = scan(rows.select(*rows.columns), order, number="__seq").withColumn("__seq", F.col("__seq") - 1)
    line, at = F.floor(F.col("__seq") / columns).cast("long").alias("line"), F.col("__seq") % columns
    return n.groupBy(line).agg(*(F.max(F.when(at == i, F.col(v))).alias(f"{v}_{i + 1}") for i in range(columns) for v in values))


def year_table(spark, n: int = 30, base: int = 1919, era: int = 1911) -> DataFrame:
    """vol, year, era_year for volumes 1 to ``n``."""
    return spark.range(1, n + 1).select(F.col("id").cast("int").alias("vol"), (F.col("id") + base).cast("int").alias("year"), (F.col("id") + base - era).cast("int").alias("era_year"))


def first_of_each(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first by order; the union of sources deduplicated by text is this."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def top(rows: DataFrame, n: int, order: list, within: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows by order, of each group or of all."""
    if not within:
        return rows.orderBy(*order).limit(n)
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).filter(F.col("__n") <= n).drop("__n")


def shares(rows: DataFrame, *by: str) -> DataFrame:
    """n and pct (one decimal) of each group, most common first in reports."""
    n = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.join(F.broadcast(total)).select(*by, "n", F.round(100.0 * F.col("n") / F.col("total"), 1).alias("pct"))


def issue_order(vol: str = "vol", issue: str = "issue") -> list:
    """Volumes ascending with missing ones last, then the leading number of the issue."""
    return [F.col(vol).asc_nulls_last(), F.split(F.col(issue), "-")[0].try_cast("int").asc_nulls_last(), F.col(issue)]
