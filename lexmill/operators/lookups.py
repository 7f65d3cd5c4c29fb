"""Lookups in reference tables: cascading keys, longest contained names, spans to rows, anti joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Texts that mean no date.
NO_DATE = ("0000-00-00", "0000", "")


def expand_spans(rows: DataFrame, first: str, last: str, out: str = "issue") -> DataFrame:
    """A row for every number from ``first`` to ``last``; none where first is above last or either is no number."""
    a, b = F.col(first).try_cast("int"), F.col(last).try_cast("int")
    span = F.when(a <= b, F.sequence(a, b))
    return rows.withColumn(out, F.explode(span))


def best_dates(rows: DataFrame, keys: list[str], date: str, order: str) -> DataFrame:
    """One row per key with its first date that is not empty, else ''."""
    real = F.when(~F.coalesce(F.col(date), F.lit("")).isin(*NO_DATE), F.col(date))
    return rows.groupBy(*keys).agg(F.coalesce(F.min_by(real, F.when(real.isNotNull(), F.col(order))), F.lit("")).alias(date))


def cascade(left: DataFrame, table: DataFrame, attempts: list[dict[str, Column]], value: str, out: str = "found") -> DataFrame:
    """``left`` with ``value`` of the first attempt whose keys are in ``table``, and ``{out}_by`` its number from 1.

    Each attempt maps key columns of the table to expressions over ``left``, compared null-safely. A
    key that is there with an empty value stops the cascade, so hits and not values are
    coalesced. ``table`` must have one row per key; each attempt is one join of its own keys.
    """
    result, hits, values = left, [], []
    for n, keys in enumerate(attempts, 1):
        t = table.select(*(F.col(k).alias(f"__{n}_{k}") for k in keys), F.col(value).alias(f"__{n}_v"), F.lit(True).alias(f"__{n}_hit"))
        on = reduce(lambda a, b: a & b, (e.eqNullSafe(F.col(f"__{n}_{k}")) for k, e in keys.items()))
        result = result.join(t, on, "left").drop(*(f"__{n}_{k}" for k in keys))
        hits.append(F.when(F.col(f"__{n}_hit"), F.lit(n)))
        values.append((F.col(f"__{n}_hit"), F.col(f"__{n}_v")))
    picked = F.lit(None)
    for hit, v in reversed(values):
        picked = F.when(hit, v).otherwise(picked)
    result = result.withColumn(out, picked).withColumn(f"{out}_by", F.coalesce(*hits))
    return result.drop(*(c for n in range(1, len(attempts) + 1) for c in (f"__{n}_v", f"__{n}_hit")))


def match_status(found: Column, by: Column, known: Column) -> Column:
    """dated, matched (a key without date, or a known name), or unmatched."""
    return F.when(by.isNotNull() & (F.coalesce(found, F.lit("")) != ""), "dated").when(by.isNotNull() | known, "matched").otherwise("unmatched")


def missing(rows: DataFrame, known: DataFrame, key: Column, known_key: Column) -> DataFrame:
    """Rows whose key is not among the known ones."""
    k = known.select(known_key.alias("__k")).distinct()
    return rows.withColumn("__r", key).join(k, F.col("__r") == F.col("__k"), "left_anti").drop("__r")


def in_order_of(rows: DataFrame, anchors: DataFrame, on: str, order: str) -> DataFrame:
    """Rows that anchors point to, in the anchors' order."""
    return anchors.select(on, order).join(rows, on).orderBy(order)


def vote(rows: DataFrame, key: str, value: str, order: str, default: str | None = None) -> DataFrame:
    """The most common value per key; of equal counts the one seen first."""
    n = rows.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("o"))
    best = Window.partitionBy(key).orderBy(F.desc("n"), "o", value)
    out = n.withColumn("rn", F.row_number().over(best)).filter("rn = 1").select(key, value, "n")
    return out if default is None else rows.select(key).distinct().join(out, key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def canonical_name(rows: DataFrame, name: str, aliases: DataFrame, out: str = "canonical") -> DataFrame:
    """Rows with the canonical form of a name: of an alias (alias, canonical) its own, of others themselves, null for blank ones."""
    clean = F.nullif(F.trim(F.col(name)), F.lit(""))
    known = aliases.select(F.col("alias").alias("__a"), F.col("canonical").alias("__c"))
    return rows.withColumn("__n", clean).join(known, F.col("__n") == F.col("__a"), "left").withColumn(out, F.coalesce("__c", "__n")).drop("__n", "__a", "__c")


def resolved_dates(parsed: DataFrame, dates: DataFrame) -> DataFrame:
    """Parsed references (pub, vol, issues, text) with publish_y, publish_m, publish_d and unmatched.

    The first issue's date counts, looked up in ``dates`` (pub, vol, issue, date) by volume, then without one, then by
    volume 0. Without issues there is no date and nothing unmatched; a lookup that fails echoes the text.
    """
    from lexmill.functions.bylines import date_parts

    left = parsed.withColumn("__pub", F.col("pub")).withColumn("__vol", F.col("vol")).withColumn("__issue", F.get("issues", F.lit(0)))
    tries = [{"pub": F.col("__pub"), "vol": v, "issue": F.col("__issue")} for v in (F.col("__vol"), F.lit(None).cast("int"), F.lit(0))]
    found = cascade(left, dates, tries, "date").withColumn("d", date_parts(F.col("found")))
    asked = F.col("__issue").isNotNull()
    part = lambda x: F.when(asked, F.coalesce(F.col(f"d.{x}"), F.lit(""))).otherwise("").alias(f"publish_{x}")
    missing_date = asked & F.col("d.y").isNull()
    return found.filter("pub is not null").select("text", "pub", part("y"), part("m"), part("d"), F.when(missing_date, F.col("text")).alias("unmatched"))


def match_statistics(rows: DataFrame, text: str, canonical: str, heuristic: str) -> DataFrame:
    """relevant, matched, unmatched (not matched, but ``heuristic`` takes them for references) and distinct names of all rows."""
    return rows.agg(
        F.count(F.lit(1)).alias("relevant"), F.count(canonical).alias("matched"), F.count_if(F.col(canonical).isNull() & F.col(text).rlike(heuristic)).alias("unmatched"),
        F.count_distinct(canonical).alias("names"),
    )


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, values: list[str]) -> DataFrame:
    """``left`` with the values of the last row of ``right`` of the same key at or before its time; nulls without one.

    Both are laid in one order per key and values carried on, so no pairs are made.
    """
    kinds = {f.name: f.dataType for f in left.schema} | {f.name: f.dataType for f in right.schema}
    rest = [c for c in left.columns if c not in (key, time)]
    null = lambda c: F.lit(None).cast(kinds[c])
    a = left.select(key, time, F.lit(1).alias("__side"), *rest, F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("__v"))
    b = right.select(key, time, F.lit(0).alias("__side"), *(null(c).alias(c) for c in rest), F.struct(*values).alias("__v"))
    upto = Window.partitionBy(key).orderBy(time, "__side").rowsBetween(Window.unboundedPreceding, 0)
    met = a.unionByName(b).withColumn("__v", F.last("__v", True).over(upto)).filter("__side = 1")
    return met.select(*left.columns, *(F.col(f"__v.{v}").alias(v) for v in values))


def interval_join(points: DataFrame, spans: DataFrame, at: str, first: str, last: str, width: float) -> DataFrame:
    """Pairs of points and the spans [first, last] that hold them, met by buckets of ``width``; spans take as many buckets as they cross."""
    bucket = lambda c: F.floor(F.col(c) / width).cast("long")
    wide = spans.filter(F.col(first) <= F.col(last)).withColumn("__b", F.explode(F.sequence(bucket(first), bucket(last))))
    return points.withColumn("__b", bucket(at)).join(wide, "__b").filter((F.col(at) >= F.col(first)) & (F.col(at) <= F.col(last))).drop("__b")
