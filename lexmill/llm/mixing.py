"""Mixing sources to target weights by weighted fair queueing.

Documents of a source stand in a shuffled queue. A document's virtual finish time
is the source's words up to it, divided by the source's target; all queues are
sorted together by finish time and cut where the budget is used up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import WORD, stored

#: Weights by the rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: No document is taken more often.
MOST = 3
#: Finish times are binned twice by this factor before rows are sorted.
BINS = 1024
#: Rows of one source that one task orders, about.
RUN = 2000


def n_words(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target: shares of all words by weight, none above ``most`` times its size.

    ``sizes`` has one row per source (source, source_size). Sources rank by code point,
    null last. Resharing the excess until none is above is the fixed point
    sum(min(most * size, level * weight)) = total; sorted by size / weight, the sources
    that stop are a prefix, so running sums give the level. All sums are of integers.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * most)
    by_room = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, everything = by_room.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    # a source stops if the level it would see, all smaller ones stopped, is above its room
    seen = ranked.withColumn("level", level).withColumn("stops", F.col("level") * F.col("weight") >= F.col("most"))
    final = F.min(F.when(~F.col("stops"), F.struct((F.col("most") / F.col("weight")).alias("room"), F.col("level")))).over(everything)["level"]
    return seen.withColumn("final", final).select(
        "source", "source_size", F.when(F.col("stops"), F.col("most").cast("double")).otherwise(F.col("final") * F.col("weight")).alias("target")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row.

    The shuffle order is md5 of doc_id (then doc_id and a row's own hash), so reruns
    agree. A null source is a source that ranks last; a null doc_id sorts first;
    rows with equal doc_id queue one after the other and each comes back. Documents
    without words take nothing. An empty table gives an empty table.

    Texts are read once, for their sizes. A queue is cut into runs by the leading digits of
    md5, so that a source with a third of all rows is summed by many tasks; bins of
    finish times are summed before any rows are ordered.
    """
    rows = stored(
        docs.select(
            "doc_id", "source", n_words(F.col("text")).alias("size"),
            F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("")).alias("key"),
            F.xxhash64("text").alias("tie"),
        )
    )
    n = rows.count()
    digits = min(6, max(1, math.ceil(math.log(max(n / RUN, 1), 16))))
    rows = rows.withColumn("run", F.substring("key", 1, digits))
    sums = rows.groupBy("source", "run").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    targets = stored(source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most))
    offsets = sums.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0))).select(
        F.col("source").alias("__source"), F.col("run").alias("__run"), "ahead"
    )
    queue = Window.partitionBy("source", "run").orderBy("key", F.col("doc_id").asc_nulls_first(), "tie")
    placed = (
        rows.join(offsets, F.col("source").eqNullSafe(F.col("__source")) & (F.col("run") == F.col("__run")))
        .withColumn("upto", F.col("ahead") + F.sum("size").over(queue.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(queue))
        .drop("__source", "__run", "ahead", "run")
    )
    t = targets.select(F.col("source").alias("__source"), "source_size", "target")
    placed = stored(placed.join(t, F.col("source").eqNullSafe(F.col("__source"))).drop("__source"))
    rounds = F.least(F.lit(most - 1), F.floor(F.col("target") / F.col("source_size"))).cast("int")
    heard = (
        placed.filter("size > 0 and target > 0")
        .withColumn("round", F.explode(F.sequence(F.lit(0), rounds)))
        .withColumn("finish", (F.col("round") * F.col("source_size") + F.col("upto")) / F.col("target"))
        .withColumn("bin", F.least(F.floor(F.col("finish") * BINS * BINS), F.lit(2 * BINS * BINS)).cast("long"))
    )
    budget = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("t")).first()["t"]
    last, left = _cut(heard.groupBy(F.floor(F.col("bin") / BINS).cast("long").alias("b")).agg(F.sum("size").alias("s")).collect(), budget)
    fine, left = _cut(heard.filter(F.floor(F.col("bin") / BINS) == last).groupBy(F.col("bin").alias("b")).agg(F.sum("size").alias("s")).collect(), left)
    inside = Window.partitionBy("bin").orderBy("finish", "key", F.col("doc_id").asc_nulls_first(), "tie", "nth", "round")
    edge = (
        heard.filter(F.col("bin") == fine)
        .withColumn("run_up", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("run_up") <= left)
        .groupBy("key", F.col("doc_id").alias("__id"), "tie", "nth").agg(F.count(F.lit(1)).alias("more"))
        .withColumnsRenamed({"key": "__key", "tie": "__tie", "nth": "__nth"})
    )
    # a row's rounds below the cut follow from its own finish times
    below = sum(
        (F.when((rounds >= r) & (F.least(F.floor((r * F.col("source_size") + F.col("upto")) / F.col("target") * BINS * BINS), F.lit(2 * BINS * BINS)) < fine), 1).otherwise(0) for r in range(most)),
        F.lit(0),
    )
    full = placed.join(
        edge,
        (F.col("key") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("tie").eqNullSafe(F.col("__tie")) & (F.col("nth") == F.col("__nth")),
        "left",
    )
    times = F.when((F.col("size") > 0) & (F.col("target") > 0), below).otherwise(0) + F.coalesce(F.col("more"), F.lit(0))
    return full.select("doc_id", "source", "tie", "nth", "size", "source_size", "target", (times * F.col("size")).cast("long").alias("taken"))


def _cut(bins: list, budget: int) -> tuple[int, int]:
    """The first bin that does not fit, and what is left of the budget there; bins are at most 2049."""
    left = budget
    for b, s in sorted(bins):
        if s > left:
            return b, left
        left -= s
    return 1 << 60, left


def op7(docs: DataFrame) -> DataFrame:
    """The digest of mix(): doc_id, size, source_size, target, taken."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, all columns kept.

    Rows that are alike in doc_id, source and text are taken alike often in total.
    """
    times = mix(docs).filter("taken > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("tie").alias("__tie"),
        (F.col("taken") / F.col("size")).cast("int").alias("__times"),
    )
    times = times.groupBy("__id", "__source", "__tie").agg(F.sort_array(F.collect_list("__times"), asc=False).alias("__all"))
    same = Window.partitionBy("doc_id", "source", "__t").orderBy(F.lit(1))
    keyed = docs.withColumn("__t", F.xxhash64("text")).withColumn("__n", F.row_number().over(same))
    met = keyed.join(times, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source")) & (F.col("__t") == F.col("__tie")))
    return (
        met.withColumn("__k", F.coalesce(F.get("__all", F.col("__n") - 1), F.lit(0)))
        .filter("__k > 0")
        .withColumn("__r", F.explode(F.sequence(F.lit(1), F.col("__k"))))
        .select(*docs.columns)
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(doc_id::VARCHAR) AS key FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS most,
         ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(most) OVER w, 0)::BIGINT)::DOUBLE
            / ((sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER w, 0)::BIGINT)::DOUBLE AS level
  FROM s WINDOW w AS (ORDER BY most::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         CASE WHEN level * weight >= most THEN most::DOUBLE ELSE weight *
           (SELECT arg_min(level, most::DOUBLE / weight) FROM l WHERE NOT level * weight >= most) END AS target
  FROM l),
q AS (
  SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id)::BIGINT AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (
  SELECT doc_id, size, key, round, (round * source_size + upto)::DOUBLE / target AS finish
  FROM q, (VALUES (0), (1), (2)) x(round)
  WHERE size > 0 AND target > 0 AND round <= floor(target / source_size)),
u AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT doc_id, sum(size) OVER (ORDER BY finish, key, doc_id, round ROWS UNBOUNDED PRECEDING) AS total FROM r)
  WHERE total <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT q.doc_id, size, source_size, target, (size * coalesce(n, 0))::BIGINT AS taken FROM q LEFT JOIN u ON q.doc_id = u.doc_id
"""
