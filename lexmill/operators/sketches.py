"""Approximate aggregates that are stored by day and merged over any range of days, with bounds on their error."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the registers of a HyperLogLog sketch, and the size of a KLL sketch.
LG, K = 12, 200
#: Normalised rank error of a KLL sketch of size K, and standard errors of a distinct count that its bounds span.
RANK_ERROR, ERRORS = 0.0133, 3.0


def daily_sketches(rows: DataFrame, day: Column, distinct: str, number: str) -> DataFrame:
    """day, n, distinct_sketch, number_sketch: one row a day, some ten kilobytes, whatever the day holds.

    Nulls of the column count in neither sketch; rows without a day are left out.
    """
    return (
        rows.withColumn("day", day).filter("day is not null").groupBy("day")
        .agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(distinct, F.lit(LG)).alias("distinct_sketch"), F.kll_sketch_agg_double(number, F.lit(K)).alias("number_sketch"))
    )


def merged(sketches: DataFrame, ranges: DataFrame, rank: float = 0.5) -> DataFrame:
    """name, n, days, distinct_estimate with its bounds, and the bounds of the value at ``rank``, of each range (name, first, last; both days included).

    Sketches are merged, never rows, and meet ranges by day. Ranges without a day that has rows do not come back.
    """
    days = ranges.select("name", F.explode(F.sequence("first", "last")).alias("day"))
    both = sketches.join(days, "day").groupBy("name").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("days"), F.hll_union_agg("distinct_sketch").alias("d"), F.kll_merge_agg_double("number_sketch").alias("q")
    )
    estimate, error = F.hll_sketch_estimate("d"), ERRORS * 1.04 / math.sqrt(1 << LG)
    at = lambda r: F.kll_sketch_get_quantile_double("q", F.lit(min(max(r, 0.0), 1.0)))
    return both.select(
        "name", "n", "days", estimate.alias("distinct_estimate"), F.floor(estimate / (1 + error)).alias("distinct_low"), F.ceil(estimate / (1 - error)).alias("distinct_high"),
        at(rank - RANK_ERROR).alias("low"), at(rank).alias("value"), at(rank + RANK_ERROR).alias("high"),
    )
