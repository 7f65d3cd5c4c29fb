"""The corpus pipeline: quality, line dedup, near-copy removal, mixing and packing, one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm.common import forget, stored
from lexmill.llm.pipeline_stages import STAGES
from lexmill.session import mark, sweep, table

#: The quality network and the tokenizer are not SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to the documents of a folder; each result is stored and read again as the next one's input.

    What a stage has stored for itself goes when its result is written, and so does its input.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        since = mark()
        docs = stored(stage(spark, docs, sf_dir))
        sweep(spark, since, keep=(docs._stored_at,))
        if before is not None:
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
