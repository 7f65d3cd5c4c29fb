"""Streams with state of their own: reviews that fall due, sessions, and rows that come too late."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Session settings (dots as two underscores) that hold within a block."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


class _Reviews(StatefulProcessor):
    """Of each key: the articles seen, as a map of the state store, and their number."""

    def __init__(self, every: int):
        self.every = every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("articles", "article string", "seen boolean")
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = before = self.count.get()[0] if self.count.exists() else 0
        for batch in rows:
            for article in batch["article"].unique():
                if not self.seen.containsKey((article,)):
                    self.seen.updateValue((article,), (True,))
                    n += 1
        if n != before:
            self.count.update((n,))
        due = range((before // self.every + 1) * self.every, n + 1, self.every)
        if len(due):
            yield pd.DataFrame({"dimension": [key[0]] * len(due), "term": [key[1]] * len(due), "articles": list(due)})

    def close(self) -> None:
        pass


def reviews_due(terms: DataFrame, every: int = 5) -> DataFrame:
    """dimension, term, articles: a row each time that a term's distinct articles cross a multiple of ``every``.

    ``terms`` is a stream (dimension, term, article). State lives in the store, keyed by dimension and term, with one
    entry for each article; a batch reads and writes only entries of its own articles. However rows
    are cut into batches, repeated or restarted, each multiple comes once. Rows with a null among the three are left out.
    """
    rows = terms.select("dimension", "term", "article").dropna()
    return rows.groupBy("dimension", "term").transformWithStateInPandas(
        _Reviews(every), "dimension string, term string, articles long", outputMode="Append", timeMode="None"
    )


def run_to_end(rows: DataFrame, path: str, checkpoint: str, kind: str = "parquet") -> StreamingQuery:
    """Run a stream over all that is there, into files; start it again with the same checkpoint and it goes on behind that."""
    with settings(rows.sparkSession, spark__sql__streaming__stateStore__providerClass=_ROCKS):
        q = rows.writeStream.format(kind).outputMode("append").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
        q.awaitTermination()
    return q


def sessions(rows: DataFrame, time: str, by: str, gap: str, late: str, values: dict[str, Column] | None = None) -> DataFrame:
    """Sessions of each key in a stream: runs of rows with less than ``gap`` between neighbours; start, end, n and aggregates.

    A session comes out once, when the watermark, ``late`` behind the latest row of the batches
    before, has passed its end; a row whose own session would have ended by then is dropped. State holds open sessions only.
    """
    window = F.session_window(time, gap)
    more = [c.alias(n) for n, c in (values or {}).items()]
    found = rows.withWatermark(time, late).groupBy(window.alias("w"), by).agg(F.count(F.lit(1)).alias("n"), *more)
    return found.select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", *(values or {}))


def dropped_rows(q: StreamingQuery) -> int:
    """Rows that a query's last run dropped as too late, by its own progress."""
    return sum(op.numRowsDroppedByWatermark for p in q.recentProgress for op in p.stateOperators)


def kept_and_late(all_rows: DataFrame, found: DataFrame, key: str, kept: str = "ids") -> DataFrame:
    """The rows of a stream's input that no session holds: those that came too late, by name."""
    return all_rows.join(found.select(F.explode(kept).alias("__id")), F.col(key) == F.col("__id"), "left_anti")
