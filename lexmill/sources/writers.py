"""Sinks: articles with their contents, candidates, logs, and tables; all write distributed, into folders that executors share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.sources.byte_ranges import file_system


def write_articles(articles: DataFrame, path: str, text: str = "text", by: str | None = None) -> None:
    """One text file per row group: ``text`` as whole files under ``path``, in a folder per value of ``by``."""
    rows = articles.select(text, *([by] if by else []))
    writer = rows.write.mode("overwrite").option("lineSep", "\n\n")
    (writer.partitionBy(by) if by else writer).text(path)


def write_named(rows: DataFrame, path: str, name: str = "name", text: str = "text") -> None:
    """Each row's text as a file of its own below ``path``; names may hold folders. A task that runs again writes the same files again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            system, base = file_system(path)
            for n, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                system.create_dir(f"{base}/{n}".rpartition("/")[0], recursive=True)
                with system.open_output_stream(f"{base}/{n}") as f:
                    f.write((t or "").encode())
            yield b.select([0])

    rows.select(F.col(name).alias("name"), text).filter("name is not null").mapInArrow(run, "name string").write.format("noop").mode("overwrite").save()


def write_json(rows: DataFrame, path: str, by: str | None = None) -> None:
    """Rows as JSON lines, candidates of a document for example."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def append_log(rows: DataFrame, path: str) -> None:
    """Rows added to a log of JSON lines; what is there stays."""
    rows.write.mode("append").json(path)


def rewrite_log(rows: DataFrame, path: str) -> None:
    """A log replaced by ``rows``, which may be read from it: written beside it first, then put in its place."""
    spark = rows.sparkSession
    beside = f"{path.rstrip('/')}.new"
    rows.write.mode("overwrite").json(beside)
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    old, new = jvm(path), jvm(beside)
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(old, True)
    if not files.rename(new, old):
        raise OSError(f"could not move {beside} to {path}")


def write_table(rows: DataFrame, path: str, batch: int = 100_000) -> None:
    """Rows as a Parquet table, in files of at most ``batch`` rows."""
    rows.write.mode("overwrite").option("maxRecordsPerFile", batch).parquet(path)


def read_back(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """What a writer left under ``path``."""
    return spark.read.schema(schema).format(kind).load(path)
