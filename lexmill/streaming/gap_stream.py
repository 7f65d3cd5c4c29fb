"""The gap log as a stream: frequencies over all distinct (article, dimension, term)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import shared_folder


SCHEMA = "article_path string, timestamp string, concepts array<string>, domains array<string>, functions array<string>, bearings array<string>, gap_terms array<string>"


def read_gap_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """A folder of JSON lines, file by file."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(path)


def gap_counts(log: DataFrame, prefix: str = "") -> DataFrame:
    """dimension, term, n. A term counts once per article forever, so state has no watermark: its size is that of the distinct terms."""
    rows = gap_terms_row(log, prefix)
    return rows.dropDuplicates(["article", "dimension", "term"]).groupBy("dimension", "term").agg(F.count(F.lit(1)).alias("n"))


def gap_terms_row(log: DataFrame, prefix: str = "") -> DataFrame:
    """gap_terms() as one pass over the log, which streams need."""
    from lexmill.functions.text import normal_label, simplified
    from lexmill.operators.gaps import DIMENSIONS, clean_path

    rows = log.filter(~F.col("article_path").contains("/tmp/")).withColumn("article", clean_path(F.col("article_path"), prefix))
    none = F.array().cast("array<string>")
    pair = lambda d, f: (lambda x: F.struct(F.lit(d).alias("dimension"), f(x).alias("term")))
    parts = [F.transform(F.coalesce(d, none), pair(d, simplified)) for d in DIMENSIONS] + [F.transform(F.coalesce("gap_terms", none), pair("concepts", normal_label))]
    return rows.select("article", F.explode(F.concat(*parts)).alias("p")).select("article", "p.dimension", "p.term")


def counted(counts: DataFrame) -> DataFrame:
    """The counts of a stream at the end of what is there, from files: each batch writes all of them to a folder of its number, and the last folder is read.

    A batch that runs again writes the same folder; nothing passes through the driver.
    """
    spark, base = counts.sparkSession, shared_folder(counts.sparkSession, "counts")
    last: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/{number}")
        last.append(number)

    writer = counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint_folder(spark)).trigger(availableNow=True)
    writer.foreachBatch(write).start().awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{base}/{last[-1]}") if last else spark.createDataFrame([], counts.schema)


def checkpoint_folder(spark: SparkSession) -> str:
    """A new folder for a stream's state."""
    return shared_folder(spark, "stream")


def windowed_counts(rows: DataFrame, time: str, by: str, late: str = "10 minutes", size: str = "1 hour", slide: str | None = None) -> DataFrame:
    """n per window and group; rows later than ``late`` are dropped, which bounds the state."""
    at = F.window(time, size, slide) if slide else F.window(time, size)
    return rows.withWatermark(time, late).groupBy(at.alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")


def distinct_counts(rows: DataFrame, by: str, distinct: str) -> DataFrame:
    """n of distinct values per group, for batches and streams."""
    return rows.select(by, distinct).dropDuplicates().groupBy(by).agg(F.count(F.lit(1)).alias("n"))
