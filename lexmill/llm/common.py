"""What the corpus operators share: shared storage, text expressions, range cuts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import delete, shared_folder

#: The six characters of [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word, for Java's and DuckDB's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    This cuts the lineage and survives lost executors; later reads prune columns. sweep()
    of the session deletes the table once the query's result is written.
    """
    spark = df.sparkSession
    path = shared_folder(spark, "lexmill")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete stored() tables that nothing will read again."""
    for df in tables:
        delete(df.sparkSession, df._stored_at)


def utf8(column) -> list[bytes]:
    """UTF-8 texts of an Arrow column of strings; null is empty."""
    return [x or b"" for x in column.cast("binary").to_pylist()]


def released(run: Callable) -> Callable:
    """A function for mapInArrow that gives its memory back to the system at the end of each task, since workers live on."""

    def tidy(batches):
        import ctypes
        import gc

        import pyarrow

        try:
            yield from run(batches)
        finally:
            gc.collect()
            pyarrow.default_memory_pool().release_unused()
            libc = ctypes.CDLL(None)
            if hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)

    return tidy


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body's lambdas read it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def cuts(df: DataFrame, column: str, n: int) -> list:
    """At most ``n - 1`` ascending values that split ``column`` into about equal runs."""
    if n < 2:
        return []
    shares = ",".join(f"{i / n:.8f}D" for i in range(1, n))
    got = df.agg(F.expr(f"percentile_approx({column}, array({shares}), 10000)").alias("q")).first()["q"]
    return sorted({x for x in got or [] if x is not None})
