"""SQLite files read in parallel from any store that Spark reads: a file is a task."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession

from lexmill.sources.byte_ranges import file_system

#: Rows that leave a file together.
BATCH = 5_000


def sqlite_rows(files: DataFrame, table: str, schema: str, content: str = "content") -> DataFrame:
    """Rows of ``table`` of every database in a binary column, as ``schema`` (DDL) names them; files without the table have none."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(schema)
    arrow, names = to_arrow_schema(kind), ", ".join('"' + n.replace('"', '""') + '"' for n in kind.names)
    quoted = '"' + table.replace('"', '""') + '"'

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0).to_pylist():
                if data is None:
                    continue
                db = sqlite3.connect(":memory:")
                db.deserialize(data)
                if db.execute("SELECT 1 FROM sqlite_master WHERE type IN ('table', 'view') AND name = ?", (table,)).fetchone():
                    rows = db.execute(f"SELECT {names} FROM {quoted}")
                    while part := rows.fetchmany(BATCH):
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*part, strict=True), arrow, strict=True)], schema=arrow)
                db.close()

    return files.select(content).mapInArrow(run, schema)


def read_sqlite(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """Rows of a table of all SQLite files under ``path``."""
    return sqlite_rows(spark.read.format("binaryFile").load(path).select("content"), table, schema)


def write_sqlite(rows: DataFrame, path: str, table: str, file: Column) -> None:
    """Rows as SQLite files below ``path``, one for each value of ``file``, which bounds what a task holds; a task that runs again writes the same files."""
    names = rows.columns
    kinds = {"string": "TEXT", "double": "REAL", "float": "REAL"}
    quoted = lambda n: '"' + n.replace('"', '""') + '"'
    columns = ", ".join(f"{quoted(f.name)} {kinds.get(f.dataType.simpleString(), 'INTEGER')}" for f in rows.schema)

    def run(key: tuple, held: pa.Table) -> pa.Table:
        db = sqlite3.connect(":memory:")
        db.execute(f"CREATE TABLE {quoted(table)} ({columns})")
        db.executemany(f"INSERT INTO {quoted(table)} VALUES ({', '.join('?' * len(names))})", zip(*(held[n].to_pylist() for n in names), strict=True))
        db.commit()
        system, base = file_system(path)
        system.create_dir(base, recursive=True)
        with system.open_output_stream(f"{base}/{key[0].as_py()}.db") as f:
            f.write(db.serialize())
        return pa.table({"n": [held.num_rows]})

    rows.withColumn("__file", file).groupBy("__file").applyInArrow(run, "n long").write.format("noop").mode("overwrite").save()
