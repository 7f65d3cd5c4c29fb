"""Sinks whose folders change from one state to the next at once: versions that are written beside each other and one pointer that is renamed.

A folder holds ``versions/<id>/`` and ``CURRENT``, a small file with the id that counts. Writers
never touch a version that CURRENT names; whoever is killed, a task or a job, leaves CURRENT as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from lexmill.sources.byte_ranges import file_system

CURRENT, VERSIONS = "CURRENT", "versions"


def current(path: str) -> str | None:
    """The id of the version that counts, or null if there is none yet."""
    system, at = file_system(path)
    if not system.get_file_info(f"{at}/{CURRENT}").is_file:
        return None
    with system.open_input_file(f"{at}/{CURRENT}") as f:
        return f.read().decode().strip()


def _point(path: str, version: str) -> None:
    system, at = file_system(path)
    beside = f"{at}/.{CURRENT}-{uuid.uuid4().hex}"
    with system.open_output_stream(beside) as f:
        f.write(version.encode())
    system.move(beside, f"{at}/{CURRENT}")


def vacuum(path: str) -> list[str]:
    """Delete every version but the one that counts; their ids. Not to be called while others write."""
    system, at = file_system(path)
    kept = current(path)
    gone = [i.base_name for i in system.get_file_info(pafs.FileSelector(f"{at}/{VERSIONS}", allow_not_found=True)) if i.base_name != kept]
    for name in gone:
        system.delete_dir(f"{at}/{VERSIONS}/{name}")
    return sorted(gone)


def replace_log(rows: DataFrame, path: str) -> str:
    """A log of JSON lines replaced by ``rows``, which may be read from it; the new version's id. Readers see the old log or the new one."""
    version = uuid.uuid4().hex
    rows.write.mode("error").json(f"{path}/{VERSIONS}/{version}")
    _point(path, version)
    return version


def read_log_version(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the log's version that counts; none before the first."""
    version = current(path)
    return spark.read.schema(schema).json(f"{path}/{VERSIONS}/{version}") if version else spark.createDataFrame([], schema)


@dataclass
class _Written(WriterCommitMessage):
    manifest: str
    files: int


class _ArticleWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.version = path, uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        """A task's articles in a folder of its attempt, and a manifest that lists them."""
        system, at = file_system(self.path)
        task = TaskContext.get()
        part = f"{task.partitionId()}-{task.taskAttemptId()}"
        folder, listed = f"{at}/{VERSIONS}/{self.version}/{part}", []
        system.create_dir(folder, recursive=True)
        for b in batches:
            for row in b.select(["name", "text", "toc", "toc_json"]).to_pylist():
                stem = f"{folder}/{len(listed)}"
                for end, column in ((".md", "text"), (".toc.md", "toc"), (".toc.json", "toc_json")):
                    with system.open_output_stream(stem + end) as f:
                        f.write((row[column] or "").encode())
                listed.append({"name": row["name"], "stem": f"{part}/{len(listed)}"})
        manifest = f"manifest-{part}.jsonl"
        with system.open_output_stream(f"{at}/{VERSIONS}/{self.version}/{manifest}") as f:
            f.write("".join(json.dumps(x, ensure_ascii=False) + "\n" for x in listed).encode())
        return _Written(manifest, len(listed))

    def commit(self, messages: list[_Written | None]) -> None:
        """Name the manifests of the attempts that count, then point at the version."""
        system, at = file_system(self.path)
        system.create_dir(f"{at}/{VERSIONS}/{self.version}", recursive=True)
        with system.open_output_stream(f"{at}/{VERSIONS}/{self.version}/MANIFESTS") as f:
            f.write("\n".join(m.manifest for m in messages if m).encode())
        _point(self.path, self.version)

    def abort(self, messages: list[_Written | None]) -> None:
        system, at = file_system(self.path)
        if system.get_file_info(f"{at}/{VERSIONS}/{self.version}").type != pafs.FileType.NotFound:
            system.delete_dir(f"{at}/{VERSIONS}/{self.version}")


class ArticleSink(DataSource):
    """Format ``articles``: rows (name, text, toc, toc_json) as one text file and one pair of contents files each."""

    @classmethod
    def name(cls) -> str:
        return "articles"

    def schema(self) -> str:
        return "name string, text string, toc string, toc_json string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _ArticleWriter(self.options["path"])


def write_article_files(articles: DataFrame, path: str) -> None:
    """One .md, .toc.md and .toc.json for each row (name, text, toc, toc_json); the set of files replaces the one before at once.

    Null texts are empty files. Names need not be file names: manifests map them to files. Rows of
    equal name are files of their own.
    """
    articles.sparkSession.dataSource.register(ArticleSink)
    articles.select("name", "text", "toc", "toc_json").write.format("articles").option("path", path).mode("append").save()


def read_article_files(spark: SparkSession, path: str) -> DataFrame:
    """name, text, toc, toc_json of every article of the version that counts; none before the first."""
    version, schema = current(path), "name string, text string, toc string, toc_json string"
    if version is None:
        return spark.createDataFrame([], schema)
    system, at = file_system(path)
    with system.open_input_file(f"{at}/{VERSIONS}/{version}/MANIFESTS") as f:
        names = [n for n in f.read().decode().split("\n") if n]
    if not names:
        return spark.createDataFrame([], schema)
    root = f"{path}/{VERSIONS}/{version}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            system, base = file_system(root)
            rows = []
            for name, stem in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                texts = []
                for end in (".md", ".toc.md", ".toc.json"):
                    with system.open_input_file(f"{base}/{stem}{end}") as f:
                        texts.append(f.read().decode())
                rows.append((name, *texts))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(4)], ["name", "text", "toc", "toc_json"])

    listed = spark.read.schema("name string, stem string").json([f"{root}/{n}" for n in names])
    return listed.mapInArrow(run, schema)
