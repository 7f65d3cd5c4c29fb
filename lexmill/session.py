"""Session helpers: defaults for a large cluster, table registration, SQL entry."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables that a data folder may hold, one Parquet file or folder each.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(app: str = "lexmill", **conf: str) -> SparkSession:
    """A session with adaptive execution; the caller's settings win."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt out over all cores, before work that costs much more than reading them: a file's row group is read by one task."""
    return rows.repartition(max(32, 4 * rows.sparkSession.sparkContext.defaultParallelism))


def register_tables(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    """Make the tables of a folder known to ``spark.sql`` as temporary views."""
    for name in names or TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def run_sql(spark: SparkSession, query: str, args: dict | list | None = None) -> DataFrame:
    """Free-form SQL over registered views, with named or positional parameters."""
    return spark.sql(query, args=args) if args else spark.sql(query)


_scratch: list[str] = []
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the session's spark.checkpoint.dir, or the context's where that is unset.

    Where neither is set a local session gets one temporary folder, removed at exit; on a cluster
    an unset folder is an error, since executors could not share it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    kept = spark.sparkContext._jsc.sc().getCheckpointDir()
    if kept.isDefined():
        return kept.get().rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master or ""):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="lexmill-")
        atexit.register(shutil.rmtree, _local[app], ignore_errors=True)
    return "file://" + _local[app]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below shared_dir(); sweep() deletes what is written there."""
    _scratch.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _scratch[-1]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def mark() -> int:
    """A point in time for sweep()."""
    return len(_scratch)


def sweep(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Delete what was written to shared folders after a mark(), besides ``keep``: to be called when a query's result is written."""
    for path in [p for p in _scratch[since:] if p not in keep]:
        delete(spark, path)
        _scratch.remove(path)
