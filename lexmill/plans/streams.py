"""Queries of streams that run over several batches and a restart, into files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.plans.catalogue import query
from lexmill.session import shared_folder, table
from lexmill.streaming import stateful


@query(
    """SELECT event_type AS dimension, 't' || k % 40 AS term, unnest(range(5, n + 1, 5))::BIGINT AS articles
    FROM (SELECT event_type, k % 40 AS k, count(DISTINCT user_id) AS n FROM (SELECT event_type, user_id, (props->>'k')::INT AS k FROM events) GROUP BY ALL)"""
)
def reviews_in_state(spark: SparkSession, d: str) -> DataFrame:
    """Reviews that fall due at every fifth user of a term, over many batches, with a restart halfway."""
    events = table(spark, d, "events").select("event_id", "event_type", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    rows = events.select("event_id", F.col("event_type").alias("dimension"), F.concat(F.lit("t"), F.col("k") % 40).alias("term"), F.col("user_id").cast("string").alias("article"))
    base = shared_folder(spark, "reviews")
    for half in range(2):
        rows.filter(F.col("event_id") % 2 == half).repartition(4, "event_id").write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/in")
        stateful.run_to_end(stateful.reviews_due(source), f"{base}/out", f"{base}/state")
    return spark.read.schema("dimension string, term string, articles long").parquet(f"{base}/out")


#: Events come in six batches by time; every tenth is two batches late. The last batch has nothing to say but the time.
_BATCHES, _GAP, _LATE = 6, "2 hours", "1 day"
_BATCH = f"least((event_id * {_BATCHES}) // (SELECT max(event_id) + 1 FROM events) + CASE WHEN event_id % 10 = 0 THEN 2 ELSE 0 END, {_BATCHES})::INT"


@query(
    f"""WITH RECURSIVE e AS (SELECT event_id, user_id, ts, {_BATCH} AS b FROM events),
    w AS (SELECT b.b, (SELECT max(ts) - INTERVAL 1 DAY FROM e x WHERE x.b < b.b) AS mark FROM (SELECT DISTINCT b FROM e) b),
    k AS (SELECT e.*, mark IS NULL OR ts + INTERVAL 2 HOUR > date_trunc('milliseconds', mark) AS kept FROM e JOIN w USING (b)),
    g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM k WHERE kept),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM g)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS "end", count(*)::BIGINT AS n, FALSE AS late, NULL::BIGINT AS event_id FROM s GROUP BY user_id, no
    UNION ALL SELECT user_id, ts, NULL, 1, TRUE, event_id FROM k WHERE NOT kept"""
)
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of users in a stream whose rows come out of order, and by name each row that came too late for its session."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts")
    most = events.agg(F.max("event_id").alias("m"), F.max("ts").alias("t")).first()
    batch = F.least(F.floor(F.col("event_id") * _BATCHES / F.lit((most["m"] or 0) + 1)) + F.when(F.col("event_id") % 10 == 0, 2).otherwise(0), F.lit(_BATCHES)).cast("int")
    base = shared_folder(spark, "sessions")
    for b in range(_BATCHES + 1):  # one write a batch, so that files have an order in time
        events.filter(batch == b).coalesce(1).write.mode("append").parquet(f"{base}/in")
    last = spark.sql("SELECT -1L AS event_id, cast(NULL AS long) AS user_id, :t + INTERVAL 30 DAYS AS ts", args={"t": most["t"]})
    last.coalesce(1).write.mode("append").parquet(f"{base}/in")
    source = spark.readStream.schema("event_id long, user_id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    found = stateful.sessions(source, "ts", "user_id", _GAP, _LATE, {"ids": F.collect_list("event_id")})
    # with one stateful operator rows are late by the watermark of their own batch
    with stateful.settings(spark, spark__sql__streaming__statefulOperator__allowMultiple="false", spark__sql__shuffle__partitions="4"):
        stateful.run_to_end(found, f"{base}/out", f"{base}/state")
    out = spark.read.schema(found.schema).parquet(f"{base}/out").filter("user_id is not null")
    late = stateful.kept_and_late(events, out, "event_id")
    return out.select("user_id", "start", "end", "n", F.lit(False).alias("late"), F.lit(None).cast("long").alias("event_id")).unionByName(
        late.select("user_id", F.col("ts").alias("start"), F.lit(None).cast("timestamp").alias("end"), F.lit(1).cast("long").alias("n"), F.lit(True).alias("late"), "event_id")
    )
