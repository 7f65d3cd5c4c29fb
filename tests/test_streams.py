"""Streams with state: batches cut anywhere, restarts, nulls and repeats; sessions with rows that come too late."""

import datetime as dt
import random

import pytest
from lexmill.streaming import stateful
from pyspark.sql import functions as F


@pytest.mark.parametrize("files", [1, 3])
def test_reviews_come_once_however_files_are_cut(spark, tmp_path, files):
    rng, provider = random.Random(files), spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    rows = [(rng.choice(["c", "d", None]), rng.choice(["x", "y", None]), rng.choice([None, *(f"a{i}" for i in range(23))])) for _ in range(400)]
    d = spark.createDataFrame(rows, "dimension string, term string, article string")
    of = {}
    for k in rows:
        if None not in k:
            of.setdefault(k[:2], set()).add(k[2])
    want = sorted((*k, n) for k, v in of.items() for n in range(5, len(v) + 1, 5))
    for part in range(3):  # three runs on one checkpoint
        d.filter(F.abs(F.hash("article", "term", "dimension")) % 3 == part).repartition(files).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        stateful.run_to_end(stateful.reviews_due(source), f"{tmp_path}/out", f"{tmp_path}/state")
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, got.collect())) == want
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == provider


def test_sessions_and_late_rows(spark, tmp_path):
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    batches = [[(1, 7, 0), (2, 7, 1), (3, 8, 5)], [(4, 7, 30), (5, 8, 6.5)], [(6, 7, 1.5), (7, 8, 29), (8, None, 30)], [(9, 9, 200)], [(10, 7, 150)], [(11, 0, 400)]]
    every = [r for b in batches for r in b]
    schema = "id long, u long, ts timestamp"
    for b in batches:
        spark.createDataFrame([(i, u, at(h)) for i, u, h in b], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    found = stateful.sessions(source, "ts", "u", "2 hours", "10 hours", {"ids": F.collect_list("id")})
    with stateful.settings(spark, spark__sql__streaming__statefulOperator__allowMultiple="false"):
        q = stateful.run_to_end(found, f"{tmp_path}/out", f"{tmp_path}/state")
    out = spark.read.schema(found.schema).parquet(f"{tmp_path}/out")
    got = sorted((r.u or -1, r.n, sorted(r.ids)) for r in out.collect())
    # 3 and 5 are one session, 6 comes when hour 20 has passed, 10 when hour 190 has; 11 is still open
    assert got == [(-1, 1, [8]), (7, 1, [4]), (7, 2, [1, 2]), (8, 1, [7]), (8, 2, [3, 5]), (9, 1, [9])]
    late = stateful.kept_and_late(spark.createDataFrame([(i, u, at(h)) for i, u, h in every if i != 11], schema), out, "id")
    assert sorted(r.id for r in late.collect()) == [6, 10] and stateful.dropped_rows(q) == 2
