"""Prefix scans against plain loops, with nulls, ties, hot keys over many tasks, and empty tables."""

import random

import pytest
from lexmill.operators.scan import scan
from pyspark.sql import functions as F


def plain(rows, key):
    """(n, fill, sum, prev, following) of each row (k, o, v) in order."""
    out, last = [], object()
    for i, (k, _, v) in enumerate(rows):
        kk = k if key else 0
        if i == 0 or kk != last:
            n, fill, total = 0, None, 0
        n, fill, total = n + 1, v if v is not None else fill, total + (v or 0)
        prev = rows[i - 1][2] if n > 1 else None
        nxt = rows[i + 1][2] if i + 1 < len(rows) and (not key or rows[i + 1][0] == k) else None
        out.append((n, fill, total, prev, nxt))
        last = kk
    return out


@pytest.mark.parametrize("parts", [1, 7, 40])
@pytest.mark.parametrize("batch", [3, 10_000])
def test_scan(spark, parts, batch):
    rng = random.Random(parts * batch)
    rows = [(rng.choice([None, 1, 2, 2, 2, 2, 2, 2, 5]), i, rng.choice([None, None, None, i, -i])) for i in range(400)]
    d = spark.createDataFrame(rows, "k int, o int, v int").repartition(5)
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for c, v in zip(old, (str(parts), str(batch), "false"), strict=True):
            spark.conf.set(c, v)
        for within in ([], ["k"]):
            order = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0) if within else (), r[1]))
            got = scan(d, [F.col("o")], within, "n", fills={"fill": "v"}, sums={"total": "v"}, prev={"p": "v"}, following={"f": "v"})
            found = {r.o: (r.n, r.fill, r.total, r.p, r.f) for r in got.collect()}
            assert [found[o] for _, o, _ in order] == plain(order, bool(within))
            assert got.columns == ["k", "o", "v", "n", "fill", "total", "p", "f"]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_ties_and_empty(spark):
    d = spark.createDataFrame([("a", 1)] * 9 + [(None, None)] * 3, "k string, o int")
    got = scan(d, [F.col("o")], ["k"])
    assert sorted((r.k or "", r.seq) for r in got.collect()) == [("", 1), ("", 2), ("", 3), *(("a", i) for i in range(1, 10))]
    assert scan(d.limit(0), [F.col("o")], ["k"], fills={"f": "o"}, following={"g": "o"}).collect() == []
    assert "Window" not in got._jdf.queryExecution().toString()
