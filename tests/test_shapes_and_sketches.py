"""Logs of several shapes, and sketches that merge, with nulls and nothing."""

import random

from lexmill.sources import shapes
from lexmill.operators import sketches
from pyspark.sql import functions as F


def test_lines_of_several_shapes(spark, tmp_path):
    lines = ['{"article_path":"a","gap_terms":["x"],"keywords":["y"]}', '{"article_path":"b","concepts":"one","functions":[1,null,"z"]}', '{"article_path":"c","concepts":{"no":1}}', "[1]", "null", "3", "{broken", "", " \t ", '{"concepts":["no path"]}']
    (tmp_path / "log").write_text("\n".join(lines))
    rows = shapes.read_variant_lines(spark, str(tmp_path))
    assert rows.count() == 8 and [r.line for r in rows.filter("malformed").collect()] == ["{broken"]
    got = {r.article_path: r for r in shapes.log_rows(rows).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"].gap_terms == ["x", "y"] and got["a"].concepts is None
    assert got["b"].concepts == ["one"] and got["b"].functions == ["1", None, "z"] and got["c"].concepts is None
    assert shapes.common_shape(rows.filter("line like '{%' and not malformed").filter(F.col("line").contains("path"))).startswith("OBJECT<article_path: ")
    assert rows.limit(0).select(shapes.shape(F.col("v"))).collect() == []


def test_sketches(spark):
    rng = random.Random(2)
    rows = [(f"2024-01-{1 + i % 20:02d}" if i % 50 else None, rng.randrange(3000), rng.gauss(0, 1) if i % 9 else None) for i in range(20_000)]
    d = spark.createDataFrame(rows, "day string, who int, x double").withColumn("day", F.to_date("day"))
    stored = sketches.daily_sketches(d, F.col("day"), "who", "x")
    assert stored.count() == 20
    ranges = spark.createDataFrame([("all", "2024-01-01", "2024-01-31"), ("one", "2024-01-03", "2024-01-03"), ("none", "2025-01-01", "2025-01-02")], "name string, first string, last string")
    got = {r.name: r for r in sketches.merged(stored, ranges.selectExpr("name", "date(first) first", "date(last) last")).collect()}
    assert set(got) == {"all", "one"} and got["all"].days == 20 and got["one"].days == 1
    for name, keep in (("all", lambda day: day), ("one", lambda day: day == "2024-01-03")):
        mine = [r for r in rows if r[0] and keep(r[0])]
        who, xs = {r[1] for r in mine}, sorted(r[2] for r in mine if r[2] is not None)
        assert got[name].n == len(mine) and got[name].distinct_low <= len(who) <= got[name].distinct_high
        assert got[name].low <= xs[len(xs) // 2] <= got[name].high
