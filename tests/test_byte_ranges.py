"""Elements by byte ranges against whole files, and sinks that change at once, with tasks and jobs that fail."""

import os
import random

import pytest
from lexmill.sources import byte_ranges, versions, xml_nodes
from pyspark.sql import functions as F


def made(rng):
    out = [b"<?xml version='1.0'?><TEI>"]
    for i in range(rng.randint(0, 12)):
        inner = b"".join(rng.choice([b"<cb:div><cb:mulu level=\"3\">x</cb:mulu></cb:div>", b"text ", b"<cb:divx/>", "漢字".encode(), b"<cb:mulu n='1' level=\"2\">again</cb:mulu>"]) for _ in range(rng.randint(0, 9)))
        out.append(b"<cb:div type='a'><p>%d</p><cb:mulu %slevel=\"2\">h</cb:mulu>%s%s" % (i, rng.choice([b"", b"n='7' "]), inner, rng.choice([b"</cb:div>", b"</cb:div>", b""])))
        out.append(b"pad " * rng.randint(0, 30))
    return b"".join(out)


@pytest.mark.parametrize("split", [1, 7, 64, 1000, 1 << 20])
def test_ranges_equal_whole_files(tmp_path, split):
    rng = random.Random(split)
    for n in range(30 if split > 1 else 3):
        data = b"" if n == 0 else b'<cb:mulu level="2">no division</cb:mulu>' if n == 1 else made(rng)
        f = tmp_path / f"{n}.xml"
        f.write_bytes(data)
        found, elements = [], byte_ranges.Elements()
        for a in range(0, len(data), split):
            with byte_ranges.file_system(str(f))[0].open_input_file(str(f)) as stream:
                w = byte_ranges.Window(stream, len(data), a, min(a + split, len(data)))
                found += elements.of_range(w, a, min(a + split, len(data)))
        assert found == xml_nodes.byte_ranges(data)


def test_source(spark, tmp_path):
    rng = random.Random(9)
    for n in range(5):
        (tmp_path / f"{n}.xml").write_bytes(made(rng) * 40)
    (tmp_path / "_hidden.xml").write_bytes(made(rng))
    whole = {(r.path.removeprefix("file:"), r.byte_start, r.byte_end, bytes(r.chunk)) for r in xml_nodes.articles(xml_nodes.read_documents(spark, str(tmp_path))).collect()}
    whole = {x for x in whole if "_hidden" not in x[0]}
    for split in (700, 1 << 26):
        got = byte_ranges.read_elements(spark, str(tmp_path), split)
        assert {(r.path, r.byte_start, r.byte_end, bytes(r.chunk)) for r in got.collect()} == whole
    one = got.filter((F.col("path") == str(tmp_path / "3.xml")) & (F.col("byte_start") >= 2000))
    assert {(r.path, r.byte_start) for r in one.collect()} == {(p, a) for p, a, _, _ in whole if p.endswith("3.xml") and a >= 2000}
    reader = byte_ranges._Reader({"path": str(tmp_path), "splitbytes": "700"})
    list(reader.pushFilters([byte_ranges.EqualTo(("path",), str(tmp_path / "3.xml")), byte_ranges.GreaterThanOrEqual(("byte_start",), 2000), byte_ranges.LessThan(("byte_end",), 5000)]))
    assert {(p.path, p.a) for p in reader.partitions()} == {(str(tmp_path / "3.xml"), a) for a in range(1400, 5000, 700)}
    (tmp_path / "large").mkdir()
    (tmp_path / "large" / "x.xml").write_bytes(b'<cb:div><cb:mulu level="2">h</cb:mulu>some text of an article</cb:div>\n' * 20_000)
    found = byte_ranges.read_elements(spark, str(tmp_path / "large"), 40_000)
    size = (tmp_path / "large" / "x.xml").stat().st_size
    assert found.count() == 20_000 and found.agg(F.sum("bytes_read")).first()[0] < 2 * size and found.rdd.getNumPartitions() == -(-size // 40_000)
    got = byte_ranges.read_elements(spark, str(tmp_path), 1 << 20, suffix="3.xml")
    whole = {x for x in whole if x[0].endswith("3.xml")}
    back = byte_ranges.chunks_of(got.select("path", "byte_start", "byte_end"))
    assert {(r.path, r.byte_start, r.byte_end, bytes(r.chunk)) for r in back.collect()} == whole
    none = spark.createDataFrame([(None, 1, 2), (str(tmp_path / "absent"), 0, 1), (str(tmp_path / "0.xml"), 10**9, 10**9 + 5), (str(tmp_path / "0.xml"), 5, 3)], "path string, byte_start long, byte_end long")
    assert [r.chunk if r.chunk is None else bytes(r.chunk) for r in byte_ranges.chunks_of(none.coalesce(1)).orderBy("byte_start").collect()] == [None, None, b"", b""]
    (tmp_path / "empty").mkdir()
    assert byte_ranges.read_elements(spark, str(tmp_path / "empty")).collect() == []


def test_many_small_ranges_share_tasks(spark, tmp_path):
    """Ranges stay as they are asked for, but more than some hundred of them are no tasks of their own."""
    rng = random.Random(4)
    for n in range(3):
        (tmp_path / f"{n}.xml").write_bytes(made(rng) * 60)
    parts = byte_ranges._Reader({"path": str(tmp_path), "splitbytes": "50"}).partitions()
    every = [(r.path, r.a, r.b) for p in parts for r in (p, *p.then)]
    assert every == [(p, a, min(a + 50, size)) for p, size in byte_ranges.files_below(str(tmp_path)) for a in range(0, size, 50)]
    assert len(every) > 1000 and len(parts) <= byte_ranges.MANY_RANGES
    got = {tuple(r) for r in byte_ranges.read_elements(spark, str(tmp_path), 50).select("path", "byte_start", "byte_end").collect()}
    assert got == {(str(tmp_path / f"{n}.xml"), *x) for n in range(3) for x in xml_nodes.byte_ranges((tmp_path / f"{n}.xml").read_bytes())}
    large = byte_ranges._Reader({"path": str(tmp_path), "splitbytes": str(1 << 26)}).partitions()
    assert len(large) == 3 and not any(p.then for p in large)


def articles(spark, n, tag):
    return spark.range(n).repartition(3).select(F.concat(F.lit(f"{tag}/"), F.col("id")).alias("name"), F.concat(F.lit("text\n"), F.col("id")).alias("text"), F.lit("- t").alias("toc"), F.lit(None).cast("string").alias("toc_json"))


def test_article_files_change_at_once(spark, tmp_path):
    path = str(tmp_path / "sink")
    assert versions.read_article_files(spark, path).collect() == []
    versions.write_article_files(articles(spark, 7, "a"), path)
    first = sorted((r.name, r.text, r.toc, r.toc_json) for r in versions.read_article_files(spark, path).collect())
    assert first == sorted((f"a/{i}", f"text\n{i}", "- t", "") for i in range(7))
    fails = articles(spark, 50, "b").withColumn("text", F.when(F.col("name") == "b/33", F.raise_error(F.lit("killed"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="killed"):  # a task that dies after others have written
        versions.write_article_files(fails, path)
    assert sorted((r.name, r.text, r.toc, r.toc_json) for r in versions.read_article_files(spark, path).collect()) == first
    writer = versions._ArticleWriter(path)  # a job that is killed before its commit
    os.makedirs(f"{path}/versions/{writer.version}/0-0")
    assert versions.read_article_files(spark, path).count() == 7
    versions.write_article_files(articles(spark, 3, "c"), path)
    assert versions.read_article_files(spark, path).count() == 3
    assert len(versions.vacuum(path)) >= 2 and versions.read_article_files(spark, path).count() == 3
    versions.write_article_files(articles(spark, 0, "d"), path)
    assert versions.read_article_files(spark, path).collect() == []


def test_log_is_replaced_at_once(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "log"), "a int, b string"
    assert versions.read_log_version(spark, path, schema).collect() == []
    versions.replace_log(spark.createDataFrame([(1, "x"), (2, None)], schema), path)
    old = versions.read_log_version(spark, path, schema)
    versions.replace_log(old.filter("a = 1"), path)  # read from itself
    assert [tuple(r) for r in versions.read_log_version(spark, path, schema).collect()] == [(1, "x")]
    monkeypatch.setattr(versions, "_point", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):  # killed between the rows and the pointer
        versions.replace_log(spark.createDataFrame([(9, "z")], schema), path)
    assert [tuple(r) for r in versions.read_log_version(spark, path, schema).collect()] == [(1, "x")]
