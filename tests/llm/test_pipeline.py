"""The pipeline against a brute-force version of its stages, one after the other."""

import hashlib
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
from lexmill.llm import quality, tokens

tokenizers = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(9)
    words = "stone river morning letter window garden paper winter bread candle forest harbor island meadow".split()
    rows = []
    for i in range(90):
        text = " ".join(rng.choice(words, int(rng.integers(30, 60)))) + "\nthe same closing line"
        rows.append((i, " ".join(w + "$$%" for w in text.split()) if i % 5 == 4 else text, "en", f"s{i % 4 if i % 4 else 0}", len(text)))
    rows += [(90 + i, rows[i][1] + " more", "en", "s1", 1) for i in (0, 1, 2)] + [(95, rows[3][1], "en", None, 1), (96, None, "en", "s2", 0), (97, "", None, "s2", 0)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 4), 0) for i in range(90)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [r for r in docs.orderBy("doc_id").collect() if model.scores([(r.text or "").encode()])[0] >= 0.7]
    assert len(rows) < docs.count() and sum(r.doc_id % 5 != 4 for r in rows if r.doc_id < 90) >= 70
    line_key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
    first = {}
    for r in rows:
        for x in (r.text or "").split("\n"):
            first.setdefault(line_key(x), r.doc_id)
    cut = [(r.doc_id, "\n".join(x for x in (r.text or "").split("\n") if len(line_key(x)) < 10 or first[line_key(x)] == r.doc_id), r.source) for r in rows]

    def grams(t):
        w = WORD.findall(t.lower())
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    group = {}
    sets = [grams(t) for _, t, _ in cut]
    for i, s in enumerate(sets):
        near = [group[j] for j in range(i) if s and sets[j] and 100 * len(s & sets[j]) >= 75 * len(s | sets[j])]
        group[i] = min(near, default=i)
        for j in range(i):
            if group[j] in near:
                group[j] = group[i]
    kept = [cut[i] for i in range(len(cut)) if group[i] == i]

    found = docs
    results = []
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, found, folder)
        results.append(found)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert found.columns == docs.columns
    text = lambda df: sorted((r.doc_id, r.text or "") for r in df.collect())
    assert text(results[0]) == sorted((r.doc_id, r.text or "") for r in rows)
    assert text(results[1]) == sorted((i, t) for i, t, _ in cut)
    assert text(results[2]) == sorted((i, t) for i, t, _ in kept)
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted({s for *_, s in kept}, key=lambda s: (s is None, s or "")))}
    size = {i: len(WORD.findall(t)) for i, t, _ in kept}
    sums = {s: sum(size[i] for i, _, x in kept if x == s) for s in weights}
    target, open_, left = {}, set(sums), sum(sums.values())
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 3 * sums[s]}
        if not full:
            target |= share
            break
        target |= {s: 3 * sums[s] for s in full}
        left -= sum(3 * sums[s] for s in full)
        open_ -= full
    queue = []
    for s in sums:
        ahead = 0
        for i in sorted((i for i, _, x in kept if x == s and size[i]), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i)) * 3:
            ahead += size[i]
            queue.append((ahead / target[s], hashlib.md5(str(i).encode()).hexdigest(), i))
    times, used = {}, 0
    for _, _, i in sorted(queue):
        used += size[i]
        if used > sum(sums.values()):
            break
        times[i] = times.get(i, 0) + 1
    texts = {i: t for i, t, _ in kept}
    mixed = sorted((i, texts[i]) for i, n in times.items() for _ in range(n))
    assert text(results[3]) == mixed
    tok = tokens.load(tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in mixed:
        ids = [*tok.encode(t, add_special_tokens=False).ids, 1]
        want += [(i, k, 4096 * k, len(p := ids[4096 * k : 4096 * k + 4096]), zlib.crc32(np.array(p, "<u4").tobytes())) for k in range(-(-len(ids) // 4096))]
    last = corpus_pipeline.run(spark, folder).collect()
    assert sorted(tuple(r)[:5] for r in last) == sorted(want)
    assert len({(r.sequence_id, r.offset) for r in last}) == len(last)


def test_stages_on_odd_tables(spark, tmp_path):
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns; then no rows at all."""
    long = "\n".join(f"a rather long line of ordinary words number {i} with some more of them" for i in range(6000))
    prose = "the quiet river went past the old mill and nobody in the village ever spoke of it again"
    rows = [(1, prose, "en", "a", 1), (1, prose, "en", "a", 1), (1, "quite another text of seven words here", "en", None, 1), (2, None, "en", "a", 0), (3, "", None, "b", 0), (None, prose + " at all", "en", "b", 1), (None, None, None, None, None), (4, long, "en", "c", 1), (5, long, "en", "c", 1)]
    extra = [(*r, "s", 7, "m", 1, "t", "k") for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, n_lines int, marks string, size int, tie string, `key` string"
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (2, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    for name, part in (("all", extra), ("none", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(part, schema).write.parquet(f"{folder}/documents.parquet")
        (labels if part else labels.limit(0)).write.parquet(f"{folder}/labels.parquet")
        docs = found = spark.read.parquet(f"{folder}/documents.parquet")
        n = []
        for stage_name, stage in corpus_pipeline.STAGES:
            # all documents are good here, so that every stage meets them
            found = found if stage_name == "quality_network" and part else stage(spark, found, folder)
            n.append(found.count())
            if stage is not corpus_pipeline.STAGES[-1][1]:
                assert found.schema == docs.schema or found.dtypes == docs.dtypes
                if part:
                    assert {(r.score, r.n_lines, r.marks, r["size"], r.tie, r.key) for r in found.collect()} == {("s", 7, "m", 1, "t", "k")}
        assert (n[:3] == [9, 9, 7] and n[3] > 0 and n[4] >= n[3]) if part else n == [0] * 5, n
        kept = corpus_pipeline.STAGES[0][1](spark, docs, folder)
        assert kept.dtypes == docs.dtypes and kept.count() <= len(part)
        assert corpus_pipeline.run(spark, folder).count() >= 0
