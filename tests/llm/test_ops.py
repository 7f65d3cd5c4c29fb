"""Corpus operators against brute force, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from lexmill.llm import embedding_join, fingerprints, graph, license_scan, line_dedup, mixing, ngram_join, packing, quality, shingles, tokens, url_filter
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 700} x{i}" for i in range(9000))
COPY = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
ROWS = [
    (1, COPY, "b"), (2, COPY.upper(), "b"), (3, COPY + " more", None), (4, None, None), (5, "", "a"), (6, "  \n \t", "a"), (7, LONG, "a"), (8, LONG, "a"),
    (9, "a b", "c"), (9, "a b", "c"), (9, "A  B", "c"), (None, COPY, "c"), (None, None, None), (12, "line of ten chars\nx\n Line of TEN chars \nx", "c"),
    (13, "line of ten chars\nline of ten chars\nown", "d"), (14, "é ß 漢字 \U00020000 end.", "d"),
]
SCHEMA = "doc_id long, text string, source string, n long, line string, rank int, size int, taken string, score string, key string"


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with columns that clash with names the operators use."""
    return spark.createDataFrame([(i, t, s, 1, "x", 2, 3, "y", "z", "k") for i, t, s in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def test_line_dedup(docs, none):
    def line_key(x):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for i, t, _ in ROWS:
        for x in (t or "").split("\n"):
            if len(line_key(x)) >= 10:
                holders.setdefault(line_key(x), set()).add(math.inf if i is None else i)
    want = []
    for i, t, _ in ROWS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(h := holders.get(line_key(x), ())) < 2 or min(h) == (math.inf if i is None else i)]
        want.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    assert sorted(map(tuple, line_dedup.op3(docs).collect()), key=key) == sorted(want, key=key)
    assert line_dedup.op3(none).collect() == []
    assert line_dedup.without_lines(docs).columns == docs.columns


def test_line_dedup_keeps_columns_and_handles_long_documents(spark):
    long = "\n".join(f"a line of some length number {i}" for i in range(40_000))
    rows = [(1, long, 7, 8), (2, long + "\nand one of its own", 7, 8), (None, long, 7, 8), (None, "another text, alone", 7, 8), (2, "a line of some length number 5\nx", 7, 8)]
    d = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, n_dropped int")
    got = {(r.doc_id, r.text) for r in line_dedup.without_lines(d).collect()}
    assert got == {(1, long), (2, "and one of its own"), (None, ""), (None, "another text, alone"), (2, "x")}
    assert line_dedup.without_lines(d).select("n_lines", "n_dropped").distinct().collect() == [(7, 8)]
    assert sorted(r.n_dropped for r in line_dedup.op3(d).collect()) == [0, 0, 1, 40_000, 40_000]


def brute_sets():
    out = []
    for _, t, _ in ROWS:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_ngram_join(docs, none, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "SMALL", block)
    sets, ids = brute_sets(), [r[0] for r in ROWS]
    link = [[i != j and bool(a) and 100 * len(a & b) >= 75 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    root = graph.local_roots(len(sets), *map(np.array, zip(*[(i, j) for i in range(len(sets)) for j in range(len(sets)) if link[i][j]], strict=True)))
    want = []
    for i, s in enumerate(sets):
        mine = [ids[j] for j in range(len(sets)) if root[j] == root[i] and ids[j] is not None]
        want.append((ids[i], len(s), (min(mine) if mine else None) if s else ids[i], sum(link[i])))
    assert sorted(map(tuple, ngram_join.op2(docs).collect()), key=key) == sorted(want, key=key)
    if block > 40:
        assert ngram_join.op2(none).collect() == []
        kept = ngram_join.one_of_each(docs)
        assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == [1, 4, 5, 6, 7, 9, 12, 13, 14]
        assert [r.text for r in kept.filter("doc_id is null").collect()] == [None] and kept.columns == docs.columns
        twice = docs.select("doc_id", "text").union(docs.limit(1).selectExpr("1L", "'quite another text of more than five words'"))
        twice = twice.union(docs.limit(2).selectExpr("cast(null as long)", "'words that no other row has at all'"))
        assert sorted((r.doc_id or 0, r.text[:5]) for r in ngram_join.one_of_each(twice).filter("text > '' and (doc_id = 1 or doc_id is null)").collect()) == [(0, "words"), (1, "One t"), (1, "quite")]


@pytest.mark.parametrize("piece", [3, 100_000])
def test_meeting_finds_every_similar_pair(piece):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 60, 40)
    sets = [np.unique(np.concatenate([base[rng.random(40) < 0.9], rng.integers(100, 130, rng.integers(0, 6))])).astype(np.uint64) for _ in range(60)]
    cls = np.zeros(1 << ngram_join.BUCKET_BITS, np.uint8)
    col, node, n, pos = [], [], [], []
    for i, s in enumerate(sets):
        first = s[np.argsort(ngram_join.column_order(s, cls))][: len(s) - -(-75 * len(s) // 100) + 1]
        col += first.tolist()
        node += [i] * len(first)
        n += [len(s)] * len(first)
        pos += range(len(first))
    rows = np.array([col, node, n, pos]).T[np.lexsort((n, col))]
    meeting, edges = ngram_join.Meeting(), []
    for at in range(0, len(rows), piece):  # columns go on from one batch to the next
        edges += meeting.feed(*rows[at : at + piece].T)
    e = np.array(edges).reshape(-1, 2)
    root = graph.local_roots(len(sets), e[:, 0], e[:, 1])
    a, b = ngram_join.block_links(sets, np.zeros(len(sets), int), False)
    want = {(i, j) for i in range(60) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
    assert {(max(x), min(x)) for x in zip(a.tolist(), b.tolist(), strict=True)} == want and want
    assert all(root[i] == root[j] for i, j in want)


def test_components(spark):
    rng = np.random.default_rng(2)
    e = rng.integers(0, 300, (220, 2))
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(e.tolist(), "a long, b long"))[1].collect()}
    root = graph.local_roots(300, e[:, 0].copy(), e[:, 1].copy())
    assert all(got.get(i, i) == root[i] for i in range(300))
    assert graph.components(spark.createDataFrame([], "a long, b long"))[1].collect() == []


@pytest.mark.parametrize("part", [16_384, 7])
def test_embedding_join(spark, monkeypatch, part):
    monkeypatch.setattr(embedding_join, "PART_VALUES", 32 * part)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((12, 32))
    rows = [(i, (base[i % 12] * (1 + i) + (0.15 * rng.standard_normal(32) if i % 3 else 0)).tolist(), 0) for i in range(60)]
    rows += [(60, None, 0), (61, [0.0] * 32, 1), (62, [math.nan] * 32, 1), (63, [None, *[1.0] * 31], 1), (64, [math.inf] * 32, 1), (65, [], 1), (66, [1.0, 2.0], 2), (67, [2.0, 4.0], 3)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_join.op1(v).collect()}
    x = np.array([r[1] for r in rows[:60]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a = (x @ x.T >= 0.95) & ~np.eye(60, dtype=bool)
    root = graph.local_roots(60, *np.nonzero(a))
    assert all(got[i] == (int(a[i].sum()), int(root[i]), bool(root[i] == i)) for i in range(60)) and a.sum()
    assert all(got[i] == (0, i, True) for i in range(60, 66)) and got[66] == (1, 66, True) and got[67] == (1, 66, False)
    assert embedding_join.op1(v.limit(0)).collect() == []
    whole = [(i, [int(y) for y in rng.integers(-9, 9, 16)]) for i in range(20)] + [(20, [2] * 16), (21, [3] * 16), (22, None), (23, [None] * 16)]
    for kind in ("int", "long", "decimal(9,2)"):
        got = embedding_join.op1(spark.createDataFrame(whole, "vec_id long, embedding array<long>").selectExpr("vec_id", f"cast(embedding as array<{kind}>) embedding"))
        assert {r.vec_id: r.n_links for r in got.collect()} == {i: int(i in (20, 21)) for i in range(24)}


@pytest.mark.parametrize("parts", [8, 0.001])
def test_embedding_join_counts_repeated_rows_and_null_ids(spark, monkeypatch, parts):
    monkeypatch.setattr(embedding_join, "PARTS", parts)  # few parts: the grid cuts more dimensions
    monkeypatch.setattr(embedding_join, "PART_VALUES", 24 * 16)
    near, far = [1.0, 2.0, 3.0] * 8, [3.0, -2.0, 1.0] * 8
    rows = [(1, near, "a"), (1, near, "b"), (2, [*near[:-1], 3.1], "a"), (None, near, "a"), (3, far, "b"), (1, far, "b"), (5, [2 * x for x in far], "c"), (None, None, "c"), (7, [-0.0, *near[1:]], "c"), (8, [0.0, *near[1:]], "c")]
    rows += [(100 + i, near, "c") for i in range(50)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, linked string").withColumn("root", F.lit(1)).withColumn("node", F.lit("x"))
    got = sorted((tuple(r) for r in embedding_join.op1(v).collect()), key=key)
    want, x = [], np.array([r[1] or far for r in rows]).astype(np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    fine = np.array([r[0] is not None for r in rows])
    a = (x @ x.T >= 0.95) & fine & fine[:, None] & ~np.eye(len(rows), dtype=bool)
    for i, r in enumerate(rows):
        mine = {i}
        while True:
            more = mine | {int(j) for m in mine for j in np.flatnonzero(a[m])}
            if more == mine:
                break
            mine = more
        c = min((rows[j][0] for j in mine if rows[j][0] is not None), default=None)
        want.append((r[0], int(a[i].sum()), c, None if r[0] is None else r[0] == c))
    assert got == sorted(want, key=key) and want[0][1] == 54


def test_token_counts(docs, none):
    tok = tokens.load(tokenizers.path("byte_bpe_50k.json"))
    want = [(i, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t, _ in ROWS]
    assert sorted(map(tuple, tokens.op4(docs).collect()), key=key) == sorted(want, key=key)
    assert tokens.op4(none).collect() == []


ODD = [
    "It's a TEST, isn't it... yes. ÉCOLE, Straße. a,b c.d e!, f!. <|ENDOFTEXT|> <|endoftext|>x", "İstanbul ΣΑΣ. x\x1cy z\x85w", "a　b c. d,\te.\x0bf", "é É, KK. ǅx, ﬁ. ½. 5, 5. x5. ", "", "   ",
    "ab.\rcd.\n\nef,", "the.", "the, ", "a  b   c\n\n d", "a\n \nb <|endoftext|> x", "tab\tx　y", "é\n\n\n  é ", "x" * 200_000, "a b c " * 30_000,
]


def test_segments_change_no_token():
    word, byte = tokenizers.path("word_bpe_49k.json"), tokenizers.path("byte_bpe_50k.json")
    w, b = tokens.load(word), tokens.load(byte)
    raw = [x.encode() for x in ODD]
    for bits in (1, 12):  # a table of two places forgets nearly everything
        assert [x.tolist() for x in tokens.Encoder(word, bits).encode(raw)] == [w.encode(x, add_special_tokens=False).ids for x in ODD]
        assert tokens.Counter(byte, bits).count(raw) == [len(b.encode(x, add_special_tokens=False).ids) for x in ODD]
    assert "".join(tokens.long_pieces(ODD[-1], 100)) == ODD[-1]


def test_fingerprints(docs, none, spark):
    got = fingerprints.op5(docs).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t, _ in order]
    want = []
    for n, (i, _, _) in enumerate(order):
        t, u = texts[n], texts[(n + 1) % len(texts)]
        h = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[: len(t) - h] + u[:h]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(want, key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[7].fingerprint == by[8].fingerprint and by[7].near_next == 1.0 and by[4].fingerprint == ""
    edited = spark.createDataFrame([(n, t[: len(t) - len(t) // 2] + texts[(n + 1) % len(texts)][: len(t) // 2]) for n, t in enumerate(texts)], "n int, text string")
    own = {r.n: r.f for r in edited.select("n", fingerprints.digest(fingerprints.marks(F.col("text"))).alias("f")).collect()}
    plain = {r.n: r.f for r in spark.createDataFrame(list(enumerate(texts)), "n int, text string").select("n", fingerprints.digest(fingerprints.marks(F.col("text"))).alias("f")).collect()}

    def like(a, b):
        a, b = set(a.split()), set(b.split())
        return len(a & b) / len(a | b) if a | b else 1.0

    want = [(order[n][0], plain[n], own[n], like(plain[n], own[n]), like(plain[n], plain[(n + 1) % len(texts)])) for n in range(len(texts))]
    assert sorted(((r.doc_id, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in got), key=key) == sorted(want, key=key)
    assert fingerprints.op5(none).collect() == []
    one = spark.createDataFrame([(1, "only a few words here and there")], "doc_id long, text string")
    assert fingerprints.op5(one).first().near_next == 1.0


def test_winnowing_rule_and_guarantee(spark):
    """Every mark is the rightmost least gram of some window, and every window has one."""
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["a", "b", "c"], rng.integers(0, 60))) for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    grams = F.transform(F.sequence(F.lit(0), F.greatest(F.size(F.split("text", " ")) - 5, F.lit(0))), lambda i: F.shiftrightunsigned(F.xxhash64(F.transform(F.slice(F.split("text", " "), i + 1, 5), lambda x: F.xxhash64(x))), 31))
    for r in df.select("text", grams.alias("g"), fingerprints.marks(F.col("text")).alias("m"), fingerprints.mark_positions(fingerprints.marks(F.col("text"))).alias("p")).collect():
        if not r.text:
            assert r.m == []
            continue
        want = []
        for a in range(max(1, len(r.g) - 7)):
            window = r.g[a : a + 8]
            at = a + max(i for i, x in enumerate(window) if x == min(window))
            if at not in want:
                want.append(at)
        assert r.p == want and [(x.hash % 2**64) >> 31 for x in r.m] == [r.g[i] for i in want]


def test_mixing(docs, none, spark):
    got = mixing.op7(docs).collect()
    sizes = sorted(((i, len(WORD.findall(t or ""))) for i, t, _ in ROWS), key=key)
    assert sorted(((r.doc_id, r["size"]) for r in got), key=key) == sizes
    total, targets = sum(s for _, s in sizes), {r.target: r.source_size for r in got}
    sources = mixing.mix(docs).groupBy("source").agg(F.sum("size").alias("s"), F.max("target").alias("t"), F.sum("taken").alias("k"), F.max("size").alias("m")).collect()
    assert abs(sum(r.t for r in sources) - total) < 1e-6 * total and all(r.t <= 3 * r.s + 1e-9 for r in sources) and targets
    assert all(r.taken <= 3 * r["size"] and (not r["size"] or r.taken % r["size"] == 0) for r in got)
    assert sum(r.k for r in sources) <= total
    assert mixing.op7(none).collect() == []
    again = mixing.op7(docs.repartition(3)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, again), key=key)
    assert mixing.mixed_documents(docs).agg(F.sum(mixing.n_words(F.col("text")))).first()[0] == sum(r.taken for r in got)
    many = spark.createDataFrame([(i, "w " * (1 + i % 9), f"s{min(i % 7, 3)}") for i in range(3000)], "doc_id long, text string, source string")
    for r in mixing.mix(many).groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("k")).collect():
        assert abs(r.k - r.t) <= 30


def test_packing(docs, none):
    tok = tokens.load(tokenizers.path("word_bpe_49k.json"))
    got = packing.op8(docs).collect()
    want = []
    for i, t, _ in ROWS:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(i, k, 4096 * k, len(p := ids[4096 * k : 4096 * k + 4096]), zlib.crc32(np.array(p, "<u4").tobytes())) for k in range(-(-len(ids) // 4096))]
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.op8(none).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plans_fill_sequences(seed):
    """Every rank has one place, no sequence overflows, and few are used."""
    rng = np.random.default_rng(seed)
    cap = 128
    lengths = rng.choice(np.arange(1, cap + 1), rng.integers(1, 900), p=np.arange(cap, 0, -1) / np.arange(cap, 0, -1).sum())
    counts = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True), strict=True)}
    large = {k: v for k, v in counts.items() if k > 16}
    places, n_large = packing.plan_large(large, cap)
    flat = np.repeat(sorted(large, reverse=True), [large[k] for k in sorted(large, reverse=True)])
    fill = np.zeros(n_large, int)
    if len(flat):
        seq, _, slot = places.find(np.arange(len(flat)))
        np.add.at(fill, seq, flat)
        assert len(set(zip(seq.tolist(), slot.tolist(), strict=True))) == len(flat)
    assert (fill <= cap).all() and (fill > 0).all()
    rooms = {int(k): int(v) for k, v in zip(*np.unique(cap - fill, return_counts=True), strict=True)}
    plan, new = packing.plan_small({k: v for k, v in counts.items() if k <= 16}, rooms, cap)
    used = {}
    for length, n in counts.items():
        if length <= 16:
            rank, room, _ = plan[length].find(np.arange(n))
            for x in zip(room.tolist(), rank.tolist(), strict=True):
                used[x] = used.get(x, 0) + length
    assert all(v <= room and rank < (new if room == cap else rooms[room]) for (room, rank), v in used.items())
    assert n_large + new <= 1.1 * math.ceil(lengths.sum() / cap) + sum(v for k, v in counts.items() if k > cap // 2) * 0.5 + 2


def test_quality(spark, docs, none):
    rng = np.random.default_rng(0)
    words = ["stone", "river", "morning", "letter", "window", "garden", "paper", "winter"]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(160)]
    rows = [(i, " ".join(w + "$$%" for w in t.split()) if i % 3 == 0 else t) for i, t in enumerate(texts)]
    many = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(160)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.op9(many, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 3 != 0) for r in held]) > 0.9
    assert [tuple(r) for r in quality.op9(many, labels).orderBy("doc_id").collect()] == sorted(map(tuple, got))
    odd = quality.op9(docs, labels).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.score <= 1 for r in odd)
    assert quality.op9(none, labels.limit(0)).collect() == []
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.schema["score"] == docs.schema["score"] and {r.score for r in kept.collect()} <= {"z"}


def test_scores_are_the_plain_forward_pass(monkeypatch):
    """Every text's score by loops over bytes, filters and chunks, and the same with pieces of a few halves."""
    rng = np.random.default_rng(8)
    m = quality.ByteConv.fresh(3)
    m.bias[:] = 0.1 * rng.standard_normal(quality.FILTERS)
    texts = [b"", b"a", b"short text", bytes(rng.integers(1, 256, 127).tolist()), bytes(rng.integers(1, 256, 1500).tolist()), b"ab " * 200]
    want = []
    for t in texts:
        n = max(2, -(-(len(t) + quality.WIDTH) // quality.HALF))
        padded = t + bytes(n * quality.HALF + quality.WIDTH - len(t))
        answers = np.zeros((n * quality.HALF, quality.FILTERS))
        for i in range(len(t)):
            x = np.concatenate([m.embed[b] for b in padded[i : i + quality.WIDTH]])
            answers[i] = np.maximum(x.astype(float) @ m.filters + m.bias, 0)
        chunks = np.array([answers[h * quality.HALF : (h + 2) * quality.HALF].max(axis=0) for h in range(n - 1)])
        want.append(1 / (1 + np.exp(-(chunks.mean(axis=0) @ m.out_mean + chunks.max(axis=0) @ m.out_max + m.out_bias[0]))))
    assert np.allclose(m.scores(texts), want, atol=1e-5)
    monkeypatch.setattr(quality, "GROUP_BYTES", 3 * quality.HALF)
    assert np.allclose(m.scores(texts), want, atol=1e-5)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(6)
    m = quality.ByteConv.fresh(4)
    texts, y = [bytes(rng.integers(1, 200, int(n)).tolist()) for n in (40, 300, 700)], np.array([1, 0, 1], np.float32)

    def loss():
        p = m.scores(texts)
        return float(-np.log(np.where(y > 0, p, 1 - p)).sum())

    g = m._gradients(texts, y)
    for name, at in (("filters", (3, 5)), ("bias", (2,)), ("out_mean", (7,)), ("out_max", (1,)), ("out_bias", (0,)), ("embed", (77, 1))):
        w = getattr(m, name)
        kept, step = w[at], 2e-3
        w[at] = kept + step
        up = loss()
        w[at] = kept - step
        assert abs((up - loss()) / (2 * step) - g[name][at]) < 0.02 + 0.1 * abs(g[name][at]), name
        w[at] = kept


def test_scores_cover_the_whole_text():
    m = quality.ByteConv.fresh()
    long = (b"quiet river " * 60_000)[:700_001]
    alone = m.scores([long])[0]
    assert abs(m.scores([b"", long, b"x" * 300])[1] - alone) < 1e-9
    assert abs(m.scores([long[:-40] + b"%$#@!*&^" * 5])[0] - alone) > 0


def test_url_filter(spark):
    urls = [
        "http://A.example.NET/en/x?q", "https://example.com/de/1", "http://x.org/fr/2", "http://x.org/en/2", "net", None, "ftp://net", "http://net/", "http://notnet.com/", "http://b.example.com/de", "://h#f",
    ]
    bad = [(100 + i, f"http://h.info/bad/{i}.html", 1) for i in range(40)] + [(200 + i, f"http://h.info/good/{i}.html", 0) for i in range(40)]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(i, u, "x") for i, u, _ in bad], "page_id long, url string, template string")
    labels = spark.createDataFrame([(i, b) for i, _, b in bad if i % 2] + [(None, 1), (0, None)], "page_id long, bad int")
    got = {r.page_id: r for r in url_filter.url_filter(pages, labels).collect()}
    assert [got[i].rule for i in range(len(urls))] == ["example.net/en/", "example.com/de/", "org/fr/", None, None, None, None, "net/", None, None, None]
    assert [got[i].verdict for i in (0, 1, 2, 7)] == ["allow", "block", "allow", "block"]
    assert (got[0].host, got[0].path, got[4].host, got[5].host, got[10].host) == ("a.example.net", "/en/x", "", "", "h")
    assert all(got[i].verdict == "block" for i in range(100, 140)) and all(got[i].verdict == "allow" for i in range(200, 240))
    assert url_filter.url_filter(pages.limit(0), labels).collect() == []


def test_url_templates(spark):
    """Deep branches, thin siblings, lone branches, path ends, repeated and null ids, very long urls."""
    deep = [(i, f"http://d.info/en/shop/all/pills/x{i}", 1) for i in range(40)] + [(100 + i, f"http://d.info/en/shop/all/books/x{i}", 0) for i in range(40)]
    thin = [(200 + i, f"http://t.info/bad/{i}", 1) for i in range(40)] + [(300 + i, f"http://t.info/good/{i}", 0) for i in range(9)] + [(310 + i, f"http://t.info/more/{i}", None) for i in range(60)]
    only = [(400 + i, f"http://h.com/only/{i}", i % 2) for i in range(90)] + [(500 + i, "http://h.com/only", 0) for i in range(30)]
    odd = [(600, "http://l.info/" + "a/" * 3000 + "b" * 100_000, 1), (601, "http://l.info/" + "a/" * 3000, 0), (None, "http://d.info/en/shop/all/pills/y", None), (700, "http://d.info/en/shop/all/books/y", None), (105, "http://d.info/en/shop/all/books/x5", None)]
    rows = deep + thin + only + odd
    pages = spark.createDataFrame([(i, u, "s") for i, u, _ in rows], "page_id long, url string, segs string")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows if b is not None], "page_id long, bad int")
    got = url_filter.url_filter(pages, labels).collect()
    assert len(got) == len(rows)
    by = {(r.page_id, r.path): r for r in got}
    verdict = lambda i, p: (by[(i, p)].template, by[(i, p)].verdict)
    assert verdict(5, "/en/shop/all/pills/x5") == ("d.info/en/shop/all/pills/**", "block") and verdict(105, "/en/shop/all/books/x5") == ("d.info/en/shop/all/books/**", "allow")
    assert by[(None, "/en/shop/all/pills/y")].verdict == "block" and by[(700, "/en/shop/all/books/y")].verdict == "allow"
    assert verdict(203, "/bad/3") == ("t.info/bad/**", "block") and verdict(303, "/good/3")[1] == "allow" and verdict(312, "/more/2")[1] == "allow"
    assert verdict(404, "/only/4") == ("h.com/only/#/", "allow") and verdict(500, "/only") == ("h.com/only/", "allow")


def test_license_scan(spark, docs, none):
    model = license_scan.trained()
    right = [model.families[model.probabilities(t).argmax()] == f for i, (t, f) in enumerate(license_scan.notices()) if i % 3 == 2]
    assert np.mean(right) > 0.9
    texts = ["Intro\nReleased under the MIT License.", "Licensed under CC BY-NC 4.0.", "The driver lost the license after the accident.", "nothing here", None, "", "x\nLicensed under the Apache License, Version 2.0.\nReleased under the MIT License."]
    d = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, family string")
    got = {r.doc_id: r for r in license_scan.op6(d).collect()}
    assert [got[i].licence for i in range(6)] == ["mit", "cc-by-nc", "unknown", None, None, None] and got[6].licence in ("apache", "mit") and got[6].n_candidates == 2
    for r in license_scan.paragraphs(d).collect():
        line = texts[r.doc_id].split("\n")[r.position]
        p = model.probabilities(line)
        assert r.family == model.families[p.argmax()] and abs(r.confidence - p.max()) < 1e-9
    assert len(license_scan.op6(docs).collect()) == len(ROWS) and license_scan.op6(none).collect() == []


def test_license_texts_without_names(spark):
    """A licence's own paragraph on one line is told by its text, each family's."""
    texts = [(f, t) for f, ts in license_scan.TEXTS.items() for t in ts]
    d = spark.createDataFrame([(i, f"Some words.\n{t}\nMore.") for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.licence, r.position) for r in license_scan.op6(d).collect()}
    assert [got[i] for i in range(len(texts))] == [(f, 1) for f, _ in texts] and {"isc", "epl", "unlicense"} <= {f for f, _ in texts}
    other = "Permission is hereby granted, free of charge, to any visitor holding a ticket for the museum."
    assert license_scan.op6(spark.createDataFrame([(1, other)], "doc_id long, text string")).first().licence == "unknown"


def test_license_notices_over_lines_and_short(spark):
    """Wrapped notices, bare names, notices deep in one long line; prose with the same words tells nothing."""
    body = license_scan.TEXTS["mit"][0].split()
    warranty = license_scan.TEXTS["bsd"][5].split()
    prose = " ".join(f"the river ran by the library and word{i} went with it" for i in range(60))
    wrap = lambda w, n, mark="": "\n".join(mark + " ".join(w[i : i + n]) for i in range(0, len(w), n))
    cases = [
        ("This is free text under the GNU General\nPublic License version 3.", "gpl"), ("Released under MIT.", "mit"), ("Apache-2.0", "apache"), ("x\n\nBSD-3-Clause\n", "bsd"), ("MIT", "mit"),
        (f"int x;\n{wrap(body, 9, '// ')}\nint y;", "mit"), (wrap(body, 1), "mit"), (f"{prose}\n{wrap(warranty, 1)}\n{prose}", "bsd"), (f"{prose} {' '.join(body)} {prose}", "mit"),
        ("Copyright (c) 2020, Someone\nAll rights reserved.\n\n" + wrap(license_scan.TEXTS["bsd"][0].split(), 5), "bsd"), (f"{prose}\nThis is under the GNU General\nPublic License version 3.\n{prose}", "gpl"),
        ("Er kam mit dem Zug.", None), ("Apache helicopters flew.\nThe eclipse began.", None), ("GNU General\n\nPublic License", "unknown"),
    ]
    d = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.op6(d).collect()}
    assert [got[i].licence for i in range(len(cases))] == [f for _, f in cases]
    assert got[0].n_candidates == 3 and got[3].position == 2 and got[5].position <= 1
    assert max(2 * len(license_scan.words_of(t)) for ts in license_scan.TEXTS.values() for t in ts) <= license_scan.WINDOWS[-1] // 2


def test_license_scan_returns_every_family(spark):
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    texts = [f"x\n{mit}\n{apache}\n{mit}", f"{mit}\ncode\nThe text is under Creative Commons\nAttribution 4.0", "The driver lost the license after the accident.", "nothing", None, "All rights reserved.\n" + mit, "Licensed under MIT or Apache-2.0.", "x\nunder MIT or Apache 2.0", f"{mit} {apache}"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.op6(d).collect()}
    assert [tuple(x) for x in got[0].licences] == [("apache", 2), ("mit", 1), ("mit", 3)] and got[0].licence in ("apache", "mit")
    assert [x.family for x in got[1].licences] == ["cc-by", "mit"] and got[1].licences[1].position == 0
    assert [got[i].licences for i in (2, 3, 4)] == [[], [], []]
    assert [tuple(x) for x in got[5].licences] == [("mit", 1), ("proprietary", 0)] and got[5].licence == "mit"
    assert [tuple(x) for x in got[6].licences] == [("apache", 0), ("mit", 0)] and got[6].n_candidates == 1
    assert [tuple(x) for x in got[7].licences] == [("apache", 1), ("mit", 1)] and got[7].n_candidates == 1
    assert [tuple(x) for x in got[8].licences] == [("apache", 0), ("mit", 0)]


def test_shingles_match_brute_force():
    h, n = shingles.shingle_sets([(t or "").encode() for _, t, _ in ROWS])
    sets = brute_sets()
    assert n.tolist() == [len(s) for s in sets] and len(np.unique(h)) == len(set().union(*sets))
