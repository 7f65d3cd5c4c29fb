"""Token groups, links and their counts against plain loops over the libraries' own tokens; spans and their table."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from lexmill.llm import alignment, shingles, spans, tokens

tokenizers = pytest.importorskip("public_tokenizers")
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
TEXTS = [
    "The café's 12,345 words", None, "", " ", "\n", "a▁b", "x  \n\n y\t z   ", "<|endoftext|> hi <s>", "漢字漢字\U00020000 é ", "the the the", "the the the",
    "no break 　 wide", "q" * 5000, "Ab9x" * 900, " ".join(f"w{i % 700} x{i}" for i in range(4000)), "end \x1c ctrl\x85", "tail \n",
]


def brute():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizers.path(A))
    tok.encode_special_tokens = True
    sp = SentencePieceProcessor(model_file=tokenizers.path(B))
    of_a = alignment.byte_level(tok.get_vocab(), tok.get_vocab_size())
    of_b = alignment.piece_bytes([sp.id_to_piece(i) for i in range(sp.get_piece_size())])
    out = []
    for t in TEXTS:
        a, b = (tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)) if t else ([], [])
        if any(b"".join(table[i] for i in ids) != b" " + t.encode() for ids, table in ((a, of_a), (b, of_b)) if t):
            a = b = []
        groups, x, y, i, j = [], 0, 0, 0, 0
        ga, gb = [], []
        while i < len(a) or j < len(b):
            if x <= y and i < len(a) and (x < y or not ga):
                ga.append(a[i])
                x += len(of_a[a[i]])
                i += 1
            else:
                gb.append(b[j])
                y += len(of_b[b[j]])
                j += 1
            if x == y:
                groups.append((ga, gb))
                ga, gb = [], []
        out.append((a, b, groups))
    return out


def wanted():
    found = brute()
    links = [Counter((p, q) for ga, gb in g for p in ga for q in gb) for _, _, g in found]
    count = Counter(pair for x in links for pair in x)
    most = {}
    for (p, _), n in count.items():
        most[p] = max(most.get(p, 0), n)
    rows = []
    for (a, b, g), x in zip(found, links, strict=True):
        line = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        best = sum(n for (p, q), n in x.items() if count[p, q] == most[p])
        rows.append((len(a), len(b), len(g), sum(x.values()), best, sum(n * count[k] for k, n in x.items()), hashlib.sha256(line.encode()).hexdigest() if line else ""))
    return rows, count, found


@pytest.fixture(scope="module")
def docs(spark):
    ids = [None if i == 4 else min(i, 12) for i in range(len(TEXTS))]
    return spark.createDataFrame([(i, t, 1, 2, "p") for i, t in zip(ids, TEXTS, strict=True)], "doc_id long, text string, block long, n_a int, pairs string")


@pytest.mark.parametrize(("block", "many"), [(1 << 24, 1 << 14), (40, 1)])
def test_cross_alignment(spark, docs, monkeypatch, block, many):
    rows, count, found = wanted()
    ids = [r.doc_id for r in docs.collect()]
    key = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    want = sorted(((i, *r) for i, r in zip(ids, rows, strict=True)), key=key)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    got = alignment.op11(docs)
    assert sorted(map(tuple, got.collect()), key=key) == want
    aligner = alignment.kept(tokenizers.path(A), tokenizers.path(B))
    monkeypatch.setattr(alignment, "MANY", many)
    for t, (_, _, g) in zip(TEXTS, found, strict=True):
        keys, n = aligner.aligned([(t or "").encode()]).links()
        mask = (1 << alignment.ID_BITS) - 1
        assert {(k >> alignment.ID_BITS, k & mask): m for k, m in zip(keys.tolist(), n.tolist(), strict=True)} == Counter((p, q) for ga, gb in g for p in ga for q in gb)


def test_groups_and_counts(spark, docs):
    _, count, found = wanted()
    got = alignment.token_groups(docs, tokenizers.path(A), tokenizers.path(B)).collect()
    assert [(r.a_ids, r.b_ids) for r in got] == [(a, b) for a, b, _ in found]
    assert [list(zip(r.n_a, r.n_b, strict=True)) for r in got] == [[(len(x), len(y)) for x, y in g] for _, _, g in found]
    pairs = alignment.pair_counts(docs, tokenizers.path(A), tokenizers.path(B)).collect()
    assert {(r.a_id, r.b_id): r.n_docs for r in pairs} == count


def test_empty_table(docs):
    none = docs.limit(0)
    assert alignment.op11(none).collect() == []
    assert alignment.token_groups(none, tokenizers.path(A), tokenizers.path(B)).collect() == []
    assert alignment.pair_counts(none, tokenizers.path(A), tokenizers.path(B)).collect() == []


def thue_morse(n, a, b):
    return "".join((a, b)[bin(i).count("1") & 1] for i in range(n))


@pytest.mark.parametrize("n", [16, 1024, 2048, 8192])
def test_patterned_words_are_told_apart(n):
    one, two = (thue_morse(n, *x) for x in ("ab", "ba"))
    data = np.frombuffer((one + two).encode(), np.uint8)
    h = spans.span_hashes(data, np.array([0, n]), np.array([n, 2 * n]))
    assert h[0] != h[1]
    sets, sizes = shingles.shingle_sets([one.encode(), two.encode()])
    assert sizes.tolist() == [1, 1] and sets[0] != sets[1]
    path = tokenizers.path(A)
    texts = ["x " + one, "x " + two]
    tok = tokens.load(path)
    assert tokens.Counter(path).count([x.encode() for x in texts]) == [len(tok.encode(x).ids) for x in texts]
    path = tokenizers.path("word_bpe_49k.json")
    tok = tokens.load(path)
    got = [x.tolist() for x in tokens.Encoder(path).encode([x.encode() for x in texts])]
    assert got == [tok.encode(x, add_special_tokens=False).ids for x in texts]


def test_a_memo_never_returns_another_span(monkeypatch):
    monkeypatch.setattr(spans, "_hashed", lambda words: words[0] & np.uint64(3))  # nearly every hash collides
    memo, rng = spans.Memo(np.uint32, 4, 64), np.random.default_rng(0)
    for _ in range(30):
        words = [bytes(rng.integers(97, 100, rng.integers(0, 30)).tolist()) for _ in range(40)]
        end = np.cumsum([len(w) for w in words])
        start = end - [len(w) for w in words]
        data = np.frombuffer(b"".join(words), np.uint8)

        def encode(at, start=start, end=end, data=data):
            ids = [data[a:b].tolist() for a, b in zip(start[at], end[at], strict=True)]
            n = np.array([len(x) for x in ids])
            return np.array([i for x in ids for i in x], np.uint32), np.cumsum(n) - n, n

        ids, n = memo.runs(data, start, end, encode)
        assert ids.tolist() == data.tolist() and n.tolist() == [len(w) for w in words]
