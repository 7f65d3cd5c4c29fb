"""Large dictionaries against plain loops: greedy matches, and the longest contained name."""

import random
import time

import pytest
from lexmill.operators import dictionary, matching


def plain(text, terms):
    out, i, most = [], 0, max(map(len, terms), default=0)
    while i < len(text):
        for n in range(min(most, len(text) - i), 0, -1):
            if text[i : i + n] in terms:
                out.append((i, text[i : i + n]))
                i += n
                break
        else:
            i += 1
    return out


@pytest.mark.parametrize("seed", range(8))
def test_trie(seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abc漢\U00020000") for _ in range(n))
    terms = {word(rng.randint(1, 6)) for _ in range(rng.choice([0, 1, 40, 300]))}
    trie = dictionary.Trie.of(list(terms))
    for _ in range(30):
        text = word(rng.randint(0, 80))
        assert [(p, text[p : p + n]) for p, n in trie.greedy(dictionary.codes(text))] == plain(text, terms)


def test_hits_of_a_large_dictionary(spark, monkeypatch):
    rng = random.Random(1)
    terms = {"".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(100_000)}
    lines = [None, "", "abc"] + ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 400))) for _ in range(200)]
    d = spark.createDataFrame([(i, x, "s") for i, x in enumerate(lines)], "no int, line string, kept string")
    began = time.time()
    trie = dictionary.Trie.of(list(terms))
    built = time.time() - began
    monkeypatch.setattr(dictionary, "CHARS", 1000)
    got = matching.positions(d, list(terms), ["no"]).collect()
    want = [(i, k, s, p) for i, x in enumerate(lines) for k, (p, s) in enumerate(plain(x or "", terms))]
    assert sorted((r.no, r.ordinal, r.surface, r.position) for r in got) == sorted(want) and got[0].kept == "s"
    text = dictionary.codes("".join(rng.choice("abcdefgh ") for _ in range(1_000_000)))
    began = time.time()
    trie.greedy(text)
    print(f"{len(terms)} terms: built in {built:.2f} s, {trie.nbytes >> 20} MB, a million characters in {time.time() - began:.2f} s")
    assert built < 20 and time.time() - began < 20
    monkeypatch.setattr(dictionary, "MOST_BYTES", 10)
    with pytest.raises(ValueError, match="exceeds"):
        dictionary.trie_hits(d, list(terms))


@pytest.mark.parametrize("small", [1_000_000, 0])
@pytest.mark.parametrize("fold", [False, True])
def test_longest_contained(spark, monkeypatch, small, fold):
    monkeypatch.setattr(dictionary, "SMALL_INDEX", small)
    rng = random.Random(small + fold)
    word = lambda n: "".join(rng.choice("abAB.\n") for _ in range(n))
    names = [(word(rng.randint(1, 8)), f"c{i}", rng.randint(0, 5) * 1000 + i) for i in range(60)] + [("", "none", 1), (None, "none", 2), ("absent name", "x", 3)]
    rows = [(rng.choice([None, *range(40)]), word(rng.randint(0, 30))) for _ in range(60)] + [(50, None), (51, "")]
    got = dictionary.longest_contained(spark.createDataFrame(rows, "k int, t string"), "k", "t", spark.createDataFrame(names, "alias string, canonical string, ord int"), fold)
    low = (lambda x: x.lower()) if fold else (lambda x: x)
    want = {}
    for k, t in rows:
        for a, c, o in names:
            if a and t and low(a) in low(t):
                want[k] = min(want.get(k, (0, 10**9, "", "")), (-len(a), o, a, c))
    assert {(r.k, r.alias, r.canonical) for r in got.collect()} == {(k, a, c) for k, (_, _, a, c) in want.items()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    empty = dictionary.longest_contained(spark.createDataFrame(rows, "k int, t string"), "k", "t", spark.createDataFrame([], "alias string, canonical string, ord int"))
    assert empty.columns == ["k", "alias", "canonical"] and empty.collect() == []


def test_names_that_are_alike(spark):
    """Every name's grams of four characters are in every text; only names that a text holds are laid out, long ones by their beginning."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    rows = [(i, word(400)) for i in range(100)]
    names = [(word(rng.choice([12, 14, 40, 60])), f"c{i}", i) for i in range(2000)] + [(rows[7][1][30:80], "long", -1), (rows[8][1][:15], "short", -2)]
    texts, named = spark.createDataFrame(rows, "__k int, __t string"), spark.createDataFrame(names, "alias string, canonical string, ord int")
    held = dictionary._filter(named.select("alias", dictionary.F.left("alias", dictionary.F.lit(32)).alias("gram")), 16)
    sizes = sorted({min(32, len(a)) for a, *_ in names})
    met = {(r["__k"], r.gram) for r in dictionary.grams_met(texts, sizes, held, 16).collect()}
    true = {(k, a[:32]) for k, t in rows for a, *_ in names if a[:32] in t}
    every = sum(len({t[i : i + n] for i in range(len(t) - n + 1)}) for _, t in rows for n in sizes)
    assert true <= met and len(met - true) < 0.02 * every
    got = dictionary.longest_contained(texts, "__k", "__t", named)
    want = {k: min((-len(a), o, c) for a, c, o in names if a in t) for k, t in rows if any(a in t for a, *_ in names)}
    assert {r["__k"]: r.canonical for r in got.collect()} == {k: c for k, (*_, c) in want.items()} and want[7][2] == "long"


@pytest.mark.parametrize("most", [0, 10_000])
def test_hits_are_counted_where_they_are(spark, monkeypatch, most):
    rng = random.Random(2)
    terms = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(40)}
    lines = [None, "", "xyz"] + ["".join(rng.choice("abcd ") for _ in range(rng.randint(0, 300))) for _ in range(50)]
    d = spark.createDataFrame(list(enumerate(lines)), "no int, line string")
    monkeypatch.setattr(matching, "MOST_ALTERNATIVES", most)
    got = sorted((r.no, r.surface, r.n) for r in matching.hit_counts(d, list(terms)).collect())
    want = {}
    for i, x in enumerate(lines):
        for _, s in plain(x or "", terms):
            want[i, s] = want.get((i, s), 0) + 1
    assert got == sorted((*k, n) for k, n in want.items())


def test_hits_leave_run_by_run(spark, monkeypatch):
    d = spark.createDataFrame([(0, "")], "no int, line string")
    monkeypatch.setattr(dictionary, "CHARS", 100)
    monkeypatch.setattr(type(d), "mapInArrow", lambda self, run, schema: run)
    batch = dictionary.pa.RecordBatch.from_pydict({"no": list(range(200)), "line": ["ab" * 25] * 200})
    sent = list(dictionary.trie_hits(d, ["ab"])(iter([batch])))
    assert sum(b.num_rows for b in sent) == 5000 and max(b.num_rows for b in sent) <= 75
