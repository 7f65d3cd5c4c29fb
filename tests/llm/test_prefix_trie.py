"""The trie of conversations against a plain one, with nulls, ties, repeated rows, absent bases and hot prefixes."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from lexmill.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, key string, n string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def made():
    rng, rows = random.Random(3), []
    ids = [*range(0, 70), 100, 104, 119, -20, -3, 1005, 1007]
    for c in ids:
        if c == 40:
            continue  # an absent base
        for t in range(rng.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "hi there", None, "", "a  b\tc", "ü 漢字"])))
    for c in range(200, 260):  # many equal conversations, and prefixes that many share
        rows += [(c, t, "user", f"turn {t} of all") for t in range(3 + (c % 3 == 0) * 4)]
    rows += [(300, None, "x", "y"), (300, None, None, "z z"), (300, 1, "b", "tie"), (300, 1, "a", "tie"), (300, 1, "a", "tie"), (None, 1, "user", "no one's"), (None, None, None, None)]
    rows += [(400, i, "user", f"long {i % 7}") for i in range(900)] + [(420, i, "user", f"long {i % 7}") for i in range(900)]
    rng.shuffle(rows)
    return rows


def plain(rows):
    of = {}
    for c, t, r, x in rows:
        if c is not None:
            of.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    of = {c: [(r, x) for _, r, x in sorted(v)] for c, v in of.items()}
    whole = {}
    for c, own in of.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = tuple(of.get(base, [])[:h] + own[h:])
    members = {}
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves.setdefault(path, 0)
        leaves[path] = leaves[path] or 1
        words = len(WORD.findall(path[-1][1])) if path else 0
        saved[path] = saved.get(path, 0) + (len(members[path]) - 1) * words
        if path:
            up = path[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[path]
            saved[up] = saved.get(up, 0) + saved[path]
    out = []
    for path, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(whole[c]) == len(path)))
        up = min(members[path[:-1]]) if path else None
        out.append((min(m), len(path), up, len(m), children.get(path, 0), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("chunk", [4096, 7])
def test_prefix_trie(spark, monkeypatch, chunk):
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    rows = made()
    d = spark.createDataFrame([(*r, 1, "k", "n") for r in rows], SCHEMA)
    got = prefix_trie.op13(d)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = sorted((tuple(r[n] for n in names) for r in got.collect()), key=lambda r: (r[1], r[0]))
    assert got.columns == names and found == plain(rows)
    if chunk == 4096:
        c = duckdb.connect()
        c.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
        short = [r for r in rows if r[0] not in (400, 420)]
        c.executemany("insert into conversations values (?, ?, ?, ?)", short)
        r = c.execute(f"select {', '.join(names)} from ({prefix_trie.ORACLE}) order by depth, conv_id").fetchall()
        assert [tuple(x) for x in r] == plain(short)


def test_single_and_empty(spark):
    d = spark.createDataFrame([(5, 1, "u", "a b", 1, "", "")], SCHEMA)
    assert sorted((r.depth, r.conv_id, r.n_leaves, r.n_children) for r in prefix_trie.op13(d).collect()) == sorted((x[1], x[0], x[5], x[4]) for x in plain([(5, 1, "u", "a b")]))
    assert prefix_trie.op13(d.limit(0)).collect() == []
    assert prefix_trie.op13(spark.createDataFrame([(None, 1, "u", "a", 1, "", "")], SCHEMA)).collect() == []
