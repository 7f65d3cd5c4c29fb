"""Alignment of two tokenizers: byte ranges where tokens of both end together, and how often ids meet in them.

Every byte of a text gets a label: no token ends here, one of the first, one of the second, or
one of both. A regular expression scans the labels for spans that end at a both-label; the
labels of a span count its tokens. Documents are read once; what the corpus knows of a pair of
ids comes back to them by blocks.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import released, stored, utf8
from lexmill.llm.spans import Memo
from lexmill.llm.tokens import _ODD_ASCII, _ODD_SPACE, groups, load, long_pieces

#: Labels: A ends, B ends; both is their sum.
A_END, B_END, BOTH = 1, 2, 3
_SPAN = re.compile(rb"[\x00-\x02]*\x03")
#: Bits of an id in a key (document, A id, B id).
ID_BITS = 20
#: UTF-8 bytes of a block of documents, about; a longer text is a block of its own.
BLOCK_BYTES = 1 << 24
#: Groups with more links than this are counted by their distinct ids.
MANY = 1 << 14
#: Pairs and documents that travel in one row or batch.
PAIRS, ROWS = 1 << 15, 1 << 10
#: Segments that are encoded as one string.
TOGETHER = 64


def byte_level(vocabulary: dict[str, int], size: int) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary: printable bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    out = [b""] * size
    for piece, i in vocabulary.items():
        out[i] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
    return out


def piece_bytes(pieces: list[str]) -> list[bytes]:
    """The bytes of sentencepiece pieces: U+2581 is a space, <0xHH> a byte."""
    return [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]


class _Side:
    """Ids of one tokenizer for segments that begin with white space, remembered by their bytes."""

    def __init__(self, table: list[bytes]):
        self.sizes = np.array([len(x) for x in table], np.int64)
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.begin = np.cumsum(self.sizes) - self.sizes
        width = len(str(len(table)))
        self.digits = np.array([list(str(i).encode().ljust(width, b"\0")) for i in range(len(table))], np.uint8).reshape(len(table), width)
        self.memo = Memo(np.uint32, 19, 1 << 21)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with white space."""
        raise NotImplementedError

    def whole(self, text: str) -> np.ndarray:
        """Ids of a text of any kind, a space before it."""
        raise NotImplementedError

    def _new(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As Memo.runs() asks: runs of segments go through the library as one string and are cut where each ends."""
        begin, n = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        rest = np.array([i for i, x in enumerate(texts) if x[-1] not in b" \n"], np.int64)
        runs = ["".join([texts[i].decode() for i in rest[k : k + TOGETHER].tolist()]) for k in range(0, len(rest), TOGETHER)]
        ids = np.fromiter(itertools.chain.from_iterable(self.encode(runs)), np.uint32)
        ends, want = np.cumsum(self.sizes[ids]), np.cumsum([len(texts[i]) for i in rest.tolist()], dtype=np.int64)
        at = np.searchsorted(ends, want)
        met = at < len(ends)
        met[met] = ends[at[met]] == want[met]
        met[1:] &= met[:-1].copy()  # behind a missed end every place is in doubt
        begin[rest], n[rest] = np.concatenate([[0], at[:-1] + 1]) if len(at) else at, np.diff(at, prepend=-1)
        alone = [*(i for i, x in enumerate(texts) if x[-1] in b" \n"), *rest[~met].tolist()]
        more = self.encode([texts[i].decode() for i in alone])
        n[alone] = [len(x) for x in more]
        begin[alone] = len(ids) + np.cumsum(n[alone]) - n[alone]
        return np.concatenate([ids, *(np.asarray(x, np.uint32) for x in more)]), begin, n

    def runs(self, data: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.memo.runs(np.frombuffer(data, np.uint8), start, end, lambda at: self._new([data[a:b] for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]))

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a run of tokens."""
        n = self.sizes[ids]
        upto = np.cumsum(n)
        return self.flat[np.repeat(self.begin[ids] - (upto - n), n) + np.arange(int(upto[-1]) if len(upto) else 0)]


class _SideA(_Side):
    """A byte-level BPE of a .json file; special strings inside texts are plain text."""

    def __init__(self, path: str):
        self.tok = load(path)
        self.tok.encode_special_tokens = True
        super().__init__(byte_level(self.tok.get_vocab(), self.tok.get_vocab_size()))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def whole(self, text: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint32), *(np.asarray(x, np.uint32) for x in self.encode(list(long_pieces(" " + text))))])


class _SideB(_Side):
    """A sentencepiece model that puts a space before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        super().__init__(piece_bytes(pieces))
        #: no piece holds white space behind another character, so white space always begins a token
        self.cuts = not any(re.search("[^▁\n][▁\n]", p) for p in pieces)
        self.before = len(self.model.encode("a"))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x[self.before :] for x in self.model.encode(["a" + x for x in texts], num_threads=1)]

    def whole(self, text: str) -> np.ndarray:
        if not self.cuts:
            return np.asarray(self.model.encode(text), np.uint32)
        first, *rest = long_pieces(" " + text)
        return np.concatenate([np.asarray(x, np.uint32) for x in [self.model.encode(first[1:]), *self.encode(rest)]])


@dataclass
class Aligned:
    """Token groups of texts one after the other; tokens are ids in order, offsets count from the first text."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    last_a: np.ndarray  #: whether an A token ends its group
    last_b: np.ndarray
    group_a: np.ndarray  #: the group of each A token
    group_b: np.ndarray
    n_a: np.ndarray  #: A tokens of each group
    n_b: np.ndarray
    text: np.ndarray  #: the text of each group
    texts: int

    def each(self, of_groups: np.ndarray) -> np.ndarray:
        """Sums over each text's groups."""
        return np.bincount(self.text, of_groups, self.texts).astype(np.int64)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Ascending keys (text, A id, B id) of the distinct linked pairs of each text, and how many token pairs each stands for."""
        shift = np.uint64(ID_BITS)
        many = self.n_a * self.n_b > MANY
        reps = np.where(many, 0, self.n_b)[self.group_a]
        upto = np.cumsum(reps)
        at = np.repeat((np.cumsum(self.n_b) - self.n_b)[self.group_a] - (upto - reps), reps) + np.arange(int(upto[-1]) if len(upto) else 0)
        head = (self.text[self.group_a].astype(np.uint64) << shift | self.ids_a.astype(np.uint64)) << shift
        keys, n = np.unique(np.repeat(head, reps) | self.ids_b[at].astype(np.uint64), return_counts=True)
        for g in np.flatnonzero(many).tolist():  # ids are counted before they are paired
            a, m = np.unique(head[self.group_a == g], return_counts=True)
            b, k = np.unique(self.ids_b[self.group_b == g].astype(np.uint64), return_counts=True)
            keys, where = np.unique(np.concatenate([keys, (a[:, None] | b[None, :]).ravel()]), return_inverse=True)
            n = np.bincount(where, np.concatenate([n, np.outer(m, k).ravel()])).astype(np.int64)
        return keys, n

    def written(self, digits_a: np.ndarray, digits_b: np.ndarray) -> list[bytes]:
        """Groups as ``a1,a2|b1;a3|b2,b3``, one line for each text."""
        width = max(digits_a.shape[1], digits_b.shape[1])
        rows = np.zeros((len(self.ids_a) + len(self.ids_b), width + 1), np.uint8)
        at_a = np.arange(len(self.ids_a)) + (np.cumsum(self.n_b) - self.n_b)[self.group_a]
        at_b = np.arange(len(self.ids_b)) + np.cumsum(self.n_a)[self.group_b]
        rows[at_a, : digits_a.shape[1]] = digits_a[self.ids_a]
        rows[at_b, : digits_b.shape[1]] = digits_b[self.ids_b]
        rows[at_a, width] = np.where(self.last_a, ord("|"), ord(","))
        rows[at_b, width] = np.where(self.last_b, ord(";"), ord(","))
        ends = np.cumsum(self.each(self.n_a + self.n_b))
        rows[ends[self.each(self.n_b) > 0] - 1, width] = 0
        kept = rows != 0
        upto = np.concatenate([[0], np.cumsum(kept.sum(1))])
        flat = rows[kept].tobytes()
        return [flat[a:b] for a, b in zip(upto[np.concatenate([[0], ends[:-1]])].tolist(), upto[ends].tolist(), strict=True)] if self.texts else []


class Aligner:
    """Aligns texts by two tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = _SideA(path_a), _SideB(path_b)

    def aligned(self, texts: list[bytes]) -> Aligned:
        """Of UTF-8 texts; those that are empty, or that the tokens of either side do not spell, have no tokens."""
        ids: list[list[np.ndarray]] = [[np.zeros(0, np.uint32)] * 2 for _ in texts]
        spelt = np.zeros(len(texts), bool)
        plain = [i for i, x in enumerate(texts) if x and self.b.cuts and not (_ODD_ASCII.search(x) if x.isascii() else _ODD_SPACE.search(x.decode()))]
        if plain:
            data = b" " + b" ".join([texts[i] for i in plain])
            edges = np.cumsum([0, *(len(texts[i]) + 1 for i in plain)])
            flat = np.frombuffer(data, np.uint8)
            space = (flat == 32) | (flat == 10)
            begins = np.zeros(len(flat), bool)
            begins[edges[:-1]] = True
            begins[1:] |= space[1:] & ~space[:-1]
            start = np.flatnonzero(begins)
            end = np.append(start[1:], len(flat))
            of = np.searchsorted(start, edges)
            for k, side in enumerate((self.a, self.b)):
                got, n = side.runs(data, start, end)
                upto = np.concatenate([[0], np.cumsum(n)])[of]
                for i, a, b in zip(plain, upto[:-1].tolist(), upto[1:].tolist(), strict=True):
                    ids[i][k] = got[a:b]
        fast = set(plain)
        for i, text in enumerate(texts):
            if text and not (i in fast and self._spells(text, ids[i])):
                x = text.decode()
                ids[i] = [self.a.whole(x), self.b.whole(x)]
                spelt[i] = self._spells(text, ids[i])
            else:
                spelt[i] = bool(text)
        live = [i for i in range(len(texts)) if spelt[i]]
        return self._grouped(live, [len(texts[i]) + 1 for i in live], [ids[i][0] for i in live], [ids[i][1] for i in live], len(texts))

    def _spells(self, text: bytes, ids: list[np.ndarray]) -> bool:
        return all(int(s.sizes[x].sum()) == len(text) + 1 and s.joined(x).tobytes() == b" " + text for s, x in zip((self.a, self.b), ids, strict=True))

    def _grouped(self, live: list[int], sizes: list[int], of_a: list[np.ndarray], of_b: list[np.ndarray], texts: int) -> Aligned:
        none = np.zeros(0, np.uint32)
        ids_a, ids_b = np.concatenate([none, *of_a]), np.concatenate([none, *of_b])
        edges = np.cumsum(sizes, dtype=np.int64)
        labels = np.zeros(int(edges[-1]) if live else 0, np.uint8)
        end_a, end_b = np.cumsum(self.a.sizes[ids_a]) - 1, np.cumsum(self.b.sizes[ids_b]) - 1
        labels[end_a] += A_END
        labels[end_b] += B_END
        ends = np.cumsum(np.fromiter(map(len, _SPAN.findall(labels.tobytes())), np.int64))
        upto_a, upto_b = np.cumsum((labels & A_END) > 0), np.cumsum((labels & B_END) > 0)
        n_a, n_b = np.diff(upto_a[ends - 1], prepend=0), np.diff(upto_b[ends - 1], prepend=0)
        group = np.arange(len(ends))
        text = np.asarray(live, np.int64)[np.searchsorted(edges, ends)] if live else np.zeros(0, np.int64)
        return Aligned(ids_a, ids_b, labels[end_a] == BOTH, labels[end_b] == BOTH, np.repeat(group, n_a), np.repeat(group, n_b), n_a, n_b, text, texts)


@lru_cache(maxsize=1)
def kept(path_a: str, path_b: str) -> Aligner:
    """The worker's last aligner: its tables have a fixed size, about 50 MB, and outlive the task."""
    return Aligner(path_a, path_b)


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, kind))


def token_groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, a_ids, b_ids (array<int>), and n_a, n_b (array<int>): the tokens of each group, in order.

    Texts that are null or empty, or that either tokenizer's tokens do not spell, have no
    groups. Null and repeated doc_ids come back as they are; an empty table gives an empty table.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept(path_a, path_b)
        for batch in batches:
            at = 0
            for texts in groups(utf8(batch.column(1))):
                g = aligner.aligned(texts)
                one = np.ones(len(g.n_a))
                columns = [_lists(v, n, pa.int32()) for v, n in ((g.ids_a, g.each(g.n_a)), (g.ids_b, g.each(g.n_b)), (g.n_a, g.each(one)), (g.n_b, g.each(one)))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *columns], ["doc_id", "a_ids", "b_ids", "n_a", "n_b"])
                at += len(texts)

    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {id_type}, a_ids array<int>, b_ids array<int>, n_a array<int>, n_b array<int>")


class _Block:
    """Documents of one task whose distinct pairs are numbered together."""

    def __init__(self, number: int, id_type: pa.DataType):
        self.number, self.id_type, self.size, self.rows = number, id_type, 0, []

    def add(self, ids: pa.Array, size: int, columns: list, keys: np.ndarray, n: np.ndarray) -> None:
        self.size += size
        self.rows.append((ids, columns, keys, n))

    def batches(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        """Rows of documents, then rows of numbered pairs."""
        mask = np.uint64((1 << 2 * ID_BITS) - 1)
        pairs, where, docs = np.unique(np.concatenate([k & mask for _, _, k, _ in self.rows]), return_inverse=True, return_counts=True)
        at = 0
        for ids, columns, keys, n in self.rows:
            of = np.bincount((keys >> np.uint64(2 * ID_BITS)).astype(np.int64), minlength=len(ids))
            upto = np.concatenate([[0], np.cumsum(of)])
            for a in range(0, len(ids), ROWS):
                b = min(a + ROWS, len(ids))
                lo, hi = int(upto[a]), int(upto[b])
                mine = [_lists(where[at + lo : at + hi], of[a:b], pa.int32()), _lists(n[lo:hi], of[a:b], pa.int64())]
                yield self._batch(names, b - a, [ids.slice(a, b - a), *(c.slice(a, b - a) for c in columns), *mine, *self._none(b - a, (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32())))])
            at += len(keys)
        kinds = (self.id_type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()))
        for a in range(0, len(pairs), PAIRS):
            part, count = pairs[a : a + PAIRS].astype(np.int64), docs[a : a + PAIRS]
            one = np.array([len(part)])
            yield self._batch(names, 1, [*self._none(1, kinds), pa.array([a], pa.int32()), _lists(part, one, pa.int64()), _lists(count, one, pa.int32())])

    def _none(self, n: int, kinds: tuple) -> list[pa.Array]:
        return [pa.nulls(n, k) for k in kinds]

    def _batch(self, names: list[str], n: int, columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, self.number)), *columns], names)


def _blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of documents (n_a not null) with the numbers of their pairs in the block, and rows of a block's pairs with their documents."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block long, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, numbers array<int>, links array<long>, "
        "first int, pairs array<long>, docs array<int>"
    )
    names = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "numbers", "links", "first", "pairs", "docs"]
    most = BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number, block = kept(path_a, path_b), TaskContext.get().partitionId() << 32, None
        for batch in batches:
            at = 0
            for texts in groups(utf8(batch.column(1))):
                g = aligner.aligned(texts)
                one = np.ones(len(g.n_a))
                lines = g.written(aligner.a.digits, aligner.b.digits)
                digests = pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in lines], pa.string())
                counts = [pa.array(g.each(x), pa.int64()) for x in (g.n_a, g.n_b, one, g.n_a * g.n_b)]
                block = block or _Block(number, batch.column(0).type)
                block.add(batch.column(0).slice(at, len(texts)), sum(map(len, texts)), [*counts, digests], *g.links())
                at += len(texts)
                if block.size >= most:
                    yield from block.batches(names)
                    number, block = number + 1, None
        if block:
            yield from block.batches(names)

    return docs.select("doc_id", "text").mapInArrow(released(run), schema)


def _counted(held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The blocks' pairs one by one (block, number, pair, n), and how many documents hold each pair."""
    each = held.filter("n_a is null").select("block", "first", F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "x"))
    each = each.select("block", (F.col("first") + F.col("at")).alias("number"), F.col("x.pairs").alias("pair"), F.col("x.docs").alias("n"))
    return each, each.groupBy("pair").agg(F.sum("n").alias("count"))


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """a_id, b_id, n_docs: how many rows hold the pair linked, that is in one group. Without links the result is empty."""
    _, counts = _counted(_blocks(docs, path_a, path_b))
    return counts.select(F.shiftright("pair", ID_BITS).cast("int").alias("a_id"), F.col("pair").bitwiseAND((1 << ID_BITS) - 1).cast("int").alias("b_id"), F.col("count").alias("n_docs"))


def cross_alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    A pair of ids counts the rows that hold it linked; n_best counts links whose pair counts
    most among those of its A id, ties included; count_sum adds the counts up over the links.
    Null and empty texts, and texts that either tokenizer's tokens do not spell (U+2581 in a
    text is one), have zeros and ''. Null and repeated doc_ids are rows of their own and come
    back as they are. Texts of any length are whole: the distinct pairs of one text are what a
    task holds at least. An empty table gives an empty table.

    Pairs are counted in blocks before they are shuffled, and their counts come back once for
    each block. What is broadcast has one row for each A id of the vocabulary at most.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    held = stored(_blocks(docs, path_a, path_b))
    each, counts = _counted(held)
    counts = stored(counts)
    head = F.shiftright("pair", ID_BITS)
    best = counts.groupBy(head.alias("a")).agg(F.max("count").alias("most"))
    told = counts.join(F.broadcast(best), head == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = each.select("block", "number", "pair").join(told, "pair").select(F.col("block").alias("in_block"), "number", "count", "best")
    rows = held.filter("n_a is not null").drop("first", "pairs", "docs")
    schema = f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        number = right["number"].to_numpy()
        count[number], best[number] = right["count"].to_numpy(), right["best"].to_numpy()
        numbers, links = left["numbers"].combine_chunks(), left["links"].combine_chunks()
        upto = np.asarray(numbers.offsets) - int(numbers.offsets[0].as_py()) if len(numbers) else np.zeros(1, np.int64)
        at, n = numbers.flatten().to_numpy(), links.flatten().to_numpy()
        sums = [np.diff(np.concatenate([[0], np.cumsum(x[at] * n)])[upto]) for x in (best, count)]
        return pa.table({
            **{c: left[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
            "n_best": pa.array(sums[0], pa.int64()), "count_sum": pa.array(sums[1], pa.int64()), "groups_sha256": left["groups_sha256"],
        })

    return rows.groupBy("block").cogroup(back.groupBy("in_block")).applyInArrow(summed, schema)


def op11(docs: DataFrame) -> DataFrame:
    """cross_alignment() of the 50k byte-level and the 32k sentencepiece vocabularies."""
    import public_tokenizers

    return cross_alignment(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
