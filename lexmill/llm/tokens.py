"""Token counts and token ids of whole texts, by the libraries' own vocabularies.

Texts are cut into segments at boundaries where no token can span. Short segments are looked
up by all their bytes; those that a worker's table of fixed size does not hold are encoded in
batches balanced by bytes, so frequent words cost a lookup. Texts with unusual white space
go to the library in long pieces that end at boundaries which are safe for any text.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.llm.common import released, utf8
from lexmill.llm.spans import Memo

#: UTF-8 bytes handled together; batches are balanced by size, not by rows.
BATCH_BYTES = 1 << 20
#: Longer texts that go to the library whole are cut into pieces of about so many characters.
LONG = 1 << 16

#: White space of other kinds than space and line feed, in Python's wide sense.
_ODD_SPACE = re.compile(r"[^\S \n]")
#: Characters that Python takes for white space but Unicode's White_Space does not, and NEL.
_ODD_CONTROL = re.compile("[\x1c-\x1f\x85]")
#: Texts with other characters, or with what may begin a special token, are not lower-cased beforehand.
_BEYOND_LATIN, _SPECIAL = re.compile("[^\x00-\u012f\u0131-\u024f]"), "<|"
#: What no plain Latin text holds: the two above, and white space beyond ASCII.
_UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0]|[^\x00-\u012f\u0131-\u024f]")
#: A stop between a letter and white space is a token of its own.
_STOP = re.compile(r"[.,](?<=[a-z\u00df-\u00f6\u00f8-\u00ff][.,])(?=[ \n]|\Z)")
_SAFE = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def load(path: str):
    """The tokenizer of a .json file, without padding and truncation."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_padding()
    tok.no_truncation()
    return tok


def long_pieces(text: str, size: int = LONG) -> Iterator[str]:
    """``text`` cut before single spaces between ASCII letters, where no token spans."""
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def groups(texts: Iterable[bytes], size: int = BATCH_BYTES) -> Iterator[list[bytes]]:
    """Runs of texts of about ``size`` bytes."""
    run, n = [], 0
    for text in texts:
        run.append(text)
        n += len(text)
        if n >= size:
            yield run
            run, n = [], 0
    if run:
        yield run


class Spans:
    """Ids of spans of bytes by a tokenizer, remembered in a Memo."""

    def __init__(self, path: str, bits: int = 20):
        self.tok = load(path)
        self.memo = Memo(np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32, bits)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and of each text where its own begin and how many they are."""
        got = [x.ids for run in _str_groups(texts) for x in self.tok.encode_batch_fast(run, add_special_tokens=False)]
        n = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), self.memo.dtype, int(n.sum())), np.cumsum(n) - n, n

    def _runs(self, data: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the spans, and the counts of each."""

        def new(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return self._encode([data[a:b].decode() for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)])

        return self.memo.runs(np.frombuffer(data, np.uint8), start, end, new)


class Counter(Spans):
    """Numbers of tokens of a byte-level BPE whose words begin with at most one space."""

    def count(self, texts: list[bytes]) -> list[int]:
        """Tokens of each UTF-8 text."""
        out: list[int] = []
        for run in groups(texts):
            whole = {i: x.decode() for i, x in enumerate(run) if _has_odd_space(x)}
            kept = [b"" if i in whole else x for i, x in enumerate(run)]
            data = b"".join(kept)
            edges = np.cumsum([0, *map(len, kept)])
            flat = np.frombuffer(data, np.uint8)
            space = (flat == 32) | (flat == 10)
            # a boundary before a run of spaces and line feeds, behind any other character
            cut = np.flatnonzero(space[1:] & ~space[:-1]) + 1 if len(flat) else np.zeros(0, np.int64)
            begins = np.zeros(len(flat) + 1, bool)
            begins[cut] = begins[edges] = True
            start = np.flatnonzero(begins[:-1])
            _, n = self._runs(data, start, np.append(start[1:], len(flat)))
            upto = np.concatenate([[0], np.cumsum(n)])
            counts = np.diff(upto[np.searchsorted(start, edges)]).tolist()
            for i, x in whole.items():
                counts[i] = len(self._encode(list(long_pieces(x)))[0])
            out += counts
        return out


def _has_odd_space(text: bytes) -> bool:
    if text.isascii():
        return bool(_ODD_ASCII.search(text))
    return bool(_ODD_SPACE.search(text.decode()))


_ODD_ASCII = re.compile(rb"[\t\x0b-\r\x1c-\x1f]")


def _str_groups(texts: list[str]) -> Iterator[list[str]]:
    run, n = [], 0
    for text in texts:
        run.append(text)
        n += len(text)
        if n >= BATCH_BYTES // 2:
            yield run
            run, n = [], 0
    if run:
        yield run


_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


class Encoder(Spans):
    """Ids of a tokenizer that drops white space and lower-cases each character.

    Latin texts are lower-cased and their stops set apart before words are looked up, which
    changes no id and leaves fewer words to encode.
    """

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As of Spans; words of letters only are one pre-token each and go through the library together."""
        plain, rest = [], []
        for i, w in enumerate(texts):
            (plain if w.isalpha() else rest).append(i)
        begin, n = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        parts, total = [np.zeros(0, self.memo.dtype)], 0
        for a in range(0, len(plain), 4096):
            run = plain[a : a + 4096]
            got = self.tok.encode(" ".join([texts[i] for i in run]), add_special_tokens=False)
            edges = np.flatnonzero(np.diff(np.asarray(got.word_ids))) + 1
            if len(edges) != len(run) - 1:
                rest += run
                continue
            ids = np.asarray(got.ids, self.memo.dtype)
            begin[run] = total + np.concatenate([[0], edges])
            n[run] = np.diff(edges, prepend=0, append=len(ids))
            parts.append(ids)
            total += len(ids)
        ids, at, counts = super()._encode([texts[i] for i in rest])
        begin[rest], n[rest] = total + at, counts
        return np.concatenate([*parts, ids]), begin, n

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each UTF-8 text."""
        for run in groups(texts):
            whole: dict[int, str] = {}
            kept = []
            for i, raw in enumerate(run):
                x = raw.decode()
                if _UNUSUAL.search(x):
                    if _ODD_CONTROL.search(x):
                        whole[i] = x
                        x = ""
                    elif _SPECIAL in x or _BEYOND_LATIN.search(x):
                        x = " ".join(x.split())
                    else:
                        x = _STOP.sub(r" \g<0>", " ".join(x.split()).lower())
                elif _SPECIAL not in x:
                    x = _STOP.sub(r" \g<0>", x.lower())
                kept.append(x.encode())
            data = b" ".join(kept) + b" "
            space = _WHITE[np.frombuffer(data, np.uint8)]
            edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).view(np.int8)))
            start, end = edge[0::2], edge[1::2]
            ids, n = self._runs(data, start, end)
            upto = np.concatenate([[0], np.cumsum(n)])
            bounds = upto[np.searchsorted(start, np.cumsum([0, *(len(x) + 1 for x in kept)]))]
            for i in range(len(run)):
                yield self._encode(list(long_pieces(whole[i])))[0] if i in whole else ids[bounds[i] : bounds[i + 1]]


@lru_cache(maxsize=1)
def kept(kind: type, path: str) -> Spans:
    """The worker's last counter or encoder: its table has a fixed size, about 40 MB, and outlives the task."""
    return kind(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) of every row.

    No begin, end or added special tokens; special strings inside texts as by the
    library's default. Null text is empty: 0 bytes, 0 tokens. Null and repeated doc_ids
    come back as they are. An empty table gives an empty table.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept(Counter, path)
        for batch in batches:
            texts = utf8(batch.column(1))
            tokens = counter.count(texts)
            sizes = list(map(len, texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([x > limit for x in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Token pieces of every row: doc_id, piece, start, length, ids_crc32.

    A document is its ids and ``end_id``; only longer ones are cut, into ``capacity`` ids.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end, step = kept(Encoder, path), end_id.to_bytes(4, "little"), 4 * capacity
        for batch in batches:
            rows, piece, length, crc = [], [], [], []
            for i, found in enumerate(ids_of.encode(utf8(batch.column(1)))):
                ids = found.astype("<u4").tobytes() + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append(i)
                    piece.append(k)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            start = pa.array([k * capacity for k in piece], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), start, pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def op4(docs: DataFrame) -> DataFrame:
    """token_counts() by the 50k byte-level vocabulary, limit 512."""
    import public_tokenizers

    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
