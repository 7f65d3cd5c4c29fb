"""Spans of bytes told apart exactly, their 64-bit hashes, and a bounded table from spans to runs of ids, in numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np

P = np.uint64(0xD6E8FEB86659FD93)
#: Spans of up to so many bytes fit, with their length, into three 64-bit words.
SHORT = 23
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Three words for each span [start, end) of bytes; for spans of up to SHORT bytes they hold it whole, with its length."""
    n = end - start
    padded = np.concatenate([data, np.zeros(32, np.uint8)])
    view = np.ndarray((len(data) + 25,), "<u8", padded, strides=(1,))
    words = [view[np.minimum(start + 8 * k, len(data))] & _MASKS[np.clip(n - 8 * k, 0, 8)] for k in range(3)]
    words[2] = (words[2] & _MASKS[7]) | (np.minimum(n, 255).astype(np.uint64) << np.uint64(56))
    return words


def _hashed(words: list[np.ndarray]) -> np.ndarray:
    h = mix(words[0] + P)
    for w in words[1:]:
        h = mix((h ^ w) + P)
    return h


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span [start, end) of bytes: short ones by their packed words, longer ones by blake2b."""
    out = _hashed(packed(data, start, end))
    for i in np.flatnonzero(end - start > SHORT).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


class Memo:
    """Runs of ids by spans of bytes. It never holds more than ``1 << bits`` spans and about ``pool`` ids, whatever it is asked for.

    A span of up to SHORT bytes is kept whole and compared whole, so no other span's ids can
    come back, whatever the hashes. It has one place; a later one takes it. Spans that are not
    there, and longer ones always, are encoded anew, so forgetting costs time only.
    """

    def __init__(self, dtype: type, bits: int = 20, pool: int = 1 << 22):
        self.dtype, self.bits, self.most = dtype, np.uint64(64 - bits), pool
        self.words = [np.zeros(1 << bits, np.uint64) for _ in range(3)]
        self.at, self.n = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
        self.pool, self.used = np.empty(pool, dtype), 0

    def runs(
        self, data: np.ndarray, start: np.ndarray, end: np.ndarray, encode: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
    ) -> tuple[np.ndarray, np.ndarray]:
        """All ids in the order of the spans, and how many each has. ``encode`` gives the ids of the named spans, where each one's begin, and their counts."""
        words = packed(data, start, end)
        h = _hashed(words)
        slot = (h >> self.bits).astype(np.int64)
        at, n = self.at[slot].astype(np.int64), self.n[slot].astype(np.int64)
        short, empty = end - start <= SHORT, end == start
        known = short & ~empty
        for w, held in zip(words, self.words, strict=True):
            known &= held[slot] == w
        n[empty] = 0
        miss = np.flatnonzero(short & ~known & ~empty)
        _, first, where = np.unique(h[miss], return_index=True, return_inverse=True)
        one = miss[first]
        same = np.ones(len(miss), bool)
        for w in words:
            same &= w[miss] == w[one][where]
        # equal long spans are met by their bytes, spans whose hash alone is equal go one by one
        of_bytes: dict[bytes, int] = {}
        long = np.flatnonzero(~short)
        number = np.array([of_bytes.setdefault(data[a:b].tobytes(), len(of_bytes)) for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)], np.int64)
        _, first_long = np.unique(number, return_index=True)
        odd = miss[~same]
        asked = np.concatenate([one, odd, long[first_long]])
        if len(asked):
            ids, begin, counts = encode(asked)
            if self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool[: self.used], ids])
            else:
                self.pool[self.used : self.used + len(ids)] = ids
            begin = begin + self.used
            self.used += len(ids)
            k, m = len(one), len(one) + len(odd)
            at[miss], n[miss] = begin[where], counts[where]
            at[odd], n[odd] = begin[k:m], counts[k:m]
            at[long], n[long] = begin[m + number], counts[m + number]
            s = slot[one]
            for w, held in zip(words, self.words, strict=True):
                held[s] = w[one]
            self.at[s], self.n[s] = begin[:k], counts[:k]
        upto = np.cumsum(n)
        got = self.pool[np.repeat(at - (upto - n), n) + np.arange(int(upto[-1]) if len(upto) else 0)]
        if self.used > self.most:
            for held in self.words:
                held[:] = 0
            self.pool, self.used = np.empty(self.most, self.dtype), 0
        return got, n
