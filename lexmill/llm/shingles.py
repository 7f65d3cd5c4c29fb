"""Sets of word shingles of whole texts as 64-bit hashes, by numpy over batches of bytes."""

from __future__ import annotations

import numpy as np

from lexmill.llm.spans import P, mix, span_hashes

WORDS = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct shingle hashes of all texts, one text after the other, and how many each has.

    Words are runs of other bytes than [\\x20\\x09-\\x0D], A-Z lower-cased. A text of
    fewer than ``words`` words is one shingle, one without words has none.
    """
    sizes = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    word = span_hashes(data, start, end)
    bounds = np.searchsorted(start, np.concatenate([[0], ends]))
    n = len(word)
    if n >= words:
        rolled = word[: n - words + 1].copy()
        for k in range(1, words):
            rolled = rolled * P + word[k : n - words + 1 + k]
        rolled = mix(rolled)
    else:
        rolled = np.zeros(0, np.uint64)
    out, counts = [], np.zeros(len(texts), np.int64)
    for i in range(len(texts)):
        a, b = int(bounds[i]), int(bounds[i + 1])
        if b - a >= words:
            got = np.sort(rolled[a : b - words + 1])
            if len(got) > 1:
                got = got[np.concatenate([[True], got[1:] != got[:-1]])]
        elif b > a:
            whole = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in word[a:b]:
                    whole = whole * P + w
            got = mix(np.array([whole ^ np.uint64(0xA5A5A5A5)], np.uint64))
        else:
            got = rolled[:0]
        out.append(got)
        counts[i] = len(got)
    return np.concatenate(out), counts


def batches_of(texts: list, most: int = 1 << 20):
    """(first row, UTF-8 texts) of runs of about ``most`` bytes; null is empty."""
    run, first, n = [], 0, 0
    for i, text in enumerate(texts):
        data = (text or "").encode()
        run.append(data)
        n += len(data)
        if n >= most:
            yield first, run
            run, first, n = [], i + 1, 0
    if run:
        yield first, run
