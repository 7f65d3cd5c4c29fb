"""Dictionaries of any size: a trie in flat arrays for greedy matching, and a join of grams for contained names."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A trie may take so many bytes in every task; a larger dictionary is refused, since each task needs all of it.
MOST_BYTES = 1 << 28
#: Characters that are scanned together.
CHARS = 1 << 18
#: Characters of a gram: names are met by themselves, longer ones by so many first characters and compared as a whole then.
GRAM = 32
#: Names that are sent to all executors at most; more are joined by a shuffle.
SMALL_INDEX = 200_000
#: A filter of grams has 16 bits a name, but 2 to the power of so many at most (64 MB).
MOST_BITS = 29


def codes(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class Trie:
    """The states of all terms' beginnings: sorted keys (state, character), the state each leads to, and whether a term ends there."""

    letters: np.ndarray  #: the characters of all terms, ascending
    keys: np.ndarray
    to: np.ndarray
    ends: np.ndarray
    first: np.ndarray  #: the state behind each first character

    @classmethod
    def of(cls, terms: list[str]) -> Trie:
        """All terms level by level: prefixes of equal length are told apart together."""
        rows = [codes(t) for t in sorted(set(terms)) if t]
        letters = np.unique(np.concatenate([np.zeros(0, np.uint32), *rows]))
        n, size = len(letters), np.array([len(r) for r in rows], np.int64)
        flat = np.searchsorted(letters, np.concatenate([np.zeros(0, np.uint32), *rows])).astype(np.int64)
        start, state, made = np.cumsum(size) - size, np.zeros(len(rows), np.int64), 1
        keys, to, ends = [], [], [0]
        for d in range(int(size.max()) if len(size) else 0):
            live = np.flatnonzero(size > d)
            new, where = np.unique(state[live] * n + flat[start[live] + d], return_inverse=True)
            keys.append(new)
            to.append(np.arange(made, made + len(new)))
            state[live] = made + where
            ends += state[live][size[live] == d + 1].tolist()
            made += len(new)
        all_keys, all_to = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (keys, to))
        order = np.argsort(all_keys)
        final = np.zeros(made, bool)
        final[ends[1:]] = True
        first = np.full(n, -1, np.int64)
        if keys:
            first[keys[0]] = to[0]
        return cls(letters, all_keys[order], all_to[order], final, first)

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.letters, self.keys, self.to, self.ends, self.first))

    def longest(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The length and the last state of the longest term that begins at each place, 0 for none; all places go down the trie together."""
        n, out, told = len(self.letters), np.zeros(len(text), np.int32), np.zeros(len(text), np.int64)
        if not n:
            return out, told
        letter = np.minimum(np.searchsorted(self.letters, text), n - 1)
        letter = np.where(self.letters[letter] == text, letter, -1)
        at = np.flatnonzero(letter >= 0)
        state, depth = self.first[letter[at]], 1
        at, state = at[state >= 0], state[state >= 0]
        while len(at):
            ended = self.ends[state]
            out[at[ended]], told[at[ended]] = depth, state[ended]
            on = at + depth < len(text)
            at, state = at[on], state[on]
            nxt = letter[at + depth]
            key = state * n + nxt
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = (nxt >= 0) & (self.keys[place] == key)
            at, state, depth = at[on], self.to[place[on]], depth + 1
        return out, told

    def places(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and state of leftmost-longest terms without overlaps; equal terms have equal states."""
        size, state = self.longest(text)
        found, free = [], 0
        at = np.flatnonzero(size)
        for p, n in zip(at.tolist(), size[at].tolist(), strict=True):
            if p >= free:
                found.append(p)
                free = p + n
        found = np.array(found, np.int64)
        return found, size[found].astype(np.int64), state[found]

    def greedy(self, text: np.ndarray) -> list[tuple[int, int]]:
        """(start, length) of leftmost-longest terms without overlaps."""
        at, size, _ = self.places(text)
        return list(zip(at.tolist(), size.tolist(), strict=True))


def trie_hits(lines: DataFrame, terms: list[str], text: str = "line") -> DataFrame:
    """``lines`` exploded to one row a hit with ordinal, surface and position, as matching.positions() by a Trie that is built once and broadcast.

    Null and empty lines have no hits. Lines of a batch are scanned as one run of characters; a gap that no term holds keeps them apart.
    """
    return _scan(lines, terms, text, False)


def trie_counts(lines: DataFrame, terms: list[str], text: str = "line") -> DataFrame:
    """``lines`` with surface and n, how often it is hit in the line, as trie_hits() grouped by line: one row for each surface that the line holds."""
    return _scan(lines, terms, text, True)


def _scan(lines: DataFrame, terms: list[str], text: str, counts: bool) -> DataFrame:
    trie = Trie.of(terms)
    if trie.nbytes > MOST_BYTES:
        raise ValueError(f"a dictionary of {trie.nbytes} bytes exceeds the {MOST_BYTES} that are sent to every task")
    sent, at = lines.sparkSession.sparkContext.broadcast(trie), lines.columns.index(text)
    columns = [("surface", pa.string(), "string"), ("n", pa.int64(), "long")] if counts else [("ordinal", pa.int32(), "int"), ("surface", pa.string(), "string"), ("position", pa.int32(), "int")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, n in _runs(b.column(at)):  # a run's hits are handed on before the next is read: a batch of long texts holds too many
                group, rows = b.column(at).slice(first, n).to_pylist(), b.slice(first, n)
                run_of, begins, _ = _joined(group)
                start, size, state = sent.value.places(run_of)
                line = np.searchsorted(begins, start, side="right") - 1
                if counts:
                    _, one, n_of = np.unique(line * len(sent.value.ends) + state, return_index=True, return_counts=True)
                    start, size, line = start[one], size[one], line[one]
                place = start - begins[line]
                surfaces = [group[i][p : p + k] for i, p, k in zip(line.tolist(), place.tolist(), size.tolist(), strict=True)]
                told = [surfaces, n_of] if counts else [np.arange(len(line)) - np.searchsorted(line, line, side="left"), surfaces, place]
                taken = rows.take(pa.array(line, pa.int64()))
                more = [pa.array(x, t) for x, (_, t, _) in zip(told, columns, strict=True)]
                yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(taken.columns) if i != at), *more], [c for c in b.schema.names if c != text] + [c for c, *_ in columns])

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema if f.name != text] + [f"{c} {kind}" for c, _, kind in columns]
    return lines.mapInArrow(run, ", ".join(schema))


_APART = np.array([0xFFFFFFFF], np.uint32)


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts of about CHARS characters: the first one's number and how many."""
    first, n = 0, 0
    for i, size in enumerate(pc.utf8_length(texts).to_pylist()):
        n += size or 0
        if n >= CHARS:
            yield first, i + 1 - first
            first, n = i + 1, 0
    if first < len(texts):
        yield first, len(texts) - first


def _joined(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of texts with a gap behind each, and where each begins and ends."""
    parts = [x for t in texts for x in (codes(t or ""), _APART)]
    at = np.cumsum([0, *map(len, parts)])
    return np.concatenate(parts), at[0:-1:2], at[1::2]


_BASE, _STIR = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


@lru_cache(2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, 2 to the power of ``bits`` of each, modulo 2^64."""
    of = lambda x: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full((1 << bits) - 1, x, np.uint64)]))
    return of(_BASE), of(pow(_BASE, -1, 1 << 64))


def _sums(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of a text's code points up to each place, each times a power of the base, and the inverse powers."""
    up, down = _powers(max(18, len(text).bit_length()))
    letter = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(_STIR[0])
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum((letter ^ (letter >> np.uint64(31))) * up[: len(text)])]), down


def _bits(sums: np.ndarray, down: np.ndarray, size: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of a filter for the ``size`` characters at each place."""
    h = (sums[size:] - sums[:-size]) * down[: len(sums) - size]
    h ^= h >> np.uint64(29)
    return tuple((h * np.uint64(x)) >> np.uint64(64 - bits) for x in _STIR)


def _filter(named: DataFrame, bits: int) -> np.ndarray:
    """The bits of all names' grams, as bytes: Spark collects them in parts of 4 KB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [x for t in b.column(0).to_pylist() for c in [codes(t)] for two in _bits(*_sums(c), len(c), bits) for x in two.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x + 1 for x in found], pa.int64())], ["bit"])

    parts = named.select("gram").mapInArrow(run, "bit long").groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("held"))
    out = np.zeros(max(1, (1 << bits) >> 15) << 12, np.uint8)
    for r in parts.toLocalIterator():
        out[(r.part - 1) << 12 : r.part << 12] = np.frombuffer(bytes(r.held), np.uint8)
    return out


def grams_met(texts: DataFrame, sizes: list[int], held: np.ndarray, bits: int) -> DataFrame:
    """__k and gram: the distinct substrings, of the given sizes, of each text (__k, __t) whose bits a filter holds."""
    sent = texts.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has = lambda x: (sent.value[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 > 0
        for b in batches:
            for first, n in _runs(b.column(1)):
                group = b.column(1).slice(first, n).to_pylist()
                text, begins, ends = _joined(group)
                sums, down = _sums(text)
                found = set()
                for size in sizes:
                    if size > len(text):
                        continue
                    one, two = _bits(sums, down, size, bits)
                    at = np.flatnonzero(has(one))
                    at = at[has(two[at])]
                    line = np.searchsorted(begins, at, side="right") - 1
                    inside = at + size <= ends[line]
                    at, line = at[inside], line[inside]
                    found.update((i, group[i][p : p + size]) for i, p in zip(line.tolist(), (at - begins[line]).tolist(), strict=True))
                keys = b.column(0).slice(first, n).take(pa.array([i for i, _ in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, pa.array([g for _, g in found], pa.string())], ["__k", "gram"])

    return texts.select("__k", "__t").mapInArrow(run, f"__k {texts.schema['__k'].dataType.simpleString()}, gram string")


def longest_contained(rows: DataFrame, key: str, text: str, names: DataFrame, fold_case: bool = False) -> DataFrame:
    """key, alias, canonical of the longest alias that each text contains, of equal length the one of least ``ord``; texts with none do not come back.

    Texts and ``names`` (alias, canonical, ord) meet in a join of grams: an alias's gram is the alias itself, or its first GRAM characters,
    and of texts only those substrings are laid out that a filter of fixed size holds. So a text meets few names that it does not contain, however alike names are.
    Rows of equal key count as one text's; null keys are one. Null and empty aliases and texts match nothing.
    """
    fold = F.lower if fold_case else (lambda x: x)
    named = names.filter(F.length("alias") > 0).select("alias", "canonical", "ord", fold(F.col("alias")).alias("__a"))
    named = named.withColumn("gram", F.left("__a", F.lit(GRAM)))
    told = named.groupBy(F.length("gram").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(F.length("__a")).alias("most")).collect()  # GRAM rows at most
    if not told:
        return rows.select(key).join(named.select("alias", "canonical"), F.lit(False))
    n = sum(r.n for r in told)
    bits = min(max(16, (16 * n).bit_length()), MOST_BITS)
    texts = rows.select(F.col(key).alias("__k"), fold(F.col(text)).alias("__t"))
    met = grams_met(texts, sorted(r["size"] for r in told), _filter(named, bits), bits).join(F.broadcast(named) if n <= SMALL_INDEX else named, "gram")
    if max(r.most for r in told) > GRAM:
        long = met.filter(F.length("__a") > GRAM).select("__k", "__a", "alias", "canonical", "ord").join(texts.withColumnRenamed("__k", "__r"), F.col("__k").eqNullSafe(F.col("__r")))
        short = met.filter(F.length("__a") <= GRAM).select("__k", "alias", "canonical", "ord")
        met = short.unionByName(long.filter(F.col("__t").contains(F.col("__a"))).select("__k", "alias", "canonical", "ord"))
    best = F.min_by(F.struct("alias", "canonical"), F.struct(-F.length("alias"), F.col("ord"), F.col("alias")))
    return met.groupBy("__k").agg(best.alias("b")).select(F.col("__k").alias(key), "b.alias", "b.canonical")
