"""N-gram Jaccard join as a blocked sparse matrix product.

The incidence matrix has a row per distinct shingle set and a column per shingle. Two
sets of Jaccard similarity t share a column among the first n - ceil(t n) + 1 of each,
in any common order of columns; rare columns come first. Column blocks of this part of
the matrix tell which rows can meet at all: at their first common column two sets have at
most min(n - position) columns left, and pairs below the bound that their sizes set are
discarded. The rows that can meet, directly or by others, form row blocks; the product of a block
with itself or another accumulates overlap counts over all columns, exactly.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import forget, released, stored
from lexmill.llm.graph import components, local_roots
from lexmill.llm.shingles import WORDS, batches_of, shingle_sets
from lexmill.llm.spans import mix

#: Similarity of at least NUM / DEN links.
NUM, DEN = 75, 100
#: Columns are ordered by how often their bucket occurs; so many bits name a bucket.
BUCKET_BITS = 24
#: Buckets that travel together when counts are added up.
PAGE = 1 << 16
#: Bits of the filter that spares sets which can meet no other; it is never larger.
FILTER_BITS = 1 << 26
#: Shingles of a row block, about; larger groups are cut into bands of sizes, of which only
#: equal and neighbouring ones can hold similar sets, and full bands into parts.
BLOCK = 1_000_000
#: So many rows (set, block product) are sent to all executors at most, about 20 MB; more are joined by a shuffle.
SMALL = 200_000
#: Salts of a large group's sets.
SALTS = 32
#: Set ids that a task remembers to send copies once, in a table of fixed size.
SEEN = 1 << 20


def set_ids(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set of hashes; 0 for empty ones."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    salted = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    total = np.zeros(len(sizes), np.uint64)
    full = sizes > 0
    if full.any():
        total[full] = np.add.reduceat(salted, starts[full])
    got = mix(total + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.where(full, got.view(np.int64), 0)


def _named(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, set_id of every row; and, where page is not null, added-up counts of buckets."""
    id_type = docs.schema["doc_id"].dataType
    shift = np.uint64(64 - BUCKET_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.uint16)
        names = ["doc_id", "n", "set_id", "page", "counts"]
        for b in batches:
            for first, texts in batches_of(b.column(1).to_pylist()):
                h, n = shingle_sets(texts, words)
                at, more = np.unique((h >> shift).astype(np.int64), return_counts=True)
                counts[at] = np.minimum(counts[at].astype(np.int64) + more, 65535)
                k = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, k), pa.array(n), pa.array(set_ids(h, n)), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names
                )
        pages = [(i, x) for i, x in enumerate(counts.reshape(-1, PAGE)) if x.any()]
        k = len(pages)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(k, b.column(0).type) if k else pa.nulls(0, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array([i for i, _ in pages], pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for _, x in pages], pa.binary())],
            names,
        ) if k else pa.RecordBatch.from_pylist([], schema=pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_id", pa.int64()), ("page", pa.int32()), ("counts", pa.binary())]))

    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {id_type.simpleString()}, n long, set_id long, page int, counts binary")


def _frequency_classes(pages: DataFrame) -> np.ndarray:
    """Eight times the binary logarithm of each bucket's count, one byte a bucket: always 2**BUCKET_BITS bytes.

    Buckets hold many rare columns each; steps of 9 % still tell those that hold a shared one as well.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for page, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total[page] = total.get(page, 0) + np.frombuffer(zlib.decompress(data), np.uint16).astype(np.float32)
        cls = {k: zlib.compress(np.minimum(np.floor(8 * np.log2(np.maximum(v, 1))), 255).astype(np.uint8).tobytes(), 1) for k, v in total.items()}
        yield pa.RecordBatch.from_arrays([pa.array(list(cls), pa.int32()), pa.array(list(cls.values()), pa.binary())], ["page", "cls"])

    out = np.zeros(1 << BUCKET_BITS, np.uint8)
    for r in pages.repartition("page").mapInArrow(add, "page int, cls binary").collect():
        out[r["page"] * PAGE : (r["page"] + 1) * PAGE] = np.frombuffer(zlib.decompress(r["cls"]), np.uint8)
    return out


def column_order(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Keys by which columns ascend: rare buckets first, then a hash of the column."""
    cls = classes[(hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.uint64)
    return (cls << np.uint64(56)) | (mix(hashes) >> np.uint64(8))


def _prefixes(docs: DataFrame, words: int, classes: np.ndarray) -> DataFrame:
    """The first columns of every distinct set: col, set_id, n, pos."""
    sent = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SEEN, np.int64)
        for b in batches:
            for _, texts in batches_of(b.column(0).to_pylist()):
                h, n = shingle_sets(texts, words)
                ids, keys = set_ids(h, n), column_order(h, sent.value)
                ends = np.cumsum(n)
                col, owner, pos = [], [], []
                for i in range(len(n)):
                    m, me = int(n[i]), int(ids[i])
                    if not m or seen[me % SEEN] == me:
                        continue
                    seen[me % SEEN] = me
                    p = m - -(-NUM * m // DEN) + 1
                    a = int(ends[i]) - m
                    k = keys[a : a + m]
                    first = np.argpartition(k, p - 1)[:p] if p < m else np.arange(m)
                    first = first[np.argsort(k[first])]
                    col.append(h[a : a + m][first])
                    owner.append(np.full(p, i))
                    pos.append(np.arange(p))
                if col:
                    o = np.concatenate(owner)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(col).view(np.int64)), pa.array(ids[o]), pa.array(n[o].astype(np.int32)), pa.array(np.concatenate(pos).astype(np.int32))],
                        ["col", "set_id", "n", "pos"],
                    )

    return docs.select("text").mapInArrow(released(run), "col long, set_id long, n int, pos int")


class Meeting:
    """Edges that connect all nodes which can meet in a column, fed in order of column and size.

    In a column, x and y with sizes n and r = n - pos columns left can be similar only if
    min(r) >= NUM / (NUM + DEN) * (n_x + n_y), that is n_y <= reach_x and n_x <= reach_y with
    reach = (NUM + DEN) / NUM * r - n. By ascending size, all nodes whose reach is still open
    can meet each other, so a new node need only be tied to the smallest of them; and a node tied
    to one that reaches as far need not be kept. What is kept is so bounded by the number of
    different reaches, however many nodes a column has.
    """

    #: Ties that are remembered so that other columns need not tell them again.
    MOST = 1 << 18

    def __init__(self) -> None:
        self.col, self.heap, self.parent = None, [], {}

    def _find(self, x: int) -> int:
        parent = self.parent
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    def feed(self, col: np.ndarray, node: np.ndarray, n: np.ndarray, pos: np.ndarray) -> list[tuple[int, int]]:
        """The edges that these rows add."""
        edge = np.flatnonzero(np.concatenate([[True], col[1:] != col[:-1], [True]]))
        runs = np.flatnonzero(np.diff(edge) > 1)
        # the first run may go on from the rows before, the last into those to come
        runs = np.unique(np.concatenate([[0], runs, [len(edge) - 2]]))
        reach = (NUM + DEN) * (n - pos) - NUM * n  # times NUM
        out = []
        if len(self.parent) > self.MOST:
            self.parent.clear()
        for a, b in zip(edge[runs].tolist(), edge[runs + 1].tolist(), strict=True):
            if col[a] != self.col:
                self.col, self.heap = col[a], []
            heap = self.heap
            for y, s, r in zip(node[a:b].tolist(), (NUM * n[a:b]).tolist(), reach[a:b].tolist(), strict=True):
                while heap and heap[0][1] < s:
                    heapq.heappop(heap)
                if heap and heap[0][0] <= r:
                    p, q = self._find(heap[0][2]), self._find(y)
                    if p != q:
                        self.parent[q] = p
                        out.append((p, q))
                    if heap[0][1] >= r:
                        continue
                if r >= s:
                    heapq.heappush(heap, (s, r, y))
        return out


def _candidates(prefixes: DataFrame) -> DataFrame:
    """Edges a, b between sets that can meet, from each column block; columns are sorted outside Python and pass one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meeting = Meeting()
        for b in batches:
            if b.num_rows:
                col, node, n, pos = (c.to_numpy(zero_copy_only=False) for c in b.columns)
                got = np.array(meeting.feed(col, node, n.astype(np.int64), pos.astype(np.int64)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(got[:, 0].copy()), pa.array(got[:, 1].copy())], ["a", "b"])

    return prefixes.repartition("col").sortWithinPartitions("col", "n").mapInArrow(released(run), "a long, b long")


def _sets(docs: DataFrame, words: int, wanted: DataFrame) -> DataFrame:
    """set_id, key, hashes (little-endian unsigned 64-bit) of the rows that stand for the ``wanted`` sets, and hardly any others."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter_bits(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint8)
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for first, texts in batches_of(b.column(1).to_pylist()):
                h, n = shingle_sets(texts, words)
                ids, ends, key = set_ids(h, n), np.cumsum(n), keys[first : first + len(texts)]
                at = _filter_place(ids, key)
                hit = (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1
                rows = np.flatnonzero(hit & (n > 0))
                if len(rows):
                    data = pa.array([h[ends[i] - n[i] : ends[i]].tobytes() for i in rows.tolist()], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(key[rows]), data], ["set_id", "key", "hashes"])

    return docs.select(F.xxhash64("doc_id").alias("key"), "text").mapInArrow(released(run), "set_id long, key long, hashes binary")


def _filter_place(ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return (mix(ids.view(np.uint64) ^ mix(keys.view(np.uint64))) % np.uint64(FILTER_BITS)).astype(np.int64)


def _filter_bits(ids: DataFrame) -> bytes:
    """A filter of FILTER_BITS bits, always 8 MB, that holds all (set_id, key); false answers only cost work."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # bitmap functions count values from 1
            yield pa.RecordBatch.from_arrays([pa.array(_filter_place(*(c.to_numpy(zero_copy_only=False) for c in b.columns)) + 1)], ["at"])

    at = ids.select("set_id", "key").mapInArrow(places, "at long")
    pages = at.groupBy(F.bitmap_bucket_number("at").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for r in pages.collect():
        start = (r["page"] - 1) * 4096
        out[start : start + 4096] = bytes(r["bits"])
    return bytes(out)


def block_links(sets: list[np.ndarray], sides: np.ndarray, cross: bool) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of similar sets of a row block, or between its two sides: overlap counts by columns."""
    sizes = np.array([len(x) for x in sets])
    order = np.argsort(sizes, kind="stable")
    rank = np.empty(len(sets), np.int64)
    rank[order] = np.arange(len(sets))
    flat, owner = np.concatenate(sets), np.repeat(rank, sizes)
    o = np.lexsort((owner, flat))
    flat, owner = flat[o], owner[o]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    where = np.arange(len(flat)) - starts[column]
    by_row = np.argsort(owner, kind="stable")
    row_ends = np.cumsum(sizes[order])
    out_a, out_b = [], []
    small = sizes[order]
    for y in range(1, len(sets)):
        mine = by_row[row_ends[y] - small[y] : row_ends[y]]
        before = where[mine]
        mine, before = mine[before > 0], before[before > 0]
        if not len(mine):
            continue
        # entries of the same column that belong to smaller sets stand just before
        total = int(before.sum())
        first = np.repeat(mine - before - np.concatenate([[0], np.cumsum(before)[:-1]]), before)
        overlap = np.bincount(owner[first + np.arange(total)], minlength=y)[:y]
        x = np.flatnonzero((NUM + DEN) * overlap >= NUM * (small[:y] + small[y]))
        if cross:
            x = x[sides[order[x]] != sides[order[y]]]
        out_a.append(order[x])
        out_b.append(np.full(len(x), order[y]))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def _products(rows: DataFrame) -> DataFrame:
    """set_id, root, linked of each set in each block product: rows (grp, i, j, side, set_id, copies, hashes)."""

    def product(key: tuple, sides: list, ids: list, copies: list, sets: list) -> pa.RecordBatch:
        _, once = np.unique(np.array(ids), return_index=True)  # rows of one doc_id and text come more than once
        ids, copies, sides = np.array(ids)[once], np.array(copies)[once], np.array(sides)[once]
        a, b = block_links([sets[i] for i in once.tolist()], sides, key[1] != key[2])
        root = ids[local_roots(len(ids), a, b)]
        linked = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
        live = linked > 0
        return pa.RecordBatch.from_arrays([pa.array(ids[live]), pa.array(root[live]), pa.array(linked[live].astype(np.int64))], ["set_id", "root", "linked"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, ([], [], [], [])
        for b in batches:
            hashes = b.column(6)
            for r, (g, i, j, *row) in enumerate(zip(*(c.to_pylist() for c in b.columns[:6]), strict=True)):
                if (g, i, j) != key:
                    if len(group[0]) > 1:
                        yield product(key, *group)
                    key, group = (g, i, j), ([], [], [], [])
                for to, value in zip(group, (*row, np.frombuffer(hashes[r].as_buffer(), np.uint64)), strict=True):
                    to.append(value)
        if len(group[0]) > 1:
            yield product(key, *group)

    return (
        rows.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
        .select("grp", "i", "j", "side", "set_id", "copies", "hashes")
        .mapInArrow(released(run), "set_id long, root long, linked long")
    )


def _placed(member: DataFrame) -> DataFrame:
    """set_id, key, grp, copies, side, i, j: the block products that each set enters.

    A group of up to BLOCK shingles is one block. A larger one is cut into bands of sizes, each by DEN / NUM
    above the one below: similar sets are of one band or of neighbouring ones. A full band is cut into parts.
    """
    banded = member.withColumn("band", F.floor(F.log(F.col("n") + F.lit(0.5)) / F.lit(float(np.log(DEN / NUM)))).cast("long"))
    totals = banded.groupBy("grp", "band").agg(F.sum("n").alias("t"))
    large = totals.groupBy("grp").agg(F.sum("t").alias("all")).filter(F.col("all") > BLOCK).select("grp")
    parts = totals.join(large, "grp").select("grp", "band", F.ceil(F.col("t") / BLOCK).cast("long").alias("parts"))
    unit = lambda band, part: F.shiftleft(band, 20) + part
    units = parts.select("grp", "band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    near = units.select("grp", unit(F.col("band"), F.col("part")).alias("unit"), F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    others = parts.join(near.groupBy("grp", "band").agg(F.collect_list("unit").alias("units")), ["grp", "band"])
    # a large group's sets are dealt over salts when they meet its few bands
    others = others.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = banded.withColumn("salt", F.pmod(F.hash("set_id"), F.lit(SALTS))).join(others, ["grp", "band", "salt"], "left")
    own = F.when(F.col("parts").isNull(), F.lit(0).cast("long")).otherwise(unit(F.col("band"), F.pmod(F.xxhash64("set_id"), F.col("parts"))))
    each = each.withColumn("own", own).withColumn("other", F.explode(F.coalesce("units", F.array(F.lit(0).cast("long")))))
    return each.select(
        "set_id", "key", "grp", "copies", (F.col("own") > F.col("other")).cast("int").alias("side"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )


def _joined(docs: DataFrame, words: int) -> DataFrame:
    """ngram_join() with set_id (0 without words) and keeps: whether the row stands for its component."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    named = stored(_named(docs, words))
    classes = _frequency_classes(named.filter("page is not null").select("page", "counts"))
    rows = named.filter("page is null").select("doc_id", "n", "set_id")
    each = stored(rows.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n")))
    candidates_table, candidates = components(_candidates(_prefixes(docs, words, classes)))
    # a root is its own member
    roots = candidates.select(F.col("root").alias("node"), "root").distinct()
    member = candidates.unionByName(roots).select(F.col("node").alias("set_id"), F.col("root").alias("grp"))
    member = stored(member.join(each, "set_id").select("set_id", F.xxhash64("first_id").alias("key"), "grp", "copies", "n"))
    placed = stored(_placed(member))
    small = placed.count() <= SMALL
    found = stored(_products(_sets(docs, words, member).join(F.broadcast(placed) if small else placed, ["set_id", "key"])))
    joined_table, joined = components(found.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("set_id").agg(F.sum("linked").alias("linked"))
    near = (
        each.join(joined.select(F.col("node").alias("set_id"), "root"), "set_id", "left").join(linked, "set_id", "left")
        .select("set_id", "first_id", "copies", F.coalesce("root", "set_id").alias("root"), F.coalesce("linked", F.lit(0)).alias("linked"))
    )
    by_id = F.struct(F.col("first_id").isNull(), "first_id", "set_id")
    least = near.groupBy("root").agg(F.min("first_id").alias("component_id"), F.min_by("set_id", by_id).alias("keeper"))
    of_set = near.join(least, "root").select(
        "set_id", "first_id", "component_id", (F.col("set_id") == F.col("keeper")).alias("keeps"), (F.col("linked") + F.col("copies") - 1).alias("n_links")
    )
    of_set = stored(of_set)
    forget(each, member, placed, found, candidates_table, joined_table)
    return (
        rows.join(of_set, "set_id", "left")
        .select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).cast(id_type).alias("component_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "set_id", (F.col("keeps") & F.col("doc_id").eqNullSafe(F.col("first_id"))).alias("keeps"),
        )
    )


def ngram_join(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every row.

    Two rows link if 100 * |intersection| >= 75 * |union| of their sets of distinct
    ``words``-word shingles (fewer words: the whole sequence; none: no links).
    component_id is the least doc_id reachable by links, itself included; n_links counts
    the other rows linked directly. Equal sets, repeated rows too, link. Null doc_ids take
    part; a component of null ids alone is null. An empty table gives an empty table.

    Texts are read three times and never moved: names and counts, the first columns, and the
    sets of rows that can meet some other.
    """
    return _joined(docs, words).select("doc_id", "n_shingles", "component_id", "n_links")


def _with_set_ids(docs: DataFrame, words: int) -> DataFrame:
    """Every row of ``docs``, all columns kept, with the name of its set as __set."""
    at = docs.columns.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", __set long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [set_ids(*shingle_sets(texts, words)) for _, texts in batches_of(b.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate([np.zeros(0, np.int64), *ids]))], [*b.schema.names, "__set"])

    return docs.mapInArrow(released(run), schema)


def one_of_each(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row of each group of near copies, the one of least doc_id; rows without words all stay. Columns unchanged.

    Rows with one doc_id but dissimilar texts, and rows with null ids, are told apart by their sets.
    """
    kept = _joined(docs, words).filter("keeps").select(F.col("doc_id").alias("__id"), F.col("set_id").alias("__s")).distinct()
    named = _with_set_ids(docs, words)
    met = named.filter("__set <> 0").join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__set") == F.col("__s")), "left_semi")
    once = met.dropDuplicates(["doc_id", "__set"])
    return once.unionByName(named.filter("__set = 0")).select(*docs.columns)


def op2(docs: DataFrame) -> DataFrame:
    """ngram_join() by five words."""
    return ngram_join(docs.select("doc_id", "text"))
