"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors of cosine c are at squared distance 2 - 2c. Rotated vectors are split into
blocks; each block gets the share of the squared distance that its dimensions are
of all. Two vectors within the whole distance are within the share in one block at
least, so a range join in each block finds every pair; the union is verified exactly.
Equal vectors are one vector with a number of copies before anything is joined.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import forget, released, stored
from lexmill.llm.graph import components, local_roots

COSINE = 0.95
#: Dimensions of a block, about.
BLOCK_DIMS = 8
#: A cell is so many search radii wide; vectors near its upper side also go to the next cell.
CELL_RADII = 3.0
#: Vector components of a cell that are compared in one task, about; fuller cells are split into parts.
PART_VALUES = 3 << 20
#: Parts that a middling cell may have before the grid cuts one more dimension of each block, and the share of vectors that a cut leaves together.
PARTS, TOGETHER = 8, 0.65
#: Rows compared at once with all others of a part.
STEP = 128
#: Rounding of distances in a block may not lose a pair.
SLACK = 1e-5
SEED = 11


@dataclass(frozen=True)
class Blocks:
    """Where the blocks of a dimension begin and end, their shares, and the rotation."""

    edges: tuple[int, ...]
    shares: np.ndarray
    rotation: np.ndarray


@lru_cache(maxsize=8)
def blocks_of(dims: int, cosine: float) -> Blocks:
    """The seeded rotation and the blocks' budgets of squared distance, in proportion to their dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    n = max(1, dims // BLOCK_DIMS)
    edges = np.linspace(0, dims, n + 1).round().astype(int)
    shares = (2 - 2 * cosine) * np.diff(edges) / dims
    return Blocks(tuple(edges.tolist()), shares, q * np.sign(np.diag(r)))


def unit_rows(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in double precision scaled to length 1, and which are usable."""
    raw = raw.astype(np.float64)
    with np.errstate(all="ignore"):
        scale = np.abs(raw).max(axis=1, keepdims=True)
        norm = np.linalg.norm(raw / scale, axis=1, keepdims=True)
        unit = raw / scale / norm
    fine = np.isfinite(raw).all(axis=1) & (scale[:, 0] > 0)
    return unit, fine


def part_rows(dims: int) -> int:
    """Vectors of a part."""
    return max(2, PART_VALUES // dims)


def grid_dims(n: int, part: int) -> int:
    """Leading dimensions of a block that the grid cuts for ``n`` vectors: more for more, so that cells have few parts."""
    return max(1, min(BLOCK_DIMS, math.ceil(math.log(max(n / (PARTS * part), 1)) / -math.log(TOGETHER))))


def _cell_ids(cells: np.ndarray) -> np.ndarray:
    """One integer for the coordinates of each cell."""
    out = np.zeros(len(cells), np.int64)
    for k in range(cells.shape[1]):
        out = out * 0x5851F42D4C957F2D + cells[:, k]
    return out


def _cells(x: np.ndarray, width: float, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, cells) of leading coordinates x: the cell of each row and the next ones that its upper sides come near."""
    home = np.floor(x / width).astype(np.int64)
    near = x > (home + 1) * width - radius
    for step in itertools.product((0, 1), repeat=x.shape[1]):
        s = np.array(step)
        rows = np.flatnonzero((near | (s == 0)).all(axis=1))
        if len(rows):
            yield rows, home[rows] + s


def _placed(vectors: DataFrame, cosine: float, most: int, full: dict | None) -> DataFrame:
    """A row for each vector (node, copies, embedding), block and cell: dims, block, cell, and with ``full`` part pairs and the vector as it came."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, copies = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            sizes = pc.list_value_length(b.column(2)).to_numpy(zero_copy_only=False)
            values, ends = b.column(2).flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
            for dims in np.unique(sizes[sizes > 0]).tolist():
                at = np.flatnonzero(sizes == dims)
                raw = values[(ends[at] - dims)[:, None] + np.arange(dims)]
                unit, fine = unit_rows(raw)
                raw, unit, at = raw[fine], unit[fine], at[fine]
                plan = blocks_of(dims, cosine)
                turned = unit @ plan.rotation
                for k, (a, e) in enumerate(itertools.pairwise(plan.edges)):
                    radius = float(np.sqrt(plan.shares[k]) + SLACK)
                    for rows, cells in _cells(turned[:, a : a + min(most, e - a)], CELL_RADII * radius, radius):
                        cell = _cell_ids(cells)
                        if full is None:
                            yield _batch([np.full(len(rows), dims), np.full(len(rows), k), cell], ["dims", "block", "cell"])
                        else:
                            yield _parts(nodes[at[rows]], copies[at[rows]], raw[rows], dims, k, cell, full)

    names = "dims long, block long, cell long"
    if full is not None:
        names += ", i long, j long, side long, node long, copies long, raw binary"
    return vectors.select("node", "copies", "embedding").mapInArrow(released(run), names)


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(np.ascontiguousarray(x, dtype=np.int64)) for x in columns], names)


def _parts(nodes: np.ndarray, copies: np.ndarray, raw: np.ndarray, dims: int, block: int, cell: np.ndarray, full: dict) -> pa.RecordBatch:
    """Rows with the part pairs of their cell: a cell of n parts has n (n + 1) / 2 pairs, of which a row enters n."""
    known, where = np.unique(cell, return_inverse=True)
    n = np.array([full.get((dims, block, c), 1) for c in known.tolist()])[where]
    side = (nodes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % n
    row = np.repeat(np.arange(len(nodes)), n)
    other = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    mine = side[row]
    width = raw.dtype.itemsize * dims
    data = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(row), [None, pa.py_buffer(np.ascontiguousarray(raw[row]))]).cast(pa.binary())
    names = ["dims", "block", "cell", "i", "j", "side", "node", "copies", "raw"]
    return _batch([np.full(len(row), dims), np.full(len(row), block), cell[row], np.minimum(mine, other), np.maximum(mine, other), mine, nodes[row], copies[row], data], names)


def cell_links(unit: np.ndarray, dims: int, block: int, cell: int, cross: np.ndarray | None, cosine: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the cosine that this block and cell answer for: the first block within its share, the upper cell of both."""
    plan = blocks_of(dims, cosine)
    edges = plan.edges
    radius = float(np.sqrt(plan.shares[block]) + SLACK)
    a, e = edges[block], edges[block + 1]
    grid = min(most, e - a)
    turned = unit @ plan.rotation
    home = np.floor(turned[:, a : a + grid] / (CELL_RADII * radius)).astype(np.int64)
    part = turned[:, a:e].astype(np.float32)
    square = (part * part).sum(axis=1)
    order = np.argsort(part[:, -1], kind="stable") if e - a > grid else np.arange(len(unit))
    part, square, last = part[order], square[order], part[order, -1]
    ends = np.searchsorted(last, last + np.float32(radius + SLACK), side="right")
    limit = np.float32(radius * radius + SLACK)
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s in range(0, len(part), STEP):
        t = min(s + STEP, len(part))
        far = int(ends[t - 1]) if e - a > grid else len(part)
        d = square[s:t, None] + square[None, s:far] - 2 * (part[s:t] @ part[s:far].T)
        p, q = np.nonzero(d <= limit)
        keep = q > p
        p, q = order[p[keep] + s], order[q[keep] + s]
        if cross is not None:
            keep = cross[p] != cross[q]
            p, q = p[keep], q[keep]
        for u in range(0, len(p), 1 << 16):
            x, y = p[u : u + (1 << 16)], q[u : u + (1 << 16)]
            near = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
            x, y = x[near], y[near]
            upper = _cell_ids(np.maximum(home[x], home[y]))
            mine = upper == cell
            x, y = x[mine], y[mine]
            if block and len(x):
                gap = turned[x, :a] - turned[y, :a]
                dist = np.add.reduceat(gap * gap, np.array(edges[:block]), axis=1)
                # the same sums and shares decide in every block, so one block answers for a pair
                first = ~(dist <= plan.shares[:block] + SLACK).any(axis=1)
                x, y = x[first], y[first]
            if len(x):
                gap = turned[x, a:e] - turned[y, a:e]
                here = np.add.reduceat(gap * gap, np.array([0]), axis=1)[:, 0] <= plan.shares[block] + SLACK
                x, y = x[here], y[here]
            out_a.append(x)
            out_b.append(y)
    return np.concatenate(out_a), np.concatenate(out_b)


def _compared(placed: DataFrame, cosine: float, most: int, dtype: type) -> DataFrame:
    """node, root, linked of each linked vector in each part pair of each cell."""
    keys = ["dims", "block", "cell", "i", "j"]

    def compare(key: tuple, parts: list[tuple]) -> pa.RecordBatch:
        dims, block, cell, i, j = key
        side, nodes, copies = (np.concatenate([p[c] for p in parts]) for c in range(3))
        unit, _ = unit_rows(np.frombuffer(b"".join(p[3] for p in parts), dtype).reshape(-1, dims))
        a, b = cell_links(unit, dims, block, cell, side if i != j else None, cosine, most)
        root = local_roots(len(nodes), a, b)
        linked = np.bincount(a, copies[b], len(nodes)) + np.bincount(b, copies[a], len(nodes))
        live = linked > 0
        return _batch([nodes[live], nodes[root[live]], linked[live]], ["node", "root", "linked"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, size = None, [], 0
        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(i).to_numpy(zero_copy_only=False) for i in range(8)]
            raw = b.column(8).cast(pa.large_binary())
            ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
            data = memoryview(raw.buffers()[2])
            change = np.zeros(b.num_rows, bool)
            for c in columns[:5]:
                change[1:] |= c[1:] != c[:-1]
            for s, e in itertools.pairwise([0, *np.flatnonzero(change).tolist(), b.num_rows]):
                k = tuple(int(c[s]) for c in columns[:5])
                if k != key:
                    if size > 1:
                        yield compare(key, parts)
                    key, parts, size = k, [], 0
                parts.append((*(c[s:e].copy() for c in columns[5:]), bytes(data[ends[s] : ends[e]])))
                size += e - s
        if size > 1:
            yield compare(key, parts)

    return placed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(released(run), "node long, root long, linked long")


def embedding_join(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding).

    Rows of cosine >= ``cosine`` link, in double precision, whatever their other columns.
    Vectors that are null, empty, zero, or hold nulls or non-finite numbers link with
    nothing, nor do vectors of different lengths. Rows of equal vec_id count each as a row; a
    null vec_id links with nothing and is its own component (null). kept: vec_id = component_id.
    Arrays of integers or decimals are taken as doubles.

    Equal vectors meet by 128 bits of hash and travel once, with their number. A cell's vectors stay in
    its task or, of full cells, in pairs of parts of bounded size; pairs are counted where they are
    found and never sent, only counts and roots are.
    """
    kind = vectors.schema["embedding"].dataType.elementType.typeName()
    dtype = np.float32 if kind == "float" else np.float64
    embedding = F.col("embedding") if kind in ("float", "double") else F.col("embedding").cast("array<double>")
    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), embedding.alias("embedding"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    usable = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", number) & F.exists("embedding", lambda x: x != 0)
    key = [F.when(usable, F.xxhash64("embedding")).alias("h1"), F.when(usable, F.xxhash64(F.lit("vector"), "embedding")).alias("h2")]
    distinct = named.filter(usable).select(*key, "vec_id", "embedding").groupBy("h1", "h2")
    distinct = distinct.agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
    nodes = stored(distinct.withColumn("node", F.monotonically_increasing_id()))
    sizes = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dims")).first()
    most = grid_dims(sizes["n"], part_rows(sizes["dims"] or 1))
    # the list of full cells: at most as many as vectors' places divided by part_rows
    counted = _placed(nodes, cosine, most, None).groupBy("dims", "block", "cell").count().filter(F.col("dims") * F.col("count") > PART_VALUES).collect()
    full = {(r["dims"], r["block"], r["cell"]): -(-r["count"] // part_rows(r["dims"])) for r in counted}
    found = stored(_compared(_placed(nodes, cosine, most, full), cosine, most, dtype))
    table, roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = roots.select("node", F.col("root").alias("r"))
    links = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    met = nodes.select("h1", "h2", "node", "first_id", "copies").join(links, "node", "left").join(roots, "node", "left").withColumn("r", F.coalesce("r", "node"))
    least = met.groupBy("r").agg(F.min("first_id").alias("component_id"))
    told = stored(met.join(least, "r").select("h1", "h2", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    forget(nodes, found, table)
    return (
        named.select("vec_id", *key).join(told, ["h1", "h2"], "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )


def op1(vectors: DataFrame) -> DataFrame:
    """embedding_join() at cosine 0.95."""
    return embedding_join(vectors)
