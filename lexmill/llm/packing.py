"""Best-fit packing by a linear grouping scheme.

Lengths are at most the capacity, so all that planning needs is how many pieces have
each length: a table of at most ``capacity`` rows, whatever the number of documents.
The plan is made from it on the driver; documents then take their places by their
rank among pieces of equal length, in parallel.

Large lengths: sorted, cut into groups of equal cardinality, rounded up to the largest
of the group; configurations of these few sizes are chosen one after the other, each
the fullest that begins with the largest size left, and used as often as counts allow.
The documents themselves take the places. Small lengths then go, largest first, to
the sequences with the least room that still holds them.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import stored
from lexmill.llm.tokens import token_pieces

CAPACITY = 4096
#: Lengths of at most this part of the capacity are small.
SMALL_PART = 4
#: Groups of equal cardinality among the large lengths.
GROUPS = 1024
#: Rows that one task ranks, about, and runs at most.
RUN, MOST_RUNS = 4000, 4096


@dataclass
class Intervals:
    """Ranks [lo, next lo) take places ``base + rank - lo``; ``tag`` and ``slot`` tell which."""

    lo: np.ndarray
    base: np.ndarray
    tag: np.ndarray
    slot: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, int, int, int]]) -> Intervals:
        a = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
        return cls(a[:, 0].copy(), a[:, 1].copy(), a[:, 2].copy(), a[:, 3].copy())

    def find(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i = np.searchsorted(self.lo, rank, side="right") - 1
        return self.base[i] + rank - self.lo[i], self.tag[i], self.slot[i]


def group_sizes(counts: dict[int, int], groups: int = GROUPS) -> list[tuple[int, int, int]]:
    """(rounded size, first rank, count) of groups of equal cardinality; ranks go from long to short."""
    total = sum(counts.values())
    if not total:
        return []
    lengths = sorted(counts, reverse=True)
    ends = np.cumsum([counts[x] for x in lengths])
    edges = sorted({round(i * total / groups) for i in range(groups + 1)})
    return [(lengths[int(np.searchsorted(ends, a, side="right"))], a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _fullest(sizes: list[int], left: list[int], first: int, capacity: int) -> dict[int, int]:
    """The fullest configuration that holds group ``first``; reachable fills are bits of an integer."""
    room = capacity - sizes[first]
    mask, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int]] = []
    for g in range(first, len(sizes)):
        copies = min(left[g] - (g == first), room // sizes[g])
        for _ in range(max(0, copies)):
            steps.append((g, reach))
            reach |= (reach << sizes[g]) & mask
        if reach >> room & 1:
            break
    fill, used = reach.bit_length() - 1, {first: 1}
    for g, before in reversed(steps):
        if fill and not before >> fill & 1:
            used[g] = used.get(g, 0) + 1
            fill -= sizes[g]
    return used


def plan_large(counts: dict[int, int], capacity: int) -> tuple[Intervals, int]:
    """Places of large pieces by rank from long to short, and the number of sequences."""
    found = group_sizes(counts)
    sizes, at, left = [x[0] for x in found], [x[1] for x in found], [x[2] for x in found]
    rows, sequences = [], 0
    for first in range(len(found)):
        while left[first]:
            used = _fullest(sizes, left, first, capacity)
            times = min(left[g] // n for g, n in used.items())
            slot = 0
            for g, n in sorted(used.items()):
                for _ in range(n):
                    rows.append((at[g], sequences, 0, slot))
                    at[g] += times
                    left[g] -= times
                    slot += 1
            sequences += times
    return Intervals.of(rows), sequences


def plan_small(counts: dict[int, int], rooms: dict[int, int], capacity: int) -> tuple[dict[int, Intervals], int]:
    """Places of small pieces by length and rank: a room class and the rank in it; class ``capacity`` is new sequences.

    ``rooms``: sequences by room left. Runs of sequences move through the classes
    together, so the plan grows with the capacity and not with the number of pieces.
    """
    runs: dict[int, list[tuple[int, int, int]]] = {}
    open_rooms: list[int] = []

    def put(room: int, run: tuple[int, int, int]) -> None:
        if room not in runs:
            runs[room] = []
            bisect.insort(open_rooms, room)
        runs[room].append(run)

    for room, n in sorted(rooms.items()):
        if room > 0 and n:
            put(room, (room, 0, n))
    new, step, plan = 0, 0, {}
    for length in sorted(counts, reverse=True):
        done, n, rows = 0, counts[length], []
        while done < n:
            i = bisect.bisect_left(open_rooms, length)
            if i == len(open_rooms):
                more = -(-(n - done) // (capacity // length))
                put(capacity, (capacity, new, new + more))
                new += more
                continue
            room = open_rooms[i]
            kind, lo, hi = runs[room].pop()
            q = min(n - done, hi - lo)
            rows.append((done, lo, kind, step))
            if q < hi - lo:
                runs[room].append((kind, lo + q, hi))
            if not runs[room]:
                del runs[room]
                open_rooms.pop(i)
            if room > length:
                put(room - length, (kind, lo, lo + q))
            done += q
            step += 1
        plan[length] = Intervals.of(rows)
    return plan, new


def ranked(df: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """``df`` with ``rank`` from 0 among rows of equal ``key``; keys of any frequency are ranked in runs."""
    runs = max(1, min(MOST_RUNS, n // RUN))
    cut = df.withColumn("run", F.pmod(F.hash(*order), F.lit(runs)))
    ahead = Window.partitionBy(key).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(key, "run").agg(F.count(F.lit(1)).alias("c")).withColumn("ahead", F.coalesce(F.sum("c").over(ahead), F.lit(0)))
    inside = Window.partitionBy(key, "run").orderBy(*order)
    return (
        cut.withColumn("rank", F.row_number().over(inside) - 1)
        .join(sums.drop("c"), [key, "run"])
        .withColumn("rank", (F.col("rank") + F.col("ahead")).cast("long"))
        .drop("run", "ahead")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ... of at most ``capacity``) with sequence_id and offset.

    ``pieces`` must be stored rows, since they are read again. Rows that are alike in all
    columns get places of their own. An empty table gives an empty table.
    """
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    n, small_most = sum(counts.values()), capacity // SMALL_PART
    large = {k: v for k, v in counts.items() if k > small_most}
    places, n_large = plan_large(large, capacity)
    first, total = np.zeros(capacity + 1, np.int64), 0
    for length in sorted(large, reverse=True):
        first[length], total = total, total + large[length]

    columns = pieces.columns
    order = ["doc_id", "piece", "ids_crc32"]
    rows = stored(ranked(pieces, "length", order, n))

    @F.pandas_udf("sequence_id long, slot long")
    def large_place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        seq, _, slot = places.find(first[length.to_numpy()] + rank.to_numpy())
        return pd.DataFrame({"sequence_id": seq, "slot": slot})

    big = rows.filter(F.col("length") > small_most).withColumn("p", large_place("length", "rank")).select(*columns, "p.sequence_id", "p.slot")
    big = stored(big)
    left = stored(big.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("room")).filter("room > 0"))
    rooms = {int(r["room"]): int(r["n"]) for r in left.groupBy("room").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, _ = plan_small({k: v for k, v in counts.items() if k <= small_most}, rooms, capacity)

    @F.pandas_udf("room long, nth long, slot long")
    def small_place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((3, len(length)), np.int64)
        sizes, ranks = length.to_numpy(), rank.to_numpy()
        for size in np.unique(sizes):
            at = sizes == size
            out[1, at], out[0, at], out[2, at] = plan[int(size)].find(ranks[at])
        return pd.DataFrame({"room": out[0], "nth": out[1], "slot": out[2]})

    little = rows.filter(F.col("length") <= small_most).withColumn("p", small_place("length", "rank")).select(*columns, "p.room", "p.nth", (F.col("p.slot") + capacity).alias("slot"))
    homes = ranked(left, "room", ["sequence_id"], sum(rooms.values())).select("room", F.col("rank").alias("nth"), "sequence_id")
    fills = little.filter(F.col("room") < capacity).join(homes, ["room", "nth"]).select(*columns, "sequence_id", "slot")
    fresh = little.filter(F.col("room") == capacity).select(*columns, (F.col("nth") + n_large).alias("sequence_id"), "slot")
    ahead = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        big.unionByName(fills).unionByName(fresh)
        .withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("long"))
        .select(*columns, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    Null text is empty and so one piece, the end id alone. Rows with equal or null doc_id are
    packed row by row.
    """
    return pack(stored(token_pieces(docs, path, capacity, end_id)), capacity)


def op8(docs: DataFrame) -> DataFrame:
    """pack_documents() by the 49k vocabulary into sequences of 4096 tokens."""
    import public_tokenizers

    return pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
