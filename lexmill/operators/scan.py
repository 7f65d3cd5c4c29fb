"""Prefix scans over all rows in one order: numbers, fills, running sums and neighbours that go on from task to task.

Rows are range-sorted, so a task holds a run of them and even one key may span many tasks.
Each task scans its run and stores it; a summary of each run, as many as there are
tasks, is folded in order, and what is carried into a run comes back by a broadcast of that size.
No window and no group ever holds a key's rows together.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.session import shared_folder

_RUN, _ROW, _HEAD = "__run", "__row", "__head"


@dataclass
class _Key:
    """The rows of the key that is open at the end of what was read."""

    values: tuple = ()
    n: int = 0
    last: dict = field(default_factory=dict)  #: fills: the last value that is not null
    total: dict = field(default_factory=dict)  #: running sums
    before: dict = field(default_factory=dict)  #: the row before


def _changes(columns: list[pa.Array], rows: int) -> np.ndarray:
    """Whether each row but the first differs from the row before in any column; nulls are equal."""
    out = np.zeros(max(rows - 1, 0), bool)
    for c in columns:
        codes = c.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        out |= codes[1:] != codes[:-1]
    return out


def _scanned(batch: pa.RecordBatch, within: list[str], fills: dict, sums: dict, prev: dict, state: _Key, first: bool) -> tuple[dict, np.ndarray, bool]:
    """The scan's columns of one batch, whether each row is of the run's first key, and whether the last one is; ``state`` moves on."""
    rows = batch.num_rows
    key = lambda i: tuple(batch.column(c)[i].as_py() for c in within)
    goes_on = state.n > 0 and key(0) == state.values
    starts = np.concatenate([[not goes_on], _changes([batch.column(c) for c in within], rows)])
    begin = np.maximum.accumulate(np.where(starts, np.arange(rows), -1))  # -1: the key began before this batch
    at = np.arange(rows)
    out: dict = {"n": np.where(begin < 0, at + 1 + state.n, at - begin + 1)}
    carried: dict = {}
    for name, column in fills.items():
        values = batch.column(column)
        seen = np.maximum.accumulate(np.where(values.is_valid().to_numpy(zero_copy_only=False), at, -1))
        held = seen >= np.maximum(begin, 0)
        got = values.take(pa.array(np.where(held, seen, 0), pa.int64(), mask=~held))
        if goes_on and state.last.get(name) is not None:
            got = pa.compute.if_else(pa.array((begin < 0) & ~held), pa.scalar(state.last[name], values.type), got)
        out[name] = got
        carried[name] = got[rows - 1].as_py()
    totals: dict = {}
    for name, column in sums.items():
        upto = np.cumsum(batch.column(column).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False))
        got = upto - np.where(begin > 0, upto[np.maximum(begin - 1, 0)], 0) +np.where(begin < 0, state.total.get(name, 0), 0)
        out[name] = got
        totals[name] = int(got[-1])
    before: dict = {}
    for name, column in prev.items():
        values = batch.column(column)
        moved = pa.concat_arrays([pa.array([state.before.get(name) if goes_on else None], values.type), values.slice(0, rows - 1)])
        out[name] = pa.compute.if_else(pa.array(starts), pa.scalar(None, values.type), moved)
        before[name] = values[rows - 1].as_py()
    of_first = (begin < 0) if first else np.zeros(rows, bool)
    if first and state.n == 0:  # the run begins here: its first key is what lies before the first change
        changes = np.flatnonzero(starts[1:])
        of_first = at <= (changes[0] if len(changes) else rows)
    state.values, state.n = key(rows - 1), int(out["n"][-1])
    state.last, state.total, state.before = carried, totals, before
    return out, of_first, bool(of_first[-1])


def scan(
    rows: DataFrame,
    order: list[Column | str],
    within: list[str] | None = None,
    number: str = "seq",
    fills: dict[str, str] | None = None,
    sums: dict[str, str] | None = None,
    prev: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """``rows`` (their columns ``keep``, by default all) with what the rows up to each one say, in ``order``.

    ``number`` counts from 1; ``fills`` (new name: column) repeat the last value that is not
    null, the row's own included; ``sums`` add integers up, nulls as 0; ``prev`` and
    ``following`` are the value of the row before and behind, null where there is none.
    All of them begin anew with each key of ``within``; without it there is one scan over the
    whole table. Nulls are a key like others. Rows that ``order`` does not tell apart come in
    any order, but each row has one number. An empty table gives an empty table.

    A scan costs one range shuffle and one stored table, however large a key is.
    """
    within, fills, sums, prev, following = within or [], fills or {}, sums or {}, prev or {}, following or {}
    keep = keep or rows.columns
    spark = rows.sparkSession
    needed = list(dict.fromkeys([*keep, *within, *fills.values(), *sums.values(), *prev.values(), *following.values()]))
    placed = rows.repartitionByRange(*within, *order).sortWithinPartitions(*within, *order).select(*needed)
    kinds = {f.name: f.dataType for f in rows.schema}
    made = T.StructType(
        [T.StructField(n, kinds[n]) for n in needed]
        + [T.StructField(number, T.LongType())]
        + [T.StructField(n, kinds[c]) for n, c in (fills | prev | following).items()]
        + [T.StructField(n, T.LongType()) for n in sums]
        + [T.StructField(_RUN, T.IntegerType()), T.StructField(_ROW, T.LongType()), T.StructField(_HEAD, T.BooleanType())]
    )

    def shifted(b: pa.RecordBatch, behind: pa.RecordBatch | None) -> list[pa.Array]:
        """The values of the row behind each, of the same key; of the last row by the first of the batch behind."""
        same = np.append(~_changes([b.column(c) for c in within], b.num_rows), behind is not None and all(b.column(c)[-1].as_py() == behind.column(c)[0].as_py() for c in within))
        out = []
        for c in following.values():
            x = b.column(c)
            moved = pa.concat_arrays([x.slice(1), behind.column(c).slice(0, 1) if behind is not None else pa.nulls(1, x.type)])
            out.append(pa.compute.if_else(pa.array(same), moved, pa.scalar(None, x.type)))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, part, at, first = _Key(), TaskContext.get().partitionId(), 0, True
        here = None
        for behind in itertools.chain((b for b in batches if b.num_rows), [None]):
            if here is not None:
                got, head, first = _scanned(here, within, fills, sums, prev, state, first)
                n = here.num_rows
                columns = [*here.columns, pa.array(got["n"], pa.int64()), *(got[x] for x in (fills | prev)), *shifted(here, behind), *(pa.array(got[x], pa.int64()) for x in sums)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(at, at + n), pa.int64()), pa.array(head)], names=made.names)
                at += n
            here = behind

    path = shared_folder(spark, "scan")
    placed.mapInArrow(run, made).write.parquet(path)
    held = spark.read.schema(made).parquet(path)
    return _carried_on(held, within, number, fills, sums, prev, following).select(*keep, number, *fills, *sums, *prev, *following)


def _carried_on(held: DataFrame, within: list[str], number: str, fills: dict, sums: dict, prev: dict, following: dict) -> DataFrame:
    """The stored runs with what is carried into each: one summary a run comes to the driver and goes back."""
    spark = held.sparkSession
    ends = F.struct(_ROW, F.struct(*within, F.lit(0).alias("__0")).alias("key"), F.col(number).alias("n"), _HEAD, F.struct(*fills, F.lit(0).alias("__0")).alias("fills"), F.struct(*sums, F.lit(0).alias("__0")).alias("sums"), F.struct(*(F.col(c).alias(p) for p, c in prev.items()), F.lit(0).alias("__0")).alias("prev"))
    begins = F.struct(_ROW, F.struct(*within, F.lit(0).alias("__0")).alias("key"), F.struct(*(F.col(c).alias(p) for p, c in following.items()), F.lit(0).alias("__0")).alias("following"))
    summaries = sorted(
        held.groupBy(_RUN).agg(F.max_by(ends, _ROW).alias("end"), F.min_by(begins, _ROW).alias("begin")).collect(), key=lambda r: r[_RUN]
    )
    carried, state = [], None
    for i, r in enumerate(summaries):
        begin, end = r["begin"], r["end"]
        goes_on = state is not None and state["key"] == begin["key"]
        into = state if goes_on else None
        behind = summaries[i + 1]["begin"] if i + 1 < len(summaries) and summaries[i + 1]["begin"]["key"] == end["key"] else None
        carried.append((
            r[_RUN], end[_ROW], into["n"] if into else 0, *(into["fills"][x] if into else None for x in fills), *(into["sums"][x] if into else 0 for x in sums),
            *(into["prev"][x] if into else None for x in prev), *(behind["following"][x] if behind else None for x in following),
        ))
        whole = bool(end[_HEAD]) and goes_on  # the run is of one key, which was open before
        state = {
            "key": end["key"], "n": end["n"] + (into["n"] if whole else 0),
            "fills": {x: end["fills"][x] if end["fills"][x] is not None or not whole else into["fills"][x] for x in fills},
            "sums": {x: end["sums"][x] + (into["sums"][x] if whole else 0) for x in sums}, "prev": {x: end["prev"][x] for x in prev},
        }
    kinds = {f.name: f.dataType for f in held.schema}
    schema = T.StructType(
        [T.StructField("__r", T.IntegerType()), T.StructField("__end", T.LongType()), T.StructField("__n", T.LongType())]
        + [T.StructField(f"__f_{x}", kinds[c]) for x, c in fills.items()] + [T.StructField(f"__s_{x}", T.LongType()) for x in sums]
        + [T.StructField(f"__p_{x}", kinds[c]) for x, c in prev.items()] + [T.StructField(f"__b_{x}", kinds[c]) for x, c in following.items()]
    )
    met = held.join(F.broadcast(spark.createDataFrame(carried, schema)), F.col(_RUN) == F.col("__r"))
    head = F.col(_HEAD)
    met = met.select(
        *(c for c in held.columns if c not in {number, *fills, *sums, *prev, *following, _HEAD}),
        (F.col(number) + F.when(head, F.col("__n")).otherwise(0)).alias(number),
        *(F.coalesce(x, F.when(head, F.col(f"__f_{x}"))).alias(x) for x in fills),
        *((F.col(x) + F.when(head, F.col(f"__s_{x}")).otherwise(0)).alias(x) for x in sums),
        *(F.when(F.col(_ROW) == 0, F.col(f"__p_{x}")).otherwise(F.col(x)).alias(x) for x in prev),
        *(F.when(F.col(_ROW) == F.col("__end"), F.col(f"__b_{x}")).otherwise(F.col(x)).alias(x) for x in following),
    )
    return met
