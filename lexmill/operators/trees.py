"""Folds from the root of a tree to its leaves: what a node inherits from the nodes above it.

A tree's rows pass once, in document order, through a stack of the open ancestors' states, so
the plan has one shuffle whatever the depth, and a task keeps one state a level and no tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import is_structural, semantic_label, space_heading

#: Labels of divisions, from the whole down, and of what has no place.
LABELS = ("篇", "部", "章", "節", "小節", "小小節", "?")


def fold_down(rows: DataFrame, key: str, seq: str, depth: str, start: object, step: Callable, outputs: dict[str, str], reads: list[str] | None = None) -> DataFrame:
    """``rows`` with the ``outputs`` (name: type) that ``step(state, row)`` gives each.

    A row's parent is the last row before it in its ``key``, by ``seq``, of smaller ``depth``;
    top rows have ``start`` as their parent's state. ``step`` gets the parent's state and the row's
    ``reads``, and returns the state for the rows below and a tuple of outputs; it must not change the state it gets.
    Rows with a null depth hang on what is open and open nothing. Null keys are one tree; rows of equal seq come
    in any order. An empty table gives an empty table.
    """
    reads = reads or rows.columns
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{n}` {k}" for n, k in {**kinds, **outputs}.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, stack = object(), []  # stack: (depth, state for the rows below)
        for b in batches:
            made: list[tuple] = []
            columns = {c: b.column(c).to_pylist() for c in dict.fromkeys([*reads, key, depth])}
            for i, (k, d) in enumerate(zip(columns[key], columns[depth], strict=True)):
                if k != tree:
                    tree, stack = k, []
                while d is not None and stack and stack[-1][0] >= d:
                    stack.pop()
                state, told = step(stack[-1][1] if stack else start, {c: columns[c][i] for c in reads})
                if d is not None:
                    stack.append((d, state))
                made.append(told)
            told_columns = zip(*made, strict=True) if made else [()] * len(outputs)
            arrays = [pa.array(list(c), pa_type(t)) for c, t in zip(told_columns, outputs.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, *arrays], [*b.schema.names, *outputs])

    return rows.repartition(key).sortWithinPartitions(key, seq).mapInArrow(run, schema)


def pa_type(name: str) -> pa.DataType:
    return {"int": pa.int32(), "long": pa.int64(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[name]


def labelled(toc: DataFrame, key: str = "doc_id", seq: str = "seq", level: str = "level", text: str = "text", top: str = LABELS[0]) -> DataFrame:
    """``toc`` with heading (spaced), parent_seq and label: each label follows from the heading's pattern and its parent's label.

    What a heading becomes below each label is told by Column expressions; the fold only picks.
    """
    kinds = {f.name: f.dataType.simpleString() for f in toc.schema}
    spaced = toc.withColumn("heading", space_heading(F.col(text)))
    under = spaced.withColumn("__under", F.create_map(*(x for above in LABELS for x in (F.lit(above), semantic_label(F.col("heading"), F.lit(above))))))

    def step(state: tuple, row: dict) -> tuple:
        parent, label = state
        mine = dict(row["__under"] or []).get(label, LABELS[-1])
        return (row[seq], mine), (parent, mine)

    found = fold_down(under, key, seq, level, (None, top), step, {"parent_seq": kinds[seq], "label": "string"}, [seq, "__under"])
    return found.drop("__under")


#: The heading that gets no line of its own, and the mark of an appendix.
PREFACE, APPENDIX = "前言", "附"


def appendix_parts(heading: Column) -> tuple[Column, Column]:
    """The heading and the subtitle (null if none) of a division: an appendix's name is set apart from its mark."""
    rest = F.regexp_extract(heading, f"^{APPENDIX}[：　]?(.+)$", 1)
    apart = heading.rlike(f"^{APPENDIX}[：　].") | heading.rlike(f"^{APPENDIX}[一-鿿㐀-䶿]")
    return F.when(apart, f"{APPENDIX}：").otherwise(heading), F.when(apart, rest)


def walked(rows: DataFrame, key: str, seq: str, depth: str, level: str, heading: str, kind: str, block: str, skip: Column | None = None) -> DataFrame:
    """Divisions and blocks in document order with toc_line, body_line and dropped.

    A row with a ``block`` is a paragraph, others are divisions with a ``heading`` (null or empty: none), a
    ``level`` and a ``kind``. Divisions without heading give no line; what hangs on one of kind
    orig itself is quoted. Divisions whose heading ``skip`` names (by default structural ones) go with
    all below them. Of a division of level 1 only the divisions below it are rendered. Others have a
    contents line at indent 4 * (level - 3) and a heading of min(6, max(floor, level + offset)) marks;
    below an appendix the offset is 1 - level and the floor 2, else 0 and 3. A preface has no heading line.
    A null level is 1. The names of appendixes follow their mark on a line of their own.
    """
    skip = is_structural(F.col(heading)) if skip is None else skip
    name, subtitle = appendix_parts(F.col(heading))
    read = rows.withColumns({"__skip": F.coalesce(skip, F.lit(False)), "__name": F.coalesce(name, F.lit("")), "__sub": subtitle, "__level": F.coalesce(level, F.lit(1))})

    def step(state: tuple, row: dict) -> tuple:
        offset, dropped, silent, quoted = state
        if dropped:
            return state, (None, None, True)
        if row[block] is not None:
            return state, (None, None if silent else f"> **{row[block]}**" if quoted else row[block], silent)
        own, level_ = row["__name"], row["__level"]
        if not own:
            return (offset, False, False, row[kind] == "orig"), (None, None, False)
        if row["__skip"]:
            return (offset, True, False, False), (None, None, True)
        if level_ == 1:
            return (offset, False, True, False), (None, None, False)
        shown, floor = level_ + offset, 2 if offset < 0 else 3
        toc = "    " * max(0, level_ - 3) + "- " + own + (row["__sub"] or "")
        body = None if own == PREFACE else "#" * min(6, max(floor, shown)) + " " + "　　" * max(0, shown - floor) + own + (f"\n# {row['__sub']}" if row["__sub"] else "")
        return (1 - level_ if row["__sub"] else offset, False, False, False), (toc, body, False)

    found = fold_down(read, key, seq, depth, (0, False, False, False), step, {"toc_line": "string", "body_line": "string", "dropped": "boolean"}, [block, kind, "__skip", "__name", "__sub", "__level"])
    return found.drop("__skip", "__name", "__sub", "__level")
