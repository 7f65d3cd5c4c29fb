"""Elements of large files by byte ranges: no task reads more of a file than its range and the elements that begin in it.

A Python data source whose partitions are ranges of bytes. An element belongs to the range in
which its mark begins; its start may lie before the range and its end behind it, and only what is needed of
either is read. Any size of ranges gives the rows that reading whole files gives.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "path string, byte_start long, byte_end long, chunk binary, bytes_read long"
#: Bytes that are read at once beyond a range's ends.
STEP = 1 << 14
#: Above so many ranges, neighbours are read one after the other by one task, as long as they are no more than so many bytes.
MANY_RANGES, TASK_BYTES = 200, 1 << 25


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, with or without a scheme, and the path in it."""
    if path.startswith("file:"):
        path = re.sub("^file:/*", "/", path)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def files_below(path: str, suffix: str = "") -> list[tuple[str, int]]:
    """Path and size of a file, or of all files below a folder but hidden ones and those of writers at work, by name."""
    system, at = file_system(path)
    info = system.get_file_info(at)
    found = [info] if info.is_file else system.get_file_info(pafs.FileSelector(at, recursive=True))
    scheme = path.split("://")[0] + "://" if "://" in path and not path.startswith("file:") else ""
    hidden = lambda p: any(x.startswith(("_", ".")) for x in p[len(at) :].split("/"))
    return sorted((scheme + f.path, f.size) for f in found if f.is_file and f.path.endswith(suffix) and not hidden(f.path))


class Window:
    """A part of an open file that grows to either side; ``read`` counts the bytes that were read."""

    def __init__(self, stream, size: int, a: int, b: int):
        self.stream, self.size, self.lo, self.hi, self.read = stream, size, a, a, 0
        self.data = bytearray()
        self.right(b - a)

    def right(self, n: int) -> bool:
        """Whether there was more to read."""
        n = min(n, self.size - self.hi)
        if n <= 0:
            return False
        self.stream.seek(self.hi)
        self.data += self.stream.read(n)
        self.read += n
        self.hi += n
        return True

    def left(self, n: int) -> bool:
        n = min(n, self.lo)
        if n <= 0:
            return False
        self.stream.seek(self.lo - n)
        self.data[:0] = self.stream.read(n)
        self.read += n
        self.lo -= n
        return True


class Elements:
    """What an element is: the tag whose attributes mark it, and the tag around it."""

    def __init__(self, tag: str = "cb:div", mark: str = "cb:mulu", where: str = r'\blevel="2"'):
        self.open, self.mark = b"<" + tag.encode(), b"<" + mark.encode()
        self.where = re.compile(self.mark + rb"\b[^>]*" + where.encode())
        self.tags = re.compile(self.open + rb"\b|</" + tag.encode() + b">")

    def of_range(self, w: Window, a: int, b: int) -> Iterator[tuple[int, int]]:
        """[start, end) of the elements whose mark begins in [a, b)."""
        w.right(len(self.mark) + 1)
        at = a
        while (p := w.data.find(self.mark, at - w.lo)) >= 0 and p + w.lo < b:
            p += w.lo
            while (close := w.data.find(b">", p - w.lo)) < 0 and w.right(STEP):
                pass
            at = p + 1
            if not self.where.match(w.data, p - w.lo, len(w.data) if close < 0 else close):
                continue
            step = STEP
            while (start := w.data.rfind(self.open, 0, p - w.lo)) < 0 and w.left(step):
                step *= 2
            if start >= 0:
                start += w.lo
                yield start, self._end(w, start)

    def _end(self, w: Window, start: int) -> int:
        depth, at = 0, start
        while True:
            for t in self.tags.finditer(w.data, at - w.lo):
                if t.end() == len(w.data) and w.hi < w.size:
                    break  # what follows decides whether the tag ends here
                depth += -1 if t.group().startswith(b"</") else 1
                at = t.end() + w.lo
                if not depth:
                    return at
            at = max(at, w.hi - len(self.open) - 3)
            if not w.right(max(STEP, w.hi - start)):
                return w.size


class Range(InputPartition):
    """A range of bytes of a file, and the ranges that its task reads after it."""

    def __init__(self, path: str, size: int, a: int, b: int):
        self.path, self.size, self.a, self.b = path, size, a, b
        self.then: list[Range] = []


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.paths: set[str] | None = None
        self.least, self.most = 0, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Paths, the least byte_start and the greatest byte_end choose files and ranges; Spark checks the rows again."""
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) else None
            if name == "path" and isinstance(f, EqualTo | In):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.paths = values if self.paths is None else self.paths & values
            elif name == "byte_start" and isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                self.least = max(self.least, f.value)
            elif name == "byte_end" and isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                self.most = f.value if self.most is None else min(self.most, f.value)
            yield f

    def partitions(self) -> list[Range]:
        split, out = int(self.options.get("splitbytes", 1 << 26)), []
        for path, size in files_below(self.options["path"], self.options.get("suffix", "")):
            if self.paths is None or path in self.paths:
                # a mark lies between its element's start and end
                out += [Range(path, size, a, min(a + split, size)) for a in range(0, size, split) if a + split > self.least and (self.most is None or a < self.most)]
        n = max(1, min(-(-len(out) // MANY_RANGES), TASK_BYTES // split))
        for i in range(0, len(out), n):
            out[i].then = out[i + 1 : i + n]
        return out[::n] or [Range("", 0, 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        o = self.options
        elements = Elements(o.get("tag", "cb:div"), o.get("mark", "cb:mulu"), o.get("where", r'\blevel="2"'))
        rows, held, stream, opened = [], 0, None, ""
        try:
            for r in (part, *part.then):
                if r.path != opened:
                    if stream:
                        stream.close()
                    system, at = file_system(r.path)
                    stream, opened = system.open_input_file(at), r.path
                w, counted = Window(stream, r.size, r.a, r.b), 0
                for start, end in elements.of_range(w, r.a, r.b):
                    rows.append((r.path, start, end, bytes(w.data[start - w.lo : end - w.lo]), w.read - counted))
                    counted, held = w.read, held + end - start
                    if held > 1 << 24:
                        yield _batch(rows)
                        rows, held = [], 0
            if rows:
                yield _batch(rows)
        finally:
            if stream:
                stream.close()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["path", "byte_start", "byte_end", "chunk", "bytes_read"])


class ElementSource(DataSource):
    """Format ``elements``: options path, suffix, splitBytes, tag (of the element), mark (the tag in it) and where (a pattern of the mark's attributes)."""

    @classmethod
    def name(cls) -> str:
        return "elements"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def read_elements(spark: SparkSession, path: str, split_bytes: int = 1 << 26, **options: str) -> DataFrame:
    """path, byte_start, byte_end, chunk of every element of the files below ``path``, and bytes_read, the bytes read since the range's last row.

    By default the divisions (cb:div) around headings of level 2 (cb:mulu). Elements without a closing tag end
    with the file. Filters on path, on byte_start from below and on byte_end from above choose what is read. Paths are of
    any store that Arrow reads.
    """
    spark.dataSource.register(ElementSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("elements").option("splitBytes", str(split_bytes)).options(**options).load(path)


def chunks_of(ranges: DataFrame, path: str = "path", start: str = "byte_start", end: str = "byte_end") -> DataFrame:
    """Rows of a catalogue with ``chunk``, the bytes of their range and nothing else of the file; null where any of the three is, or no such file is."""
    names = ranges.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, opened = [], (None, None)
            for p, a, e in zip(*(b.column(names.index(c)).to_pylist() for c in (path, start, end)), strict=True):
                data = None
                if p is not None and a is not None and e is not None:
                    if p != opened[0]:
                        if opened[1]:
                            opened[1].close()
                        system, at = file_system(p)
                        opened = (p, system.open_input_file(at) if system.get_file_info(at).is_file else None)
                    if opened[1]:
                        opened[1].seek(min(a, opened[1].size()))
                        data = opened[1].read(max(e - a, 0))
                found.append(data)
            if opened[1]:
                opened[1].close()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.binary())], [*b.schema.names, "chunk"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema)
    return ranges.sortWithinPartitions(path, start).mapInArrow(run, f"{schema}, chunk binary")
