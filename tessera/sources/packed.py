"""Folders of many small and few huge files, read by planned partitions.

A Python data source lists the folder, packs small files into tasks of
``task_bytes`` and cuts large text files into byte ranges of ``row_bytes``.
Every range is one row.  A range starts and ends at a safe point: behind the
first blank line after its nominal offset, else behind the first line end, else
at the next character.  A safe point depends on the file and the offset only,
so the tasks on both sides of it agree without meeting, and a task that runs
again gives the same rows.  The rows of a file, joined by ``start``, are the
file; no row is longer than ``row_bytes`` and one search window.

Files are opened through Arrow's file systems, so a folder may be a local path
or a URI.  As with Spark's own readers, names that begin with ``_`` or ``.`` are
left out, and the files have to stay as they are while a query runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch
from functools import cache
from posixpath import basename, relpath

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import base64_plain

FORMAT = "packed_files"
ROW_BYTES, TASK_BYTES = 8 << 20, 64 << 20
OPEN_BYTES = 256 << 10  # what opening a file costs, in bytes of reading
WINDOW = 64 << 10  # bytes searched for a safe point
BATCH_BYTES = 4 << 20  # content per Arrow batch
MAX_CELL = (1 << 31) - (64 << 20)  # a binary file has to fit one cell
BLANK_LINE = re.compile(rb"\n\r?\n")
SCHEMAS = {"text": "path string, part long, start long, length long, text string", "binary": "path string, length long, content binary"}


@dataclass(frozen=True)
class Range:
    """Bytes lo to hi of a file (nominal offsets) as row ``part``."""
    path: str
    size: int
    part: int
    lo: int
    hi: int


@dataclass
class Task(InputPartition):
    ranges: tuple[Range, ...]


@cache
def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def listed(folder: str, glob: str, recursive: bool) -> list[tuple[str, int]]:
    """(path, bytes) of the files whose name matches, in the order of paths."""
    system, root = _opened(folder)
    found = []
    for f in system.get_file_info(fs.FileSelector(root, recursive=recursive)):
        inner = relpath(f.path, root).split("/")
        if f.type == fs.FileType.File and not any(p[0] in "_." for p in inner) and fnmatch(basename(f.path), glob):
            found.append((f.path, f.size))
    return sorted(found)


def ranges(files: list[tuple[str, int]], row_bytes: int | None) -> Iterator[Range]:
    """One range per file, or one per ``row_bytes`` of it."""
    for path, size in files:
        step = row_bytes or max(size, 1)
        for part, lo in enumerate(range(0, max(size, 1), step)):
            yield Range(path, size, part, lo, min(lo + step, size))


def packed(units: Iterator[Range], task_bytes: int, together: bool = False) -> list[Task]:
    """Consecutive ranges up to ``task_bytes`` (a longer one stands alone);
    with ``together`` no file is dealt over tasks."""
    tasks, held, cost = [], [], 0
    for u in units:
        own = u.hi - u.lo + OPEN_BYTES
        if held and cost + own > task_bytes and not (together and u.path == held[-1].path):
            tasks.append(Task(tuple(held)))
            held, cost = [], 0
        held.append(u)
        cost += own
    return tasks + ([Task(tuple(held))] if held else [])


def safe_point(read, offset: int, size: int, window: int) -> int:
    """The first safe point at or after ``offset``; ``read(at, n)`` gives bytes."""
    if offset <= 0 or offset >= size:
        return max(0, min(offset, size))
    seen = read(offset, min(window, size - offset))
    if found := BLANK_LINE.search(seen):
        return offset + found.end()
    if (line := seen.find(b"\n")) >= 0:
        return offset + line + 1
    for k, b in enumerate(seen[:4]):
        if b & 0xC0 != 0x80:
            return offset + k
    return size if len(seen) < 4 else offset  # the last character, or no UTF-8 text


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.glob = options["path"], options.get("glob", "*")
        self.kind, self.recursive = options.get("kind", "text"), options.get("recursive", "false").lower() == "true"
        self.row_bytes, self.task_bytes = int(options.get("row_bytes", ROW_BYTES)), int(options.get("task_bytes", TASK_BYTES))
        self.together = options.get("together", "false").lower() == "true"
        if self.row_bytes < 4 or self.task_bytes < 1:
            raise ValueError("row_bytes has to be at least 4, task_bytes at least 1")
        self.window = min(WINDOW, self.row_bytes)  # below the distance of two offsets: safe points keep their order

    def partitions(self):
        files = listed(self.folder, self.glob, self.recursive)
        if self.kind == "binary" and (large := [p for p, n in files if n > MAX_CELL]):
            raise ValueError(f"files of more than {MAX_CELL} bytes do not fit one row: {large[:3]}")
        return packed(ranges(files, self.row_bytes if self.kind == "text" else None), self.task_bytes, self.together) or [Task(())]

    def read(self, partition):
        rows, size = [], 0
        for row in self._rows(partition.ranges):
            rows.append(row)
            size += row[-2 if self.kind == "text" else 1]
            if size >= BATCH_BYTES:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _rows(self, units: tuple[Range, ...]):
        system, _ = _opened(self.folder)
        for u in units:
            with system.open_input_file(u.path) as f:
                if self.kind == "binary":
                    yield u.path, u.size, f.read()
                    continue

                def read(at, n):
                    f.seek(at)
                    return f.read(n)
                lo, hi = (safe_point(read, x, u.size, self.window) for x in (u.lo, u.hi))
                if lo < hi or u.size == 0:
                    yield u.path, u.part, lo, hi - lo, read(lo, hi - lo).decode("utf-8", "replace")

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        names = [c.split()[0] for c in SCHEMAS[self.kind].split(", ")]
        types = {"path": pa.string(), "text": pa.string(), "content": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array(c, types.get(n, pa.int64())) for n, c in zip(names, zip(*rows), strict=True)], names)


class PackedFiles(DataSource):
    """Options: path (one folder), glob, kind (text or binary), recursive,
    row_bytes (text), task_bytes, together."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        kind = self.options.get("kind", "text")
        if kind not in SCHEMAS:
            raise ValueError(f"kind must be one of {sorted(SCHEMAS)}")
        return SCHEMAS[kind]

    def reader(self, schema):
        return _Reader(self.options)


def _read(spark: SparkSession, folder: str, **options) -> DataFrame:
    spark.dataSource.register(PackedFiles)
    return spark.read.format(FORMAT).options(**options).load(folder)


def read_text_parts(spark: SparkSession, folder: str, glob: str = "*", *, row_bytes: int = ROW_BYTES, task_bytes: int = TASK_BYTES, recursive: bool = False,
                    together: bool = False) -> DataFrame:
    """Text files as rows of bounded size: ``doc_id`` (a hash of path and
    part), ``source`` (path), ``part``, ``start`` and ``length`` (bytes),
    ``text``.  Part numbers rise with ``start``; a part that holds no safe
    point of its own is left out.  An empty file is one empty row, bytes that
    are no UTF-8 become replacement characters, a folder without matching files
    gives no rows.  With ``together`` the parts of a file follow each other in
    one task."""
    d = _read(spark, folder, glob=glob, kind="text", recursive=recursive, row_bytes=row_bytes, task_bytes=task_bytes, together=together)
    return d.select(F.xxhash64("path", "part").alias("doc_id"), F.col("path").alias("source"), "part", "start", "length", "text")


def read_packed_binary(spark: SparkSession, folder: str, glob: str = "*", *, task_bytes: int = TASK_BYTES, recursive: bool = False) -> DataFrame:
    """``read_binary_files`` with small files packed into tasks: path, length,
    content, b64.  A file is one row, so one beyond 2 GB is an error."""
    d = _read(spark, folder, glob=glob, kind="binary", recursive=recursive, task_bytes=task_bytes)
    return d.select("path", "length", "content", base64_plain(F.col("content")).alias("b64"))
