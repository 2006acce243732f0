"""Split documents into overlapping chunks with their start offsets.

* ``fixed_chunks``: sliding character windows (size, overlap) as one
  ``explode(sequence(...))`` + ``substring`` - native, no Python.
* ``recursive_chunks``: spans between separators of the ladder
  ``["\\n\\n", "\\n", " ", ""]``, packed greedily up to the size with the
  requested overlap and trimmed; offsets are carried, never searched for.
  Runs per document in ``mapInArrow``; Spark spreads documents over tasks.
  A task holds one batch of documents, the units of one window and at most
  OUT_ROWS chunks, however long a document is.

Both take documents in parts as well (``part_col``: rows of bounded size whose
texts, joined in the order of that column, are the document's) and give the
chunks of the whole documents, of which no task then holds one.

Output rows: ``doc_id, chunk_no (0-based), start_index (0-based), source,
chunk`` plus ``chunk_id``, one key for (doc_id, chunk_no).
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checked_broadcast, new_scratch_path

CHUNK_ID_STRIDE = 1_000_000
OUT_ROWS = 4_096  # chunks that the recursive splitter hands on at once
DROPPED = 64 << 10  # characters done with that are let go at once
# The separator ladder of the recursive splitter.
SEPARATORS = ("\n\n", "\n", " ", "")


def fixed_chunks(docs: DataFrame, size: int = 300, overlap: int = 100, text_col: str = "text",
                 id_col: str = "doc_id", source_col: str = "source", part_col: str | None = None) -> DataFrame:
    """A text is cut into stretches of about sqrt(windows) windows first and
    each stretch into its windows: a window is found by counting characters,
    so cutting every one from the whole text would be quadratic in its length.

    With ``part_col`` a document is the rows of one id.  Windows inside a part
    are cut from it, those that reach over a border are put together from
    their pieces; every other text stays where it is."""
    step = size - overlap
    x = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("_t"), *[F.col(c).alias("_p") for c in [part_col] if c])
    if part_col:
        x = _placed(x, size, overlap)
        inner = x.filter("_b > _a").select("doc_id", "source", F.expr(f"substring(_t, CAST(_a * {step} - _lo + 1 AS INT), CAST((_b - _a - 1) * {step} + {size} AS INT))").alias("_t"),
                                           F.expr("CAST(_b - _a AS INT)").alias("_n"), F.expr("CAST(_a AS INT)").alias("_j"))
        cut = _windows(inner, size, step).unionByName(_bordering(x, size, step))
    else:
        n = F.greatest(F.ceil((F.coalesce(F.length("_t"), F.lit(0)) - overlap) / step), F.lit(1)).cast("int")
        cut = _windows(x.withColumns({"_n": n, "_j": F.lit(0)}), size, step)
    return cut.select("doc_id", "chunk_no", (F.col("chunk_no") * step).alias("start_index"), "source", "chunk",
                      chunk_key(F.col("doc_id"), F.col("chunk_no")).alias("chunk_id"))


def _windows(x: DataFrame, size: int, step: int) -> DataFrame:
    """The ``_n`` windows of every text ``_t``, numbered from ``_j`` on."""
    x = x.withColumn("_g", F.greatest(F.ceil(F.sqrt("_n")), F.lit(1)).cast("int"))
    stretches = F.expr(f"transform(sequence(0, (_n - 1) div _g), i -> substring(_t, CAST(i * _g * {step} + 1 AS INT), (_g - 1) * {step} + {size}))")
    x = x.select("doc_id", "source", "_n", "_j", "_g", F.posexplode(stretches).alias("_s", "_part"))
    x = x.select("doc_id", "source", "_part", (F.col("_j") + F.col("_s") * F.col("_g")).alias("_first"),
                 F.explode(F.expr("sequence(0, least(_g, _n - _s * _g) - 1)")).alias("_k"))
    return x.select("doc_id", (F.col("_first") + F.col("_k")).alias("chunk_no"), "source", F.expr(f"substring(_part, _k * {step} + 1, {size})").alias("chunk"))


def _placed(x: DataFrame, size: int, overlap: int) -> DataFrame:
    """Parts with the characters ``_lo`` to ``_hi`` of their document that they
    hold, its number of windows ``_w``, and the windows ``_a`` to ``_b`` (not
    included) that lie inside the part.  Only the parts' lengths are shuffled;
    they are written once, as the parts are read several times."""
    spark, step = x.sparkSession, size - overlap
    path = new_scratch_path(spark, "part-lengths")
    x.select("doc_id", "_p", F.coalesce(F.length("_t"), F.lit(0)).cast("long").alias("_c")).write.parquet(path)
    lengths = spark.read.parquet(path)
    before = Window.partitionBy("doc_id").orderBy("_p")
    at = lengths.select("doc_id", "_p", F.sum("_c").over(before).alias("_hi"), "_c", F.sum("_c").over(Window.partitionBy("doc_id")).alias("_all"))
    at = at.select("doc_id", "_p", (F.col("_hi") - F.col("_c")).alias("_lo"), "_hi", F.col("_hi").eqNullSafe(F.col("_all")).alias("_last"),
                   F.expr(f"greatest(CAST(ceil((_all - {overlap}) / {step}) AS LONG), 1L)").alias("_w"))
    at = at.withColumn("_a", F.expr(f"CAST(ceil(_lo / {step}) AS LONG)"))
    at = at.withColumn("_b", F.expr(f"greatest(_a, CASE WHEN _last THEN _w ELSE least(_w, CAST(floor((_hi - {size}) / {step}) AS LONG) + 1) END)")).drop("_last")
    return x.join(checked_broadcast(at), ["doc_id", "_p"])


def _bordering(x: DataFrame, size: int, step: int) -> DataFrame:
    """The windows that no part holds whole: each part gives its piece of those
    at its two ends."""
    def numbers(lo: str, hi: str) -> str:
        return f"filter(sequence({lo}, greatest({lo}, {hi})), j -> j < {hi})"
    begun = numbers(f"greatest(0L, CAST(floor((_lo - {size}) / {step}) AS LONG) + 1)", "least(_a, _w)")
    ending = numbers("_b", f"least(_w, CAST(ceil(_hi / {step}) AS LONG))")
    x = x.select("doc_id", "source", "_t", "_lo", "_hi", F.explode(F.expr(f"concat({begun}, {ending})")).alias("_j"))
    piece = f"substring(_t, CAST(greatest(_j * {step}, _lo) - _lo + 1 AS INT), CAST(least(_j * {step} + {size}, _hi) - greatest(_j * {step}, _lo) AS INT))"
    pieces = x.select("doc_id", F.expr("CAST(_j AS INT)").alias("chunk_no"), "source", F.struct("_lo", F.expr(piece).alias("t")).alias("_piece"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("_piece")), lambda p: p["t"]), "")
    return pieces.groupBy("doc_id", "chunk_no").agg(F.first("source").alias("source"), whole.alias("chunk"))


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """Documents and chunks per source (every document has chunk 0)."""
    return chunks.groupBy("source").agg(
        F.count(F.when(F.col("chunk_no") == 0, F.lit(1))).alias("n_docs"),
        F.count(F.lit(1)).alias("n_chunks"))


def chunk_key(doc_id, chunk_no):
    """One 64-bit key for (doc_id, chunk_no): readable for small ids, a hash
    where the product would not fit (file documents have hashed ids)."""
    small = (F.abs(doc_id) < F.lit(1 << 42)) & (chunk_no < CHUNK_ID_STRIDE)
    return F.when(small, F.when(small, doc_id).otherwise(0) * CHUNK_ID_STRIDE + chunk_no).otherwise(F.xxhash64(doc_id, chunk_no))


# ---- recursive splitter: spans over one document -------------------------

def units(text: str, lo: int, hi: int, size: int, separators=SEPARATORS, length=len) -> Iterator[tuple[int, int] | None]:
    """Units of text[lo:hi], one by one, with None where a run of neighbouring
    units ends.  A unit ends where the coarsest separator that occurs begins;
    one that is not below the size is split by the finer separators into runs
    of its own."""
    at = next(i for i, s in enumerate(separators) if text.find(s, lo, hi) >= 0)
    mark, finer = separators[at], separators[at + 1:]
    if not mark:
        yield from ((p, p + 1) for p in range(lo, hi))
        yield None
        return

    def cuts() -> Iterator[int]:
        yield from (m.start() for m in re.compile(re.escape(mark)).finditer(text, lo, hi) if m.start() > lo)
        yield hi

    a = lo
    for b in cuts():
        if length(text[a:b]) < size:
            yield a, b
        else:
            yield None
            yield from units(text, a, b, size, finer, length)
        a = b
    yield None


class Held:
    """A text that arrives in parts, by the offsets of the whole; what lies
    before the last ``drop`` is gone."""

    def __init__(self, parts: Iterable[str]):
        self.parts, self.text, self.base, self.ended = iter(parts), "", 0, False

    def end(self, least: int) -> int:
        """Where the held text ends: at ``least`` or behind it, or at the whole's end."""
        while self.base + len(self.text) < least and not self.ended:
            self._more()
        return self.base + len(self.text)

    def _more(self) -> None:
        part = next(self.parts, None)
        self.text, self.ended = self.text + (part or ""), part is None

    def __getitem__(self, at: slice) -> str:
        self.end(at.stop)
        return self.text[at.start - self.base:at.stop - self.base]

    def find(self, mark: str, lo: int, hi: int | None = None) -> int:
        """As of a string; without ``hi`` parts are read until the mark occurs."""
        if hi is not None:
            self.end(hi)
        while (found := self.text.find(mark, lo - self.base, None if hi is None else hi - self.base)) < 0 and hi is None and not self.ended:
            lo = max(lo, self.base + len(self.text) - len(mark) + 1)
            self._more()
        return found + self.base if found >= 0 else -1

    def drop(self, before: int) -> None:
        if before - self.base > DROPPED:
            self.text, self.base = self.text[before - self.base:], before


def held_units(text: Held, size: int, length=len) -> Iterator[tuple[int, int | str] | None]:
    """``units`` of a text that arrives in parts, but a line that is not below
    the size is one run, its offset and its text.  A paragraph that is not
    below it is read line by line, so no more than a line and a window is held.
    ``length`` must not fall when a text grows.  A text without a blank line is
    one paragraph here; where it is below the size, that gives the same window
    as its lines would."""
    mark, line = SEPARATORS[:2]
    a = 0
    while text.end(a + 1) > a:
        first = a + len(mark) if text[a:a + len(mark)] == mark else a
        reach = max(size, 1)
        while (b := text.find(mark, first, a + reach + len(mark))) < 0:
            if text.end(a + reach + len(mark) + 1) <= a + reach + len(mark):
                b = text.end(a)
                break
            if length(text[a:a + reach]) >= size:
                break
            reach *= 2
        if b >= 0 and length(text[a:b]) < size:
            yield a, b
            a = b
            continue
        yield None
        while True:
            b = text.find(line, a + 1)
            b = text.end(a) if b < 0 else b
            row = text[a:b]
            if length(row) < size:
                yield a, b
            else:
                yield None
                yield a, row
            a = b
            if text.end(a + 1) == a or (a >= first and text[a:a + len(mark)] == mark):
                break
        yield None
    yield None


def _windows_of(text: str | Held, parts: Iterable[tuple | None], size: int, overlap: int, length) -> Iterator[tuple[int, int]]:
    """Greedy windows over each run: as many units as fit; the next window goes
    back over at most ``overlap`` as far as its first new unit still fits.
    Only the units of one window are held."""
    window: deque[tuple[int, int]] = deque()
    held = isinstance(text, Held)
    for unit in parts:
        if unit is None:
            if window:
                yield window[0][0], window[-1][1]
            window.clear()
            continue
        a, b = unit
        if held:
            text.drop(window[0][0] if window else a)
            if isinstance(b, str):  # a long line: runs of its own
                yield from ((a + lo, a + hi) for lo, hi in _windows_of(b, units(b, 0, len(b), size, SEPARATORS[2:], length), size, overlap, length))
                continue
        if window and length(text[window[0][0]:b]) > size:
            yield window[0][0], a
            while window and (length(text[window[0][0]:a]) > overlap or length(text[window[0][0]:b]) > size):
                window.popleft()
        window.append(unit)


def spans(text: str | Held, size: int, overlap: int, length=len) -> Iterator[tuple[int, int]]:
    """The windows of a text, by its offsets."""
    parts = held_units(text, size, length) if isinstance(text, Held) else units(text, 0, len(text), size, length=length) if text else ()
    return _windows_of(text, parts, size, overlap, length)


def chunk_spans(text: str | Held, size: int, overlap: int, length=len) -> Iterator[tuple[int, str]]:
    """Trimmed chunks with their 0-based offsets, which are the spans' own."""
    for a, b in spans(text, size, overlap, length):
        part = text[a:b]
        chunk = part.strip()
        if chunk:
            yield a + len(part) - len(part.lstrip()), chunk


def chunk_with_offsets(text: str, size: int, overlap: int, length=len) -> list[tuple[int, str]]:
    return list(chunk_spans(text, size, overlap, length))


def token_length(text: str) -> int:
    """Length in white-space separated tokens (a ``length`` for the splitter)."""
    return len(text.split())


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "chunk_no": pa.int32(), "start_index": pa.int32(), "source": pa.string(), "chunk": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds.values())], names=list(kinds))


def _documents(batches) -> Iterator[tuple]:
    for batch in batches:
        ids, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, (did, src) in enumerate(zip(ids, sources)):
            yield did, src, batch.column(2)[i].as_py() or ""


def _joined_parts(batches) -> Iterator[tuple]:
    """Documents whose parts follow each other in a task.  A text is taken out
    of its batch alone, and no batch is held while the next one is read."""
    def rows():
        for batch in batches:
            texts, keys = batch.column(2), list(zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))))
            del batch
            for i, key in enumerate(keys):
                yield *key, texts[i].as_py() or ""
            del texts

    for did, parts in groupby(rows(), key=lambda r: r[0]):
        first = next(parts)

        def texts():
            last = -1
            for _, _, part, text in chain([first], parts):
                if part <= last or (last < 0 and part):
                    raise ValueError(f"the parts of document {did} are not in one task, in their order")
                last = part
                yield text
        yield did, first[1], Held(texts())


def _cut_batches(size: int, overlap: int, length, documents=_documents):
    def run(batches):
        rows = []
        for did, src, text in documents(batches):
            for no, (start, chunk) in enumerate(chunk_spans(text, size, overlap, length)):
                rows.append((did, no, start, src, chunk))
                if len(rows) >= OUT_ROWS:
                    yield _chunk_batch(rows)
                    rows = []
        yield _chunk_batch(rows)
    return run


def recursive_chunks(docs: DataFrame, size: int = 300, overlap: int = 100, text_col: str = "text",
                     id_col: str = "doc_id", source_col: str = "source", length=len, part_col: str | None = None) -> DataFrame:
    """``length`` measures a text against ``size`` and ``overlap`` (default:
    characters; ``token_length``: tokens).  With ``part_col`` the parts of a
    document, numbered from 0, follow each other in one task, as
    ``read_text_documents`` gives them; otherwise this raises.  A task then
    holds a batch of parts and the text of one line and window."""
    schema = "doc_id long, chunk_no int, start_index int, source string, chunk string"
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"), *[F.col(c).alias("part") for c in [part_col] if c])
    cut = _cut_batches(size, overlap, length, _joined_parts if part_col else _documents)
    return src.mapInArrow(cut, schema).withColumn("chunk_id", chunk_key(F.col("doc_id"), F.col("chunk_no")))
