"""Repeated lines across documents, by two Bloom filters.

Pass 1 writes the digest of every eligible line (distinct per document),
sorted within its task, and builds two filters over all of them: bits seen
once and bits seen twice.  Tasks send the set bits of their batches by
segment; a segment's ``twice`` bits are those that two batches, or two lines
of a batch, have in common, so a digest that occurs twice always has all its
bits there.  Pass 2 tests every digest against the second filter.  Only the
suspects shuffle: an aggregate per digest confirms the repeats exactly and
names the smallest document, and the digests to drop go back by document.

A filter has BITS bits a line.  Digests are tested a slice at a time, each
slice a range of digests whose filter has at most SLICE_BITS bits, so what is
broadcast is bounded at any size; a slice reads only its range, as the written
digests are sorted.  Repeats that hold more than a thousandth of the suspects
(fewer than a thousand of them) are joined by broadcast, the rest by shuffle,
so a very common line never meets in one task.

Defined results: a null or empty text is one empty line; very long texts are
cut into lines like any other; a row without doc_id keeps all its lines and
its lines do not count; rows that share a doc_id are one document and lose the
same keys; repeated rows stay repeated; an empty table gives no rows; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.chunks import blocks
from tessera.llm.common import lower_ascii, materialize, pick, released

MIN_CHARS = 10
STRIP = " \t\n\x0b\x0c\r"
BITS = 16  # filter bits a line; two of them are set by each digest
SEGMENT_BITS = (1 << 16, 1 << 26)  # least and largest segment merged by one task
SLICE_BITS = 1 << 29  # filter bits broadcast at once (64 MB)
HEAVY_SHARE = 1000  # a repeat above this fraction of the suspects is broadcast
BLOCK_BYTES = 8 << 20  # text cut together
DIGEST_BYTES = 16


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_digests(text: Column) -> Column:
    """Distinct 16-byte SHA-256 prefixes of the keys of at least MIN_CHARS."""
    keys = F.transform(_lines(lower_ascii(text)), lambda x: F.btrim(x, F.lit(STRIP)))
    long = F.filter(keys, lambda k: F.length(k) >= MIN_CHARS)
    return F.transform(F.array_distinct(long), lambda k: F.unhex(F.substring(F.sha2(k, 256), 1, 2 * DIGEST_BYTES)))


def _digest(line: str) -> bytes:
    """The same digest of one line (bytes.lower changes A-Z only)."""
    return hashlib.sha256(line.strip(STRIP).encode().lower()).digest()[:DIGEST_BYTES]


class Layout:
    """How digests fall into a filter: the leading bits name the segment, two
    numbers of the second half the bits inside."""

    def __init__(self, lines: int):
        bits = max(SEGMENT_BITS[0], 1 << max(lines * BITS - 1, 0).bit_length())
        self.segment_bits = min(SEGMENT_BITS[1], max(SEGMENT_BITS[0], bits // 64))
        self.segments = bits // self.segment_bits
        self.slices = max(1, min(self.segments, bits // SLICE_BITS))

    def place(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        words = np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].view(">u8").astype(np.uint64).reshape(-1, 2)
        depth, inside = self.segments.bit_length() - 1, np.uint64(self.segment_bits - 1)
        segment = words[:, 0] >> np.uint64(64 - depth) if depth else np.zeros(len(words), np.uint64)
        return segment.astype(np.int64), words[:, 1] & inside, (words[:, 1] >> np.uint64(32)) & inside

    def slice_range(self, k: int) -> tuple[bytes, bytes | None]:
        """First digest of slice ``k`` and of the next (None after the last)."""
        edge = [(i * (1 << 8 * DIGEST_BYTES)) // self.slices for i in (k, k + 1)]
        return edge[0].to_bytes(DIGEST_BYTES, "big"), None if k + 1 == self.slices else edge[1].to_bytes(DIGEST_BYTES, "big")


def _set_bits(layout: Layout):
    """(segment, bits set, bits set twice) of each batch of digests."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            segment, *bits = layout.place(batch.column(0))
            order = np.argsort(segment, kind="stable")
            names, first = np.unique(segment[order], return_index=True)
            once, twice = [], []
            for part in np.split(order, first[1:]):
                bit, times = np.unique(np.concatenate([b[part] for b in bits]).astype("<u4"), return_counts=True)
                once.append(bit.tobytes())
                twice.append(bit[times > 1].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], names=["segment", "once", "twice"])
    return run


def _merge(segment_bits: int):
    """The second filter of one segment: bits that two batches share."""
    def run(group: pa.Table) -> pa.Table:
        once, twice = np.zeros(segment_bits, bool), np.zeros(segment_bits, bool)
        for a, b in zip(group.column("once"), group.column("twice")):
            seen = np.frombuffer(a.as_buffer(), "<u4")
            twice[seen[once[seen]]] = True
            once[seen] = True
            twice[np.frombuffer(b.as_buffer(), "<u4")] = True
        return pa.table({"segment": group.column("segment").slice(0, 1), "bits": pa.array([zlib.compress(np.packbits(twice).tobytes(), 1)], pa.binary())})
    return run


def twice_seen(digests: DataFrame, layout: Layout) -> DataFrame:
    """The filter of digests seen at least twice: segment, bits (compressed)."""
    seen = digests.select("digest").mapInArrow(released(_set_bits(layout)), "segment long, once binary, twice binary")
    return seen.groupBy("segment").applyInArrow(_merge(layout.segment_bits), "segment long, bits binary")


def _suspects(layout: Layout, shared):
    def run(batches):
        filters = {s: np.frombuffer(zlib.decompress(b), np.uint8) for s, b in shared.value.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            segment, x, y = layout.place(batch.column(1))
            keep = np.zeros(batch.num_rows, bool)
            order = np.argsort(segment, kind="stable")
            names, first = np.unique(segment[order], return_index=True)
            for name, part in zip(names.tolist(), np.split(order, first[1:])):
                if (bits := filters.get(name)) is not None:
                    hit = [(bits[(b[part] >> np.uint64(3)).astype(np.int64)] >> (7 - (b[part] & np.uint64(7)).astype(np.uint8))) & 1 for b in (x, y)]
                    keep[part] = (hit[0] & hit[1]).astype(bool)
            yield batch.filter(pa.array(keep))
    return run


def suspects(digests: DataFrame, layout: Layout) -> DataFrame:
    """Rows (doc_id, digest) whose digest may occur twice: every true repeat,
    and some two in a hundred of the others."""
    spark, table = digests.sparkSession, materialize(twice_seen(digests, layout), "twice-seen-lines")
    found, per_slice = None, layout.segments // layout.slices
    for k in range(layout.slices):
        low, high = layout.slice_range(k)
        own = table.filter((F.col("segment") >= k * per_slice) & (F.col("segment") < (k + 1) * per_slice))
        shared = spark.sparkContext.broadcast({r.segment: bytes(r.bits) for r in own.collect()})  # at most SLICE_BITS bits
        rows = digests if layout.slices == 1 else digests.filter(F.col("digest") >= F.lit(bytearray(low)))
        rows = rows if high is None else rows.filter(F.col("digest") < F.lit(bytearray(high)))
        part = materialize(rows.mapInArrow(released(_suspects(layout, shared)), digests.schema), "suspected-lines")
        found = part if found is None else found.unionByName(part)
    return found


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, gone): the digests of the keys that each document loses.
    ``docs`` holds doc_id and text."""
    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", F.explode(line_digests(F.col("text"))).alias("digest"))
    digests = materialize(rows.sortWithinPartitions("digest"), "line-digests")
    found = suspects(digests, Layout(digests.count()))
    confirmed = materialize(found.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("n"))
                            .filter("keep_id < last_id").drop("last_id"), "repeated-lines")
    floor = found.count() // HEAVY_SHARE + 1
    heavy = F.broadcast(confirmed.filter(F.col("n") >= floor).drop("n"))
    hot = found.join(heavy, "digest")
    rest = found.join(heavy, "digest", "left_anti").join(confirmed.filter(F.col("n") < floor).drop("n"), "digest")
    return hot.unionByName(rest).filter("doc_id > keep_id").groupBy("doc_id").agg(F.collect_set("digest").alias("gone"))


KEPT = "doc_id long, n_lines long, n_dropped long, text string"


def _drop(batches):
    for batch in batches:
        for part in blocks(batch, 1, BLOCK_BYTES):
            out = []
            for doc_id, text, gone in zip(*(part.column(i).to_pylist() for i in range(3))):
                lines = (text or "").split("\n")
                kept = lines
                if gone:
                    gone = set(gone)
                    kept = [x for x in lines if _digest(x) not in gone]
                out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                             names=["doc_id", "n_lines", "n_dropped", "text"])


def dedup_lines(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped and the text left."""
    ids = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    joined = ids.join(repeated_lines(ids), "doc_id", "left")
    return joined.select("doc_id", "text", "gone").mapInArrow(released(_drop), KEPT)


def digests(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     k AS (SELECT doc_id, lines, [trim(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) FOR x IN lines] AS keys FROM d),
     u AS (SELECT DISTINCT doc_id, unnest(keys) AS key FROM k),
     r AS (SELECT key, min(doc_id) AS keep_id FROM u WHERE length(key) >= 10 GROUP BY key HAVING count(*) > 1),
     x AS (SELECT u.doc_id, list(u.key) AS gone FROM u JOIN r ON u.key = r.key WHERE u.doc_id > r.keep_id GROUP BY u.doc_id),
     f AS (SELECT k.doc_id, lines, [lines[i] FOR i IN range(1, len(lines) + 1) IF NOT coalesce(list_contains(gone, keys[i]), false)] AS kept
           FROM k LEFT JOIN x ON k.doc_id = x.doc_id)
SELECT doc_id, len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256 FROM f
"""
