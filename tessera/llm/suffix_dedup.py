"""Repeated substrings by distributed doubling over sampled positions.

Every byte covered by a LENGTH-byte string that also starts elsewhere is
removed.  Plain prefix doubling ranks each byte position at offsets 1, 2, 4,
...; here names (64-bit fingerprints of substrings, taken from prefix sums)
stand for ranks, and a position takes part in the next length only while its
name at the shorter one is shared:

* a window's sample position is the smallest 64-byte string inside it, so
  equal windows have the same one at the same place; windows that share it
  form a family, and a family whose 64-byte name is unique is done;
* families are cut into bands of 64, then 8, then 1 neighbouring windows at
  fixed places around the sample position.  The bytes common to a band
  (337, 393, 400) give its core name: unique cores are done.  The bytes of the
  whole band (463, 407, 400) give its full name: where that is shared all its
  windows repeat.  The rest is cut finer, together with the finished bands of
  the same core, until a band is one window of LENGTH bytes.

Names are sums of mixed 8-byte strings, so that no arithmetic pattern of single
bytes (a Thue-Morse string) cancels out.  The core's and the full name come
from two differently mixed sums: what is removed agrees in both, 128 bits.

Per level one shuffle sorts the distinct (core, full) names of each block of
documents, so copies are counted before they travel and a name that a third
of all rows hold is one row per block.

Defined results: texts are UTF-8 bytes, a null text is empty; strings never
cross documents; texts below LENGTH bytes lose nothing; repeated rows and ids
are separate documents (their texts repeat); other columns are ignored; an
empty table gives no rows.  A document is handled whole, with some 30 bytes of
memory for each of its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.chunks import blocks
from tessera.llm.common import materialize, pick, released

LENGTH, SAMPLE = 400, 64
BANDS = (64, 8, 1)
BLOCK_BYTES = 2 << 20
SEGMENT = 1 << 18  # window starts whose families are found together
BROADCAST_BYTES = 32 << 20  # marks of all blocks sent to every executor at most
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
GRAM = 8  # bytes mixed together; no name is asked of fewer
CORE, FULL = U(0x2545F4914F6CDD1D), U(0xD6E8FEB86659FD93)  # salts of the two kinds of names


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def up(b: int) -> np.ndarray:
        return np.multiply.accumulate(np.concatenate([np.ones(1, U), np.full(size, U(b))]))
    return up(int(BASE)), up(pow(int(BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(32))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(29))


class Names:
    """Fingerprints of the substrings, of GRAM bytes or more, of one buffer."""

    def __init__(self, data: np.ndarray, salt: np.uint64 = CORE):
        size, n = 1 << max(21, int(len(data)).bit_length()), max(len(data) - GRAM + 1, 0)
        power, self.inverse = _powers(size)
        self.sums = np.zeros(n + 1, U)
        grams = np.ndarray((n,), "<u8", buffer=data.tobytes(), strides=(1,)) if n else np.zeros(0, U)
        np.cumsum(_mix(grams ^ salt) * power[:n], out=self.sums[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return _mix((self.sums[hi - GRAM + 1] - self.sums[lo]) * self.inverse[lo])


def families(data: np.ndarray, ends: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """(sample position, first window, last window, name of the sample) of
    every family; a window never crosses a document's end."""
    names, w = Names(data), length - k + 1
    parts = []
    starts = np.concatenate([[0], ends[:-1]])
    for s0 in range(0, max(len(data) - length + 1, 0), SEGMENT):
        n = min(SEGMENT, len(data) - length + 1 - s0)  # window starts
        at = np.arange(s0, s0 + n + w - 1)
        key = (names.of(at, at + k) & ~U(0xFFFFFFFF)) | (at - s0).astype(U)
        rows = -(-len(key) // w)
        key = np.concatenate([key, np.full(rows * w - len(key), U(2**64 - 1))]).reshape(rows, w)
        ahead = np.minimum.accumulate(key, axis=1).ravel()
        back = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
        sample = (np.minimum(back[:n], ahead[w - 1:w - 1 + n]) & U(0xFFFFFFFF)).astype(np.int64) + s0
        inside = np.zeros(n + 1, np.int64)
        np.add.at(inside, np.clip(starts - s0, 0, n), 1)
        np.add.at(inside, np.clip(np.maximum(ends - length + 1, starts) - s0, 0, n), -1)
        p = np.flatnonzero(np.cumsum(inside[:n]) > 0)
        if len(p):
            a = sample[p]
            p = p + s0
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)]))
            parts.append((a[new], p[new], p[np.concatenate([new[1:] - 1, [len(p) - 1]])]))
    if not parts:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),)
    a, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
    # a family cut by a segment's end is one family; windows of two documents
    # never share a sample position, as it lies inside both
    new = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    a, lo, hi = a[new], lo[new], hi[np.concatenate([new[1:] - 1, [len(a) - 1]])]
    return a, lo, hi, names.of(a, a + k)


# What a level finds about a band whose core name is shared.
DONE, PARTNER, CUT = 1, 2, 3  # repeats; repeats, but is needed to compare others with; has to be cut finer


def _distinct(core, full, whole, open_):
    """The distinct (core, full) names of a block's bands: an index of one
    band each, the inverse, counts, and whether any such band is open."""
    key = _mix(core + _mix(np.where(whole, full, U(0)) + U(1)))
    _, first, inverse, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return first, inverse, counts, np.bincount(inverse, weights=open_, minlength=len(first)) > 0


def _marks(found: bytes | None, n: int) -> np.ndarray:
    some = np.frombuffer(_unsqueeze(found), np.uint8) if found else np.zeros(0, np.uint8)
    return np.concatenate([some, np.zeros(n - len(some), np.uint8)])


def _advance(data, ends, fam, marks: list[bytes | None], length: int):
    """Replay the levels whose marks are known.  Returns the rows (core, full,
    whole, open, count) of the next level, or the mask of repeated windows
    after the last."""
    a, lo, hi, name = fam
    first, last = a - hi, a - lo  # windows start at a - offset
    low, core, full, whole, open_ = (first // BANDS[0]) * BANDS[0], name, np.zeros(len(a), U), np.zeros(len(a), bool), np.ones(len(a), bool)
    at = np.searchsorted(ends, a, "right")
    doc_start, doc_end = np.concatenate([[0], ends])[at], np.append(ends, 0)[at]
    repeated = np.zeros(len(data) + 1, np.int64)
    names, others = (Names(data), Names(data, FULL)) if marks and len(a) else (None, None)
    for level in range(len(BANDS) + 1):
        one, inverse, counts, opened = _distinct(core, full, whole, open_)
        if len(marks) == level:
            return core[one], full[one], whole[one], opened, counts
        state = _marks(marks[level], len(one))[inverse]
        done = (state == DONE) | (state == PARTNER)
        np.add.at(repeated, (a - last)[done], 1)
        np.add.at(repeated, (a - first)[done] + 1, -1)
        if level == len(BANDS):
            break
        rest = state >= PARTNER
        a, doc_start, doc_end, first, last, low, state = (x[rest] for x in (a, doc_start, doc_end, first, last, low, state))
        # cut: every finer band that meets the offsets first..last
        width = BANDS[level]
        n = (last - low) // width + 1
        row = np.repeat(np.arange(len(a)), n)
        low = low[row] + width * (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
        a, doc_start, doc_end, open_ = a[row], doc_start[row], doc_end[row], (state == CUT)[row]
        first, last = np.maximum(first[row], low), np.minimum(last[row], low + width - 1)
        met = first <= last
        a, doc_start, doc_end, first, last, low, open_ = (x[met] for x in (a, doc_start, doc_end, first, last, low, open_))
        whole = (a - low - width + 1 >= doc_start) & (a - low + length <= doc_end)
        salt = _mix((low + (width << 20)).astype(U))
        core, full = np.zeros(len(a), U), np.zeros(len(a), U)
        if len(a):
            core = names.of(a - low, a - low - width + 1 + length) ^ salt
            full[whole] = others.of((a - low - width + 1)[whole], (a - low + length)[whole])
    return np.cumsum(repeated)[:len(data)] > 0


def _bytes(strings: pa.Array) -> tuple[bytes, np.ndarray]:
    s = pc.fill_null(strings.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(s.buffers()[1], np.int64)[s.offset:s.offset + len(s) + 1]
    return s.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if offsets[-1] > offsets[0] else b"", offsets[1:] - offsets[0]


def _squeeze(raw: bytes) -> bytes:
    return np.array([len(raw)], "<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unsqueeze(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int(np.frombuffer(data[:8], "<i8")[0]), codec="zstd", asbytes=True)


BLOCK = "block long, doc_ids array<long>, ends binary, text binary, families binary"


def _to_blocks(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for b in blocks(batch, 1, BLOCK_BYTES):
                raw, ends = _bytes(b.column(1))
                a, lo, hi, name = families(np.frombuffer(raw, np.uint8), ends, length, k)
                fam = np.concatenate([x.astype("<i8") for x in (a, a - lo, a - hi)] + [name.view("<i8")])
                planes = np.ascontiguousarray(fam.view(np.uint8).reshape(-1, 8).T).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([b.column(0).to_pylist()], pa.list_(pa.int64())),
                                                  pa.array([ends.astype("<i8").tobytes()], pa.binary()), pa.array([_squeeze(raw)], pa.binary()),
                                                  pa.array([_squeeze(planes)], pa.binary())], ["block", "doc_ids", "ends", "text", "families"])
                number += 1
    return run


def _open(row: dict):
    data, ends = np.frombuffer(_unsqueeze(row["text"]), np.uint8), np.frombuffer(row["ends"], "<i8")
    planes = np.frombuffer(_unsqueeze(row["families"]), np.uint8)
    fam = np.ascontiguousarray(planes.reshape(8, len(planes) // 8).T).view("<i8").ravel().reshape(4, -1)
    return data, ends, (fam[0], fam[0] - fam[1], fam[0] - fam[2], fam[3].view(U))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):  # one block at a time
            yield b.slice(i, 1).to_pylist()[0]


NAMES = "core long, full long, whole boolean, open boolean, count int, block long, place int"


def _level(length: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            core, full, whole, opened, counts = _advance(*_open(r), [r[f"marks{i}"] for i in range(level)], length)
            n = len(core)
            yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(full.view(np.int64)), pa.array(whole), pa.array(opened), pa.array(counts.astype(np.int32)),
                                              pa.array(np.full(n, r["block"], np.int64)), pa.array(np.arange(n, dtype=np.int32))],
                                             ["core", "full", "whole", "open", "count", "block", "place"])
    return run


def ranked(names: DataFrame) -> DataFrame:
    """(block, place, state) of the names that are shared: one shuffle sorts
    them by (core, full)."""
    core = Window.partitionBy("core")
    n = names.select("block", "place", "open", "whole", F.sum("count").over(core).alias("n_core"),
                     F.sum("count").over(Window.partitionBy("core", "whole", "full")).alias("n_full"), "core").filter("n_core > 1")
    n = n.withColumn("asks", F.expr("open AND (NOT whole OR n_full = 1)"))
    n = n.withColumn("asked", F.max("asks").over(core))
    return n.select("block", "place", F.expr(f"CASE WHEN asks THEN {CUT} WHEN asked THEN {PARTNER} ELSE {DONE} END").alias("state"))


def _mark(group: pa.Table) -> pa.Table:
    """The states of one block's names, by place."""
    place = group.column("place").to_numpy()
    states = np.zeros(int(place.max()) + 1, np.uint8)
    states[place] = group.column("state").to_numpy()
    return pa.table({"block": group.column("block")[:1], "marks": pa.array([_squeeze(states.tobytes())], pa.binary())})


def covered(repeated: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Bytes covered by a repeated window (windows never cross documents)."""
    step = np.zeros(len(repeated) + length + 1, np.int32)
    at = np.flatnonzero(repeated)
    np.add.at(step, at, 1)
    np.add.at(step, at + length, -1)
    return np.cumsum(step)[:len(repeated)] > 0


def _cut(length: int, emit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            data, ends, fam = _open(r)
            gone = covered(_advance(data, ends, fam, [r[f"marks{i}"] for i in range(len(BANDS) + 1)], length), ends, length)
            yield emit(r["doc_ids"], data, ends, gone)
    return run


def _emit_digests(doc_ids, data, ends, gone) -> pa.RecordBatch:
    raw, removed, spans, digests, at = data.tobytes(), [], [], [], 0
    sizes = np.diff(ends, prepend=0)
    for e in ends.tolist():
        g = gone[at:e]
        n = int(np.count_nonzero(g))
        removed.append(n)
        spans.append(int(np.count_nonzero(g[1:] & ~g[:-1])) + int(g[0]) if n else 0)
        digests.append(hashlib.sha256(data[at:e][~g].tobytes() if n else raw[at:e]).hexdigest())
        at = e
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(sizes), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests)],
                                      ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _emit_spans(doc_ids, data, ends, gone) -> pa.RecordBatch:
    kept, spans, at = [], [], 0
    for e in ends.tolist():
        g = np.concatenate([[0], gone[at:e].astype(np.int8), [0]])
        turn = np.flatnonzero(np.diff(g)).reshape(-1, 2)
        spans.append([{"start": int(a), "end": int(b)} for a, b in turn])
        kept.append(data[at:e][~gone[at:e]].tobytes())
        at = e
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "spans", "kept"])


def _with_marks(table: DataFrame, marks: list[DataFrame]) -> DataFrame:
    for i, m in enumerate(marks):
        size = m.agg(F.sum(F.length("marks") + 24)).first()[0] or 0
        m = m.withColumnRenamed("marks", f"marks{i}")
        table = table.join(F.broadcast(m) if size <= BROADCAST_BYTES else m, "block", "left")
    return table


def repeats(docs: DataFrame, emit, schema: str, length: int = LENGTH, k: int = SAMPLE) -> DataFrame:
    """``emit(doc_ids, bytes, ends, removed mask)`` turns a block into rows."""
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    table = materialize(d.mapInArrow(released(_to_blocks(length, k)), BLOCK), "text-blocks")
    marks: list[DataFrame] = []
    for level in range(len(BANDS) + 1):
        names = _with_marks(table, marks).mapInArrow(released(_level(length, level)), NAMES)
        found = ranked(names).groupBy("block").applyInArrow(_mark, "block long, marks binary")
        marks.append(materialize(found, f"shared-names-{level}"))
    return _with_marks(table, marks).mapInArrow(released(_cut(length, emit)), schema)


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return repeats(docs, _emit_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", length)


def cut_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, spans (removed bytes), kept (remaining bytes)."""
    return repeats(docs, _emit_spans, "doc_id long, spans array<struct<start:long,end:long>>, kept binary", length)
