"""SentencePiece encoding and decoding through a distinct-chunk table.

Where no piece of the model crosses a white-space marker, a text falls into
independent chunks (a marker run with the word behind it; a newline with the
word behind it).  Four steps:

1. blocks: each block of documents becomes one row with its distinct chunks,
   dealt into hash buckets, and its texts as positions in that chunk list;
2. the chunk rows are shuffled by bucket, so equal chunks of all blocks meet,
   and each distinct chunk is segmented (and decoded back) once;
3. the ids go back to their block as (position, ids);
4. each block joins the ids to its texts by position.

The shuffles carry distinct chunks per block, never one row per word, and a
chunk that every text holds is one entry per block.

Defined results: a null or empty text has no ids and decodes to the empty
text; repeated rows and null ids are encoded like any other row; a very
long text is a block of its own and handled by one task; extra columns are ignored; an empty table gives no rows.  A model whose pieces do
cross markers is given whole texts as chunks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.chunks import RAW, blocks, chunk_text, cut
from tessera.llm.common import pick

BLOCK_BYTES = 32 << 20  # text per block
GROUP_BYTES = 8 << 20  # chunks of several blocks looked up together
KNOWN_BYTES, CHUNK_COST = 256 << 20, 200  # distinct chunks a task holds; bytes of one beside its text
MARKER = "▁"
# Texts beyond the plain rule: two spaces in a row, one at the start, the
# marker itself, the control characters that mark chunks.
ODD = "[\\x00-\\x02]|  |^ "
CHUNKS = re.compile(" +[^ \n]*|\n[^ \n]*")
BLOCK = "block long, doc_ids array<long>, counts binary, codes binary, words array<binary>"


@cache
def _model(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


@cache
def cuttable(path: str) -> bool:
    """No piece holds a marker behind another character or a newline beside
    one, and the normalizer only adds the first marker and maps spaces."""
    sp = _model(path)
    inner = re.compile(f"[^{MARKER}]{MARKER}|.\n|\n.", re.S)
    probe = "ﬁ  Ａ́ \t\n x "
    known = sp.id_to_piece(sp.piece_to_id(MARKER)) == MARKER
    return known and sp.normalize(probe) == MARKER + probe.replace(" ", MARKER) and not any(
        inner.search(sp.id_to_piece(i)) for i in range(sp.get_piece_size()))


def _planes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes()


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    """Byte strings and arrays (as planes of equal byte rank) in one
    compressed string."""
    parts = [a if isinstance(a, bytes) else _planes(a) for a in arrays]
    head = np.array([len(parts), *map(len, parts)], "<i8").tobytes()
    raw = head + b"".join(parts)
    return np.array([len(raw)], "<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> list[bytes]:
    raw = pa.decompress(data[8:], decompressed_size=int(np.frombuffer(data[:8], "<i8")[0]), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw[:8], "<i8")[0])
    sizes = np.frombuffer(raw[8:8 + 8 * n], "<i8")
    ends = 8 + 8 * n + np.cumsum(sizes)
    return [raw[e - s:e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _array(planes: bytes, dtype: str) -> np.ndarray:
    k = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(k, len(planes) // k).T).view(dtype).ravel()


def _strings(lengths: np.ndarray, blob: bytes) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(blob))


def _raw_chunks(text: str) -> list[str]:
    return [RAW + c for c in CHUNKS.findall(" " + text)]


def _cut_blocks(path: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for b in blocks(batch, 1, BLOCK_BYTES):
                texts = pc.replace_substring(b.column(1).cast(pa.large_string()).fill_null(""), MARKER, " ")
                w = cut(texts, ODD, False, _raw_chunks) if cuttable(path) else cut(texts, "(?s).", False, lambda t: [RAW + " " + t])
                often = np.argsort(-np.bincount(w.codes, minlength=len(w.distinct)), kind="stable")
                rank = np.empty(len(often), np.uint32)
                rank[often] = np.arange(len(often), dtype=np.uint32)
                distinct = w.distinct.take(pa.array(often))
                which = _bucket(distinct, buckets)
                by = np.argsort(which, kind="stable")
                edges = np.searchsorted(which[by], np.arange(buckets + 1))
                packed = []
                for k in range(buckets):
                    at = by[edges[k]:edges[k + 1]]
                    some = distinct.take(pa.array(at))
                    packed.append(_pack(np.diff(at, prepend=0).astype("<u4"), np.asarray(pc.binary_length(some)).astype("<u4"), _blob(some)) if len(at) else None)
                counts, codes = _pack(w.counts.astype("<u4")), _pack(rank[w.codes])
                ids = b.column(0)
                # a block is known by its place and content: equal blocks stay apart,
                # and a repeated task gives the same block
                name = int.from_bytes(hashlib.blake2b(codes + counts + repr((part, made, ids.to_pylist())).encode() + hashlib.sha256(_blob(distinct)).digest(),
                                                      digest_size=8).digest(), "little", signed=True)
                made += 1
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([counts], pa.binary()),
                                                  pa.array([codes], pa.binary()), pa.array([packed], pa.list_(pa.binary()))],
                                                 ["block", "doc_ids", "counts", "codes", "words"])
    return run


def _blob(strings: pa.Array) -> bytes:
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    return strings.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if len(strings) else b""


def _bucket(strings: pa.Array, buckets: int) -> np.ndarray:
    from zlib import crc32
    raw, ends = memoryview(_blob(strings)), np.cumsum(np.diff(np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1])).tolist()
    return np.array([crc32(raw[a:b]) for a, b in zip([0, *ends], ends)], np.uint32).astype(np.int64) % buckets


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for block, words in zip(b.column(0).to_pylist(), b.column(4), strict=True):
            some = [(k, w.as_py()) for k, w in enumerate(words) if w.is_valid]
            if some:
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(some)), pa.array([k for k, _ in some], pa.int32()),
                                                  pa.array([w for _, w in some], pa.binary())], ["block", "bucket", "words"])


def _segment(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray, dict[int, str]]:
    """(ids, ids per chunk, decoded text of the chunks that do not decode to
    themselves)."""
    sp, sizes, flat, odd = _model(path), [], [], {}
    for at in range(0, len(words), 20_000):
        some = [chunk_text(w) for w in words[at:at + 20_000]]
        # the library adds a marker in front: it stands for the chunk's own
        # first one, or is taken off where the chunk has none
        ids = sp.encode([c[1:] if c[0] == " " else c for c in some], num_threads=1)
        ids = [[sp.piece_to_id(MARKER)] if c == " " else i if c[0] == " " else i[1:] for c, i in zip(some, ids, strict=True)]
        back = sp.decode(ids, num_threads=1)
        for k, (c, d) in enumerate(zip(some, back, strict=True)):
            whole = " " + d if c[0] == " " else d
            if whole != c:
                odd[at + k] = whole
        sizes += map(len, ids)
        flat += [np.array(i, "<u4") for i in ids]
    return np.concatenate(flat) if flat else np.zeros(0, "<u4"), np.array(sizes, np.int64), odd


def _segment_bucket(path: str):
    """All rows of a bucket meet in one partition; a partition's chunks are
    segmented once for all blocks.  Rows pass in groups of GROUP_BYTES and only
    the distinct chunks are held; beyond KNOWN_BYTES of them the table starts
    anew (a chunk that comes again is then segmented again, with equal ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Segments(path)
        for group in _groups((row for b in batches for row in zip(*(b.column(i) for i in range(3)), strict=True))):
            yield from table.ids_of(group)
    return run


def _groups(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """(block, bucket, words) of consecutive rows, about GROUP_BYTES at a time."""
    group, size = [], 0
    for block, bucket, words in rows:
        raw = _unpack(words.as_py())
        group.append((block.as_py(), bucket.as_py(), raw))
        size += len(raw[2])
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


class _Segments:
    """Distinct chunks met so far, with their ids."""

    def __init__(self, path: str):
        self.path = path
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64)
        self.odd: dict[int, str] = {}
        self.bytes = 0

    def codes(self, words: list[str]) -> np.ndarray:
        """Places of distinct chunks in the table, new ones added."""
        new = [w for w in words if w not in self.index]
        if new:
            ids, sizes, odd = _segment(new, self.path)
            first = len(self.sizes)
            self.index.update(zip(new, range(first, first + len(new))))
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
            self.odd.update({first + k: t for k, t in odd.items()})
            self.bytes += sum(map(len, new)) + CHUNK_COST * len(new)
        return np.array([self.index[w] for w in words], np.int64)

    def ids_of(self, group: list[tuple]) -> Iterator[pa.RecordBatch]:
        from tessera.llm.chunks import gather
        if self.bytes > KNOWN_BYTES:
            self.clear()
        strings = [_strings(_array(w[1], "<u4"), w[2]) for _, _, w in group]
        coded = pa.chunked_array(strings).combine_chunks().dictionary_encode()
        codes = self.codes(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
        starts, at = np.cumsum(self.sizes) - self.sizes, 0
        for (block, bucket, w), s in zip(group, strings, strict=True):
            own = codes[at:at + len(s)]
            at += len(s)
            strange = [(k, self.odd[c]) for k, c in enumerate(own.tolist()) if c in self.odd] if self.odd else []
            data = _pack(w[0], self.sizes[own].astype("<u4"), gather(self.ids, starts, self.sizes, own))
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([bucket], pa.int32()), pa.array([data], pa.binary()),
                                              pa.array([[k for k, _ in strange]], pa.list_(pa.int32())), pa.array([[t for _, t in strange]], pa.list_(pa.string()))],
                                             ["block", "bucket", "ids", "odd_at", "odd_text"])


def _join(emit):
    """Join the ids of a block's chunks to its texts by position."""
    def run(texts: pa.Table, ids: pa.Table) -> pa.Table:
        out = []
        for r in texts.to_pylist():
            counts, codes = _array(_unpack(r["counts"])[0], "<u4"), _array(_unpack(r["codes"])[0], "<u4")
            words = [None if w is None else _unpack(w) for w in r["words"]]
            total = sum(len(w[0]) // 4 for w in words if w is not None)
            chunk, chunk_ids, filled = [""] * total, [b""] * total, 0
            for got in ids.to_pylist():
                delta, lengths, blob = words[got["bucket"]]
                at = np.cumsum(_array(delta, "<u4"), dtype=np.int64)
                own = [chunk_text(x) for x in _strings(_array(lengths, "<u4"), blob).to_pylist()]
                for k, t in zip(got["odd_at"], got["odd_text"], strict=True):
                    own[k] = t
                _, sizes, flat = _unpack(got["ids"])
                flat, ends = _array(flat, "<u4"), np.cumsum(_array(sizes, "<u4"), dtype=np.int64).tolist()
                for p, c, lo, hi in zip(at.tolist(), own, [0, *ends], ends):
                    chunk[p], chunk_ids[p] = c, flat[lo:hi]
                filled += len(own)
            if filled != total:
                raise RuntimeError("a block has chunks without ids; its input changed between two runs of a task")
            out.append(emit(r["doc_ids"], counts, codes, chunk, chunk_ids))
        return pa.concat_tables(out)
    return run


def encode(docs: DataFrame, path: str, emit, schema: str) -> DataFrame:
    """Encode and decode every text.  ``emit(doc_ids, counts, codes, chunks,
    ids)`` turns a block into rows of ``schema``: text k consists of counts[k]
    chunks, given by the next codes into ``chunks`` (decoded text) and ``ids``
    (uint32 arrays); a text's first chunk starts with the added marker."""
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    parts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = d.mapInArrow(_cut_blocks(path, parts), BLOCK).repartition(parts, "block")
    chunk_rows = table.mapInArrow(_chunk_rows, "block long, bucket int, words binary").repartition(parts, "bucket")
    ids = chunk_rows.mapInArrow(_segment_bucket(path), "block long, bucket int, ids binary, odd_at array<int>, odd_text array<string>")
    return table.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(_join(emit), schema)


def _emit_digests(doc_ids, counts, codes, chunks, ids) -> pa.Table:
    text_of = [",".join(map(str, i.tolist())) if len(i) else "" for i in ids]
    size = np.array([len(i) for i in ids], np.int64)
    codes = codes.astype(np.int64)
    tokens, a, b, at = [], [], [], 0
    for n in counts.tolist():
        own = codes[at:at + n]
        tokens.append(int(size[own].sum()))
        run = own.tolist()
        a.append(hashlib.sha256(",".join([text_of[c] for c in run]).encode()).hexdigest())
        b.append(hashlib.sha256("".join([chunks[c] for c in run])[1:].encode()).hexdigest())
        at += n
    return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(tokens, pa.int64()), "ids_sha256": a, "decoded_sha256": b})


def _emit_ids(doc_ids, counts, codes, chunks, ids) -> pa.Table:
    rows, texts, at = [], [], 0
    for n in counts.tolist():
        run = codes[at:at + n].tolist()
        rows.append(np.concatenate([ids[c] for c in run]).astype(np.int32) if run else np.zeros(0, np.int32))
        texts.append("".join([chunks[c] for c in run])[1:])
        at += n
    return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "ids": pa.array(rows, pa.list_(pa.int32())), "decoded": pa.array(texts, pa.string())})


def encode_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded."""
    return encode(docs, path, _emit_ids, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256."""
    return encode(docs, path, _emit_digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
