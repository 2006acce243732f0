"""Packing by concatenate and cut.

Pass 1 tokenizes each partition and writes, per document, its ids and the
tokens of the same partition before it.  The partition totals (one row each)
are turned into global offsets by a prefix sum.  Pass 2 adds the two numbers
and cuts every document at the multiples of the window; a document that
crosses a window boundary gives one record per window.  Only the totals are
shuffled, never ids.

Defined results: a null or empty text has only the end id; documents follow
one another in partition order; all sequences are full but the last, which is
padded unless its length is a power of two; repeated rows and null ids are
packed like any other row; a very long text is tokenized whole by one task and
cut into as many pieces as it needs; extra columns are ignored; an empty table
gives no pieces.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.chunks import RAW, blocks, chunk_text, cut, gather
from tessera.llm.common import materialize, pick, released

WINDOW = 2048
END_ID = 1
SPECIAL = "<|endoftext|>"  # a text that holds it is encoded whole by the library
BLOCK_BYTES = 8 << 20  # text tokenized together
CACHE_WORDS = 250_000  # distinct chunks a task remembers (about 50 MB)
CUT_ROWS = 1000  # documents cut together in pass 2
# Fixed value: the split pattern of byte-level BPE tokenizers of this kind.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Chunks of these characters only go to the faster encoder; the library itself
# takes the rest, whose character classes may differ between Unicode versions.
LATIN = re.compile(r"[\n -~\u00a1-\u024f]*")
# Texts beyond the plain rule: two separators in a row, one at the start, any
# other white space or control character, the special string.
ODD = (r"[ \n][ \n]|^[ \n]|[\x00-\x09\x0b-\x1f\x7f-\xa0]|[\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]|"
       + re.escape(SPECIAL))
# A chunk ends between a character that is surely no white space and a separator.
SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n])")


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@cache
def _ranked(path: str):
    """The same vocabulary in tiktoken's encoder, or None where its ids are
    not in the order of its merges."""
    import tiktoken
    model = json.load(open(path, encoding="utf-8"))["model"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if any(model["vocab"][a + b] != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    ranks = {bytes(char[c] for c in w): i for w, i in model["vocab"].items() if i < 256 + len(merges)}
    return tiktoken.Encoding("chunks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


@cache
def id_type(path: str) -> str:
    return "<u2" if _tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4"


def _raw_chunks(text: str) -> list[str]:
    return [RAW + text] if SPECIAL in text else [RAW + c for c in SAFE_CUT.split(text)]


def _encode(words: list[str], path: str, known: dict[str, bytes]) -> list[bytes]:
    """Ids (little-endian, ``id_type`` wide) of each distinct chunk; chunks ``known`` holds
    are not segmented again."""
    kind = id_type(path)
    fresh = [w for w in words if w not in known]
    if len(known) + len(fresh) > CACHE_WORDS:
        known.clear()
        fresh = words
    fast, rest = _ranked(path), []
    for w in fresh:
        c = chunk_text(w)
        if fast is not None and SPECIAL not in c and LATIN.fullmatch(c):
            known[w] = np.array(fast.encode_ordinary(c), kind).tobytes()
        else:
            rest.append((w, c))
    for at in range(0, len(rest), 10_000):
        some = rest[at:at + 10_000]
        for (w, _), e in zip(some, _tokenizer(path).encode_batch_fast([c for _, c in some], add_special_tokens=False), strict=True):
            known[w] = np.array(e.ids, kind).tobytes()
    return [known[w] for w in words]


def token_ids(texts: pa.Array, path: str, known: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, ids per text) without end ids."""
    words = cut(texts, ODD, True, _raw_chunks)
    ids = _encode(words.distinct.to_pylist(), path, known)
    width = np.dtype(id_type(path)).itemsize
    lengths = np.array([len(b) // width for b in ids], np.int64)
    starts = np.cumsum(lengths) - lengths
    flat = gather(np.frombuffer(b"".join(ids), id_type(path)), starts, lengths, words.codes)
    per_word = lengths[words.codes]
    before = np.concatenate([[0], np.cumsum(per_word)])
    return flat, before[words.ends] - before[words.starts]


def _tokenized(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, known = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            for b in blocks(batch, 1, BLOCK_BYTES):
                flat, counts = token_ids(b.column(1).cast(pa.large_string()).fill_null(""), path, known)
                n = counts + 1
                ends = np.cumsum(n)
                out = np.full(int(ends[-1]), end_id, flat.dtype)
                mask = np.ones(len(out), bool)
                mask[ends - 1] = False
                out[mask] = flat
                ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b.num_rows, [
                    None, pa.py_buffer(np.concatenate([[0], ends * out.itemsize]).astype(np.int64)), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.full(b.num_rows, part, np.int32)), pa.array(seen + ends - n), pa.array(n), ids.cast(pa.binary())],
                    ["doc_id", "part", "before", "n", "ids"])
                seen += int(ends[-1])
    return run


def tokenize(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Pass 1, written once: doc_id, part, before, n, ids (little-endian, as
    wide as the vocabulary needs)."""
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    t = d.mapInArrow(released(_tokenized(path, end_id)), "doc_id long, part int, before long, n long, ids binary")
    return materialize(t, "token-ids")


def partition_offsets(tokens: DataFrame) -> DataFrame:
    """Prefix sums of the partition totals.  One row per partition of pass 1,
    so the table stays small: 16 bytes for each task."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))


def _cutter(window: int, kind: str):
    cols = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (batch.slice(at, CUT_ROWS) for batch in batches for at in range(0, batch.num_rows, CUT_ROWS)):
            first = np.asarray(b.column(1)) + np.asarray(b.column(4))  # before + offset of the partition
            n = np.asarray(b.column(2))
            pieces = (first + n - 1) // window - first // window + 1
            row = np.repeat(np.arange(b.num_rows), pieces)
            seq = first[row] // window + np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            lo = np.maximum(seq * window, first[row])
            hi = np.minimum((seq + 1) * window, first[row] + n[row])
            start = lo - first[row]
            doc = [np.frombuffer(x.as_buffer(), kind) for x in b.column(3)]
            ids = [doc[r][s:s + k].astype("<u4").tobytes() for r, s, k in zip(row.tolist(), start.tolist(), (hi - lo).tolist(), strict=True)]
            arrays = [b.column(0).take(pa.array(row)), pa.array(start), pa.array(hi - lo), pa.array(n[row]), pa.array(seq), pa.array(lo - seq * window),
                      pa.array([crc32(x) for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, cols)
    return run


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset,
    ids_crc32, ids (uint32, little-endian)."""
    tokens = tokenize(docs, path, end_id)
    offsets = partition_offsets(tokens)
    placed = tokens.join(F.broadcast(offsets), "part").select("doc_id", "before", "n", "ids", "offset")
    return placed.mapInArrow(released(_cutter(window, id_type(path))), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long, ids binary")
