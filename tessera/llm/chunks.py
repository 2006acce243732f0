"""Cutting texts into independent tokenizer chunks, vectorised with Arrow.

A tokenizer whose pieces never cross a point of the text can be run on the
chunks between such points, so each distinct chunk is segmented once.  Words
are cut with Arrow kernels for ordinary texts and with a regular expression
for texts in which the plain rule (one separator between words) does not
hold.  A chunk travels as a word:

* ``w``          stands for a space followed by w,
* ``\\x00`` + w   stands for a newline followed by w,
* ``\\x02`` + c   is the chunk c itself.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NEWLINE, RAW = "\x00", "\x02"


def chunk_text(word: str) -> str:
    if word.startswith(RAW):
        return word[1:]
    return "\n" + word[1:] if word.startswith(NEWLINE) else " " + word


class Words:
    """Distinct words of a block and, for each text, the run of its codes."""

    def __init__(self, distinct: pa.Array, codes: np.ndarray, counts: np.ndarray):
        self.distinct, self.codes, self.counts = distinct, codes, counts
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts


def cut(texts: pa.Array, odd: str, first_raw: bool, raw_chunks: Callable[[str], list[str]]) -> Words:
    """Cut ``texts`` (large_string, no nulls).  ``odd``: RE2 pattern of texts
    that go to ``raw_chunks`` instead; ``first_raw``: no separator is implied
    before a text's first word.  An empty text has no chunk."""
    n = len(texts)
    empty = np.asarray(pc.equal(pc.binary_length(texts), 0))
    slow = np.asarray(pc.match_substring_regex(texts, odd)) & ~empty
    plain = pc.replace_substring(texts, "\n", " " + NEWLINE)
    if first_raw:
        plain = pc.binary_join_element_wise(pa.scalar(RAW, pa.large_string()), plain, pa.scalar("", pa.large_string()))
    fast = np.flatnonzero(~slow & ~empty)
    lists = pc.split_pattern(plain.take(pa.array(fast)), " ")
    own = np.diff(np.asarray(lists.offsets)) if len(fast) else np.zeros(0, np.int64)
    counts = np.zeros(n, np.int64)
    counts[fast] = own
    parts = [lists.flatten().cast(pa.large_string())]
    raws = []
    for i in np.flatnonzero(slow):
        r = raw_chunks(texts[i].as_py())
        counts[i] = len(r)
        raws += r
    if raws:
        parts.append(pa.array(raws, pa.large_string()))
    coded = pa.concat_arrays(parts).dictionary_encode()
    codes = np.asarray(coded.indices).astype(np.int64)
    if raws:  # the slow texts' chunks stand at the end: put every run in its place
        order = np.concatenate([np.repeat(fast, own), np.repeat(np.flatnonzero(slow), counts[slow])])
        codes = codes[np.argsort(order, kind="stable")]
    return Words(coded.dictionary, codes, counts)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Concatenate values[starts[c]:starts[c] + lengths[c]] for c in codes."""
    take = lengths[codes]
    ends = np.cumsum(take)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts[codes] - (ends - take), take)
    at += np.arange(total, dtype=at.dtype)
    return values[at]


def blocks(batch: pa.RecordBatch, column: int, max_bytes: int):
    """Slices of a batch with about ``max_bytes`` of text each (a longer text
    stands alone)."""
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64))
    at = 0
    while at < batch.num_rows:
        floor = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, floor + max_bytes, "right")))
        yield batch.slice(at, end - at)
        at = end
