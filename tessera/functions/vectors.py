"""Vector expressions over ``array<float|double>`` columns (all in double,
summed left to right with ``aggregate``), relevance scores and the hashed
bag-of-tokens embedding.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import tokens


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v) -> Column:
    return F.transform(_c(v), lambda x: x.cast("double"))


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def sq_l2(a, b) -> Column:
    """Squared Euclidean distance (the vector store's default metric)."""
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)))


def l2(a, b) -> Column:
    return F.sqrt(sq_l2(a, b))


def norm(a) -> Column:
    return F.sqrt(_sum(F.transform(as_double(a), lambda x: x * x)))


def cosine_distance(a, b) -> Column:
    """1 - cosine similarity; null when either vector is all zeros."""
    return F.lit(1.0) - dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def relevance(sq_distance) -> Column:
    """Relevance in about [0, 1] from a squared L2 distance of unit vectors:
    1 - d / sqrt(2).  Not bounded below by 0."""
    return F.lit(1.0) - _c(sq_distance) / F.lit(math.sqrt(2.0))


def token_bucket(tok, dim: int) -> Column:
    """Bucket of a token: first 8 hex digits of its md5, modulo ``dim``.  Where
    ``dim`` divides a power of 16 only the last digits of the eight decide."""
    digits = next((n for n in range(1, 8) if 16 ** n % dim == 0), 8)
    return F.conv(F.substring(F.md5(tok), 9 - digits, digits), 16, 10).cast("bigint") % F.lit(dim)


def token_buckets(text, dim: int = 64, lower: bool = True) -> Column:
    """md5 bucket id of every whitespace token of ``text`` (JVM side)."""
    return F.transform(tokens(text, lower=lower), lambda t: token_bucket(t, dim).cast("int"))


KEPT_TOKENS = 200_000  # tokens whose bucket a task keeps
COUNTED_ROWS = 2_048  # texts that are counted at once
_BLANKS = bytes.maketrans(b"\t\r\n", b"   ")


class _Buckets(dict):
    """Token (UTF-8) -> ``token_bucket``; ``dim`` for the empty string between blanks."""

    def __init__(self, dim: int):
        self.dim = dim

    def __missing__(self, token: bytes) -> int:
        if len(self) >= KEPT_TOKENS:
            self.clear()
        self[token] = b = int.from_bytes(hashlib.md5(token, usedforsecurity=False).digest()[:4], "big") % self.dim if token else self.dim
        return b


def hashed_text(text, lower: bool = True) -> Column:
    """What ``text_counts`` reads: the UTF-8 bytes, in lower case by default."""
    return (F.lower(_c(text)) if lower else _c(text)).cast("binary")


def text_counts(dim: int = 64) -> Callable[[Sequence[bytes | None]], np.ndarray]:
    """Counts of the buckets of the tokens of a batch of texts, one row a text
    (null: zeros): the same as ``token_buckets``, but a token is hashed once a
    task and not wherever it stands."""
    buckets = _Buckets(dim)

    def counts(texts: Sequence[bytes | None]) -> np.ndarray:
        ids = [[*map(buckets.__getitem__, t.translate(_BLANKS).split(b" "))] if t else () for t in texts]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        at = np.repeat(np.arange(len(ids)) * (dim + 1), sizes) + np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum()))
        return np.bincount(at, minlength=len(ids) * (dim + 1)).reshape(len(ids), dim + 1)[:, :dim]

    return counts


def count_texts(counts: Callable[[Sequence[bytes | None]], np.ndarray]):
    """``counts`` as an Arrow-batched UDF: binary -> ``array<int>``."""
    @F.pandas_udf("array<int>")
    def udf(texts: pd.Series) -> pd.Series:
        parts = (counts(texts.iloc[s:s + COUNTED_ROWS].tolist()).astype(np.int32) for s in range(0, len(texts), COUNTED_ROWS))
        return pd.Series([row for part in parts for row in part], dtype=object)

    return udf


def with_hashed_counts(df, text_col: str, out_col: str, dim: int = 64, lower: bool = True):
    """Add ``out_col``: hashed bag-of-tokens counts of ``text_col`` (a narrow,
    shuffle-free step, one pass per Arrow batch)."""
    return df.withColumn(out_col, count_texts(text_counts(dim))(hashed_text(text_col, lower)))


#: For a search that embeds its corpus within its own tasks: the column to send there and the function of a batch of it.
with_hashed_counts.in_task = lambda text, dim: (hashed_text(text), text_counts(dim))


def int_dot(a, b) -> Column:
    """Exact integer dot product of two count vectors."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x * y).cast("bigint")),
                       F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def int_sq_norm(a) -> Column:
    return int_dot(a, a)


def normalized(counts) -> Column:
    """L2-normalised ``array<double>`` of a count vector (zero stays zero)."""
    n = F.sqrt(int_sq_norm(counts).cast("double"))
    return F.transform(_c(counts), lambda v: F.when(n > 0, v / n).otherwise(F.lit(0.0)))
