"""Weighted embedding: hashed token counts times the inverse document
frequency of their buckets, scaled to length one.

The frequencies come from one aggregate over the documents; the weights are a
value of their own (``Weights``), named by their content.  The name is the
embedder id of every table built with them, so a table and a question that do
not share the weights refuse each other, and both sides of a search take the
weights stored beside the table.
"""

from __future__ import annotations

import hashlib
import json
import math
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.pointers import commit, current
from .vectors import token_buckets, with_hashed_counts

NAME = "WEIGHTS"


class Weights(NamedTuple):
    """``idf`` per bucket: ln((1 + documents) / (1 + documents that hold it)) + 1."""
    idf: tuple[float, ...]

    @property
    def embedder(self) -> str:
        return "md5-tfidf-" + hashlib.sha256(json.dumps(self.idf).encode()).hexdigest()[:12]

    def embed(self, df: DataFrame, text_col: str, out_col: str, dim: int) -> DataFrame:
        """The ``embed`` hook of ``retrieve`` and ``build_vector_table`` (unit
        vectors: compare with ``metric='sq_l2'``); a text without tokens gets
        the zero vector."""
        if dim != len(self.idf):
            raise ValueError(f"weights of {len(self.idf)} buckets, vectors of {dim}")
        idf = F.array(*[F.lit(x) for x in self.idf])
        raw = F.zip_with("_counts", idf, lambda c, w: c * w)
        norm = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda s, x: s + x * x))
        return (with_hashed_counts(df, text_col, "_counts", dim).withColumn("_raw", raw).withColumn("_norm", norm)
                .withColumn(out_col, F.transform("_raw", lambda x: F.when(F.col("_norm") > 0, x / F.col("_norm")).otherwise(F.lit(0.0)))).drop("_counts", "_raw", "_norm"))


def document_frequencies(docs: DataFrame, text_col: str = "text", dim: int = 64) -> DataFrame:
    """(bucket, df) of the buckets that occur, and a row of bucket -1 with the
    number of documents: one aggregate, combined map-side to ``dim`` + 1 rows a
    task."""
    held = F.array_distinct(token_buckets(F.coalesce(F.col(text_col), F.lit("")), dim))
    return docs.select(F.explode(F.concat(F.array(F.lit(-1)), held)).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("df"))


def fit(docs: DataFrame, text_col: str = "text", dim: int = 64) -> Weights:
    df = {r.bucket: r.df for r in document_frequencies(docs, text_col, dim).collect()}  # dim + 1 rows
    return Weights(tuple(math.log((1 + df.get(-1, 0)) / (1 + df.get(b, 0))) + 1 for b in range(dim)))


def save(spark: SparkSession, weights: Weights, root: str) -> None:
    """Store the weights beside a vector table."""
    commit(spark, root, NAME, json.dumps(weights.idf))


def load(spark: SparkSession, root: str) -> Weights:
    number, idf = current(spark, root, NAME)
    if not number:
        raise ValueError(f"no weights at {root}")
    return Weights(tuple(idf))
