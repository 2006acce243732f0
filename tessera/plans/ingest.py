"""Ingest: documents -> chunks -> hashed embeddings -> versioned vector table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import weights
from ..functions.vectors import with_hashed_counts
from ..operators import ivf
from ..operators.chunking import fixed_chunks, recursive_chunks
from ..session import spread
from ..sinks import vector_store
from ..sinks.files import open_vector_table, write_vector_table

EMBEDDER = "md5-bag"


def build_vector_table(docs: DataFrame, root: str, size: int = 300, overlap: int = 100, dim: int = 64,
                       recursive: bool = False, embed=with_hashed_counts, embedder: str = EMBEDDER) -> str:
    """Chunk, embed with ``embed(df, text_col, out_col, dim)`` and write a new
    version of the vector table tagged ``{embedder}-{dim}``."""
    docs = spread(docs)
    chunks = recursive_chunks(docs, size, overlap) if recursive else fixed_chunks(docs, size, overlap)
    vec = embed(chunks, "chunk", "embedding", dim)
    return write_vector_table(vec, root, f"{embedder}-{dim}", dim)


def open_vectors(spark: SparkSession, root: str, dim: int = 64, embedder: str = EMBEDDER) -> DataFrame:
    """The current version; refused unless it was built by ``embedder``/``dim``."""
    return open_vector_table(spark, root, f"{embedder}-{dim}", dim)


def index_vectors(vectors: DataFrame, root: str, c_id: str = "chunk_id", c_vec: str = "embedding") -> ivf.Index:
    """Write the inverted-file index of a vector table (a version, or any
    table of ids and vectors) under ``root``, a new folder, and open it."""
    return ivf.build(vectors, root, c_id=c_id, c_vec=c_vec)


def update_vector_table(docs: DataFrame, root: str, size: int = 300, overlap: int = 100, dim: int = 64, recursive: bool = False, embed=with_hashed_counts,
                        embedder: str = EMBEDDER) -> dict:
    """Bring an updatable vector table to the state of ``docs``: only new and
    changed documents are chunked and embedded (``vector_store.update``)."""
    cut = recursive_chunks if recursive else fixed_chunks
    return vector_store.update(docs, root, lambda d: cut(spread(d), size, overlap), lambda c: embed(c, "chunk", "embedding", dim), f"{embedder}-{dim}")


def read_vectors(spark: SparkSession, root: str, dim: int = 64, embedder: str = EMBEDDER, snapshot: int | None = None) -> DataFrame:
    return vector_store.read(spark, root, f"{embedder}-{dim}", snapshot)


def build_weighted_table(docs: DataFrame, root: str, size: int = 300, overlap: int = 100, dim: int = 64) -> weights.Weights:
    """A vector table with tf-idf vectors.  The weights are fitted on ``docs``
    when there are none at ``root`` and reused afterwards, as vectors of one
    table must share them."""
    spark = docs.sparkSession
    try:
        w = weights.load(spark, root)
    except ValueError:
        w = weights.fit(docs, dim=dim)
        weights.save(spark, w, root)
    update_vector_table(docs, root, size, overlap, dim, embed=w.embed, embedder=w.embedder)
    return w
