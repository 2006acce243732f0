"""Retrieval: embed questions and chunks with the same embedder, find the
k nearest chunks per question, test the best relevance, and build the
ordered context, the ordered source list and the filled prompt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import CONTEXT_SEPARATOR, PROMPT_TEMPLATE, fill_template
from ..functions.vectors import with_hashed_counts
from ..operators.chunking import CHUNK_ID_STRIDE
from ..operators.knn import knn_join, threshold, with_lsh_keys
from ..session import checked_broadcast, fits, new_scratch_path

# Questions up to this count make a hit table (questions x k rows) small
# enough to broadcast into the chunk table; above it the join shuffles.
BROADCAST_QUESTIONS = 100_000


def _ordered(field: str, sep: str):
    """Join the ``field`` of a query's hits in rank order.  A query has at
    most k hits, so the collected list is bounded by k."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rk", field))),
                                    lambda x: x[field]), sep)


Cut = tuple[DataFrame, Callable[[DataFrame], DataFrame]]


def _recut(hits: DataFrame, documents: DataFrame, chunker: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The hits, written once (questions x k rows), and the chunks of the
    documents that hold them.  A chunk id tells its document unless it is a
    hash; documents whose chunk ids can be hashes are all cut."""
    path = new_scratch_path(hits.sparkSession, "hits")
    hits.write.parquet(path)
    hits = hits.sparkSession.read.schema(hits.schema).parquet(path)
    ids = hits.select(F.floor(F.col("chunk_id") / CHUNK_ID_STRIDE).alias("_id")).distinct()
    far = F.coalesce((F.abs("doc_id") >= 1 << 42) | (F.length("text") >= CHUNK_ID_STRIDE), F.lit(True))
    near = documents.filter(~far).join(checked_broadcast(ids), F.col("doc_id") == F.col("_id"), "left_semi")
    return hits, chunker(near.unionByName(documents.filter(far)))


def hits_for(questions: DataFrame, chunks: DataFrame, k: int = 3, dim: int = 64,
             q_id: str = "query_id", q_text: str = "text", embed=with_hashed_counts,
             metric: str = "cosine_counts", lsh: tuple[int, int] | None = None, cut: Cut | None = None) -> DataFrame:
    """Top-k chunk hits per question joined back to the chunk text and
    source.  ``embed(df, text_col, out_col, dim)`` is the embedder, applied to
    both sides (default: hashed token counts, compared by cosine); an
    embedder of float vectors pairs with ``metric='sq_l2'``.  An embedder with
    an ``in_task(text, dim)`` (see ``with_hashed_counts``) embeds the chunks in
    the tasks that search them, so no vector of a chunk leaves a task.

    ``lsh=(tables, bits)`` searches approximately, as the original vector
    store does: both sides get hyperplane sign buckets (one per table, the
    query also probing the buckets one bit away) and only bucket mates are
    compared, exactly.  Signs do not change under positive scaling, so the
    raw counts bucket like their cosine.

    ``cut=(documents, chunker)`` says how ``chunks`` was made: then the text of
    a hit comes from its own document, cut again, and the rest of the corpus is
    not cut a second time."""
    qv = embed(questions.select(F.col(q_id).alias("query_id"), F.col(q_text).alias("text")), "text", "v", dim)
    kw = {}
    if lsh is None and hasattr(embed, "in_task"):
        text, kw["c_embed"] = embed.in_task("chunk", dim)
        cv = chunks.select("chunk_id", text.alias("v"))
    else:
        cv = embed(chunks.select("chunk_id", "chunk"), "chunk", "v", dim)
    if lsh is not None:
        tables, bits = lsh
        qv, cv = with_lsh_keys(qv, "v", dim, tables, bits), with_lsh_keys(cv, "v", dim, tables, bits)
        kw = dict(c_bucket=F.col("_ckeys"), q_probe=F.col("_qkeys"))
    hits = knn_join(qv, cv, k, q_id="query_id", q_vec="v", c_id="chunk_id", c_vec="v", metric=metric, **kw)
    if cut is not None:
        hits, chunks = _recut(hits, *cut)
    if fits(questions, BROADCAST_QUESTIONS):
        hits = F.broadcast(hits)
    origin = [c for c in ("doc_id", "start_index") if c in chunks.columns]
    return chunks.select("chunk_id", "chunk", "source", *origin).join(hits, "chunk_id")


def source_records(hits: DataFrame) -> DataFrame:
    """Per question the ordered list of where its hits come from:
    array<struct<source, start_index>>, at most k entries."""
    ranked = F.array_sort(F.collect_list(F.struct("rk", "source", "start_index")))
    records = F.transform(ranked, lambda x: F.struct(x["source"].alias("source"), x["start_index"].alias("start_index")))
    return hits.groupBy("query_id").agg(records.alias("sources"))


def context_rows(hits: DataFrame) -> DataFrame:
    return hits.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.max("relevance").alias("best_relevance"),
        _ordered("chunk", CONTEXT_SEPARATOR).alias("context"),
        _ordered("source", ", ").alias("sources"))


def retrieve(questions: DataFrame, chunks: DataFrame, k: int = 3, dim: int = 64, min_relevance: float = 0.5,
             on_low: str = "flag", template: str = PROMPT_TEMPLATE, q_id: str = "query_id",
             q_text: str = "text", embed=with_hashed_counts, metric: str = "cosine_counts",
             lsh: tuple[int, int] | None = None, cut: Cut | None = None) -> DataFrame:
    """One row per question: hit count, best relevance, low-confidence flag
    (or, with ``on_low='drop'``, only questions whose best hit passes),
    ordered context, ordered sources and the filled prompt."""
    hits = hits_for(questions, chunks, k, dim, q_id, q_text, embed, metric, lsh, cut)
    if on_low == "drop":
        hits = threshold(hits, min_relevance, on_low="drop")
    ctx = context_rows(hits)
    q = questions.select(F.col(q_id).alias("query_id"), F.col(q_text).alias("question"))
    how = "inner" if on_low == "drop" else "left"
    out = q.join(ctx, "query_id", how)
    context = F.coalesce("context", F.lit(""))
    return out.select(
        "query_id", F.coalesce("n_hits", F.lit(0)).alias("n_hits"), "best_relevance",
        F.coalesce(F.col("best_relevance") < min_relevance, F.lit(True)).alias("low_confidence"),
        context.alias("context"), F.coalesce("sources", F.lit("")).alias("sources"),
        fill_template(template, context, F.col("question")).alias("prompt"))
