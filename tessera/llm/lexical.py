"""Ranked lexical search: for every item of a query table, its best documents.

Pass 1 cuts the documents into blocks and writes, per block, the postings of
the query terms (document and count, in document order), with the counts that
the corpus statistics need.  Pass 2 reads the blocks and answers every item:
the postings of its short lists are summed into accumulators (term at a time);
these stand as one more iterator, with one bound, beside the long lists, which
are walked document at a time.  Windows of documents whose bounds cannot reach
the item's k-th best score are skipped; in the others a document is dropped as
soon as its score and the bounds of the lists left stay below it.  The k best
of a task are merged in two steps.  No text and no posting is shuffled.

Query terms are held by every task, so items are taken in groups of about
GROUP_BYTES of terms, dealt by hash; each group has its own two passes.

Defined results: a null or empty text has no terms, and neither has one of
separators only; such documents count nowhere and such items give no rows; a
very long text is a block of its own; rows of one item id are one item, its
terms united; repeated document rows are ranked one by one; equal scores go by
doc_id, a null doc_id last; an empty table gives no rows; extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.chunks import blocks
from tessera.llm.common import materialize, pick, released

K = 10
BLOCK_DOCS, BLOCK_BYTES = 4096, 8 << 20  # documents and text of a block
SHORT_SHARE = 16  # a list of at most this fraction of the block's documents is short
SPAN, WALK = 64, 8  # documents of a window; windows between two looks at the k-th best score
GROUP_BYTES = 4 << 20  # query terms held at once
MERGE_SLICES = 64
# ASCII letters and digits are parts of terms, A-Z as a-z; other ASCII separates.
_PARTS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_PARTS).split()


def _item_terms(batches):
    for batch in batches:
        rows = [(i, t) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for t in set(terms(text))]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.binary())], names=["item_id", "term"])


POSTINGS = ("doc_ids array<long>, n binary, n_docs long, n_terms long, terms array<int>, sizes array<long>, docs binary, counts binary")


def _postings(shared):
    """One row per block: its documents that hold a query term, and the
    postings of every term, in the order of ``terms``."""
    def run(batches):
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                for part in blocks(batch.slice(at, BLOCK_DOCS), 1, BLOCK_BYTES):
                    yield one(part, known)

    def one(part: pa.RecordBatch, known: dict[bytes, int]) -> pa.RecordBatch:
        ids, lengths, places, found, all_docs, all_terms = [], [], [], [], 0, 0
        for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            words = terms(text)
            all_docs, all_terms = all_docs + bool(words), all_terms + len(words)
            if own := [known[w] for w in words if w in known]:
                places.append(np.full(len(own), len(ids), np.int64))
                found.append(np.array(own, np.int64))
                ids.append(doc_id)
                lengths.append(len(words))
        doc, term = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, found))
        pair, counts = np.unique(term << 32 | doc, return_counts=True)
        held, sizes = np.unique(pair >> 32, return_counts=True)
        columns = [(ids, pa.list_(pa.int64())), (np.array(lengths, "<i8").tobytes(), pa.binary()), (all_docs, pa.int64()), (all_terms, pa.int64()),
                   (held, pa.list_(pa.int32())), (sizes, pa.list_(pa.int64())), ((pair & 0xFFFFFFFF).astype("<u4").tobytes(), pa.binary()), (counts.astype("<u4").tobytes(), pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in columns], names=[c.split()[0] for c in POSTINGS.split(", ")])
    return run


class Block:
    """One block opened for search: scores of every posting and the largest
    of each list in each window."""

    def __init__(self, row: dict, weights: np.ndarray, corpus_docs: int, corpus_terms: int):
        self.nulls = np.array([i is None for i in row["doc_ids"]], bool)
        self.ids = np.array([i or 0 for i in row["doc_ids"]], np.int64)
        n = np.frombuffer(row["n"], "<i8")
        m = np.array([10 + (90 * x * corpus_docs) // corpus_terms for x in n.tolist()], np.int64)
        held, self.docs, tf = np.array(row["terms"], np.int64), np.frombuffer(row["docs"], "<u4").astype(np.int64), np.frombuffer(row["counts"], "<u4").astype(np.int64)
        self.ends = np.cumsum(np.array([0, *row["sizes"]], np.int64))
        self.at = {int(t): i for i, t in enumerate(held) if weights[t] > 0}
        self.score = np.repeat(weights[held], np.diff(self.ends)) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[self.docs]))
        self.windows = -(-len(n) // SPAN)
        self.bounds: dict[int, np.ndarray] = {}

    def lists(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.docs[self.ends[i]:self.ends[i + 1]], self.score[self.ends[i]:self.ends[i + 1]]

    def bound(self, i: int) -> np.ndarray:
        if i not in self.bounds:
            docs, score = self.lists(i)
            self.bounds[i] = _window_max(docs, score, self.windows)
        return self.bounds[i]

    def best(self, query: list[int], floor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that may belong to the k best, given that the
        k-th best score known so far is ``floor``."""
        mine = [self.at[t] for t in query if t in self.at]
        if not mine:
            return _NONE
        short = [i for i in mine if self.ends[i + 1] - self.ends[i] <= len(self.ids) // SHORT_SHARE]
        # term at a time: the short lists become one iterator
        summed = np.zeros(len(self.ids), np.int64)
        for i in short:
            docs, score = self.lists(i)
            summed[docs] += score
        first = _window_max(np.flatnonzero(summed), summed[summed > 0], self.windows)
        # document at a time: it and the long lists, the highest bounds first
        long = sorted(set(mine) - set(short), key=lambda i: -int(self.bound(i).max()))
        left = np.zeros((len(long) + 1, self.windows), np.int64)  # bounds of lists not yet read
        for j in range(len(long) - 1, -1, -1):
            left[j] = left[j + 1] + self.bound(long[j])
        live = np.flatnonzero(first + left[0] >= max(floor, 1))
        docs_found, scores_found = [], []
        for at in range(0, len(live), WALK):
            some = live[at:at + WALK]
            some = some[(first + left[0])[some] >= max(floor, 1)]
            docs = (some[:, None] * SPAN + np.arange(SPAN)[None, :]).ravel()
            docs = docs[docs < len(self.ids)]
            total = summed[docs]
            for j, i in enumerate(long):
                stays = total + left[j][docs // SPAN] >= max(floor, 1)
                docs, total = docs[stays], total[stays]
                if not len(docs):
                    break
                held, score = self.lists(i)
                where = np.minimum(np.searchsorted(held, docs), len(held) - 1)  # skip to each document
                total = total + np.where(held[where] == docs, score[where], 0)
            stays = total >= max(floor, 1)
            docs_found.append(docs[stays])
            scores_found.append(total[stays])
            if stays.any():
                every = np.concatenate(scores_found)
                if len(every) >= k:
                    floor = max(floor, int(np.partition(every, len(every) - k)[len(every) - k]))
        return (np.concatenate(docs_found), np.concatenate(scores_found)) if docs_found else _NONE


_NONE = np.zeros(0, np.int64), np.zeros(0, np.int64)


def _window_max(docs: np.ndarray, score: np.ndarray, windows: int) -> np.ndarray:
    out = np.zeros(windows, np.int64)
    np.maximum.at(out, docs // SPAN, score)
    return out


def _search(shared, corpus_docs: int, corpus_terms: int, k: int):
    def run(batches):
        queries, weights = shared.value
        top = [(*_NONE, np.zeros(0, bool))] * len(queries)  # scores, ids, whether the id is null
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block(batch.slice(at, 1).to_pylist()[0], weights, corpus_docs, corpus_terms)
                for q, query in enumerate(queries):
                    score, ids, nulls = top[q]
                    docs, more = block.best(query, int(score[-1]) if len(score) == k else 0, k)
                    if len(docs):
                        score, ids, nulls = np.concatenate([score, more]), np.concatenate([ids, block.ids[docs]]), np.concatenate([nulls, block.nulls[docs]])
                        order = np.lexsort((ids, nulls, -score))[:k]
                        top[q] = score[order], ids[order], nulls[order]
        sizes = [len(s) for s, _, _ in top]
        if sum(sizes):
            score, ids, nulls = (np.concatenate(x) for x in zip(*top))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(top)), sizes), pa.int64()), pa.array(ids, pa.int64(), mask=nulls), pa.array(score, pa.int64()),
                                              pa.array(np.full(len(score), TaskContext.get().partitionId() % MERGE_SLICES), pa.int32())], names=["item", "doc_id", "score", "part"])
    return run


def _rank_group(items: DataFrame, docs: DataFrame, k: int) -> DataFrame | None:
    """The best documents of one group of items (item_id, term)."""
    sc = docs.sparkSession.sparkContext
    rows = [(r.item_id, bytes(r.term)) for r in items.collect()]  # about GROUP_BYTES
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, t in rows}))}
    postings = materialize(docs.mapInArrow(released(_postings(sc.broadcast(vocabulary))), POSTINGS), "postings")
    corpus = postings.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    held = postings.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t")).groupBy("t.terms").agg(F.sum("t.sizes").alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for r in held.collect():  # at most one row per term of the group
        weights[r.terms] = math.floor(1000 * math.log((2 * corpus.docs + 2) / (2 * r.df + 1)))
    names = sorted({i for i, _ in rows}, key=lambda i: (i is None, i))
    place = {i: n for n, i in enumerate(names)}
    queries = [[] for _ in names]
    for i, t in rows:
        queries[place[i]].append(vocabulary[t])
    if not corpus.terms:
        return None
    found = postings.mapInArrow(released(_search(sc.broadcast((queries, weights)), corpus.docs, corpus.terms, k)), "item long, doc_id long, score long, part int")
    order = F.desc("score"), F.asc_nulls_last("doc_id")
    for by in (["item", "part"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)
    ids = docs.sparkSession.createDataFrame(list(enumerate(names)), "item long, item_id long")
    return found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def rank(items: DataFrame, docs: DataFrame, k: int = K, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item.
    ``items`` holds item_id and text, ``docs`` doc_id and text."""
    asked = pick(items, "item_id", "text").select(F.col("item_id").cast("long").alias("item_id"), "text")
    asked = materialize(asked.mapInArrow(_item_terms, "item_id long, term binary").distinct(), "item-terms")
    size = asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    groups = -(-size // group_bytes)
    found = None
    for g in range(groups):
        part = _rank_group(asked if groups == 1 else asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g), d, k)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
     c AS (SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM w WHERE len(words) > 0),
     q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
     t AS (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM w),
     p AS (SELECT doc_id, any_value(n)::BIGINT AS n, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
     f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
     i AS (SELECT p.doc_id, p.term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
                  * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS impact FROM p JOIN f ON p.term = f.term CROSS JOIN c),
     s AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM q JOIN i ON q.term = i.term GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""
