"""k-nearest-neighbour join: for every query vector, the k closest corpus
vectors, with rank, distance and relevance.

Plan shape (no cross join, no pair rows).

* few queries: at most ``broadcast_queries`` rows and 64 MB of vectors
            (checked with a bounded count) are broadcast and the corpus
            streams once through ``mapInArrow`` in its own scan partitions;
            every task keeps a running top-k per query, so neither side is
            shuffled and only k rows per query leave a task (retrieval: few
            questions, a huge chunk table);
* equal queries: of a larger query side that may meet itself, equal vectors
            ask once (they have the same neighbours), as few queries or
            blocked, and every row takes the hits of its vector;
* blocked:  both sides are cut into blocks of at most ``block_rows`` rows and
            SIDE_BYTES; each query block meets each corpus block in one
            ``cogroup`` + ``applyInArrow`` group.  A row is sent once per block
            of the other side, so a side of n rows is copied
            n / ``block_rows`` times; a group holds its two blocks and compares
            them in tiles of TILE rows, so memory does not follow the data;
* bucketed: random-hyperplane sign buckets (same seed on both sides), with
            optional multi-probe of the buckets one bit away; exact re-rank
            inside cells ``(bucket, q_block, c_block)`` dealt into packs,
            approximate overall (recall is measured in the tests).

A window group limit merges the winners of tasks, blocks or packs.  Distances
are computed in float64 and summed in index order, so they are bit-identical to
a left fold in SQL; ties go to the smaller corpus id.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.vectors import COUNTED_ROWS, count_texts, relevance
from ..session import new_scratch_path

OUT_SCHEMA = "qid long, cid long, distance double"
# Query sets up to this many rows, and up to this many bytes of float64
# vectors, are broadcast and the corpus is streamed; larger query sets use
# the blocked equi-key join.
BROADCAST_QUERIES = 65_536
BROADCAST_QUERY_BYTES = 64 << 20
TASKS_PER_CORE = 4
PACK_ROWS = 16_384  # rows of both sides that one Python group of small cells compares
BLOCK_ROWS, SIDE_BYTES = 65_536, 32 << 20  # one side of a blocked group, as float64
BUCKET_BLOCK_ROWS = 2_048  # rows of a side of a bucket's cell
LARGE = 1e30  # squared norms from which float32 does not do
TILE = 1_024  # rows of both sides that are compared at once
DEDUPE_QUERIES = 1_024  # from so many queries on, equal corpus rows of a block are compared once


def usable(df: DataFrame, vec: str) -> DataFrame:
    """The rows whose vector is there and has only finite components.  One
    NaN in a block would make every comparison with the block's bound false."""
    kind = df.schema[vec].dataType
    there = F.col(vec).isNotNull()
    if isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        x = F.transform(vec, lambda c: c.cast("double"))
        return df.filter(there & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return df.filter(there & F.forall(vec, lambda c: c.isNotNull()) if kind.containsNull else there)


def _small_query_side(queries: DataFrame, q_vec: str, max_rows: int, max_bytes: int) -> bool:
    """Row count and widest vector of at most ``max_rows + 1`` rows (the
    limit stops the scan early): the query side fits when both its rows and
    its float64 matrix stay within the bounds."""
    r = (queries.select(F.size(q_vec).alias("d")).limit(max_rows + 1)
         .agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d")).first())
    return r["n"] <= max_rows and r["n"] * max(r["d"] or 0, 0) * 8 <= max_bytes


BUCKET_ROWS = 64  # corpus rows of an even bucket


def lsh_bits(corpus_rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Bits per hash table that leave about ``bucket_rows`` corpus rows in an
    even bucket, so a query meets a number of rows that hardly grows."""
    return max(1, (max(corpus_rows - 1, 0) // bucket_rows).bit_length())


def hyperplanes(dim: int, bits: int, seed: int = 7) -> np.ndarray:
    return np.random.RandomState(seed).standard_normal((bits, dim))


MAX_TABLES, ASKED = 256, 500


def lsh_tables(df: DataFrame, id_col: str, vec_col: str, dim: int, bits: int, k: int = 3, floor: float = 0.9, seed: int = 7, queries: DataFrame | None = None) -> int:
    """Hash tables of ``bits`` bits whose probes (the bucket and those one bit
    away) meet at least ``floor`` of the exact ``k`` nearest rows, measured on
    ASKED rows (of ``queries``, when not all rows ask) by an exact search, with
    two hundredths to spare for the sample.  0 when MAX_TABLES do not: then only the exact search does."""
    d, q = (usable(x.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")), "v") for x in (df, df if queries is None else queries))
    asked = q.orderBy(F.xxhash64("id"), "id").limit(ASKED)
    exact = knn_join(asked, d, k, q_id="id", q_vec="v", c_id="id", c_vec="v", exclude_self=True)
    pairs = [(r.query_id, r.chunk_id) for r in exact.select("query_id", "chunk_id").collect()]  # at most ASKED * k
    if not pairs:
        return 1
    ids = sorted({i for p in pairs for i in p})
    wanted = df.sparkSession.createDataFrame([(i,) for i in ids], "id long")
    vectors = {r.id: r.v for r in d.join(F.broadcast(wanted), "id").collect()}
    V = np.array([vectors[i] for i in ids], dtype=np.float64)
    at = np.searchsorted(ids, np.array(pairs))
    signs = V @ hyperplanes(dim, MAX_TABLES * bits, seed).T > 0
    apart = (signs[at[:, 0]] != signs[at[:, 1]]).reshape(len(pairs), MAX_TABLES, bits).sum(2)
    recall = np.logical_or.accumulate(apart <= 1, axis=1).mean(0)
    return int(np.argmax(recall >= min(1.0, floor + 0.02))) + 1 if recall[-1] >= min(1.0, floor + 0.02) else 0


def lsh_buckets(planes: np.ndarray, tables: int, bits: int):
    """Arrow-batched sign buckets of every hash table: one numpy pass per
    batch.  The dot products are a left fold in index order (vectorised over
    rows and planes), the same sums as the SQL check, so
    every sign bit is identical to theirs."""
    P = np.asarray(planes, dtype=np.float64)
    weights = (1 << np.arange(bits)).astype(np.int32)

    @F.pandas_udf("array<int>")
    def buckets(vecs: pd.Series) -> pd.Series:
        ok = vecs.notna().to_numpy()
        out = [None] * len(vecs)
        if not ok.any():
            return pd.Series(out, dtype=object)
        V = np.stack(vecs[ok].to_numpy()).astype(np.float64)
        if V.shape[1] != P.shape[1]:
            raise ValueError(f"vectors of {V.shape[1]} values, hyperplanes of {P.shape[1]}")
        acc = np.zeros((V.shape[0], P.shape[0]))
        for i in range(P.shape[1]):
            acc = acc + V[:, i:i + 1] * P[:, i]
        b = ((acc > 0).reshape(V.shape[0], tables, bits) * weights).sum(2).astype(np.int32)
        for j, i in enumerate(np.flatnonzero(ok)):
            out[i] = b[j]
        return pd.Series(out, dtype=object)

    return buckets


def with_lsh_keys(df: DataFrame, vec_col: str, dim: int, tables: int = 3, bits: int = 4,
                  seed: int = 7) -> DataFrame:
    """Add ``_ckeys`` (one bucket key per hash table, for the corpus side)
    and ``_qkeys`` (each table's bucket plus the ``bits`` buckets one bit
    away, for the query side).  Keys of different tables never collide:
    key = table * 2^bits + bucket."""
    planes = hyperplanes(dim, tables * bits, seed)
    x = df.withColumn("_lsh", lsh_buckets(planes, tables, bits)(F.col(vec_col)))
    ck = [F.col("_lsh")[t] + F.lit(t << bits) for t in range(tables)]
    qk = [(F.col("_lsh")[t].bitwiseXOR(F.lit(flip))) + F.lit(t << bits)
          for t in range(tables) for flip in [0] + [1 << j for j in range(bits)]]
    return x.withColumn("_ckeys", F.array(*ck)).withColumn("_qkeys", F.array(*qk)).drop("_lsh")


def _nearest(qid: np.ndarray, Q: np.ndarray, cid: np.ndarray, C: np.ndarray, k: int, metric: str, exclude_self: bool):
    """(qid, cid, distance) of the k nearest rows of one block per query."""
    if metric == "cosine_counts":
        dots = Q.astype(np.float64) @ C.astype(np.float64).T  # whole numbers below 2^53: exact
        nq = (Q * Q).sum(1)
        nc = (C * C).sum(1)
        den = np.sqrt((nq[:, None] * nc[None, :]).astype(np.float64))
        with np.errstate(divide="ignore", invalid="ignore"):
            approx = np.where(den > 0, 2.0 - 2.0 * dots / den, 2.0)
    else:
        approx = (Q * Q).sum(1)[:, None] + (C * C).sum(1)[None, :] - 2.0 * (Q @ C.T)
    if exclude_self:
        approx = np.where(qid[:, None] == cid[None, :], np.inf, approx)
    # every column that may belong to the k nearest: within a rounding
    # bound of the k-th value, so ties are cut by the exact order only
    kth = np.partition(approx, min(k, len(cid)) - 1, axis=1)[:, min(k, len(cid)) - 1]
    slack = 0.0 if metric == "cosine_counts" else 1e-9 * (1.0 + (Q * Q).sum(1) + (C * C).sum(1).max())
    row, col = np.nonzero((approx <= (kth + slack)[:, None]) & np.isfinite(approx))
    if metric == "cosine_counts":
        exact = approx[row, col]
    else:
        exact = np.zeros(len(row))
        for j in range(Q.shape[1]):  # left fold in index order
            t = Q[row, j] - C[col, j]
            exact = exact + t * t
    order = np.lexsort((cid[col], exact, row))
    row, col, exact = row[order], col[order], exact[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row, "left") < k
    return qid[row[keep]], cid[col[keep]], exact[keep]


def _frame(found) -> pd.DataFrame:
    if not found:
        return pd.DataFrame({"qid": np.zeros(0, np.int64), "cid": np.zeros(0, np.int64), "distance": np.zeros(0)})
    return pd.DataFrame({n: np.concatenate(x) for n, x in zip(("qid", "cid", "distance"), zip(*found))})


def _vectors(column: pa.ChunkedArray, metric: str = "sq_l2") -> np.ndarray:
    v = column.combine_chunks()
    sizes = pc.unique(pc.list_value_length(v))
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sizes.to_pylist()}")
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1).astype(np.int64 if metric == "cosine_counts" else np.float64)


def _pack_topk(k: int, metric: str, exclude_self: bool):
    """The cells (bucket, query block, corpus block) of one pack, one by one."""
    def fn(q: pa.Table, c: pa.Table) -> pa.Table:
        found = []
        if q.num_rows and c.num_rows:
            # number the cells of both sides alike, then walk both in that order
            n, cell = q.num_rows, np.zeros(q.num_rows + c.num_rows, np.int64)
            for name in ("b", "qs", "cs"):
                values = pa.concat_arrays([x.cast(q.column(name).type) for t in (q, c) for x in t.column(name).chunks]).dictionary_encode()
                cell = np.unique(cell * len(values.dictionary) + values.indices.to_numpy(), return_inverse=True)[1]
            qid, cid, Q, C = q.column("qid").to_numpy(), c.column("cid").to_numpy(), _vectors(q.column("v"), metric), _vectors(c.column("v"), metric)
            if Q.shape[1] != C.shape[1]:
                raise ValueError(f"query vectors of {Q.shape[1]} values, corpus vectors of {C.shape[1]}")
            qo, co = np.argsort(cell[:n], kind="stable"), np.argsort(cell[n:], kind="stable")
            at = np.arange(cell.max() + 2)
            qa, ca = np.searchsorted(cell[:n][qo], at), np.searchsorted(cell[n:][co], at)
            for i in np.flatnonzero((np.diff(qa) > 0) & (np.diff(ca) > 0)):
                x, y = qo[qa[i]:qa[i + 1]], co[ca[i]:ca[i + 1]]
                found.append(_nearest(qid[x], Q[x], cid[y], C[y], k, metric, exclude_self))
        return pa.Table.from_pandas(_frame(found), preserve_index=False)
    return fn


def _few_copies(cid: np.ndarray, C: np.ndarray, keep: int) -> np.ndarray:
    """Rows, by ascending id, without those whose vector ``keep`` smaller ids
    have: they are never among the nearest."""
    at = np.argsort(cid, kind="stable")
    same = np.unique(np.ascontiguousarray(C[at] + 0.0).view(np.dtype((np.void, C.shape[1] * C.itemsize))).ravel(), return_inverse=True)[1].ravel()
    order = np.argsort(same, kind="stable")
    group, ids = same[order], cid[at][order]
    new = np.r_[True, (group[1:] != group[:-1]) | (ids[1:] != ids[:-1])]
    nth = np.cumsum(new)  # distinct (vector, id) so far; copies of an id share a number
    first = nth[np.searchsorted(group, group, "left")]
    return at[np.sort(order[nth - first < keep])]


class _TopK:
    """The k nearest corpus rows so far of every query.  One matrix product in
    float32 gives for each pair a value g that falls with the distance, which is
    a - 2 g up to rounding; only pairs within the rounding bound of a query's
    k-th best get their exact distance."""

    def __init__(self, qid: np.ndarray, Q: np.ndarray, k: int, metric: str, exclude_self: bool):
        self.qid, self.Q, self.k, self.exclude_self, self.cosine = qid, Q, k, exclude_self, metric == "cosine_counts"
        self.n = (Q * Q).sum(1)
        X, self.a = (self._unit(Q, self.n), np.full(len(Q), 2.0)) if self.cosine else (np.c_[Q, np.ones(len(Q))], self.n)
        self.single, self.X = X.astype(np.float32) if self.n.max(initial=0) < LARGE else None, X
        self.distance = np.full((len(Q), k), np.inf)
        self.cid = np.full((len(Q), k), np.iinfo(np.int64).max)

    @staticmethod
    def _unit(x: np.ndarray, n: np.ndarray) -> np.ndarray:
        return x / np.sqrt(np.where(n > 0, n, 1.0))[:, None]

    def add(self, cid: np.ndarray, C: np.ndarray) -> None:
        if not len(cid) or not len(self.Q):
            return
        if C.shape[1] != self.Q.shape[1]:
            raise ValueError(f"query vectors of {self.Q.shape[1]} values, corpus vectors of {C.shape[1]}")
        if len(self.Q) >= DEDUPE_QUERIES and C.shape[1]:
            some = _few_copies(cid, C, self.k + self.exclude_self)
            cid, C = cid[some], C[some]
        m = (C * C).sum(1)
        Y, X = self._unit(C, m) if self.cosine else np.c_[C, -0.5 * m], self.X
        if self.single is not None and m.max() < LARGE:
            X, Y = self.single, Y.astype(np.float32)
        # rounding of a product of so many terms, on both sides of a comparison
        self.rounding = 4 * np.finfo(X.dtype).eps * (C.shape[1] + 8)
        room = np.empty(TILE * TILE, X.dtype)
        for s in range(0, len(self.Q), TILE):
            for t in range(0, len(cid), TILE):
                x, y = X[s:s + TILE], Y[t:t + TILE]
                g = np.matmul(x, y.T, out=room[:len(x) * len(y)].reshape(len(x), len(y)))
                self._tile(slice(s, s + TILE), g, cid[t:t + TILE], C[t:t + TILE], m[t:t + TILE])

    def _tile(self, rows: slice, g: np.ndarray, cid: np.ndarray, C: np.ndarray, m: np.ndarray) -> None:
        qid, Q, n, a, best = self.qid[rows], self.Q[rows], self.n[rows], self.a[rows], self.distance[rows, -1]
        if self.exclude_self:
            order = np.argsort(cid, kind="stable")
            lo, hi = (np.searchsorted(cid[order], qid, side) for side in ("left", "right"))
            for i in np.flatnonzero(hi > lo):
                g[i, order[lo[i]:hi[i]]] = -np.inf
        slack = np.full(len(Q), self.rounding) if self.cosine else self.rounding * (n + m.max()) + 1e-30
        least = (a - best - slack) / 2
        open_ = np.flatnonzero(np.isinf(best))  # fewer than k rows so far
        if len(open_):
            if len(cid) > self.k:
                kth = len(cid) - self.k
                least[open_] = np.partition(g[open_], kth, axis=1)[:, kth] - slack[open_]
            else:
                least[open_] = -np.inf
        found = np.flatnonzero((g >= np.nextafter(least.astype(g.dtype), g.dtype.type(-np.inf))[:, None]).ravel())
        row, col = np.divmod(found, len(cid))
        near = g.ravel()[found]
        if self.exclude_self:
            there = near > -np.inf
            row, col, near = row[there], col[there], near[there]
        exact = self._exact(Q, C, n, m, row, col, near)
        kth_id = self.cid[rows, -1]
        better = (exact < best[row]) | ((exact == best[row]) & (cid[col] < kth_id[row]))
        row, col, exact = row[better], col[better], exact[better]
        if not len(row):
            return
        touched = np.unique(row)
        row = np.r_[np.repeat(touched, self.k), row]
        exact = np.r_[self.distance[rows][touched].ravel(), exact]
        ids = np.r_[self.cid[rows][touched].ravel(), cid[col]]
        order = np.lexsort((ids, exact, row))
        row, exact, ids = row[order], exact[order], ids[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row, "left") < self.k
        at = rows.start + touched
        self.distance[at], self.cid[at] = exact[keep].reshape(-1, self.k), ids[keep].reshape(-1, self.k)

    def _exact(self, Q, C, n, m, row, col, near) -> np.ndarray:
        if not self.cosine:
            out = np.zeros(len(row))
            for j in range(Q.shape[1]):  # left fold in index order
                t = Q[row, j] - C[col, j]
                out += t * t
            return out
        den = np.sqrt(n[row] * m[col])
        if den.max(initial=0) * self.rounding < 0.25:
            dots = np.rint(near.astype(np.float64) * den)  # whole numbers, off by less than a half
        else:
            dots = np.concatenate([np.zeros(0), *((Q[row[i:i + BLOCK_ROWS]] * C[col[i:i + BLOCK_ROWS]]).sum(1) for i in range(0, len(row), BLOCK_ROWS))])
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(den > 0, 2.0 - 2.0 * dots / den, 2.0)

    def hits(self, asked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, corpus id, distance); ``asked`` lists for every query id the
        row of its vector."""
        rows = np.arange(len(self.Q)) if asked is None else asked
        at, nth = np.nonzero(np.isfinite(self.distance[rows]))
        return at, self.cid[rows[at], nth], self.distance[rows[at], nth]


def _hit_batch(qid: np.ndarray, cid: np.ndarray, distance: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(qid, pa.int64()), pa.array(cid, pa.int64()), pa.array(distance, pa.float64())], names=["qid", "cid", "distance"])


def _stream_topk(qid: np.ndarray, Q: np.ndarray, k: int, metric: str, exclude_self: bool, c_embed: Callable | None = None):
    """Per-partition running top-k of every broadcast query over the corpus
    rows of the partition.  Queries with equal vectors ask once.  Rows that
    ``c_embed`` makes vectors of do so a few at a time."""
    asked, one = np.arange(len(Q)), np.arange(len(Q))
    if not exclude_self and len(Q) and Q.shape[1]:
        one, asked = np.unique(Q + 0.0, axis=0, return_index=True, return_inverse=True)[1:]
        asked = asked.ravel()
    vectors = Q[one]

    def run(batches):
        top = _TopK(qid[one], vectors, k, metric, exclude_self)
        for batch in batches:
            if batch.num_rows and c_embed is None:
                top.add(batch.column(0).to_numpy(zero_copy_only=False), _vectors(pa.chunked_array([batch.column(1)])))
            for s in range(0, batch.num_rows if c_embed else 0, COUNTED_ROWS):
                some = batch.slice(s, COUNTED_ROWS)
                top.add(some.column(0).to_numpy(zero_copy_only=False), c_embed(some.column(1).to_pylist()).astype(np.float64))
        at, cid, distance = top.hits(asked)
        yield _hit_batch(qid[at], cid, distance)
    return run


def _block_topk(k: int, metric: str, exclude_self: bool):
    """One block of queries against one block of the corpus."""
    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return pa.Table.from_batches([_hit_batch([], [], [])])
        qid = q.column("qid").to_numpy()
        top = _TopK(qid, _vectors(q.column("v")), k, metric, exclude_self)
        top.add(c.column("cid").to_numpy(), _vectors(c.column("v")))
        at, cid, distance = top.hits()
        return pa.Table.from_batches([_hit_batch(qid[at], cid, distance)])
    return run


def knn_join(queries: DataFrame, corpus: DataFrame, k: int, *, q_id: str, q_vec: str, c_id: str, c_vec: str,
             metric: str = "sq_l2", exclude_self: bool = False, block_rows: int | None = None,
             q_bucket: Column | None = None, c_bucket: Column | None = None, q_probe: Column | None = None,
             min_groups: int | None = None, broadcast_queries: int = BROADCAST_QUERIES, c_embed: Callable | None = None) -> DataFrame:
    """Top-``k`` corpus rows per query: ``query_id, rk, chunk_id, distance,
    relevance`` (rk 1 = nearest; distance = squared L2, or 2 - 2 cos for
    ``metric='cosine_counts'`` on integer count vectors).

    ``q_bucket``/``c_bucket`` restrict candidates to equal buckets (an
    array ``c_bucket`` puts a corpus row in several buckets, e.g. one per
    hash table); ``q_probe`` (an array column) lets one query look in
    several buckets.  Rows without a vector, or with a null, NaN or infinite
    component, take no part on either side.

    With ``c_embed`` (without buckets only) the corpus has texts as bytes in
    place of vectors: the function makes the count vectors of a list of them.
    Few queries meet them in the task that makes them."""
    spark = queries.sparkSession
    queries, corpus = usable(queries, q_vec), corpus if c_embed else usable(corpus, c_vec)
    groups = min_groups or 2 * spark.sparkContext.defaultParallelism
    if q_bucket is None and c_bucket is None and q_probe is None:
        q = queries.select(F.col(q_id).cast("long").alias("qid"), F.col(q_vec).alias("v"))
        c = corpus.select(F.col(c_id).cast("long").alias("cid"), F.col(c_vec).alias("v"))
        if _small_query_side(q, "v", broadcast_queries, BROADCAST_QUERY_BYTES):
            return _merge_top(_streamed(q, c, k, metric, exclude_self, c_embed), k)
        if c_embed:
            c = c.withColumn("v", count_texts(c_embed)("v"))
        if exclude_self:  # equal vectors do not have equal neighbours: each leaves itself out
            return _merge_top(_blocked(q, c, k, metric, True, block_rows or BLOCK_ROWS, groups), k)
        return _merge_top(_asked_once(q, c, k, metric, block_rows or BLOCK_ROWS, groups, broadcast_queries), k)
    block_rows = block_rows or BUCKET_BLOCK_ROWS
    q = queries.select(F.col(q_id).cast("long").alias("qid"), F.col(q_vec).alias("v"),
                       (q_probe if q_probe is not None else
                        F.array(q_bucket if q_bucket is not None else F.lit(0))).alias("bs"))
    q = q.withColumn("b", F.explode("bs")).drop("bs")
    c = corpus.select(F.col(c_id).cast("long").alias("cid"), F.col(c_vec).alias("v"),
                      (c_bucket if c_bucket is not None else F.lit(0)).alias("b"))
    if isinstance(c.schema["b"].dataType, T.ArrayType):
        c = c.withColumn("b", F.explode("b"))
    # per-bucket sizes of both sides, joined: blocks of at most ``block_rows``
    sizes = (q.select("b", F.lit(1).alias("_q")).unionByName(c.select("b", F.lit(0).alias("_q")))
             .groupBy("b").agg(F.sum("_q").alias("nq"), F.sum(F.lit(1) - F.col("_q")).alias("nc")).filter("nq > 0 AND nc > 0"))
    # written once: read twice below, and the keys of both sides are costly
    path = new_scratch_path(spark, "bucket-sizes")
    sizes.write.parquet(path)
    sizes = spark.read.schema(sizes.schema).parquet(path)
    blocks = sizes.select("b", "nq", "nc", F.ceil(F.col("nq") / block_rows).alias("qb"), F.ceil(F.col("nc") / block_rows).alias("cb"))
    def dealt(side: DataFrame, key: str, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        """A row is in one block of its side and meets all of the other's."""
        return (side.join(blocks.select("b", "qb", "cb"), "b").withColumn(own, F.pmod(F.xxhash64(key), F.col(own_n)))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_n) - 1))).drop("qb", "cb"))
    q2, c2 = dealt(q, "qid", "qs", "qb", "cs", "cb"), dealt(c, "cid", "cs", "cb", "qs", "qb")
    # a cell holds at most two blocks; small cells share a pack of some
    # PACK_ROWS rows, as every group of a cogroup costs a fixed time
    rows, cells = blocks.agg(F.sum(F.col("cb") * F.col("nq") + F.col("qb") * F.col("nc")), F.sum(F.col("qb") * F.col("cb"))).first()
    packs = max(1, min(cells or 0, max(-(-(rows or 0) // PACK_ROWS), groups)))
    pack = F.pmod(F.xxhash64("b", "qs", "cs"), F.lit(packs)).alias("pack")
    part = (q2.groupBy(pack).cogroup(c2.groupBy(pack))
            .applyInArrow(_pack_topk(k, metric, exclude_self), OUT_SCHEMA))
    return _merge_top(part, k, repeats=q_probe is not None)


def _merge_top(part: DataFrame, k: int, repeats: bool = False) -> DataFrame:
    """Merge per-block / per-task winners: a window group limit (partial
    before the shuffle) keeps the k best (distance, cid) per query.  With
    ``repeats`` (a query that probes several buckets can meet a corpus row
    twice) equal pairs share a rank and one stays, in the same partitions."""
    w = Window.partitionBy("qid").orderBy("distance", "cid")
    top = part.withColumn("rk", (F.dense_rank() if repeats else F.row_number()).over(w)).filter(F.col("rk") <= k)
    if repeats:
        top = top.dropDuplicates(["qid", "cid"])
    return top.select(F.col("qid").alias("query_id"), "rk", F.col("cid").alias("chunk_id"), "distance",
                      relevance(F.col("distance")).alias("relevance"))


def _streamed(queries: DataFrame, corpus: DataFrame, k: int, metric: str, exclude_self: bool, c_embed: Callable | None = None) -> DataFrame:
    """Broadcast-query plan: the (size-checked) query vectors are collected
    once and shipped with the task closure (PySpark broadcasts a large
    closure); the corpus is scanned once, unshuffled."""
    rows = queries.toArrow()
    if not rows.num_rows:
        return corpus.sparkSession.createDataFrame([], OUT_SCHEMA)
    if rows.column("qid").null_count:
        raise ValueError("a query has no id")
    qid, Q = rows.column("qid").to_numpy(), _vectors(rows.column("v"))
    # every task emits k rows per query, so neighbouring corpus splits share a
    # task: the merge reads queries x k x TASKS_PER_CORE x cores rows whatever
    # the corpus size.  Nothing is shuffled, and fewer splits stay as they are.
    tasks = TASKS_PER_CORE * corpus.sparkSession.sparkContext.defaultParallelism
    return corpus.coalesce(tasks).mapInArrow(_stream_topk(qid, Q, k, metric, exclude_self, c_embed), OUT_SCHEMA)


def _blocked(queries: DataFrame, corpus: DataFrame, k: int, metric: str, exclude_self: bool, block_rows: int, groups: int) -> DataFrame:
    """Every block of queries meets every block of the corpus."""
    sizes = {r.side: r for r in queries.select(F.lit(0).alias("side"), F.size("v").alias("d")).unionByName(corpus.select(F.lit(1).alias("side"), F.size("v").alias("d")))
             .groupBy("side").agg(F.count("*").alias("n"), F.max("d").alias("d")).collect()}  # two rows
    if len(sizes) < 2:
        return queries.sparkSession.createDataFrame([], OUT_SCHEMA)
    rows = max(1, min(block_rows, SIDE_BYTES // (8 * max(sizes[0].d, sizes[1].d, 1))))
    even = int(np.ceil(np.sqrt(groups)))
    qb, cb = (max(-(-r.n // rows), min(even, -(-r.n // 64))) for r in (sizes[0], sizes[1]))
    cb = max(cb, min(-(-groups // qb), -(-sizes[1].n // 64)))
    qb = max(qb, min(-(-groups // cb), -(-sizes[0].n // 64)))

    def dealt(side: DataFrame, key: str, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        """A row is in one block of its side and meets all of the other's."""
        return side.select("*", F.pmod(F.xxhash64(key), F.lit(own_n)).alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_n - 1).cast("long"))).alias(other))
    q, c = dealt(queries, "qid", "qs", qb, "cs", cb), dealt(corpus, "cid", "cs", cb, "qs", qb)
    return q.groupBy("qs", "cs").cogroup(c.groupBy("qs", "cs")).applyInArrow(_block_topk(k, metric, exclude_self), OUT_SCHEMA)


def _asked_once(queries: DataFrame, corpus: DataFrame, k: int, metric: str, block_rows: int, groups: int, broadcast_queries: int) -> DataFrame:
    """Each distinct query vector asks once; its hits go to all its rows."""
    spark, keyed = queries.sparkSession, queries.withColumn("h", F.xxhash64("v"))
    path = new_scratch_path(spark, "knn-vectors")
    keyed.select("h", "v").distinct().withColumn("rep", F.monotonically_increasing_id()).write.parquet(path)
    distinct = spark.read.schema("h long, v " + queries.schema["v"].dataType.simpleString() + ", rep long").parquet(path)
    asked = distinct.select(F.col("rep").alias("qid"), "v")
    few = _small_query_side(asked, "v", broadcast_queries, BROADCAST_QUERY_BYTES)
    found = _streamed(asked, corpus, k, metric, False) if few else _blocked(asked, corpus, k, metric, False, block_rows, groups)
    top = Window.partitionBy("qid").orderBy("distance", "cid")
    found = found.withColumn("rk", F.row_number().over(top)).filter(F.col("rk") <= k).select(F.col("qid").alias("rep"), "cid", "distance")
    side = F.broadcast if few else (lambda df: df)  # at most ``broadcast_queries`` vectors and k hits of each
    return keyed.join(side(distinct), ["h", "v"]).select("qid", "rep").join(side(found), "rep").select("qid", "cid", "distance")


def knn_single(query_vec: Column, corpus: DataFrame, k: int, *, c_id: str, c_vec: str,
               distance: Column) -> DataFrame:
    """Top-k for one query: a distributed ``orderBy().limit()`` (each
    partition keeps k rows, the driver merges k * partitions)."""
    return (corpus.select(F.col(c_id).alias("chunk_id"), distance.alias("distance"))
            .orderBy("distance", "chunk_id").limit(k))


def best_hits(hits: DataFrame) -> DataFrame:
    """Best hit per query (rank 1)."""
    return hits.filter(F.col("rk") == 1)


def threshold(hits: DataFrame, min_relevance: float, on_low: str = "drop") -> DataFrame:
    """Keep all hits of queries whose best relevance reaches the threshold
    (``on_low='drop'``), or keep everything with a ``low_confidence`` flag
    (``on_low='flag'``).  Only the best hit is tested."""
    best = F.max("relevance").over(Window.partitionBy("query_id"))
    j = hits.filter("query_id IS NOT NULL").withColumn("best_relevance", best)
    if on_low == "drop":
        return j.filter(F.col("best_relevance") >= min_relevance).drop("best_relevance")
    return j.withColumn("low_confidence", F.col("best_relevance") < min_relevance).drop("best_relevance")
