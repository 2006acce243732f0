"""Nearest neighbours by stable projections (small index, verified).

Vectors are lengthened by one component that turns the largest inner product
into the smallest Euclidean distance, and projected to a few dimensions with
Gaussian (2-stable) weights.  The projections of each corpus block are indexed
by a kd-tree; each query verifies its nearest leaves and then goes outwards in
shells of projected distance, verifying vectors by their exact product as long
as a chi-square test allows: a vector as near as the k-th found so far would,
with probability ``CONFIDENCE``, have a nearer projection than one that the
test refuses.  It refuses leaves by their box and single vectors of the others,
whose projected distances to a group of neighbouring queries are one matrix
product.  Blocks give k rows per query; a final ranking merges them.

The larger a block, the nearer its k-th and the smaller the share that a query
verifies; so blocks are as large as ``BLOCK_BYTES`` lets them be.

Every row is indexed.  Equal vectors are indexed once per block and carry
their smallest k + 1 ids, which is all that any list of k can hold.

Defined results: null, zero, non-finite and null-holding vectors take no part,
nor do vectors whose length differs from the most frequent one (ties: the
shorter); a row's own id is never its neighbour; ties go to the smaller
vec_id; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import pick

K = 20
DIMENSIONS, LEAF, CONFIDENCE = 48, 64, 0.93
BLOCK_BYTES, QUERY_ROWS = 100_000_000, 2_048  # arrays of an index block; queries searched together
FIRST_LEAVES, GROUP, TAKE = 4, 64, 1_024  # leaves verified before the first test; queries projected together; vectors verified at once
SHELLS = (0.4, 0.55, 0.75, 1.0)  # of the largest projected distance that the test allows
SEED = 11


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part; v is double."""
    d = pick(vectors, "vec_id", "embedding").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    good = (~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))) & F.exists("v", lambda x: x != 0)
    d = d.filter("vec_id IS NOT NULL AND v IS NOT NULL").filter(good)
    size = d.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return d.filter(F.size("v") == (size.n if size else 0))


def chi_square_quantile(p: float, m: int) -> float:
    """Quantile of the chi-square distribution with an even number of degrees
    of freedom, whose tail is exp(-x/2) * sum (x/2)^i / i!."""
    half, lo, hi = m // 2, 0.0, 1000.0
    for _ in range(200):
        x = (lo + hi) / 4
        term, tail = 1.0, 1.0
        for i in range(1, half):
            term *= x / i
            tail += term
        lo, hi = (2 * x, hi) if np.exp(-x) * tail > 1 - p else (lo, 2 * x)
    return hi


class Tree:
    """kd-tree over projections: equally filled leaves with bounding boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        depth = max(0, int(np.ceil(np.log2(max(1, len(points)) / leaf))))
        parts = [np.arange(len(points))]
        for _ in range(depth):
            split = []
            for p in parts:
                axis = int(np.ptp(points[p], axis=0).argmax())
                order = p[np.argpartition(points[p, axis], len(p) // 2)]
                split += [order[:len(p) // 2], order[len(p) // 2:]]
            parts = split
        self.low = np.array([points[p].min(axis=0) for p in parts])
        self.high = np.array([points[p].max(axis=0) for p in parts])
        width = max(map(len, parts))
        self.rows = np.array([np.concatenate([p, np.full(width - len(p), -1)]) for p in parts])

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of each query to each leaf's box."""
        out = np.zeros((len(q), len(self.low)))
        for axis in range(q.shape[1]):
            x = q[:, axis, None]
            out += np.maximum(np.maximum(self.low[:, axis] - x, x - self.high[:, axis]), 0) ** 2
        return out


def _top(score: np.ndarray, row: np.ndarray, order_id: np.ndarray, k: int):
    """The best k by (score, smaller id)."""
    order = np.lexsort((order_id[row], -score))[:k]
    return score[order], row[order]


def search(x: np.ndarray, first_id: np.ndarray, q: np.ndarray, top_norm: float, k: int, met: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows of x, scores) for each query, the k best distinct vectors found;
    ``met``, if given, gathers how many vectors each query verified."""
    d = x.shape[1]
    project = np.random.default_rng(SEED).standard_normal((d + 1, DIMENSIONS))
    rest = np.sqrt(np.maximum(top_norm**2 - (x * x).sum(1), 0))
    points = np.column_stack([x, rest]) @ project
    tree = Tree(points)
    # rows by leaf, so that a leaf is a slice
    at, rows = np.concatenate([[0], np.cumsum((tree.rows >= 0).sum(1))]), tree.rows[tree.rows >= 0]
    x, points, first_id = x[rows], points[rows], first_id[rows]
    leaf_of = np.repeat(np.arange(len(tree.rows)), np.diff(at))
    bound = chi_square_quantile(CONFIDENCE, DIMENSIONS)
    slack = 1e-12 * bound * top_norm**2  # rounding of the projected distances
    asked = q @ project[:d]
    near = tree.distances(asked)
    # |p - a|^2 = |p|^2 - 2 a.p + |a|^2; the product of the lengthened rows is this without |a|^2
    far, points = (asked * asked).sum(1), np.column_stack([points, (points * points).sum(1)])
    asked = np.column_stack([-2 * asked, np.ones(len(q))])
    reach = top_norm**2 + (q * q).sum(1)  # squared distance of x: |q|^2 + M^2 - 2 q.x
    n_first = min(len(tree.rows), max(FIRST_LEAVES, -(-2 * k // LEAF)))
    first = np.argpartition(near, n_first - 1, axis=1)[:, :n_first]
    out: list = [None] * len(q)
    verified = np.zeros(len(q), np.int64)
    taken, room = np.empty((TAKE, d)), np.empty(GROUP * len(x))  # reused: fresh pages cost as much as the sums

    def limit(i: int, score: np.ndarray) -> float:
        return bound * max(reach[i] - 2 * score[-1], 0) + slack if len(score) == k else np.inf

    def verify(i: int, some: np.ndarray, score: np.ndarray, row: np.ndarray):
        verified[i] += len(some)
        s = np.empty(len(some))
        for j in range(0, len(some), TAKE):
            part = some[j:j + TAKE]
            np.einsum("nd,d->n", np.take(x, part, axis=0, out=taken[:len(part)], mode="clip"), q[i], out=s[j:j + TAKE])
        if len(score) == k:
            good = s >= score[-1]
            s, some = s[good], some[good]
        return _top(np.concatenate([score, s]), np.concatenate([row, some]), first_id, k) if len(s) else (score, row)

    turn = np.argsort(near.argmin(axis=1), kind="stable")  # queries of one region together
    for group in np.split(turn, range(GROUP, len(turn), GROUP)):
        best = [verify(i, np.concatenate([np.arange(at[leaf], at[leaf + 1]) for leaf in first[i]]), np.empty(0), np.empty(0, np.int64)) for i in group]
        allowed = near[group] <= np.array([limit(i, score) for i, (score, _) in zip(group, best, strict=True)])[:, None]
        np.put_along_axis(allowed, first[group], True, 1)
        wanted = allowed.any(axis=0)
        slot, cols = np.concatenate([[0], np.cumsum(np.diff(at) * wanted)]), np.flatnonzero(wanted[leaf_of])
        seen = points if len(cols) == len(x) else points[cols]
        gaps = np.matmul(asked[group], seen.T, out=room[:len(group) * len(cols)].reshape(len(group), -1))
        for i, gap, (score, row) in zip(group, gaps, best, strict=True):
            for leaf in first[i]:
                gap[slot[leaf]:slot[leaf + 1]] = np.nan  # done
            # shells of growing projected distance; the limit shrinks from one to the next
            for share in SHELLS:
                some = np.flatnonzero(gap <= share * limit(i, score) - far[i])
                gap[some] = np.nan
                score, row = verify(i, cols[some], score, row)
            out[i] = rows[row], score
    if met is not None:
        met.extend(verified.tolist())
    return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    c = column.combine_chunks()
    return np.ascontiguousarray(c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1))


def _search_cell(top_norm: float, k: int):
    def run(corpus: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not corpus.num_rows or not queries.num_rows:
            return empty
        x, ids = _matrix(corpus.column("v")), corpus.column("ids").to_pylist()
        q, own = _matrix(queries.column("v")), queries.column("vec_id").to_pylist()
        first = np.array([i[0] for i in ids])
        out: tuple[list, list, list] = ([], [], [])
        # one distinct vector more than k: the query's own may be among them
        for query, (rows, scores) in zip(own, search(x, first, q, top_norm, k + 1), strict=True):
            found = sorted((-s, i) for r, s in zip(rows.tolist(), scores.tolist(), strict=True) for i in ids[r] if i != query)[:k]
            out[0].extend([query] * len(found))
            out[1].extend(i for _, i in found)
            out[2].extend(-s for s, _ in found)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})
    return run


def nearest(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k largest inner products
    found.  ``is_query``: Column over vec_id."""
    rows = usable(vectors)
    # equal vectors: the k + 1 smallest ids (ranks cut per task before the shuffle)
    ranked = rows.distinct().withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    distinct = ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    queries = rows.filter(is_query).distinct()
    facts = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"),
                     F.max(F.size("v")).alias("width"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("norm")).first()
    block_rows = BLOCK_BYTES // (8 * ((facts.width or 0) + DIMENSIONS + GROUP)) or 1  # vector, projection, distances to a group
    blocks, chunks = max(1, -(-facts.n // block_rows)), max(1, -(-facts.q // QUERY_ROWS))
    corpus = distinct.select("v", "ids", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(blocks)).alias("block"), F.explode(F.expr(f"sequence(0, {chunks - 1})")).alias("chunk"))
    asked = queries.select("vec_id", "v", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"))
    found = corpus.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(
        _search_cell(float(facts.norm or 0), k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
