"""Hard negatives by integer inner products in a residue number system.

Vectors become whole numbers, floor(scale * x).  A block of scores is the
product of two integer matrices: both are reduced modulo a few primes below
1024 (residues centred on zero), each pair of residue matrices is multiplied
in float32, where every partial sum stays below 2^24 and is therefore exact,
and the signed scores are put together by Chinese remaindering.  The number of
primes follows from the largest norm of the data.

Anchors are dealt into blocks and so is the table; a cell holds one block of
each side, so no task holds more than two blocks and one strip of scores,
whatever the size.  The first pass keeps the best positives of every anchor
in each cell, the second the best rows of each positive's score window; window
functions over these few rows pick the final ones.

Defined results: rows without vec_id or label, without a vector, or with a
null or non-finite component take no part; a shorter vector counts as padded
with zeros; rows that repeat whole count once; rows that share the anchor's
vec_id are not its partners; ties go to the smaller vec_id; an anchor without
positives, or a positive without rows in its window, gives no rows; an empty
table gives none; extra columns are ignored, whatever their names.  Scores
beyond 2^55 are refused.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, pick, released

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 5, 80, 100  # windows: LOW to HIGH per cent of the positive's score
BLOCK_ROWS, STRIP_ROWS, LEAST_ROWS = 16_384, 256, 1_024
TOP_PRIME, LARGEST = 1024, 1 << 55


@cache
def primes(bound: int) -> tuple[int, ...]:
    """The largest primes below TOP_PRIME whose product exceeds 2 * bound."""
    found, product = [], 1
    for p in range(TOP_PRIME - 1, 2, -2):
        if all(p % d for d in range(3, int(p ** 0.5) + 1, 2)):
            found.append(p)
            product *= p
            if product > 2 * bound:
                return tuple(found)
    raise ValueError(f"no primes for scores up to {bound}")


def residue_product(a: np.ndarray, b: np.ndarray, moduli: tuple[int, ...]) -> np.ndarray:
    """a @ b.T of whole-number matrices, exact while its values stay below
    half the product of the moduli."""
    total, whole = None, 1
    for p in moduli:
        half = p // 2
        x, y = (((m + half) % p - half).astype(np.float32) for m in (a, b))
        wide = max(1, (1 << 24) // (half * half))  # columns whose products sum exactly in float32
        r = np.zeros((len(a), len(b)), np.int64)
        for at in range(0, a.shape[1], wide):
            r += (x[:, at:at + wide] @ y[:, at:at + wide].T).astype(np.int64)
        r %= p
        # next digit of the mixed-radix form: exact in 64 bits
        total = r if total is None else total + ((r - total) % p * pow(whole, -1, p) % p) * whole
        whole *= p
    return np.where(total > whole // 2, total - whole, total)


def quantised(vectors: DataFrame, label: Column | None = None, scale: int = SCALE) -> DataFrame:
    """The rows that take part: vec_id, label, q (whole numbers as doubles)."""
    d = pick(vectors, "vec_id", "label", "embedding")
    d = d.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    x = F.transform("embedding", lambda c: c.cast("double"))
    d = d.filter(~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    return d.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"),
                    F.transform(x, lambda c: F.floor(c * scale).cast("double")).alias("q")).distinct()


def _matrix(t: pa.Table, dim: int) -> np.ndarray:
    v = t.column("q").combine_chunks()
    sizes = np.diff(v.offsets.to_numpy())
    out = np.zeros((len(v), dim), np.int64)
    out[np.arange(dim)[None, :] < sizes[:, None]] = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return out


def _best(row: np.ndarray, score: np.ndarray, other: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best (score, then smaller id) entries of every row."""
    order = np.lexsort((other, -score, row))
    at = row[order]
    return order[np.arange(len(at)) - np.searchsorted(at, at, "left") < k]


def _strips(anchors: pa.Table, rows: pa.Table, dim: int, moduli):
    """Scores of STRIP_ROWS anchors at a time: (anchors' positions, scores,
    same label, rows that are partners)."""
    A, C = _matrix(anchors, dim), _matrix(rows, dim)
    ids, own = rows.column("vec_id").to_numpy(), anchors.column("vec_id").to_numpy()
    label, mine = rows.column("label").to_numpy(), anchors.column("label").to_numpy()
    for at in range(0, len(A), STRIP_ROWS):
        part = np.arange(at, min(at + STRIP_ROWS, len(A)))
        yield part, residue_product(A[part], C, moduli), mine[part][:, None] == label[None, :], own[part][:, None] != ids[None, :]


def _positives(dim: int, moduli, k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        if anchors.num_rows and rows.num_rows:
            ids = rows.column("vec_id").to_numpy()
            for part, score, same, other in _strips(anchors, rows, dim, moduli):
                usable = np.where(same & other, score, -LARGEST * 2)
                kth = min(k, len(ids))
                edge = np.partition(usable, len(ids) - kth, axis=1)[:, len(ids) - kth]
                r, c = np.nonzero((usable >= edge[:, None]) & same & other)
                keep = _best(r, score[r, c], ids[c], k)
                found.append((part[r[keep]], ids[c[keep]], score[r[keep], c[keep]]))
        row, positive, score = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), (), ())))
        own = anchors.select(["vec_id", "row"]).take(pa.array(row, pa.int64()))
        return pa.table([own.column(0), own.column(1), pa.array(positive, pa.int64()), pa.array(score, pa.int64())], names=["anchor_id", "row", "positive_id", "positive_score"])
    return run


def _negatives(dim: int, moduli, k: int, low: int, high: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        if anchors.num_rows and rows.num_rows:
            ids, lists = rows.column("vec_id").to_numpy(), anchors.column("scores").combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            wanted = np.full((len(sizes), int(sizes.max())), -LARGEST * 2)  # positives' scores, one column each
            has = np.arange(wanted.shape[1])[None, :] < sizes[:, None]
            wanted[has] = lists.flatten().to_numpy(zero_copy_only=False)
            for part, score, same, other in _strips(anchors, rows, dim, moduli):
                for j in range(wanted.shape[1]):
                    p = wanted[part, j][:, None]
                    r, c = np.nonzero(has[part, j][:, None] & ~same & other & (low * p <= 100 * score) & (100 * score <= high * p))
                    keep = _best(r, score[r, c], ids[c], k)
                    found.append((part[r[keep]], np.full(len(keep), j), ids[c[keep]], score[r[keep], c[keep]]))
        row, j, negative, score = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), (), (), ())))
        own = anchors.select(["vec_id", "row"]).take(pa.array(row, pa.int64()))
        return pa.table([own.column(0), own.column(1), *(pa.array(x, pa.int64()) for x in (j, negative, score))],
                        names=["anchor_id", "row", "j", "negative_id", "negative_score"])
    return run


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    per anchor and each of its best ``positives``, the best ``negatives`` of
    another label whose score lies between ``low`` and ``high`` per cent of the
    positive's.  ``is_anchor`` may use vec_id and label, ``label`` replaces the
    label column."""
    rows = materialize(quantised(vectors, label, scale).withColumn("row", F.xxhash64("vec_id", "label", "q")), "quantised-vectors")
    norm = F.aggregate("q", F.lit(0.0), lambda s, x: s + x * x)
    facts = rows.agg(F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("anchors"), F.max(norm).alias("norm"), F.max(F.size("q")).alias("dim")).first()
    if (facts.norm or 0) > LARGEST:
        raise ValueError(f"scores up to {facts.norm:g} do not fit; scale the vectors down")
    bound, dim, cores = int((facts.norm or 0) * 1.01) + 1, max(facts.dim or 0, 1), rows.sparkSession.sparkContext.defaultParallelism
    moduli = primes(bound)
    cb = max(1, -(-facts.n // BLOCK_ROWS), min(2 * cores, -(-facts.n // LEAST_ROWS)))
    ab = max(1, -(-facts.anchors // BLOCK_ROWS))

    def dealt(side: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return side.withColumn(own, F.pmod("row", F.lit(n))).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))))

    table = dealt(rows, "c", cb, "a", ab)

    def cells(anchors: DataFrame, run, schema: str) -> DataFrame:
        side = dealt(anchors, "a", ab, "c", cb)
        side = side.toDF(*side.columns)  # columns of its own, apart from the table's
        return side.groupBy("a", "c").cogroup(table.groupBy("a", "c")).applyInArrow(run, schema)

    def best(found: DataFrame, by: list[str], score: str, other: str, k: int) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(F.desc(score), other)
        return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    anchors = rows.filter(is_anchor)
    near = best(cells(anchors, _positives(dim, moduli, positives), "anchor_id long, row long, positive_id long, positive_score long"),
                ["anchor_id", "row"], "positive_score", "positive_id", positives)
    per_anchor = materialize(near.groupBy("anchor_id", "row").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("p")), "positives")
    asked = anchors.join(per_anchor.select(F.col("anchor_id").alias("vec_id"), "row", F.col("p.positive_score").alias("scores")), ["vec_id", "row"])
    hard = best(cells(asked, _negatives(dim, moduli, negatives, low, high), "anchor_id long, row long, j long, negative_id long, negative_score long"),
                ["anchor_id", "row", "j"], "negative_score", "negative_id", negatives)
    positive = F.col("p")[F.col("j").cast("int")]
    return hard.join(per_anchor, ["anchor_id", "row"]).select("anchor_id", positive["positive_id"].alias("positive_id"), "rank", "negative_id",
                                                             positive["positive_score"].alias("positive_score"), "negative_score")


SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
     s AS (SELECT a.vec_id AS anchor_id, v.vec_id AS other_id, a.label = v.label AS same, list_inner_product(a.q, v.q)::BIGINT AS score
           FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
     p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place FROM s WHERE same) WHERE place <= 5),
     n AS (SELECT p.anchor_id, p.other_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
                  s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
           FROM p JOIN s ON p.anchor_id = s.anchor_id WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT * FROM n WHERE rank <= 5
"""
