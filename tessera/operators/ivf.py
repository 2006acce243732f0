"""Inverted-file vector search: the corpus laid out by the cells of a k-means,
each query compared with the cells whose centroids are nearest to it.

Build.  Centroids come from Lloyd rounds over a bounded sample (SAMPLE_ROWS
rows a cell, chosen by hash); every corpus row is then assigned to its nearest
centroid, one matrix product per Arrow batch, and written in packs: runs of
neighbouring cells with about PACK_ROWS rows.  A cell with more rows is dealt
over several packs by the hash of its ids, so a vector that a third of the rows
share is never one task's.  The centroids and the pack table (one row a cell,
at most MAX_CELLS) are written beside the rows.

Search.  A query names its ``probes`` nearest cells and is sent once to every
pack that holds one of them, however many of the pack's cells it probes: first
to the packs of its nearest cell, then, with the k-th distance found there, to
the others, which answer only with rows within it.  Packs and queries meet in a cogroup whose sides are both bounded (a pack that more
than QUERY_ROWS queries probe is copied for each such block of queries).  Each
cell is compared by matrix products in float32; only pairs within the rounding
bound of a query's k-th best get their exact distance, summed as in
``knn_join``, and a window group limit merges the packs' winners.

How many cells to probe is measured, not guessed: ``probes_for`` searches a
bounded sample of the queries exactly and takes the fewest cells that hold
``floor`` of the true neighbours, with two hundredths to spare.

Rows without a usable vector (``knn.usable``) are not indexed and ask nothing.
"""

from __future__ import annotations

import json
import os
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import new_scratch_path
from .knn import OUT_SCHEMA, _frame, _merge_top, _vectors, knn_join, usable

SAMPLE_ROWS, ROUNDS = 64, 6  # rows a cell that train the centroids, Lloyd rounds
MAX_CELLS = 1 << 15
PACK_ROWS, QUERY_ROWS = 4_096, 32_768
TILE_ROWS = 2_048  # queries compared with a cell at once
ASKED = 500  # queries searched exactly to choose the probes


class Index(NamedTuple):
    """``rows``: pack, cell, cid, v.  ``centroids``: a matrix.  ``counts``,
    ``first``, ``splits``: per cell its rows, its first pack and in how many
    packs it lies."""
    rows: DataFrame
    centroids: np.ndarray
    counts: np.ndarray
    first: np.ndarray
    splits: np.ndarray


def cells_for(rows: int) -> int:
    """About twice the square root of the rows: assigning a row and reading a
    probed cell then cost alike."""
    return int(min(MAX_CELLS, max(1, 2 * round(max(rows, 1) ** 0.5))))


def _squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances up to a constant of the row: enough to rank centroids."""
    return (centroids * centroids).sum(1)[None, :] - 2.0 * (x @ centroids.T)


def _tiles(batches, column: int, rows: int = 4096):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, _vectors(pa.chunked_array([part.column(column)]), "sq_l2")


def _partial_means(centroids: np.ndarray):
    def run(batches):
        total, n = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for _, x in _tiles(batches, 0):
            cell = _squared(x, centroids).argmin(1)
            np.add.at(total, cell, x)
            n += np.bincount(cell, minlength=len(centroids))
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(n[held], pa.int64()), pa.array(list(total[held]), pa.list_(pa.float64()))],
                                         names=["cell", "n", "total"])
    return run


def _sum_means(group: pa.Table) -> pa.Table:
    total = _vectors(group.column("total"), "sq_l2").sum(0)
    return pa.table({"cell": group.column("cell").slice(0, 1), "n": pa.array([pc.sum(group.column("n")).as_py()], pa.int64()),
                     "total": pa.array([total], pa.list_(pa.float64()))})


def train(vectors: DataFrame, n_rows: int, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids (at most ``cells``) of the vectors in column ``v``; ``id``
    orders the sample.  A cell that loses all its rows keeps its centroid."""
    spark = vectors.sparkSession
    share = min(1.0, 1.1 * cells * SAMPLE_ROWS / max(n_rows, 1))
    cut = int(-(1 << 63) + share * ((1 << 64) - 1)) if share < 1 else (1 << 63) - 1
    path = new_scratch_path(spark, "ivf-sample")
    vectors.filter(F.xxhash64("id") <= cut).select("v", "id").write.parquet(path)
    sample = spark.read.parquet(path)
    start = sample.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(cells).collect()  # at most MAX_CELLS rows
    if not start:
        return np.zeros((0, 0))
    centroids = np.array([list(r.v) for r in start], np.float64)
    for _ in range(rounds):
        parts = sample.select("v").mapInArrow(_partial_means(centroids), "cell int, n long, total array<double>")
        for r in parts.groupBy("cell").applyInArrow(_sum_means, parts.schema).collect():  # one row a cell
            centroids[r.cell] = np.array(r.total) / r.n
    return centroids


def _order(centroids: np.ndarray) -> np.ndarray:
    """Cells in an order that keeps near centroids together: halves by the
    direction of the widest spread, again and again."""
    out, todo = [], [np.arange(len(centroids))]
    while todo:
        part = todo.pop()
        if len(part) <= 2:
            out.append(part)
            continue
        x = centroids[part] - centroids[part].mean(0)
        axis = np.linalg.svd(x, full_matrices=False)[2][0]
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        by = part[np.argsort(x @ axis, kind="stable")]
        todo += [by[len(by) // 2:], by[:len(by) // 2]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _packs(order: np.ndarray, counts: np.ndarray, pack_rows: int) -> tuple[np.ndarray, np.ndarray]:
    first, splits, pack, held = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), 0, 0
    for cell in order.tolist():
        n = int(counts[cell])
        if n > pack_rows:  # a hot cell: packs of its own
            pack += 1 if held else 0
            first[cell], splits[cell] = pack, -(-n // pack_rows)
            pack, held = pack + int(splits[cell]), 0
            continue
        if held and held + n > pack_rows:
            pack, held = pack + 1, 0
        first[cell], held = pack, held + n
    return first, splits


def _assign(centroids: np.ndarray):
    def run(batches):
        for part, x in _tiles(batches, 1):
            yield pa.RecordBatch.from_arrays([pa.array(_squared(x, centroids).argmin(1), pa.int32()), *part.columns], names=["cell", "cid", "v"])
    return run


def build(corpus: DataFrame, root: str, *, c_id: str, c_vec: str, cells: int | None = None, pack_rows: int = PACK_ROWS) -> Index:
    """Write the index of ``corpus`` under ``root`` (a new folder) and open it."""
    spark = corpus.sparkSession
    d = usable(corpus.select(F.col(c_id).cast("long").alias("id"), F.col(c_vec).alias("v")), "v")
    d = d.select("id", F.transform("v", lambda x: x.cast("double")).alias("v"))
    n = d.count()
    centroids = train(d, n, cells or cells_for(n))
    if len(centroids):
        assigned = d.mapInArrow(_assign(centroids), "cell int, cid long, v array<double>")
    else:
        assigned = d.select(F.lit(0).alias("cell"), F.col("id").alias("cid"), "v")
    staged = os.path.join(root, "assigned")
    assigned.write.mode("error").parquet(staged)
    assigned = spark.read.schema(assigned.schema).parquet(staged)
    counts = np.zeros(max(len(centroids), 1), np.int64)
    for r in assigned.groupBy("cell").count().collect():  # one row a cell
        counts[r.cell] = r["count"]
    order = _order(centroids) if len(centroids) else np.zeros(1, np.int64)
    first, splits = _packs(order, counts, pack_rows)
    table = spark.createDataFrame([(i, [float(x) for x in (centroids[i] if len(centroids) else [])], int(counts[i]), int(first[i]), int(splits[i])) for i in range(len(counts))],
                                  "cell int, centroid array<double>, n long, first long, splits long")
    table.coalesce(1).write.mode("error").parquet(os.path.join(root, "cells"))
    placed = assigned.join(F.broadcast(table.select("cell", "first", "splits")), "cell").select(  # at most MAX_CELLS rows
        (F.col("first") + F.pmod(F.xxhash64("cid"), F.col("splits"))).alias("pack"), "cell", "cid", "v")
    placed.repartitionByRange("pack").sortWithinPartitions("pack", "cell").write.mode("error").parquet(os.path.join(root, "rows"))
    return open_index(spark, root)


def open_index(spark: SparkSession, root: str) -> Index:
    cells = spark.read.parquet(os.path.join(root, "cells")).orderBy("cell").collect()  # at most MAX_CELLS rows
    centroids = np.array([list(r.centroid) for r in cells], np.float64).reshape(len(cells), -1)
    return Index(spark.read.parquet(os.path.join(root, "rows")), centroids, *(np.array([r[c] for r in cells], np.int64) for c in ("n", "first", "splits")))


def _probed(x: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    """The nearest ``probes`` cells of every row (in no order)."""
    d = _squared(x, centroids)
    return np.argpartition(d, probes - 1, axis=1)[:, :probes] if probes < d.shape[1] else np.tile(np.arange(d.shape[1]), (len(x), 1))


def _visits(cells: np.ndarray, index_cells) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, pack, cell) of every probed cell in every pack that holds it."""
    _, first, splits = index_cells
    row, cell = np.repeat(np.arange(len(cells)), cells.shape[1]), cells.ravel()
    times = splits[cell]
    row, cell = np.repeat(row, times), np.repeat(cell, times)
    nth = np.arange(len(cell)) - np.repeat(np.cumsum(times) - times, times)
    return row, first[cell] + nth, cell


def _by_pack(cells: np.ndarray, index_cells) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Visits grouped by (row, pack): their rows and packs, where each group
    begins among the cells, and the cells."""
    row, pack, cell = _visits(cells, index_cells)
    order = np.lexsort((cell, pack, row))
    row, pack, cell = row[order], pack[order], cell[order]
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (pack[1:] != pack[:-1])]) if len(row) else np.zeros(0, np.int64)
    return row[new], pack[new], np.r_[new, len(cell)], cell


def _count_visits(index_cells, centroids, probes):
    def run(batches):
        n: dict[int, int] = {}
        for _, x in _tiles(batches, 1):
            for p, c in zip(*np.unique(_by_pack(_probed(x, centroids, probes), index_cells)[1], return_counts=True)):
                n[int(p)] = n.get(int(p), 0) + int(c)
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int64()), pa.array(list(n.values()), pa.int64())], names=["pack", "n"])
    return run


def _send(index_cells, centroids, probes, blocks: np.ndarray, home: bool):
    """A query's rows for the packs of its nearest cell (``home``) or for all
    other packs that hold one of its cells."""
    _, first, splits = index_cells

    def run(batches):
        for part, x in _tiles(batches, 1, 1024):
            row, pack, at, cell = _by_pack(_probed(x, centroids, probes), index_cells)
            nearest = _squared(x, centroids).argmin(1)[row]
            mine = np.flatnonzero(((pack >= first[nearest]) & (pack < first[nearest] + splits[nearest])) == home)
            sizes = np.diff(at)[mine]
            cell = cell[np.repeat(at[:-1][mine] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
            own, pack = part.take(pa.array(row[mine], pa.int64())), pack[mine]
            block = own.column(0).to_numpy() % blocks[pack]
            yield pa.RecordBatch.from_arrays([pa.array(pack, pa.int64()), pa.array(block, pa.int64()), *own.columns,
                                              pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(cell, pa.int32()))],
                                             names=["pack", "block", "qid", "v", "bound", "cells"])
    return run


class _Best:
    """The k smallest rough distances of every query so far, and the pairs that
    may still belong to the k nearest."""

    def __init__(self, Q: np.ndarray, C: np.ndarray, k: int, bound: np.ndarray):
        qn, cn = (Q * Q).sum(1), (C * C).sum(1)
        kind = np.float32 if max(qn.max(), cn.max()) < 1e30 else np.float64
        self.k, self.best, self.kept = k, np.repeat(bound.astype(kind)[:, None], k, 1), []
        self.Q, self.C, self.qn, self.cn = Q.astype(kind), C.astype(kind), qn.astype(kind), cn.astype(kind)
        # rounding of a product of Q.shape[1] terms and of a bound, both sides of a comparison
        self.slack = (4e-7 * (Q.shape[1] + 8) * (qn + cn.max() + np.where(np.isfinite(bound), bound, 0.0)) + 1e-30).astype(kind)

    def add(self, x: np.ndarray, y: np.ndarray, same: tuple[np.ndarray, np.ndarray] | None) -> None:
        """Compare queries ``x`` with rows ``y``; pairs ``same`` are left out."""
        d = self.Q[x] @ self.C[y].T
        d *= -2.0
        d += self.cn[y][None, :]
        d += self.qn[x][:, None]
        if same is not None:
            d[same] = np.inf
        near = d <= (self.best[x, -1] + self.slack[x])[:, None]
        some = np.flatnonzero(near.any(1))
        if not len(some):
            return
        r, c = np.nonzero(near[some])
        d = d[some]
        self.kept.append((x[some[r]], y[c], d[r, c]))
        top = np.partition(d, self.k - 1, axis=1)[:, :self.k] if d.shape[1] > self.k else d
        self.best[x[some]] = np.partition(np.concatenate([self.best[x[some]], top], 1), self.k - 1, axis=1)[:, :self.k]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.kept:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, col, d = (np.concatenate(t) for t in zip(*self.kept))
        stays = np.isfinite(d) & (d <= self.best[row, -1] + self.slack[row])
        return row[stays], col[stays]


def _compare(k: int, exclude_self: bool):
    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return pa.Table.from_pandas(_frame([]), preserve_index=False)
        Q, C = _vectors(q.column("v"), "sq_l2"), _vectors(c.column("v"), "sq_l2")
        if Q.shape[1] != C.shape[1]:
            raise ValueError(f"query vectors of {Q.shape[1]} values, corpus vectors of {C.shape[1]}")
        qid, cid, own = q.column("qid").to_numpy(), c.column("cid").to_numpy(), c.column("cell").to_numpy()
        lists = q.column("cells").combine_chunks()
        row = np.repeat(np.arange(q.num_rows), np.diff(lists.offsets.to_numpy()))
        cell = lists.flatten().to_numpy(zero_copy_only=False)
        asks, rows = np.argsort(cell, kind="stable"), np.lexsort((cid, own))
        bound = q.column("bound").to_numpy()
        names, best = np.intersect1d(cell, own), _Best(Q, C, k, bound)
        a, b = (np.searchsorted(x, [names, names + 1]) for x in (cell[asks], own[rows]))
        for i in range(len(names)):
            y = rows[b[0][i]:b[1][i]]
            for at in range(a[0][i], a[1][i], TILE_ROWS):
                x, same = row[asks[at:min(at + TILE_ROWS, a[1][i])]], None
                if exclude_self:
                    lo, hi = (np.searchsorted(cid[y], qid[x], side) for side in ("left", "right"))
                    r = np.repeat(np.arange(len(x)), hi - lo)
                    same = r, np.repeat(lo, hi - lo) + np.arange(len(r)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
                best.add(x, y, same)
        r, c = best.pairs()
        exact = np.zeros(len(r))
        for j in range(Q.shape[1]):  # left fold in index order, as in the exact join
            t = Q[r, j] - C[c, j]
            exact = exact + t * t
        order = np.lexsort((cid[c], exact, r))
        order = order[exact[order] <= bound[r[order]]]
        r, c, exact = r[order], c[order], exact[order]
        keep = np.arange(len(r)) - np.searchsorted(r, r, "left") < k
        return pa.table([pa.array(qid[r[keep]], pa.int64()), pa.array(cid[c[keep]], pa.int64()), pa.array(exact[keep])], names=["qid", "cid", "distance"])
    return run


def search(queries: DataFrame, index: Index, k: int, probes: int, *, q_id: str, q_vec: str, exclude_self: bool = False,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """Top ``k`` of the rows in each query's ``probes`` nearest cells, in the
    columns of ``knn_join``; ids of queries are distinct."""
    if not index.counts.sum():
        return queries.sparkSession.createDataFrame([], "query_id long, rk int, chunk_id long, distance double, relevance double")
    q = usable(queries.select(F.col(q_id).cast("long").alias("qid"), F.col(q_vec).alias("v")), "v")
    q = q.select("qid", F.transform("v", lambda x: x.cast("double")).alias("v"))
    probes, cells = max(1, min(probes, len(index.centroids))), (index.counts, index.first, index.splits)
    sizes = np.zeros(int((index.first + index.splits).max()), np.int64)
    for r in q.mapInArrow(_count_visits(cells, index.centroids, probes), "pack long, n long").groupBy("pack").agg(F.sum("n").alias("n")).collect():  # one row a pack
        sizes[r.pack] = r.n
    blocks = np.maximum(1, -(-sizes // query_rows))
    many = index.rows.sparkSession.createDataFrame([(int(p), int(n)) for p, n in enumerate(blocks) if n > 1], "pack long, blocks long")
    rows = index.rows.join(F.broadcast(many), "pack", "left")  # one row a pack at most
    rows = rows.select("pack", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)).alias("block"), "cell", "cid", "v")

    def compared(asked: DataFrame, home: bool) -> DataFrame:
        sent = asked.mapInArrow(_send(cells, index.centroids, probes, blocks, home), "pack long, block long, qid long, v array<double>, bound double, cells array<int>")
        return sent.groupBy("pack", "block").cogroup(rows.groupBy("pack", "block")).applyInArrow(_compare(k, exclude_self), OUT_SCHEMA)

    # the packs of a query's nearest cell bound its k-th distance; all others
    # send only rows within that bound
    path = new_scratch_path(index.rows.sparkSession, "ivf-home")
    compared(q.withColumn("bound", F.lit(float("inf"))), True).write.parquet(path)
    home = index.rows.sparkSession.read.schema(OUT_SCHEMA).parquet(path)
    top = Window.partitionBy("qid").orderBy("distance", "cid")
    bounds = home.withColumn("place", F.row_number().over(top)).filter(F.col("place") == k).select("qid", F.col("distance").alias("bound"))
    rest = compared(q.join(bounds, "qid", "left").select("qid", "v", F.coalesce("bound", F.lit(float("inf"))).alias("bound")), False)
    return _merge_top(home.unionByName(rest), k)


def probes_for(queries: DataFrame, index: Index, k: int, *, q_id: str, q_vec: str, exclude_self: bool = False, floor: float = 0.9) -> tuple[int, dict]:
    """The fewest probes whose cells hold ``floor`` of the true ``k`` nearest
    rows of ASKED queries (two hundredths to spare), and the facts measured:
    recall, and the share of the corpus that a query meets."""
    q = usable(queries.select(F.col(q_id).cast("long").alias("qid"), F.col(q_vec).alias("v")), "v")
    asked = q.orderBy(F.xxhash64("qid"), "qid").limit(ASKED)
    hits = knn_join(asked, index.rows, k, q_id="qid", q_vec="v", c_id="cid", c_vec="v", exclude_self=exclude_self).select(F.col("query_id").alias("qid"), F.col("chunk_id").alias("cid"))
    at = index.rows.select("cid", "cell").join(F.broadcast(hits), "cid").collect()  # at most ASKED * k
    vectors = {r.qid: r.v for r in asked.collect()}  # ASKED
    if not at:
        return 1, {"recall": 1.0, "share": 0.0}
    ids = sorted(vectors)
    order = np.argsort(_squared(np.array([list(vectors[i]) for i in ids], np.float64), index.centroids), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :].repeat(len(ids), 0), axis=1)
    rank = place[np.searchsorted(ids, [r.qid for r in at]), [r.cell for r in at]]
    recall = np.cumsum(np.bincount(rank, minlength=order.shape[1])) / len(rank)
    probes = int(np.argmax(recall >= min(1.0, floor + 0.02))) + 1
    met = index.counts[order[:, :probes]].sum(1).mean() / max(index.counts.sum(), 1)
    return probes, {"recall": float(recall[probes - 1]), "share": float(met)}


def describe(index: Index, facts: dict) -> str:
    return json.dumps({"rows": int(index.counts.sum()), "cells": len(index.centroids), "packs": int((index.first + index.splits).max()), **facts}, sort_keys=True)
