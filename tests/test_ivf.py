"""Inverted-file search against brute force, vectors that take no part, and
the spreading of derived tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.operators import ivf
from tessera.operators import knn as K
from tessera.plans import views
from tessera.session import new_scratch_path, table

SF = "/root/testdata/sf0.01"
IDS = dict(q_id="id", q_vec="v", exclude_self=True)
SCHEMA = "id long, v array<double>"


def found(df):
    return sorted((r.query_id, r.rk, r.chunk_id, r.distance) for r in df.collect())


def odd_rows(seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(300)]  # a vector that many rows share
    rows += [(2000, None), (2001, [float("nan")] * 6), (2002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2003, [float("inf")] * 6), (2004, [0.0] * 6), (2005, [1e20] * 6)]
    return rows


def test_all_cells_probed_is_the_exact_join(spark):
    e = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    index = ivf.build(e, new_scratch_path(spark, "ivf"), c_id="id", c_vec="v", cells=20, pack_rows=64)
    assert index.splits.max() > 1 and index.counts.sum() == 702  # the shared vector lies in several packs
    exact = K.knn_join(e, e, 4, c_id="id", c_vec="v", **IDS)
    assert found(ivf.search(e, index, 4, len(index.centroids), query_rows=50, **IDS)) == found(exact)


def test_the_measured_recall_is_reached(spark):
    e = table(spark, SF, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    index = ivf.build(e, new_scratch_path(spark, "ivf"), c_id="id", c_vec="v")
    probes, facts = ivf.probes_for(e, index, 3, **IDS)
    hits, exact = (found(x) for x in (ivf.search(e, index, 3, probes, **IDS), K.knn_join(e, e, 3, c_id="id", c_vec="v", **IDS)))
    true = {(q, c) for q, _, c, _ in exact}
    assert len({(q, c) for q, _, c, _ in hits} & true) >= 0.9 * len(true) and facts["recall"] >= 0.92
    assert 0 < facts["share"] < 1 and probes < len(index.centroids)
    again = ivf.open_index(spark, index.rows.inputFiles()[0].rsplit("/rows/", 1)[0].replace("file://", ""))
    assert (again.centroids == index.centroids).all() and again.rows.count() == e.count()


def test_clustered_rows_need_few_cells(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16)) * 10
    e = spark.createDataFrame([(i, (centres[i % 40] + rng.normal(size=16)).tolist()) for i in range(2000)], SCHEMA)
    index = ivf.build(e, new_scratch_path(spark, "ivf"), c_id="id", c_vec="v")
    assert ivf.probes_for(e, index, 3, **IDS)[1]["share"] < 0.1


def test_empty_index_and_queries(spark):
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)
    for corpus, queries in ((none, some), (some, none), (none, none), (some, some)):
        index = ivf.build(corpus, new_scratch_path(spark, "ivf"), c_id="id", c_vec="v")
        probes, _ = ivf.probes_for(queries, index, 3, **IDS)
        assert ivf.search(queries, index, 3, probes, **IDS).count() == 0
    index = ivf.build(some, new_scratch_path(spark, "ivf"), c_id="id", c_vec="v")
    assert found(ivf.search(some, index, 3, 1, q_id="id", q_vec="v")) == [(1, 1, 1, 0.0)]


@pytest.mark.parametrize("parts", [1, 4, 16])
@pytest.mark.parametrize("broadcast", [0, 65_536])
def test_nonfinite_vectors_take_no_part(spark, parts, broadcast):
    rows = [r for r in odd_rows(3) if r[0] < 30 or r[0] >= 2000]
    clean = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    e = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = found(K.knn_join(e, e, 2, c_id="id", c_vec="v", broadcast_queries=broadcast, **IDS))
    ids, V = np.array([i for i, _ in clean]), np.array([v for _, v in clean])
    d = ((V[:, None] - V[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    want = [(int(q), r + 1, int(ids[j])) for q, row in zip(ids, d) for r, j in enumerate(np.lexsort((ids, row))[:2])]
    assert [(q, r, c) for q, r, c, _ in got] == sorted(want)


def test_a_small_view_of_joins_is_spread(spark, monkeypatch):
    a = views.authority(spark, SF)
    target = spark.sparkContext.defaultParallelism
    assert session.spread(a).rdd.getNumPartitions() == target
    assert session.scan_bytes(a) < 16 << 20  # the largest table read, not the product of the joined ones
    monkeypatch.setattr(session, "SPREAD_BYTES", 1)
    assert session.spread(a) is a
