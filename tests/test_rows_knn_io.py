import os

import numpy as np

import pytest
from pyspark.sql import functions as F

from tessera.operators import knn as K
from tessera.operators import rows as W
from tessera.session import new_scratch_path, table


def test_row_numbers_consecutive(spark):
    df = spark.range(0, 5000, 7).withColumn("k", (F.col("id") * 37) % 5003).repartition(5)
    out = W.row_numbers(df, ["k"]).orderBy("k").collect()
    assert [r["row_no"] for r in out] == list(range(1, len(out) + 1))
    b = W.batch_numbers(df, "k", 20).agg(F.max("batch_no")).first()[0]
    assert b == (len(out) + 19) // 20


def test_nth_row(spark):
    df = spark.range(100)
    assert W.nth_row(df, ["id"], 10).first()[0] == 10
    assert W.nth_row(df, ["id"], 200).count() == 0


def test_union_rows_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id long, k string")
    b = spark.createDataFrame([(2, "e")], "id long, err string")
    u = W.union_rows([a, b])
    assert u.columns == ["id", "k", "err"] and u.count() == 2


def _brute(spark):
    e = table(spark, "/root/testdata/sf0.01", "embeddings").select("vec_id", "embedding").toPandas()
    import numpy as np
    V = np.stack(e["embedding"].to_numpy()).astype(np.float64)
    ids = e["vec_id"].to_numpy()
    d = ((V[:, None, :] - V[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    top = {}
    for i, q in enumerate(ids):
        order = np.lexsort((ids, d[i]))[:3]
        top[int(q)] = [int(ids[j]) for j in order]
    return top


def test_exact_knn_matches_brute_force_and_bucketed_recall(spark):
    truth = _brute(spark)
    e = table(spark, "/root/testdata/sf0.01", "embeddings").select("vec_id", "embedding")
    for bq in (0, K.BROADCAST_QUERIES):  # blocked equi-key join, then broadcast queries + streamed corpus
        exact = K.knn_join(e, e, 3, q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding",
                           exclude_self=True, block_rows=128, broadcast_queries=bq)
        got = {}
        for r in exact.collect():
            got.setdefault(r["query_id"], []).append((r["rk"], r["chunk_id"]))
        assert {q: [c for _, c in sorted(v)] for q, v in got.items()} == truth
    x = K.with_lsh_keys(e, "embedding", 64, tables=3, bits=4)
    approx = K.knn_join(x, x, 3, q_id="vec_id", q_vec="embedding", c_id="vec_id", c_vec="embedding",
                        exclude_self=True, c_bucket=F.col("_ckeys"), q_probe=F.col("_qkeys"))
    hits = sum(1 for r in approx.collect() if r["chunk_id"] in truth[r["query_id"]])
    recall = hits / (3 * len(truth))
    assert recall > 0.6, recall


def test_csv_reader_nulls_tokens(spark):
    path = new_scratch_path(spark, "csvtok")
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write('id,name\n1,NA\n2,"say ""hi"""\n3,\n4,n/a\n5,ok\n')
    from tessera.sources.files import read_csv_table
    got = {r["id"]: r["name"] for r in read_csv_table(spark, path, "id long, name string", multiline=False).collect()}
    assert got == {1: None, 2: 'say "hi"', 3: None, 4: None, 5: "ok"}


def test_vector_table_versions_and_embedder_check(spark):
    import pytest
    from tessera.plans import ingest
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "source", "text")
    root = new_scratch_path(spark, "vt")
    ingest.build_vector_table(docs, root)
    vt = ingest.open_vectors(spark, root)
    assert vt.count() > 0 and set(["embedding", "embedder", "dim"]) <= set(vt.columns)
    with pytest.raises(ValueError):
        from tessera.sinks.files import open_vector_table
        open_vector_table(spark, root, "other", 64)


def test_batched_lsh_buckets_equal_plain_dot_products(spark):
    e = table(spark, "/root/testdata/sf0.01", "embeddings").select("vec_id", "embedding")
    planes = K.hyperplanes(64, 12)
    rows = e.withColumn("b", K.lsh_buckets(planes, 3, 4)(F.col("embedding"))).collect()
    for r in rows[::7]:
        signs = []
        for p in planes:
            dot = 0.0
            for x, y in zip(r.embedding, p):
                dot += x * y
            signs.append(dot > 0)
        assert r.b == [sum(1 << j for j in range(4) if signs[4 * t + j]) for t in range(3)]


def test_query_side_bound_counts_bytes(spark):
    wide = spark.createDataFrame([(i, [0.5] * 2048) for i in range(10)], "id long, v array<double>")
    assert K._small_query_side(wide, "v", 100, 10 * 2048 * 8)
    assert not K._small_query_side(wide, "v", 100, 10 * 2048 * 8 - 1)
    assert not K._small_query_side(wide, "v", 9, 1 << 30)


def test_pluggable_embedder_for_retrieval_and_vector_table(spark):
    """A replacement embedder (unit-length doubles of the hashed counts,
    compared by squared L2) is used on both sides; on unit vectors it ranks
    like the default cosine, and the vector table records its id."""
    from tessera.functions import vectors as V
    from tessera.operators.chunking import fixed_chunks
    from tessera.plans import ingest, retrieve as R

    def unit_embed(df, text_col, out_col, dim):
        return V.with_hashed_counts(df, text_col, "_c", dim).withColumn(out_col, V.normalized("_c")).drop("_c")

    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "source", "text")
    qs = table(spark, "/root/testdata/sf0.001", "benchmark").select(F.col("item_id").alias("query_id"), "text")
    ch = fixed_chunks(docs, 300, 100)
    a = {r["query_id"]: (r["chunk_id"], r["distance"]) for r in R.hits_for(qs, ch).filter("rk = 1").collect()}
    b = {r["query_id"]: (r["chunk_id"], r["distance"])
         for r in R.hits_for(qs, ch, embed=unit_embed, metric="sq_l2").filter("rk = 1").collect()}
    assert set(a) == set(b)
    for q in a:
        assert abs(a[q][1] - b[q][1]) < 1e-9
    same = sum(a[q][0] == b[q][0] for q in a) / len(a)
    assert same >= 0.9, same
    root = new_scratch_path(spark, "vt-embed")
    ingest.build_vector_table(docs, root, embed=unit_embed, embedder="unit-md5")
    assert ingest.open_vectors(spark, root, embedder="unit-md5").count() == ch.count()
    with pytest.raises(ValueError):
        ingest.open_vectors(spark, root)


def test_bucketed_retrieval_recall_against_exact(spark):
    """Approximate retrieval (LSH buckets on the count vectors) returns hits
    whose distances are exact, and finds most of the exact top-3."""
    from tessera.operators.chunking import fixed_chunks
    from tessera.plans import retrieve as R

    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    qs = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    ch = fixed_chunks(docs, 300, 100)
    exact = {(r["query_id"], r["chunk_id"]): r["distance"] for r in R.hits_for(qs, ch).collect()}
    approx = {(r["query_id"], r["chunk_id"]): r["distance"] for r in R.hits_for(qs, ch, lsh=(3, 4)).collect()}
    assert approx and {q for q, _ in approx} <= {q for q, _ in exact}
    recall = len(set(approx) & set(exact)) / len(exact)
    assert recall >= 0.5, recall
    for key in set(approx) & set(exact):
        assert abs(approx[key] - exact[key]) < 1e-12


def test_row_numbers_lose_no_row(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 300_000, numPartitions=8).selectExpr("xxhash64(id) AS k", "repeat(cast(id AS string), 50) AS wide", "id % 7 AS tie")
    for order in (["k"], ["tie"]):
        r = W.row_numbers(df, order).agg(F.count("*"), F.countDistinct("row_no"), F.min("row_no"), F.max("row_no")).first()
        assert tuple(r) == (300_000, 300_000, 1, 300_000)
    tied = [W.row_numbers(df.repartition(n).drop("wide"), ["tie"]).select("k", "row_no") for n in (3, 11)]
    assert tied[0].exceptAll(tied[1]).isEmpty()  # ties have one order


def test_a_rewritten_table_is_read_anew(spark, tmp_path):
    for n in (3, 5):
        spark.range(n).write.mode("overwrite").parquet(str(tmp_path / "region.parquet"))
        assert table(spark, str(tmp_path), "region").count() == n


def test_knn_ties_do_not_depend_on_partitions_or_plan(spark):
    from tessera.operators.knn import knn_join
    df = spark.createDataFrame([(i, [1.0, 2.0, float(i == 0)]) for i in range(400)] + [(900, None)], "id long, v array<double>")
    for metric in ("sq_l2", "cosine_counts"):
        d = df if metric == "sq_l2" else df.withColumn("v", df.v.cast("array<bigint>"))
        for n in (1, 4, 16):
            for limit in (0, 65_536):
                hits = knn_join(d.filter("id = 7"), d.repartition(n), 3, q_id="id", q_vec="v", c_id="id", c_vec="v", metric=metric, broadcast_queries=limit)
                assert [r["chunk_id"] for r in hits.orderBy("rk").collect()] == [1, 2, 3]


def test_lsh_bits_follow_the_corpus():
    from tessera.operators import knn as K
    assert [K.lsh_bits(n) for n in (0, 1, 64, 65, 129, 64_000, 64_000_000)] == [1, 1, 1, 1, 2, 10, 20]


def test_a_hot_bucket_is_cut_and_loses_nothing(spark):
    """Copies of one vector share every bucket: cut into blocks, the k nearest
    are still the smallest ids, and a pair met in several tables counts once."""
    from tessera.operators import knn as K
    df = spark.range(300).select("id", F.array(F.lit(1.0), F.lit(-2.0), F.lit(0.5)).alias("v"))
    x = K.with_lsh_keys(df, "v", 3, 3, 2)
    hits = K.knn_join(x, x, 3, q_id="id", q_vec="v", c_id="id", c_vec="v", exclude_self=True, block_rows=64, c_bucket=F.col("_ckeys"), q_probe=F.col("_qkeys"))
    got = {}
    for r in hits.collect():
        got.setdefault(r.query_id, {})[r.rk] = r.chunk_id
    assert len(got) == 300
    assert all(list(dict(sorted(g.items())).values()) == [i for i in range(4) if i != q][:3] for q, g in got.items())


def test_registered_bucketed_search_reaches_its_recall(spark):
    import __spark_entry__ as entry
    for sf in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        exact = {(r.query_id, r.chunk_id) for r in entry.queries()["knn_top3"](spark, sf).filter("query_id % 100 = 0").collect()}
        got = {(r.query_id, r.chunk_id) for r in entry.queries()["knn_bucketed_recall"](spark, sf).collect()}
        assert {q for q, _ in got} == {q for q, _ in exact}
        assert len(got & exact) >= 0.9 * len(exact)


def test_searches_that_measure_recall_ask_with_every_hundredth_row_of_all(spark, tmp_path):
    import __spark_entry__ as entry
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((350, 64)).astype(np.float32)
    spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = entry.queries()["knn_bucketed_recall"](spark, str(tmp_path)).collect()
    got = {(r.query_id, r.chunk_id) for r in found}
    d = ((vectors[::100, None, :].astype(float) - vectors[None].astype(float)) ** 2).sum(2)
    true = {(100 * i, int(j)) for i in range(4) for j in [j for j in np.argsort(d[i]) if j != 100 * i][:3]}
    assert {q for q, _ in got} == {0, 100, 200, 300} and len(got & true) >= 0.9 * len(true)
    facts = entry.queries()["knn_ivf_facts"](spark, str(tmp_path)).first()
    assert tuple(facts) == (350, 1050, 0, True)  # knn_ivf_facts asks with every row


def test_the_inverted_file_facts_ask_with_every_row(spark, tmp_path):
    """Ids of which none is divisible by 100, and the registered SQL."""
    import __spark_entry__ as entry
    rng = np.random.default_rng(4)
    rows = [(100 * i + 7, v.tolist()) for i, v in enumerate(rng.standard_normal((90, 8)).astype(np.float32))]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert tuple(entry.queries()["knn_ivf_facts"](spark, str(tmp_path)).first()) == (90, 270, 0, True)
    assert "WHERE" not in entry.oracle_sql()["knn_ivf_facts"]


def _nearest_rows(qid, Q, cid, C, k, metric, exclude_self):
    if metric == "sq_l2":
        d = np.zeros((len(Q), len(C)))
        for j in range(Q.shape[1]):
            d = d + (Q[:, j:j + 1] - C[:, j]) ** 2
    else:
        den = np.sqrt((Q * Q).sum(1)[:, None] * (C * C).sum(1))
        with np.errstate(divide="ignore", invalid="ignore"):
            d = np.where(den > 0, 2 - 2 * (Q @ C.T) / den, 2.0)
    if exclude_self:
        d = np.where(qid[:, None] == cid, np.inf, d)
    return [(i, cid[j], d[i, j]) for i in range(len(Q)) for j in np.lexsort((cid, d[i]))[:k] if d[i, j] < np.inf]


def test_running_top_k_equals_brute_force():
    r = np.random.RandomState(3)
    for trial in range(16):
        metric, exclude = ("sq_l2", "cosine_counts")[trial % 2], bool(trial // 2 % 2)
        nq, nc, k = r.randint(1, 2600), r.randint(1, 2600), r.randint(1, 5)
        Q, C = (r.randint(0, 3, (n, 5)).astype(float) for n in (nq, nc))
        qid, cid = r.randint(0, nq + 1, nq), r.randint(0, nc + 1, nc)  # repeated ids
        top = K._TopK(qid, Q, k, metric, exclude)
        for s in range(0, nc, 900):
            top.add(cid[s:s + 900], C[s:s + 900])
        assert list(zip(*top.hits())) == _nearest_rows(qid, Q, cid, C, k, metric, exclude)


def test_equal_query_vectors_ask_once(spark, monkeypatch):
    """A larger query side with few distinct vectors is neither copied nor
    compared row by row; repeated ids rank together as before."""
    asked = []
    streamed = K._streamed
    monkeypatch.setattr(K, "_streamed", lambda q, *a: asked.append(q.count()) or streamed(q, *a))
    r = np.random.RandomState(5)
    rows = [(int(i), [int(x) for x in v]) for i, v in zip(r.randint(0, 350, 400), r.randint(0, 3, (400, 2)))]
    corpus = [(i, [int(x) for x in v]) for i, v in enumerate(r.randint(0, 4, (300, 2)))]
    q, c = (spark.createDataFrame(x, "id long, v array<int>") for x in (rows, corpus))
    hits = K.knn_join(q, c, 3, q_id="id", q_vec="v", c_id="id", c_vec="v", metric="cosine_counts", broadcast_queries=20)
    got = sorted((x.query_id, x.rk, x.chunk_id, x.distance) for x in hits.collect())
    assert asked == [9]
    by_id = {}
    for at, cid, d in _nearest_rows(None, np.array([v for _, v in rows], float), np.arange(300), np.array([v for _, v in corpus], float), 3, "cosine_counts", False):
        by_id.setdefault(rows[at][0], []).append((d, int(cid)))
    assert got == sorted((i, rk + 1, cid, d) for i, x in by_id.items() for rk, (d, cid) in enumerate(sorted(x)[:3]))


def test_blocked_sides_are_copied_a_few_times_only(spark):
    """Rows sent by the blocked plan: once per block of the other side, and
    blocks hold tens of thousands of rows, not two thousand."""
    df = spark.range(10_000).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    plan = K._blocked(df.toDF("qid", "v"), df.toDF("cid", "v"), 2, "sq_l2", True, K.BLOCK_ROWS, 4)
    path = new_scratch_path(spark, "blocks")
    plan.write.parquet(path)
    assert spark.read.parquet(path).count() == 10_000 * 2 * 2  # two blocks a side, two hits in each


def test_threshold_reads_the_hits_once(spark):
    hits = spark.createDataFrame([(1, 0.9), (1, 0.1), (2, 0.2), (None, 0.9)], "query_id long, relevance double")
    kept = K.threshold(hits, 0.5)
    assert sorted(tuple(r) for r in kept.collect()) == [(1, 0.1), (1, 0.9)]
    assert kept._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
