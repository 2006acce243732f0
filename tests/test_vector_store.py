"""Updatable vector table and weighted embedding."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import weights as W
from tessera.functions.vectors import with_hashed_counts
from tessera.operators.chunking import fixed_chunks
from tessera.plans import ingest, store_queries
from tessera.session import new_scratch_path, table
from tessera.sinks import vector_store as S

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, text string"


def rows(df):
    return sorted(((r.doc_id, r.chunk_no, r.chunk, r.source, list(r.embedding)) for r in df.collect()), key=repr)


def corpus(spark, state):
    """Documents of a state: ids 0-99; a new state changes, drops and adds."""
    texts = {i: f"document {i} " + "word " * (i % 7) * 20 for i in range(100)}
    if state:
        texts |= {5: "changed", 6: ""}
        for i in (10, 11):
            del texts[i]
        texts |= {200: "added one", 201: None}
    out = [(i, f"s{i % 3}", t) for i, t in texts.items()] + [(None, "s0", "no id"), (300, "s1", "two rows" if state else "two rows of one"), (300, "s2", "second row")]
    return spark.createDataFrame(out, SCHEMA).repartition(3 + state)


def test_only_changes_are_embedded_and_the_result_is_a_full_build(spark):
    root, full, embedded = (new_scratch_path(spark, n) for n in ("store", "store", "seen"))

    def embed(df, *a):
        df.select("doc_id").write.mode("append").parquet(embedded)
        return with_hashed_counts(df, *a)

    assert ingest.update_vector_table(corpus(spark, 0), root, embed=embed) == {"snapshot": 1, "embedded": 102, "kept": 0, "dropped": 0}
    first = rows(ingest.read_vectors(spark, root))
    before = spark.read.parquet(embedded).count()
    assert ingest.update_vector_table(corpus(spark, 1), root, embed=embed) == {"snapshot": 2, "embedded": 5, "kept": 97, "dropped": 5}
    fresh = spark.read.parquet(embedded).count() - before
    assert fresh <= 10  # chunks of the five changed documents
    ingest.update_vector_table(corpus(spark, 1), full)
    want = rows(ingest.read_vectors(spark, full))
    assert rows(ingest.read_vectors(spark, root)) == want
    assert rows(ingest.read_vectors(spark, root, snapshot=1)) == first  # an earlier snapshot stays readable
    assert ingest.update_vector_table(corpus(spark, 1), root, embed=embed) == {"snapshot": 3, "embedded": 0, "kept": 102, "dropped": 0}
    assert spark.read.parquet(embedded).count() == before + fresh
    assert S.compact(spark, root, "md5-bag-64", small=0.2) == 1 or S.compact(spark, root, "md5-bag-64", min_live=1.0, small=0.2) >= 1
    assert rows(ingest.read_vectors(spark, root)) == want
    assert spark.read.parquet(embedded).count() == before + fresh  # vectors are moved, not computed
    assert len(S.unused(spark, root)) >= 2 and not set(S.unused(spark, root)) & set(S.unused(spark, root, keep=99))


def test_compaction_drops_dead_rows(spark):
    root = new_scratch_path(spark, "store")
    docs = corpus(spark, 0)
    ingest.update_vector_table(docs, root)
    changed = docs.withColumn("text", F.when(F.col("doc_id") < 60, F.lit("new")).otherwise(F.col("text")))
    ingest.update_vector_table(changed, root)
    want = rows(ingest.read_vectors(spark, root))
    assert S.compact(spark, root, "md5-bag-64") == 1  # the first part: less than 0.7 of it is live
    _, snap = S.current(spark, root, S.NAME)
    assert all(p["live"] == p["built"] for p in snap["parts"].values()) and rows(ingest.read_vectors(spark, root)) == want
    assert S.compact(spark, root, "md5-bag-64") == 0


def test_refusals_and_empty_states(spark):
    root = new_scratch_path(spark, "store")
    with pytest.raises(ValueError, match="no snapshot"):
        ingest.read_vectors(spark, root)
    ingest.update_vector_table(corpus(spark, 0), root)
    with pytest.raises(ValueError, match="was built with"):
        ingest.read_vectors(spark, root, embedder="other")
    with pytest.raises(ValueError, match="was built with"):
        ingest.update_vector_table(corpus(spark, 1), root, embedder="other")
    none = spark.createDataFrame([], SCHEMA)
    assert ingest.update_vector_table(none, root) == {"snapshot": 2, "embedded": 0, "kept": 0, "dropped": 102}
    with pytest.raises(ValueError, match="no documents"):
        ingest.read_vectors(spark, root)
    assert ingest.update_vector_table(corpus(spark, 0), root)["embedded"] == 102


def test_a_late_writer_fails(spark, monkeypatch):
    root = new_scratch_path(spark, "store")
    ingest.update_vector_table(corpus(spark, 0), root)
    stale = S.current(spark, root, S.NAME)
    ingest.update_vector_table(corpus(spark, 1), root)
    monkeypatch.setattr(S, "current", lambda *a: stale)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        ingest.update_vector_table(corpus(spark, 1), root)


def test_digests_tell_rows_apart(spark):
    def digest(*pairs):
        return [r.digest for r in S.document_digests(spark.createDataFrame([(1, *p) for p in pairs], SCHEMA)).collect()][0]
    assert digest(("a", "x"), ("b", "y")) == digest(("b", "y"), ("a", "x"))
    some = [digest(("a", "x")), digest(("ax", "")), digest(("", "ax")), digest((None, "x")), digest(("a", None)), digest(("a", "")), digest(("a", "x"), ("a", "x")), digest(("a", "y"), ("a", "y"))]
    assert len(set(some)) == len(some)


DIM = 64


def tfidf(texts):
    def buckets(t):
        return [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % DIM for w in (t or "").lower().split()]
    held = [set(buckets(t)) for t in texts]
    idf = np.array([math.log((1 + len(texts)) / (1 + sum(b in h for h in held))) + 1 for b in range(DIM)])

    def vector(t):
        v = np.bincount(buckets(t), minlength=DIM) * idf
        return v / np.linalg.norm(v) if v.any() else v
    return idf, vector


def test_weights_are_inverse_document_frequencies(spark):
    texts = ["a b c", "a a b", "", None, "a d", "B"]
    docs = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], SCHEMA).repartition(2)
    w, (idf, vector) = W.fit(docs, dim=DIM), tfidf(texts)
    assert np.allclose(w.idf, idf)
    for r in w.embed(docs, "text", "v", DIM).collect():
        assert np.allclose(r.v, vector(r.text))
    with pytest.raises(ValueError):
        w.embed(docs, "text", "v", 32)
    assert W.fit(docs.limit(0), dim=4).idf == (1.0,) * 4


def test_a_table_and_other_weights_refuse_each_other(spark):
    root = new_scratch_path(spark, "weighted")
    with pytest.raises(ValueError, match="no weights"):
        W.load(spark, root)
    docs = corpus(spark, 0)
    w = ingest.build_weighted_table(docs, root)
    assert W.load(spark, root) == w and w.embedder != W.fit(corpus(spark, 1)).embedder
    with pytest.raises(ValueError, match="was built with"):
        ingest.read_vectors(spark, root, embedder=W.fit(corpus(spark, 1)).embedder)
    assert ingest.build_weighted_table(corpus(spark, 1), root) == w  # an update keeps the weights of the table
    assert rows(ingest.read_vectors(spark, root, embedder=w.embedder)) == rows(w.embed(fixed_chunks(corpus(spark, 1), 300, 100), "chunk", "embedding", DIM))


def test_weighted_retrieval_equals_brute_force(spark):
    docs = table(spark, SF, "documents").select("doc_id", "source", "text")
    _, vector = tfidf([r.text for r in docs.collect()])
    chunks = [(r.chunk_id, vector(r.chunk)) for r in fixed_chunks(docs, 300, 100).collect()]
    ids, V = np.array([i for i, _ in chunks]), np.array([v for _, v in chunks])
    got = {}
    for r in store_queries.q_tfidf_retrieve(spark, SF).collect():
        got.setdefault(r.query_id, []).append((r.rk, r.distance))
    for q in table(spark, SF, "benchmark").collect():
        d = np.sort(((V - vector(q.text)) ** 2).sum(1))[:3]
        assert np.allclose([x for _, x in sorted(got[q.item_id])], d, atol=1e-6)
    assert len(ids) > 100


@pytest.mark.parametrize("dim", [1, 2, 16, 64, 100, 256, 1000, 4096, 1 << 28])
def test_buckets_are_the_first_eight_digits_modulo_dim(spark, dim):
    from tessera.functions.vectors import token_bucket
    words = [f"w{i}" for i in range(300)] + ["", "é", "日本"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", token_bucket(F.col("w"), dim).alias("b")).collect()
    assert all(r.b == int(hashlib.md5(r.w.encode()).hexdigest()[:8], 16) % dim for r in got)
