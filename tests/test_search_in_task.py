"""Chunks are embedded in the tasks that search them, and their documents are
dealt out whatever the file is like."""

import numpy as np
from pyspark.sql import functions as F

from tessera import session
from tessera.functions import vectors as V
from tessera.operators import knn as K
from tessera.operators.chunking import fixed_chunks
from tessera.plans import catalog
from tessera.plans import retrieve as R
from tessera.session import table

SF = "/root/testdata/sf0.001"
ODD = [None, "", "  \t\r\n ", "a", "A a\tA\r\nÄ ä", "no break\x0bspace\x0chere", "İ ΣΣ straße", " lead and trail \n", "x " * 3000, "\U0001f600 中文"]


def test_counts_equal_the_buckets_of_every_token(spark, monkeypatch):
    monkeypatch.setattr(V, "KEPT_TOKENS", 3)
    df = spark.createDataFrame(list(enumerate(ODD)), "id long, text string")
    for dim in (64, 48):
        for lower in (True, False):
            rows = df.select(V.token_buckets(F.col("text"), dim, lower).alias("b"), V.hashed_text("text", lower).alias("t")).collect()
            want = [np.bincount(np.array(r.b or [], int), minlength=dim).tolist() for r in rows]
            assert V.text_counts(dim)([r.t and bytes(r.t) for r in rows]).tolist() == want
            assert [r.v for r in V.with_hashed_counts(df, "text", "v", dim, lower).orderBy("id").collect()] == want


def test_chunks_meet_the_questions_where_they_are_embedded(spark):
    docs = table(spark, SF, "documents").select("doc_id", "source", "text").limit(60)
    docs = docs.unionByName(spark.createDataFrame([(-9 - i, "s", t) for i, t in enumerate(ODD)], docs.schema))
    chunks = fixed_chunks(docs, 300, 100)
    questions = spark.createDataFrame([(1, "the and of"), (2, "A a Ä"), (3, ""), (4, None), (5, "the and of")], "query_id long, text string")

    def rows(df):
        return sorted(map(tuple, df.select("query_id", "rk", "chunk_id", "distance").collect()))

    hits = R.hits_for(questions, chunks)
    assert "ArrowEvalPython" not in hits._jdf.queryExecution().executedPlan().toString()
    want = rows(R.hits_for(questions, chunks, embed=lambda *a: V.with_hashed_counts(*a)))
    assert rows(hits) == want and len(want) == 15
    text, counts = V.with_hashed_counts.in_task("chunk", 64)
    q = V.with_hashed_counts(questions, "text", "v")
    for few in (0, 2):
        got = K.knn_join(q, chunks.select("chunk_id", text.alias("v")), 3, q_id="query_id", q_vec="v", c_id="chunk_id", c_vec="v",
                         metric="cosine_counts", broadcast_queries=few, c_embed=counts)
        assert rows(got) == want


def test_documents_of_one_row_group_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(session, "SPREAD_BYTES", 10_000)
    size = session.scan_bytes(table(spark, SF, "documents"))
    assert size > 100_000
    assert catalog._searched(spark, SF).rdd.getNumPartitions() >= size // 20_000
