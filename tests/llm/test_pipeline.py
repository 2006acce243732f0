"""The pipeline against a stage-by-stage brute-force version."""

import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tessera.llm import langid, packing, secret_scan
from test_operators import brute_print

SF = "/root/testdata/sf0.001"


def test_stages_have_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(30), SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    # 1: the same fitted model, applied row by row
    model = langid.fit(langid.sample(docs))
    def accepted(t):
        if not t or not re.search(r"[^\W\d_]", t):
            return False
        return model.predict([t])[1][0] >= 0.25
    rows = {i: t for i, t in rows.items() if accepted(t)}
    assert len(rows) >= 195  # clean documents stay
    # 2
    last = {}
    for i, t in rows.items():
        k = t.translate({c: c + 32 for c in range(65, 91)})
        last[k] = max(last.get(k, -1), i)
    rows = {i: rows[i] for i in last.values()}
    # 3
    prints, parent = {i: brute_print(t) for i, t in rows.items()}, {i: i for i in rows}
    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a in rows:
        for b in rows:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    rows = {i: t for i, t in rows.items() if find(i) == i}
    # 4: chains counted over what is left
    chains = secret_scan.train(spark.createDataFrame(list(rows.items()), "doc_id long, text string"))
    rows = {i: secret_scan.redacted(t, secret_scan.find(t, chains)) for i, t in rows.items()}
    # 5
    tok = packing._tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id].append(r)
    assert set(got) == set(rows)
    for i, t in rows.items():
        ids = [x for r in sorted(got[i], key=lambda r: r.start) for x in np.frombuffer(r.ids, "<u4").tolist()]
        assert ids == [*tok.encode(t, add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("name", ["op4_chat_format", "op8_url_rules", "op10_exact_dedup", "op11_hard_negatives", "op12_lexical_search", "op13_line_dedup"])
def test_queries_have_sql(name):
    import __spark_entry__ as entry
    assert name in entry.queries() and name in entry.oracle_sql()


def test_the_dealt_queries_and_the_pipeline_are_registered():
    import __spark_entry__ as entry
    numbers = {int(m[1]) for q in entry.queries() if (m := re.match(r"op(\d+)_", q))}
    assert numbers == set(range(1, 14)) and "pipeline" in entry.queries()
