"""Every pipeline stage and operator on odd tables: nulls in any column, empty
and very long texts, repeated rows, empty tables, clashing extra columns."""

import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import ann, chat, exact_dedup, langid, packing, pieces, secret_scan, simhash, suffix_dedup, url_rules
from test_operators import ODD, SF

EXTRA = {"TEXT": "'no'", "Doc_Id": "5L", "_c0": "7", "_c1": "'x'", "digest": "'q'", "_digest": "'q'", "_id": "1L", "fp": "2L", "node": "3L", "block": "4L", "component_id": "6L",
         "score": "0.5", "_score": "0.5", "_lang": "'zz'", "lang_pred": "'zz'", "keep_id": "8L", "text_sha256": "'q'", "ids": "array(1)", "start": "9L", "n": "9L", "spans": "1"}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").limit(40).collect()]
    rows += [(50_000 + i, t, None if i % 2 else "xx", None) for i, t in enumerate(ODD)]
    rows += [(None, "some words here", "en", "s"), (None, None, None, None), rows[0], rows[0], (60_000, "the long text " * 40_000, "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    return df.selectExpr("*", *[f"{v} AS {k}" for k, v in EXTRA.items()])


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_columns_and_whole_rows(spark, odd, name, stage):
    out = stage(spark, odd, SF)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    def others(df):  # every column but the text, which the secret scan changes
        return Counter(tuple(str(x) for i, x in enumerate(r) if i != 1) for r in df.collect())
    got, given = others(out), others(odd)
    assert got and not got - given
    if name == "secret scans":
        assert got == given
    assert stage(spark, odd.limit(0), SF).count() == 0
    assert stage(spark, odd.withColumn("text", F.lit(None).cast("string")), SF).count() == {"language ID": 0, "exact dedup": 1}.get(name, stage(spark, odd.withColumn("text", F.lit("")), SF).count())


def test_last_stage(spark, odd):
    got = corpus_pipeline.packing_stage(spark, odd, SF)
    assert got.agg(F.sum("length")).first()[0] == got.filter("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert got.filter("start = 0").count() == odd.count()
    assert corpus_pipeline.packing_stage(spark, odd.limit(0), SF).count() == 0


def test_one_row_per_document_whatever_else_the_table_holds(spark, odd):
    n, ids = odd.count(), Counter(r[0] for r in odd.collect())
    for out in (pieces.digests(odd, public_tokenizers.path("piece_bpe_32k.model")), secret_scan.digests(odd), suffix_dedup.digests(odd),
                simhash.near_duplicates(odd), langid.languages(odd), exact_dedup.duplicates(odd)):
        assert out.count() == n
        assert Counter(r.doc_id for r in out.select("doc_id").collect()) == ids


def test_an_all_null_table(spark):
    d = spark.range(3).selectExpr("CAST(NULL AS LONG) AS doc_id", "CAST(NULL AS STRING) AS text", "CAST(NULL AS STRING) AS lang")
    assert [r.n_tokens for r in pieces.digests(d, public_tokenizers.path("piece_bpe_32k.model")).collect()] == [0] * 3
    assert [r.length for r in packing.pack(d, public_tokenizers.path("byte_bpe_50k.json")).collect()] == [1] * 3
    assert [r.spans for r in secret_scan.digests(d).collect()] == [""] * 3
    assert [(r.n_bytes, r.n_removed) for r in suffix_dedup.digests(d).collect()] == [(0, 0)] * 3
    assert [(r.fingerprint, r.component_id) for r in simhash.near_duplicates(d).collect()] == [("0" * 16, None)] * 3
    assert [(r.lang_pred, r.score, r.held_out) for r in langid.languages(d).collect()] == [("und", 0.0, False)] * 3
    assert [(r.group_size, r.kept) for r in exact_dedup.duplicates(d).collect()] == [(3, True)] * 3
    assert exact_dedup.drop_duplicates(d).count() == 1
    p = spark.range(2).selectExpr("CAST(NULL AS LONG) AS page_id", "CAST(NULL AS STRING) AS url", "1 AS rid", "'x' AS URL")
    assert [(r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(p).collect()] == [("", "", None, "allow")] * 2
    v = spark.range(2).selectExpr("CAST(NULL AS LONG) AS vec_id", "CAST(NULL AS ARRAY<DOUBLE>) AS embedding", "1 AS v")
    assert ann.nearest(v, F.col("vec_id") % 20 == 0).count() == 0
    c = spark.range(2).selectExpr("CAST(NULL AS LONG) AS conv_id", "CAST(NULL AS INT) AS turn", "CAST(NULL AS STRING) AS role", "CAST(NULL AS STRING) AS text", "1 AS turns", "2 AS ROLE")
    assert [(r.conv_id, r.n_turns, r.loss_chars, r.valid) for r in chat.digests(c).collect()] == [(None, 2, 0, False)]


def test_every_language_is_learned_from_all_its_distinct_texts(spark):
    copies = spark.range(20_000).selectExpr("id AS doc_id", "'the same words again' AS text", "'aa' AS lang")
    others = spark.range(20_000, 20_010).selectExpr("id AS doc_id", "concat('other words ', id) AS text", "'aa' AS lang")
    long = spark.range(30_000, 30_008).selectExpr("id AS doc_id", "repeat(concat('very long ', id, ' '), 2000) AS text", "'bb' AS lang")
    many = spark.range(40_000, 41_000).selectExpr("id AS doc_id", "concat('text number ', id) AS text", "'cc' AS lang")
    d = copies.unionByName(others).unionByName(long).unionByName(many)
    got = langid.sample(d)
    want = {(r.lang, r.text) for r in d.filter(~langid.held_out(F.col("doc_id"))).select("lang", "text").distinct().collect()}
    by = Counter(x for x, _ in got)
    assert set(got) <= want and len(set(got)) == len(got)
    assert {x: by[x] for x in ("aa", "bb")} == {x: sum(y == x for y, _ in want) for x in ("aa", "bb")} and by["cc"] == langid.SAMPLE


def test_equal_blocks_are_encoded_apart(spark):
    rows = spark.range(0, 3, 1, 3).selectExpr("1L AS doc_id", "'a b' AS text")  # one row a partition
    got = [tuple(r) for r in pieces.encode_ids(rows, public_tokenizers.path("piece_bpe_32k.model")).collect()]
    sp = pieces._model(public_tokenizers.path("piece_bpe_32k.model"))
    assert got == [(1, sp.encode("a b"), "a b")] * 3


def test_a_token_partly_in_a_base_span_is_still_judged(spark):
    rng = random.Random(4)
    *secret, rest = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32)) for _ in range(61)]
    texts = [f"see xoxe-1234567890123456-{rest} here", "see 0123456789abcdef0123456789abcdef here"]
    words = spark.read.parquet(f"{SF}/documents.parquet").select("text")
    chains = secret_scan.train(words.union(spark.createDataFrame([(f"token = {s}",) for s in secret], "text string")))
    assert chains.is_random(texts[0].split()[1])
    assert secret_scan.find(texts[0], chains) == [("random", 4, 26 + len(rest)), ("hex", 9, 25)]
    assert [k for k, _, _ in secret_scan.find(texts[1], chains)] == ["hex"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.text for r in secret_scan.redact(d, chains).orderBy("doc_id").collect()] == ["see [SECRET] here"] * 2
