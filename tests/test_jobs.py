"""Composed jobs, lenient JSON, explicit newline handling, CSV cells."""

import json

import pytest
from conftest import AUTH_SCHEMA, AUTHORITY_ROWS
from pyspark.sql import functions as F

from tessera.functions import replies as R
from tessera.functions import text as T
from tessera.operators import textcheck
from tessera.plans import jobs, match_eval
from tessera.sinks import files as sinks
from tessera.sources import files as sources

PROBES = [(1, "Africa", "Ethiopia", "Oromia", "Mirab Shewa (Zone)"), (2, "Asia", "China", "", "Putian"), (3, "", "", "", ""), (4, "Asia", "Japan", "", "")]
PROBE_SCHEMA = "irn bigint, continent string, country string, state_province string, county string"


@pytest.fixture(scope="module")
def probes(spark):
    return spark.createDataFrame(PROBES, PROBE_SCHEMA)


def strict(s, nan):
    def refuse(_):
        raise ValueError
    try:
        json.loads(s, parse_constant=None if nan else refuse)
        return True
    except ValueError:
        return False


JSON_TEXTS = ['{"a":1,"a":2}', '{"a":NaN}', '{"a":[NaN,-Infinity, Infinity ]}', "{'a':1}", '{"a":\'b\'}', '{"a":"it\'s"}', '{"a":"x\\"y\'"}', '{"a":"x\ty"}',
              '{"a":"x\\ty"}', '{"a":1} x', '{"a":1}{}', '{"a":1},{"b":2}', '{"a":01}', '{a:1}', '{"a":1,}', '{"a":"\\q"}', '{"a":"NaN, b"}', '{"a" NaN}',
              '{"a":NaNa}', '{"a":"\\\\"}', '{"a":"\\\\\\""}', '{"a":"\x7f"}', '', ' {"a":\n1 } ', '{"a":{"a":{"a":[]}}}', '{"a":"é "}', '{"a":tru}', '"x', '{"a":"\n"}', ']', '{"a":1}]']


@pytest.mark.parametrize("nan", [False, True])
def test_json_check_agrees_with_the_plain_parser(spark, nan):
    df = spark.createDataFrame([(s,) for s in JSON_TEXTS], "s string")
    got = {r.s: r.ok for r in df.select("s", R.is_json("s", allow_nan=nan).alias("ok")).collect()}
    assert got == {s: strict(s, nan) for s in JSON_TEXTS}


def test_very_long_json(spark):
    long = '{"a":"' + "x\\\"'" * 200_000 + '"}'
    df = spark.createDataFrame([(long,), (long[:-1],), (None,)], "s string")
    assert [r[0] for r in df.select(R.is_json("s")).collect()] == [True, False, False]


def test_repeated_keys_count_once_in_order(spark):
    df = spark.createDataFrame([('{"a":1,"b":2,"a":3}',), ('{"b":1,"a":2}',)], "s string")
    assert [r[0] for r in df.select(R.keys_in_order("s", ["a", "b"])).collect()] == [True, False]


def test_slots_in_values_stay(spark):
    df = spark.createDataFrame([("{question}", "{context}")], "c string, q string")
    r = df.select(T.fill_template("[{context}|{question}]", "c", "q", T.HUMAN_PREFIX).alias("x")).first()
    assert r.x == "Human: [{question}|{context}]"


def test_reconcile_replies(spark, probes, golden_authority):
    replies = spark.createDataFrame([(1, '```json {"irn_eluts":"375150","country":null,"county":"Z"} ```'), (3, '{"irn_eluts":"9"}'), (4, None)], "irn bigint, reply string")
    out = {r.irn: r.asDict() for r in jobs.reconcile_replies(probes, golden_authority, replies).collect()}
    assert len(out) == 4
    assert (out["1"]["error"], out["1"]["irn_eluts"], out["1"]["continent"], out["1"]["country"], out["1"]["county"]) == ("OK", "375150", "none", "none", "Z")
    assert (out["2"]["error"], out["2"]["irn_eluts"], out["2"]["county"], out["2"]["error_output"], out["2"]["num_authority_matches"]) == ("INVALID_JSON", "none", "Putian", "", 1)
    assert (out["3"]["error"], out["3"]["error_output"], out["3"]["query_string"]) == ("NO_ANSWER", "{}", "")
    assert out["4"]["error"] == "INVALID_JSON" and out["4"]["num_authority_matches"] == 2


def test_reconcile_prompt(spark, probes, golden_authority):
    out = {r.irn: r for r in jobs.reconcile_prompts(probes, golden_authority, 10).collect()}
    assert out[3].prompt is None and out[3].num_authority_matches == 0
    body = out[1].prompt.split("\n")
    assert json.loads(body[1])[0]["irn_eluts"] == "375150"
    assert body[0] == "Answer the question based on the following context:" and body[2].endswith('County="Mirab Shewa (Zone)"')


def test_retrieve_places(spark, probes, golden_authority):
    hits = jobs.place_hits(probes, jobs.row_chunks(golden_authority), 3)
    prompts = {r.irn: r for r in jobs.place_prompts(probes, hits).collect()}
    assert set(prompts) == {1, 2, 3, 4} and prompts[1].n_hits == 3 and prompts[1].prompt.count("irn_eluts: ") == 3
    out = {r.irn: r for r in jobs.answered_rows(probes, jobs.nearest_replies(hits, golden_authority)).collect()}
    nearest = {str(r.query_id): str(r.doc_id) for r in hits.filter("rk = 1").collect()}
    assert {k: r.irn_eluts for k, r in out.items()} == nearest and {r.error for r in out.values()} == {"OK"}
    assert out["1"].country == "Ethiopia" and out["1"].error_output == "NA"
    none = jobs.answered_rows(probes, spark.createDataFrame([(1, "sorry"), (2, "{}")], "irn bigint, reply string")).orderBy("irn").collect()
    assert [(r.error, r.irn_eluts, r.error_output) for r in none] == [("INVALID_JSON", "none", "sorry"), ("NO_ANSWER", "none", "{}"), ("INVALID_JSON", "none", ""), ("INVALID_JSON", "none", "")]


def test_topk_evaluation(spark, golden_authority):
    out = {r.variant: r for r in match_eval.match_eval_topk(golden_authority, 3).collect()}
    assert [out[v].n_probes for v in range(4)] == [6] * 4 and out[0].n_hit1 == 6
    assert all(out[v].n_hit1 <= out[v].n_hitk <= 6 for v in range(4))
    empty = spark.createDataFrame([], AUTH_SCHEMA)
    assert match_eval.match_eval_topk(empty, 3).count() == 0
    one_each = match_eval.retrieve_eval(golden_authority, 3).collect()
    assert sum(r.n_probes for r in one_each) == len(AUTHORITY_ROWS)


def test_newline_choice_is_explicit_and_cells_survive(spark, tmp_path):
    rows = [(1, "a\nb"), (2, '  "q", \n'), (3, ""), (4, None)]
    path = str(tmp_path / "cells")
    sinks.write_csv(spark.createDataFrame(rows, "id long, s string"), path)
    with pytest.raises(TypeError):
        sources.read_csv_table(spark, path, "id long, s string")
    back = sources.read_csv_table(spark, path, "id long, s string", multiline=True, keep_empty=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_quarantine(spark):
    docs = spark.createDataFrame([(1, "<a/>", "x"), (2, "<a>", "x"), (3, None, "y")], "id long, t string, host string")
    checked = textcheck.xml_quality(docs, "id", "t", carry=("host",))
    good, bad = textcheck.quarantined(docs, checked, "id")
    assert [r.id for r in good.collect()] == [1] and sorted(r.id for r in bad.collect()) == [2, 3]
    by = {(r.host, r.fault is None): r.n_docs for r in textcheck.quality_by_source(checked, "host").collect()}
    assert by == {("x", True): 1, ("x", False): 1, ("y", False): 1}


def test_oversized_vectors_are_refused(spark):
    from tessera.operators import knn
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "id long, v array<double>")
    with pytest.raises(Exception, match="hyperplanes"):
        knn.with_lsh_keys(df, "v", 2).select(F.size("_ckeys")).collect()


def test_retrieval_evaluation_asks_every_row_in_every_variant(spark, golden_authority):
    import hashlib
    from collections import Counter

    def bag(text):
        return Counter(int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 64 for t in text.lower().split())

    def distance(a, b):
        n = sum(x * x for x in a.values()) * sum(x * x for x in b.values())
        return 2 - 2 * sum(a[i] * b[i] for i in a) / n ** 0.5 if n else 2.0
    chunks = {r.doc_id: bag(r.chunk) for r in jobs.row_chunks(golden_authority).collect()}
    cases = match_eval.degraded_probes(golden_authority).select("variant", "expected", T.question_text(*T.PLACE_FIELDS).alias("text")).collect()
    want = {v: [0, 0, 0] for v in range(4)}
    for c in cases:
        near = sorted(chunks, key=lambda i: (distance(bag(c.text), chunks[i]), i))[:3]
        want[c.variant] = [a + b for a, b in zip(want[c.variant], (1, near[0] == c.expected, c.expected in near))]
    got = {r.variant: [r.n_probes, r.n_hit1, r.n_hitk] for r in match_eval.retrieve_eval_all(golden_authority, 3).collect()}
    assert got == want and sum(n for n, _, _ in got.values()) == 4 * len(AUTHORITY_ROWS)
