"""Replies with unlisted keys, the splitter as a table function, and the JVM
markup check."""

import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tessera.functions import tables
from tessera.operators import textcheck as X
from tessera.operators.chunking import recursive_chunks, token_length
from tessera.plans import open_replies as O
from tessera.session import table

SF = "/root/testdata/sf0.001"
REPLIES = ['{"b": 1, "a": "x"}', 'Sure: {"a": "y", "C": 2.5, "b": 3}', '{"d": {"e": [1]}, "c": true, "a": null}', '{"b": 1', "{}", None, "nothing", '{"b": "two", "reply_id": 9, "it\'s": "q.1"}',
           '{"a": "x", "a": "last"}', '{"f": true}', '{"f": false, "g": 1e3}', '{"": 1}']


def frame(spark):
    return spark.createDataFrame(list(enumerate(REPLIES)), "reply_id long, reply string").repartition(3)


def test_extra_holds_every_unlisted_key(spark):
    got = {r.reply_id: r for r in O.with_extra(frame(spark), ("a",)).collect()}
    assert got[0].extra == {"b": "1"} and got[0].a == "x"
    assert got[1].extra == {"C": "2.5", "b": "3"}
    assert got[2].extra == {"d": '{"e":[1]}', "c": "true"} and got[2].a == "none"
    assert got[7].extra == {"b": "two", "reply_id": "9", "it's": "q.1"}
    assert got[8].a == "last" and got[8].extra == {}
    assert all(got[i].extra is None and got[i].error != "OK" for i in (3, 4, 5, 6))


def test_dynamic_columns(spark):
    df = O.dynamic_rows(frame(spark))
    assert df.columns == ["reply_id", "b", "a", "C", "d", "it's", "f", "g", "", "extra", "error", "error_output"]  # order of first sight
    kinds = dict(df.dtypes)
    assert (kinds["b"], kinds["C"], kinds["f"], kinds["g"], kinds["d"], kinds["a"]) == ("string", "string" if kinds["C"] == "string" else "double", "boolean", "double", "string", "string")
    got = {r[0]: r for r in df.collect()}
    assert got[0]["b"] == "1" and got[7]["b"] == "two"  # mixed types become text
    assert got[2]["d"] == '{"e":[1]}' and got[2]["extra"] == {"c": "true"}  # "c" differs from "C" by case only
    assert got[7]["reply_id"] == 7 and got[7]["extra"] == {"reply_id": "9"}  # a carried column wins
    assert got[9]["f"] is True and got[10]["f"] is False and got[10]["g"] == 1000.0
    assert got[3]["error_output"] == "" and got[0]["error_output"] == "NA"
    few = {r[0]: r for r in O.dynamic_rows(frame(spark), max_keys=1).collect()}
    assert few[0]["extra"] == {"a": "x"} and few[0]["b"] == "1"
    assert O.dynamic_rows(frame(spark).limit(0)).columns == ["reply_id", "extra", "error", "error_output"]


def test_split_text_equals_the_operator(spark):
    tables.register(spark)
    docs = table(spark, SF, "documents").select("doc_id", "source", "text").unionByName(spark.createDataFrame([(-1, "s", None), (-2, "s", ""), (-3, "s", "a b  c")], "doc_id long, source string, text string"))
    for call, kw in (("split_text(d.text, 300, 100)", dict(size=300, overlap=100)), ("split_text(d.text, 40, 0, 'tokens')", dict(size=40, overlap=0, length=token_length))):
        got = spark.sql(f"SELECT d.doc_id, c.* FROM {{docs}} d, LATERAL {call} c", docs=docs)
        want = recursive_chunks(docs, **kw).select("doc_id", "chunk_no", "start_index", "chunk")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("call", ["split_text('x', 10, 10)", "split_text('x', 10, -1)", "split_text('x', 10, 2, 'bytes')", "split_text('x', length(string(rand())), 2)", "split_text(5, 10, 2)"])
def test_split_text_refuses_wrong_constants(spark, call):
    tables.register(spark)
    with pytest.raises(AnalysisException, match="split_text"):
        spark.sql(f"SELECT * FROM {call}")


TEXTS = ["<a/>", " <a/>\n", "<a>x</a>", "<a b='1'>x<c/></a>", "<a><b></a></b>", "<a>", "</a>", "", " ", "x", "<a/><b/>", "<a/>x", "x<a/>", "<a b=1/>", "<a b='1' b='2'/>", "<a>&amp;</a>",
         "<a>&nbsp;</a>", "<a>&#0;</a>", "<a><!-- -- --></a>", "<a><!-- c --></a>", "<?xml version='1.0'?><a/>", " <?xml version='1.0'?><a/>", "<?xml version='1.1'?><a/>", "<a>\x01</a>",
         "<!DOCTYPE html><html></html>", "<!DOCTYPE a [<!ENTITY x 'y'>]><a>&x;</a>", "<a><![CDATA[<]]></a>", "<a>]]></a>", "<a:b/>", "<a xmlns:b='u'><b:c/></a>", "<a b:c='1'/>", "<a><</a>",
         "<a>&</a>", "<a b='<'/>", "<1a/>", "<a/><!-- c -->", "<a/><?pi x?>", "<A></a>", "<a b='&quot;'>é</a>", "<a><br></a>", "<a", "<a></a>extra<b></b>", "<a></a><a></a>", "<a><a></a></a>",
         "<a/></a>", "<ab></ab><a></a>", "<a b/>", "<a\n></a>", "<a>￾</a>", "<a>\U0001F600</a>", "<a b='>'></a>", "<é/>", "<a>a:b</a>", "<a b='x:y'>t</a>", "﻿<a/>", "<a.b-c></a.b-c>", "<a></a >", "<a></ a>"]


def verdict(text):
    try:
        ET.fromstring(text)
        return True, "The XML is well-formed."
    except ET.ParseError as e:
        return False, f"XML is not well-formed: {e}"


def damaged(pages):
    rng = random.Random(6)
    good = ["<html><head><title>t</title></head><body class='x'><p>one &lt; two</p><br/></body></html>", "<r><i n='1'/><i n=\"2\">é</i></r>", *pages]
    for text in good:
        yield text
        for _ in range(12):
            at = rng.randrange(len(text))
            yield rng.choice([text[:at] + text[at + 1:], text[:at] + rng.choice("<>/&'\"= a:!?-]") + text[at:], text[:at], text + text[at:], text[at:]])


def test_verdicts_are_the_parsers(spark):
    pages = [r.html for r in table(spark, SF, "pages").select("html").limit(25).collect()]
    texts = TEXTS + list(damaged(pages))
    df = spark.createDataFrame([(i, "h", t) for i, t in enumerate([*texts, None])], "page_id long, host string, html string").repartition(3)
    got = {r.page_id: (r.valid, r.message) for r in X.xml_quality(df, "page_id", "html", ("host",)).collect()}
    assert got.pop(len(texts)) == (False, "XML is not well-formed: no text")
    wrong = [(t, got[i], verdict(t)) for i, t in enumerate(texts) if got[i] != verdict(t)]
    assert not wrong, wrong[:6]
    sure = {r.html for r in df.filter(X.surely_well_formed("html")).collect()}
    assert {"<a/>", "<a>x</a>", "<a b='1'>x<c/></a>"} <= sure  # settled without Python
    assert all(verdict(t)[0] for t in sure)
