import pytest

from tessera.functions import replies as R
from tessera.functions.text import run_stamp

# Reply cleaning goldens (reply, trimmed, default status, parity status).
CASES = [
    ('{"irn_eluts":"1"}', '{"irn_eluts":"1"}', "OK", "OK"),
    ('[{"text":"tim"}]', '{"text":"tim"}', "OK", "OK"),
    ("'''json {\"a\":1} '''", '{"a":1}', "OK", "OK"),
    ('{"a":null}', '{"a":null}', "OK", "INVALID_JSON"),
    ('{"a":1},{"b":2}', '{"a":1},{"b":2}', "INVALID_JSON", "INVALID_JSON"),
    ('{"a":1', "", "INVALID_JSON", "INVALID_JSON"),
    ("{}", "{}", "NO_ANSWER", "NO_ANSWER"),
    ("{ }", "{ }", "OK", "OK"),
    ("sorry", "", "INVALID_JSON", "INVALID_JSON"),
]


@pytest.fixture(scope="module")
def replies(spark):
    return spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "reply_id long, reply string")


def test_trim_and_status(replies):
    out = replies.select("reply_id", R.brace_trim("reply").alias("t"),
                         R.reply_status(R.clean_reply("reply")).alias("s"),
                         R.reply_status(R.clean_reply("reply", strict_parity=True)).alias("p")).collect()
    for r in out:
        _, trimmed, status, parity = CASES[r["reply_id"]]
        assert (r["t"], r["s"], r["p"]) == (trimmed, status, parity)


def test_strict_json_gaps_closed(spark):
    df = spark.createDataFrame([(s,) for s in ['{"a":1}]', '{"a":1}],[{"b":2}', '{"a":1} x', "{'a':1}",
                                               '1', '"x"', ' {"a": 1} ']], "s string")
    got = [r[0] for r in df.select(R.is_json("s")).collect()]
    assert got == [False, False, False, False, True, True, True]


def test_key_order_counts(spark):
    df = spark.createDataFrame([('{"continent":1,"irn_eluts":2}',), ('{"irn_eluts":2,"continent":1}',)], "s string")
    got = [r[0] for r in df.select(R.keys_in_order("s", ["irn_eluts", "continent"])).collect()]
    assert got == [False, True]


def test_run_stamp(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-05-18 06:53:26' AS ts")
    assert df.select(run_stamp("ts")).first()[0] == "2024-05-18T06-53-26"


def test_chat_reply_round_trip(spark):
    from tessera.plans import requests as Q
    conv = spark.createDataFrame([(1, 0, "user", "a b c"), (1, 1, "assistant", "x y")],
                                 "conv_id long, turn long, role string, text string")
    r = Q.reply_table(Q.chat_reply_docs(conv)).first()
    assert (r["content"], r["role"], r["completion_tokens"], r["prompt_tokens"], r["total_tokens"]) == \
        ("x y", "assistant", 2, 3, 5)


def test_strict_json_check_matches_python_on_damaged_replies(spark):
    """Randomly damaged JSON (truncation, stray brackets, single quotes,
    trailing commas, bare words, NaN, doubled values): the Column check
    agrees with Python's strict parser (NaN rejected) on every string."""
    import json
    import random

    from pyspark.sql import functions as F

    from tessera.functions import replies as R

    rnd = random.Random(5)
    base = ['{"a":1}', '{"a":[1,2,{"b":"x"}]}', '{"s":"q\\"uote"}', '{"a":null,"b":true}', '{"a":1.5e3}', '{ }',
            '{"a":{"b":{}}}', '{"k": "v", "n": [ ]}']
    ops = [lambda s: s, lambda s: s[:-1], lambda s: s + "}", lambda s: s.replace('"', "'"),
           lambda s: s.replace("}", ",}", 1), lambda s: s + ",{}", lambda s: "[" + s, lambda s: s + "]",
           lambda s: s.replace(":", "", 1), lambda s: " " + s + " \n", lambda s: s.replace("1", "NaN", 1),
           lambda s: s + "],[" + s, lambda s: s.replace('"a"', "a", 1), lambda s: s.replace("true", "True"),
           lambda s: s[:len(s) // 2] + s, lambda s: s.replace("{", "{{", 1), lambda s: s + s]
    cases = set()
    for _ in range(1500):
        s = rnd.choice(base)
        for _ in range(rnd.randint(1, 2)):
            s = rnd.choice(ops)(s)
        cases.add(s)

    def strict(s):
        try:
            json.loads(s, parse_constant=lambda c: (_ for _ in ()).throw(ValueError(c)))
            return True
        except ValueError:
            return False

    df = spark.createDataFrame([(s,) for s in sorted(cases)], "s string")
    got = {r["s"]: r["v"] for r in df.select("s", R.is_json(F.col("s")).alias("v")).collect()}
    assert {s: got[s] for s in cases} == {s: strict(s) for s in cases}
