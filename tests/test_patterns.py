"""Regular-expression counties: covers are sound, patterns mean in the JVM what
they mean in Python, and the join equals a plain search of every pair."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import authority as A
from tessera.operators import patterns as P
from tessera.plans.reconcile import reconcile

ATOMS = ["a", "ab", "abc", "bca", ".", "[ab]", "[^a]", "(ab)", "(a|bc)", "(abc|b)+", "a*", "(ab)?", "b{2}", "(?:ca){1,2}", "^", "$", r"\b", r"\w", "(?=b)", "c"]
PATTERN = st.lists(st.sampled_from(ATOMS), min_size=1, max_size=6).map("".join)
TEXT = st.text("abc ", max_size=14)


@settings(max_examples=400, deadline=None)
@given(PATTERN, TEXT, st.dictionaries(st.text("abc", min_size=1, max_size=3), st.integers(0, 5)))
def test_every_match_holds_a_gram_of_the_cover(pattern, text, held):
    try:
        tree = P.required(pattern)
    except re.error:
        return
    if tree is not None and re.search(pattern, text):
        assert any(g in text for g in P.cover(tree, held)[1])


def test_trees_and_covers():
    assert P.required("abcd") == ["and", "abc", "bcd"]
    assert P.required("Shewa (Zone)") == P.required("Shewa Zone")
    assert P.required("(ab|cd)x") == ["and", ["or", "ab", "cd"], "x"]
    assert P.required("[xy]") == ["or", "x", "y"]
    assert P.required(".*") is P.required("(a|)") is P.required("(?i)abc") is P.required("a?") is None
    assert P.cover(["and", "abc", ["or", "x", "y"]], {"abc": 9, "x": 2, "y": 3}) == (5, ["x", "y"])
    assert P.cover(["and", "abc", "zzz"], {"abc": 9}) == (0, ["zzz"])


SAME = [r"ab", r"a.c", r"a$", r"^a", r"(?P<x>a)(?P=x)", r"a\Z", r"[[a]", r"[]a]", r"[a&&b]", r"[^]a]", r"a{,2}b", r"a{x", r"{", r"}", r"a{2}", r"\w+\b", r"\d", r"é\w", r"a\vb", r"[\]a]", r"a|b$",
        r"(?s)a.b", r"(?m)^b", r"(?x) a b", r"\x41", r"\.", r"[a-c]+?d", r"(?:a|b)*c", r"a++b", r"(?>a+)b", r"(?<=a)b", r"(?<!a)b"]
TEXTS = ["", "a", "ab", "abc", "a\nb", "b\na", "aa", "[", "]", "&", "a{x", "{", "}", "éa", "É1", "٣", "a\x0bb", "A", "a\r\n", "a\n", "a b", "abcd", "a b", "aab", "\\", "^", "x]a"]


def test_patterns_mean_the_same_in_the_jvm(spark):
    rows = [(p, P.java_pattern(p), t) for p in SAME for t in TEXTS]
    assert all(j for _, j, _ in rows)
    df = spark.createDataFrame(rows, "p string, j string, t string").withColumn("hit", F.expr("rlike(t, j)"))
    wrong = [(r.p, r.t, r.hit) for r in df.collect() if r.hit != bool(re.search(r.p, r.t))]
    assert not wrong
    assert all(P.java_pattern(p) is None for p in ("(", "[a", "*a", "a**", "(?", r"\q", "(a)(?(1)b|c)", "a{99999999999}", "(" * 5000 + ")" * 5000))


COLS = ("continent", "country", "state_province", "county")


def plain(probes, authority):
    out = set()
    for irn, *probe in probes:
        if not any(probe):
            continue
        for key, *row in authority:
            same = all(not p or p == a for p, a in zip(probe[:3], row[:3]))
            if probe[3] and same:
                try:
                    same = row[3] is not None and re.search(probe[3], row[3]) is not None
                except re.error:
                    same = False
            if same:
                out.add((irn, key))
    return out


def frames(spark, probes, authority):
    return (spark.createDataFrame(probes, "irn long, " + ", ".join(f"{c} string" for c in COLS)).repartition(3),
            spark.createDataFrame(authority, "irn_eluts long, " + ", ".join(f"{c} string" for c in COLS)))


@pytest.mark.parametrize("limit", [0, 1000])
def test_the_join_equals_a_search_of_every_pair(spark, limit):
    rng = random.Random(limit)
    def field(n):
        return rng.choice(["", "x", "y"][:n])
    authority = [(i, field(3), field(3), field(3) or None, rng.choice([None, "", "(Zone)", *("".join(rng.choices("abc", k=rng.randrange(1, 9))) for _ in range(6))])) for i in range(150)]
    probes = [(i, field(3), field(2), field(2), rng.choice(["", "", "(", "[a-c]{3}", "a.c$", "(ab|bc)", "^", "abca", "b", "(Zone)", r"\(Zone\)", "a*"])) for i in range(200)]
    p, a = frames(spark, probes, authority)
    pairs = A.authority_candidates(p, a, county="regex", key_broadcast_rows=limit)
    assert "NestedLoop" not in pairs._jdf.queryExecution().toString() and "CartesianProduct" not in pairs._jdf.queryExecution().toString()
    got = [(r.irn, r.a_irn_eluts) for r in pairs.collect()]
    want = plain(probes, authority)
    assert len(got) == len(want) and set(got) == want
    counts = {r.irn: r.num_authority_matches for r in A.match_counts(p, a, county="regex", key_broadcast_rows=limit).collect()}
    assert counts == {i: sum(x == i for x, _ in want) for i, *_ in probes}


def test_a_name_in_brackets_differs_between_the_modes(spark, golden_authority):
    probes, _ = frames(spark, [(1, "", "", "", "Mirab Shewa (Zone)"), (2, "", "", "", r"Mirab Shewa \(Zone\)"), (3, "", "", "", "ikita"), (4, "", "", "", "Mirab (")], [(1, "", "", "", "")])
    literal, regex = ({r.irn: r.num_authority_matches for r in A.match_counts(probes, golden_authority, county=mode).collect()} for mode in ("literal", "regex"))
    assert literal == {1: 1, 2: 0, 3: 3, 4: 0} and regex == {1: 0, 2: 1, 3: 3, 4: 0}
    rows = {r.irn: (r.error, r.irn_eluts) for r in reconcile(probes, golden_authority, county="regex").collect()}
    assert rows["2"] == ("OK", "375150") and rows["4"][0] == "NO_ANSWER"


def test_no_probe_has_a_county(spark, golden_authority):
    probes, _ = frames(spark, [(1, "Africa", "", "", ""), (2, "", "", "", "")], [(1, "", "", "", "")])
    assert {r.irn: r.num_authority_matches for r in A.match_counts(probes, golden_authority, county="regex").collect()} == {1: 3, 2: 0}
