"""Hard negatives, ranked lexical search and line dedup against brute force on
small tables with nulls, empty and long texts, ties, repeated rows and
clashing extra columns, at parameters that split the work."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import hard_negatives, lexical, line_dedup

EXTRA = {"digest": "'q'", "TEXT": "'no'", "gone": "'1'", "keep_id": "8", "n": "9", "item": "3", "score": "4", "row": "5", "a": "6", "c": "7", "j": "8", "q": "'x'"}


def with_extra(df):
    have = {c.lower() for c in df.columns}
    return df.selectExpr("*", *[f"{v} AS {k}" for k, v in EXTRA.items() if k not in have or k == "TEXT"])


# ---- hard negatives

def test_residue_product():
    rng = np.random.default_rng(1)
    for size, dim in ((3, 1), (300, 64), (40_000, 130), (30_000_000, 16)):
        a, b = rng.integers(-size, size + 1, (7, dim)), rng.integers(-size, size + 1, (9, dim))
        bound = size * size * dim
        assert (hard_negatives.residue_product(a, b, hard_negatives.primes(bound)) == a @ b.T).all()
    edge = np.full((1, 64), 510)  # the largest residues of the largest prime
    assert hard_negatives.residue_product(edge, -edge, hard_negatives.primes(510 * 510 * 64))[0, 0] == -510 * 510 * 64
    with pytest.raises(ValueError):
        hard_negatives.primes(10 ** 800)


def mined(rows, is_anchor, k_pos=5, k_neg=5):
    whole = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows
             if None not in (i, v, lab) and all(x is not None and math.isfinite(x) for x in v)}
    out = Counter()
    for i, lab, q in whole:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), o, ol) for o, ol, p in whole if o != i)
        for s, o, _ in [t for t in scored if t[2] == lab][:k_pos]:
            near = [(-n, x) for n, x, xl in scored if xl != lab and 80 * -s <= 100 * -n <= 100 * -s][:k_neg]
            for r, (n, x) in enumerate(near, 1):
                out[i, o, r, x, -s, n] += 1
    return out


def test_hard_negatives(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, 0.25, 0.5, -0.3, 1.7]) for _ in range(6)], rng.randrange(3)) for i in range(220)]
    rows += [(300 + i, [0.5] * 6, i % 3) for i in range(40)] + [(300, [0.5] * 6, 0)] * 3  # ties, repeated rows
    rows += [(400, None, 1), (401, [1.0, None], 1), (402, [float("nan")] * 6, 1), (403, [float("inf")] * 6, 2), (404, [0.5] * 6, None), (None, [0.5] * 6, 1),
             (405, [0.5, 0.5], 2), (406, [], 1), (407, [0.0] * 6, 1), (10, [0.25] * 6, 2)]
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 60)  # several blocks of both sides
    monkeypatch.setattr(hard_negatives, "STRIP_ROWS", 7)
    for parts in (1, 5):
        df = with_extra(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(parts))
        got = hard_negatives.mine(df, F.col("vec_id") % 2 == 0).collect()
        cols = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        assert Counter(tuple(r[c] for c in cols) for r in got) == mined(rows, lambda i: i % 2 == 0)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(none, F.col("vec_id") % 2 == 0).count() == 0
    with pytest.raises(ValueError):
        hard_negatives.mine(spark.createDataFrame([(0, [1e9], 1)], "vec_id long, embedding array<double>, label int"), F.lit(True))


# ---- ranked lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(items, docs, k=10):
    cut = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, n_terms = len(cut), sum(sum(c.values()) for _, c in cut)
    df = Counter(t for _, c in cut for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(words(t))
    out = set()
    for i, ts in asked.items():
        scored = []
        for d, c in cut:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if s > 0:
                scored.append((-s, d is None, d))
        out |= {(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)}
    return out


@pytest.mark.parametrize("parts, block, group", [(1, 4096, 1 << 22), (4, 40, 1 << 22), (3, 300, 200)])
def test_lexical(spark, monkeypatch, parts, block, group):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["É", "é", "日本", "İ", "ß"]
    weight = [1 / (i + 1) for i in range(len(vocab))]
    docs = [(i, " ".join(rng.choices(vocab, weight, k=rng.randrange(1, 60)))) for i in range(700)]
    docs += [(800, None), (801, ""), (802, " ,;"), (803, "w1 " * 30_000), (804, "W50 w50,w50\x00w51 w52"), (None, "w55 w56 w57"), (805, "w55 w56 w57"), (805, "w55 w56 w57"),
             *[(900 + i, "w58 w59") for i in range(30)]]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(1, 12)))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "absent"), (33, "w58"), (34, "W55!w56"), (34, "w57"), (None, "w0 w1"), (35, "w0")]
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "SPAN", 8)
    monkeypatch.setattr(lexical, "WALK", 2)
    frame = with_extra(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts))
    asked = with_extra(spark.createDataFrame(items, "item_id long, text string").repartition(2))
    got = lexical.rank(asked, frame, group_bytes=group).collect()
    assert {(r.item_id, r["rank"], r.doc_id, r.score) for r in got} == ranked(items, docs)
    assert len(got) == len({(r.item_id, r["rank"]) for r in got})


def test_lexical_empty(spark):
    none, some = spark.createDataFrame([], "doc_id long, item_id long, text string"), spark.createDataFrame([(1, 1, "a b")], "doc_id long, item_id long, text string")
    assert lexical.rank(none, some).count() == lexical.rank(some, none).count() == 0
    assert [tuple(r) for r in lexical.rank(some, some).collect()] == [(1, 1, 1, r.score) for r in lexical.rank(some, some).collect()]


# ---- line dedup

def kept(rows):
    def keys(text):
        return ["".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r")) for x in (text or "").split("\n")]
    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for key in keys(t):
                holders[key].add(i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        stays = [x for x, key in zip(lines, keys(t)) if i is None or len(key) < 10 or len(holders[key]) < 2 or min(holders[key]) == i]
        out[i, len(lines), len(lines) - len(stays), hashlib.sha256("\n".join(stays).encode()).hexdigest()] += 1
    return out


LINES = [f"a line of text {i}" for i in range(40)] + ["short", "", "123456789", "1234567890", "  Padded LINE\t\r", "padded line xx", " padded line", "ÀÉ ten chars", "àé ten chars", "👍" * 9, "👍" * 10]


@pytest.mark.parametrize("parts, slice_bits", [(1, 1 << 29), (5, 1 << 29), (3, 1 << 14)])
def test_line_dedup(spark, monkeypatch, parts, slice_bits):
    rng = random.Random(7)
    rows = [(i, "\n".join(rng.choice(LINES) for _ in range(rng.randrange(1, 9)))) for i in range(200)]
    rows += [(i, f"{i} a unique line of text\nthe line that everyone holds\n" + "x" * 50_000 + str(i)) for i in range(200, 300)]  # a hot line, long lines
    rows += [(400, None), (401, ""), (402, "\n\n"), (403, "THE same line\nthe same line"), (403, "the SAME line\nother words here"), (404, "the same line "), (404, "the same line "),
             (None, "the same line\nkept"), (None, "only without an id"), (405, "only without an id"), (406, "\n".join(f"line number {i} of many" for i in range(3000))),
             (407, "\n".join(f"LINE number {i} of many" for i in range(0, 6000, 2)))]
    monkeypatch.setattr(line_dedup, "SLICE_BITS", slice_bits)
    df = with_extra(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts))
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.digests(df).collect())
    assert got == kept(rows)
    assert line_dedup.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_filters_find_every_repeat_and_little_else(spark):
    """Every digest held twice is a suspect; of the others about two in a hundred."""
    rows = spark.range(60_000).selectExpr("id AS doc_id", "concat('the line of number ', CASE WHEN id < 2000 THEN id % 1000 ELSE id END) AS text")
    digests = rows.select("doc_id", F.explode(line_dedup.line_digests(F.col("text"))).alias("digest")).repartition(6).sortWithinPartitions("digest")
    digests = line_dedup.materialize(digests, "test-digests")
    found = {r.doc_id for r in line_dedup.suspects(digests, line_dedup.Layout(60_000)).collect()}
    assert set(range(2000)) <= found and len(found) < 2000 + 0.03 * 58_000
