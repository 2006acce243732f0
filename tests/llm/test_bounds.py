"""Bounded state: results do not depend on group sizes, table limits or slices."""

import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from test_operators import brute_repeats

from tessera.llm import ann, exact_dedup, langid, pieces, suffix_dedup

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _rows(words, block):
    raw = [w.encode() for w in words]
    return block, block % 3, pieces._unpack(pieces._pack(np.arange(len(raw), dtype="<u4"), np.array([len(w) for w in raw], "<u4"), b"".join(raw)))


def test_segments_are_equal_whatever_the_table_holds(spark, monkeypatch):
    words = [[" a", " word", "\nline", " Überzahl", " 日本語"], [" word", " other", " \ufb01n", " a"], [], [" word", " a", "\nline"]]
    groups = [_rows(w, k) for k, w in enumerate(words) if w]

    def out(size, known):
        monkeypatch.setattr(pieces, "KNOWN_BYTES", known)
        table = pieces._Segments(MODEL)
        return [b.to_pylist()[0] for at in range(0, len(groups), size) for b in table.ids_of(groups[at:at + size])]
    want = out(3, 1 << 30)
    assert [r["block"] for r in want] == [0, 1, 3]
    assert out(1, 1 << 30) == out(1, 0) == out(2, 0) == want


def test_groups_hold_every_row_in_order(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(pieces, "GROUP_BYTES", 20)
    monkeypatch.setattr(pieces, "_unpack", lambda raw: [b"", b"", raw])
    rows = [(pa.scalar(k), pa.scalar(0), pa.scalar(b"x" * n)) for k, n in enumerate([0, 30, 5, 5, 15, 1])]
    groups = list(pieces._groups(iter(rows)))
    assert [[r[0] for r in g] for g in groups] == [[0, 1], [2, 3, 4], [5]]
    assert list(pieces._groups(iter([]))) == []


def test_language_scores_equal_a_plain_kernel_ridge(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labelled = langid.sample(docs)
    model = langid.fit(labelled)
    langs = sorted({x for x, _ in labelled})

    def plain(text):
        t = text.lower()
        return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    marks = []
    for lang in langs:
        marks += [plain(t) for x, t in labelled if x == lang and any(c.isalpha() for c in t)][:langid.LANDMARKS]

    def row(g):
        return [len(g & m) / math.sqrt(max(1, len(g)) * len(m)) for m in marks]
    k = np.array([row(plain(t)) for _, t in labelled])
    own = np.array([row(m) for m in marks])
    y = np.array([[1.0 if x == lang else -1.0 for lang in langs] for x, _ in labelled])
    w = np.array([len(labelled) / (len(langs) * sum(x == z for z, _ in labelled)) for x, _ in labelled])[:, None]
    # the same ridge problem in the landmarks' own coordinates
    alpha = np.linalg.pinv(k.T @ (w * k) + langid.RIDGE * own, rcond=1e-12, hermitian=True) @ (k.T @ (w * y))
    asked = [r for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)]
    got = {r.doc_id: r for r in langid.languages(docs).collect()}
    assert len(asked) > 100
    for r in asked:
        s = np.array(row(plain(r.text))) @ alpha
        assert got[r.doc_id].score == pytest.approx(min(1, max(0, (s.max() + 1) / 2)), abs=2e-3)
        if np.sort(s)[-1] - np.sort(s)[-2] > 1e-2:
            assert got[r.doc_id].lang_pred == langs[int(s.argmax())]


@pytest.mark.parametrize("slices", [1, 3, 64])
def test_the_sample_is_equal_for_any_slices_and_partitions(spark, monkeypatch, slices):
    rows = [(i, f"text {i % 400} of many words", "ab"[i % 2]) for i in range(900)] + [(1000, "x" * 30_000, "c"), (1001, "short c", "c")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "SAMPLE", 40)
    want = {}
    for i, t, lang in rows:
        if not np.any([langid_held(i)]):
            want.setdefault(lang, set()).add(t)
    monkeypatch.setattr(langid, "SLICES", slices)
    got = langid.sample(d.repartition(7))
    assert got == langid.sample(d.coalesce(1))
    for lang, texts in want.items():
        mine = [t for x, t in got if x == lang]
        assert len(mine) == len(set(mine)) == min(40, len(texts)) and set(mine) <= texts


def langid_held(i):
    from zlib import crc32
    return crc32(str(i).encode()) % 4 == 2


def test_dedup_shuffles_the_texts_once(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = exact_dedup.drop_duplicates(d)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the texts by digest, the digests by digest, and the few rows of hot digests
    assert plan.count("Exchange hashpartitioning") == 3, plan


def test_exact_dedup_keeps_one_of_repeated_ids_and_null_ids(spark):
    rows = [(5, "A"), (5, "a"), (5, "A"), (None, "a"), (None, "b"), (None, "B"), (7, None), (8, "")] * 3
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = sorted((r.text.lower() if r.text else "", r.doc_id) for r in exact_dedup.drop_duplicates(d).collect())
    assert out == [("", 8), ("a", 5), ("b", None)]


def test_search_verifies_part_of_the_vectors():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((4000, 64)) + 1.5 * rng.standard_normal((10, 64))[rng.integers(0, 10, 4000)]
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, met = x[::20], []
    found = ann.search(x, np.arange(len(x)), q, 1.0, 21, met)
    exact = np.argsort(-(q @ x.T), axis=1)[:, :21]
    recall = np.mean([len(set(r.tolist()) & set(e.tolist())) / 21 for (r, _), e in zip(found, exact, strict=True)])
    assert recall >= 0.9 and len(met) == len(q) and np.mean(met) < 0.6 * len(x)


def test_search_verifies_a_falling_share_of_the_vectors():
    # without structure each query verified half of 10,000 vectors
    rng, shares = np.random.default_rng(5), []
    x = rng.standard_normal((10_000, 64)) + 0.5 * rng.standard_normal((10, 64))[rng.integers(0, 10, 10_000)]
    x /= np.linalg.norm(x, axis=1)[:, None]
    for n in (2_500, 10_000):
        q, met = x[:n:50], []
        found = ann.search(x[:n], np.arange(n), q, 1.0, 21, met)
        exact = np.argsort(-(q @ x[:n].T), axis=1)[:, :21]
        assert np.mean([len(set(r.tolist()) & set(e.tolist())) / 21 for (r, _), e in zip(found, exact, strict=True)]) >= 0.9
        assert all((s == np.einsum("nd,d->n", x[r], v)).all() and (np.diff(s) <= 0).all() and len(set(r.tolist())) == 21 for (r, s), v in zip(found, q, strict=True))
        shares.append(np.mean(met) / n)
    assert shares[1] < 0.35 and shares[1] < 0.8 * shares[0], shares


def test_search_refuses_the_leaves_of_far_clusters():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((64, 32))[np.arange(6_400) % 64] + 0.02 * rng.standard_normal((6_400, 32))
    q, met = x[::40], []
    found = ann.search(x, np.arange(len(x)), q, float(np.linalg.norm(x, axis=1).max()), 21, met)
    exact = np.argsort(-(q @ x.T), axis=1)[:, :21]
    assert np.mean([len(set(r.tolist()) & set(e.tolist())) / 21 for (r, _), e in zip(found, exact, strict=True)]) >= 0.9
    assert len(met) == len(q) and np.mean(met) < 0.15 * len(x)


def test_search_of_fewer_vectors_than_wanted_finds_each_once():
    x = np.random.default_rng(7).standard_normal((150, 8))
    found = ann.search(x, np.arange(150), x[:3], float(np.linalg.norm(x, axis=1).max()), 200)
    assert all(sorted(r.tolist()) == list(range(150)) for r, _ in found)


def _thue_morse(bits, pair):
    word = [0]
    for _ in range(bits):
        word += [1 - x for x in word]
    return bytes(pair[x] for x in word)


@pytest.mark.parametrize("pair", [b"ab", b"\x00\xff", b"\n "])
def test_patterned_texts_have_different_names(pair):
    one, other = _thue_morse(12, pair), _thue_morse(12, pair[::-1])
    for salt in (suffix_dedup.CORE, suffix_dedup.FULL):
        a, b = (suffix_dedup.Names(np.frombuffer(x, np.uint8), salt) for x in (one, other))
        for size in (8, 64, 400, 1024, 4096):
            lo, hi = np.array([0]), np.array([size])
            x, y = int(a.of(lo, hi)[0]), int(b.of(lo, hi)[0])
            assert x != y and (x ^ y) & 0xFFFFFFFF and (x ^ y) >> 32
    again = suffix_dedup.Names(np.frombuffer(b"12345" + one, np.uint8))
    assert again.of(np.array([5]), np.array([405]))[0] == suffix_dedup.Names(np.frombuffer(one, np.uint8)).of(np.array([0]), np.array([400]))[0]


def test_patterned_texts_are_cut_as_by_brute_force(spark):
    texts = [_thue_morse(10, b"ab").decode(), _thue_morse(10, b"ba").decode(), "x" + _thue_morse(9, b"ab").decode(), "a" * 7, "é" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(df).collect()}
    assert [got[i] for i in range(len(texts))] == list(brute_repeats(texts, 400))
