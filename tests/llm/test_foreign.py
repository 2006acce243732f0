"""The language stage lets no text of an unknown script or junk through."""

import pytest

from tessera.llm import langid

SF = "/root/testdata/sf0.001"
FOREIGN = ["Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
           "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
           "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα",
           "x9$#@ zzqk vvxw kkjq 8827 qqzx wvkj zxqv jjkw qzvx kqzw xvjz 77#@ qqkx zvvw xxqj kzzq"]


def _plain_familiarity(text, marks):
    def plain(t):
        t = t.lower()
        return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    g = plain(text)
    return max((len(g & m) + langid.PRIOR) / (min(len(g), len(m)) + langid.PRIOR) for m in map(plain, marks))


def test_foreign_texts_go_and_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = {r.doc_id for r in docs.collect() if r.text and langid.LETTER.search(r.text)}
    names = docs.columns
    odd = [{"doc_id": -k - 1, "text": t} for k, t in enumerate([*FOREIGN, "ok", "ß", "", "12 34", None])]
    more = spark.createDataFrame([tuple(o.get(n) for n in names) for o in odd], docs.schema)
    got = {r.doc_id for r in langid.accepted(docs.unionByName(more)).collect()}
    assert got == clean | {-len(FOREIGN) - 1, -len(FOREIGN) - 2}


def test_familiarity_equals_plain_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labelled = langid.sample(docs)
    model = langid.fit(labelled)
    taken, marks = {}, []
    for lang, t in labelled:
        if langid.LETTER.search(t) and taken.get(lang, 0) < langid.LANDMARKS:
            taken[lang] = taken.get(lang, 0) + 1
            marks.append(t)
    texts = [t for _, t in langid.sample(docs, held=True)][:20] + FOREIGN + ["a"]
    for t, f in zip(texts, model.judge(texts)[2], strict=True):
        assert f == pytest.approx(_plain_familiarity(t, marks), abs=1e-4)


def test_no_labels_held_out_reject_nothing_foreign():
    model = langid.fit([("a", "one two three"), ("b", "uno dos tres")])
    assert langid.familiar_floor(model, []) == langid.familiar_floor(model, [("a", "123")]) == 0.0
    assert langid.familiar_floor(langid.fit([]), [("a", "abc")]) == 0.0
    assert 0 < langid.familiar_floor(model, [("a", "two three four")]) < 1


def test_the_floor_is_of_every_text_held_out(spark, monkeypatch):
    """More held-out texts than a sample holds: all of them set the floor,
    copies once."""
    monkeypatch.setattr(langid, "SAMPLE", 5)
    words = ["one two three four", "uno dos tres cuatro"]
    rows = [(i, f"{words[i % 2]} {'xyzw'[i % 4] * (i % 7)} {i % 50}", "ab"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(langid.sample(docs))
    held = {r.text for r in docs.filter(langid.held_out(docs.doc_id)).collect()}
    assert len(held) > 2 * langid.SAMPLE
    seen = sorted(model.judge(sorted(held))[2])
    assert langid.held_out_floor(docs, model) == pytest.approx(langid.MARGIN * seen[int((len(seen) - 1) * langid.QUANTILE)], abs=1e-6)
    assert langid.held_out_floor(docs.filter("doc_id < 0"), model) == 0.0
