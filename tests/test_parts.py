"""Documents in parts give the chunks of the whole documents."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import chunking
from tessera.operators.chunking import Held, chunk_with_offsets, chunk_spans, fixed_chunks, recursive_chunks, token_length
from tessera.session import new_scratch_path
from tessera.sources import files

MARKS = ["\n", "\n\n", " ", "a", "bc", "é世", "word ", "\r\n"]


def texts(rng, n, longest):
    out = ["", "\n", "\n\n", "\n\n\n\n\n", "x" * 50, "a\n" * 9, " " * 20]
    for _ in range(n):
        some = rng.sample(MARKS, rng.randint(1, len(MARKS)))
        out.append("".join(rng.choice(some) * rng.choice([1, 1, 1, 2, 7]) for _ in range(rng.randint(1, longest))))
    return out


def cut(rng, text):
    """The text in parts of one character and more, as no part is empty but that of an empty text."""
    at = sorted(rng.sample(range(1, len(text)), min(len(text) - 1, rng.randint(0, 12)))) if len(text) > 1 else []
    return [text[a:b] for a, b in zip([0, *at], [*at, len(text)])]


@pytest.mark.parametrize("length", [len, token_length])
def test_the_splitter_of_parts_equals_that_of_the_text(length, monkeypatch):
    monkeypatch.setattr(chunking, "DROPPED", 3)
    rng = random.Random(1)
    for text in texts(rng, 1500, 60):
        size = rng.randint(1, 14)
        overlap = rng.randint(0, size - 1)
        held = Held(cut(rng, text))
        assert list(chunk_spans(held, size, overlap, length)) == chunk_with_offsets(text, size, overlap, length), (text, size, overlap)


def test_a_long_text_is_never_held():
    text = Held(f"line {i} of a text that has many\n" for i in range(200_000))
    most = n = 0
    for _ in chunk_spans(text, 300, 0):
        most, n = max(most, len(text.text)), n + 1
    assert n > 10_000 and most < 4 * chunking.DROPPED


def test_chunks_of_parts_equal_those_of_documents(spark):
    rng = random.Random(2)
    docs = [(i, f"s{i}", t) for i, t in enumerate(texts(rng, 60, 150))]
    parts = [(i, s, k, p) for i, s, t in docs for k, p in enumerate(cut(rng, t))]
    whole = spark.createDataFrame(docs, "doc_id long, source string, text string")
    cut_up = spark.createDataFrame(parts, "doc_id long, source string, part long, text string").coalesce(1)
    for size, overlap in ((30, 10), (7, 3), (5, 0)):
        for chunks in (fixed_chunks, recursive_chunks):
            got, want = (sorted(map(tuple, chunks(d, size, overlap, **kw).collect())) for d, kw in ((cut_up, {"part_col": "part"}), (whole, {})))
            assert got == want, (chunks, size, overlap)
    shuffled = fixed_chunks(cut_up.repartition(5), 30, 10, part_col="part")
    assert sorted(map(tuple, shuffled.collect())) == sorted(map(tuple, fixed_chunks(whole, 30, 10).collect()))


def test_parts_that_are_dealt_over_tasks_are_refused(spark):
    parts = spark.createDataFrame([(1, "s", 1, "b"), (1, "s", 0, "a")], "doc_id long, source string, part long, text string").coalesce(1)
    with pytest.raises(Exception, match="not in one task"):
        recursive_chunks(parts, 5, 0, part_col="part").collect()


def test_files_are_read_in_parts_of_bounded_size(spark):
    path = new_scratch_path(spark, "part-documents")
    text = "".join(f"row {i} é\n" + "\n" * (i % 3) for i in range(9_000))
    for name in "ab":
        spark.createDataFrame([(text + name,)], "value string").coalesce(1).write.text(f"{path}/file={name}")
    parts = files.read_text_documents(spark, path, "*.txt", part_bytes=4_096, recursive=True)
    assert parts.rdd.getNumPartitions() == 2  # a file is not dealt over tasks
    assert parts.agg(F.max(F.length("text"))).first()[0] <= 2 * 4_096 and parts.filter("part = 0").count() == 2
    whole = files.read_text_documents(spark, path, "*.txt", recursive=True)
    for chunks in (fixed_chunks, recursive_chunks):
        a, b = (chunks(d, 300, 100, **kw).withColumn("file", F.regexp_extract("source", "file=(.)", 1)) for d, kw in ((parts, {"part_col": "part"}), (whole, {})))
        rows = [sorted(tuple(r) for r in d.select("file", "chunk_no", "start_index", "chunk").collect()) for d in (a, b)]
        assert rows[0] == rows[1] and len(rows[0]) > 500


def test_file_ingest_holds_no_file(spark, tmp_path, monkeypatch):
    """Files of many parts, and the registered figures of whole files."""
    import __spark_entry__ as entry
    from tessera.plans import catalog
    read = []
    monkeypatch.setattr(catalog, "FILE_PART_BYTES", 2_000)
    plain = files.read_text_documents
    monkeypatch.setattr(files, "read_text_documents", lambda *a, **kw: read.append(plain(*a, **kw)) or read[-1])
    rng = random.Random(3)
    docs = [(i, t) for i, t in enumerate(texts(rng, 200, 400)) if "\r" not in t] + [(-3, "negative id"), (40_000, "x" * 5_000)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["file_ingest"](spark, str(tmp_path)).first()
    by_file = {}
    for i, t in docs:
        by_file.setdefault(i % 16 if i >= 0 else -(-i % 16), []).append(t)
    n = [sum(len(t) + 1 for t in f) for f in by_file.values()]
    assert tuple(got) == (len(n), sum(n), sum(max(x - 101, 0) // 200 + 1 for x in n), sum(len("".join(t.split())) for _, t in docs))
    assert read[0].agg(F.max(F.octet_length("text"))).first()[0] <= 2 * 2_000
