from tessera.operators import chunking as C
from tessera.operators import textcheck as X


def _contract(text, size, overlap):
    chunks = C.chunk_with_offsets(text, size, overlap)
    for start, ch in chunks:
        assert len(ch) <= size
        assert text[start:start + len(ch)] == ch
        assert ch == ch.strip() and ch
    return chunks


def test_recursive_splitter_contract():
    text = ("Para one line one.\nPara one line two is a bit longer.\n\n" * 8
            + "x" * 700 + "\n\nlast words " * 20)
    chunks = _contract(text, 100, 30)
    assert any(len(ch) == 100 for _, ch in chunks)  # the unbroken run is cut at the size
    assert chunks[0][0] == 0
    starts = [s for s, _ in chunks]
    assert starts == sorted(starts)


def test_recursive_splitter_prefers_coarse_separators():
    text = "aaaa bbbb\n\ncccc dddd"
    assert [c for _, c in C.chunk_with_offsets(text, 12, 0)] == ["aaaa bbbb", "cccc dddd"]
    # the separator stays at the start of the next piece (" w3" is 3 long),
    # so "w3" + " w4" is 6 > 5 and they stay apart
    assert [c for _, c in C.chunk_with_offsets("w1 w2 w3 w4", 5, 0)] == ["w1 w2", "w3", "w4"]
    assert [c for _, c in C.chunk_with_offsets("w1 w2 w3 w4", 6, 0)] == ["w1 w2", "w3 w4"]


def test_recursive_chunks_on_spark(spark):
    docs = spark.createDataFrame([(1, "s", "one two three four five six seven")], "doc_id long, source string, text string")
    rows = C.recursive_chunks(docs, 10, 4).orderBy("chunk_no").collect()
    text = "one two three four five six seven"
    for r in rows:
        assert text[r["start_index"]:r["start_index"] + len(r["chunk"])] == r["chunk"]


def test_fixed_chunks_cover_text(spark):
    docs = spark.createDataFrame([(1, "s", "abcdefghij" * 7)], "doc_id long, source string, text string")
    rows = C.fixed_chunks(docs, 30, 10).orderBy("chunk_no").collect()
    assert [r["start_index"] for r in rows] == [0, 20, 40]
    assert "".join(r["chunk"][:20] for r in rows[:-1]) + rows[-1]["chunk"] == "abcdefghij" * 7


def test_fixed_chunks_of_every_length_and_of_a_long_text(spark):
    texts = [None, *("é" * n for n in range(0, 140)), "".join(chr(97 + i * i % 23) for i in range(300_000))]
    docs = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], "doc_id long, source string, text string")
    got = {(r.doc_id, r.chunk_no): (r.start_index, r.chunk) for r in C.fixed_chunks(docs, 30, 10).collect()}
    want = {}
    for i, t in enumerate(texts):
        for no, at in enumerate(range(0, max(len(t or "") - 10, 1), 20)):
            want[i, no] = (at, None if t is None else t[at:at + 30])
    assert got == want


def test_xml_check(spark):
    df = spark.createDataFrame([(1, "<a><b/></a>"), (2, "<a><b></a>")], "id long, x string")
    out = {r["id"]: r for r in X.xml_quality(df, "id", "x").collect()}
    assert out[1]["valid"] and out[1]["message"] == "The XML is well-formed."
    assert not out[2]["valid"] and out[2]["message"].startswith("XML is not well-formed: mismatched tag")


def test_char_census_counts_code_points(spark):
    df = spark.createDataFrame([("aé😀a",)], "text string")
    got = {r["code_point"]: r["n"] for r in X.char_census(df).collect()}
    assert got == {97: 2, 233: 1, 128512: 1}


def test_recursive_chunks_cover_whole_documents(spark):
    """Whole driver table: every chunk fits, sits at its offset, offsets never
    go back, and whatever no chunk covers (between chunks, before the first,
    after the last) is whitespace only - no text is lost."""
    from pyspark.sql import functions as F
    from pyspark.sql.window import Window

    from tessera.session import table
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "source", "text")
    ch = C.recursive_chunks(docs, 300, 100)
    j = ch.join(docs.select("doc_id", "text"), "doc_id")
    w = Window.partitionBy("doc_id").orderBy("chunk_no")
    end = F.col("start_index") + F.length("chunk")
    x = j.withColumn("prev_end", F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))) \
         .withColumn("prev_start", F.lag("start_index").over(w)) \
         .withColumn("last", F.col("chunk_no") == F.max("chunk_no").over(Window.partitionBy("doc_id")))
    gap = F.when(F.col("prev_end").isNull(), F.substring("text", 1, F.col("start_index"))) \
        .otherwise(F.expr("substring(text, prev_end + 1, greatest(start_index - prev_end, 0))"))
    tail = F.when(F.col("last"), F.expr("substring(text, start_index + length(chunk) + 1)")).otherwise(F.lit(""))
    bad = x.filter((F.length("chunk") > 300)
                   | (F.expr("substring(text, start_index + 1, length(chunk))") != F.col("chunk"))
                   | (F.col("prev_start").isNotNull() & (F.col("start_index") < F.col("prev_start")))
                   | (F.trim(gap, F.lit(" \t\r\n")) != "") | (F.trim(tail, F.lit(" \t\r\n")) != ""))
    assert bad.count() == 0
    # every document with visible text has chunks
    covered = ch.select("doc_id").distinct().count()
    assert covered == docs.filter(F.trim(F.col("text"), F.lit(" \t\r\n")) != "").count()


def test_the_splitter_holds_one_window_of_a_long_text():
    """Chunks of a long text come one by one: no list of all its units."""
    import itertools
    import tracemalloc
    text = "ab cd\n" * 400_000
    tracemalloc.start()
    some = list(itertools.islice(C.chunk_spans(text, 300, 100), 1_000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(some) == 1_000 and peak < 4 << 20
    assert all(text.startswith(chunk, at) and len(chunk) <= 300 for at, chunk in some)


def test_chunks_leave_a_task_in_bounded_batches():
    import pyarrow as pa
    docs = pa.RecordBatch.from_pydict({"doc_id": [1, 2, None], "source": ["s", "s", None], "text": ["ab cd\n" * 100_000, None, "x y"]})
    got = list(C._cut_batches(30, 0, len)(iter([docs])))
    assert max(b.num_rows for b in got) == C.OUT_ROWS and len(got) > 2
    assert {i for b in got for i in b.column(0).to_pylist()} == {1, None}
