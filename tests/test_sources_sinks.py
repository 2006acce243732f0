import os

import pytest

from pyspark.sql import functions as F

from tessera.operators.rows import first_rows
from tessera.session import new_scratch_path
from tessera.sinks import files as sinks
from tessera.sources import files as sources


def test_text_directory_documents_top_folder_only(spark):
    d = new_scratch_path(spark, "docs")
    os.makedirs(os.path.join(d, "sub"))
    with open(os.path.join(d, "a.md"), "w") as f:
        f.write("line one\n\nline two")
    with open(os.path.join(d, "b.txt"), "w") as f:
        f.write("not markdown")
    with open(os.path.join(d, "sub", "c.md"), "w") as f:
        f.write("nested")
    rows = sources.read_text_documents(spark, d, "*.md").collect()
    assert len(rows) == 1
    assert rows[0]["text"] == "line one\n\nline two" and rows[0]["source"].endswith("a.md")


def test_csv_rows_as_documents(spark):
    df = spark.createDataFrame([(7, "Asia", None)], "irn_eluts long, Continent string, County string")
    plain = sources.csv_rows_as_documents(df, "auth.csv", "irn_eluts").first()
    labelled = sources.csv_rows_as_documents(df, "auth.csv", "irn_eluts", labelled=True).first()
    assert plain["text"] == "7\nAsia\n"
    assert labelled["text"] == "irn_eluts: 7\nContinent: Asia\nCounty: "
    assert plain["doc_id"] == 7 and plain["source"] == "auth.csv"


def test_binary_files_base64_without_breaks(spark):
    import base64
    d = new_scratch_path(spark, "bin")
    os.makedirs(d)
    payload = bytes(range(256)) * 3
    with open(os.path.join(d, "x.jpg"), "wb") as f:
        f.write(payload)
    r = sources.read_binary_files(spark, d, "*.jpg").first()
    assert r["b64"] == base64.b64encode(payload).decode()


def test_csv_sink_round_trip_keeps_empty_strings(spark):
    df = spark.createDataFrame([(1, "", None, 'q"uote')], "id long, e string, n string, q string")
    path = new_scratch_path(spark, "out")
    sinks.write_csv(df, path, keys=["id", "q", "e", "n"])
    back = sources.read_csv_table(spark, path, "id long, q string, e string, n string", multiline=False, keep_empty=True)
    assert back.columns == ["id", "q", "e", "n"]
    r = back.first()
    assert (r["q"], r["e"], r["n"]) == ('q"uote', "", None)


def test_batch_writes_and_first_rows(spark):
    df = spark.range(45).withColumnRenamed("id", "irn")
    path = new_scratch_path(spark, "batches")
    sinks.write_batches(df, path, "irn", 20)
    counts = {r["batch_no"]: r["count"] for r in spark.read.parquet(path).groupBy("batch_no").count().collect()}
    assert counts == {1: 20, 2: 20, 3: 5}
    assert [r[0] for r in first_rows(df, ["irn"], 3).collect()] == [0, 1, 2]
    assert first_rows(df, ["irn"], None).count() == 45
    assert sinks.stamped_path("out", "proj", "2024-05-18T06-53-26", 20) == "out/proj_2024-05-18T06-53-26-20.csv"


def test_spread_deals_out_small_inputs_only(spark, monkeypatch):
    from tessera import session
    target = spark.sparkContext.defaultParallelism
    one = new_scratch_path(spark, "one-file")
    spark.range(0, 1000, numPartitions=1).write.parquet(one)
    small = spark.read.parquet(one)
    assert session.spread(small).rdd.getNumPartitions() == target
    monkeypatch.setattr(session, "SPREAD_BYTES", 1)  # a large input: more planned bytes than the bound
    assert session.spread(small) is small


def test_csv_columns_are_taken_by_name(spark):
    path = new_scratch_path(spark, "wide-csv")
    spark.createDataFrame([("1", "junk", "China", "Asia"), ("x", "j", "NULL", "")], "irn string, extra string, country string, continent string").coalesce(1).write.option("header", True).csv(path)
    got = sources.read_csv_table(spark, path, "irn bigint, continent string, country string", multiline=False, bad_cells="bad").orderBy(F.col("irn").desc()).collect()
    assert [tuple(r) for r in got] == [(1, "Asia", "China", []), (None, None, None, ["irn"])]
    with pytest.raises(ValueError):
        sources.read_csv_table(spark, path, "irn bigint, nowhere string", multiline=False)


def test_file_documents_can_be_chunked(spark):
    from tessera.operators.chunking import fixed_chunks, recursive_chunks, token_length
    path = new_scratch_path(spark, "md-chunks")
    spark.createDataFrame([("one two three " * 60,)], "value string").coalesce(1).write.text(path)
    docs = sources.read_text_documents(spark, path, "*.txt")
    for chunks in (fixed_chunks(docs, 100, 20), recursive_chunks(docs, 100, 20), recursive_chunks(docs, 12, 3, length=token_length)):
        rows = chunks.collect()
        text = docs.first()["text"]
        assert len(rows) > 5 and len({r["chunk_id"] for r in rows}) == len(rows)
        assert all(text[r["start_index"]:r["start_index"] + len(r["chunk"])] == r["chunk"] for r in rows)


def test_files_grow_with_the_documents(spark, tmp_path):
    import __spark_entry__ as entry
    spark.range(2_000).selectExpr("id AS doc_id", "concat('text ', id) AS text").write.parquet(str(tmp_path / "documents.parquet"))
    r = entry.queries()["file_ingest_ranges"](spark, str(tmp_path)).first()
    assert r.n_docs == 8 and r.n_chars == sum(len(f"text {i}") + 1 for i in range(2_000)) and r.recursive_chars == r.n_chars - 2 * 2_000
