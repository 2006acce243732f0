"""Registered queries of the file source with planned partitions (see
``catalog`` for the contract of a query)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import replies as R
from ..functions.text import image_reference
from ..session import new_scratch_path, table
from ..sources import packed
from .catalog import FILE_DOCS, REQUEST_MODEL, REQUEST_PROMPT, query

PART_BYTES = 64 << 10  # nominal bytes of a row, so that files of the smallest tables are cut as well
IMAGE_KEYS = 64  # keys per image file


@query("file_parts", f"""SELECT doc_id // {FILE_DOCS} AS file, sum(strlen(t) + 1)::BIGINT AS n_bytes, sum(length(t) + 1)::BIGINT AS n_chars,
  sum(length(t) - length(replace(t, chr(10), '')) + 1)::BIGINT AS n_lines, 0::BIGINT AS n_gaps, 0::BIGINT AS n_long
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) d GROUP BY 1""")
def q_file_parts(spark, sf):
    """Documents written as files by ranges of ids and read as rows of bounded
    size: every byte, character and line of a file once, each part where the
    one before it ends, none longer than a part and a search window."""
    path = new_scratch_path(spark, "part-files")
    docs = table(spark, sf, "documents").select(F.expr(f"doc_id div {FILE_DOCS}").alias("file"), F.coalesce("text", F.lit("")).alias("text"))
    docs.repartition("file").write.partitionBy("file").text(path)
    parts = packed.read_text_parts(spark, path, "*.txt", row_bytes=PART_BYTES, recursive=True)
    facts = parts.select("source", "start", "length", F.length("text").alias("chars"),
                         (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).alias("lines"))
    before = F.lag(F.col("start") + F.col("length"), 1, 0).over(Window.partitionBy("source").orderBy("start"))
    return facts.withColumn("before", before).groupBy(F.regexp_extract("source", r"file=(\d+)", 1).cast("bigint").alias("file")).agg(
        F.sum("length").alias("n_bytes"), F.sum("chars").cast("bigint").alias("n_chars"), F.sum("lines").cast("bigint").alias("n_lines"),
        F.count_if(F.col("start") != F.col("before")).alias("n_gaps"), F.count_if(F.col("length") > 2 * PART_BYTES).alias("n_long"))


@query("image_requests_ranges", f"""SELECT file, length(content) AS n_bytes, 'data:image/jpeg;base64,' || to_base64(encode(content)) AS image_ref,
  '{{"model":' || to_json('{REQUEST_MODEL}'::VARCHAR) || ',"logprobs":false,"messages":[{{"role":"user","content":[{{"type":"text","temperature":"0.0","text":'
  || to_json('{REQUEST_PROMPT}'::VARCHAR) || '}},{{"type":"image_url","image_url":{{"url":"data:image/jpeg;base64,' || to_base64(encode(content)) || '"}}}}]}}],"max_tokens":4096}}' AS request
FROM (SELECT s_suppkey // {IMAGE_KEYS} AS file, string_agg(s_name || chr(10), '' ORDER BY s_suppkey) AS content FROM supplier GROUP BY 1) s""")
def q_image_requests_ranges(spark, sf):
    """``image_requests`` with a file per range of keys, so that the files grow
    in number and not in size, read in packed tasks."""
    path = new_scratch_path(spark, "image-files")
    rows = table(spark, sf, "supplier").select(F.expr(f"s_suppkey div {IMAGE_KEYS}").alias("file"), "s_suppkey", "s_name")
    rows.repartition("file").sortWithinPartitions("file", "s_suppkey").select("file", "s_name").write.partitionBy("file").text(path)
    files = packed.read_packed_binary(spark, path, "*.txt", recursive=True)
    ref = image_reference(F.lit("file"), F.col("path"), F.col("content"))
    return files.select(F.regexp_extract("path", r"file=(\d+)", 1).cast("bigint").alias("file"), F.col("length").alias("n_bytes"), ref.alias("image_ref"),
                        R.request_payload(F.lit(REQUEST_MODEL), F.lit(REQUEST_PROMPT), ref, F.lit(4096)).alias("request"))
