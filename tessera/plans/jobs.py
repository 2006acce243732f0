"""Composed jobs: place rows -> retrieval prompts -> status rows, and
reconcile rows built from a table of model replies.

The remote model is outside this library: a job gives the prompts it would be
sent, and takes a table of its replies (``irn, reply``; one row per prompt).
``nearest_replies`` stands in for it with the best hit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import replies as R
from ..functions.text import PLACE_FIELDS, PLACE_TEMPLATE, RECONCILE_TEMPLATE, RETRIEVE_INSTRUCTION, fill_template, instruction_text, predicate_text, question_text
from ..operators.authority import candidate_lists, match_counts
from ..operators.chunking import recursive_chunks
from ..sources.files import csv_rows_as_documents
from .reconcile import RESULT_COLS
from .retrieve import context_rows, hits_for

REPLY_KEYS = ("irn_eluts", *PLACE_FIELDS)
# Result columns of the retrieval job in their order.
RETRIEVE_COLS = ("irn", "error", "irn_eluts", "continent", "country", "state_province", "county", "error_output")


def row_chunks(authority: DataFrame, size: int = 300, source: str = "authority") -> DataFrame:
    """Every authority row as a labelled document, cut without overlap."""
    return recursive_chunks(csv_rows_as_documents(authority, source, "irn_eluts", labelled=True), size, 0)


def place_hits(probes: DataFrame, chunks: DataFrame, k: int = 3, dim: int = 64, **kw) -> DataFrame:
    """The k nearest chunks of each place row (``query_id`` is its irn)."""
    questions = probes.select(F.col("irn").alias("query_id"), question_text(*PLACE_FIELDS).alias("text"))
    return hits_for(questions, chunks, k, dim, **kw)


def place_prompts(probes: DataFrame, hits: DataFrame, min_relevance: float = 0.5) -> DataFrame:
    """One row per place row: hit count, best relevance, low-confidence flag
    and the prompt that holds the hits as context."""
    rows = probes.join(context_rows(hits).withColumnRenamed("query_id", "irn"), "irn", "left")
    prompt = fill_template(PLACE_TEMPLATE, F.coalesce("context", F.lit("")), instruction_text(*PLACE_FIELDS, template=RETRIEVE_INSTRUCTION))
    return rows.select("irn", F.coalesce("n_hits", F.lit(0)).alias("n_hits"), "best_relevance",
                       F.coalesce(F.col("best_relevance") < min_relevance, F.lit(True)).alias("low_confidence"), prompt.alias("prompt"))


def nearest_replies(hits: DataFrame, authority: DataFrame) -> DataFrame:
    """irn, reply: the authority row of the best hit, as the JSON asked for."""
    row = F.struct(F.col("irn_eluts").cast("string").alias("irn_eluts"), *[F.coalesce(F.col(f), F.lit("")).alias(f) for f in PLACE_FIELDS])
    best = hits.filter("rk = 1").select(F.col("query_id").alias("irn"), F.col("doc_id").alias("irn_eluts"))
    return best.join(authority, "irn_eluts").select("irn", F.to_json(row).alias("reply"))


def answered_rows(probes: DataFrame, replies: DataFrame) -> DataFrame:
    """Status rows of the retrieval job.  A row without a usable reply holds
    'none' in its place fields and the reply as it came; a missing reply is
    an invalid one."""
    rows = probes.select("irn").join(replies, "irn", "left").withColumn("cleaned", R.clean_reply(F.coalesce("reply", F.lit(""))))
    rows = rows.withColumn("error", R.reply_status("cleaned")).withColumn("f", R.reply_fields("cleaned", REPLY_KEYS))
    ok = F.col("error") == R.STATUS_OK
    fields = [F.when(ok, F.col(f"f.{k}")).otherwise(F.lit("none")).alias(k) for k in REPLY_KEYS]
    output = F.when(ok, F.lit("NA")).otherwise(F.coalesce("reply", F.lit(""))).alias("error_output")
    return rows.select(F.col("irn").cast("string").alias("irn"), "error", *fields, output).select(*RETRIEVE_COLS)


def reconcile_prompts(probes: DataFrame, authority: DataFrame, cap: int, **kw) -> DataFrame:
    """irn, num_authority_matches, prompt: the best ``cap`` candidates as
    context before the instruction; no prompt for a row without candidates."""
    lists = candidate_lists(probes, authority, cap, **kw)
    prompt = fill_template(RECONCILE_TEMPLATE, "candidates", instruction_text(*PLACE_FIELDS))
    return lists.select("irn", "num_authority_matches", F.when(F.col("num_authority_matches") > 0, prompt).alias("prompt"))


def reconcile_replies(probes: DataFrame, authority: DataFrame, replies: DataFrame, allow_nan: bool = False, **kw) -> DataFrame:
    """Result rows of the reconcile job from a table of replies.  A row without
    candidates was never asked and has no answer; one whose reply is missing
    or unreadable keeps its input place fields and the cleaned reply."""
    rows = match_counts(probes, authority, **kw).join(replies, "irn", "left")
    asked = F.col("num_authority_matches") > 0
    rows = rows.withColumn("cleaned", F.when(asked, R.clean_reply(F.coalesce("reply", F.lit("")))).otherwise(F.lit("{}")))
    rows = rows.withColumn("error", R.reply_status("cleaned", allow_nan)).withColumn("f", R.reply_fields("cleaned", REPLY_KEYS))
    ok = F.col("error") == R.STATUS_OK
    return rows.select(
        F.when(ok, F.col("f.irn_eluts")).otherwise(F.lit("none")).alias("irn_eluts"),
        *[F.when(ok, F.col(f"f.{f}")).otherwise(F.col(f)).alias(f) for f in PLACE_FIELDS],
        "num_authority_matches", F.col("irn").cast("string").alias("irn"), "error",
        predicate_text(*PLACE_FIELDS).alias("query_string"),
        F.when(ok, F.lit("NA")).otherwise(F.col("cleaned")).alias("error_output")).select(*RESULT_COLS)
