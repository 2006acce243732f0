"""Reconcile transcribed place rows against the authority table.

normalise blanks -> wildcard authority join -> candidate count -> nearest
candidate -> status row.  One output row per probe, columns in the fixed
result order; failed rows keep the input values and carry a status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.replies import STATUS_NO_ANSWER, STATUS_OK
from ..functions.text import PLACE_FIELDS, predicate_text
from ..operators import prepared
from ..operators.authority import probe_stats
from ..operators.rows import batch_numbers

# Result columns in their order.
RESULT_COLS = ("irn_eluts", "continent", "country", "state_province", "county",
               "num_authority_matches", "irn", "error", "query_string", "error_output")


def reconcile(probes: DataFrame, authority: DataFrame, **kw) -> DataFrame:
    """``probes``: irn + four place fields with '' blanks."""
    return status_rows(probe_stats(probes, authority, **kw))


def reconcile_prepared(probes: DataFrame, authority: prepared.Prepared, **kw) -> DataFrame:
    """The same rows from a prepared authority, at the cost of the probes."""
    return status_rows(prepared.probe_stats(probes, authority, **kw))


def status_rows(j: DataFrame) -> DataFrame:
    """Result rows of probes with their match count and ``best`` candidate."""
    ok = F.col("best").isNotNull()
    return j.select(
        F.when(ok, F.col("best.irn_eluts").cast("string")).otherwise(F.lit("none")).alias("irn_eluts"),
        *[F.when(ok, F.col("best." + f)).otherwise(F.col(f)).alias(f) for f in PLACE_FIELDS],
        "num_authority_matches",
        F.col("irn").cast("string").alias("irn"),
        F.when(ok, F.lit(STATUS_OK)).otherwise(F.lit(STATUS_NO_ANSWER)).alias("error"),
        predicate_text(*[F.col(f) for f in PLACE_FIELDS]).alias("query_string"),
        F.when(ok, F.lit("NA")).otherwise(F.lit("{}")).alias("error_output"),
    )


def batch_snapshots(result: DataFrame, batch_size: int = 20, order_col: str = "irn") -> DataFrame:
    """Result rows numbered in input order with the save batch they belong to.

    The progressive files of the original job are cumulative: file n holds
    rows 1..n*batch_size, i.e. ``batch_no <= n``.  Writing
    ``partitionBy("batch_no")`` appends each batch once instead."""
    return batch_numbers(result, order_col, batch_size)
