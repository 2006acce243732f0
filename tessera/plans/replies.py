"""Clean a table of model replies into status-coded rows.

reply -> (optional null patch) -> brace trim -> strict JSON test -> status
-> fields of OK rows; failed rows keep the cleaned text as error output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import replies as R
from ..operators.rows import union_rows


def clean_replies(df: DataFrame, keys, id_col: str = "reply_id", reply_col: str = "reply",
                  strict_parity: bool = False) -> DataFrame:
    """One row per reply: id, cleaned text, status, the requested fields
    (OK rows; 'none' fills missing or null values) and ``error_output``."""
    c = df.select(id_col, R.clean_reply(F.col(reply_col), strict_parity).alias("cleaned"))
    c = c.withColumn("error", R.reply_status("cleaned"))
    ok = F.col("error") == R.STATUS_OK
    fields = R.reply_fields("cleaned", keys)
    return c.select(id_col, "cleaned", "error",
                    *[F.when(ok, fields[k]).alias(k) for k in keys],
                    F.when(ok, F.lit("NA")).otherwise(F.col("cleaned")).alias("error_output"))


def assembled_rows(df: DataFrame, keys, id_col: str = "reply_id", reply_col: str = "reply") -> DataFrame:
    """OK rows (id, the reply's keys, status) and failed rows (id, status,
    error output) have different key sets; unite them by name."""
    c = clean_replies(df, keys, id_col, reply_col)
    ok = c.filter(F.col("error") == R.STATUS_OK).select(id_col, *keys, "error")
    bad = c.filter(F.col("error") != R.STATUS_OK).select(id_col, "error", "error_output")
    return union_rows([ok, bad])


def status_counts(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("error").agg(F.count(F.lit(1)).alias("n"))
