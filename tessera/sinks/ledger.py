"""Resumable saves: costly work over the rows of a table, in chunks, with a
ledger of the chunks that are finished.

A chunk's rows and keys are written first, its ledger line afterwards; readers
take only what the ledger names.  A run that is killed and repeated (with the
same or more input) drops the finished keys by an anti-join and goes on, so
every key's rows appear once and no finished work is done again.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_scratch_path
from .pointers import commit, pointers

CHUNK_ROWS = 1_000_000


def _finished(spark: SparkSession, root: str) -> list[dict]:
    return [json.loads(line) for _, line in pointers(spark, root, "DONE")]


def unfinished(rows: DataFrame, root: str, key: str) -> DataFrame:
    """The rows whose key no finished chunk holds.  A null key equals itself."""
    done = _finished(rows.sparkSession, root)
    if not done:
        return rows
    keys = rows.sparkSession.read.parquet(*[d["keys"] for d in done]).select(F.col(key).alias("_done"))
    return rows.join(keys, F.col(key).eqNullSafe(F.col("_done")), "left_anti")


def save_resumable(rows: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], root: str, chunk_rows: int = CHUNK_ROWS) -> int:
    """Apply ``work`` to the unfinished rows, about ``chunk_rows`` at a time,
    and save its result; returns the chunks done in this run.  Rows of one key
    share a chunk."""
    spark = rows.sparkSession
    path = new_scratch_path(spark, "unfinished")
    todo = unfinished(rows, root, key)
    todo.write.parquet(path)
    todo = spark.read.schema(todo.schema).parquet(path)
    chunks = -(-todo.count() // chunk_rows)
    for c in range(chunks):
        part = todo.filter(F.pmod(F.xxhash64(key), F.lit(chunks)) == c)
        folder = os.path.join(root, f"chunk-{uuid.uuid4().hex[:12]}")
        entry = {"rows": os.path.join(folder, "rows"), "keys": os.path.join(folder, "keys")}
        work(part).write.mode("error").parquet(entry["rows"])
        part.select(key).distinct().write.mode("error").parquet(entry["keys"])
        commit(spark, root, "DONE", json.dumps(entry))
    return chunks


def read_saved(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all finished chunks."""
    done = _finished(spark, root)
    if not done:
        raise ValueError(f"nothing finished at {root}")
    return spark.read.parquet(*[d["rows"] for d in done])
