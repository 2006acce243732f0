"""Sinks: CSV result tables, batch-numbered appends, the vector table
(written to a fresh version path, never delete-then-write), stamped paths."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import select_keys
from .pointers import commit, pointers


def write_csv(df: DataFrame, path: str, keys=(), mode: str = "overwrite") -> None:
    """Header, comma, UTF-8; blanks at the ends of a cell are kept.  Spark writes '' as a quoted "" and null as an
    empty field, so both read back as they were; cells with newlines read back
    with ``multiline=True``.  A folder of part files (one per task)."""
    (select_keys(df, keys).write.mode(mode).option("header", True).option("escape", '"').option("encoding", "UTF-8")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_batches(df: DataFrame, path: str, order_col: str, batch_size: int = 20, run: str = "1") -> None:
    """Write the save batches of one run (rows numbered in ``order_col``
    order) under ``run=<run>``: a repeated run replaces its own rows and no
    others.  ``batch_no`` is a column, and files follow its order, so reading
    batches 1..n skips the rest; the cumulative file n of the original job is
    their union."""
    from ..operators.rows import batch_numbers
    batch_numbers(df, order_col, batch_size).write.mode("overwrite").parquet(os.path.join(path, f"run={run}"))


def stamped_path(folder: str, project: str, stamp: str, count: int, ext: str = "csv") -> str:
    return os.path.join(folder, f"{project}_{stamp}-{count}.{ext}")


def write_vector_table(df: DataFrame, root: str, embedder: str, dim: int) -> str:
    """Write a new version of the vector table and then a new numbered
    pointer to it.  Nothing is deleted or overwritten: a run that fails at any
    point leaves the previous version current, and two runs that take the same
    number cannot both commit.  Returns the version path."""
    version = os.path.join(root, f"v-{uuid.uuid4().hex[:12]}")
    (df.withColumn("embedder", F.lit(embedder)).withColumn("dim", F.lit(dim))
     .write.mode("error").parquet(version))
    commit(df.sparkSession, root, "CURRENT", version)
    return version


def open_vector_table(spark: SparkSession, root: str, embedder: str, dim: int) -> DataFrame:
    """Read the current version and refuse a table built by another embedder
    or dimension (both sides of a search must use the same embedder)."""
    found = pointers(spark, root, "CURRENT")
    if not found:
        raise ValueError(f"no vector table at {root}")
    version = found[-1][1]
    df = spark.read.parquet(version)
    bad = df.filter((F.col("embedder") != embedder) | (F.col("dim") != dim)).limit(1).count()
    if bad:
        raise ValueError(f"vector table at {version} was not built with {embedder}/{dim}")
    return df
