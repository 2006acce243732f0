"""Numbered pointers: how a folder of immutable versions says what is current.

Nothing is deleted or overwritten.  A version is written first and its pointer
afterwards, as a folder ``<name>-<number>`` holding one line; two writers that
take the same number cannot both commit (the second one's write fails), and a
run that dies before its pointer leaves the earlier state current.
"""

from __future__ import annotations

import json
import os

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def pointers(spark: SparkSession, root: str, name: str) -> list[tuple[int, str]]:
    """(number, line) of every committed pointer, oldest first."""
    try:
        lines = spark.read.text(os.path.join(root, f"{name}-*")).collect()  # one row a commit
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []
    return sorted((int(n), line) for n, line in (r[0].split("\t", 1) for r in lines))


def commit(spark: SparkSession, root: str, name: str, line: str, number: int | None = None) -> int:
    """Add the next pointer (or exactly ``number``, to notice that another
    writer was first); returns its number."""
    number = number or max([n for n, _ in pointers(spark, root, name)], default=0) + 1
    spark.createDataFrame([(f"{number}\t{line}",)], "line string").coalesce(1).write.mode("error").text(os.path.join(root, f"{name}-{number:08d}"))
    return number


def current(spark: SparkSession, root: str, name: str) -> tuple[int, dict]:
    """Number and fields of the newest pointer; (0, {}) when there is none."""
    found = pointers(spark, root, name)
    return (found[-1][0], json.loads(found[-1][1])) if found else (0, {})
