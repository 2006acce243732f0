"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import new_scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def positional(df: DataFrame) -> DataFrame:
    """The same rows under the names _c0, _c1, ... so that no column of a
    caller's table can clash with a working column (or with another column
    that differs by case only)."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """Only the named columns (``new=old`` renames).  An exact match wins over
    names that differ by case; of several columns with one name the first is
    taken; every other column is left behind."""
    cols, hidden = df.columns, positional(df)
    want = [(n, n) for n in names] + list(renamed.items())
    missing = [old for _, old in want if old not in cols]
    if missing:
        raise ValueError(f"columns {missing} not found in {cols}")
    return hidden.select(*[F.col(f"_c{cols.index(old)}").alias(new) for new, old in want])


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character untouched."""
    return F.translate(c, UPPER, UPPER.lower())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared scratch folder and read it
    back: cuts lineage, survives lost executors, and is pruned by column."""
    spark: SparkSession = df.sparkSession
    path = new_scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(run: Callable) -> Callable:
    """A batch function that hands its freed memory back to the system when a
    task ends: Python workers are kept for later tasks, whose limits it would
    count against."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)
    return task
