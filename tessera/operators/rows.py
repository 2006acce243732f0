"""Row-shape operators: projection by key list, default rows, union of rows
with different keys, consecutive numbering in a given order, n-th row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType
from pyspark.sql.window import Window

from .predicates import quote_ident
from ..session import checkpoint as _checkpoint

_LOW33 = (1 << 33) - 1


def select_keys(df: DataFrame, keys=()) -> DataFrame:
    """Subset and reorder columns by ``keys``, taken as names whatever they
    hold (dots, blanks); an empty list keeps all."""
    return df.select(*[F.col(quote_ident(k)) for k in keys]) if keys else df


def default_filled(df: DataFrame, keys, fill: str = "none") -> DataFrame:
    """Every key of the fixed list present, missing or null values -> ``fill``."""
    cols = []
    for k in keys:
        c = F.col(quote_ident(k)).cast("string") if k in df.columns else F.lit(None).cast("string")
        cols.append(F.coalesce(c, F.lit(fill)).alias(k))
    return df.select(*cols)


def union_rows(frames) -> DataFrame:
    """Rows with different key sets into one table (missing keys -> null),
    columns in first-seen order."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def row_numbers(df: DataFrame, order_cols, name: str = "row_no") -> DataFrame:
    """Consecutive 1-based numbers in ``order_cols`` order without moving the
    table into one partition.

    Range-partition and sort, number rows inside each partition
    (``monotonically_increasing_id`` carries the partition id in its high
    bits), then add the row count of all earlier partitions.  The numbered
    partitions are checkpointed first: the counts and the rows have to come
    from the same partitions, and neither sampled range bounds nor runtime
    coalescing give the same ones twice.  The offset table has one row per
    partition, so broadcasting it is bounded by the partition count, not by
    the data.  Rows tied on ``order_cols`` follow the hash of their other
    columns, which also splits a value that many rows share over several
    partitions; only rows equal in every column are in no defined order."""
    order_cols = list(order_cols)
    hashable = [F.col(quote_ident(f.name)) for f in df.schema if "map<" not in f.dataType.simpleString()
                and not isinstance(f.dataType, VariantType)]
    order = [*order_cols, F.xxhash64(*hashable)] if hashable else order_cols
    x = _checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_mid", F.monotonically_increasing_id()))
    x = x.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    counts = x.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)).alias("_off"))
    return (x.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.col("_loc") + 1)
            .drop("_mid", "_pid", "_loc", "_off"))


def batch_numbers(df: DataFrame, order_col: str, batch_size: int = 20) -> DataFrame:
    """``row_no`` in ``order_col`` order and ``batch_no = ceil(row_no / batch_size)``."""
    r = row_numbers(df, [order_col])
    return r.withColumn("batch_no", F.floor((F.col("row_no") - 1) / batch_size).cast("bigint") + 1)


def first_rows(df: DataFrame, order_cols, n: int | None) -> DataFrame:
    """First ``n`` rows in order (a development stop); ``None`` keeps all."""
    return df if n is None else df.orderBy(*order_cols).limit(n)


def nth_row(df: DataFrame, order_cols, n: int) -> DataFrame:
    """The row at 0-based position ``n`` in order, or no row when there are
    fewer.  Plans as a distributed top-(n+1), not a full sort."""
    return df.orderBy(*order_cols).offset(n).limit(1)
