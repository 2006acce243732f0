"""Connected components of a link table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step over directed pairs (x, y): every neighbour that is
    larger (smaller) than x, and in the small step x itself, is linked to the
    smallest of x and its neighbours."""
    least = pairs.groupBy("x").agg(F.min("y").alias("m")).withColumn("m", F.least("x", "m"))
    joined = pairs.join(least, "x")
    if large:
        return joined.filter("y > x").selectExpr("y AS u", "m AS v")
    return joined.filter("y <> m").selectExpr("y AS u", "m AS v").unionByName(least.selectExpr("x AS u", "m AS v"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest
    node that can be reached.  Large-star and small-star steps alternate until
    the links no longer change; each round is written, so lineage stays short."""
    e = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    e, before = materialize(e, "links"), None
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            return e.groupBy("u").agg(F.min("v").alias("root")).selectExpr("u AS node", "root").unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = tuple(mark)
        both = e.selectExpr("u AS x", "v AS y").unionByName(e.selectExpr("v AS x", "u AS y"))
        wide = _star(both, True).filter("u > v").distinct()
        e = materialize(_star(wide.selectExpr("u AS x", "v AS y"), False).filter("u > v").distinct(), "links")
