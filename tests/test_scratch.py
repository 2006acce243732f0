"""Scratch tables go with the scope they were made in; column names are names."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.operators.rows import default_filled, select_keys
from tessera.session import new_scratch_path, scratch_scope


def _table(spark, name):
    path = new_scratch_path(spark, name)
    spark.range(5).write.parquet(path)
    return path


def test_a_scope_removes_its_own_tables_only(spark, tmp_path):
    before = _table(spark, "before")
    with scratch_scope(spark):
        outer = _table(spark, "outer")
        with scratch_scope(spark):
            inner = _table(spark, "inner")
            spark.read.parquet(inner).write.parquet(str(tmp_path / "result"))
        assert not os.path.exists(inner) and os.path.exists(outer)
        new_scratch_path(spark, "never-written")
    after = _table(spark, "after")
    assert not os.path.exists(outer) and os.path.exists(before) and os.path.exists(after)
    assert spark.read.parquet(str(tmp_path / "result")).count() == 5


def test_a_scope_that_fails_removes_its_tables(spark):
    with pytest.raises(RuntimeError), scratch_scope(spark):
        path = _table(spark, "failed")
        raise RuntimeError
    assert not os.path.exists(path)


def test_keys_are_names(spark):
    d = spark.range(2).select(F.lit("x").alias("a.b"), F.lit(None).cast("string").alias("c d"), F.lit("t").alias("q`u"), F.struct(F.lit("nested").alias("b")).alias("a"))
    assert select_keys(d, ["q`u", "a.b", "c d"]).columns == ["q`u", "a.b", "c d"]
    assert select_keys(d).columns == d.columns
    r = default_filled(d, ["a.b", "c d", "e.f"]).first()
    assert (r["a.b"], r["c d"], r["e.f"]) == ("x", "none", "none")
    with pytest.raises(Exception, match="a.c"):
        select_keys(d, ["a.c"]).collect()
