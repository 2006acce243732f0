import pytest

import __spark_entry__ as E
from conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "num_authority_matches" in df.columns


def test_every_query_has_a_callable_and_oracles_are_known():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


@pytest.mark.parametrize("name", ["reconcile", "reply_status", "retrieve", "knn_bucketed", "chat_fields"])
def test_same_result_with_ansi_mode(spark, name):
    """The driver's own session runs with Spark 4's default ANSI mode; the
    library sets it off.  Results must not depend on it."""
    q = E.queries()[name]
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "true")
        on = sorted(map(tuple, q(spark, SF001).collect()), key=repr)
        spark.conf.set("spark.sql.ansi.enabled", "false")
        off = sorted(map(tuple, q(spark, SF001).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert on == off
