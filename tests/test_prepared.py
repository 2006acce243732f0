"""Prepared authority, numbered pointers and resumable saves."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import authority as A
from tessera.operators import prepared as P
from tessera.plans import views
from tessera.plans.reconcile import reconcile, reconcile_prepared
from tessera.session import new_scratch_path
from tessera.sinks import ledger, pointers
from tessera.streaming import incremental

SF = "/root/testdata/sf0.01"
COLS = ("continent", "country", "state_province", "county")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    def field():
        return rng.choice(["", "x", "y", "z"])
    names = ["".join(rng.choices("abc", k=rng.randrange(0, 9))) for _ in range(40)]
    authority = spark.createDataFrame([(i, field(), field(), field(), rng.choice([None, *names])) for i in range(300)], "irn_eluts long, " + ", ".join(f"{c} string" for c in COLS))
    probes = spark.createDataFrame([(i, field(), field(), field(), rng.choice(["", "a", "bc", "abcd", *names])) for i in range(400)], "irn long, " + ", ".join(f"{c} string" for c in COLS))
    return probes, authority


def test_prepared_gives_the_rows_of_reconcile(spark, tables):
    probes, authority = tables
    root = new_scratch_path(spark, "prepared")
    assert P.prepare(authority, root, buckets=8) == 1
    want = rows(reconcile(probes, authority))
    for prune in (P.PRUNE_KEYS, 0):  # named buckets, then bucket by bucket
        assert rows(reconcile_prepared(probes, P.open_prepared(spark, root), prune_keys=prune)) == want
    assert rows(reconcile_prepared(probes.limit(0), P.open_prepared(spark, root))) == []
    with pytest.raises(ValueError):
        P.open_prepared(spark, new_scratch_path(spark, "nowhere"))


def test_the_prepared_keys_are_those_of_the_expanded_authority(spark, tables, monkeypatch):
    """Nulls, blanks, rows that come twice and rows without an id included; the
    expanded rows are summed by hash and never sorted."""
    odd = [(None, "x", "y", "", "ab"), (None, "x", "y", "", "zz"), (900, None, "y", "z", "abc"), (901, "x", None, None, None), (-5, "x", "y", "z", "ABab"), (902, "x", "y", "z", "")]
    authority = tables[1].unionByName(tables[1].limit(50)).unionByName(spark.createDataFrame(odd, tables[1].schema))
    written = {}
    monkeypatch.setattr(P, "_write", lambda df, path, name, key, buckets: written.setdefault(os.path.basename(path), df) and {})
    monkeypatch.setattr(P, "commit", lambda *_: 1)
    P.prepare(authority, new_scratch_path(spark, "prepared"))
    kinds = [(m, 0) for m in range(1, 8)] + [(m | 8, n) for m in range(8) for n in (1, 2)]
    want = (A._keyed_authority(authority, kinds).groupBy(*P.KEY).agg(F.count(F.lit(1)).alias("n"), A._best_struct(A.similarity_score()).alias("best"))
            .select(P.probe_key().alias("k"), "n", "best"))
    assert written["keyed"].columns == want.columns
    assert rows(written["keyed"]) == rows(want)
    plan = written["keyed"]._jdf.queryExecution().executedPlan().toString()
    assert all("HashAggregate" in line for line in plan.splitlines() if "partial_count(1)" in line)


def test_a_batch_reads_its_buckets_and_expands_nothing(spark, tables):
    probes, authority = tables
    root = new_scratch_path(spark, "prepared")
    P.prepare(authority, root, buckets=32)
    p = P.open_prepared(spark, root)
    few = A.shapes(spark.createDataFrame([(1, "x", "", "", "ab"), (2, "x", "y", "", "")], probes.schema).select(*A.PROBE_COLS), 3)
    plan = P.key_stats(few, p)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan and "PushedFilters: [In(k" in plan
    keys = few.keys.withColumn("k", P.probe_key())
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", 1 << 30)  # a scan split a file
        assert P._only(p.keyed, "k", keys, True).rdd.getNumPartitions() <= 6 and p.keyed.rdd.getNumPartitions() >= 32
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        many = P.key_stats(few, p, prune_keys=0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in many and many.count("Exchange hashpartitioning(k") == 1  # the probes' side only


def test_a_gram_of_every_county_is_not_one_task(spark, tables):
    authority = spark.range(4000).selectExpr("id AS irn_eluts", "'' AS continent", "'' AS country", "'' AS state_province", "concat('County ', id) AS county")
    root = new_scratch_path(spark, "prepared")
    P.prepare(authority, root, buckets=8)
    files = P.open_prepared(spark, root).grams.groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"), F.count(F.when(F.col("gram") == "Cou", 1)).alias("hot"))
    rows_per_file = files.agg(F.sum("n"), F.max("n")).first()
    assert rows_per_file[1] <= 0.3 * rows_per_file[0]


def test_a_session_that_did_not_write_it_registers_it(spark, tables):
    probes, authority = tables
    root = new_scratch_path(spark, "prepared")
    P.prepare(authority, root, buckets=4)
    want = rows(reconcile_prepared(probes, P.open_prepared(spark, root)))
    for t in spark.catalog.listTables():
        if t.name.startswith("tessera_"):
            spark.sql(f"DROP TABLE {t.name}")  # external: the files stay
    again = P.open_prepared(spark, root)
    assert rows(reconcile_prepared(probes, again)) == want
    assert rows(reconcile_prepared(probes, again, prune_keys=0)) == want


def test_a_new_version_takes_effect_with_the_next_batch(spark, tables):
    probes, authority = tables
    root, arrived, out, ckpt = (new_scratch_path(spark, n) for n in ("prepared", "probes", "out", "ckpt"))
    half = authority.filter("irn_eluts < 150")
    P.prepare(half, root, buckets=4)
    for authority_now, part in ((half, probes.filter("irn < 200")), (authority, probes.filter("irn >= 200"))):
        if authority_now is authority:
            assert P.prepare(authority, root, buckets=4) == 2
        part.write.mode("append").parquet(arrived)
        incremental.run_incremental_reconcile(spark, arrived, probes.schema, root, out, ckpt)
    got = spark.read.parquet(out)
    want = reconcile(probes.filter("irn < 200"), half).unionByName(reconcile(probes.filter("irn >= 200"), authority))
    assert rows(got.select(*want.columns)) == rows(want)


def test_two_writers_cannot_take_one_number(spark):
    root = new_scratch_path(spark, "pointers")
    assert pointers.current(spark, root, "X") == (0, {}) and pointers.commit(spark, root, "X", '{"a": 1}') == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        pointers.commit(spark, root, "X", "{}", number=1)
    assert pointers.commit(spark, root, "Y", "{}") == 1 and pointers.current(spark, root, "X") == (1, {"a": 1})


def test_a_killed_run_goes_on_where_it_stopped(spark):
    root, seen = new_scratch_path(spark, "ledger"), []
    source = spark.range(1000).withColumn("v", F.col("id") * 2).repartition(4)

    def work(part):
        seen.append(part.count())
        if len(seen) == 3:
            raise RuntimeError("killed")
        return part.withColumn("w", F.col("v") + 1).filter("id % 10 <> 3")  # some keys give no row

    with pytest.raises(RuntimeError):
        ledger.save_resumable(source, "id", work, root, chunk_rows=200)
    finished = sum(seen[:2])
    part = ledger.read_saved(spark, root).count()
    assert 0 < part <= finished < 1000
    assert ledger.unfinished(source, root, "id").count() == 1000 - finished
    ledger.save_resumable(source, "id", work, root, chunk_rows=200)
    assert sum(seen[3:]) == 1000 - finished  # finished work, empty results included, is not done again
    got = [r.id for r in ledger.read_saved(spark, root).collect()]
    assert sorted(got) == [i for i in range(1000) if i % 10 != 3]
    assert ledger.save_resumable(source, "id", work, root, chunk_rows=200) == 0
    odd = spark.createDataFrame([(None, 1), (None, 2), (5, 1)], "id long, v long")
    more = new_scratch_path(spark, "ledger")
    ledger.save_resumable(odd, "id", lambda d: d, more, chunk_rows=1)
    assert ledger.unfinished(odd, more, "id").count() == 0 and ledger.read_saved(spark, more).count() == 3
    with pytest.raises(ValueError):
        ledger.read_saved(spark, new_scratch_path(spark, "none"))


def test_prepared_on_the_driver_tables(spark):
    root = new_scratch_path(spark, "prepared")
    authority, probes = views.authority(spark, SF), views.normalized(spark, SF)
    P.prepare(authority, root)
    assert os.path.isdir(root)
    assert rows(reconcile_prepared(probes, P.open_prepared(spark, root))) == rows(reconcile(probes, authority))
