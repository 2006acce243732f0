import pytest
from pyspark.sql import functions as F

from tessera.functions.text import predicate_text
from tessera.operators import authority as A
from tessera.plans import reconcile as rec

PROBE_SCHEMA = "irn bigint, continent string, country string, state_province string, county string"
# The degraded match cases quoted with their expected answer.
CASES = [
    (1, "Africa", "Ethiopia", "Oromia", "Mirab Shewa (Zone)", 375150),
    (2, "Africa", "", "Oromia", "Mirab Shewa", 375150),
    (3, "Asia", "China", "Fujian", "Putian (City)", 1036733),
    (4, "Asia", "China", "", "Putian", 1036733),
    (5, "", "China", "", "Putian", 1036733),
    (6, "", "", "", "", None),
]


@pytest.fixture(scope="module")
def probes(spark):
    return spark.createDataFrame([c[:5] for c in CASES], PROBE_SCHEMA)


def test_nearest_finds_expected_rows(probes, golden_authority):
    got = {r["irn"]: r["irn_eluts"] for r in A.nearest_candidates(probes, golden_authority).collect()}
    for c in CASES:
        assert got.get(c[0]) == c[5]


def test_all_blank_probe_has_no_match_and_status(probes, golden_authority):
    out = {r["irn"]: r for r in rec.reconcile(probes, golden_authority).collect()}
    assert out["6"]["num_authority_matches"] == 0
    assert out["6"]["error"] == rec.STATUS_NO_ANSWER
    assert out["6"]["irn_eluts"] == "none"
    assert out["1"]["error"] == rec.STATUS_OK and out["1"]["irn_eluts"] == "375150"


def test_predicate_text(probes):
    r = probes.filter("irn = 5").select(predicate_text("continent", "country", "state_province", "county")).first()[0]
    assert r == '(Country == "China") and (County.str.contains("Putian"))'


def _nested_loop_counts(probes, authority):
    t, a = probes.alias("t"), authority.alias("a")
    cond = (~((F.col("t.continent") == "") & (F.col("t.country") == "") & (F.col("t.state_province") == "")
              & (F.col("t.county") == ""))
            & ((F.col("t.continent") == "") | (F.col("a.continent") == F.col("t.continent")))
            & ((F.col("t.country") == "") | (F.col("a.country") == F.col("t.country")))
            & ((F.col("t.state_province") == "") | (F.col("a.state_province") == F.col("t.state_province")))
            & ((F.col("t.county") == "") | F.contains(F.col("a.county"), F.col("t.county"))))
    j = t.join(a, cond, "left")
    return {r[0]: r[1] for r in j.groupBy("t.irn").agg(F.count("a.irn_eluts")).collect()}


def test_mask_split_equals_nested_loop_on_driver_tables(spark):
    from tessera.plans import views
    sf = "/root/testdata/sf0.001"
    probes, auth = views.normalized(spark, sf), views.authority(spark, sf)
    # add short, long, hot-gram and wildcard-only shapes
    extra = spark.createDataFrame([
        (90001, "", "", "", "0"), (90002, "", "", "", "Customer#"), (90003, "ASIA", "", "", "r#00000001"),
        (90004, "", "", "BUILDING", "1"), (90005, "EUROPE", "", "", ""), (90006, "", "", "", "zzz")], PROBE_SCHEMA)
    p = probes.unionByName(extra)
    want = _nested_loop_counts(p, auth)
    got = {r["irn"]: r["num_authority_matches"] for r in A.match_counts(p, auth).collect()}
    assert got == want
    pairs = A.authority_candidates(p, auth).groupBy("irn").count().collect()
    assert {r[0]: r[1] for r in pairs} == {k: v for k, v in want.items() if v}
    assert {r["irn"]: r["num_authority_matches"] for r in A.match_counts(p, auth, rarest_gram=False).collect()} == want


def test_candidate_list_is_capped_but_count_exact(spark, golden_authority):
    probes = spark.createDataFrame([(1, "Asia", "", "", "")], PROBE_SCHEMA)
    r = A.candidate_lists(probes, golden_authority, cap=2).first()
    assert r["num_authority_matches"] == 3
    assert r["candidates_truncated"] is True
    assert r["candidates"].count("irn_eluts") == 2


def test_shuffle_fallbacks_equal_broadcast_plans(spark):
    """Limits of 0 force every probe-key and stats join to shuffle; the
    counts and nearest rows must not change."""
    from tessera.plans import views
    sf = "/root/testdata/sf0.001"
    probes, auth = views.normalized(spark, sf), views.authority(spark, sf)
    extra = spark.createDataFrame([(90002, "", "", "", "Customer#"), (90003, "ASIA", "", "", "r#00000001"),
                                   (90004, "", "", "BUILDING", "1")], PROBE_SCHEMA)
    p = probes.unionByName(extra)
    want = _nested_loop_counts(p, auth)
    small = dict(key_broadcast_rows=0, stats_broadcast_rows=0)
    got = {r["irn"]: r["num_authority_matches"] for r in A.match_counts(p, auth, **small).collect()}
    assert got == want
    near = {r["irn"]: (r["irn_eluts"], r["score"]) for r in A.nearest_candidates(p, auth).collect()}
    near_shuffled = {r["irn"]: (r["irn_eluts"], r["score"]) for r in A.nearest_candidates(p, auth, **small).collect()}
    assert near == near_shuffled and set(near) == {k for k, v in want.items() if v}


def test_shapes_counts_keys(spark):
    p = spark.createDataFrame([(1, "ASIA", "", "", ""), (2, "ASIA", "", "", ""), (3, "", "", "", "ab"),
                               (4, "", "", "", "abcd"), (5, "", "", "", "")], PROBE_SCHEMA)
    sh = A.shapes(p, 3)
    assert sh.keyed == [(1, 0), (8, 2)]
    assert (sh.n_keyed, sh.n_long, sh.n_long_grams, sh.has_long) == (2, 1, 2, True)


def test_nearest_match_rule_is_pluggable(spark, golden_authority):
    """A replacement rule (here: the largest irn_eluts wins) is applied on
    both the keyed path (continent only) and the long-county path."""
    probes = spark.createDataFrame([(1, "Asia", "", "", ""), (2, "", "", "", "ikita")], PROBE_SCHEMA)
    rule = F.col("a_irn_eluts").cast("double")
    got = {r["irn"]: r["irn_eluts"] for r in A.nearest_candidates(probes, golden_authority, score=rule).collect()}
    assert got == {1: 1036733, 2: 372354}
    lists = {r["irn"]: r["candidates"] for r in A.candidate_lists(probes, golden_authority, cap=1, score=rule).collect()}
    assert '"1036733"' in lists[1] and '"372354"' in lists[2]
    out = {r["irn"]: r["irn_eluts"] for r in rec.reconcile(probes, golden_authority, score=rule).collect()}
    assert out == {"1": "1036733", "2": "372354"}
