from pyspark.sql import functions as F

from tessera.operators import predicates as P


def ids(df):
    return sorted(r[0] for r in df.select("irn_eluts").collect())


def test_contains_literal_and_regex(golden_authority):
    a = golden_authority
    assert ids(P.where_contains(a, "county", "Bikita")) == [372354]
    assert ids(P.where_contains(a, "county", "ikita")) == [217493, 218022, 372354]
    assert ids(P.where_contains(a, "county", "Mirab Shewa (Zone)")) == [375150]
    # as a regular expression the parentheses are a group: no row matches itself
    assert ids(P.where_contains(a, "county", "Mirab Shewa (Zone)", regex=True)) == []


def test_null_tests_and_equality(golden_authority):
    a = golden_authority
    assert ids(P.where_null(a, "state_province")) == [373035]
    assert len(ids(P.where_not_null(a, "state_province"))) == 5
    assert ids(P.where_equal(a, "country", "Ethiopia")) == [373035, 375150]
    assert ids(P.where_sql(a, "country = 'Ethiopia'")) == [373035, 375150]
    assert ids(P.where_bound(a, "country = :c", c="Ethiopia")) == [373035, 375150]


def test_not_in_keeps_nulls_and_partitions_table(golden_authority):
    a = golden_authority
    kept = ids(P.where_not_in(a, "state_province", ["Oromia"]))
    assert kept == [217493, 218022, 372354, 373035, 1036733]
    assert 373035 not in ids(P.where_not_in(a, "state_province", ["Oromia"], keep_nulls=False))
    inside = ids(P.where_in(a, "state_province", ["Oromia"]))
    assert sorted(inside + kept) == ids(a)


def test_large_lists_become_semi_and_anti_joins(golden_authority):
    a = golden_authority
    big = ["Ethiopia"] + [f"X{i}" for i in range(P.INLINE_LIST_MAX + 5)]
    assert ids(P.where_in(a, "country", big)) == [373035, 375150]
    assert ids(P.where_not_in(a, "country", big)) == [217493, 218022, 372354, 1036733]


def test_like_and_and_or(golden_authority):
    a = golden_authority
    assert ids(P.where_like(a, "county", "Mirab%")) == [373035, 375150]
    c = F.col
    both = a.filter(P.all_of(c("country") == "Ethiopia", c("state_province") == "Oromia"))
    assert ids(both) == [375150]
    either = a.filter(P.any_of(c("country") == "China", c("country") == "Zimbabwe"))
    assert ids(either) == [372354, 1036733]


def test_equality_filter_is_pushed_to_parquet(spark):
    from tessera.session import table
    df = P.where_equal(table(spark, "/root/testdata/sf0.001", "customer"), "c_mktsegment", "BUILDING")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "c_mktsegment" in plan


def test_null_lists_agree_whatever_their_length_or_container(spark):
    from tessera.operators import predicates as P
    df = spark.createDataFrame([(1,), (2,), (None,)], "`a.b` int")
    for extra in ([], list(range(10, 1500))):
        for values in ([1, None, *extra], spark.createDataFrame([(x,) for x in [1, None, *extra]], "v int")):
            assert [r[0] for r in P.where_in(df, "a.b", values).collect()] == [1]
            assert P.where_not_in(df, "a.b", values, keep_nulls=False).count() == 0
            assert sorted(r[0] or 0 for r in P.where_not_in(df, "a.b", values).collect()) == [0, 2]
    assert P.where_null(df, "a.b").count() == 1 and P.where_not_null(df, "a.b").count() == 2
