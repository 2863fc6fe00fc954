import datetime as dt

from pyspark.sql import functions as F

from inforce.operators import selection as SEL

D = dt.date


def test_latest_by_key_nulls_first_and_tiebreak(spark):
    df = spark.createDataFrame(
        [("p1", D(2020, 1, 1), 1), ("p1", None, 2), ("p2", D(2021, 1, 1), 3), ("p2", D(2021, 1, 1), 4)],
        "pol_id string, eff date, prd int",
    )
    out = {r.pol_id: r.prd for r in SEL.latest_by_key(df, ["pol_id"], ["eff"], ["prd"]).collect()}
    # descending order puts the NULL effective date first (warehouse default)
    assert out == {"p1": 2, "p2": 4}


def test_extreme_by_key_keeps_ties_and_skips_nulls(spark):
    df = spark.createDataFrame(
        [("p1", 5, 1), ("p1", 5, 2), ("p1", 3, 3), ("p2", None, 4), ("p3", 1, 5)], "k string, v int, id int"
    )
    got = sorted(r.id for r in SEL.extreme_by_key(df, ["k"], "v", "max").collect())
    assert got == [1, 2, 5]
    got_min = sorted(r.id for r in SEL.extreme_by_key(df, ["k"], "v", "min").collect())
    assert got_min == [3, 5]


def test_campaign_purity_null_arm_counts_as_test(spark):
    rows = spark.createDataFrame(
        [("a", "C"), ("a", "C"), ("b", "C"), ("b", "T"), ("c", "T"), ("c", None), ("d", None)], "pol_id string, ctrl_test_cd string"
    )
    pure = sorted({r.pol_id for r in SEL.campaign_purity(rows).collect()})
    assert pure == ["a", "c", "d"]


def test_test_only_once(spark):
    rows = spark.createDataFrame([("a", "T"), ("b", "T"), ("b", "T"), ("c", "C")], "pol_id string, ctrl_test_cd string")
    assert [r.pol_id for r in SEL.test_only_once(rows).collect()] == ["a"]


def test_credit_removed_only_one_to_zero(spark):
    df = spark.createDataFrame(
        [("p", D(2020, 1, 1), 1, 1), ("p", D(2021, 1, 1), 2, 0), ("p", D(2022, 1, 1), 3, 1), ("q", D(2020, 1, 1), 4, 0)],
        "pol_id string, pol_eff_dt date, pol_prd_id int, acct_cr_ind int",
    )
    out = SEL.credit_removed(df).collect()
    assert [(r.pol_id, r.acct_cr_ind) for r in out] == [("p", 0)]


def test_not_in_with_null_member_is_not_a_trap(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "pol_id string")
    ids = spark.createDataFrame([("a",), (None,)], "pol_id string")
    kept = sorted((r.pol_id or "") for r in SEL.exclude_members(df, ids).collect())
    # NULL in the list is ignored (SQL NOT IN would return nothing); the NULL row is kept by DELETE semantics
    assert kept == ["", "b"]
    missing = sorted(r.pol_id for r in SEL.missing_ids(df, ids).collect())
    assert missing == ["b"]


def test_tag_and_stack_dedupes_one_side(spark):
    a = spark.createDataFrame([("x",), ("x",)], "pol_id string")
    b = spark.createDataFrame([("y",), ("y",)], "pol_id string")
    out = SEL.tag_and_stack({"a": a, "b": b}, dedupe=["a"]).groupBy("source").count().collect()
    assert {r.source: r["count"] for r in out} == {"a": 1, "b": 2}


def test_cohort_split_partitions_the_book(spark):
    book = spark.createDataFrame([(str(i),) for i in range(10)], "pol_id string")
    members = spark.createDataFrame([("1",), ("3",), (None,), ("99",)], "pol_id string")
    parts = SEL.cohort_split(book, members)
    m, rest = parts["members"].count(), parts["book_minus_members"].count()
    assert (m, rest) == (2, 8) and m + rest == parts["book"].count()


def test_renewal_window(spark):
    df = spark.createDataFrame([(D(2024, 12, 1),), (D(2024, 11, 15),), (D(2025, 3, 1),)], "exp date")
    out = [r[0] for r in df.select(SEL.renewal_window("exp", D(2024, 10, 1), D(2024, 12, 31))).collect()]
    # 2024-11-15 renews 60 days earlier (2024-09-16), before the window, and is not after as_of
    assert out == [True, False, True]
    out2 = [r[0] for r in df.select(SEL.renewal_window("exp", D(2024, 10, 1), D(2024, 10, 15))).collect()]
    assert out2 == [True, True, True]


def test_bucketed_lags_equal_plain_window_with_a_hot_key(spark):
    import random

    from inforce.operators.sequence import bucketed_lags, plain_lags

    rnd = random.Random(7)
    rows = []
    i = 0
    for key, n in (("hot", 400), ("a", 3), ("b", 1), ("c", 7)):
        for _ in range(n):
            i += 1
            eff = None if rnd.random() < 0.02 else D(2000 + rnd.randrange(0, 12), 1 + rnd.randrange(12), 1)
            rows.append((key, eff, i, rnd.choice([None, 1.5, 2.5, 3.5]), rnd.choice(["x", "y"])))
    df = spark.createDataFrame(rows, "k string, eff date, prd int, v double, s string")
    lags = {"v": (1, 2), "s": (1,)}
    a = bucketed_lags(df, ["k"], ["eff", "prd"], F.year("eff"), lags)
    b = plain_lags(df, ["k"], ["eff", "prd"], lags)
    cols = ["prd", "lag1_v", "lag2_v", "lag1_s"]
    assert sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())


def test_with_group_aggs_matches_window_with_null_keys(spark):
    from pyspark.sql import Window

    from inforce.operators.common import with_group_aggs

    df = spark.createDataFrame([("a", 1), ("a", 5), (None, 2), (None, 7), ("b", None)], "k string, v int")
    got = sorted((r.k or "", r.v or 0, r.m or 0) for r in with_group_aggs(df, ["k"], [F.max("v").alias("m")], null_keys=True).collect())
    want = sorted((r.k or "", r.v or 0, r.m or 0) for r in df.withColumn("m", F.max("v").over(Window.partitionBy("k"))).collect())
    assert got == want
