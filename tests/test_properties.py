
import datetime as dt

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inforce.functions.bands import band_expr, band_sql
from inforce.operators import loss as L
from inforce.operators import reconcile as R
from inforce.operators import selection as SEL
from inforce.operators.sequence import bucketed_lags, plain_lags

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

terms = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from(["hot", "hot", "a", "b"])),
        st.one_of(st.none(), st.dates(dt.date(2000, 1, 1), dt.date(2006, 12, 31))),
        st.one_of(st.none(), st.integers(-5, 5)),
    ),
    min_size=1,
    max_size=60,
)


@SETTINGS
@given(terms)
def test_bucketed_lags_equal_plain_window(spark, rows):
    data = [(k, d, i, v) for i, (k, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, d date, i int, v int")
    lags = {"v": (1, 2, 3)}
    cols = ["i", "lag1_v", "lag2_v", "lag3_v"]
    a = bucketed_lags(df, ["k"], ["d", "i"], F.year("d"), lags).select(*cols).collect()
    b = plain_lags(df, ["k"], ["d", "i"], lags).select(*cols).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), st.integers(1, 6), st.integers(0, 40)), min_size=1, max_size=40))
def test_allocation_conserves_the_model_value(spark, rows):
    loss = spark.createDataFrame(
        [("p", prd, "BI", f"2024{m % 12 + 1:02d}", float(ee)) for _, prd, ee in rows for m in [prd]],
        "pol_id string, pol_prd_id bigint, cov_type_abbr string, earned_month string, ee double",
    )
    model_rows = [tuple([prd] + [3.0, 2.0] * len(R.MODEL_COVERAGES)) for prd in range(1, 7)]
    schema = "cv_plcy_period_id bigint, " + ", ".join(f"adj_{c}_pp_pred double, {c}_exposure double" for c in R.MODEL_COVERAGES)
    model = spark.createDataFrame(model_rows, schema)
    per = R.allocate_prediction(loss, model, digits=None).groupBy("pol_prd_id").agg(F.sum("adj_bi_pp").alias("s"))
    total_ee = {r.pol_prd_id: r.t for r in loss.groupBy("pol_prd_id").agg(F.sum("ee").alias("t")).collect()}
    for r in per.collect():
        if total_ee[r.pol_prd_id] == 0:
            assert r.s is None  # nothing to spread
        else:
            assert abs(r.s - 6.0) < 1e-9  # prediction x exposure


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["C", "D"]), st.sampled_from([L.NO_ACC_LABEL, L.YES_ACC_LABEL]),
                          st.integers(1, 6), st.integers(0, 100), st.integers(1, 100)), min_size=1, max_size=40))
def test_running_total_ends_at_grand_total_and_shares_sum_to_one(spark, rows):
    df = spark.createDataFrame(
        [(f"p{i}", f"20240{m}", cd, fl, float(lo), float(pr), 0.1) for i, (cd, fl, m, lo, pr) in enumerate(rows)],
        "pol_id string, earned_month string, clean_dirty_cd string, derived_yes_no_flag string, incur_loss double, "
        "epapr double, ee double",
    )
    rr = L.running_ratio(df).collect()
    by_seg = {}
    for r in rr:
        if r.segment not in by_seg or r.earned_month > by_seg[r.segment].earned_month:
            by_seg[r.segment] = r
    seg = df.withColumn("segment", L.segment_label())
    totals = {r.segment: r.t for r in seg.groupBy("segment").agg(F.sum("incur_loss").alias("t")).collect()}
    assert {k: v.cum_loss for k, v in by_seg.items()} == totals
    shares = [r.share for r in L.share_of_total(seg, ["segment"], "epapr").collect()]
    assert abs(sum(shares) - 1.0) < 1e-5


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["1", "2", "3", "4"])), max_size=10),
       st.lists(st.sampled_from(["1", "2", "3", "4", "5"]), min_size=1, max_size=20))
def test_members_plus_rest_is_the_book(spark, member_ids, book_ids):
    book = spark.createDataFrame([(b,) for b in book_ids], "pol_id string")
    members = spark.createDataFrame([(m,) for m in member_ids] or [(None,)], "pol_id string")
    parts = SEL.cohort_split(book, members)
    assert parts["members"].count() + parts["book_minus_members"].count() == len(book_ids)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-20, 1100)), min_size=1, max_size=30))
def test_band_rules_agree_with_their_sql(spark, xs):
    from inforce.plans.segment_plans import decile_rules

    df = spark.createDataFrame([(x,) for x in xs], "x int")
    got = [r[0] for r in df.select(band_expr("x", decile_rules())).collect()]
    vals = ", ".join(f"({'NULL' if x is None else x}::INTEGER)" for x in xs)
    want = [r[0] for r in duckdb.sql(f"SELECT {band_sql('x', decile_rules())} FROM (VALUES {vals}) t(x)").fetchall()]
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", "e"]), st.integers(0, 1), st.integers(0, 1),
                          st.integers(0, 1), st.integers(0, 1)), min_size=1, max_size=30),
       st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "x"])), max_size=6))
def test_one_pass_cohort_rates_equal_three_separate_rates(spark, book_rows, member_ids):
    from inforce.operators import persistency as P

    book = spark.createDataFrame(book_rows, "pol_id string, atr_e_flat int, cancel_e_flat int, atr_e_30 int, cancel_e_30 int")
    members = spark.createDataFrame([(m,) for m in member_ids] or [(None,)], "pol_id string")
    one = {(r.cohort, r.horizon): (r.atr_sum, r.cancel_sum, r.rate_pct) for r in P.cohort_rates(book, members).collect()}
    parts = SEL.cohort_split(book, members)
    for label, df in parts.items():
        for h, hl in (("flat", 0), ("30", 30)):
            r = P.persistency_rate(df, h).first()
            assert one.get((label, hl), (0, 0, None)) == (r.atr_sum, r.cancel_sum, r.rate_pct)
