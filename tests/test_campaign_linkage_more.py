import datetime as dt

from pyspark.sql import functions as F

from inforce.operators import campaign as C
from inforce.operators import linkage as LK
from inforce.operators import maintenance as MT
from inforce.operators import reconcile as R

D = dt.date


def test_inforce_billing_buckets(spark):
    inf = spark.createDataFrame(
        [("a", D(2025, 1, 1)), ("b", D(2025, 1, 10)), ("c", D(2024, 8, 1)), ("d", D(2024, 6, 1)), ("e", D(2025, 1, 5))],
        "pol_id string, pol_eff_dt date",
    )
    bill = spark.createDataFrame(
        [("a", D(2025, 1, 1), "ACT_A1", "Full Pay"), ("b", D(2025, 1, 10), "ACT_A6", "Full Pay"),
         ("c", D(2024, 8, 1), "ACT_A7", "Monthly Installments"), ("d", D(2024, 6, 1), "ACT_A2", "Monthly Installments"),
         ("e", D(2025, 1, 5), "ACT_A5", "Full Pay")],
        "pol_id string, pol_eff_dt date, bill_acct_plan_typ_cd string, bill_instal_typ_desc string",
    )
    auto = {r.bucket: r.cnt for r in C.inforce_billing_buckets(inf, bill, (D(2024, 12, 12), D(2025, 1, 27)), D(2024, 7, 27)).collect()}
    assert auto == {"Auto Full Pay": 1, "On Demand Full Pay": 1, "On Demand Monthly Pay": 1, "N/A": 1}  # d is before the window
    home = {r.bucket: r.cnt for r in C.inforce_billing_buckets(inf, bill, (D(2024, 12, 12), D(2025, 1, 27)), D(2024, 7, 27), "home").collect()}
    assert home["On Demand Full Pay"] == 2  # A5 is on-demand for the second line only


def test_household_credit_flag_priorities(spark):
    rows = [
        ("p1", D(2024, 7, 1), "InForce", "N", "InForce", "Y"),   # future window + conflict
        ("p2", D(2024, 5, 1), "InForce", "N", "InForce", "Y"),   # old term, not future -> forced 0
        ("p3", D(2024, 10, 1), "Left", "N", "InForce", "Y"),     # only home in force with credit
        ("p4", D(2024, 10, 1), "Left", "Y", "Left", "N"),        # both left, one indicator Y
        ("p5", D(2024, 10, 1), "InForce", "Y", "InForce", "Y"),  # no conflict
    ]
    df = spark.createDataFrame(rows, "auto_pol_id string, auto_eff_dt date, auto_status string, auto_acct_cr_ind string, "
                                     "home_status string, home_acct_cr_ind string")
    out = {r.auto_pol_id: (r.future_ind, r.acct_issue_ind) for r in
           LK.household_credit_issues(df, D(2024, 6, 5), D(2024, 8, 2), D(2024, 9, 1)).collect()}
    assert out == {"p1": (1, 1), "p2": (0, 0), "p3": (0, 1), "p4": (0, 1), "p5": (0, 0)}


def test_quote_funnel_and_enrich_rules(spark):
    latest = spark.createDataFrame([(1, "p"), (2, "q")], "qcn bigint, pol_id string")
    flow = spark.createDataFrame([(1, 0, 1), (1, 2, 0), (2, 1, 0)], "qcn bigint, resp_ind_cnt int, iss_ind_cnt int")
    rater = spark.createDataFrame([(1, 5)], "qcn bigint, carriers_quoted int")
    first = spark.createDataFrame([("p", D(2020, 1, 1))], "pol_id string, first_pol_eff_dt date")
    out = {r.qcn: r for r in LK.quote_funnel(latest, rater, first, quote_flow=flow).collect()}
    assert (out[1].resp_ind_cnt, out[1].iss_ind_cnt, out[1].carriers_quoted, out[1].pol_cnt_issue_match) == (2, 1, 5, 1)
    assert out[2].carriers_quoted is None and out[2].pol_cnt_issue_match == 0
    hits = spark.createDataFrame([("p", D(2020, 1, 1), 7), ("p", D(2020, 1, 1), 8), ("x", D(2020, 1, 1), 7)],
                                 "pol_id string, pol_eff_dt date, uw_ref_decl_rule_id bigint")
    ref = spark.createDataFrame([(7, "msg7")], "rule_id bigint, msg string")
    terms = spark.createDataFrame([("p", D(2020, 1, 1), 3)], "pol_id string, pol_eff_dt date, veh_cnt int")
    got = sorted((r.uw_ref_decl_rule_id, r.msg, r.veh_cnt) for r in LK.enrich_rules(hits, ref, terms).collect())
    assert got == [(7, "msg7", 3), (8, None, 3)]


def test_snapshot_vs_history_and_profile(spark):
    snap = spark.createDataFrame(
        [("a", D(2024, 9, 30), "X", "InForce"), ("a", D(2024, 10, 31), "X", "InForce"), ("b", D(2024, 10, 31), "X", "Cancelled"),
         ("c", D(2024, 10, 31), "Y", "InForce")],
        "policy_id string, me_dt date, rate_plan_cd string, pol_status_cd string",
    )
    hist = spark.createDataFrame([("a", "X"), ("b", "X"), ("c", "Y")], "pol_id string, rate_plan_cd string")
    out = {r.rate_plan_cd: (r.mif_cnt, r.per_cnt, r.pct_diff, r.diff_cnt) for r in
           R.snapshot_vs_history_counts(snap, hist, snapshot_filter=F.col("pol_status_cd") == "InForce").collect()}
    assert out == {"X": (1, 2, 66.67, 1), "Y": (1, 1, 0.0, 0)}
    p = MT.profile(snap, "policy_id", "me_dt", "pol_status_cd").first()
    assert (p.latest_dt, p.first_dt, p.status_cnt, p.id_cnt, p.date_cnt, p.row_cnt) == (D(2024, 10, 31), D(2024, 9, 30), 2, 3, 2, 4)
    by = {(r.rate_plan_cd, r.pol_status_cd): r.cnt for r in LK.inforce_by_status(snap, ["InForce", "A"]).collect()}
    assert by == {("X", "InForce"): 1, ("Y", "InForce"): 1}  # the older snapshot is not counted


def test_claims_ingest_dates_and_split(spark):
    from decimal import Decimal as Dec

    src = spark.createDataFrame(
        [(1, "Glass", dt.datetime(2024, 7, 2, 13, 5), dt.datetime(2024, 7, 3, 9, 0), Dec("10.5000")),
         (2, "Collision", dt.datetime(2024, 7, 5, 0, 0), dt.datetime(2024, 7, 6, 0, 0), Dec("99.0000")),
         (3, "Towing", dt.datetime(2024, 6, 30, 23, 0), dt.datetime(2024, 7, 1, 0, 0), Dec("5.0000"))],
        "clm_id int, cov_typ_desc string, loss_dt timestamp, rpt_tmsp timestamp, clm_ttl_inc_amt decimal(18,4)",
    )
    out = MT.claims_ingest(src, D(2024, 7, 1))
    assert dict(out.dtypes)["loss_dt"] == "date" and dict(out.dtypes)["rpt_tmsp"] == "date"
    got = {r.clm_id: (r.loss_dt, float(r.glass_tow_amt)) for r in out.collect()}
    assert got == {1: (D(2024, 7, 2), 10.5), 2: (D(2024, 7, 5), 0.0)}


def test_latest_with_aggs_matches_window(spark):
    from inforce.operators import selection as SEL

    df = spark.createDataFrame(
        [("k", None, 1, 10), ("k", D(2024, 1, 2), 2, 20), ("k", D(2024, 1, 2), 3, 30), ("j", D(2023, 1, 1), 4, 40)],
        "key string, d date, n int, v int",
    )
    got = {r.key: (r.n, r.v, r.mx) for r in SEL.latest_with_aggs(df, ["key"], ["d", "n"], ["n", "v"], [F.max("v").alias("mx")]).collect()}
    # NULL order value first (descending, nulls first), as latest_by_key
    assert got == {"k": (1, 10, 30), "j": (4, 40, 40)}
    ref = {r.key: r.n for r in SEL.latest_by_key(df, ["key"], ["d"], ["n"]).collect()}
    assert ref == {k: v[0] for k, v in got.items()}
