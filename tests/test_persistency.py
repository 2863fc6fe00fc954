import datetime as dt

import pytest
from pyspark.sql import functions as F

from inforce.operators import persistency as P

D = dt.date
AS_OF = D(2024, 12, 31)


def _terms(spark, rows):
    return spark.createDataFrame(
        rows, "pol_id string, pol_prd_id int, pol_eff_dt date, canc_eff_dt date, canc_trans_dt date"
    )


def test_cancel_flag_and_day_365_edges(spark):
    eff = D(2023, 1, 1)
    rows = [
        ("a", 1, eff, None, None),                       # not cancelled
        ("b", 2, eff, eff + dt.timedelta(days=365), None),  # exactly 365: an expiry, not a cancel
        ("c", 3, eff, eff + dt.timedelta(days=364), None),
        ("d", 4, eff, eff, eff - dt.timedelta(days=40)),    # flat cancel entered 40 days ahead
        ("e", 5, eff, eff + dt.timedelta(days=366), None),
    ]
    out = {r.pol_id: r for r in P.development_flags(_terms(spark, rows), AS_OF).collect()}
    assert out["a"].cancel_flag == 0 and out["a"].num_days_canc == -1 and out["a"].cancel_e_365 == 0
    assert out["b"].cancel_flag == 0 and out["b"].cancel_e_365 == 0 and out["b"].cancel_e_330 == 0
    assert out["c"].cancel_flag == 1 and out["c"].cancel_e_365 == 1 and out["c"].cancel_e_330 == 0
    assert out["d"].cancel_e_flat == 1 and out["d"].cancel_e_30 == 1
    assert out["d"].canc_pre_30 == 1 and out["d"].canc_pre_45 is None and out["d"].canc_pre == 1
    assert out["e"].cancel_flag == 1 and out["e"].cancel_e_365 == 0


def test_attained_exactly_on_n_days(spark):
    eff = AS_OF - dt.timedelta(days=30)
    rows = [("a", 1, eff, None, None), ("f", 2, AS_OF + dt.timedelta(days=20), None, None)]
    out = {r.pol_id: r for r in P.development_flags(_terms(spark, rows), AS_OF).collect()}
    assert out["a"].atr_e_30 == 1 and out["a"].atr_e_60 == 0 and out["a"].num_days_eff == 30
    # pre-effective: 20 days before the effective date
    assert out["f"].atr_e_flat == 0 and out["f"].atr_pre_30 == 1 and out["f"].atr_pre_15 is None
    assert out["f"].atr_pre is None


def _hist(spark, rows):
    df = spark.createDataFrame(
        rows, "pol_id string, pol_prd_id int, pol_eff_dt date, prem double, new_rnw_cd string, rate_plan_cd string, cancel_flag int"
    )
    return P.term_history(df, compare=["rate_plan_cd"], acct_cr=None)


def test_term_history_single_term_and_zero_prior(spark):
    rows = [
        ("s", 1, D(2020, 1, 1), 100.0, "N", "A", 0),
        ("z", 2, D(2020, 1, 1), 0.0, "N", "A", 1),
        ("z", 3, D(2021, 1, 1), 50.0, "R", "A", 0),
        ("r", 4, D(2020, 1, 1), 100.0, "N", "A", 0),
        ("r", 5, D(2021, 1, 1), 95.0, "R", "B", 0),
        ("r", 6, D(2022, 1, 1), 95.0, "R", "B", 0),
    ]
    out = {r.pol_prd_id: r for r in _hist(spark, rows).collect()}
    assert out[1].prev_term_prem == 0.0 and out[1].renewal_prem_change is None and out[1].prev_rate_plan_cd is None
    assert out[3].renewal_prem_change is None and out[3].prior_term_canc_ind == "1"  # prior premium 0
    assert out[5].renewal_prem_change == pytest.approx(-0.05) and out[5].same_rate_plan_cd_ind == 0
    assert out[6].renewal_prem_change == 0.0 and out[6].same_rate_plan_cd_ind == 1
    assert out[6].prev_two_term_prem == 100.0
    assert out[6].renewal_prem_change_grp == "c. 0 to 9"


@pytest.mark.parametrize(
    "chg,label", [(-0.06, "a. < -5"), (-0.05, "b. -5 to 0"), (0.0, "c. 0 to 9"), (0.1, "d. 10 to 19"), (0.2, "e. > 20")]
)
def test_premium_change_band_edges(spark, chg, label):
    from inforce.functions.bands import band_expr

    df = spark.createDataFrame([(chg,)], "c double")
    assert df.select(band_expr("c", P.PREMIUM_CHANGE_BANDS)).first()[0] == label


def test_ultimate_cancel_simplification_equals_twelve_branches(spark):
    eff0 = D(2024, 1, 1)
    rows = []
    for i, days in enumerate([-10, 0, 29, 30, 95, 200, 340, 364, 365, 400]):
        eff = AS_OF - dt.timedelta(days=days)
        canc = eff + dt.timedelta(days=50) if i % 3 == 0 else None
        rows.append((f"p{i}", i, eff, canc, None, "R" if i % 2 else "N", 6 if i == 5 else 12))
    df = spark.createDataFrame(
        rows, "pol_id string, pol_prd_id int, pol_eff_dt date, canc_eff_dt date, canc_trans_dt date, new_rnw_cd string, term_mo_cnt int"
    )
    flags = P.development_flags(df, AS_OF)
    fac = spark.createDataFrame([("90-Ult", "R", 0.8), ("30-Ult", "N", 0.7)], "persistency_period string, pol_new_renew_cd string, dev_fctr double")
    u = P.ultimate_cancel(flags, fac)
    twelve = None
    for n in reversed([*P.DEV_DAYS]):
        c = F.col(f"atr_e_{n}") == 1
        twelve = F.when(c, 1.0 - F.col("dev_fctr")) if twelve is None else twelve.when(c, 1.0 - F.col("dev_fctr"))
    twelve = twelve.when(F.col("atr_e_flat") == 1, 1.0 - F.col("dev_fctr"))
    ref = (
        F.when(F.col("latest_cancel") == 1, 1.0)
        .when((F.col("latest_cancel") == 0) & (F.col("atr_e_365") == 1), 0.0)
        .when((F.col("latest_cancel") == 0) & (F.col("atr_e_365") == 0), twelve)
    )
    rows = u.select("ult_canc_cnt", F.round(ref, 6).alias("ref"), "persistency_period", "dev_fctr").collect()
    for r in rows:
        assert r.ult_canc_cnt == r.ref
    periods = {r.persistency_period for r in rows}
    assert {"1", "0-Ult", "30-Ult", "90-Ult"} <= periods and None in periods


def test_persistency_rate_and_zero_attained(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (1, 0), (1, 0)], "atr_e_flat int, cancel_e_flat int")
    r = P.persistency_rate(df, "flat").first()
    assert (r.atr_sum, r.cancel_sum, r.rate_pct, r.rate_text) == (4, 1, 75.0, "75.00%")
    empty = spark.createDataFrame([(0, 0)], "atr_e_flat int, cancel_e_flat int")
    assert P.persistency_rate(empty, "flat").first().rate_pct is None


def test_code_transitions_month_label_not_alphabetical(spark):
    # Dec -> Jan: MAX('Dec', 'Jan') alphabetically is 'Jan' either way, so use Jan -> Dec to catch the trap
    snaps = spark.createDataFrame(
        [("p", D(2024, 1, 31), "A"), ("p", D(2024, 2, 29), "B"), ("p", D(2024, 12, 31), "C"),
         ("q", D(2024, 1, 31), "A"), ("q", D(2024, 2, 29), "A")],
        "policy_id string, me_dt date, pol_form_cd string",
    )
    now = spark.createDataFrame([("q",)], "policy_id string")
    out = {r.policy_id: r for r in P.code_transitions(snaps, now, from_code="A", label="A").collect()}
    assert set(out) == {"p"}  # q never changed
    assert out["p"].change_month == "Dec" and out["p"].initial_code == "A" and out["p"].current_code == "C"
    assert out["p"].cancel_flag == 1 and out["p"].bucket == "A to Other"


def test_reinstated_after_cancel(spark):
    txns = spark.createDataFrame(
        [("q1", D(2024, 12, 2), 1, "Cancel", "Committed", D(2024, 1, 1), D(2024, 12, 2)),
         ("q1", D(2024, 12, 9), 2, "Reinstate", "Committed", D(2024, 1, 1), None),
         ("q2", D(2024, 12, 2), 3, "Cancel", "Committed", D(2022, 1, 1), D(2024, 12, 2)),
         ("q2", D(2024, 12, 9), 4, "Reinstate", "Committed", D(2022, 1, 1), None)],
        "qcn string, trans_dt date, trans_id int, trans_typ_desc string, trans_stat_desc string, orig_pol_eff_dt date, canc_eff_dt date",
    )
    reasons = spark.createDataFrame(
        [("q1", D(2024, 12, 2), "Non-Payment"), ("q1", D(2024, 12, 9), "Other"),
         ("q2", D(2024, 12, 2), "Non-Payment"), ("q2", D(2024, 12, 9), "Other")],
        "qcn string, trans_dt date, trans_rsn_desc string",
    )
    out = P.reinstated_after_cancel(txns, reasons, D(2024, 12, 1)).collect()
    assert [(r.qcn, r.prior_cancel_dt) for r in out] == [("q1", D(2024, 12, 2))]  # q2 is 2 calendar years old


def test_term_characteristics_edges(spark):
    from decimal import Decimal as Dec

    rows = [
        # policy b was rewritten from policy a: its first term falls back to a's latest premium
        ("a", 1, 20230101, 0, 0, Dec("100.00"), 12, Dec("50.0000"), "a", 1, "3.5", "06103", "1234", D(2023, 1, 1), Dec("1.00"), "Y"),
        ("a", 2, 20240101, 20240301, 20240215, Dec("120.00"), 6, Dec("30.0000"), "a", 2, "4.5", "06103", None, D(2024, 1, 1), Dec("2.00"), "Y"),
        ("b", 3, 20240601, 0, 0, Dec("80.00"), 12, None, "a", None, "0.5", "01000", None, D(2024, 4, 1), None, "N"),
        ("c", 4, 20240101, 0, 0, Dec("0.00"), 12, Dec("0.0000"), "c", 1, "1.0", "02000", None, D(2024, 1, 1), Dec("5.00"), "Y"),
        ("c", 5, 20250101, 0, 0, Dec("10.00"), 12, Dec("0.0000"), "c", 1, "1.0", "02000", None, D(2025, 1, 1), Dec("5.00"), "Y"),
    ]
    schema = ("policy_id string, pol_prd_id bigint, pol_eff_dt int, canc_eff_dt int, pol_entry_dt int, term_writ_prem decimal(18,2), "
              "pol_term_mo_cnt int, current_term_auto_prem decimal(18,4), prev_pol_id string, acct_cr_cd int, years_with_co string, "
              "zip_cd string, plus4_cd string, rate_tbl_dt date, total_aal_cat_load decimal(18,2), aal_data_ind string")
    ref = spark.createDataFrame(rows, schema)
    out = {r.pol_prd_id: r for r in P.term_characteristics(ref, modelled=("total_aal_cat_load",)).collect()}
    assert out[1].pol_eff_date == D(2023, 1, 1) and out[1].canc_eff_date is None and out[1].cancel_trans_dt is None
    assert out[1].dwell_loc_addr_full_zip_cd == "06103-1234" and out[2].dwell_loc_addr_full_zip_cd == "06103"
    assert out[2].canc_eff_date == D(2024, 3, 1) and out[2].cancel_trans_dt == D(2024, 2, 15)
    assert out[2].pol_annl_ttl_bill_prem_amt == Dec("240.00") and out[2].acct_cr_ind == "N"
    assert out[2].prem_chng_combined == pytest.approx(150.0 / 150.0 - 1.0) and out[2].rate_tbl_dt_chng_ind == 1
    assert out[3].prev_term_latest_prem_amt == Dec("120.00") and out[3].prev_pol_id_latst_prem == Dec("120.00")
    assert out[3].acct_cr_ind is None and out[3].aal_cat_load_change == "NO AAL"
    assert out[5].prem_chng_combined == -1.0  # DIV0: zero prior total gives 0, minus 1
    assert out[5].aal_cat_load_change == "NO CHANGE" and out[2].aal_cat_load_change == "INCREASE"
    assert str(out[1].tenure_years) == "3.5"


def test_cohort_rates_one_pass(spark):
    book = spark.createDataFrame(
        [("a", 1, 0, 1, 0), ("b", 1, 1, 1, 1), ("c", 1, 0, 0, 0), ("d", 0, 0, 0, 0)],
        "pol_id string, atr_e_flat int, cancel_e_flat int, atr_e_30 int, cancel_e_30 int",
    )
    members = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "pol_id string")
    out = {(r.cohort, r.horizon): (r.atr_sum, r.cancel_sum, r.rate_pct) for r in P.cohort_rates(book, members).collect()}
    assert out[("members", 0)] == (2, 1, 50.0) and out[("book", 0)] == (3, 1, 66.67)
    assert out[("book_minus_members", 0)] == (1, 0, 100.0) and out[("book_minus_members", 30)] == (0, 0, None)
    assert out[("book", 30)] == (2, 1, 50.0)


def test_term_history_first_premium_table_equals_prejoin(spark):
    rows = [("p", 1, D(2020, 1, 1), 100.0, "N", "A", 0), ("p", 2, D(2021, 1, 1), 110.0, "R", "A", 0),
            ("p", 3, D(2022, 1, 1), 90.0, "R", "B", 1), ("q", 4, D(2021, 6, 1), 50.0, "N", "A", 0),
            ("q", 5, D(2022, 6, 1), 55.0, "R", "A", 0)]
    terms = spark.createDataFrame(
        rows, "pol_id string, pol_prd_id int, pol_eff_dt date, prem double, new_rnw_cd string, rate_plan_cd string, cancel_flag int"
    )
    ft = spark.createDataFrame([(1, 99.0), (2, 105.0), (3, None), (5, 60.0)], "pol_prd_id int, frst_trans_prem double")
    cols = ["pol_prd_id", "frst_trans_prem", "prev_trm_frst_trans_prem", "renewal_prem_change", "renewal_prem_change_grp"]
    pre = P.term_history(terms.join(ft, "pol_prd_id", "left"), compare=["rate_plan_cd"], acct_cr=None, first_prem="frst_trans_prem")
    post = P.term_history(terms, compare=["rate_plan_cd"], acct_cr=None, first_prem="frst_trans_prem", first_prem_table=ft,
                          bucket=F.year("pol_eff_dt"))
    assert sorted(map(tuple, pre.select(*cols).collect())) == sorted(map(tuple, post.select(*cols).collect()))
