import datetime as dt

import pytest
from pyspark.sql import functions as F

from inforce.operators import loss as L
from inforce.operators import reconcile as R

D = dt.date


def test_cohort_extract_nb_is_strictly_after(spark):
    pol = spark.createDataFrame(
        [("a", 1, D(2024, 6, 30), D(2024, 8, 1)) + (0,) * 6, ("b", 1, D(2024, 7, 1), D(2024, 8, 1)) + (0,) * 6,
         ("c", 1, D(2024, 7, 1), D(2024, 8, 1), None, 0, 0, 0, 0, 0), ("d", 2, D(2024, 7, 1), D(2024, 6, 1)) + (1,) * 6],
        "pol_id string, risk_st int, orig_pol_eff_dt date, pol_eff_dt date, uw_afa_cnt int, uw_naf_cnt int, uw_comp_cnt int, "
        "uw_mltry_cnt int, uw_perm_cnt int, uw_rentl_cnt int",
    )
    cfg = spark.createDataFrame([(1, D(2024, 7, 11), "202407"), (2, D(2024, 7, 11), "202407")], "risk_st int, start_dt date, start_month string")
    out = {r.pol_id: r for r in L.cohort_extract(pol, cfg, D(2024, 12, 31)).collect()}
    assert set(out) == {"a", "b"}  # c has a NULL eligibility count, d starts before its state's date
    assert out["a"].pol_type == "Renewal" and out["b"].pol_type == "NB"
    assert out["a"].derived_yes_no_flag == L.NO_ACC_LABEL


def test_running_ratio_last_value_is_grand_total(spark):
    rows = [("p1", "202401", "C", L.NO_ACC_LABEL, 10.0, 100.0, 0.1), ("p2", "202401", "C", L.NO_ACC_LABEL, 5.0, 50.0, 0.1),
            ("p1", "202402", "C", L.NO_ACC_LABEL, 20.0, 100.0, 0.1), ("p3", "202402", "D", L.YES_ACC_LABEL, 1.0, 0.0, 0.1)]
    df = spark.createDataFrame(rows, "pol_id string, earned_month string, clean_dirty_cd string, derived_yes_no_flag string, "
                                     "incur_loss double, epapr double, ee double")
    out = {(r.segment, r.earned_month): r for r in L.running_ratio(df).collect()}
    cc = out[(L.SEG_CLEAN_CLEAN, "202402")]
    assert cc.cum_loss == 35.0 and cc.cum_epapr == 250.0 and cc.cum_loss_ratio == 0.14 and cc.pol_cnt == 1
    assert out[(L.SEG_CLEAN_CLEAN, "202401")].pol_cnt == 2
    assert out[(L.SEG_DIRTY_DIRTY, "202402")].cum_loss_ratio is None  # zero premium -> no ratio


def test_relativity_and_share(spark):
    df = spark.createDataFrame(
        [("S", "x", "NB", 10.0, 100.0), ("S", "y", "Renewal", 30.0, 100.0), ("T", "x", "Renewal", 5.0, 50.0)],
        "risk_st string, segment string, pol_type string, incur_loss double, epapr double",
    )
    rel = {(r.risk_st, r.segment): r for r in L.relativity(df, ["risk_st", "segment"], ["risk_st"]).collect()}
    assert rel[("S", "x")].lrr == 0.5 and rel[("S", "y")].lrr == 1.5 and rel[("T", "x")].lrr == 1.0
    nb = {(r.risk_st, r.segment): r for r in L.relativity(df, ["risk_st", "segment"], ["risk_st"], "NB").collect()}
    assert nb[("S", "y")].segment_lr is None and nb[("S", "x")].lrr == 1.0
    shares = L.share_of_total(df, ["segment"], "epapr").collect()
    assert sum(r.share for r in shares) == pytest.approx(1.0)


def test_allocation_conservation_and_zero_exposure(spark):
    loss = spark.createDataFrame(
        [("p", 1, "BI", "202401", 3.0), ("p", 1, "BI", "202402", 1.0), ("p", 1, "MED", "202401", 2.0),
         ("q", 2, "BI", "202401", 0.0), ("q", 2, "BI", "202402", 0.0)],
        "pol_id string, pol_prd_id bigint, cov_type_abbr string, earned_month string, ee double",
    )
    cols = {"cv_plcy_period_id": [1, 2]}
    model_rows = []
    for pid in cols["cv_plcy_period_id"]:
        row = [pid]
        for c in R.MODEL_COVERAGES:
            row += [10.0, 2.0]
        model_rows.append(tuple(row))
    schema = "cv_plcy_period_id bigint, " + ", ".join(f"adj_{c}_pp_pred double, {c}_exposure double" for c in R.MODEL_COVERAGES)
    model = spark.createDataFrame(model_rows, schema)
    alloc = R.allocate_prediction(loss, model, digits=None)
    per = {r.pol_prd_id: r for r in alloc.groupBy("pol_prd_id").agg(F.sum("adj_bi_pp").alias("bi"), F.sum("adj_mp_pp").alias("mp")).collect()}
    assert per[1].bi == pytest.approx(20.0) and per[1].mp == pytest.approx(20.0)
    assert per[2].bi is None  # zero exposure: nothing to spread
    chk = {r.pol_prd_id: r for r in R.allocation_check(R.allocate_prediction(loss, model), model, within=False).collect()}
    assert chk["1"].bi_op == 20.0 and chk["1"].coll_ulm == 20.0 and chk["1"].coll_op == 0.0


def test_update_from_null_safe_and_deduplicated(spark):
    target = spark.createDataFrame([("a", None, 1.0), ("a", 1, 2.0), ("b", 1, 3.0)], "k string, prd int, ee double")
    source = spark.createDataFrame([("a", None, 5.0), ("a", 1, 1.0), ("a", 1, 2.0)], "k string, prd int, v double")
    out = {(r.k, r.prd): r.v for r in R.update_from(target, source, ["k", "prd"], {"v": 0.0}, null_safe=["prd"]).collect()}
    assert out == {("a", None): 5.0, ("a", 1): 3.0, ("b", 1): 0.0}
    assert R.update_from(target, source, ["k", "prd"], {"v": 0.0}, null_safe=["prd"]).count() == 3


def test_reconcile_metric_grains(spark):
    left = spark.createDataFrame([(2020, 100.0), (2021, 50.0)], "y int, m double")
    right = spark.createDataFrame([(2020, 110.0), (2021, 50.0)], "y int, m double")
    tot = R.reconcile_metric(left, right, "m", "m").first()
    assert (tot.left_total, tot.right_total, tot.pct_diff) == (150.0, 160.0, 6.67)
    by = {r._g0: r.pct_diff for r in R.reconcile_metric(left, right, "m", "m", ["y"]).collect()}
    assert by == {2020: 10.0, 2021: 0.0}


def test_maintenance_ddl_and_insert(spark):
    from inforce.operators import maintenance as MT

    t = spark.createDataFrame([("a", 1)], "k string, v int")
    t2 = MT.add_columns(t, {"adj": 0.0, "flag": "N"})
    assert t2.columns == ["k", "v", "adj", "flag"] and t2.first().adj == 0.0
    rows = spark.createDataFrame([(2, "b")], "v int, k string")
    by_name = MT.insert_into(t, rows)
    assert sorted(tuple(r) for r in by_name.collect()) == [("a", 1), ("b", 2)]
    pos = spark.createDataFrame([("c", 3)], "x string, y int")
    assert sorted(tuple(r) for r in MT.insert_into(t, pos, by_position=True).collect()) == [("a", 1), ("c", 3)]
    top = MT.top_rows(spark.createDataFrame([(i,) for i in range(100)], "x int"), 3, ["x"])
    assert [r.x for r in top.collect()] == [0, 1, 2]


def test_running_ratio_dashboard_filters(spark):
    rows = [("p1", "202401", "C", L.NO_ACC_LABEL, 10.0, 100.0, 0.1, "NB", 1),
            ("p2", "202401", "C", L.NO_ACC_LABEL, 5.0, 50.0, 0.1, "Renewal", 2)]
    df = spark.createDataFrame(rows, "pol_id string, earned_month string, clean_dirty_cd string, derived_yes_no_flag string, "
                                     "incur_loss double, epapr double, ee double, pol_type string, risk_st int")
    assert [r.cum_loss for r in L.running_ratio(df, business_type="NB").collect()] == [10.0]
    assert [r.cum_loss for r in L.running_ratio(df, states=[2]).collect()] == [5.0]
    assert [r.cum_loss for r in L.running_ratio(df).collect()] == [15.0]
