"""Fresh reads, whole totals and the rules that a fixture cannot show."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from inforce import session
from inforce.operators import campaign as C
from inforce.operators import events as EV
from inforce.operators import persistency as P
from inforce.operators import reconcile as R
from inforce.plans import QUERIES
from inforce.plans import reconcile_plans as RP
from inforce.sources import schemas as SC

SF = "/root/testdata/sf0.01"
D = dt.date


def test_a_query_sees_rows_appended_after_it_ran_once(spark):
    folder = tempfile.mkdtemp(prefix="inforce-append-")
    for t in ("orders", "customer"):
        spark.read.parquet(os.path.join("/root/testdata/sf0.001", f"{t}.parquet")).write.parquet(os.path.join(folder, f"{t}.parquet"))
    before = QUERIES["w41_profile"](spark, folder).first()
    more = spark.read.parquet(os.path.join("/root/testdata/sf0.001", "orders.parquet")).withColumn("o_custkey", F.lit(1).cast("bigint"))
    more.write.mode("append").parquet(os.path.join(folder, "orders.parquet"))
    after = QUERIES["w41_profile"](spark, folder).first()
    assert after != before


def test_update_keeps_the_total_when_target_keys_repeat(spark):
    target = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 6.0), ("b", None, 0.0), ("b", None, 0.0), ("c", 3, 1.0)], "k string, m int, ee double")
    source = spark.createDataFrame([("a", 1, 3.0), ("a", 1, 5.0), ("b", None, 10.0)], "k string, m int, v double")
    out = {(r.k, r.ee, r.v) for r in R.update_from(target, source, ["k", "m"], {"v": 0.0}, null_safe=["m"], share="ee").collect()}
    assert out == {("a", 2.0, 2.0), ("a", 6.0, 6.0), ("b", 0.0, 5.0), ("c", 1.0, 0.0)}
    total = R.update_from(target, source, ["k", "m"], {"v": 0.0}, null_safe=["m"]).agg(F.sum("v")).first()[0]
    assert total == 18.0


def test_update_total_equals_allocation_total_on_whole_tables(spark):
    alloc = RP.alloc(spark, SF)
    updated = R.update_from(RP.ulm_loss(spark, SF), alloc, RP._KEYS, {"adj_ttl_pp": 0.0}, null_safe=["pol_prd_id"], share="ee")
    a, b = (df.agg(R.exact_sum("adj_ttl_pp")).first()[0] for df in (alloc, updated))
    assert abs(a - b) < 1e-3 and a > 0
    repeated = RP.ulm_loss(spark, SF).groupBy(*RP._KEYS).count().filter("count > 1").count()
    assert repeated > 0  # the case exists in the data


def test_allocation_without_exposure(spark):
    loss = spark.createDataFrame([("p", 1, "BI", 0.0), ("p", 2, "BI", 1.0), ("p", 2, "BI", 3.0), ("p", None, "BI", 1.0)], "pol_id string, pol_prd_id int, cov_type_abbr string, ee double")
    model = spark.createDataFrame([(1,), (2,)], "cv_plcy_period_id int")
    for c in R.MODEL_COVERAGES:
        model = model.withColumn(f"adj_{c}_pp_pred", F.lit(10.00004)).withColumn(f"{c}_exposure", F.lit(1.0))
    plain = {(r.pol_prd_id, r.ee): (r.ttl_cov_ee, r.ee_percent, r.adj_bi_pp, r.adj_ttl_pp) for r in R.allocate_prediction(loss, model).collect()}
    assert plain[(1, 0.0)] == (0.0, None, None, None)
    assert plain[(2, 1.0)] == (4.0, 0.25, 2.50001, 2.50001) and (None, 1.0) not in plain
    rounded = {(r.pol_prd_id, r.ee): (r.adj_bi_pp, r.adj_ttl_pp) for r in R.allocate_prediction(loss, model, digits=4).collect()}
    assert rounded[(1, 0.0)] == (None, 0.0) and rounded[(2, 1.0)] == (2.5, 2.5)


def test_billing_buckets_by_hand(spark):
    day = D(2000, 2, 1)
    rows = [("1", "Full Pay", "ACT_A1"), ("2", "Full Pay", "ACT_A5"), ("3", "Monthly Installments", "ACT_A4"), ("4", "Monthly Installments", "ACT_A6"),
            ("5", "Full Pay (Mortgagee)", "ACT_A9"), ("6", "Full Pay (Mortgagee)", None), ("7", "Quarterly", "ACT_A1"), ("8", "Full Pay", "ACT_A9")]
    bill = spark.createDataFrame([(p, day, c, i) for p, i, c in rows], "pol_id string, pol_eff_dt date, bill_acct_plan_typ_cd string, bill_instal_typ_desc string")
    book = bill.select("pol_id", "pol_eff_dt")
    window = (D(2000, 1, 1), D(2000, 3, 1))
    home = {r.bucket: r.cnt for r in C.inforce_billing_buckets(book, bill, window, D(2000, 1, 1), "home").collect()}
    assert home == {"Auto Full Pay": 1, "On Demand Full Pay": 1, "Auto Monthly Pay": 1, "On Demand Monthly Pay": 1, "Mortgagee Full Pay": 2, "N/A": 1}
    auto = {r.bucket: r.cnt for r in C.inforce_billing_buckets(book, bill, window, D(2000, 1, 1), "auto").collect()}
    assert auto == {"Auto Full Pay": 1, "Auto Monthly Pay": 1, "On Demand Monthly Pay": 1, "N/A": 2}
    late = C.inforce_billing_buckets(book, bill, (D(2000, 3, 1), D(2000, 4, 1)), D(2000, 2, 2), "home")
    assert late.count() == 0


def test_id_lists_by_hand(spark):
    rows = [("12345678901",), ("12345678901,",), ("11111111111, 22222222222",), ("11111111111,ph123,pa9", ), ("",), (None,), (" , 33333333333 ,",), ("short",)]
    df = spark.createDataFrame([(v, D(2024, 1, 1)) for (v,) in rows], "policy_num string, event_day date")
    got = sorted(r.pol_id for r in EV.normalize_id_list(df).collect())
    assert got == ["11111111111", "12345678901", "22222222222", "33333333333", "short"]


def test_premium_of_a_replaced_policy_stands_in_for_the_prior_term(spark):
    rows = [("a", 1, D(2020, 1, 1), 110.0, "R", 100.0), ("a", 2, D(2021, 1, 1), 121.0, "R", 100.0), ("b", 3, D(2020, 1, 1), 50.0, "R", None), ("c", 4, D(2020, 1, 1), 50.0, "N", 40.0)]
    df = spark.createDataFrame(rows, "pol_id string, pol_prd_id int, pol_eff_dt date, prem double, new_rnw_cd string, old_prem double")
    out = {r.pol_prd_id: r for r in P.term_history(df, compare=(), cancel_flag=None, acct_cr=None, previous_prem="old_prem").collect()}
    assert (out[1].prev_term_prem, out[1].renewal_prem_change, out[1].renewal_prem_change_grp) == (100.0, 0.1, "d. 10 to 19")
    assert (out[2].prev_term_prem, out[2].renewal_prem_change) == (110.0, 0.1)
    assert (out[3].prev_term_prem, out[3].renewal_prem_change) == (0.0, None)
    assert (out[4].prev_term_prem, out[4].renewal_prem_change) == (40.0, None)  # new business has no change
    plain = {r.pol_prd_id: r.renewal_prem_change for r in P.term_history(df, compare=(), cancel_flag=None, acct_cr=None).collect()}
    assert plain[1] is None


def test_conform_names_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "clm_id long, loss_evnt_num int")
    with pytest.raises(ValueError, match="pol_id"):
        SC.conform(df, "claims")
    rest = tuple(f.name for f in SC.SCHEMAS["claims"].fields if f.name not in df.columns)
    assert SC.conform(df, "claims", absent=rest).first().pol_id is None


def test_a_cluster_needs_a_shared_checkpoint_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"
        applicationId = "app"

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
