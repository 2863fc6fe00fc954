import os
import tempfile

import __spark_entry__ as E
from inforce.plans.dashboard import build_uw_dashboard
from inforce.sources import schemas as SC
from inforce.sources import staging as S
from inforce.sources.io import write_table

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dashboard_reports_match_registered_queries(spark):
    out = build_uw_dashboard(spark, SF, name="uw_rollup_test")
    assert _rows(out["running_ratio"]) == _rows(E.queries()["w12_running_ratio"](spark, SF))
    assert _rows(out["relativity"]) == _rows(E.queries()["w13_relativity_renewal"](spark, SF))


def test_domain_schema_roundtrip(spark):
    term = SC.conform(S.term(spark, SF), "term_history")
    path = os.path.join(tempfile.mkdtemp(prefix="inforce-io-"), "term")
    write_table(term, path, partition_by=["new_rnw_cd"])
    back = SC.read_domain(spark, "term_history", path)
    # a partition column is appended last when read back; names and types are kept
    assert sorted((f.name, f.dataType) for f in back.schema) == sorted((f.name, f.dataType) for f in SC.SCHEMAS["term_history"])
    assert back.count() == term.count()


def test_segment_summary_written_per_segmentation(spark):
    from inforce.operators import segment as G
    from inforce.session import materialize

    df = spark.createDataFrame([("a", "x", 1, 1.0), ("b", "x", 1, 2.0), ("a", "y", None, 3.0)],
                               "b1 string, b2 string, c int, m double")
    summ = materialize(G.segment_summary(df, ["b1", "b2"], "c", "m"))  # lineage cut in the checkpoint folder
    path = os.path.join(tempfile.mkdtemp(prefix="inforce-seg-"), "summary")
    G.write_summary(summ, path)
    assert sorted(p for p in os.listdir(path) if p.startswith("segmentation=")) == ["segmentation=b1", "segmentation=b2"]
    back = spark.read.parquet(path)
    assert back.count() == summ.count() == 4


def test_persistency_build_reports_match_registered_queries(spark):
    from inforce.plans.persistency_build import build_persistency_table

    out = build_persistency_table(spark, SF, name="persistency_test")
    assert _rows(out["premium_change_by_year"]) == _rows(E.queries()["w37_premium_change_by_year"](spark, SF))
    ult = {r.pol_prd_id: r.ult_canc_cnt for r in E.queries()["w05_ultimate_cancel"](spark, SF).collect()}
    got = {r.pol_prd_id: r.ult_canc_cnt for r in out["table"].select("pol_prd_id", "ult_canc_cnt").collect()}
    assert got == ult


def test_readme_usage_on_schema_conformed_tables(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from inforce.operators import loss as L
    from inforce.operators import persistency as P
    from inforce.operators import selection as SEL

    terms = SC.conform(S.term(spark, SF), "term_history")
    loss = SC.conform(S.loss(spark, SF), "operational_loss")
    uw = SC.conform(S.auto_policy(spark, SF), "auto_policy_latest")
    cfg = spark.createDataFrame([(str(i), dt.date(1999, 7, 11), "199907") for i in range(25)],
                                "risk_st string, start_dt date, start_month string")
    rollup = L.loss_rollup(loss, L.cohort_extract(uw, cfg, as_of=S.AS_OF), exclude_cov=["R"])
    rollup = L.reclassify(rollup, F.col("clean_dirty_cd") == "D", "derived_yes_no_flag", L.YES_ACC_LABEL)
    assert L.running_ratio(rollup).count() > 0
    latest = SEL.latest_by_key(P.development_flags(terms, as_of=S.AS_OF), ["pol_id"], ["pol_eff_dt"], ["pol_prd_id"])
    assert P.persistency_rate(latest, "flat").first().atr_sum > 0
