"""Replaced policies, narrow lags, side tables, linked pairs, one-scan reconciliation, versions, split plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from inforce.operators import linkage as LK
from inforce.operators import loss as L
from inforce.operators import persistency as P
from inforce.operators import reconcile as R
from inforce.operators import sequence as SQ
from inforce.plans.registry import QUERIES
from inforce.sources.io import split_predicates

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


# ----------------------------------------------------------------------------- W37 / W03
def test_yearly_change_uses_the_replaced_policys_premium(spark):
    """A renewal under a new id is compared with the replaced policy's latest premium."""
    d = dt.date
    terms = spark.createDataFrame(
        [
            ("old", 1, d(2019, 5, 1), 100.0, "N", None), ("old", 2, d(2020, 5, 1), 200.0, "R", None),
            ("new", 3, d(2021, 5, 1), 250.0, "R", 200.0), ("new", 4, d(2022, 5, 1), 300.0, "R", 200.0),
            ("other", 5, d(2021, 7, 1), 80.0, "R", None),  # a renewal without any earlier premium: counted, no change
        ],
        "pol_id string, pol_prd_id long, pol_eff_dt date, prem double, new_rnw_cd string, replaced double",
    )
    offers = spark.createDataFrame([(1, 100.0), (2, 150.0), (3, 220.0), (4, 275.0), (5, 80.0)], "pol_prd_id long, frst_trans_prem double")
    for bucket in (None, F.year("pol_eff_dt")):
        h = P.term_history(terms, compare=(), cancel_flag=None, acct_cr=None, first_prem="frst_trans_prem", first_prem_table=offers, previous_prem="replaced", keep=[], bucket=bucket)
        got = {r.pol_prd_id: (r.prev_term_prem, r.renewal_prem_change, r.renewal_prem_change_grp) for r in h.collect()}
        # offer / latest premium before it - 1; the old id's own terms are compared among themselves
        assert got == {1: (0.0, None, None), 2: (100.0, 0.5, "e. > 20"), 3: (200.0, 0.1, "d. 10 to 19"), 4: (250.0, 0.1, "d. 10 to 19"), 5: (0.0, None, None)}
        yearly = L.premium_change_by_year(h.filter("new_rnw_cd = 'R'"), "renewal_prem_change")
        assert rows(yearly) == [(2020, 0.5, 1), (2021, 0.05, 2), (2022, 0.1, 1)]


def test_build_with_replaced_policies_equals_the_registered_report(spark):
    from inforce.plans.persistency_build import build_persistency_table

    out = build_persistency_table(spark, SF, name="persistency_rewritten", rewritten=True)
    assert rows(out["premium_change_by_year"]) == rows(QUERIES["w37_rewritten_policies"](spark, SF))


def test_expected_change_is_joined_after_the_lags(spark):
    h = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "pol_id string, pol_prd_id long")
    side = spark.createDataFrame([(2, 0.5, "x"), (None, 0.7, "y"), (9, 0.1, "z")], "pol_prd_id long, rate double, grp string")
    assert rows(P.with_expected_change(h, side, ["rate", "grp"])) == [("a", 1, None, None), ("a", 2, 0.5, "x"), ("b", None, None, None)]


@pytest.mark.parametrize(("query", "most"), [("w27_credit_removed", 6), ("w38_tag_and_stack", 6), ("w39_missing_ids", 6), ("w40_loss_by_source", 6), ("w03_term_history", 15), ("w28_crosswalk", 6)])
def test_lags_write_only_the_columns_in_use(spark, monkeypatch, query, most):
    wide = []
    real = SQ.written

    def spy(df, name):
        wide.append(len(df.columns))
        return real(df, name)

    monkeypatch.setattr(SQ, "written", spy)
    QUERIES[query](spark, SF)
    # w38 to w40 also lag the transactions, with their reasons
    assert wide and min(wide) <= most and max(wide) <= 15


def test_lags_of_kept_columns_equal_the_plain_window(spark):
    rng = random.Random(4)
    data = [(rng.choice(["k", "k", "k", "m", None]), rng.choice([None, dt.date(2000 + rng.randrange(3), 1 + rng.randrange(12), 1)]), i, rng.choice([None, rng.randrange(9)]), rng.choice("xy"), i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, d date, i int, a int, b string, unused int").repartition(4)
    lags = {"a": (1, 3), "b": (2,), "d": (1,)}
    got = SQ.bucketed_lags(df, ["k"], ["d", "i"], F.year("d"), lags, keep=["i", "a"])
    want = SQ.plain_lags(df, ["k"], ["d", "i"], lags, keep=["i", "a"])
    assert got.columns == want.columns == ["i", "a", "lag1_a", "lag3_a", "lag2_b", "lag1_d"]
    assert rows(got) == rows(want)


# ----------------------------------------------------------------------------- W28
def test_crosswalk_from_pairs_equals_the_chain(spark):
    rng = random.Random(6)
    pick = lambda n, s: rng.choice([None, *[f"{s}{i}" for i in range(n)], *[str(i) for i in range(n)]])
    aq = spark.createDataFrame([(rng.randrange(30), pick(6, "a"), dt.date(2000, 1, 1 + rng.randrange(5))) for _ in range(80)], "qcn long, pol_id string, qte_dt date")
    hq = spark.createDataFrame([(rng.randrange(20), pick(6, "h"), dt.date(2000, 2, 1 + rng.randrange(5))) for _ in range(60)], "qcn long, pol_id string, qte_dt date")
    link = spark.createDataFrame([(rng.randrange(30), rng.randrange(20)) for _ in range(90)], "auto_qcn long, home_qcn long")
    start = spark.createDataFrame([(str(i % 4), "m" + str(i % 2)) for i in range(8)] + [(None, "m")], "pol_id string, meth string")
    inforce = spark.createDataFrame([("1",), ("3",), ("03",), ("h1",), (None,)], "pol_id string")
    pairs = LK.quote_pairs(aq, link, hq)
    assert rows(LK.crosswalk_from_pairs(pairs, start, inforce, "auto", "home", ("A", "H"))) == rows(LK.crosswalk(start, aq, link, hq, inforce, "auto_qcn", "home_qcn", "A", "H"))
    assert rows(LK.crosswalk_from_pairs(pairs, start, inforce, "home", "auto", ("H", "A"))) == rows(LK.crosswalk(start, hq, link, aq, inforce, "home_qcn", "auto_qcn", "H", "A"))
    carried = LK.crosswalk_from_pairs(pairs, start, inforce, "auto", "home", ("A", "H"), ["meth"])
    assert rows(carried.drop("meth").distinct()) == rows(LK.crosswalk_from_pairs(pairs, start, inforce, "auto", "home", ("A", "H"))) and "meth" in carried.columns


# ----------------------------------------------------------------------------- W19
def test_one_scan_reconciliation_equals_the_single_ones(spark):
    rng = random.Random(8)

    def table(n):
        data = [(rng.choice([None, dt.date(1999 + rng.randrange(3), 1 + rng.randrange(12), 1)]), rng.randrange(-500, 9000), rng.choice([None, rng.randrange(900)])) for _ in range(n)]
        return spark.createDataFrame(data, "d date, x long, y long").select("d", (F.col("x") / 100).cast("decimal(18,2)").alias("x"), (F.col("y") / 1000).cast("decimal(18,4)").alias("y"))

    left, right = table(300), table(200).filter("year(d) <> 2000 or d is null")
    long = R.reconcile_all(left, right, {"xy": ("x", "y"), "x": ("x", "x")}, "d").collect()
    for name, (a, b) in {"xy": ("x", "y"), "x": ("x", "x")}.items():
        for grain, keys in (("all", []), ("year", [F.year("d")]), ("month", [F.year("d"), F.month("d")])):
            want = rows(R.reconcile_metric(left, right, a, b, keys))
            got = [tuple(x for x in (r.year_earned, r.month_earned) if x is not None) + (r.left_total, r.right_total, r.pct_diff) for r in long if r.metric == name and r.grain == grain]
            assert sorted(got, key=str) == sorted(want, key=str) and want


# ----------------------------------------------------------------------------- W09 / W06
def test_versions_match_at_most_once_and_overlaps_are_refused(spark):
    d = dt.date
    config = [("a", None, d(1999, 12, 31), 1), ("a", d(2000, 1, 1), d(2000, 6, 30), 2), ("a", d(2001, 1, 1), None, 3), ("b", None, None, 4), (None, None, None, 5)]
    cfg = spark.createDataFrame(config, "st string, lo date, hi date, v int")
    df = spark.createDataFrame([(1, "a", d(1999, 12, 31)), (2, "a", d(2000, 1, 1)), (3, "a", d(2000, 7, 1)), (4, "a", d(2024, 1, 1)), (5, "b", d(1980, 1, 1)), (6, "b", None), (7, None, d(2000, 1, 1)), (8, "c", d(2000, 1, 1))], "id int, st string, at date")
    got = L.effective_config(df, cfg, ["st"], "at", ("lo", "hi"), ["v"]).select("id", "v")
    assert rows(got) == [(1, 1), (2, 2), (4, 3), (5, 4)]
    for more in (("a", d(2000, 6, 30), d(2000, 7, 5), 6), ("b", d(2030, 1, 1), None, 7), ("a", None, None, 8)):
        with pytest.raises(ValueError, match="overlap"):
            L.effective_config(df, cfg.unionByName(spark.createDataFrame([more], cfg.schema)), ["st"], "at", ("lo", "hi"), ["v"])


def test_status_by_window_counts_each_window(spark):
    d = dt.date
    df = spark.createDataFrame(
        [("a", d(2000, 1, 5), 1, 0, 1, 0, 0), ("b", d(2000, 1, 31), 1, 1, 0, 0, 1), ("b", d(2000, 1, 31), 1, 1, 0, 0, 1), ("c", d(2000, 2, 1), 0, 0, 0, 0, 1), ("e", None, 1, 0, 1, 0, 0)],
        "pol_id string, pol_eff_dt date, atr_e_flat int, cancel_e_flat int, atr_e_30 int, cancel_e_30 int, cancel_flag int",
    )
    windows = {"jan": (d(2000, 1, 1), d(2000, 1, 31)), "both": (d(2000, 1, 1), d(2000, 2, 29))}
    got = rows(P.status_by_window(df, windows, ("flat", 30)))
    assert got == sorted([(0, "jan", "Active", 1), (0, "jan", "Cancel", 1), (0, "both", "Active", 1), (0, "both", "Cancel", 2), (30, "jan", "Active", 1), (30, "jan", "Cancel", 1), (30, "both", "Active", 1), (30, "both", "Cancel", 2)])


# ----------------------------------------------------------------------------- relational source
@pytest.mark.parametrize(("lower", "upper", "parts"), [(0, 99, 7), (-5, 5, 3), (1, 1, 4), (10, 12, 50), (0, 10**12, 16)])
def test_split_predicates_hold_every_row_once(spark, lower, upper, parts):
    values = [None, lower, upper, lower - 1, upper + 1, -(10**15), 10**15, (lower + upper) // 2] + [lower + (upper - lower) * i // 20 for i in range(20)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, k long")
    predicates = split_predicates("k", lower, upper, parts)
    assert 1 <= len(predicates) <= parts
    found = [r.i for p in predicates for r in df.filter(p).select("i").collect()]
    assert sorted(found) == list(range(len(values)))


def test_split_predicates_text():
    assert split_predicates("k", 1, 10, 3) == ["k < 4 OR k IS NULL", "k >= 4 AND k < 7", "k >= 7"]
    for bad in ((1, 0, 2), (0, 5, 0)):
        with pytest.raises(ValueError):
            split_predicates("k", *bad)


def test_jdbc_reads_by_predicates(monkeypatch):
    from inforce.sources.io import read_jdbc

    calls = []

    class Reader:
        def jdbc(self, url, table, **more):
            calls.append((url, table, more))

    class Session:
        read = Reader()

    read_jdbc(Session(), "jdbc:x", "t", {"user": "u"}, partition_column="k", lower_bound=1, upper_bound=10, num_partitions=3)
    read_jdbc(Session(), "jdbc:x", "t", predicates=["a = 1"])
    read_jdbc(Session(), "jdbc:x", "t")
    assert calls == [
        ("jdbc:x", "t", {"predicates": split_predicates("k", 1, 10, 3), "properties": {"user": "u"}}),
        ("jdbc:x", "t", {"predicates": ["a = 1"], "properties": {}}), ("jdbc:x", "t", {"properties": {}}),
    ]
    with pytest.raises(ValueError):
        read_jdbc(Session(), "jdbc:x", "t", partition_column="k")


# ----------------------------------------------------------------------------- W31
@pytest.mark.parametrize("bits", ["8388608", "64"])  # the second lets most sessions pass wrongly
def test_qualifying_sessions_filter_the_log_before_its_shuffle(spark, bits):
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    conf = {
        prefix + "enabled": "true", prefix + "applicationSideScanSizeThreshold": "0", prefix + "creationSideThreshold": "1g", prefix + "numBits": bits,
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    want = rows(QUERIES["w31_session_cohort"](spark, SF))
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = QUERIES["w31_session_cohort"](spark, SF)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan.split("Join LeftSemi")[1].split("Filter")[1]  # beside the scan, below the join
        assert rows(got) == want
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
