import datetime as dt

import pytest
from pyspark.sql import functions as F

from inforce.functions.bands import band_expr
from inforce.operators import events as EV
from inforce.operators import linkage as LK
from inforce.operators import segment as G
from inforce.plans import segment_plans as SP

D = dt.date


@pytest.mark.parametrize(
    "score,label", [(0, "NH/NS"), (1, "Decile 10"), (504, "Decile 10"), (505, "Decile 09"), (825, "Decile 02"),
                    (826, "Decile 01"), (997, "Decile 01"), (998, "NH/NS"), (None, None)]
)
def test_decile_edges(spark, score, label):
    df = spark.createDataFrame([(score,)], "s int")
    assert df.select(band_expr("s", SP.decile_rules())).first()[0] == label


def test_two_dimensional_band_gap_and_none(spark):
    df = spark.createDataFrame([("250000", "1500"), ("250000", "1500.5"), ("None", "None"), ("700000", "2600")],
                               "lmt string, sqft string")
    df = df.select(G.numeric_from_text("lmt").alias("dwelling_lmt_num"), G.numeric_from_text("sqft").alias("sqft_num"))
    out = [r[0] for r in df.select(band_expr("sqft_num", SP.coverage_sqft_rules(), default="no_coverage")).collect()]
    assert out == ["<$300k and sqft 0-1500", "no_coverage", "<$300k and sqft 0-1500", "$650k+ and sqft 2501+"]


def test_relativity_rows_and_summary(spark):
    df = spark.createDataFrame(
        [(1, "A", 1.0, "x", 1), (2, "A", 3.0, "y", None), (3, "B", 2.0, "x", 1), (4, None, 5.0, None, 1)],
        "qcn int, state string, lr double, band string, cnt_col int",
    )
    rel = {r.qcn: r for r in G.relativity_rows(df, "state", {"lr": "elrr"}).collect()}
    assert rel[1].elrr == 0.5 and rel[2].elrr == 1.5 and rel[3].elrr == 1.0 and rel[4].elrr is None
    summ = G.segment_summary(G.relativity_rows(df, "state", {"lr": "elrr"}), ["band"], "cnt_col", "elrr").collect()
    got = {(r.segmentation, r.band): (r.cnt, r.lrr) for r in summ}
    assert got == {("band", "x"): (2, 0.75), ("band", "y"): (0, 1.5)}  # NULL band dropped


def test_normalize_id_list_cases(spark):
    rows = [
        ("", D(2024, 1, 1)),                                   # blank -> dropped
        ("00000000001", D(2024, 1, 2)),                        # 11 chars
        ("00000000002,", D(2024, 1, 3)),                       # 11 + stray comma
        ("00000000003, ph123, 00000000004", D(2024, 1, 4)),    # list with a quote id
        ("00000000005,pa9,", D(2024, 1, 5)),                   # 16 chars with a trailing comma -> blank part dropped
        ("0000000000612", D(2024, 1, 6)),                      # 13 chars -> treated as a list of one
    ]
    df = spark.createDataFrame(rows, "policy_num string, event_day date")
    out = sorted((r.pol_id, r.event_day.day) for r in EV.normalize_id_list(df).collect())
    assert out == [("00000000001", 2), ("00000000002", 3), ("00000000003", 4), ("00000000004", 4),
                   ("00000000005", 5), ("0000000000612", 6)]
    latest = EV.latest_day_per_id(
        spark.createDataFrame([("a", D(2024, 12, 5)), ("a", D(2025, 1, 3))], "pol_id string, event_day date")
    ).first()
    assert latest.event_day == D(2025, 1, 3) and latest.event_month == "JAN-2025"  # not the alphabetical max 'DEC-2024'


def test_session_cohort_semi_join(spark):
    ev = spark.createDataFrame(
        [("s1", "a", D(2024, 1, 1), True), ("s1", "a", D(2024, 1, 2), False), ("s2", "b", D(2024, 1, 1), False)],
        "session_id string, policy_num string, event_day date, q boolean",
    )
    rows = EV.session_cohort(ev, F.lit(True), F.col("q")).collect()
    assert sorted((r.policy_num, r.event_day.day) for r in rows) == [("a", 1), ("a", 2)]


def test_crosswalk_non_numeric_ids_never_match(spark):
    start = spark.createDataFrame([("1",)], "pol_id string")
    qa = spark.createDataFrame([(10, "1", D(2024, 1, 1))], "qcn bigint, pol_id string, qte_dt date")
    link = spark.createDataFrame([(10, 20), (10, 21)], "a_qcn bigint, b_qcn bigint")
    qb = spark.createDataFrame([(20, "01RA5", D(2024, 1, 2)), (21, "0042", D(2024, 1, 3))], "qcn bigint, pol_id string, qte_dt date")
    inforce = spark.createDataFrame([("01RA5",), ("42",)], "pol_id string")
    out = LK.crosswalk(start, qa, link, qb, inforce, "a_qcn", "b_qcn", "A", "B").collect()
    assert [(r.end_pol_id, r.pol_start, r.pol_end) for r in out] == [("0042", "A", "B")]


def test_attribute_mismatch_ignores_null_pairs(spark):
    df = spark.createDataFrame([("x", "x"), ("x", "y"), (None, "y"), ("z", None)], "a string, b string")
    r = LK.attribute_mismatch(df, [("a", "b")]).first()
    assert (r.total_cnt, r.a_diff_cnt, r.any_diff_cnt) == (4, 1, 1)


def test_stack_lines_prefers_line_a(spark):
    cohort = spark.createDataFrame([("1",), ("2",), ("3",)], "pol_id string")
    a = spark.createDataFrame([("1", "Auto", 5)], "pol_id string, pol_type string, v int")
    b = spark.createDataFrame([("1", "Home", 7, 1), ("2", "Home", 8, 2)], "pol_id string, pol_type string, v int, w int")
    out = {r.pol_id: r for r in LK.stack_lines(cohort, a, b, {"pol_type": ("pol_type", "pol_type"), "v": ("v", "v"),
                                                                  "w": (None, "w")}).collect()}
    assert set(out) == {"1", "2"}
    assert (out["1"].pol_type, out["1"].v, out["1"].w) == ("Auto", 5, 1)
    assert (out["2"].pol_type, out["2"].v) == ("Home", 8)
