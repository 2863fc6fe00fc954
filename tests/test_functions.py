import datetime as dt

import duckdb
import pytest

from inforce.functions.bands import band_expr, band_sql
from inforce.functions.columns import (
    date_from_yyyymmdd,
    div0,
    earned_exposure,
    pct_diff_signed,
    pct_diff_symmetric,
    ratio,
    round_half_up,
)


def test_yyyymmdd_zero_and_null_mean_none(spark):
    df = spark.createDataFrame([(20240229,), (0,), (None,)], "d int")
    out = [r[0] for r in df.select(date_from_yyyymmdd("d")).collect()]
    assert out == [dt.date(2024, 2, 29), None, None]


@pytest.mark.parametrize(
    "month,expected",
    [("202402", 29 / 366), ("190002", 28 / 365), ("200002", 29 / 366), ("202302", 28 / 365), ("202407", 31 / 366)],
)
def test_earned_exposure_leap_rules(spark, month, expected):
    v = spark.createDataFrame([(month,)], "m string").select(earned_exposure("m")).first()[0]
    assert v == pytest.approx(expected)


def test_ratio_and_div0_zero_denominators(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 4.0)], "a double, b double")
    r = df.select(ratio("a", "b", 6).alias("r"), div0("a", "b").alias("z")).collect()
    assert [x.r for x in r] == [None, None, 0.75]
    assert [x.z for x in r] == [0.0, None, 0.75]


def test_round_half_up_matches_sql_twin(spark):
    vals = [2.5, -2.5, 0.125, 1.005, 230.45625, 7.75635, 0.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    con = duckdb.connect()
    sql = "SELECT sign(x) * floor(abs(x) * CAST(100 AS DOUBLE) + 0.5) / CAST(100 AS DOUBLE) FROM (VALUES " + \
        ", ".join(f"({v!r}::DOUBLE)" for v in vals) + ") t(x)"
    want = [r[0] for r in con.sql(sql).fetchall()]
    assert got == want
    assert got[0] == 2.5 and got[1] == -2.5


def test_pct_diffs(spark):
    df = spark.createDataFrame([(100.0, 110.0), (0.0, 5.0), (0.0, 0.0)], "a double, b double")
    r = df.select(pct_diff_signed("a", "b", 2), pct_diff_symmetric("a", "b", 2)).collect()
    assert r[0][0] == 10.0 and r[0][1] == pytest.approx(9.52, abs=1e-9)
    assert r[1][0] is None and r[1][1] == 200.0
    assert r[2][0] is None and r[2][1] is None


RULES = [
    {"label": "low", "hi": 10},
    {"label": "mid", "lo": 10, "hi": 20},
    {"label": "overlap", "lo": 15, "hi": 30},
    {"label": "zero", "eq": 0},
    {"label": "none", "is_null": True},
]


def test_band_first_vs_last_match(spark):
    df = spark.createDataFrame([(0,), (5,), (15,), (25,), (None,), (40,)], "x int")
    first = [r[0] for r in df.select(band_expr("x", RULES, default="other")).collect()]
    last = [r[0] for r in df.select(band_expr("x", RULES, default="other", first_match=False)).collect()]
    assert first == ["low", "low", "mid", "overlap", "none", "other"]
    assert last == ["zero", "low", "overlap", "overlap", "none", "other"]


def test_band_sql_twin_agrees(spark):
    xs = [None, -1, 0, 5, 9, 10, 14, 15, 19, 20, 29, 30, 99]
    df = spark.createDataFrame([(x,) for x in xs], "x int")
    got = [r[0] for r in df.select(band_expr("x", RULES, default="other")).collect()]
    con = duckdb.connect()
    vals = ", ".join(f"({'NULL' if x is None else x}::INTEGER)" for x in xs)
    want = [r[0] for r in con.sql(f"SELECT {band_sql('x', RULES, default='other')} FROM (VALUES {vals}) t(x)").fetchall()]
    assert got == want
