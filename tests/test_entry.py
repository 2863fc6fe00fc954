"""End-to-end: every registered query runs on sf0.001 and agrees with its DuckDB oracle."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from inforce.sources.tables import TABLES, table_path

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["segment", "earned_month", "cum_loss", "cum_epapr", "cum_loss_ratio", "cum_ee", "pol_cnt"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    from inforce.plans import ORACLES, QUERIES

    assert set(ORACLES) == set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(row):
    out = []
    for v in row:
        if isinstance(v, float):
            v = None if math.isnan(v) else round(v, 9)
        out.append(v)
    return tuple(out)


def _key(r):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(SF, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in sdf.columns]
    s = sorted((_norm(r) for r in sdf.collect()), key=_key)
    d = sorted((_norm(tuple(r[i] for i in order)) for r in rel.fetchall()), key=_key)
    assert s == d


def _pandas_rows(pdf):
    import pandas as pd

    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        if pd.api.types.is_float_dtype(pdf[c]):
            pdf[c] = pdf[c].round(6)
    return sorted(map(tuple, pdf.astype(str).values.tolist()))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle_through_pandas(spark, duck, name):
    """The same comparison read through pandas, where NULL integers, NULL dates
    and negative zero would otherwise differ between the two engines."""
    assert _pandas_rows(E.queries()[name](spark, SF).toPandas()) == _pandas_rows(duck.sql(E.oracle_sql()[name]).df())
