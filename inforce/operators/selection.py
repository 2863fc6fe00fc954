"""Row selection operators: newest row per key, ties-kept extremes, cohort
membership, campaign purity, indicator drops, list maintenance (W01, W02,
W08, W24, W27, W38, W39).

All per-key selections are windows partitioned by the key: one hash
exchange on the key, and ``row_number()/rank() == 1`` filters are planned
with a partial WindowGroupLimit before the shuffle, so each task forwards
only its local top row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inforce.operators.common import drop_null_keys, exclude_keys, order_cols
from inforce.operators.sequence import ordered_lags


# --------------------------------------------------------------------------- W01
def latest_by_key(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column],
    tiebreak: Sequence[str | Column] = (),
    descending: bool = True,
) -> DataFrame:
    """One newest row per key (``ROW_NUMBER() OVER (PARTITION BY key ORDER BY
    order DESC) = 1``). NULL order values sort first when descending, as in the
    source warehouse; ``tiebreak`` makes the pick deterministic."""
    w = Window.partitionBy(*key).orderBy(*order_cols(order, descending), *order_cols(tiebreak, descending))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_with_aggs(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    keep: Sequence[str],
    aggs: Sequence[Column] = (),
    descending: bool = True,
) -> DataFrame:
    """Newest row per key (its ``keep`` columns) together with other per-key
    aggregates, in one aggregation: ``max_by(row, ordering)`` is combined
    map-side like any aggregate, so each task ships one partial row per key and
    the input is scanned once (instead of a window plus a separate group-by).
    Ordering puts NULLs first, as ``latest_by_key`` (descending by default,
    ``descending=False`` gives the earliest row); ``order`` should be unique
    within a key."""
    row = F.struct(*[F.col(c) for c in keep])
    if descending:
        ordering = F.struct(*[e for c in order for e in (F.col(c).isNull(), F.col(c))])
        pick = F.max_by(row, ordering)
    else:
        ordering = F.struct(*[e for c in order for e in (F.col(c).isNotNull(), F.col(c))])
        pick = F.min_by(row, ordering)
    g = df.groupBy(*key).agg(pick.alias("_latest"), *aggs)
    return g.select(*key, "_latest.*", *[a for a in g.columns if a not in (*key, "_latest")])


# --------------------------------------------------------------------------- W02
def extreme_by_key(df: DataFrame, key: Sequence[str], col: str, kind: str = "max") -> DataFrame:
    """All rows whose ``col`` equals its per-key max (or min), ties kept.
    ``rank() == 1`` (not ``max() OVER = col``) so the planner can apply a
    partial group limit; NULL values never qualify."""
    c = F.col(col)
    w = Window.partitionBy(*key).orderBy(c.desc_nulls_last() if kind == "max" else c.asc_nulls_last())
    return (
        df.filter(c.isNotNull())
        .withColumn("_rk", F.rank().over(w))
        .filter(F.col("_rk") == 1)
        .drop("_rk")
    )


# --------------------------------------------------------------------------- W08
def cohort_split(
    book: DataFrame,
    members: DataFrame,
    key: str = "pol_id",
) -> dict[str, DataFrame]:
    """The same book split three ways: members (semi join), the whole book, and
    the book minus members (anti join on non-null member keys)."""
    return {
        "members": book.join(drop_null_keys(members.select(key), [key]), key, "left_semi"),
        "book": book,
        "book_minus_members": exclude_keys(book, members, [key]),
    }


def renewal_window(exp_col: str, window_start, as_of, lead_days: int = 60) -> Column:
    """Set to renew within ``lead_days``: (exp - lead) in [start, as_of], or exp after as_of."""
    e = F.col(exp_col)
    return F.date_sub(e, lead_days).between(F.lit(window_start), F.lit(as_of)) | (e > F.lit(as_of))


# --------------------------------------------------------------------------- W24
def campaign_purity(rows: DataFrame, id_col: str = "pol_id", arm_col: str = "ctrl_test_cd", control: str = "C") -> DataFrame:
    """Keep rows whose id sits in exactly one arm. The source averages an arm
    code (control=1, anything else incl. NULL=2) and keeps averages 1 or 2;
    that is "min code = max code", computed here per id and semi-joined back."""
    code = F.when(F.col(arm_col) == control, 1).otherwise(2)
    pure = rows.groupBy(id_col).agg(F.min(code).alias("_lo"), F.max(code).alias("_hi")).filter(
        F.col("_lo") == F.col("_hi")
    )
    return rows.join(pure.select(id_col), id_col, "left_semi")


def test_only_once(rows: DataFrame, id_col: str = "pol_id", arm_col: str = "ctrl_test_cd", test: str = "T") -> DataFrame:
    """Variant: ids with exactly one row, in the test arm, never in control."""
    g = rows.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.when(F.col(arm_col) != test, 1).otherwise(0)).alias("_other")
    )
    return g.filter((F.col("_n") == 1) & (F.col("_other") == 0)).select(id_col)


# --------------------------------------------------------------------------- W27
def credit_removed(
    terms: DataFrame,
    key: str = "pol_id",
    order: Sequence[str] = ("pol_eff_dt", "pol_prd_id"),
    ind: str = "acct_cr_ind",
    keep: Sequence[str] = (),
    bucket: Column | None = None,
) -> DataFrame:
    """Rows whose indicator dropped 1 -> 0 from the previous term
    (``LAG(ind) - ind = 1``), distinct. ``bucket`` makes the lag skew-safe; the
    columns in use are then written to the shared folder when this is called."""
    lagged = ordered_lags(terms, [key], order, {ind: (1,)}, bucket, keep=list(dict.fromkeys([key, ind, *keep])))
    dropped = (F.col(f"lag1_{ind}") - F.col(ind)) == 1
    return lagged.filter(dropped).select(key, ind, *keep).distinct()


# --------------------------------------------------------------------------- W38
def tag_and_stack(frames: Mapping[str, DataFrame], label_col: str = "source", dedupe: Sequence[str] = ()) -> DataFrame:
    """Append tables with a literal label column (``unionByName``). Frames named
    in ``dedupe`` are made distinct first; the others keep duplicates."""
    out = None
    for label, df in frames.items():
        part = df.distinct() if label in dedupe else df
        part = part.withColumn(label_col, F.lit(label))
        out = part if out is None else out.unionByName(part)
    return out


# --------------------------------------------------------------------------- W39
def exclude_members(df: DataFrame, ids: DataFrame, key: str = "pol_id") -> DataFrame:
    """``DELETE FROM df WHERE key IN (ids)`` as an anti join (NULL ids ignored)."""
    return exclude_keys(df, ids, [key])


def missing_ids(ids: DataFrame, facts: DataFrame, key: str = "pol_id") -> DataFrame:
    """Listed ids with no row in the fact table (``NOT IN``, NULLs removed)."""
    return exclude_keys(drop_null_keys(ids.select(key), [key]), facts, [key]).distinct()


def common_ids(a: DataFrame, b: DataFrame, key: str = "pol_id") -> DataFrame:
    """Ids present in both lists."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "inner")
