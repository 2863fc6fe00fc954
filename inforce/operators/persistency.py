"""Persistency: development flags, term history, ultimate cancellations,
status and retention rates, code transitions, reinstatements (W03-W07,
W30, W35).

Scale notes
-----------
* All flags of W04 are one ``select`` of ``CASE`` expressions: no shuffle,
  one pass inside whole-stage codegen.
* All lags of W03 share one window spec, so Spark plans a single exchange
  and sort on the policy key for the whole history block.
* The development-factor table is a parameter table (periods x new/renew,
  a few dozen rows) and is broadcast.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inforce.functions.bands import band_expr
from inforce.functions.columns import date_from_yyyymmdd, days_between, div0, no_negative_zero, ratio, round_half_up
from inforce.operators.common import bounded_broadcast
from inforce.operators.sequence import ordered_lags

# Fixed values of the source's development ladder.
DEV_DAYS = (30, 60, 90, 120, 150, 180, 210, 240, 270, 300, 330)
PRE_DAYS = (45, 30, 15)
PERIOD_ONE = "1"
# renewal premium change bands (first match wins): label, lower bound (incl.), upper bound (excl.)
PREMIUM_CHANGE_BANDS = [
    {"label": "a. < -5", "hi": -0.05},
    {"label": "b. -5 to 0", "lo": -0.05, "hi": 0.0},
    {"label": "c. 0 to 9", "lo": 0.0, "hi": 0.1},
    {"label": "d. 10 to 19", "lo": 0.1, "hi": 0.2},
    {"label": "e. > 20", "lo": 0.2},
]
STATUS_ACTIVE, STATUS_CANCEL, STATUS_PENDING = "Active", "Cancel", "Pending"


def cancelled(eff: str = "pol_eff_dt", canc: str = "canc_eff_dt") -> Column:
    """1 for a cancelled term, 0 for one that is not (a cancellation on day 365 is an expiry)."""
    c = F.col(canc)
    return F.when(c.isNull() | (days_between(c, F.col(eff)) == 365), 0).otherwise(1)


def flag_names(prefix: str) -> list[str]:
    return [f"{prefix}_flat"] + [f"{prefix}_{n}" for n in DEV_DAYS] + [f"{prefix}_365"]


# --------------------------------------------------------------------------- W04
def development_flags(
    terms: DataFrame,
    as_of: dt.date,
    eff: str = "pol_eff_dt",
    canc: str = "canc_eff_dt",
    canc_trans: str | None = "canc_trans_dt",
    flat_cancel: Column | None = None,
) -> DataFrame:
    """ATR_E_n ("term has attained n days by as_of") and CANCEL_E_n ("cancelled
    within n days, and n days attained") for n in flat, 30..330, 365; plus the
    cancel flag, day counts and pre-effective attainment/cancellation flags."""
    a = F.lit(as_of)
    e = F.col(eff)
    c = F.col(canc)
    days_canc = days_between(c, e)
    days_eff = days_between(a, e)
    out = [F.col("*")]
    out.append(F.lit(1).alias("pol_cnt"))
    out.append((flat_cancel if flat_cancel is not None else F.lit(0)).cast("int").alias("flat_cancel_flag"))
    out.append(F.when(c.isNull(), F.lit(-1)).otherwise(days_canc).alias("num_days_canc"))
    out.append(days_eff.alias("num_days_eff"))
    out.append(cancelled(eff, canc).alias("cancel_flag"))
    out.append(F.when(c.isNotNull() & (days_canc <= 0) & (a >= e), 1).otherwise(0).alias("cancel_e_flat"))
    for n in DEV_DAYS:
        out.append(F.when(c.isNotNull() & (days_canc <= n) & (days_eff >= n), 1).otherwise(0).alias(f"cancel_e_{n}"))
    # day 365 uses a strict bound (a cancellation exactly at 365 days is an expiry)
    out.append(F.when(c.isNotNull() & (days_canc < 365) & (days_eff >= 365), 1).otherwise(0).alias("cancel_e_365"))
    out.append(F.when(days_eff >= 0, 1).otherwise(0).alias("atr_e_flat"))
    for n in (*DEV_DAYS, 365):
        out.append(F.when(days_eff >= n, 1).otherwise(0).alias(f"atr_e_{n}"))
    for n in PRE_DAYS:
        out.append(F.when(days_eff >= -n, F.lit(1)).alias(f"atr_pre_{n}"))
    out.append(F.when(days_eff >= 0, F.lit(1)).alias("atr_pre"))
    df = terms.select(*out)
    if canc_trans is not None:
        lead = days_between(F.col(canc_trans), c)
        pre = []
        for n in PRE_DAYS:
            pre.append(
                F.when((F.col(f"atr_pre_{n}") == 1) & (lead <= -n) & (c == e), F.lit(1)).alias(f"canc_pre_{n}")
            )
        pre.append(F.when((F.col("atr_pre") == 1) & (lead <= 0) & (c == e), F.lit(1)).alias("canc_pre"))
        df = df.select(F.col("*"), *pre)
    return df


# --------------------------------------------------------------------------- W03
def term_history(
    terms: DataFrame,
    key: str = "pol_id",
    order: Sequence[str] = ("pol_eff_dt", "pol_prd_id"),
    prem: str = "prem",
    new_renew: str = "new_rnw_cd",
    compare: Sequence[str] = ("rate_plan_cd", "pol_form_cd"),
    cancel_flag: str | None = "cancel_flag",
    acct_cr: str | None = "acct_cr_ind",
    first_prem: str | None = None,
    bucket: Column | None = None,
    first_prem_table: DataFrame | None = None,
    row_id: str = "pol_prd_id",
    previous_prem: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Prior-term values (lag 1, lag 2), premium change and its band, "same as
    prior term" indicators, prior-term cancel and credit indicators.

    ``keep``: the columns of ``terms`` to carry along (all by default); fewer columns
    make the shuffle, and with ``bucket`` the written rows, narrower.

    ``previous_prem``: a column with the latest premium of the policy that this one
    replaced; it stands in for the prior term's premium where there is none (a
    renewal under a new id), and so enters the change and its band.

    The change compares the term's first-transaction premium (``first_prem``,
    default the term premium) with the prior term's latest one. All lags share
    one window spec; with ``bucket`` (e.g. the effective year) they are
    computed skew-safe (see ``sequence.bucketed_lags``, which writes the columns in
    use when it is called).

    With ``first_prem_table`` (``row_id`` -> ``first_prem``, e.g. the first
    transaction of each term from a much larger transaction table), the value
    is attached *after* the lags: once for the term and once for the prior term
    (joined on the lagged ``row_id``, which must identify a term), so the
    window inputs never include the transaction table."""
    lags: dict[str, tuple[int, ...]] = {prem: (1, 2)}
    for c in compare:
        lags[c] = (1,)
    if cancel_flag is not None:
        lags[cancel_flag] = (1,)
    if acct_cr is not None:
        lags[acct_cr] = (1,)
    if first_prem is not None and first_prem_table is None:
        lags[first_prem] = (1,)
    if first_prem_table is not None:
        lags[row_id] = (1,)
    keep = list(terms.columns) if keep is None else list(dict.fromkeys([*keep, key, *order, prem, new_renew, *compare, *([previous_prem] if previous_prem else [])]))
    if first_prem is not None and first_prem_table is None:
        keep = list(dict.fromkeys([*keep, first_prem]))
    lagged = ordered_lags(terms, [key], order, lags, bucket, keep=keep)
    if first_prem_table is not None:
        fp = first_prem or "frst_trans_prem"
        cur = first_prem_table.select(F.col(row_id).alias("_fp_id"), F.col(fp))
        prv = first_prem_table.select(F.col(row_id).alias("_pfp_id"), F.col(fp).alias(f"lag1_{fp}"))
        lagged = (
            lagged.join(cur, F.col(row_id) == F.col("_fp_id"), "left")
            .join(prv, F.col(f"lag1_{row_id}") == F.col("_pfp_id"), "left")
            .drop("_fp_id", "_pfp_id")
        )
        keep.append(fp)
    p = F.col(first_prem or prem).cast("double")
    sel = [F.col(c) for c in keep]
    replaced = [F.col(previous_prem).cast("double")] if previous_prem is not None else []
    sel.append(F.coalesce(F.col(f"lag1_{prem}").cast("double"), *replaced, F.lit(0.0)).alias("prev_term_prem"))
    sel.append(F.coalesce(F.col(f"lag2_{prem}").cast("double"), F.lit(0.0)).alias("prev_two_term_prem"))
    for c in compare:
        sel.append(F.col(f"lag1_{c}").alias(f"prev_{c}"))
    if cancel_flag is not None:
        lagc = F.col(f"lag1_{cancel_flag}")
        sel.append(F.when(lagc == 1, F.lit("1")).when(lagc == 0, F.lit("0")).alias("prior_term_canc_ind"))
    if acct_cr is not None:
        sel.append(F.col(f"lag1_{acct_cr}").alias("prior_term_acct_cr_ind"))
    if first_prem is not None:
        sel.append(F.coalesce(F.col(f"lag1_{first_prem}").cast("double"), F.lit(0.0)).alias("prev_trm_frst_trans_prem"))
    df = lagged.select(*sel)
    is_new = F.col(new_renew) == "N"
    chg1 = F.when(is_new | (F.col("prev_term_prem") == 0), F.lit(None).cast("double")).otherwise(
        p / F.col("prev_term_prem") - 1.0
    )
    chg2 = F.when(is_new | (F.col("prev_two_term_prem") == 0), F.lit(None).cast("double")).otherwise(
        p / F.col("prev_two_term_prem") - 1.0
    )
    extra = [
        no_negative_zero(F.round(chg1, 6)).alias("renewal_prem_change"),
        no_negative_zero(F.round(chg2, 6)).alias("renewal_prem_change_two_term"),
        band_expr(chg1, PREMIUM_CHANGE_BANDS).alias("renewal_prem_change_grp"),
    ]
    for c in compare:
        # the source names these CHNG_*_IND but sets 1 when the value is *unchanged*
        extra.append(F.when(F.col(c) == F.col(f"prev_{c}"), 1).otherwise(0).alias(f"same_{c}_ind"))
    return df.select(F.col("*"), *extra)


def with_expected_change(history: DataFrame, expected: DataFrame, columns: Sequence[str], row_id: str = "pol_prd_id") -> DataFrame:
    """Expected renewal premium figures of each term, from a side table keyed by the
    policy period (at most one row per period; a term without one gets NULLs). The
    table is joined after the lags, so no window carries it."""
    side = expected.filter(F.col(row_id).isNotNull()).select(row_id, *columns)
    return history.join(side, row_id, "left").select(*history.columns, *columns)


# --------------------------------------------------------------------------- W03 (characteristics)
AAL_NO_DATA, AAL_UNKNOWN, AAL_SAME, AAL_UP, AAL_DOWN = "NO AAL", "UNKNOWN", "NO CHANGE", "INCREASE", "DECREASE"


# Columns of the reference table that the output is made of.
CHARACTERISTICS = (
    "policy_id pol_prd_id pol_eff_dt canc_eff_dt pol_entry_dt acct_cr_cd pol_term_mo_cnt term_writ_prem current_term_auto_prem prev_pol_id "
    "years_with_co zip_cd plus4_cd rate_tbl_dt total_aal_cat_load aal_data_ind"
).split()


def latest_premium_by_policy(ref: DataFrame, key: str = "policy_id", prem: str = "term_writ_prem") -> DataFrame:
    """Latest term premium of every policy (newest effective date, then period)."""
    newest = F.max_by(prem, F.struct("pol_eff_dt", "pol_prd_id"))  # combined before the shuffle
    return ref.groupBy(F.col(key).alias("_prev_key")).agg(newest.alias("_prev_pol_prem"))


def term_characteristics(
    ref: DataFrame,
    key: str = "policy_id",
    order: Sequence[str] = ("pol_eff_dt", "pol_prd_id"),
    bucket: Column | None = None,
    modelled: Sequence[str] = ("eq_grss_aal_amt", "hurr_grss_aal_amt", "total_aal_cat_load"),
    first_latest: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """The remaining term-history columns of the persistency build, on a
    reference table with ``yyyymmdd`` integer dates (0 = none):
    decoded dates, credit label, annualised premium, prior-policy premium,
    combined (two-line) premium change, cancel entry date, tenure as a
    decimal, full zip, prior rate-table date and change flag, prior-term
    modelled-loss amounts and the catastrophe-load change label.

    ``first_latest`` maps a name to (first-of-term column, latest-of-term
    column): ``prev_term_<name>`` is the prior term's latest value and
    ``same_<name>_ind`` is 1 when it equals this term's first value (the
    source's CHNG_* flags, which mark an *unchanged* value)."""
    first_latest = first_latest or {}
    prev = latest_premium_by_policy(ref, key)
    j = ref.join(prev, ref["prev_pol_id"] == prev["_prev_key"], "left").drop("_prev_key")
    lags = {"term_writ_prem": (1,), "current_term_auto_prem": (1,), "rate_tbl_dt": (1,)}
    for c in modelled:
        lags[c] = (1,)
    for _, (_, latest) in first_latest.items():
        lags[latest] = (1,)
    j = ordered_lags(j, [key], order, lags, bucket, keep=list(dict.fromkeys([key, *CHARACTERISTICS, *(f for f, _ in first_latest.values()), "_prev_pol_prem"])))
    prem, auto = F.col("term_writ_prem"), F.col("current_term_auto_prem")
    lprem, lauto = F.col("lag1_term_writ_prem"), F.col("lag1_current_term_auto_prem")
    combined = F.when(
        auto.isNotNull() & lauto.isNotNull() & lprem.isNotNull(),
        div0((prem + auto).cast("double"), (lprem + lauto).cast("double")) - 1.0,
    )
    cat, prr_cat = F.col("total_aal_cat_load"), F.col("lag1_total_aal_cat_load")
    aal = (
        F.when(F.col("aal_data_ind") == "N", F.lit(AAL_NO_DATA))
        .when(cat.isNull() | prr_cat.isNull(), F.lit(AAL_UNKNOWN))
        .when(cat == prr_cat, F.lit(AAL_SAME))
        .when(cat > prr_cat, F.lit(AAL_UP))
        .when(cat < prr_cat, F.lit(AAL_DOWN))
    )
    out = [
        F.col(key), F.col("pol_prd_id"),
        date_from_yyyymmdd("pol_eff_dt").alias("pol_eff_date"),
        date_from_yyyymmdd("canc_eff_dt").alias("canc_eff_date"),
        F.when(F.col("acct_cr_cd") == 1, F.lit("Y")).when(F.col("acct_cr_cd") == 2, F.lit("N")).alias("acct_cr_ind"),
        F.when(F.col("pol_term_mo_cnt") == 6, prem * 2).otherwise(prem).alias("pol_annl_ttl_bill_prem_amt"),
        F.coalesce(lprem, F.col("_prev_pol_prem"), F.lit(0).cast("decimal(18,2)")).alias("prev_term_latest_prem_amt"),
        lauto.alias("prev_term_auto_prem"),
        round_half_up(combined, 6).alias("prem_chng_combined"),
        F.when(F.col(key) != F.col("prev_pol_id"), F.coalesce(F.col("_prev_pol_prem"), F.lit(0).cast("decimal(18,2)")))
        .otherwise(F.lit(0).cast("decimal(18,2)")).alias("prev_pol_id_latst_prem"),
        F.when(F.col("canc_eff_dt") != 0, date_from_yyyymmdd("pol_entry_dt")).alias("cancel_trans_dt"),
        F.col("years_with_co").cast("decimal(10,1)").alias("tenure_years"),
        F.when(F.col("plus4_cd").isNotNull(), F.concat(F.col("zip_cd"), F.lit("-"), F.col("plus4_cd")))
        .otherwise(F.col("zip_cd")).alias("dwell_loc_addr_full_zip_cd"),
        F.col("lag1_rate_tbl_dt").alias("prev_term_rate_tbl_dt"),
        F.when(F.col("rate_tbl_dt") != F.col("lag1_rate_tbl_dt"), 1).otherwise(0).alias("rate_tbl_dt_chng_ind"),
        *[F.col(f"lag1_{c}").alias(f"prr_{c}") for c in modelled],
        aal.alias("aal_cat_load_change"),
    ]
    for name, (first, latest) in first_latest.items():
        out.append(F.col(f"lag1_{latest}").alias(f"prev_term_{name}"))
        out.append(F.when(F.col(f"lag1_{latest}") == F.col(first), 1).otherwise(0).alias(f"same_{name}_ind"))
    return j.select(*out)


# --------------------------------------------------------------------------- W05
def persistency_period(days_eff: Column, term_months: Column) -> Column:
    """'1' once the term is fully developed (365 days, or 185 on 6-month
    terms), else the last attained 30-day step as 'n-Ult', '0-Ult' from the
    effective date, NULL before it."""
    expr = F.when(days_eff >= 365, F.lit(PERIOD_ONE)).when((days_eff >= 185) & (term_months == 6), F.lit(PERIOD_ONE))
    for n in reversed(DEV_DAYS):
        expr = expr.when(days_eff >= n, F.lit(f"{n}-Ult"))
    return expr.when(days_eff >= 0, F.lit("0-Ult"))


def ultimate_cancel(
    flags: DataFrame,
    dev_factors: DataFrame,
    factor_rows: int | None = None,
    new_renew: str = "new_rnw_cd",
    term_months: str = "term_mo_cnt",
) -> DataFrame:
    """Expected ultimate cancellations: period ladder -> development factor
    (broadcast lookup on period x new/renew) -> 1 / 0 / 1 - factor.

    The source lists twelve ATR branches that all yield ``1 - factor``; any
    attained step implies ATR_E_FLAT = 1, so one test on ATR_E_FLAT is exact."""
    df = flags.withColumn("persistency_period", persistency_period(F.col("num_days_eff"), F.col(term_months)))
    df = df.withColumn("latest_cancel", F.greatest(*[F.col(n) for n in reversed(flag_names("cancel_e"))]))
    fac = bounded_broadcast(
        dev_factors.select(
            F.col("persistency_period").alias("_pp"), F.col("pol_new_renew_cd").alias("_nr"), F.col("dev_fctr").alias("_f")
        ),
        factor_rows,
    )
    df = df.join(fac, (df.persistency_period == fac._pp) & (df[new_renew] == fac._nr), "left")
    dev = F.when(F.col("persistency_period") == PERIOD_ONE, F.lit(1.0)).otherwise(F.coalesce(F.col("_f"), F.lit(1.0)))
    df = df.withColumn("dev_fctr", dev).drop("_pp", "_nr", "_f")
    ult = (
        F.when(F.col("latest_cancel") == 1, F.lit(1.0))
        .when((F.col("latest_cancel") == 0) & (F.col("atr_e_365") == 1), F.lit(0.0))
        .when((F.col("latest_cancel") == 0) & (F.col("atr_e_365") == 0) & (F.col("atr_e_flat") == 1), 1.0 - F.col("dev_fctr"))
    )
    return df.withColumn("ult_canc_cnt", F.round(ult, 6)).withColumn("ult_atr_cnt", F.col("atr_e_flat"))


# --------------------------------------------------------------------------- W06
def term_status(df: DataFrame, horizon: int | str = "flat") -> Column:
    """Active / Cancel / Pending from the ATR/CANCEL flags at a horizon."""
    h = "flat" if horizon in (0, "0", "flat") else str(horizon)
    atr, can = F.col(f"atr_e_{h}"), F.col(f"cancel_e_{h}")
    return (
        F.when((atr == 1) & (can == 0), F.lit(STATUS_ACTIVE))
        .when((atr == 1) & (can == 1), F.lit(STATUS_CANCEL))
        .when((atr == 0) & (can == 0) & (F.col("cancel_flag") == 1), F.lit(STATUS_CANCEL))
        .otherwise(F.lit(STATUS_PENDING))
    )


def status_counts(df: DataFrame, horizon: int | str = "flat", key: str = "pol_id", by: Sequence[str] = ()) -> DataFrame:
    """Distinct policies per status (and optional extra dimensions)."""
    return df.withColumn("status", term_status(df, horizon)).groupBy(*by, "status").agg(F.countDistinct(key).alias("cnt"))


def status_by_window(
    df: DataFrame,
    windows: Mapping[str, tuple[dt.date, dt.date]],
    horizons: Sequence[int | str] = ("flat", 30),
    key: str = "pol_id",
    eff: str = "pol_eff_dt",
) -> DataFrame:
    """(horizon, window_name, status, cnt): distinct policies per status whose term takes
    effect in a window (both ends included), for all windows and horizons in one pass.
    Windows may overlap: a term counts in each it lies in; a null date lies in none."""
    inside = F.filter(
        F.array(*[F.struct(F.lit(n).alias("name"), F.col(eff).between(F.lit(a), F.lit(b)).alias("ok")) for n, (a, b) in windows.items()]),
        lambda w: F.coalesce(w["ok"], F.lit(False)),
    )
    states = F.array(*[F.struct(F.lit(0 if h in (0, "0", "flat") else int(h)).alias("horizon"), term_status(df, h).alias("status")) for h in horizons])
    long = df.select(key, states.alias("_s"), F.explode(inside).alias("_w")).select(key, F.col("_w.name").alias("window_name"), F.explode("_s").alias("_s"))
    return long.select(key, "window_name", "_s.horizon", "_s.status").groupBy("horizon", "window_name", "status").agg(F.countDistinct(key).alias("cnt"))


# --------------------------------------------------------------------------- W07
def persistency_rate(df: DataFrame, horizon: int | str = "flat", by: Sequence[str] = ()) -> DataFrame:
    """(ΣATR − ΣCANCEL) / ΣATR × 100 at a horizon, rounded to 2, plus '%' text."""
    h = "flat" if horizon in (0, "0", "flat") else str(horizon)
    atr = F.coalesce(F.sum(f"atr_e_{h}"), F.lit(0))
    can = F.coalesce(F.sum(f"cancel_e_{h}"), F.lit(0))
    g = df.groupBy(*by).agg(atr.cast("bigint").alias("atr_sum"), can.cast("bigint").alias("cancel_sum"))
    rate = F.round(ratio(F.col("atr_sum") - F.col("cancel_sum"), F.col("atr_sum"), None) * 100.0, 2)
    return g.withColumn("rate_pct", rate).withColumn(
        "rate_text", F.concat(F.format_string("%.2f", F.col("rate_pct")), F.lit("%"))
    )


def cohort_rates(
    book: DataFrame,
    members: DataFrame,
    horizons: Sequence[int | str] = ("flat", 30),
    key: str = "pol_id",
    labels: tuple[str, str, str] = ("members", "book", "book_minus_members"),
) -> DataFrame:
    """Persistency rates of the three cohorts (members, whole book, book minus
    members) at several horizons in one pass over the book: each row is tagged
    with its membership (left join to the distinct non-null member keys),
    emits the cohorts it belongs to, and one aggregation sums every horizon."""
    m = members.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_is_m", F.lit(True))
    hs = ["flat" if h in (0, "0", "flat") else str(h) for h in horizons]
    tagged = book.join(m, key, "left").select(
        F.explode(
            F.when(F.col("_is_m"), F.array(F.lit(labels[0]), F.lit(labels[1])))
            .otherwise(F.array(F.lit(labels[2]), F.lit(labels[1])))
        ).alias("cohort"),
        *[F.col(f"atr_e_{h}") for h in hs], *[F.col(f"cancel_e_{h}") for h in hs],
    )
    aggs = []
    for h in hs:
        aggs += [F.coalesce(F.sum(f"atr_e_{h}"), F.lit(0)).cast("bigint").alias(f"a_{h}"),
                 F.coalesce(F.sum(f"cancel_e_{h}"), F.lit(0)).cast("bigint").alias(f"c_{h}")]
    g = tagged.groupBy("cohort").agg(*aggs)
    per_h = F.explode(F.array(*[
        F.struct(F.lit(0 if h == "flat" else int(h)).alias("horizon"), F.col(f"a_{h}").alias("atr_sum"),
                 F.col(f"c_{h}").alias("cancel_sum"))
        for h in hs
    ])).alias("_h")
    out = g.select("cohort", per_h).select("cohort", "_h.horizon", "_h.atr_sum", "_h.cancel_sum")
    rate = F.round(ratio(F.col("atr_sum") - F.col("cancel_sum"), F.col("atr_sum"), None) * 100.0, 2)
    return out.withColumn("rate_pct", rate).withColumn(
        "rate_text", F.concat(F.format_string("%.2f", F.col("rate_pct")), F.lit("%"))
    )


# --------------------------------------------------------------------------- W30
def transition_bucket(from_code: str, none_code: str = "0", label: str | None = None) -> Column:
    """Kind of a change from ``initial_code`` to ``current_code``, seen from one code."""
    ini, cur, lab = F.col("initial_code"), F.col("current_code"), label or from_code
    return (
        F.when((ini == from_code) & (cur != none_code), F.lit(f"{lab} to Other"))
        .when((ini == from_code) & (cur == none_code), F.lit(f"{lab} to Nothing"))
        .when((cur == from_code) & (ini != none_code), F.lit(f"Other to {lab}"))
        .when((cur == from_code) & (ini == none_code), F.lit(f"Nothing to {lab}"))
        .when(cur == ini, F.lit("Multiple Code Changes"))
        .otherwise(F.lit(f"No {lab} in Transition"))
    )


def code_transitions(
    snapshots: DataFrame,
    as_of_snapshots: DataFrame,
    key: str = "policy_id",
    code: str = "pol_form_cd",
    when_col: str = "me_dt",
    from_code: str = "3-MEDIUM",
    none_code: str = "0",
    label: str | None = None,
) -> DataFrame:
    """Per policy: first and last code over the snapshots, the month of the
    latest change (the real date is aggregated, then formatted — taking MAX of
    the 'Mon' label would be alphabetical), a cancelled flag (not in force on
    the latest snapshot) and a transition bucket."""
    w = Window.partitionBy(key).orderBy(F.col(when_col).asc())
    wall = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ch = snapshots.select(
        key,
        F.first(code).over(wall).alias("initial_code"),
        F.last(code).over(wall).alias("current_code"),
        F.when(F.col(code) != F.lag(code, 1).over(w), F.col(when_col)).alias("_chg_dt"),
    )
    per = ch.groupBy(key).agg(
        F.max("initial_code").alias("initial_code"),
        F.max("current_code").alias("current_code"),
        F.max("_chg_dt").alias("_chg_dt"),
    ).filter(F.col("_chg_dt").isNotNull())
    inforce = as_of_snapshots.select(F.col(key).alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    per = per.join(inforce, per[key] == inforce._k, "left").withColumn(
        "cancel_flag", F.when(F.col("_k").isNull(), 1).otherwise(0)
    ).drop("_k")
    return per.select(
        key, "initial_code", "current_code", F.date_format("_chg_dt", "MMM").alias("change_month"),
        F.col("_chg_dt").alias("change_dt"), "cancel_flag", transition_bucket(from_code, none_code, label).alias("bucket"),
    )


# --------------------------------------------------------------------------- W35
def reinstated_after_cancel(
    txns: DataFrame,
    reasons: DataFrame,
    since: dt.date,
    key: str = "qcn",
    when_col: str = "trans_dt",
    max_years: int = 1,
    bucket: Column | None = None,
) -> DataFrame:
    """Current transaction 'Reinstate' whose previous one (per quote, by date)
    was a 'Cancel' for 'Non-Payment', within ``max_years`` calendar-year
    boundaries of the original effective date."""
    j = txns.join(reasons, [key, when_col], "inner").filter(
        ((F.year(when_col) - F.year("orig_pol_eff_dt")) <= max_years)
        & (F.col(when_col) >= F.lit(since))
        & (F.col("trans_stat_desc") == "Committed")
    )
    j = ordered_lags(
        # a transaction can carry several reasons (the reason table is keyed by
        # quote and date only), so the reason is the last tiebreak of the order
        j, [key], [when_col, "trans_id", "trans_rsn_desc"],
        {"trans_typ_desc": (1,), "trans_rsn_desc": (1,), "canc_eff_dt": (1,)}, bucket,
        keep=[key, "trans_id", "orig_pol_eff_dt", when_col, "canc_eff_dt", "trans_rsn_desc", "trans_typ_desc"],
    )
    j = (
        j.withColumnRenamed("lag1_trans_typ_desc", "prior_trans_type")
        .withColumnRenamed("lag1_trans_rsn_desc", "prior_trans_reason")
        .withColumnRenamed("lag1_canc_eff_dt", "prior_cancel_dt")
    )
    return j.filter(
        (F.col("trans_typ_desc") == "Reinstate")
        & (F.col("prior_trans_type") == "Cancel")
        & (F.col("prior_trans_reason") == "Non-Payment")
    )
