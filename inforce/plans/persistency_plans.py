"""Registered selection and persistency queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from inforce.operators import persistency as P
from inforce.operators import selection as SEL
from inforce.operators import snapshots as SN
from inforce.plans.registry import deliver_as_double, deliver_as_text, finalize, register
from inforce.sources import staging as S
from inforce.sources.tables import read_table

A = S.AS_OF_SQL


def YEAR_BUCKET():  # noqa: N802 - a column factory used as a constant
    """Order bucket for skew-safe lags over a policy's terms: the effective year."""
    return F.year("pol_eff_dt")


RENEWAL_WINDOW_START = dt.date(2000, 3, 1)


# ----------------------------------------------------------------------------- SQL mirrors
def flags_sql(src: str = "term", name: str = "pers") -> str:
    dc = "date_diff('day', pol_eff_dt, canc_eff_dt)"
    de = f"date_diff('day', pol_eff_dt, {A})"
    lead = "date_diff('day', canc_eff_dt, canc_trans_dt)"
    cols = [
        "*",
        "1 AS pol_cnt",
        "CASE WHEN canc_eff_dt = pol_eff_dt THEN 1 ELSE 0 END AS flat_cancel_flag",
        f"CAST(CASE WHEN canc_eff_dt IS NULL THEN -1 ELSE {dc} END AS INTEGER) AS num_days_canc",
        f"CAST({de} AS INTEGER) AS num_days_eff",
        f"CASE WHEN canc_eff_dt IS NULL OR {dc} = 365 THEN 0 ELSE 1 END AS cancel_flag",
        f"CASE WHEN canc_eff_dt IS NOT NULL AND {dc} <= 0 AND {A} >= pol_eff_dt THEN 1 ELSE 0 END AS cancel_e_flat",
    ]
    for n in P.DEV_DAYS:
        cols.append(f"CASE WHEN canc_eff_dt IS NOT NULL AND {dc} <= {n} AND {de} >= {n} THEN 1 ELSE 0 END AS cancel_e_{n}")
    cols.append(f"CASE WHEN canc_eff_dt IS NOT NULL AND {dc} < 365 AND {de} >= 365 THEN 1 ELSE 0 END AS cancel_e_365")
    cols.append(f"CASE WHEN {de} >= 0 THEN 1 ELSE 0 END AS atr_e_flat")
    for n in (*P.DEV_DAYS, 365):
        cols.append(f"CASE WHEN {de} >= {n} THEN 1 ELSE 0 END AS atr_e_{n}")
    for n in P.PRE_DAYS:
        cols.append(f"CASE WHEN {de} >= -{n} THEN 1 END AS atr_pre_{n}")
    cols.append(f"CASE WHEN {de} >= 0 THEN 1 END AS atr_pre")
    for n in P.PRE_DAYS:
        cols.append(
            f"CASE WHEN {de} >= -{n} AND {lead} <= -{n} AND canc_eff_dt = pol_eff_dt THEN 1 END AS canc_pre_{n}"
        )
    cols.append(f"CASE WHEN {de} >= 0 AND {lead} <= 0 AND canc_eff_dt = pol_eff_dt THEN 1 END AS canc_pre")
    return f"{name} AS (SELECT " + ",\n  ".join(cols) + f" FROM {src})"


FLAG_COLS = (
    ["pol_cnt", "flat_cancel_flag", "num_days_canc", "num_days_eff", "cancel_flag"]
    + P.flag_names("cancel_e")
    + P.flag_names("atr_e")
    + [f"atr_pre_{n}" for n in P.PRE_DAYS] + ["atr_pre"]
    + [f"canc_pre_{n}" for n in P.PRE_DAYS] + ["canc_pre"]
)


def pers(spark, d):
    t = S.term(spark, d)
    flat = F.coalesce((F.col("canc_eff_dt") == F.col("pol_eff_dt")).cast("int"), F.lit(0))
    return P.development_flags(t, S.AS_OF, flat_cancel=flat)


def _sql(body: str, extra: list[str] | None = None, base: tuple = ("term",)) -> str:
    return S.with_ctes(list(base), body, extra)


# ----------------------------------------------------------------------------- W01
_T_COLS = ["pol_id", "pol_prd_id", "pol_eff_dt", "pol_exp_dt", "prem", "rate_plan_cd", "canc_eff_dt", "new_rnw_cd"]


@register(
    "w01_latest_term",
    _sql(
        f"SELECT {', '.join(c if c != 'prem' else 'CAST(prem AS DOUBLE) AS prem' for c in _T_COLS)} FROM ("
        "SELECT *, row_number() OVER (PARTITION BY pol_id ORDER BY pol_eff_dt DESC NULLS FIRST, pol_prd_id DESC NULLS FIRST) AS rn "
        "FROM term) WHERE rn = 1"
    ),
)
def w01_latest_term(spark, d):
    t = S.term(spark, d)
    return finalize(SEL.latest_by_key(t, ["pol_id"], ["pol_eff_dt"], ["pol_prd_id"]).select(*_T_COLS))


deliver_as_text("w01_latest_term", ("canc_eff_dt",))


# ----------------------------------------------------------------------------- W02
@register(
    "w02_max_eff_ties",
    _sql(
        "SELECT pol_id, pol_prd_id, pol_eff_dt FROM term "
        "QUALIFY pol_eff_dt IS NOT NULL AND pol_eff_dt = MAX(pol_eff_dt) OVER (PARTITION BY pol_id)"
    ),
)
def w02_max_eff_ties(spark, d):
    return SEL.extreme_by_key(S.term(spark, d), ["pol_id"], "pol_eff_dt", "max").select("pol_id", "pol_prd_id", "pol_eff_dt")


# ----------------------------------------------------------------------------- W03
HIST_COLS = [
    "pol_id", "pol_prd_id", "frst_trans_prem", "prev_term_prem", "prev_two_term_prem", "prev_rate_plan_cd",
    "prev_pol_form_cd", "prior_term_canc_ind", "prior_term_acct_cr_ind", "renewal_prem_change",
    "renewal_prem_change_two_term", "renewal_prem_change_grp", "same_rate_plan_cd_ind", "same_pol_form_cd_ind",
    "prev_trm_frst_trans_prem",
]

FIRST_TRANS_SQL = """first_trans AS (
  SELECT pol_prd_id, frst_trans_prem FROM (
    SELECT l_orderkey AS pol_prd_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS frst_trans_prem,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn
    FROM lineitem) WHERE rn = 1
)"""


def first_transactions(spark, d):
    """First transaction premium per agreement (earliest line of each order)."""
    li = read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("pol_prd_id"), "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("frst_trans_prem"), "l_extendedprice",
    )
    # earliest line per order as one (map-side combined) aggregation
    return SEL.latest_with_aggs(
        li, ["pol_prd_id"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
        ["frst_trans_prem"], descending=False,
    )


#: Columns that the registered history queries carry through the lags.
HISTORY_KEEP = ["pol_id", "pol_prd_id", "pol_eff_dt", "prem", "rate_plan_cd", "pol_form_cd", "acct_cr_ind", "new_rnw_cd", "risk_st"]


def history(spark, d, keep=HISTORY_KEEP, terms=None, previous_prem=None):
    """Term history; the flags are computed from the terms after the lags (only the
    cancel flag is lagged). ``terms`` with a ``previous_prem`` column: a policy that
    replaced another one is compared with that one's latest premium."""
    t = S.term(spark, d) if terms is None else terms
    return P.term_history(
        t.withColumn("cancel_flag", P.cancelled()), prem="prem", first_prem="frst_trans_prem", first_prem_table=first_transactions(spark, d),
        bucket=YEAR_BUCKET(), previous_prem=previous_prem, keep=keep,
    )


def nz(x: str) -> str:
    """SQL twin of ``no_negative_zero``."""
    return f"(CASE WHEN {x} = 0 THEN 0.0 ELSE {x} END)"


def history_sql_ctes() -> list[str]:
    w = "OVER (PARTITION BY p.pol_id ORDER BY p.pol_eff_dt ASC NULLS FIRST, p.pol_prd_id ASC NULLS FIRST)"
    chg = lambda prev: (
        f"CASE WHEN new_rnw_cd = 'N' OR {prev} = 0 THEN NULL ELSE CAST(frst_trans_prem AS DOUBLE) / {prev} - 1.0 END"
    )
    from inforce.functions.bands import band_sql

    return [
        flags_sql(),
        FIRST_TRANS_SQL,
        f"""h1 AS (
  SELECT p.*, f.frst_trans_prem,
         COALESCE(CAST(LAG(p.prem, 1) {w} AS DOUBLE), 0.0) AS prev_term_prem,
         COALESCE(CAST(LAG(p.prem, 2) {w} AS DOUBLE), 0.0) AS prev_two_term_prem,
         LAG(p.rate_plan_cd, 1) {w} AS prev_rate_plan_cd,
         LAG(p.pol_form_cd, 1) {w} AS prev_pol_form_cd,
         CASE WHEN LAG(p.cancel_flag, 1) {w} = 1 THEN '1' WHEN LAG(p.cancel_flag, 1) {w} = 0 THEN '0' END AS prior_term_canc_ind,
         LAG(p.acct_cr_ind, 1) {w} AS prior_term_acct_cr_ind,
         COALESCE(CAST(LAG(f.frst_trans_prem, 1) {w} AS DOUBLE), 0.0) AS prev_trm_frst_trans_prem
  FROM pers p LEFT JOIN first_trans f ON p.pol_prd_id = f.pol_prd_id
)""",
        f"""hist AS (
  SELECT *,
         {nz(f"ROUND({chg('prev_term_prem')}, 6)")} AS renewal_prem_change,
         {nz(f"ROUND({chg('prev_two_term_prem')}, 6)")} AS renewal_prem_change_two_term,
         {band_sql(chg('prev_term_prem'), P.PREMIUM_CHANGE_BANDS)} AS renewal_prem_change_grp,
         CASE WHEN rate_plan_cd = prev_rate_plan_cd THEN 1 ELSE 0 END AS same_rate_plan_cd_ind,
         CASE WHEN pol_form_cd = prev_pol_form_cd THEN 1 ELSE 0 END AS same_pol_form_cd_ind
  FROM h1
)""",
    ]


@register(
    "w03_term_history",
    _sql(
        "SELECT " + ", ".join(
            "CAST(frst_trans_prem AS DOUBLE) AS frst_trans_prem" if c == "frst_trans_prem" else c for c in HIST_COLS
        ) + " FROM hist",
        history_sql_ctes(),
    ),
)
def w03_term_history(spark, d):
    return finalize(history(spark, d).select(*HIST_COLS))


deliver_as_double("w03_term_history", ("prior_term_acct_cr_ind",))


# ----------------------------------------------------------------------------- W04
_W04_COLS = ["pol_id", "pol_prd_id", "pol_eff_dt", "canc_eff_dt", *FLAG_COLS]


_W04_NULLABLE = tuple([f"atr_pre_{n}" for n in P.PRE_DAYS] + ["atr_pre"] + [f"canc_pre_{n}" for n in P.PRE_DAYS] + ["canc_pre"])


@register("w04_development_flags", _sql(f"SELECT {', '.join(_W04_COLS)} FROM pers", [flags_sql()]))
def w04_development_flags(spark, d):
    return pers(spark, d).select(*_W04_COLS)


deliver_as_double("w04_development_flags", _W04_NULLABLE)
deliver_as_text("w04_development_flags", ("canc_eff_dt",))


# ----------------------------------------------------------------------------- W05
def _ult_sql() -> str:
    de = "num_days_eff"
    ladder = f"CASE WHEN {de} >= 365 THEN '1' WHEN {de} >= 185 AND term_mo_cnt = 6 THEN '1' "
    for n in reversed(P.DEV_DAYS):
        ladder += f"WHEN {de} >= {n} THEN '{n}-Ult' "
    ladder += f"WHEN {de} >= 0 THEN '0-Ult' END"
    latest = "GREATEST(" + ", ".join(reversed(P.flag_names("cancel_e"))) + ")"
    return f"""ult AS (
  SELECT q.*,
         CASE WHEN q.persistency_period = '1' THEN 1.0 ELSE COALESCE(f.dev_fctr, 1.0) END AS dev_fctr
  FROM (SELECT *, {ladder} AS persistency_period, {latest} AS latest_cancel FROM pers) q
  LEFT JOIN dev_factor f ON q.persistency_period = f.persistency_period AND q.new_rnw_cd = f.pol_new_renew_cd
)"""


@register(
    "w05_ultimate_cancel",
    _sql(
        """SELECT pol_id, pol_prd_id, persistency_period, latest_cancel, dev_fctr,
       ROUND(CASE WHEN latest_cancel = 1 THEN 1.0
                  WHEN latest_cancel = 0 AND atr_e_365 = 1 THEN 0.0
                  WHEN latest_cancel = 0 AND atr_e_365 = 0 AND atr_e_flat = 1 THEN 1.0 - dev_fctr END, 6) AS ult_canc_cnt,
       atr_e_flat AS ult_atr_cnt
FROM ult""",
        [flags_sql(), S.dev_factors_sql(), _ult_sql()],
    ),
)
def w05_ultimate_cancel(spark, d):
    u = P.ultimate_cancel(pers(spark, d), S.dev_factors(spark), factor_rows=len(S.dev_factor_rows()))
    return u.select("pol_id", "pol_prd_id", "persistency_period", "latest_cancel", "dev_fctr", "ult_canc_cnt", "ult_atr_cnt")


# ----------------------------------------------------------------------------- W06 / W07 / W08 — renewal-zone book
def members(spark, d):
    """Renewal-zone list: policies whose holder had a qualifying web event."""
    ev = read_table(spark, d, "events")
    return ev.filter(F.col("event_type") == "purchase").select(F.col("user_id").cast("string").alias("pol_id")).distinct()


MEMBERS_SQL = "members AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS pol_id FROM events WHERE event_type = 'purchase')"


def book(spark, d):
    latest = SEL.latest_by_key(pers(spark, d), ["pol_id"], ["pol_eff_dt"], ["pol_prd_id"])
    return latest.filter(SEL.renewal_window("pol_exp_dt", RENEWAL_WINDOW_START, S.AS_OF))


BOOK_SQL = f"""book AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY pol_id ORDER BY pol_eff_dt DESC NULLS FIRST, pol_prd_id DESC NULLS FIRST) AS rn FROM pers
  ) WHERE rn = 1
    AND ((CAST(pol_exp_dt - INTERVAL 60 DAY AS DATE) BETWEEN DATE '{RENEWAL_WINDOW_START.isoformat()}' AND {A}) OR pol_exp_dt > {A})
)"""


def _status_sql(h: str) -> str:
    return (
        f"CASE WHEN atr_e_{h} = 1 AND cancel_e_{h} = 0 THEN 'Active' "
        f"WHEN atr_e_{h} = 1 AND cancel_e_{h} = 1 THEN 'Cancel' "
        f"WHEN atr_e_{h} = 0 AND cancel_e_{h} = 0 AND cancel_flag = 1 THEN 'Cancel' ELSE 'Pending' END"
    )


def _w06(h):
    def q(spark, d):
        return P.status_counts(book(spark, d), h)

    return q


for _h in ("flat", "30"):
    register(
        f"w06_term_status_e{'0' if _h == 'flat' else _h}",
        _sql(
            f"SELECT {_status_sql(_h)} AS status, COUNT(DISTINCT pol_id) AS cnt FROM book GROUP BY 1",
            [flags_sql(), BOOK_SQL],
        ),
    )(_w06(_h))


# renewal-zone members' newest terms, by the window in which they take effect
W06_FROM = dt.date(1999, 10, 1)
W06_WINDOWS = {
    "Oct-1999": (dt.date(1999, 10, 1), dt.date(1999, 10, 31)), "Jan-2000": (dt.date(2000, 1, 1), dt.date(2000, 1, 31)),
    "Oct-Dec 1999": (dt.date(1999, 10, 4), dt.date(1999, 12, 30)), "Jan-Mar 2000": (dt.date(2000, 1, 2), dt.date(2000, 3, 30)),
}


def renewal_zone(spark, d):
    """Members' terms from a date on, the newest effective date of each (ties kept)."""
    recent = pers(spark, d).filter(F.col("pol_eff_dt") >= F.lit(W06_FROM)).join(members(spark, d), "pol_id", "left_semi")
    return SEL.extreme_by_key(recent, ["pol_id"], "pol_eff_dt", "max")


@register(
    "w06_status_windows",
    _sql(
        " UNION ALL ".join(
            f"SELECT {0 if h == 'flat' else h} AS horizon, '{n}' AS window_name, {_status_sql(h)} AS status, COUNT(DISTINCT pol_id) AS cnt "
            f"FROM zone WHERE pol_eff_dt BETWEEN DATE '{a}' AND DATE '{b}' GROUP BY 3"
            for h in ("flat", "30") for n, (a, b) in W06_WINDOWS.items()
        ),
        [
            flags_sql(), MEMBERS_SQL,
            f"""zone AS (
  SELECT p.* FROM pers p JOIN (
    SELECT pol_id, MAX(pol_eff_dt) AS pol_eff_dt FROM pers JOIN members USING (pol_id) WHERE pol_eff_dt >= DATE '{W06_FROM}' GROUP BY pol_id
  ) USING (pol_id, pol_eff_dt)
)""",
        ],
    ),
)
def w06_status_windows(spark, d):
    return P.status_by_window(renewal_zone(spark, d), W06_WINDOWS)


def _rate_sql(h: str, src: str, extra_cols: str = "") -> str:
    atr = f"COALESCE(SUM(atr_e_{h}), 0)"
    can = f"COALESCE(SUM(cancel_e_{h}), 0)"
    return (
        f"SELECT {extra_cols}atr_sum, cancel_sum, rate_pct, printf('%.2f', rate_pct) || '%' AS rate_text FROM ("
        f"SELECT *, ROUND(CAST(atr_sum - cancel_sum AS DOUBLE) / NULLIF(CAST(atr_sum AS DOUBLE), 0) * 100.0, 2) AS rate_pct FROM ("
        f"SELECT {extra_cols}CAST({atr} AS BIGINT) AS atr_sum, CAST({can} AS BIGINT) AS cancel_sum FROM {src}))"
    )


register("w07_persistency_rate_e0", _sql(_rate_sql("flat", "book"), [flags_sql(), BOOK_SQL]))(
    lambda spark, d: P.persistency_rate(book(spark, d), "flat")
)
register("w07_persistency_rate_e30", _sql(_rate_sql("30", "book"), [flags_sql(), BOOK_SQL]))(
    lambda spark, d: P.persistency_rate(book(spark, d), 30)
)
register("w07_persistency_rate_e60", _sql(_rate_sql("60", "book"), [flags_sql(), BOOK_SQL]))(
    lambda spark, d: P.persistency_rate(book(spark, d), 60)
)


def _w08_sql() -> str:
    parts = []
    for label, src in (
        ("members", "(SELECT * FROM book WHERE pol_id IN (SELECT pol_id FROM members WHERE pol_id IS NOT NULL))"),
        ("book", "book"),
        ("book_minus_members", "(SELECT * FROM book WHERE pol_id NOT IN (SELECT pol_id FROM members WHERE pol_id IS NOT NULL))"),
    ):
        for h, hl in (("flat", "0"), ("30", "30")):
            parts.append(
                f"SELECT '{label}' AS cohort, {hl} AS horizon, * FROM ({_rate_sql(h, src + ' s')})"
            )
    return _sql(" UNION ALL ".join(parts), [flags_sql(), BOOK_SQL, MEMBERS_SQL], base=("term",))


@register("w08_cohort_split", _w08_sql())
def w08_cohort_split(spark, d):
    return P.cohort_rates(book(spark, d), members(spark, d), ("flat", 30))


# ----------------------------------------------------------------------------- W27
# successive eligible terms of a policy, and those where the credit went from 1 to 0
REMOVED_SQL = """eligible AS (
  SELECT *, row_number() OVER (PARTITION BY pol_id ORDER BY pol_eff_dt NULLS FIRST, pol_prd_id NULLS FIRST) AS nth
  FROM pers WHERE newco_ind = 'Y' AND atr_e_flat = 1
),
credit_dropped AS (
  SELECT now.* FROM eligible now JOIN eligible before ON before.pol_id = now.pol_id AND before.nth + 1 = now.nth
  WHERE before.acct_cr_ind = 1 AND now.acct_cr_ind = 0
)"""


@register(
    "w27_credit_removed",
    _sql("SELECT DISTINCT pol_id, acct_cr_ind, mkt_segment FROM credit_dropped", [flags_sql(), REMOVED_SQL]),
)
def w27_credit_removed(spark, d):
    p = pers(spark, d).filter((F.col("newco_ind") == "Y") & (F.col("atr_e_flat") == 1))
    return SEL.credit_removed(p, keep=["mkt_segment"], bucket=YEAR_BUCKET())


# ----------------------------------------------------------------------------- W30
W30_FROM_ME = "2000-01-31"


@register(
    "w30_code_transitions",
    _sql(
        """SELECT policy_id, initial_code, current_code, strftime(change_dt, '%b') AS change_month, change_dt,
       CAST(NOT EXISTS (SELECT 1 FROM inforce_now n WHERE n.policy_id = c.policy_id) AS INTEGER) AS cancel_flag,
       CASE '3-MEDIUM' WHEN initial_code THEN 'MEDIUM to ' || IF(current_code = '0', 'Nothing', 'Other')
                       WHEN current_code THEN IF(initial_code = '0', 'Nothing', 'Other') || ' to MEDIUM'
                       ELSE IF(initial_code = current_code, 'Multiple Code Changes', 'No MEDIUM in Transition') END AS bucket
FROM (
  SELECT policy_id, codes[1] AS initial_code, codes[-1] AS current_code,
         days[list_max([i FOR i IN range(2, len(codes) + 1) IF codes[i] <> codes[i - 1]])] AS change_dt
  FROM history
) c
WHERE change_dt IS NOT NULL""",
        [
            S.inforce_monthend_sql(),
            f"""history AS (
  SELECT policy_id, list(pol_form_cd ORDER BY me_dt) AS codes, list(me_dt ORDER BY me_dt) AS days
  FROM inforce_monthend WHERE pol_status_cd = 'InForce' AND me_dt > DATE '{W30_FROM_ME}' GROUP BY policy_id
)""",
            "inforce_now AS (SELECT policy_id FROM inforce_monthend WHERE pol_status_cd = 'InForce' AND me_dt = " + S.LAST_MONTH_END_SQL + ")",
        ],
    ),
)
def w30_code_transitions(spark, d):
    snap = S.inforce_monthend(spark, d)
    recent = snap.filter((F.col("me_dt") > F.lit(W30_FROM_ME).cast("date")) & (F.col("pol_status_cd") == "InForce"))
    now = SN.month_snapshot(S.term(spark, d), S.last_month_end(spark, d).scalar()).filter(F.col("pol_status_cd") == "InForce")
    return P.code_transitions(recent, now, from_code="3-MEDIUM", label="MEDIUM")


# ----------------------------------------------------------------------------- W35
W35_SINCE = dt.date(1995, 6, 1)

TXN_SQL = """txn_raw AS (
  SELECT t.pol_id AS qcn, t.pol_eff_dt AS trans_dt, t.pol_prd_id AS trans_id, t.pol_prd_id AS version_id,
         CASE WHEN t.canc_eff_dt IS NOT NULL THEN 'Cancel' ELSE 'Reinstate' END AS trans_typ_desc,
         CASE WHEN t.pol_prd_id % 10 = 3 THEN 'Pending' ELSE 'Committed' END AS trans_stat_desc,
         MIN(t.pol_eff_dt) OVER (PARTITION BY t.pol_id) AS orig_pol_eff_dt, t.canc_eff_dt
  FROM term t
),
txn AS (SELECT * FROM txn_raw QUALIFY MAX(version_id) OVER (PARTITION BY qcn, trans_dt) = version_id),
rsn AS (
  SELECT pol_id AS qcn, pol_eff_dt AS trans_dt, CASE WHEN pol_prd_id % 8 = 0 THEN 'Non-Payment' ELSE 'Other' END AS trans_rsn_desc
  FROM term
)"""


def transactions(spark, d):
    t = S.term(spark, d)
    raw = t.select(
        F.col("pol_id").alias("qcn"), F.col("pol_eff_dt").alias("trans_dt"), F.col("pol_prd_id").alias("trans_id"),
        F.col("pol_prd_id").alias("version_id"),
        F.when(F.col("canc_eff_dt").isNotNull(), F.lit("Cancel")).otherwise(F.lit("Reinstate")).alias("trans_typ_desc"),
        F.when(F.col("pol_prd_id") % 10 == 3, F.lit("Pending")).otherwise(F.lit("Committed")).alias("trans_stat_desc"),
        F.col("orig_pol_eff_dt"), "canc_eff_dt",
    )
    txn = SEL.extreme_by_key(raw, ["qcn", "trans_dt"], "version_id", "max")
    rsn = t.select(
        F.col("pol_id").alias("qcn"), F.col("pol_eff_dt").alias("trans_dt"),
        F.when(F.col("pol_prd_id") % 8 == 0, F.lit("Non-Payment")).otherwise(F.lit("Other")).alias("trans_rsn_desc"),
    )
    return txn, rsn


_W35_COLS = ["qcn", "trans_id", "orig_pol_eff_dt", "trans_dt", "canc_eff_dt", "trans_rsn_desc", "prior_trans_type",
             "prior_trans_reason", "prior_cancel_dt"]

# committed transactions with their reasons, numbered per quote; a reinstatement
# counts if the one numbered before it is a cancellation for non-payment
REINSTATED_SQL = f"""numbered AS (
  SELECT t.*, trans_rsn_desc, row_number() OVER (PARTITION BY qcn ORDER BY trans_dt NULLS FIRST, trans_id NULLS FIRST, trans_rsn_desc NULLS FIRST) AS nth
  FROM txn t JOIN rsn USING (qcn, trans_dt)
  WHERE trans_stat_desc = 'Committed' AND trans_dt >= DATE '{W35_SINCE.isoformat()}' AND datediff('year', orig_pol_eff_dt, trans_dt) <= 1
),
reinstated AS (
  SELECT n.*, p.trans_typ_desc AS prior_trans_type, p.trans_rsn_desc AS prior_trans_reason, p.canc_eff_dt AS prior_cancel_dt
  FROM numbered n JOIN numbered p ON p.qcn = n.qcn AND p.nth = n.nth - 1
  WHERE (n.trans_typ_desc, p.trans_typ_desc, p.trans_rsn_desc) = ('Reinstate', 'Cancel', 'Non-Payment')
)"""


@register("w35_reinstated_after_cancel", _sql(f"SELECT {', '.join(_W35_COLS)} FROM reinstated", [TXN_SQL, REINSTATED_SQL]))
def w35_reinstated_after_cancel(spark, d):
    txn, rsn = transactions(spark, d)
    return P.reinstated_after_cancel(txn, rsn, W35_SINCE, bucket=F.year("trans_dt")).select(*_W35_COLS)


deliver_as_text("w35_reinstated_after_cancel", ("canc_eff_dt", "prior_cancel_dt"))


# ----------------------------------------------------------------------------- W37
W37_STATE = 7
W37_MIN_EFF = "1997-01-01"


@register(
    "w37_premium_change_by_year",
    _sql(
        f"""SELECT eff_year,
       sign(x) * floor(abs(x) * CAST(1000000 AS DOUBLE) + 0.5) / CAST(1000000 AS DOUBLE) AS avg_prem_change, term_cnt
FROM (SELECT eff_year, CAST(SUM(CAST(renewal_prem_change AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*) AS x, COUNT(*) AS term_cnt
      FROM (SELECT *, CAST(year(pol_eff_dt) AS INTEGER) AS eff_year FROM hist) h
      WHERE risk_st = {W37_STATE} AND pol_eff_dt >= DATE '{W37_MIN_EFF}' AND new_rnw_cd = 'R'
      GROUP BY eff_year)""",
        history_sql_ctes(),
    ),
)
def w37_premium_change_by_year(spark, d):
    return yearly_change(history(spark, d))


def yearly_change(h):
    from inforce.operators.loss import premium_change_by_year

    h = h.filter((F.col("risk_st") == W37_STATE) & (F.col("pol_eff_dt") >= F.lit(W37_MIN_EFF).cast("date")) & (F.col("new_rnw_cd") == "R"))
    return premium_change_by_year(h, "renewal_prem_change")


# ----------------------------------------------------------------------------- W03 characteristics
_CHAR_COLS = [
    "policy_id", "pol_prd_id", "pol_eff_date", "canc_eff_date", "acct_cr_ind", "pol_annl_ttl_bill_prem_amt",
    "prev_term_latest_prem_amt", "prev_term_auto_prem", "prem_chng_combined", "prev_pol_id_latst_prem",
    "cancel_trans_dt", "tenure_years", "dwell_loc_addr_full_zip_cd", "prev_term_rate_tbl_dt", "rate_tbl_dt_chng_ind",
    "prr_eq_grss_aal_amt", "prr_hurr_grss_aal_amt", "prr_total_aal_cat_load", "aal_cat_load_change",
    "prev_term_loss_cnt", "same_loss_cnt_ind", "prev_term_ins_score", "same_ins_score_ind",
]
FIRST_LATEST = {"loss_cnt": ("frst_chrg_loss_cnt", "latst_chrg_loss_cnt"),
                "ins_score": ("frst_ins_score_cd", "latst_ins_score_cd")}
_YMD = "CASE WHEN {c} IS NULL OR {c} = 0 THEN NULL ELSE CAST(strptime(CAST({c} AS VARCHAR), '%Y%m%d') AS DATE) END"


# terms numbered within their policy, each beside the one numbered before it; the
# premium of the newest term of every policy stands in for a missing one
NUMBERED_SQL = """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY policy_id ORDER BY pol_eff_dt NULLS FIRST, pol_prd_id NULLS FIRST) AS nth FROM {ref}
),
newest_prem AS (SELECT policy_id AS replaced_id, arg_max(term_writ_prem, nth) AS replaced_prem FROM numbered GROUP BY policy_id)"""


def _six_places(x: str) -> str:
    return f"sign({x}) * floor(abs({x}) * CAST(1000000 AS DOUBLE) + 0.5) / CAST(1000000 AS DOUBLE)"


def _char_sql() -> str:
    both = "CAST(now.term_writ_prem + now.current_term_auto_prem AS DOUBLE)"
    before = "CAST(old.term_writ_prem + old.current_term_auto_prem AS DOUBLE)"
    change = _six_places(f"(IF({before} = 0, CAST(0 AS DOUBLE), {both} / {before}) - 1.0)")
    return f"""SELECT now.policy_id, now.pol_prd_id,
       {_YMD.format(c='now.pol_eff_dt')} AS pol_eff_date, {_YMD.format(c='now.canc_eff_dt')} AS canc_eff_date,
       ['Y', 'N'][now.acct_cr_cd] AS acct_cr_ind,
       CAST(now.term_writ_prem * IF(now.pol_term_mo_cnt = 6, 2, 1) AS DOUBLE) AS pol_annl_ttl_bill_prem_amt,
       CAST(COALESCE(old.term_writ_prem, replaced_prem, 0) AS DOUBLE) AS prev_term_latest_prem_amt,
       CAST(old.current_term_auto_prem AS DOUBLE) AS prev_term_auto_prem,
       {change} AS prem_chng_combined,
       CAST(IF(now.policy_id = now.prev_pol_id, 0, COALESCE(replaced_prem, 0)) AS DOUBLE) AS prev_pol_id_latst_prem,
       CASE WHEN now.canc_eff_dt <> 0 THEN {_YMD.format(c='now.pol_entry_dt')} END AS cancel_trans_dt,
       CAST(CAST(now.years_with_co AS DECIMAL(10,1)) AS DOUBLE) AS tenure_years,
       concat_ws('-', now.zip_cd, now.plus4_cd) AS dwell_loc_addr_full_zip_cd,
       old.rate_tbl_dt AS prev_term_rate_tbl_dt,
       CAST(COALESCE(now.rate_tbl_dt <> old.rate_tbl_dt, FALSE) AS INTEGER) AS rate_tbl_dt_chng_ind,
       CAST(old.eq_grss_aal_amt AS DOUBLE) AS prr_eq_grss_aal_amt, CAST(old.hurr_grss_aal_amt AS DOUBLE) AS prr_hurr_grss_aal_amt,
       CAST(old.total_aal_cat_load AS DOUBLE) AS prr_total_aal_cat_load,
       IF(now.aal_data_ind = 'N', 'NO AAL',
          COALESCE(['DECREASE', 'NO CHANGE', 'INCREASE'][2 + CAST(sign(now.total_aal_cat_load - old.total_aal_cat_load) AS INTEGER)], 'UNKNOWN')) AS aal_cat_load_change,
       old.latst_chrg_loss_cnt AS prev_term_loss_cnt,
       CAST(COALESCE(old.latst_chrg_loss_cnt = now.frst_chrg_loss_cnt, FALSE) AS INTEGER) AS same_loss_cnt_ind,
       old.latst_ins_score_cd AS prev_term_ins_score,
       CAST(COALESCE(old.latst_ins_score_cd = now.frst_ins_score_cd, FALSE) AS INTEGER) AS same_ins_score_ind
FROM numbered now LEFT JOIN numbered old ON old.policy_id = now.policy_id AND old.nth = now.nth - 1
LEFT JOIN newest_prem ON newest_prem.replaced_id = now.prev_pol_id"""


@register("w03_term_characteristics", S.with_ctes(["term", "char_ref"], _char_sql(), [NUMBERED_SQL.format(ref="char_ref")]))
def w03_term_characteristics(spark, d):
    out = P.term_characteristics(
        S.char_ref(spark, d), bucket=(F.col("pol_eff_dt") / 10000).cast("int"), first_latest=FIRST_LATEST
    )
    return finalize(out.select(*_CHAR_COLS))


deliver_as_double("w03_term_characteristics", ("prev_term_loss_cnt",))
deliver_as_text("w03_term_characteristics", ("canc_eff_date", "cancel_trans_dt", "prev_term_rate_tbl_dt"))


# ----------------------------------------------------------------------------- W03 (renewals under a new id)
@register(
    "w03_rewritten_policies",
    _sql(
        """SELECT pol_id, pol_prd_id, new_rnw_cd, prev_term_prem,
       CASE WHEN new_rnw_cd = 'R' AND prev_term_prem <> 0 THEN ROUND(change, 6) + 0.0 END AS renewal_prem_change,
       CASE WHEN new_rnw_cd = 'R' AND prev_term_prem <> 0
            THEN CASE WHEN change < -0.05 THEN 'a. < -5' WHEN change < 0 THEN 'b. -5 to 0' WHEN change < 0.1 THEN 'c. 0 to 9'
                      WHEN change < 0.2 THEN 'd. 10 to 19' ELSE 'e. > 20' END END AS renewal_prem_change_grp
FROM (SELECT *, CAST(prem AS DOUBLE) / NULLIF(prev_term_prem, 0) - 1.0 AS change FROM rewritten)""",
        ["""ordered AS (
  SELECT *, row_number() OVER (PARTITION BY pol_id ORDER BY pol_eff_dt NULLS FIRST, pol_prd_id NULLS FIRST) AS nth,
         CASE WHEN CAST(pol_id AS BIGINT) % 4 = 1 THEN CAST(CAST(pol_id AS BIGINT) - 1 AS VARCHAR) END AS replaced_id
  FROM term
),
last_prem AS (SELECT pol_id AS replaced_id, arg_max(prem, nth) AS replaced_prem FROM ordered GROUP BY pol_id),
rewritten AS (
  SELECT now.pol_id, now.pol_prd_id, now.prem, IF(l.replaced_prem IS NOT NULL, 'R', now.new_rnw_cd) AS new_rnw_cd,
         CAST(COALESCE(before.prem, l.replaced_prem, 0) AS DOUBLE) AS prev_term_prem
  FROM ordered now LEFT JOIN ordered before ON before.pol_id = now.pol_id AND before.nth = now.nth - 1
  LEFT JOIN last_prem l ON l.replaced_id = now.replaced_id
)"""],
    ),
)
def w03_rewritten_policies(spark, d):
    """Policies with id 4n+1 replaced policy 4n: their first term is a renewal, compared
    with the replaced policy's latest premium."""
    out = P.term_history(
        S.renewal_terms(spark, d), compare=(), cancel_flag=None, acct_cr=None, previous_prem="replaced_prem", bucket=YEAR_BUCKET(),
        keep=["pol_id", "pol_prd_id", "new_rnw_cd"],
    )
    return out.select("pol_id", "pol_prd_id", "new_rnw_cd", "prev_term_prem", "renewal_prem_change", "renewal_prem_change_grp")


# ----------------------------------------------------------------------------- W37 (renewals under a new id)
@register(
    "w37_rewritten_policies",
    _sql(
        f"""SELECT eff_year, {_six_places('x')} AS avg_prem_change, term_cnt
FROM (
  SELECT CAST(year(pol_eff_dt) AS INTEGER) AS eff_year, COUNT(*) AS term_cnt,
         CAST(SUM(CAST(ROUND(CAST(frst_trans_prem AS DOUBLE) / NULLIF(prev_prem, 0) - 1.0, 6) AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*) AS x
  FROM offers
  WHERE risk_st = {W37_STATE} AND pol_eff_dt >= DATE '{W37_MIN_EFF}' AND (new_rnw_cd = 'R' OR replaced_prem IS NOT NULL)
  GROUP BY 1
)""",
        [
            FIRST_TRANS_SQL,
            """ordered AS (
  SELECT *, row_number() OVER (PARTITION BY pol_id ORDER BY pol_eff_dt NULLS FIRST, pol_prd_id NULLS FIRST) AS nth,
         CASE WHEN CAST(pol_id AS BIGINT) % 4 = 1 THEN CAST(CAST(pol_id AS BIGINT) - 1 AS VARCHAR) END AS replaced_id
  FROM term
),
last_prem AS (SELECT pol_id AS replaced_id, arg_max(prem, nth) AS replaced_prem FROM ordered GROUP BY pol_id),
offers AS (
  SELECT now.*, f.frst_trans_prem, l.replaced_prem, CAST(COALESCE(old.prem, l.replaced_prem, 0) AS DOUBLE) AS prev_prem
  FROM ordered now LEFT JOIN ordered old ON old.pol_id = now.pol_id AND old.nth = now.nth - 1
  LEFT JOIN last_prem l ON l.replaced_id = now.replaced_id
  LEFT JOIN first_trans f ON f.pol_prd_id = now.pol_prd_id
)""",
        ],
    ),
)
def w37_rewritten_policies(spark, d):
    """The yearly figure with renewals under a new id, whose offer is compared with
    the replaced policy's latest premium."""
    return yearly_change(history(spark, d, terms=S.renewal_terms(spark, d), previous_prem="replaced_prem"))


# ----------------------------------------------------------------------------- W03 (expected premium change)
@register(
    "w03_expected_change",
    _sql(
        "SELECT h.pol_id, h.pol_prd_id, h.prev_term_prem, h.renewal_prem_change, "
        + ", ".join(f"CAST(e.{c} AS DOUBLE) AS {c}" if c not in ("pol_eff_yrmo", "low_prem_flag", "overall_expected_rate_grp") else f"e.{c}" for c in S.EXPECTED_COLS)
        + " FROM hist h LEFT JOIN expected_change e ON e.pol_prd_id = h.pol_prd_id",
        [*history_sql_ctes(), S.EXPECTED_SQL],
    ),
)
def w03_expected_change(spark, d):
    """Offered and expected premium change of every term."""
    h = history(spark, d).select("pol_id", "pol_prd_id", "prev_term_prem", "renewal_prem_change")
    out = finalize(P.with_expected_change(h, S.expected_change(spark, d), S.EXPECTED_COLS))
    return out.withColumn("polyr", F.col("polyr").cast("double"))


# ----------------------------------------------------------------------------- W03 (modelled losses)
MODELLED = [*S.MODEL_AMOUNTS, "aal_yrmo_dt", "aal_data_ind", "total_aal_cat_load", "tot_aal_cat_load_wp_grp"]
MODEL_FIRST_LATEST = {**FIRST_LATEST, **{c: (f"frst_{c}", f"latst_{c}") for c in S.FIRST_LATEST_CODES}}
_AMOUNTS = (*S.MODEL_AMOUNTS, "total_aal_cat_load")


@register(
    "w03_model_lags",
    S.with_ctes(
        ["term", "char_ref"],
        "SELECT now.policy_id, now.pol_prd_id, "
        + ", ".join(f"CAST(old.{c} AS DOUBLE) AS prr_{c}" if c in _AMOUNTS else f"old.{c} AS prr_{c}" for c in MODELLED) + ", "
        + ", ".join(
            (f"CAST(old.{late} AS DOUBLE)" if n == "loss_cnt" else f"old.{late}") + f" AS prev_term_{n}, CAST(COALESCE(old.{late} = now.{first}, FALSE) AS INTEGER) AS same_{n}_ind"
            for n, (first, late) in MODEL_FIRST_LATEST.items()
        )
        + " FROM numbered now LEFT JOIN numbered old ON old.policy_id = now.policy_id AND old.nth = now.nth - 1",
        [S.model_ref_sql(), NUMBERED_SQL.format(ref="model_ref")],
    ),
)
def w03_model_lags(spark, d):
    """All thirteen modelled-loss values of the prior term and the six "unchanged"
    flags of the rating inputs, from one lag."""
    out = P.term_characteristics(S.model_ref(spark, d), bucket=(F.col("pol_eff_dt") / 10000).cast("int"), modelled=MODELLED, first_latest=MODEL_FIRST_LATEST)
    out = finalize(out.select("policy_id", "pol_prd_id", *[f"prr_{c}" for c in MODELLED], *[x for n in MODEL_FIRST_LATEST for x in (f"prev_term_{n}", f"same_{n}_ind")]))
    return out.withColumn("prev_term_loss_cnt", F.col("prev_term_loss_cnt").cast("double"))
