"""Registered list-maintenance, profiling, breakdown and ingestion queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from inforce.operators import linkage as LK
from inforce.operators import maintenance as MT
from inforce.operators import persistency as P
from inforce.operators import selection as SEL
from inforce.plans.persistency_plans import REINSTATED_SQL, REMOVED_SQL, TXN_SQL, W35_SINCE, flags_sql, pers, transactions
from inforce.plans.reconcile_plans import last_snapshot
from inforce.plans.registry import finalize, register
from inforce.plans.shared import _sql
from inforce.sources import lines as LN
from inforce.sources import staging as S


# ----------------------------------------------------------------------------- W43
@register(
    "w43_premium_by",
    _sql("SELECT cov_type_abbr, newco_ind, CAST(SUM(ep) AS DOUBLE) AS sum_ep FROM loss GROUP BY 1, 2", [], base=("loss",)),
)
def w43_premium_by(spark, d):
    return finalize(LK.premium_by(S.loss(spark, d), ["cov_type_abbr", "newco_ind"], "ep"))


@register(
    "w43_inforce_by_status",
    _sql(
        """SELECT rate_plan_cd, pol_status_cd, COUNT(DISTINCT policy_id) AS cnt FROM inforce_monthend
WHERE me_dt = (SELECT MAX(me_dt) FROM inforce_monthend) AND (pol_status_cd = 'InForce' OR pol_status_cd = 'A')
GROUP BY 1, 2""",
        [S.inforce_monthend_sql()],
    ),
)
def w43_inforce_by_status(spark, d):
    return LK.inforce_by_status(last_snapshot(spark, d), ["InForce", "A"], latest=S.last_month_end(spark, d))


# ----------------------------------------------------------------------------- W38 / W39 / W40
REMOVED_IDS_SQL = "removed_ids AS (SELECT pol_id FROM credit_dropped)"
REINSTATED_IDS_SQL = "reinstated_ids AS (SELECT qcn AS pol_id FROM reinstated)"
STACKED_SQL = """stacked AS (
  SELECT DISTINCT pol_id, 'credit_removed' AS source FROM removed_ids
  UNION ALL
  SELECT pol_id, 'reinstated' AS source FROM reinstated_ids
)"""
_LIST_CTES = [flags_sql(), TXN_SQL, REMOVED_SQL, REINSTATED_SQL, REMOVED_IDS_SQL, REINSTATED_IDS_SQL, STACKED_SQL]


def id_lists(spark, d):
    removed = SEL.credit_removed(pers(spark, d).filter((F.col("newco_ind") == "Y") & (F.col("atr_e_flat") == 1)),
                                 keep=["pol_prd_id"], bucket=F.year("pol_eff_dt")).select("pol_id")
    txn, rsn = transactions(spark, d)
    reinst = P.reinstated_after_cancel(txn, rsn, W35_SINCE, bucket=F.year("trans_dt")).select(F.col("qcn").alias("pol_id"))
    return removed, reinst


def stacked_ids(spark, d):
    removed, reinst = id_lists(spark, d)
    return SEL.tag_and_stack({"credit_removed": removed, "reinstated": reinst}, dedupe=["credit_removed"])


@register("w38_tag_and_stack", _sql("SELECT pol_id, source FROM stacked", _LIST_CTES))
def w38_tag_and_stack(spark, d):
    return stacked_ids(spark, d)


MEMBERS_SQL = "members AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS pol_id FROM events WHERE event_type = 'purchase')"


def _members(spark, d):
    from inforce.plans.persistency_plans import members

    return members(spark, d)


@register(
    "w39_exclude_members",
    _sql("SELECT pol_id, source FROM stacked WHERE pol_id NOT IN (SELECT pol_id FROM members WHERE pol_id IS NOT NULL)",
         _LIST_CTES + [MEMBERS_SQL]),
)
def w39_exclude_members(spark, d):
    return SEL.exclude_members(stacked_ids(spark, d), _members(spark, d))


@register(
    "w39_missing_ids",
    _sql("SELECT DISTINCT pol_id FROM stacked WHERE pol_id IS NOT NULL AND pol_id NOT IN "
         "(SELECT pol_id FROM members WHERE pol_id IS NOT NULL)", _LIST_CTES + [MEMBERS_SQL]),
)
def w39_missing_ids(spark, d):
    return SEL.missing_ids(stacked_ids(spark, d), _members(spark, d))


@register(
    "w39_common_ids",
    _sql("SELECT DISTINCT a.pol_id FROM removed_ids a JOIN reinstated_ids b ON a.pol_id = b.pol_id", _LIST_CTES),
)
def w39_common_ids(spark, d):
    removed, reinst = id_lists(spark, d)
    return SEL.common_ids(removed, reinst)


@register(
    "w40_loss_by_source",
    _sql(
        """SELECT s.pol_id, l.earned_month, s.source, CAST(SUM(l.ep) AS DOUBLE) AS ep, CAST(SUM(l.incur_loss) AS DOUBLE) AS incur_loss
FROM stacked s LEFT JOIN loss l ON s.pol_id = l.pol_id GROUP BY 1, 2, 3""",
        _LIST_CTES, base=("term", "loss"),
    ),
)
def w40_loss_by_source(spark, d):
    from inforce.operators.loss import loss_by_source

    lo = S.loss(spark, d).select("pol_id", "earned_month", "ep", "incur_loss")
    return loss_by_source(stacked_ids(spark, d), lo)


@register(
    "w40_distinct_ids",
    _sql("SELECT COUNT(DISTINCT s.pol_id) AS id_cnt FROM stacked s LEFT JOIN loss l ON s.pol_id = l.pol_id",
         _LIST_CTES, base=("term", "loss")),
)
def w40_distinct_ids(spark, d):
    return MT.distinct_count(stacked_ids(spark, d), "pol_id")


# ----------------------------------------------------------------------------- W41
@register(
    "w41_profile",
    _sql(
        """SELECT MAX(me_dt) AS latest_dt, MIN(me_dt) AS first_dt, COUNT(DISTINCT pol_status_cd) AS status_cnt,
       COUNT(DISTINCT policy_id) AS id_cnt, COUNT(DISTINCT me_dt) AS date_cnt, COUNT(*) AS row_cnt
FROM inforce_monthend""",
        [S.inforce_monthend_sql()],
    ),
)
def w41_profile(spark, d):
    return MT.profile(S.inforce_monthend(spark, d), "policy_id", "me_dt", "pol_status_cd")


@register("w41_distinct_statuses", _sql("SELECT DISTINCT pol_status_cd FROM inforce_monthend", [S.inforce_monthend_sql()]))
def w41_distinct_statuses(spark, d):
    return S.inforce_monthend(spark, d).select("pol_status_cd").distinct()


@register(
    "w41_segment_date_range",
    _sql(
        """SELECT rate_plan_cd, MIN(pol_eff_dt) AS first_dt, MAX(pol_eff_dt) AS last_dt, COUNT(DISTINCT pol_id) AS id_cnt
FROM term GROUP BY rate_plan_cd""",
        [],
    ),
)
def w41_segment_date_range(spark, d):
    return MT.segment_date_range(S.term(spark, d), ["rate_plan_cd"], "pol_eff_dt", "pol_id")


# ----------------------------------------------------------------------------- W44
CLAIMS_SINCE = dt.date(1998, 7, 1)
CLAIMS_SINCE_TEXT = "01Jul1998"  # as the extraction script writes it


@register(
    "w44_claims_ingest",
    _sql(
        f"""SELECT clm_id, loss_evnt_num, pol_id, cov_typ_desc, CAST(loss_dt AS DATE) AS loss_dt, CAST(rpt_tmsp AS DATE) AS rpt_tmsp,
       CAST(clm_ttl_inc_amt AS DOUBLE) AS clm_ttl_inc_amt,
       CAST(CASE WHEN cov_typ_desc IN ('Glass', 'Towing') THEN clm_ttl_inc_amt ELSE 0 END AS DOUBLE) AS glass_tow_amt
FROM claims_source WHERE loss_dt >= DATE '{CLAIMS_SINCE}'""",
        [LN.CLAIMS_SQL], base=(),
    ),
)
def w44_claims_ingest(spark, d):
    from inforce.functions.columns import date_literal

    return finalize(MT.claims_ingest(LN.claims_source(spark, d), date_literal(CLAIMS_SINCE_TEXT)))
