"""Registered cross-line linkage and enrichment queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from inforce.operators import linkage as LK
from inforce.operators import selection as SEL
from inforce.plans.persistency_plans import REMOVED_SQL, flags_sql, pers
from inforce.plans.reconcile_plans import last_snapshot
from inforce.plans.registry import deliver_as_double, deliver_as_text, finalize, register
from inforce.plans.shared import LATEST_PERS_SQL, A, _sql, latest_pers
from inforce.session import written
from inforce.sources import lines as LN
from inforce.sources import staging as S


# ----------------------------------------------------------------------------- W28
def auto_inforce_now(spark, d):
    """Policies in force at the last month end: that month's snapshot, and no other's."""
    return last_snapshot(spark, d).filter((F.col("pol_status_cd") == "InForce") & F.col("policy_id").isNotNull()).select(F.col("policy_id").alias("pol_id"))


def contact_method(key: str):
    """Emulated contact method of the original quote, by period number."""
    k = F.col(key) % 3
    return F.when(k == 0, "Phone").when(k == 1, "Web").otherwise("Agent")


def crosswalk(spark, d, keep=()):
    terms = S.term(spark, d).withColumn("orig_qte_cntct_meth_cd", contact_method("pol_prd_id"))
    # eligible: newer company, and in force at some time (attained the effective date)
    eligible = terms.filter((F.col("newco_ind") == "Y") & (F.col("pol_eff_dt") <= F.lit(S.AS_OF)))
    removed = SEL.credit_removed(eligible, keep=keep, bucket=F.year("pol_eff_dt")).filter(F.col("acct_cr_ind") == 0)
    home = LN.home_policy(spark, d).withColumn("orig_qte_cntct_meth_cd", contact_method("pol_prd_id"))
    # both directions read the linked quotes: joined once, written when this is called
    pairs = written(LK.quote_pairs(LN.auto_quotes(spark, d), LN.party_link_rows(spark, d, S.loss_partitions(spark, d)), LN.home_quotes(spark, d)), "quote-pairs")
    a2h = LK.crosswalk_from_pairs(pairs, removed, home.filter(F.col("pol_status_cd") == "InForce"), "auto", "home", ("Auto", "Home"), keep)
    h2a = LK.crosswalk_from_pairs(pairs, home.filter(F.col("acct_cr_ind") == "N"), auto_inforce_now(spark, d), "home", "auto", ("Home", "Auto"), keep)
    return a2h.unionByName(h2a)


_XW_COLS = "pol_start, start_pol_id, start_orig_qte_dt, start_qcn, end_qcn, end_orig_qte_dt, end_pol_id, pol_end"
XW_SQL_CTES = [
    flags_sql(), LN.HOME_POLICY_SQL, LN.AUTO_QUOTES_SQL, LN.HOME_QUOTES_SQL, LN.PARTY_LINK_SQL, S.inforce_monthend_sql(),
    REMOVED_SQL,
    "removed AS (SELECT DISTINCT pol_id FROM credit_dropped)",
    """auto_inforce AS (
  SELECT TRY_CAST(policy_id AS DECIMAL(38,0)) AS pol_id FROM inforce_monthend
  WHERE policy_id IS NOT NULL AND me_dt = (SELECT MAX(me_dt) FROM inforce_monthend) AND pol_status_cd = 'InForce'
)""",
    "home_inforce AS (SELECT TRY_CAST(pol_id AS DECIMAL(38,0)) AS pol_id FROM home_policy WHERE pol_status_cd = 'InForce')",
    f"""xw AS (
  SELECT DISTINCT 'Auto' AS pol_start, r.pol_id AS start_pol_id, aq.qte_dt AS start_orig_qte_dt, aq.qcn AS start_qcn,
         lk.home_qcn AS end_qcn, hq.qte_dt AS end_orig_qte_dt, hq.pol_id AS end_pol_id, 'Home' AS pol_end
  FROM removed r JOIN auto_quotes aq ON r.pol_id = aq.pol_id JOIN party_link lk ON aq.qcn = lk.auto_qcn
  JOIN home_quotes hq ON lk.home_qcn = hq.qcn
  WHERE hq.pol_id IS NOT NULL AND TRY_CAST(hq.pol_id AS DECIMAL(38,0)) IN (SELECT pol_id FROM home_inforce WHERE pol_id IS NOT NULL)
  UNION ALL
  SELECT DISTINCT 'Home' AS pol_start, h.pol_id AS start_pol_id, hq.qte_dt AS start_orig_qte_dt, hq.qcn AS start_qcn,
         lk.auto_qcn AS end_qcn, aq.qte_dt AS end_orig_qte_dt, aq.pol_id AS end_pol_id, 'Auto' AS pol_end
  FROM (SELECT DISTINCT pol_id FROM home_policy WHERE acct_cr_ind = 'N') h JOIN home_quotes hq ON h.pol_id = hq.pol_id
  JOIN party_link lk ON hq.qcn = lk.home_qcn JOIN auto_quotes aq ON lk.auto_qcn = aq.qcn
  WHERE aq.pol_id IS NOT NULL AND TRY_CAST(aq.pol_id AS DECIMAL(38,0)) IN (SELECT pol_id FROM auto_inforce WHERE pol_id IS NOT NULL)
)""",
]


@register("w28_crosswalk", _sql(f"SELECT {_XW_COLS} FROM xw", XW_SQL_CTES))
def w28_crosswalk(spark, d):
    return crosswalk(spark, d)


_METHOD_SQL = "['Phone', 'Web', 'Agent'][1 + pol_prd_id % 3]"


@register(
    "w28_crosswalk_contact",
    _sql(
        """SELECT pol_start, start_pol_id, orig_qte_cntct_meth_cd, start_orig_qte_dt, start_qcn, end_qcn, end_orig_qte_dt, end_pol_id, pol_end
FROM xw JOIN methods USING (pol_start, start_pol_id)""",
        [
            *XW_SQL_CTES,
            f"""methods AS (
  SELECT DISTINCT 'Auto' AS pol_start, pol_id AS start_pol_id, {_METHOD_SQL} AS orig_qte_cntct_meth_cd FROM credit_dropped
  UNION
  SELECT DISTINCT 'Home', pol_id, {_METHOD_SQL} FROM home_policy WHERE acct_cr_ind = 'N'
)""",
        ],
    ),
)
def w28_crosswalk_contact(spark, d):
    """The crosswalk with the contact method of the start policy's original quote."""
    return crosswalk(spark, d, keep=["orig_qte_cntct_meth_cd"])


# ----------------------------------------------------------------------------- W29
FUTURE_START, FUTURE_END, HIST_CUTOFF = dt.date(2000, 6, 5), dt.date(2000, 8, 2), dt.date(2000, 9, 1)

W29_COLS = ["auto_pol_id", "auto_eff_dt", "auto_status", "auto_acct_cr_ind", "auto_form_cd", "auto_qcn", "home_qcn",
            "home_form_cd", "home_pol_id", "home_acct_cr_ind", "home_status", "future_ind", "acct_issue_ind"]


def linked_pairs(spark, d, book=None, expires_from=None):
    """Linked auto and home policies. ``book``: a condition on the terms from which
    the latest one of each auto policy is taken; ``expires_from``: the first expiry
    date of those terms."""
    a = F.lit(S.AS_OF)
    if book is None:
        latest = latest_pers(spark, d)
    else:
        latest = SEL.latest_by_key(pers(spark, d).filter(book), ["pol_id"], ["pol_eff_dt"], ["pol_prd_id"])
    if expires_from is not None:
        latest = latest.filter(F.col("pol_exp_dt") >= F.lit(expires_from))
    ap = latest.select(
        F.col("pol_id").alias("auto_pol_id"), F.col("pol_eff_dt").alias("auto_eff_dt"),
        F.when(
            (F.col("canc_eff_dt").isNull() | (F.col("canc_eff_dt") > a)) & (F.col("pol_eff_dt") >= F.add_months(a, -6)),
            F.lit("InForce"),
        ).otherwise(F.lit("Left")).alias("auto_status"),
        F.when(F.col("acct_cr_ind") == 1, F.lit("Y")).otherwise(F.lit("N")).alias("auto_acct_cr_ind"),
        F.col("pol_form_cd").alias("auto_form_cd"),
    )
    hp = LN.home_policy(spark, d).select(
        F.col("pol_id").alias("_hp_id"), F.col("pol_form_cd").alias("home_form_cd"),
        F.col("acct_cr_ind").alias("home_acct_cr_ind"),
        F.when((F.col("pol_status_cd") == "InForce") & (F.col("pol_eff_dt") >= F.add_months(a, -12)), F.lit("InForce"))
        .otherwise(F.lit("Left")).alias("home_status"),
    )
    aq = LN.auto_quotes(spark, d).select(F.col("pol_id").alias("auto_pol_id"), F.col("qcn").alias("auto_qcn")).distinct()
    lk = LN.party_link(spark, d)
    hq = LN.home_quotes(spark, d).select(F.col("qcn").alias("home_qcn"), F.col("pol_id").alias("home_pol_id")).distinct()
    # every side is distinct on what it contributes and every join key is kept
    # (or equal to a kept column), so the chain output is already distinct
    j = ap.distinct().join(aq, "auto_pol_id").join(lk, "auto_qcn").join(hq, "home_qcn")
    return j.join(hp.distinct(), j.home_pol_id.cast("string") == hp._hp_id).drop("_hp_id")


def _w29_sql(book: str) -> str:
    """Auto and home sides as state tables, linked through their quotes; ``at_odds``
    is the rule that both indicators of a pair share."""
    return _sql(
        f"""SELECT {', '.join(W29_COLS)} FROM (
  SELECT *, CAST(at_odds AND auto_eff_dt BETWEEN DATE '{FUTURE_START}' AND DATE '{FUTURE_END}' AS INTEGER) AS future_ind FROM pairs
), LATERAL (SELECT CAST(COALESCE(CASE
    WHEN auto_eff_dt <= DATE '{HIST_CUTOFF}' AND future_ind = 0 THEN FALSE
    WHEN auto_status = 'InForce' THEN at_odds
    WHEN home_status = 'InForce' THEN home_acct_cr_ind = 'Y'
    ELSE 'Y' IN (auto_acct_cr_ind, home_acct_cr_ind) END, FALSE) AS INTEGER) AS acct_issue_ind)""",
        [
            flags_sql(), LATEST_PERS_SQL, LN.HOME_POLICY_SQL, LN.AUTO_QUOTES_SQL, LN.HOME_QUOTES_SQL, LN.PARTY_LINK_SQL,
            f"""home_side AS (
  SELECT DISTINCT q.qcn AS home_qcn, q.pol_id AS home_pol_id, p.pol_form_cd AS home_form_cd, p.acct_cr_ind AS home_acct_cr_ind,
         IF(p.pol_status_cd = 'InForce' AND p.pol_eff_dt >= CAST({A} - INTERVAL 1 YEAR AS DATE), 'InForce', 'Left') AS home_status
  FROM home_quotes q JOIN home_policy p USING (pol_id)
),
auto_side AS (
  SELECT DISTINCT b.pol_id AS auto_pol_id, b.pol_eff_dt AS auto_eff_dt, b.pol_form_cd AS auto_form_cd, q.qcn AS auto_qcn,
         IF(b.acct_cr_ind = 1, 'Y', 'N') AS auto_acct_cr_ind,
         IF(COALESCE(b.canc_eff_dt > {A}, TRUE) AND b.pol_eff_dt >= CAST({A} - INTERVAL 6 MONTH AS DATE), 'InForce', 'Left') AS auto_status
  FROM ({book}) b JOIN auto_quotes q USING (pol_id)
),
pairs AS (
  SELECT *, auto_status = 'InForce' AND CASE home_status WHEN 'InForce' THEN 'N' IN (auto_acct_cr_ind, home_acct_cr_ind)
                                                         ELSE auto_acct_cr_ind = 'Y' END AS at_odds
  FROM auto_side JOIN party_link USING (auto_qcn) JOIN home_side USING (home_qcn)
)""",
        ],
    )


W29_EXPIRES_FROM = dt.date(1999, 9, 1)


@register("w29_household_credit_issues", _w29_sql("SELECT * FROM latest_pers"))
def w29_household_credit_issues(spark, d):
    return LK.household_credit_issues(linked_pairs(spark, d), FUTURE_START, FUTURE_END, HIST_CUTOFF).select(*W29_COLS)


@register(
    "w29_newer_company_book",
    _w29_sql(
        f"""SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY pol_id ORDER BY pol_eff_dt DESC NULLS FIRST, pol_prd_id DESC NULLS FIRST) AS newest
    FROM pers WHERE newco_ind = 'Y')
  WHERE newest = 1 AND pol_exp_dt >= DATE '{W29_EXPIRES_FROM}'"""
    ),
)
def w29_newer_company_book(spark, d):
    """The source's book: newer-company terms only, latest of each policy, not expired before a date."""
    pairs = linked_pairs(spark, d, F.col("newco_ind") == "Y", W29_EXPIRES_FROM)
    return LK.household_credit_issues(pairs, FUTURE_START, FUTURE_END, HIST_CUTOFF).select(*W29_COLS)


# ----------------------------------------------------------------------------- W42
def connected(spark, d):
    """Distinct linked pairs with market attributes.

    Each side is reduced to the columns the output keeps (id sides to their
    decimal key) and de-duplicated *before* the chain is joined. Every join
    key is then either kept in the output or determined by it, so the join
    of distinct sides is itself distinct: no DISTINCT over the (much larger)
    chain output is needed, and a policy's many terms are not multiplied by
    its many quotes before being collapsed again."""
    t = pers(spark, d)
    auto = t.select(
        F.col("pol_id").alias("auto_pol_id"),
        LN._map("mkt_segment", LN.MEDIA_GROUPS, "Referral").alias("auto_mkt_grp"),
        F.when(F.col("pol_form_cd").isin("1-URGENT", "2-HIGH"), F.lit("Agency"))
        .when(F.col("pol_form_cd") == "3-MEDIUM", F.lit("Direct")).otherwise(F.lit("Partner")).alias("auto_mkt_chnl"),
    ).distinct()
    aq = LN.auto_quotes(spark, d).select(
        LK.try_decimal_id("pol_id").alias("_aq_key"), F.col("qcn").alias("auto_qcn")
    ).filter(F.col("_aq_key").isNotNull()).distinct()
    lk = LN.party_link(spark, d)
    hq = LN.home_quotes(spark, d).select(F.col("qcn").alias("home_qcn"), F.col("pol_id").alias("home_pol_id")).distinct()
    hp = LN.home_policy(spark, d).select(
        LK.try_decimal_id("pol_id").alias("_hp_key"), F.col("market_channel").alias("home_mkt_chnl"),
        F.col("mktg_media_grp").alias("home_mkt_grp"),
    ).filter(F.col("_hp_key").isNotNull()).distinct()
    j = auto.join(aq, LK.try_decimal_id("auto_pol_id") == F.col("_aq_key")).drop("_aq_key")
    j = j.join(lk, "auto_qcn").join(hq, "home_qcn")
    return j.join(hp, LK.try_decimal_id("home_pol_id") == F.col("_hp_key")).drop("_hp_key")


@register(
    "w42_attribute_mismatch",
    _sql(
        """SELECT COUNT(*) AS total_cnt,
       CAST(COUNT_IF(auto_mkt_grp <> home_mkt_grp) AS BIGINT) AS auto_mkt_grp_diff_cnt,
       CAST(COUNT_IF(auto_mkt_chnl <> home_mkt_chnl) AS BIGINT) AS auto_mkt_chnl_diff_cnt,
       CAST(COUNT_IF(auto_mkt_grp <> home_mkt_grp OR auto_mkt_chnl <> home_mkt_chnl) AS BIGINT) AS any_diff_cnt
FROM linked_markets""",
        [
            flags_sql(), LN.HOME_POLICY_SQL, LN.AUTO_QUOTES_SQL, LN.HOME_QUOTES_SQL, LN.PARTY_LINK_SQL,
            f"""auto_market AS (
  SELECT DISTINCT TRY_CAST(pol_id AS DECIMAL(38,0)) AS auto_key, pol_id AS auto_pol_id,
         {LN._case_map('mkt_segment', LN.MEDIA_GROUPS, 'Referral')} AS auto_mkt_grp,
         CASE pol_form_cd WHEN '1-URGENT' THEN 'Agency' WHEN '2-HIGH' THEN 'Agency' WHEN '3-MEDIUM' THEN 'Direct' ELSE 'Partner' END AS auto_mkt_chnl
  FROM pers
),
home_market AS (
  SELECT DISTINCT q.qcn AS home_qcn, q.pol_id AS home_pol_id, p.market_channel AS home_mkt_chnl, p.mktg_media_grp AS home_mkt_grp
  FROM home_policy p JOIN home_quotes q ON TRY_CAST(p.pol_id AS DECIMAL(38,0)) = TRY_CAST(q.pol_id AS DECIMAL(38,0))
),
linked_markets AS (
  SELECT DISTINCT * EXCLUDE (auto_key)
  FROM (SELECT DISTINCT TRY_CAST(pol_id AS DECIMAL(38,0)) AS auto_key, qcn AS auto_qcn FROM auto_quotes)
  JOIN auto_market USING (auto_key) JOIN party_link USING (auto_qcn) JOIN home_market USING (home_qcn)
)""",
        ],
    ),
)
def w42_attribute_mismatch(spark, d):
    return LK.attribute_mismatch(connected(spark, d), [("auto_mkt_grp", "home_mkt_grp"), ("auto_mkt_chnl", "home_mkt_chnl")])


# ----------------------------------------------------------------------------- W34
QUOTE_FROM = "19960101"
W34_COLS = ["qcn", "pol_id", "quote_last_transaction_dt", "resp_ind_cnt", "iss_ind_cnt", "qte_prem_amt", "own_premium",
            "carriers_quoted", "win_ind", "own_rank", "first_pol_eff_dt", "cancel_e_flat", "cancel_e_180",
            "cancel_e_365", "atr_e_flat", "atr_e_180", "atr_e_365", "canc_eff_dt", "pol_risk_st", "pol_new_rnw_cd",
            "pol_cnt_issue_match"]


def quote_funnel(spark, d):
    qf = LN.quote_flow(spark, d).withColumn("_dt", F.to_date("quote_trans_lst_chng_dt", "yyyyMMdd"))
    # latest transaction row and the per-quote maxima in one aggregation
    latest = SEL.latest_with_aggs(
        qf, ["qcn"], ["_dt", "line_no", "part_no", "supp_no", "qte_prem_amt"],
        ["pol_id", "_dt", "qte_prem_amt", "bus_unit_abbr", "quote_trans_lst_chng_dt"],
        [F.max("resp_ind_cnt").alias("resp_ind_cnt"), F.max("iss_ind_cnt").alias("iss_ind_cnt")],
    )
    latest = latest.filter((F.col("bus_unit_abbr") == "AGCY") & (F.col("quote_trans_lst_chng_dt") >= QUOTE_FROM)).select(
        "qcn", "pol_id", F.col("_dt").alias("quote_last_transaction_dt"), "qte_prem_amt", "resp_ind_cnt", "iss_ind_cnt"
    )
    first = SEL.extreme_by_key(pers(spark, d), ["pol_id"], "pol_prd_id", "min").select(
        "pol_id", F.col("pol_eff_dt").alias("first_pol_eff_dt"), "cancel_e_flat", "cancel_e_180", "cancel_e_365",
        "atr_e_flat", "atr_e_180", "atr_e_365", "canc_eff_dt", F.col("risk_st").alias("pol_risk_st"),
        F.col("new_rnw_cd").alias("pol_new_rnw_cd"),
    )
    out = LK.quote_funnel(latest, LN.comparative_rater(spark, d), first)
    return finalize(out.select(*W34_COLS))


@register(
    "w34_quote_funnel",
    _sql(
        f"""SELECT q.qcn, q.pol_id, q.quote_last_transaction_dt, q.resp_ind_cnt, q.iss_ind_cnt, CAST(q.qte_prem_amt AS DOUBLE) AS qte_prem_amt,
       CAST(r.own_premium AS DOUBLE) AS own_premium, r.carriers_quoted, r.win_ind, r.own_rank,
       t.pol_eff_dt AS first_pol_eff_dt, t.cancel_e_flat, t.cancel_e_180, t.cancel_e_365, t.atr_e_flat, t.atr_e_180, t.atr_e_365,
       t.canc_eff_dt, t.risk_st AS pol_risk_st, t.new_rnw_cd AS pol_new_rnw_cd,
       CAST(t.pol_id IS NOT NULL AS INTEGER) AS pol_cnt_issue_match
FROM newest_quote q
LEFT JOIN earliest_term t USING (pol_id)
LEFT JOIN comparative_rater r USING (qcn)""",
        [
            flags_sql(), LN.QUOTE_FLOW_SQL, LN.RATER_SQL,
            f"""newest_quote AS (
  SELECT qcn, pol_id, CAST(strptime(quote_trans_lst_chng_dt, '%Y%m%d') AS DATE) AS quote_last_transaction_dt, qte_prem_amt,
         most_resp AS resp_ind_cnt, most_iss AS iss_ind_cnt
  FROM (
    SELECT *, MAX(resp_ind_cnt) OVER q AS most_resp, MAX(iss_ind_cnt) OVER q AS most_iss,
           row_number() OVER (PARTITION BY qcn ORDER BY strptime(quote_trans_lst_chng_dt, '%Y%m%d') DESC, line_no DESC, part_no DESC, supp_no DESC, qte_prem_amt DESC) AS age
    FROM quote_flow WINDOW q AS (PARTITION BY qcn)
  ) WHERE age = 1 AND bus_unit_abbr = 'AGCY' AND quote_trans_lst_chng_dt >= '{QUOTE_FROM}'
),
earliest_term AS (
  SELECT * FROM pers p WHERE pol_prd_id = (SELECT MIN(f.pol_prd_id) FROM pers f WHERE f.pol_id = p.pol_id)
)""",
        ],
    ),
)
def w34_quote_funnel(spark, d):
    return quote_funnel(spark, d)


deliver_as_double("w34_quote_funnel", ("carriers_quoted", "win_ind", "own_rank"))
deliver_as_text("w34_quote_funnel", ("canc_eff_dt",))


# ----------------------------------------------------------------------------- W36
W36_COLS = ["pol_id", "pol_eff_dt", "hit_prd_id", "hit_line", "uw_ref_decl_rule_id", "msg", "nb", "rw",
            "uw_rule_trig_rsn_desc", "pol_prd_id", "cancel_flag", "pol_form_cd", "orig_pol_eff_dt", "veh_cnt"]


def rule_terms(spark, d):
    t = pers(spark, d)
    veh = (F.col("pol_prd_id") % 3) + (F.col("pol_prd_id") % 2) + (F.col("risk_st") % 2).cast("bigint") + F.lit(1)
    return t.select(
        "pol_id", "pol_eff_dt", "pol_prd_id", "cancel_flag", "pol_form_cd",
        F.col("orig_pol_eff_dt"), veh.alias("veh_cnt"),
    )


@register(
    "w36_enrich_rules",
    _sql(
        """SELECT h.pol_id, h.pol_eff_dt, h.hit_prd_id, h.hit_line, h.uw_ref_decl_rule_id, ref.msg, ref.nb, ref.rw, ref.uw_rule_trig_rsn_desc,
       p.pol_prd_id, p.cancel_flag, p.pol_form_cd, p.orig_pol_eff_dt,
       p.pol_prd_id % 3 + p.pol_prd_id % 2 + CAST(p.risk_st % 2 AS BIGINT) + 1 AS veh_cnt
FROM pers p JOIN rule_hits h USING (pol_id, pol_eff_dt) LEFT JOIN rule_ref ref ON ref.rule_id = h.uw_ref_decl_rule_id""",
        [flags_sql(), LN.RULE_HITS_SQL, LN.RULE_REF_SQL],
    ),
)
def w36_enrich_rules(spark, d):
    return LK.enrich_rules(LN.rule_hits(spark, d), LN.rule_ref(spark, d), rule_terms(spark, d)).select(*W36_COLS)
