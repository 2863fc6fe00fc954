"""Second-line, quote, link, billing, campaign, web-event, rule and claim
fixtures derived from the driver tables (FIXTURES.md §2), each with its SQL
twin for the oracles.

Fixed emulation choices: the second product line ("home") is one policy per
supplier; quotes are orders (line A) and suppliers (line B); the party link
is the distinct (order, supplier) pairs of line items.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inforce.functions.columns import as_date
from inforce.sources.tables import read_table

HOME_BASE_DATE = dt.date(1999, 7, 1)
PLAN_CODES = {"AUTOMOBILE": "ACT_A1", "BUILDING": "ACT_A3", "FURNITURE": "ACT_A5", "HOUSEHOLD": "ACT_A6",
              "MACHINERY": "ACT_A7"}
MEDIA_GROUPS = {"AUTOMOBILE": "Digital", "BUILDING": "Print", "FURNITURE": "TV"}


def _case_map(col: str, mapping: dict, default: str | None = None) -> str:
    parts = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {parts} ELSE {repr(default) if default is not None else 'NULL'} END".replace('"', "'")


def _map(col, mapping: dict, default=None):
    c = F.col(col)
    e = None
    for k, v in mapping.items():
        e = F.when(c == k, F.lit(v)) if e is None else e.when(c == k, F.lit(v))
    return e.otherwise(F.lit(default))


# --------------------------------------------------------------------------- home line (B)
def home_policy(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier")
    k = F.col("s_suppkey")
    eff = F.date_add(F.lit(HOME_BASE_DATE), ((k * 37) % 365).cast("int"))
    canc = F.when(F.col("s_acctbal") < 1000, F.date_add(eff, ((k * 11) % 200).cast("int")))
    return s.select(
        k.cast("string").alias("pol_id"),
        k.alias("pol_prd_id"),
        eff.alias("pol_eff_dt"),
        F.date_add(eff, 365).alias("pol_exp_dt"),
        canc.alias("canc_eff_dt"),
        F.date_sub(canc, 10).alias("canc_trans_dt"),
        F.when(F.col("s_acctbal") < 1000, F.lit("Cancelled")).otherwise(F.lit("InForce")).alias("pol_status_cd"),
        F.when(k % 3 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("acct_cr_ind"),
        F.concat(F.lit("HO"), (k % 4 + 3).cast("string")).alias("pol_form_cd"),
        F.when(F.col("s_nationkey") % 3 == 0, F.lit("Agency")).when(F.col("s_nationkey") % 3 == 1, F.lit("Direct"))
        .otherwise(F.lit("Partner")).alias("market_channel"),
        F.when(k % 4 == 0, F.lit("Digital")).when(k % 4 == 1, F.lit("Print")).when(k % 4 == 2, F.lit("TV"))
        .otherwise(F.lit("Referral")).alias("mktg_media_grp"),
    )


HOME_POLICY_SQL = f"""home_policy AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS pol_id, s_suppkey AS pol_prd_id,
         DATE '{HOME_BASE_DATE.isoformat()}' + CAST((s_suppkey * 37) % 365 AS INTEGER) AS pol_eff_dt,
         DATE '{HOME_BASE_DATE.isoformat()}' + CAST((s_suppkey * 37) % 365 AS INTEGER) + 365 AS pol_exp_dt,
         CASE WHEN s_acctbal < 1000 THEN DATE '{HOME_BASE_DATE.isoformat()}' + CAST((s_suppkey * 37) % 365 AS INTEGER) + CAST((s_suppkey * 11) % 200 AS INTEGER) END AS canc_eff_dt,
         CASE WHEN s_acctbal < 1000 THEN DATE '{HOME_BASE_DATE.isoformat()}' + CAST((s_suppkey * 37) % 365 AS INTEGER) + CAST((s_suppkey * 11) % 200 AS INTEGER) - 10 END AS canc_trans_dt,
         CASE WHEN s_acctbal < 1000 THEN 'Cancelled' ELSE 'InForce' END AS pol_status_cd,
         CASE WHEN s_suppkey % 3 = 0 THEN 'Y' ELSE 'N' END AS acct_cr_ind,
         'HO' || CAST(s_suppkey % 4 + 3 AS VARCHAR) AS pol_form_cd,
         CASE WHEN s_nationkey % 3 = 0 THEN 'Agency' WHEN s_nationkey % 3 = 1 THEN 'Direct' ELSE 'Partner' END AS market_channel,
         CASE WHEN s_suppkey % 4 = 0 THEN 'Digital' WHEN s_suppkey % 4 = 1 THEN 'Print' WHEN s_suppkey % 4 = 2 THEN 'TV' ELSE 'Referral' END AS mktg_media_grp
  FROM supplier
)"""


# --------------------------------------------------------------------------- quotes and party link
def auto_quotes(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("qcn"), F.col("o_custkey").cast("string").alias("pol_id"),
        F.date_sub(as_date("o_orderdate"), 20).alias("qte_dt"),
    )


AUTO_QUOTES_SQL = """auto_quotes AS (
  SELECT o_orderkey AS qcn, CAST(o_custkey AS VARCHAR) AS pol_id, CAST(o_orderdate AS DATE) - 20 AS qte_dt FROM orders
)"""


def home_quotes(spark: SparkSession, d: str) -> DataFrame:
    h = home_policy(spark, d)
    return h.select(F.col("pol_prd_id").alias("qcn"), "pol_id", F.date_sub("pol_eff_dt", 30).alias("qte_dt"))


HOME_QUOTES_SQL = "home_quotes AS (SELECT pol_prd_id AS qcn, pol_id, pol_eff_dt - 30 AS qte_dt FROM home_policy)"


def party_link_rows(spark: SparkSession, d: str, partitions: int | None = None) -> DataFrame:
    """Linked quotes as they come, with repeats; with ``partitions``, dealt by the auto
    quote into so many tasks."""
    li = read_table(spark, d, "lineitem")
    if partitions is not None:
        li = li.repartition(partitions, "l_orderkey")
    return li.select(F.col("l_orderkey").alias("auto_qcn"), F.col("l_suppkey").alias("home_qcn"))


def party_link(spark: SparkSession, d: str) -> DataFrame:
    return party_link_rows(spark, d).distinct()


PARTY_LINK_SQL = "party_link AS (SELECT DISTINCT l_orderkey AS auto_qcn, l_suppkey AS home_qcn FROM lineitem)"


# --------------------------------------------------------------------------- billing and campaign
def billing_account(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("bill_acct_id"), _map("c_mktsegment", PLAN_CODES).alias("bill_acct_plan_typ_cd"))


def billing_term(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    eff = as_date("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("pol_term_id"), F.col("o_custkey").cast("string").alias("pol_id"),
        eff.alias("pol_eff_dt"), F.date_add(eff, 365).alias("pol_exp_dt"), F.col("o_custkey").alias("orig_bill_acct_id"),
    )


def billing_term_data(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("pol_term_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Full Pay")).otherwise(F.lit("Monthly Installments")).alias(
            "bill_instal_typ_desc"
        ),
    )


BILLING_SQL = f"""billing_data AS (
  SELECT c_custkey AS bill_acct_id, o_orderkey AS pol_term_id, CAST(o_custkey AS VARCHAR) AS pol_id,
         CAST(o_orderdate AS DATE) AS pol_eff_dt, CAST(o_orderdate AS DATE) + 365 AS pol_exp_dt,
         {_case_map('c_mktsegment', PLAN_CODES)} AS bill_acct_plan_typ_cd,
         IF(o_orderstatus = 'F', 'Full Pay', 'Monthly Installments') AS bill_instal_typ_desc
  FROM customer JOIN orders ON c_custkey = o_custkey
)"""

HOME_PLANS = [f"ACT_A{n}" for n in range(1, 9)]


def home_billing(spark: SparkSession, d: str) -> DataFrame:
    """Billing terms of the home line; some are paid in full by a mortgagee."""
    h = home_policy(spark, d)
    k = F.col("pol_prd_id")
    inst = F.when(k % 5 == 0, "Full Pay (Mortgagee)").when(k % 5 <= 2, "Full Pay").otherwise("Monthly Installments")
    return h.select(
        k.alias("pol_term_id"), "pol_id", "pol_eff_dt", inst.alias("bill_instal_typ_desc"),
        F.concat(F.lit("ACT_A"), (k % len(HOME_PLANS) + 1).cast("string")).alias("bill_acct_plan_typ_cd"),
    )


HOME_BILLING_SQL = f"""home_billing AS (
  SELECT pol_prd_id AS pol_term_id, pol_id, pol_eff_dt,
         CASE WHEN pol_prd_id % 5 = 0 THEN 'Full Pay (Mortgagee)' WHEN pol_prd_id % 5 <= 2 THEN 'Full Pay' ELSE 'Monthly Installments' END AS bill_instal_typ_desc,
         'ACT_A' || CAST(pol_prd_id % {len(HOME_PLANS)} + 1 AS VARCHAR) AS bill_acct_plan_typ_cd
  FROM home_policy
)"""


def campaign_extract(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    arm = F.when(F.col("o_custkey") % 3 == 0, F.col("o_orderkey") % 2).otherwise(F.col("o_custkey") % 2)
    return o.select(
        F.col("o_custkey").cast("string").alias("pol_id"),
        F.col("o_orderkey").alias("extract_id"),
        F.when(arm == 0, F.lit("C")).otherwise(F.lit("T")).alias("ctrl_test_cd"),
        F.lit("AUTO").alias("loi_cd"),
        F.when(F.col("o_orderstatus") == "P", F.lit("RecordUpdate")).otherwise(F.lit("RecordInsert")).alias("bill_extrct_typ_desc"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("Y")).otherwise(F.lit("N")).alias("do_not_call_cntct_list_ind"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Full Pay")).otherwise(F.lit("Monthly Installments")).alias(
            "bill_instal_typ_desc"
        ),
    )


CAMPAIGN_SQL = """campaign_extract AS (
  SELECT CAST(o_custkey AS VARCHAR) AS pol_id, o_orderkey AS extract_id,
         CASE WHEN (CASE WHEN o_custkey % 3 = 0 THEN o_orderkey % 2 ELSE o_custkey % 2 END) = 0 THEN 'C' ELSE 'T' END AS ctrl_test_cd,
         'AUTO' AS loi_cd,
         CASE WHEN o_orderstatus = 'P' THEN 'RecordUpdate' ELSE 'RecordInsert' END AS bill_extrct_typ_desc,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'Y' ELSE 'N' END AS do_not_call_cntct_list_ind,
         CASE WHEN o_orderstatus = 'F' THEN 'Full Pay' ELSE 'Monthly Installments' END AS bill_instal_typ_desc
  FROM orders
)"""


def home_campaign(spark: SparkSession, d: str) -> DataFrame:
    """Campaign extract of the home line: two records per policy; every fifth policy
    is in both arms."""
    k, nth = F.col("pol_prd_id"), F.col("nth")
    h = home_billing(spark, d).withColumnRenamed("pol_term_id", "pol_prd_id").withColumn("nth", F.explode(F.array(F.lit(0), F.lit(1))))
    arm = F.when(k % 5 == 4, (k + nth) % 2).otherwise(k % 2)
    return h.select(
        "pol_id", (k * 2 + nth).alias("extract_id"), F.when(arm == 0, "C").otherwise("T").alias("ctrl_test_cd"),
        F.lit("HOME").alias("loi_cd"), F.lit("RecordInsert").alias("bill_extrct_typ_desc"),
        F.lit("N").alias("do_not_call_cntct_list_ind"), "bill_instal_typ_desc",
    )


HOME_CAMPAIGN_SQL = """home_campaign AS (
  SELECT pol_id, pol_term_id * 2 + nth AS extract_id, bill_instal_typ_desc,
         IF((CASE WHEN pol_term_id % 5 = 4 THEN pol_term_id + nth ELSE pol_term_id END) % 2 = 0, 'C', 'T') AS ctrl_test_cd
  FROM home_billing, (VALUES (0), (1)) copies(nth)
)"""


# --------------------------------------------------------------------------- web events
QUALIFYING_EVENTS = ["purchase"]
QUALIFYING_PAGE = "renewal-dashboard"
QUALIFYING_DETAIL = "learn-more-rate"
SITE = "policy-service"


def web_events(spark: SparkSession, d: str) -> DataFrame:
    return web_events_from(read_table(spark, d, "events"))


def web_events_from(e: DataFrame) -> DataFrame:
    """Raw event rows -> web-event columns (works on batch and streaming frames)."""
    uid = F.lpad(F.col("user_id").cast("string"), 11, "0")
    nxt = F.lpad((F.col("user_id") + 1).cast("string"), 11, "0")
    eid = F.col("event_id")
    pn = (
        F.when(eid % 5 == 0, F.concat(uid, F.lit(",")))
        .when(eid % 5 == 1, F.concat(uid, F.lit(", ph"), (eid % 1000).cast("string"), F.lit(", "), nxt))
        .when(eid % 5 == 2, F.lit(""))
        .otherwise(uid)
    )
    day = as_date("ts")
    return e.select(
        pn.alias("policy_num"),
        day.alias("event_day"),
        F.when(eid % 7 == 0, F.lit("other-site")).otherwise(F.lit(SITE)).alias("web_site_identifier"),
        F.when(eid % 11 == 0, F.lit("true")).otherwise(F.lit("false")).alias("internal_traffic"),
        F.lit("consumer").alias("app_user_access_role"),
        F.col("event_type").alias("event_id"),
        F.when((F.col("event_type") == "view") & (F.col("value") >= 45), F.lit(QUALIFYING_PAGE))
        .otherwise(F.concat(F.col("event_type"), F.lit("-page"))).alias("page_name"),
        F.when((F.col("event_type") == "click") & (F.col("value") < 5), F.lit(QUALIFYING_DETAIL)).alias("event_detail"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), day.cast("string")).alias("session_id"),
    )


WEB_EVENTS_SQL = f"""web_events AS (
  SELECT CASE WHEN event_id % 5 = 0 THEN lpad(CAST(user_id AS VARCHAR), 11, '0') || ','
              WHEN event_id % 5 = 1 THEN lpad(CAST(user_id AS VARCHAR), 11, '0') || ', ph' || CAST(event_id % 1000 AS VARCHAR) || ', ' || lpad(CAST(user_id + 1 AS VARCHAR), 11, '0')
              WHEN event_id % 5 = 2 THEN ''
              ELSE lpad(CAST(user_id AS VARCHAR), 11, '0') END AS policy_num,
         CAST(ts AS DATE) AS event_day,
         CASE WHEN event_id % 7 = 0 THEN 'other-site' ELSE '{SITE}' END AS web_site_identifier,
         CASE WHEN event_id % 11 = 0 THEN 'true' ELSE 'false' END AS internal_traffic,
         'consumer' AS app_user_access_role,
         event_type AS event_id,
         CASE WHEN event_type = 'view' AND value >= 45 THEN '{QUALIFYING_PAGE}' ELSE event_type || '-page' END AS page_name,
         CASE WHEN event_type = 'click' AND value < 5 THEN '{QUALIFYING_DETAIL}' END AS event_detail,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id
  FROM events
)"""


# --------------------------------------------------------------------------- rule hits / reference
def rule_hits(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("pol_id"), as_date("o_orderdate").alias("pol_eff_dt"),
        F.col("l_orderkey").alias("hit_prd_id"), F.col("l_linenumber").alias("hit_line"),
        F.col("l_partkey").alias("uw_ref_decl_rule_id"),
    )


RULE_HITS_SQL = """rule_hits AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS pol_id, CAST(o.o_orderdate AS DATE) AS pol_eff_dt,
         l.l_orderkey AS hit_prd_id, l.l_linenumber AS hit_line, l.l_partkey AS uw_ref_decl_rule_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""


def rule_ref(spark: SparkSession, d: str) -> DataFrame:
    """Reference text per rule."""
    p = read_table(spark, d, "part")
    return p.select(
        F.col("p_partkey").alias("rule_id"), F.col("p_name").alias("msg"), F.col("p_brand").alias("nb"),
        F.col("p_type").alias("rw"), F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("uw_rule_trig_rsn_desc"),
    )


RULE_REF_SQL = """rule_ref AS (
  SELECT p_partkey AS rule_id, p_name AS msg, p_brand AS nb, p_type AS rw, 'size ' || CAST(p_size AS VARCHAR) AS uw_rule_trig_rsn_desc
  FROM part
)"""


# --------------------------------------------------------------------------- quote flow / comparative rater
def quote_flow(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("qcn"), F.col("o_custkey").cast("string").alias("pol_id"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("quote_trans_lst_chng_dt"),
        (F.col("l_linenumber") % 3).cast("int").alias("resp_ind_cnt"),
        F.when(F.col("l_returnflag") == "N", 1).otherwise(0).alias("iss_ind_cnt"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), F.lit("AGCY")).otherwise(F.lit("DIRECT"))
        .alias("bus_unit_abbr"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("qte_prem_amt"),
        F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("part_no"), F.col("l_suppkey").alias("supp_no"),
    )


QUOTE_FLOW_SQL = """quote_flow AS (
  SELECT l.l_orderkey AS qcn, CAST(o.o_custkey AS VARCHAR) AS pol_id, strftime(l.l_shipdate, '%Y%m%d') AS quote_trans_lst_chng_dt,
         CAST(l.l_linenumber % 3 AS INTEGER) AS resp_ind_cnt, CASE WHEN l.l_returnflag = 'N' THEN 1 ELSE 0 END AS iss_ind_cnt,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'AGCY' ELSE 'DIRECT' END AS bus_unit_abbr,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS qte_prem_amt,
         l.l_linenumber AS line_no, l.l_partkey AS part_no, l.l_suppkey AS supp_no
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""


def comparative_rater(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("qcn"), F.col("o_totalprice").cast("decimal(18,2)").alias("own_premium"),
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("carriers_quoted"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("win_ind"),
        (F.col("o_orderkey") % 4 + 1).cast("int").alias("own_rank"),
    )


RATER_SQL = """comparative_rater AS (
  SELECT o_orderkey AS qcn, CAST(o_totalprice AS DECIMAL(18,2)) AS own_premium,
         CAST(o_orderkey % 5 + 1 AS INTEGER) AS carriers_quoted,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS win_ind,
         CAST(o_orderkey % 4 + 1 AS INTEGER) AS own_rank
  FROM orders
)"""


# --------------------------------------------------------------------------- claims source
def claims_source(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cov = F.when(F.col("l_returnflag") == "A", "Glass").when(F.col("l_returnflag") == "N", "Collision").otherwise("Towing")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("clm_id"), F.col("l_linenumber").alias("loss_evnt_num"),
        F.col("o_custkey").cast("string").alias("pol_id"), cov.alias("cov_typ_desc"),
        F.col("l_shipdate").alias("loss_dt"), F.col("o_orderdate").alias("rpt_tmsp"),
        (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)").alias("clm_ttl_inc_amt"),
    )


CLAIMS_SQL = """claims_source AS (
  SELECT l.l_orderkey AS clm_id, l.l_linenumber AS loss_evnt_num, CAST(o.o_custkey AS VARCHAR) AS pol_id,
         CASE WHEN l.l_returnflag = 'A' THEN 'Glass' WHEN l.l_returnflag = 'N' THEN 'Collision' ELSE 'Towing' END AS cov_typ_desc,
         l.l_shipdate AS loss_dt, o.o_orderdate AS rpt_tmsp,
         CAST(l.l_extendedprice * l.l_discount AS DECIMAL(18,4)) AS clm_ttl_inc_amt
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""
