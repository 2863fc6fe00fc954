"""Staging layer: the domain tables the operators expect, derived from the
driver's Parquet tables (mapping in FIXTURES.md §2).

Each fixture exists twice: as a DataFrame builder (used by the registered
queries) and as SQL text (used by the DuckDB oracles), written from the same
definitions so both sides agree.  The fixtures are pure projections/joins of
the input tables, so their size grows with the data.

Fixed values (chosen for the emulation, not derived from data):
  AS_OF            2000-06-30   — evaluation date replacing CURRENT_DATE
  cohort groups    nations 0-7 start 1999-07-11 (month 199907),
                   nations 8-15 start 1999-10-03 (199910),
                   nations 16-24 start 2000-01-09 (200001)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inforce.functions.columns import as_date, money, month_key
from inforce.operators.common import partitions_for, with_group_aggs
from inforce.sources.tables import read_table

AS_OF = dt.date(2000, 6, 30)
AS_OF_SQL = "DATE '2000-06-30'"

COHORT_GROUPS = [
    (list(range(0, 8)), dt.date(1999, 7, 11), "199907"),
    (list(range(8, 16)), dt.date(1999, 10, 3), "199910"),
    (list(range(16, 25)), dt.date(2000, 1, 9), "200001"),
]


# --------------------------------------------------------------------------- term
def term(spark: SparkSession, d: str) -> DataFrame:
    """Policy terms: one order = one term of policy ``o_custkey``."""
    o = read_table(spark, d, "orders")
    c = read_table(spark, d, "customer").select(
        F.col("c_custkey"), F.col("c_nationkey").alias("risk_st"), F.col("c_mktsegment").alias("mkt_segment")
    )
    eff = as_date("o_orderdate")
    # first term of each policy: a per-policy minimum joined back (hot-key safe)
    first = F.struct(F.col("o_orderdate"), F.col("o_orderkey"))
    o = with_group_aggs(o, ["o_custkey"], [F.min(first).alias("_first")])
    return (
        o.join(c, o.o_custkey == c.c_custkey, "inner")
        .select(
            F.col("o_custkey").cast("string").alias("pol_id"),
            F.col("o_orderkey").alias("pol_prd_id"),
            eff.alias("pol_eff_dt"),
            F.date_add(eff, 365).alias("pol_exp_dt"),
            money("o_totalprice").alias("prem"),
            F.col("o_orderstatus").alias("rate_plan_cd"),
            F.col("o_orderpriority").alias("pol_form_cd"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0).alias("acct_cr_ind"),
            F.when(
                F.col("o_orderkey") % 4 == 0,
                F.date_add(eff, ((F.col("o_orderkey") * 37) % 420 - 20).cast("int")),
            ).alias("canc_eff_dt"),
            F.col("risk_st"),
            F.col("mkt_segment"),
            F.when(first == F.col("_first"), F.lit("N")).otherwise(F.lit("R")).alias("new_rnw_cd"),
            as_date(F.col("_first.o_orderdate")).alias("orig_pol_eff_dt"),
            F.when(F.col("o_orderkey") % 5 == 0, 6).otherwise(12).alias("term_mo_cnt"),
            F.when(
                F.col("o_orderkey") % 4 == 0,
                F.date_add(eff, ((F.col("o_orderkey") * 37) % 420 - 20 - (F.col("o_orderkey") * 11) % 60).cast("int")),
            ).alias("canc_trans_dt"),
            F.when(F.col("o_orderkey") % 3 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("newco_ind"),
        )
    )


TERM_SQL = """term AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS pol_id,
         o.o_orderkey AS pol_prd_id,
         CAST(o.o_orderdate AS DATE) AS pol_eff_dt,
         CAST(o.o_orderdate AS DATE) + 365 AS pol_exp_dt,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS prem,
         o.o_orderstatus AS rate_plan_cd,
         o.o_orderpriority AS pol_form_cd,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS acct_cr_ind,
         CASE WHEN o.o_orderkey % 4 = 0
              THEN CAST(o.o_orderdate AS DATE) + CAST((o.o_orderkey * 37) % 420 - 20 AS INTEGER) END AS canc_eff_dt,
         c.c_nationkey AS risk_st,
         c.c_mktsegment AS mkt_segment,
         CASE WHEN row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey) = 1
              THEN 'N' ELSE 'R' END AS new_rnw_cd,
         CASE WHEN o.o_orderkey % 5 = 0 THEN 6 ELSE 12 END AS term_mo_cnt,
         CASE WHEN o.o_orderkey % 4 = 0
              THEN CAST(o.o_orderdate AS DATE) + CAST((o.o_orderkey * 37) % 420 - 20 - (o.o_orderkey * 11) % 60 AS INTEGER) END AS canc_trans_dt,
         CASE WHEN o.o_orderkey % 3 = 0 THEN 'N' ELSE 'Y' END AS newco_ind,
         MIN(CAST(o.o_orderdate AS DATE)) OVER (PARTITION BY o.o_custkey) AS orig_pol_eff_dt
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""


# --------------------------------------------------------------------------- loss
def loss_partitions(spark: SparkSession, d: str) -> int:
    """Partitions for the loss rows, counted from the footers of the Parquet files (a
    Spark job that runs when this is called)."""
    return partitions_for(spark, read_table(spark, d, "lineitem").count())


def loss(spark: SparkSession, d: str, partitions: int | None = None) -> DataFrame:
    """Operational loss: one line item = one policy-period x coverage x earned-month row;
    with ``partitions``, dealt by period into so many tasks."""
    li = read_table(spark, d, "lineitem")
    if partitions is not None:
        li = li.repartition(partitions, "l_orderkey")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    inc = money(F.col("l_extendedprice") * F.col("l_discount"), 4)
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("o_custkey").cast("string").alias("pol_id"),
        F.col("l_orderkey").alias("pol_prd_id"),
        as_date("o_orderdate").alias("pol_eff_dt"),
        F.col("l_returnflag").alias("cov_type_abbr"),
        month_key("l_shipdate").alias("earned_month"),
        money("l_quantity").alias("ee"),
        F.when(F.col("l_discount") > 0, 1).otherwise(0).alias("incur_clm_cnt"),
        inc.alias("incur_loss"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("glass_tow_cnt"),
        F.when(F.col("l_linestatus") == "O", inc).otherwise(F.lit(0).cast("decimal(18,4)")).alias("glass_tow_loss"),
        money("l_extendedprice").alias("ep"),
        money(F.col("l_extendedprice") * (F.lit(1.0) + F.col("l_tax")), 4).alias("epapr"),
        money(F.col("l_extendedprice") * (F.col("l_discount") + F.col("l_tax")), 4).alias("ult_loss"),
        F.trunc(as_date("l_shipdate"), "month").alias("earned_month_dt"),
        F.when(F.col("l_linenumber") == 1, F.lit("Y")).otherwise(F.lit("N")).alias("newco_ind"),
    )


LOSS_SQL = """loss AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS pol_id,
         l.l_orderkey AS pol_prd_id,
         CAST(o.o_orderdate AS DATE) AS pol_eff_dt,
         l.l_returnflag AS cov_type_abbr,
         strftime(l.l_shipdate, '%Y%m') AS earned_month,
         CAST(l.l_quantity AS DECIMAL(18,2)) AS ee,
         CASE WHEN l.l_discount > 0 THEN 1 ELSE 0 END AS incur_clm_cnt,
         CAST(l.l_extendedprice * l.l_discount AS DECIMAL(18,4)) AS incur_loss,
         CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END AS glass_tow_cnt,
         CASE WHEN l.l_linestatus = 'O' THEN CAST(l.l_extendedprice * l.l_discount AS DECIMAL(18,4))
              ELSE CAST(0 AS DECIMAL(18,4)) END AS glass_tow_loss,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS ep,
         CAST(l.l_extendedprice * (1.0 + l.l_tax) AS DECIMAL(18,4)) AS epapr,
         CAST(l.l_extendedprice * (l.l_discount + l.l_tax) AS DECIMAL(18,4)) AS ult_loss,
         CAST(date_trunc('month', l.l_shipdate) AS DATE) AS earned_month_dt,
         CASE WHEN l.l_linenumber = 1 THEN 'Y' ELSE 'N' END AS newco_ind
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""


# --------------------------------------------------------------------------- auto policy (UW view)
def auto_policy(spark: SparkSession, d: str) -> DataFrame:
    """Underwriting attributes per term: origin date, clean/dirty code, violation and
    eligibility counts (some eligibility counts NULL on purpose)."""
    o = read_table(spark, d, "orders")
    c = read_table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("risk_st"))
    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    eff = as_date("o_orderdate")
    o = with_group_aggs(o, ["o_custkey"], [F.min(eff).alias("_orig")])
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        ck.cast("string").alias("pol_id"),
        k.alias("pol_prd_id"),
        F.col("risk_st"),
        F.col("_orig").alias("orig_pol_eff_dt"),
        eff.alias("pol_eff_dt"),
        F.col("o_orderstatus").alias("trans_stat_desc"),
        F.when(F.col("o_orderstatus") == "F", F.lit("D")).otherwise(F.lit("C")).alias("clean_dirty_cd"),
        (k % 3).cast("int").alias("spd_vio_cnt"),
        (k % 2).cast("int").alias("nspd_vio_cnt"),
        F.nullif((k % 7).cast("int"), F.lit(6)).alias("uw_afa_cnt"),
        ((k / 7).cast("bigint") % 2).cast("int").alias("uw_naf_cnt"),
        F.nullif((k % 13).cast("int"), F.lit(12)).alias("uw_comp_cnt"),
        (ck % 2).cast("int").alias("uw_mltry_cnt"),
        (ck % 3).cast("int").alias("uw_perm_cnt"),
        F.nullif((ck % 17).cast("int"), F.lit(16)).alias("uw_rentl_cnt"),
    )


AUTO_POLICY_SQL = """auto_policy AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS pol_id,
         o.o_orderkey AS pol_prd_id,
         c.c_nationkey AS risk_st,
         MIN(CAST(o.o_orderdate AS DATE)) OVER (PARTITION BY o.o_custkey) AS orig_pol_eff_dt,
         CAST(o.o_orderdate AS DATE) AS pol_eff_dt,
         o.o_orderstatus AS trans_stat_desc,
         CASE WHEN o.o_orderstatus = 'F' THEN 'D' ELSE 'C' END AS clean_dirty_cd,
         CAST(o.o_orderkey % 3 AS INTEGER) AS spd_vio_cnt,
         CAST(o.o_orderkey % 2 AS INTEGER) AS nspd_vio_cnt,
         NULLIF(CAST(o.o_orderkey % 7 AS INTEGER), 6) AS uw_afa_cnt,
         CAST((o.o_orderkey // 7) % 2 AS INTEGER) AS uw_naf_cnt,
         NULLIF(CAST(o.o_orderkey % 13 AS INTEGER), 12) AS uw_comp_cnt,
         CAST(o.o_custkey % 2 AS INTEGER) AS uw_mltry_cnt,
         CAST(o.o_custkey % 3 AS INTEGER) AS uw_perm_cnt,
         NULLIF(CAST(o.o_custkey % 17 AS INTEGER), 16) AS uw_rentl_cnt
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""


# --------------------------------------------------------------------------- cohort config
def cohort_config(spark: SparkSession) -> DataFrame:
    """Parameter table (state, start date, start month); bounded by the number of states."""
    rows = [(s, start, month) for states, start, month in COHORT_GROUPS for s in states]
    return spark.createDataFrame(rows, "risk_st int, start_dt date, start_month string")


def cohort_config_rows() -> int:
    return sum(len(states) for states, _, _ in COHORT_GROUPS)


def cohort_config_sql() -> str:
    vals = ", ".join(
        f"({s}, DATE '{start.isoformat()}', '{month}')" for states, start, month in COHORT_GROUPS for s in states
    )
    return f"cohort_config AS (SELECT * FROM (VALUES {vals}) AS t(risk_st, start_dt, start_month))"


STAGING_SQL = {
    "term": TERM_SQL,
    "loss": LOSS_SQL,
    "auto_policy": AUTO_POLICY_SQL,
}


def with_ctes(names: list[str], body: str, extra: list[str] | None = None) -> str:
    """Compose an oracle: ``WITH <staging ctes>, <extra ctes> <body>``."""
    parts = [STAGING_SQL[n] if n in STAGING_SQL else n for n in names]
    if extra:
        parts += extra
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


# --------------------------------------------------------------------------- development factors
DEV_PERIODS = ["1"] + [f"{n}-Ult" for n in (330, 300, 270, 240, 210, 180, 150, 120, 90, 60, 30, 0)]
# rows left out on purpose, so the lookup's NVL(…, 1) default is exercised
DEV_MISSING = {("90-Ult", "R"), ("0-Ult", "N")}


def dev_factor_rows() -> list[tuple[str, str, float]]:
    """Factor rule: '1' -> 1.0; step n days -> 0.60 + n/1000 (new) or 0.70 + n/1200 (renewal)."""
    rows = []
    for p in DEV_PERIODS:
        for nr in ("N", "R"):
            if (p, nr) in DEV_MISSING:
                continue
            if p == "1":
                f = 1.0
            else:
                n = int(p.split("-")[0])
                f = round(0.60 + n / 1000.0, 4) if nr == "N" else round(0.70 + n / 1200.0, 4)
            rows.append((p, nr, f))
    return rows


def dev_factors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(dev_factor_rows(), "persistency_period string, pol_new_renew_cd string, dev_fctr double")


def dev_factors_sql() -> str:
    vals = ", ".join(f"('{p}', '{nr}', CAST({f!r} AS DOUBLE))" for p, nr, f in dev_factor_rows())
    return f"dev_factor AS (SELECT * FROM (VALUES {vals}) AS t(persistency_period, pol_new_renew_cd, dev_fctr))"


# --------------------------------------------------------------------------- in-force month-end snapshots
def last_month_end(spark: SparkSession, d: str) -> DataFrame:
    """One row, one column: the last month end that is not after the newest term's
    effective date (the date of the latest snapshot)."""
    newest = F.max(as_date("o_orderdate"))
    me = F.when(newest == F.last_day(newest), newest).otherwise(F.last_day(F.add_months(newest, -1)))
    return read_table(spark, d, "orders").agg(me.alias("me_dt"))


LAST_MONTH_END_SQL = "(SELECT CASE WHEN MAX(pol_eff_dt) = last_day(MAX(pol_eff_dt)) THEN MAX(pol_eff_dt) ELSE CAST(date_trunc('month', MAX(pol_eff_dt)) AS DATE) - 1 END FROM term)"


def inforce_monthend(spark: SparkSession, d: str) -> DataFrame:
    """Month-end snapshots over the whole history: for each month end up to the
    newest term's effective date, the newest term of each policy in force then
    (eff <= me < exp). Each term emits the month ends it covers, so no join against
    a calendar is needed."""
    t = term(spark, d)
    months = F.sequence(F.trunc("pol_eff_dt", "month"), F.trunc("pol_exp_dt", "month"), F.expr("interval 1 month"))
    newest = read_table(spark, d, "orders").agg(F.max(as_date("o_orderdate"))).scalar()
    t = t.withColumn("_newest", newest)
    covered = F.filter(F.transform(months, F.last_day), lambda m: (F.col("pol_eff_dt") <= m) & (F.col("pol_exp_dt") > m) & (m <= F.col("_newest")))
    snap = t.select(
        F.col("pol_id").alias("policy_id"), "pol_prd_id", "pol_eff_dt", "canc_eff_dt", "rate_plan_cd", "pol_form_cd",
        F.explode(covered).alias("me_dt"),
    )
    w = Window.partitionBy("policy_id", "me_dt").orderBy(F.col("pol_eff_dt").desc(), F.col("pol_prd_id").desc())
    return (
        snap.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .select(
            "policy_id", "me_dt", "pol_prd_id", "rate_plan_cd", "pol_form_cd",
            F.when(F.col("canc_eff_dt").isNotNull() & (F.col("canc_eff_dt") <= F.col("me_dt")), F.lit("Cancelled"))
            .otherwise(F.lit("InForce"))
            .alias("pol_status_cd"),
        )
    )


def inforce_monthend_sql() -> str:
    return """month_ends AS (
  SELECT CAST(last_day(m) AS DATE) AS me_dt FROM (
    SELECT unnest(generate_series(date_trunc('month', MIN(pol_eff_dt)), date_trunc('month', MAX(pol_eff_dt)), INTERVAL 1 MONTH)) AS m FROM term)
  WHERE last_day(m) <= (SELECT MAX(pol_eff_dt) FROM term)
),
inforce_monthend AS (
  SELECT policy_id, me_dt, pol_prd_id, rate_plan_cd, pol_form_cd, pol_status_cd FROM (
    SELECT t.pol_id AS policy_id, m.me_dt, t.pol_prd_id, t.rate_plan_cd, t.pol_form_cd,
           CASE WHEN t.canc_eff_dt IS NOT NULL AND t.canc_eff_dt <= m.me_dt THEN 'Cancelled' ELSE 'InForce' END AS pol_status_cd,
           row_number() OVER (PARTITION BY t.pol_id, m.me_dt ORDER BY t.pol_eff_dt DESC, t.pol_prd_id DESC) AS rn
    FROM term t JOIN month_ends m ON t.pol_eff_dt <= m.me_dt AND t.pol_exp_dt > m.me_dt
  ) WHERE rn = 1
)"""


# --------------------------------------------------------------------------- policy characteristics (int dates)
def char_ref(spark: SparkSession, d: str) -> DataFrame:
    """Per-term characteristics as the source's reference table stores them:
    dates as ``yyyymmdd`` integers with 0 for "none", a possibly different
    previous policy id, second-line premium, modelled-loss (AAL) amounts."""
    t = term(spark, d)
    k = F.col("pol_prd_id")

    def ymd(c):
        return F.coalesce(F.date_format(c, "yyyyMMdd").cast("int"), F.lit(0))

    return t.select(
        F.col("pol_id").alias("policy_id"),
        "pol_prd_id",
        ymd(F.col("pol_eff_dt")).alias("pol_eff_dt"),
        ymd(F.col("canc_eff_dt")).alias("canc_eff_dt"),
        ymd(F.col("canc_trans_dt")).alias("pol_entry_dt"),
        F.col("prem").alias("term_writ_prem"),
        F.col("term_mo_cnt").alias("pol_term_mo_cnt"),
        F.when(k % 3 == 0, F.lit(None).cast("decimal(18,4)"))
        .otherwise((F.col("prem").cast("double") * 0.35).cast("decimal(18,4)")).alias("current_term_auto_prem"),
        F.when(F.col("pol_id").cast("bigint") % 4 == 1, (F.col("pol_id").cast("bigint") - 1).cast("string"))
        .otherwise(F.col("pol_id")).alias("prev_pol_id"),
        F.when(F.col("pol_form_cd").isin("1-URGENT", "2-HIGH"), F.lit(1)).when(F.col("pol_form_cd") == "5-LOW", F.lit(None))
        .otherwise(F.lit(2)).alias("acct_cr_cd"),
        F.concat((k % 200).cast("string"), F.lit("."), (k % 10).cast("string")).alias("years_with_co"),
        F.lpad((F.col("risk_st") * 1000 + F.col("pol_id").cast("bigint") % 1000).cast("string"), 5, "0").alias("zip_cd"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.lpad((k % 10000).cast("string"), 4, "0")).alias("plus4_cd"),
        F.trunc("pol_eff_dt", "quarter").alias("rate_tbl_dt"),
        (F.col("prem").cast("double") * 0.01).cast("decimal(18,4)").alias("eq_grss_aal_amt"),
        (F.col("prem").cast("double") * 0.02).cast("decimal(18,4)").alias("hurr_grss_aal_amt"),
        F.when(k % 7 == 0, F.lit(None).cast("decimal(18,2)")).otherwise(((k % 50) * 1.5).cast("decimal(18,2)"))
        .alias("total_aal_cat_load"),
        F.when(F.col("rate_plan_cd") == "P", F.lit("N")).otherwise(F.lit("Y")).alias("aal_data_ind"),
        (k % 3).cast("int").alias("frst_chrg_loss_cnt"),
        ((k + F.col("risk_st")) % 3).cast("int").alias("latst_chrg_loss_cnt"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("S"), (k % 4).cast("string")))
        .alias("frst_ins_score_cd"),
        F.concat(F.lit("S"), ((k + 1) % 4).cast("string")).alias("latst_ins_score_cd"),
    )


CHAR_REF_SQL = """char_ref AS (
  SELECT pol_id AS policy_id, pol_prd_id,
         COALESCE(CAST(strftime(pol_eff_dt, '%Y%m%d') AS INTEGER), 0) AS pol_eff_dt,
         COALESCE(CAST(strftime(canc_eff_dt, '%Y%m%d') AS INTEGER), 0) AS canc_eff_dt,
         COALESCE(CAST(strftime(canc_trans_dt, '%Y%m%d') AS INTEGER), 0) AS pol_entry_dt,
         prem AS term_writ_prem, term_mo_cnt AS pol_term_mo_cnt,
         CASE WHEN pol_prd_id % 3 = 0 THEN NULL ELSE CAST(CAST(prem AS DOUBLE) * 0.35 AS DECIMAL(18,4)) END AS current_term_auto_prem,
         CASE WHEN CAST(pol_id AS BIGINT) % 4 = 1 THEN CAST(CAST(pol_id AS BIGINT) - 1 AS VARCHAR) ELSE pol_id END AS prev_pol_id,
         CASE WHEN pol_form_cd IN ('1-URGENT', '2-HIGH') THEN 1 WHEN pol_form_cd = '5-LOW' THEN NULL ELSE 2 END AS acct_cr_cd,
         CAST(pol_prd_id % 200 AS VARCHAR) || '.' || CAST(pol_prd_id % 10 AS VARCHAR) AS years_with_co,
         lpad(CAST(risk_st * 1000 + CAST(pol_id AS BIGINT) % 1000 AS VARCHAR), 5, '0') AS zip_cd,
         CASE WHEN pol_prd_id % 5 = 0 THEN NULL ELSE lpad(CAST(pol_prd_id % 10000 AS VARCHAR), 4, '0') END AS plus4_cd,
         CAST(date_trunc('quarter', pol_eff_dt) AS DATE) AS rate_tbl_dt,
         CAST(CAST(prem AS DOUBLE) * 0.01 AS DECIMAL(18,4)) AS eq_grss_aal_amt,
         CAST(CAST(prem AS DOUBLE) * 0.02 AS DECIMAL(18,4)) AS hurr_grss_aal_amt,
         CASE WHEN pol_prd_id % 7 = 0 THEN NULL ELSE CAST((pol_prd_id % 50) * 1.5 AS DECIMAL(18,2)) END AS total_aal_cat_load,
         CASE WHEN rate_plan_cd = 'P' THEN 'N' ELSE 'Y' END AS aal_data_ind,
         CAST(pol_prd_id % 3 AS INTEGER) AS frst_chrg_loss_cnt,
         CAST((pol_prd_id + risk_st) % 3 AS INTEGER) AS latst_chrg_loss_cnt,
         CASE WHEN pol_prd_id % 11 = 0 THEN NULL ELSE 'S' || CAST(pol_prd_id % 4 AS VARCHAR) END AS frst_ins_score_cd,
         'S' || CAST((pol_prd_id + 1) % 4 AS VARCHAR) AS latst_ins_score_cd
  FROM term
)"""
STAGING_SQL["char_ref"] = CHAR_REF_SQL


# --------------------------------------------------------------------------- modelled losses and first / latest values
# Rules of the emulated columns: name -> (modulus, factor, modulus of the rows without a value)
MODEL_AMOUNTS = {
    "eq_grss_aal": (97, "0.75", 13), "ffe_grss_aal": (89, "0.25", 17), "hurr_near_term_grss_aal": (83, "1.5", 11), "hurr_lt_grss_aal": (79, "1.25", 19),
    "tor_grss_aal": (73, "0.5", 23), "hail_grss_aal": (71, "0.75", 29), "wldfr_grss_aal": (67, "2.25", 31), "rms_wt_gr_aal": (61, "1.75", 37), "tot_aal": (59, "3.5", 41),
}
# name -> (modulus, offset of the latest value, modulus of the rows without a first value)
FIRST_LATEST_CODES = {"ins_score_model_type": (3, 1, 13), "rating_terr": (5, 2, 17), "protection_class_pt1": (4, 3, 19), "itv_pct": (6, 1, 23)}


def model_ref(spark: SparkSession, d: str) -> DataFrame:
    """``char_ref`` with all modelled-loss columns of a term, the month and kind of
    their data, and the first and latest charged values of the rating inputs."""
    k = F.col("pol_prd_id")
    out = [(F.when(k % gap != 0, ((k + F.col("risk_st")) % m).cast("decimal(10,2)") * F.lit(f).cast("decimal(4,2)")).cast("decimal(18,2)")).alias(c) for c, (m, f, gap) in MODEL_AMOUNTS.items()]
    out.append(F.date_format(F.add_months(F.to_date(F.col("pol_eff_dt").cast("string"), "yyyyMMdd"), -2), "yyyyMM").alias("aal_yrmo_dt"))
    out.append(F.concat(F.lit("G"), (F.col("pol_prd_id") % 50 / 10).cast("int").cast("string")).alias("tot_aal_cat_load_wp_grp"))
    for c, (m, shift, gap) in FIRST_LATEST_CODES.items():
        out.append(F.when(k % gap != 0, F.concat(F.lit("V"), (k % m).cast("string"))).alias(f"frst_{c}"))
        out.append(F.concat(F.lit("V"), ((k + shift * (F.col("risk_st") % 3)) % m).cast("string")).alias(f"latst_{c}"))
    state = term(spark, d).select("pol_prd_id", "risk_st")
    return char_ref(spark, d).join(state, "pol_prd_id").select("*", *out).drop("risk_st")


def model_ref_sql() -> str:
    out = [f"CASE WHEN c.pol_prd_id % {gap} <> 0 THEN CAST(CAST((c.pol_prd_id + t.risk_st) % {m} AS DECIMAL(10,2)) * CAST({f} AS DECIMAL(4,2)) AS DECIMAL(18,2)) END AS {c}" for c, (m, f, gap) in MODEL_AMOUNTS.items()]
    out.append("strftime(t.pol_eff_dt - INTERVAL 2 MONTH, '%Y%m') AS aal_yrmo_dt")
    out.append("'G' || CAST((c.pol_prd_id % 50) // 10 AS VARCHAR) AS tot_aal_cat_load_wp_grp")
    for c, (m, shift, gap) in FIRST_LATEST_CODES.items():
        out.append(f"CASE WHEN c.pol_prd_id % {gap} <> 0 THEN 'V' || CAST(c.pol_prd_id % {m} AS VARCHAR) END AS frst_{c}")
        out.append(f"'V' || CAST((c.pol_prd_id + {shift} * (t.risk_st % 3)) % {m} AS VARCHAR) AS latst_{c}")
    return "model_ref AS (SELECT c.*, " + ", ".join(out) + " FROM char_ref c JOIN term t USING (pol_prd_id))"


# --------------------------------------------------------------------------- expected renewal premium change
EXPECTED_COLS = ["pol_eff_yrmo", "polyr", "curr_ye_outlk_pct", "snr", "snr_premium_change", "overall_expected_rate", "expected_premium_change", "low_prem_flag", "overall_expected_rate_grp"]


def expected_change(spark: SparkSession, d: str) -> DataFrame:
    """Expected renewal figures per policy period; two periods in three have them."""
    o = read_table(spark, d, "orders").filter(F.col("o_orderkey") % 3 != 2)
    k = F.col("o_orderkey")
    outlook, snr = (k % 11 - 3).cast("decimal(10,4)") / 100, (k % 7).cast("decimal(10,4)") / 100
    rate = (outlook + snr).cast("decimal(10,4)")
    return o.select(
        k.alias("pol_prd_id"), F.date_format("o_orderdate", "yyyyMM").alias("pol_eff_yrmo"), F.year("o_orderdate").alias("polyr"),
        outlook.cast("decimal(10,4)").alias("curr_ye_outlk_pct"), snr.cast("decimal(10,4)").alias("snr"),
        (money("o_totalprice") * snr.cast("decimal(10,4)")).cast("decimal(18,4)").alias("snr_premium_change"),
        rate.alias("overall_expected_rate"), (money("o_totalprice") * rate).cast("decimal(18,4)").alias("expected_premium_change"),
        F.when(F.col("o_totalprice") < 20000, "Y").otherwise("N").alias("low_prem_flag"),
        F.when(rate < 0, "decrease").when(rate < F.lit("0.05").cast("decimal(10,4)"), "0 to 5").otherwise("5 or more").alias("overall_expected_rate_grp"),
    )


EXPECTED_SQL = """expected_change AS (
  SELECT o_orderkey AS pol_prd_id, strftime(o_orderdate, '%Y%m') AS pol_eff_yrmo, CAST(year(o_orderdate) AS INTEGER) AS polyr,
         outlook AS curr_ye_outlk_pct, snr, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * snr AS DECIMAL(18,4)) AS snr_premium_change,
         rate AS overall_expected_rate, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * rate AS DECIMAL(18,4)) AS expected_premium_change,
         IF(o_totalprice < 20000, 'Y', 'N') AS low_prem_flag,
         CASE WHEN rate < 0 THEN 'decrease' WHEN rate < 0.05 THEN '0 to 5' ELSE '5 or more' END AS overall_expected_rate_grp
  FROM (SELECT *, CAST(outlook + snr AS DECIMAL(10,4)) AS rate FROM (
    SELECT *, CAST(CAST(o_orderkey % 11 - 3 AS DECIMAL(10,4)) * 0.01 AS DECIMAL(10,4)) AS outlook,
           CAST(CAST(o_orderkey % 7 AS DECIMAL(10,4)) * 0.01 AS DECIMAL(10,4)) AS snr
    FROM orders WHERE o_orderkey % 3 <> 2))
)"""


# --------------------------------------------------------------------------- policies that replaced another one
def renewal_terms(spark: SparkSession, d: str) -> DataFrame:
    """Terms with the latest premium of the policy that theirs replaced: policies with
    id 4n+1 replaced policy 4n, so their first term is a renewal too."""
    t = term(spark, d)
    k = F.col("pol_id").cast("bigint")
    newest = F.max_by("prem", F.struct("pol_eff_dt", "pol_prd_id"))
    last = t.groupBy(F.col("pol_id").alias("replaced_id")).agg(newest.alias("replaced_prem"))
    # terms that replaced nothing get a stand-in that matches no policy and differs from
    # term to term: as NULL they would all go to one task of the join
    none = F.concat(F.lit("none "), F.coalesce(F.col("pol_prd_id").cast("string"), F.lit("")))
    t = t.withColumn("replaced_id", F.when(k % 4 == 1, (k - 1).cast("string")).otherwise(none)).join(last, "replaced_id", "left")
    return t.withColumn("new_rnw_cd", F.when(F.col("replaced_prem").isNotNull(), "R").otherwise(F.col("new_rnw_cd"))).drop("replaced_id")
