"""Registered loss-core queries (W09-W15) on the staged driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from inforce.operators import loss as L
from inforce.plans.registry import finalize, register
from inforce.sources import staging as S

# ----------------------------------------------------------------------------- shared SQL pieces
EE_SQL = (
    "CAST(day(last_day(CAST(strptime({m} || '01', '%Y%m%d') AS DATE))) AS DOUBLE) / "
    "CAST(dayofyear(make_date(CAST(substr({m}, 1, 4) AS INTEGER), 12, 31)) AS DOUBLE)"
)

_ELIG = L.ELIG_COLS
_DERIVED = " + ".join(f"p.{c}" for c in L.DERIVED_PARTS)

COHORT_SQL = f"""cohort AS (
  SELECT p.pol_id, p.pol_prd_id, p.risk_st, p.orig_pol_eff_dt, p.pol_eff_dt, p.trans_stat_desc,
         CASE WHEN p.orig_pol_eff_dt > CAST({S.AS_OF_SQL} - INTERVAL 6 MONTH AS DATE) THEN 'NB' ELSE 'Renewal' END AS pol_type,
         p.clean_dirty_cd, p.spd_vio_cnt, p.nspd_vio_cnt, {", ".join("p." + c for c in _ELIG)},
         CAST({_DERIVED} AS INTEGER) AS derived_ttl_cnt,
         CASE WHEN {_DERIVED} = 0 THEN 'No Acc/Viol/Comp' ELSE 'Yes Acc/Viol/Comp' END AS derived_yes_no_flag,
         c.start_dt, c.start_month
  FROM auto_policy p JOIN cohort_config c ON p.risk_st = c.risk_st
  WHERE p.pol_eff_dt >= c.start_dt AND {" AND ".join(f"p.{c} IS NOT NULL" for c in _ELIG)}
)"""

_ATTR_MIN = ",\n         ".join(
    f"MIN(co.{c}) AS {'latest_pol_eff_dt' if c == 'pol_eff_dt' else c}" for c in L.ATTR_COLS
)
ROLLUP_SQL = f"""rollup AS (
  SELECT co.pol_id, l.earned_month,
         {_ATTR_MIN},
         CAST(SUM(l.incur_clm_cnt) AS BIGINT) AS incur_clm_cnt, SUM(l.incur_loss) AS incur_loss,
         CAST(SUM(l.glass_tow_cnt) AS BIGINT) AS glass_tow_cnt, SUM(l.glass_tow_loss) AS glass_tow_loss,
         SUM(l.ep) AS ep, SUM(l.epapr) AS epapr,
         CAST({EE_SQL.format(m="l.earned_month")} AS DECIMAL(18,12)) AS ee
  FROM loss l JOIN cohort co ON l.pol_id = co.pol_id AND l.pol_eff_dt = co.pol_eff_dt
  WHERE l.cov_type_abbr NOT IN ('R') AND l.earned_month >= co.start_month
  GROUP BY co.pol_id, l.earned_month
)"""

FIXED_SQL = """fixed AS (
  SELECT * REPLACE (CASE WHEN clean_dirty_cd = 'D' THEN 'Yes Acc/Viol/Comp' ELSE derived_yes_no_flag END AS derived_yes_no_flag)
  FROM rollup
)"""

SEGMENT_SQL = (
    "CASE WHEN clean_dirty_cd = 'C' AND derived_yes_no_flag = 'No Acc/Viol/Comp' THEN 'Clean/Clean' "
    "WHEN clean_dirty_cd = 'C' AND derived_yes_no_flag = 'Yes Acc/Viol/Comp' THEN 'Clean/Dirty' "
    "ELSE 'Dirty/Dirty' END"
)

_UW_CTES = ["auto_policy", "loss"]


def _uw_sql(body: str, upto: str = "fixed", more: list[str] | None = None) -> str:
    extra = [S.cohort_config_sql(), COHORT_SQL]
    if upto in ("rollup", "fixed"):
        extra.append(ROLLUP_SQL)
    if upto == "fixed":
        extra.append(FIXED_SQL)
    return S.with_ctes(_UW_CTES, body, extra + (more or []))


# ----------------------------------------------------------------------------- shared DataFrame stages
def uw_cohort(spark, d):
    return L.cohort_extract(S.auto_policy(spark, d), S.cohort_config(spark), S.AS_OF, config_rows=S.cohort_config_rows())


def uw_rollup(spark, d):
    return L.loss_rollup(S.loss(spark, d), uw_cohort(spark, d))


def uw_fixed(spark, d):
    return L.reclassify(uw_rollup(spark, d), F.col("clean_dirty_cd") == "D", "derived_yes_no_flag", L.YES_ACC_LABEL)


# ----------------------------------------------------------------------------- W09
_W09_COLS = [
    "pol_id", "pol_prd_id", "risk_st", "orig_pol_eff_dt", "pol_eff_dt", "trans_stat_desc", "pol_type",
    "clean_dirty_cd", "spd_vio_cnt", "nspd_vio_cnt", *_ELIG, "derived_ttl_cnt", "derived_yes_no_flag", "start_month",
]


@register("w09_cohort_extract", _uw_sql(f"SELECT {', '.join(_W09_COLS)} FROM cohort", upto="cohort"))
def w09_cohort_extract(spark, d):
    return uw_cohort(spark, d).select(*_W09_COLS)


# two versions per state: terms of 1999 and terms from 2000 on, which one group does not have
VERSIONS = [
    (s, first, last, start, month)
    for states, start, month in S.COHORT_GROUPS
    for s in states
    for first, last in ([(None, dt.date(1999, 12, 31)), (dt.date(2000, 1, 1), None)] if s % 3 else [(None, dt.date(1999, 12, 31))])
]


def _version_start(start, first):
    """The second version of a state starts a quarter later."""
    return start if first is None else start + dt.timedelta(days=91)


@register(
    "w09_cohort_versions",
    S.with_ctes(
        _UW_CTES,
        f"SELECT {', '.join(_W09_COLS)} FROM cohort",
        [
            "cohort_versions AS (SELECT * FROM (VALUES "
            + ", ".join(f"({s}, DATE '{a or dt.date(1, 1, 1)}', DATE '{b or dt.date(9999, 12, 31)}', DATE '{_version_start(start, a)}', '{month}')" for s, a, b, start, month in VERSIONS)
            + ") AS t(risk_st, first_day, last_day, start_dt, start_month))",
            COHORT_SQL.replace("cohort_config c ON p.risk_st = c.risk_st", "cohort_versions c ON p.risk_st = c.risk_st AND p.pol_eff_dt BETWEEN c.first_day AND c.last_day"),
        ],
    ),
)
def w09_cohort_versions(spark, d):
    """The cohort with several configuration versions per state, picked by effective date."""
    rows = [(s, a, b, _version_start(start, a), month) for s, a, b, start, month in VERSIONS]
    config = spark.createDataFrame(rows, "risk_st int, valid_from date, valid_to date, start_dt date, start_month string")
    out = L.cohort_extract(S.auto_policy(spark, d), config, S.AS_OF, config_rows=len(rows), valid=("valid_from", "valid_to"))
    return out.select(*_W09_COLS)


# ----------------------------------------------------------------------------- W10
_W10_COLS = ["pol_id", "earned_month", "risk_st", "latest_pol_eff_dt", "pol_type", "clean_dirty_cd",
             "derived_ttl_cnt", "derived_yes_no_flag", *L.LOSS_MEASURES, "ee"]


_DEC = {"incur_loss", "glass_tow_loss", "ep", "epapr", "ee"}


@register(
    "w10_loss_rollup",
    _uw_sql(
        "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _DEC else c for c in _W10_COLS) + " FROM rollup",
        upto="rollup",
    ),
)
def w10_loss_rollup(spark, d):
    return finalize(uw_rollup(spark, d).select(*_W10_COLS))


# ----------------------------------------------------------------------------- W11
@register(
    "w11_reclassify",
    _uw_sql(f"SELECT pol_id, earned_month, clean_dirty_cd, derived_yes_no_flag, {SEGMENT_SQL} AS segment FROM fixed"),
)
def w11_reclassify(spark, d):
    return uw_fixed(spark, d).select(
        "pol_id", "earned_month", "clean_dirty_cd", "derived_yes_no_flag", L.segment_label().alias("segment")
    )


# ----------------------------------------------------------------------------- W12
W12_SQL = _uw_sql(
    """SELECT segment, earned_month,
       CAST(SUM(_loss) OVER w AS DOUBLE) AS cum_loss,
       CAST(SUM(_prem) OVER w AS DOUBLE) AS cum_epapr,
       ROUND(CAST(SUM(_loss) OVER w AS DOUBLE) / NULLIF(CAST(SUM(_prem) OVER w AS DOUBLE), 0), 6) AS cum_loss_ratio,
       sign(CAST(SUM(_ee) OVER w AS DOUBLE)) * floor(abs(CAST(SUM(_ee) OVER w AS DOUBLE)) * CAST(1000000 AS DOUBLE) + 0.5) / CAST(1000000 AS DOUBLE) AS cum_ee,
       pol_cnt
FROM seg
WINDOW w AS (PARTITION BY segment ORDER BY earned_month RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    more=[
        f"""seg AS (
  SELECT {SEGMENT_SQL} AS segment, earned_month,
         SUM(incur_loss) AS _loss, SUM(epapr) AS _prem, SUM(ee) AS _ee, COUNT(DISTINCT pol_id) AS pol_cnt
  FROM fixed GROUP BY 1, 2
)"""
    ],
)


@register("w12_running_ratio", W12_SQL)
def w12_running_ratio(spark, d):
    return L.running_ratio(uw_fixed(spark, d))


# ----------------------------------------------------------------------------- W13
def _w13_sql(business_type: str) -> str:
    pick = (lambda c: c) if business_type == "Both" else (lambda c: f"CASE WHEN pol_type = '{business_type}' THEN {c} END")
    return _uw_sql(
        """SELECT risk_st, segment, ROUND(seg_lr, 6) AS segment_lr, ROUND(par_lr, 6) AS parent_lr,
       ROUND(seg_lr / NULLIF(par_lr, 0), 4) AS lrr
FROM lr""",
        more=[
            f"""seg AS (
  SELECT risk_st, {SEGMENT_SQL} AS segment, SUM({pick('incur_loss')}) AS _l, SUM({pick('epapr')}) AS _p
  FROM fixed GROUP BY 1, 2
)""",
            """lr AS (
  SELECT risk_st, segment,
         CAST(_l AS DOUBLE) / NULLIF(CAST(_p AS DOUBLE), 0) AS seg_lr,
         CAST(SUM(_l) OVER (PARTITION BY risk_st) AS DOUBLE) / NULLIF(CAST(SUM(_p) OVER (PARTITION BY risk_st) AS DOUBLE), 0) AS par_lr
  FROM seg
)""",
        ],
    )


def _w13(business_type):
    def q(spark, d):
        df = uw_fixed(spark, d).withColumn("segment", L.segment_label())
        return L.relativity(df, ["risk_st", "segment"], ["risk_st"], business_type=business_type)

    return q


register("w13_relativity_both", _w13_sql("Both"))(_w13("Both"))
register("w13_relativity_renewal", _w13_sql("Renewal"))(_w13("Renewal"))
register("w13_relativity_nb", _w13_sql("NB"))(_w13("NB"))


# ----------------------------------------------------------------------------- W14
@register(
    "w14_share_of_total",
    _uw_sql(
        """SELECT segment, pol_type, CAST(_m AS DOUBLE) AS segment_total,
       ROUND(CAST(_m AS DOUBLE) / NULLIF(CAST(SUM(_m) OVER () AS DOUBLE), 0), 6) AS share
FROM seg""",
        more=[f"seg AS (SELECT {SEGMENT_SQL} AS segment, pol_type, SUM(epapr) AS _m FROM fixed GROUP BY 1, 2)"],
    ),
)
def w14_share_of_total(spark, d):
    df = uw_fixed(spark, d).withColumn("segment", L.segment_label())
    return L.share_of_total(df, ["segment", "pol_type"], "epapr")


@register(
    "w14_share_of_total_renewal",
    _uw_sql(
        """SELECT segment, CAST(_m AS DOUBLE) AS segment_total,
       ROUND(CAST(_m AS DOUBLE) / NULLIF(CAST(SUM(_m) OVER () AS DOUBLE), 0), 6) AS share
FROM seg""",
        more=[f"seg AS (SELECT {SEGMENT_SQL} AS segment, SUM(CASE WHEN pol_type = 'Renewal' THEN epapr END) AS _m "
              "FROM fixed GROUP BY 1)"],
    ),
)
def w14_share_of_total_renewal(spark, d):
    """The dashboard's business-type switch set to 'Renewal' (EPAPR pulse check)."""
    df = uw_fixed(spark, d).withColumn("segment", L.segment_label())
    return L.share_of_total(df, ["segment"], "epapr", business_type="Renewal")


# ----------------------------------------------------------------------------- W15
W15_MIN_EFF = "1998-01-01"


@register(
    "w15_segment_loss_ratio",
    S.with_ctes(
        ["term", "loss"],
        """SELECT acct_cr_ind, rate_plan_cd, CAST(_ee AS DOUBLE) AS earned_exposure,
       ROUND(CAST(_ult AS DOUBLE) / NULLIF(CAST(_ep AS DOUBLE), 0), 4) AS ult_loss_ratio,
       ROUND(CAST(_inc AS DOUBLE) / NULLIF(CAST(_ep AS DOUBLE), 0), 4) AS incur_loss_ratio,
       ROUND(CAST(_ee AS DOUBLE) / CAST(SUM(_ee) OVER () AS DOUBLE) * 100.0, 2) AS ee_pct,
       printf('%.1f', sign(CAST(_ee AS DOUBLE) / CAST(SUM(_ee) OVER () AS DOUBLE) * 100.0)
              * floor(abs(CAST(_ee AS DOUBLE) / CAST(SUM(_ee) OVER () AS DOUBLE) * 100.0) * CAST(10 AS DOUBLE) + 0.5)
              / CAST(10 AS DOUBLE)) || '%' AS ee_pct_text
FROM seg""",
        [f"""chars AS (SELECT pol_id, pol_prd_id, acct_cr_ind, rate_plan_cd FROM term WHERE pol_eff_dt >= DATE '{W15_MIN_EFF}')""",
         """ru AS (
  SELECT pol_id, pol_prd_id, SUM(ee) AS ee, SUM(incur_loss) AS incur_loss, SUM(ult_loss) AS ult_loss, SUM(ep) AS ep
  FROM loss WHERE newco_ind = 'N' GROUP BY pol_id, pol_prd_id
)""",
         """seg AS (
  SELECT acct_cr_ind, rate_plan_cd, SUM(ee) AS _ee, SUM(ult_loss) AS _ult, SUM(incur_loss) AS _inc, SUM(ep) AS _ep
  FROM chars JOIN ru USING (pol_id, pol_prd_id) GROUP BY acct_cr_ind, rate_plan_cd
)""",
        ],
    ),
)
def w15_segment_loss_ratio(spark, d):
    chars = S.term(spark, d).filter(F.col("pol_eff_dt") >= F.lit(W15_MIN_EFF).cast("date")).select(
        "pol_id", "pol_prd_id", "acct_cr_ind", "rate_plan_cd"
    )
    lts = S.loss(spark, d).filter(F.col("newco_ind") == "N")
    return L.segment_loss_ratio(chars, lts, ["acct_cr_ind", "rate_plan_cd"])
