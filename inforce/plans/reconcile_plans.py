"""Registered allocation / reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from inforce.functions.columns import round_half_up
from inforce.operators import reconcile as R
from inforce.operators import selection as SEL
from inforce.operators import snapshots as SN
from inforce.plans.registry import finalize, register
from inforce.sources import staging as S
from inforce.sources.tables import read_table

A = S.AS_OF_SQL


def rhu(x: str, d: int = 4) -> str:
    """SQL twin of ``round_half_up``."""
    sc = f"CAST({10 ** d} AS DOUBLE)"
    return f"(sign(CAST({x} AS DOUBLE)) * floor(abs(CAST({x} AS DOUBLE)) * {sc} + 0.5) / {sc})"

# Fixed values for the emulated model table: base prediction per coverage; only
# the three coverages present in the loss data carry exposure.
# (bases and the exposure divisor avoid short decimals, so allocated values do
# not land on exact rounding halves, where engines round differently)
MODEL_BASE = {"bi": 120.537, "coll": 210.2913, "comp": 80.7641, "mp": 15.5127, "pd": 95.0339, "pip": 40.2587, "um": 30.5471}
MODEL_ACTIVE = {"bi", "coll", "mp"}
LOSS_COV = {"A": "BI", "N": "COLL", "R": "MED"}


def ulm_loss(spark, d, partitions=None):
    lo = S.loss(spark, d, partitions)
    cov = F.when(F.col("cov_type_abbr") == "A", "BI").when(F.col("cov_type_abbr") == "N", "COLL").otherwise("MED")
    return lo.select("pol_id", "pol_prd_id", cov.alias("cov_type_abbr"), "earned_month", "ee")


ULM_LOSS_SQL = """ulm_loss AS (
  SELECT pol_id, pol_prd_id,
         CASE WHEN cov_type_abbr = 'A' THEN 'BI' WHEN cov_type_abbr = 'N' THEN 'COLL' ELSE 'MED' END AS cov_type_abbr,
         earned_month, ee
  FROM loss
)"""


def model_period(spark, d):
    """Model predictions per policy period."""
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    cols = [k.alias("cv_plcy_period_id")]
    for c, base in MODEL_BASE.items():
        cols.append((F.lit(base) * (k % 7 + 1).cast("double")).alias(f"adj_{c}_pp_pred"))
        expo = ((k % 4 + 1).cast("double") / 7.0) if c in MODEL_ACTIVE else F.lit(0.0)
        cols.append(expo.alias(f"{c}_exposure"))
    return o.select(*cols)


def model_period_sql() -> str:
    cols = ["o_orderkey AS cv_plcy_period_id"]
    for c, base in MODEL_BASE.items():
        cols.append(f"CAST({base!r} AS DOUBLE) * CAST(o_orderkey % 7 + 1 AS DOUBLE) AS adj_{c}_pp_pred")
        expo = "CAST(o_orderkey % 4 + 1 AS DOUBLE) / 7.0" if c in MODEL_ACTIVE else "CAST(0.0 AS DOUBLE)"
        cols.append(f"{expo} AS {c}_exposure")
    return "model_period AS (SELECT " + ", ".join(cols) + " FROM orders)"


def _alloc_sql(digits: int | None = None, name: str = "alloc") -> str:
    """Exposure per (policy, period, coverage) as a grouped table, joined to its rows."""
    adj = []
    for code, c in R.COVERAGE_MAP.items():
        v = f"CASE WHEN cov_type_abbr = '{code}' THEN ee_percent * adj_{c}_pp_pred * {c}_exposure ELSE 0.0 END"
        adj.append((v if digits is None else rhu(v, digits)) + f" AS adj_{c}_pp")
    ttl = " + ".join(f"adj_{c}_pp" if digits is None else f"COALESCE(adj_{c}_pp, 0.0)" for c in R.MODEL_COVERAGES)
    return f"""{name}_shares AS (
  SELECT l.*, m.*, g.ttl_cov_ee, CAST(l.ee AS DOUBLE) / NULLIF(CAST(g.ttl_cov_ee AS DOUBLE), 0) AS ee_percent
  FROM ulm_loss l
  JOIN (SELECT pol_id, pol_prd_id, cov_type_abbr, SUM(ee) AS ttl_cov_ee FROM ulm_loss GROUP BY ALL) g
    ON (l.pol_id, l.pol_prd_id, l.cov_type_abbr) IS NOT DISTINCT FROM (g.pol_id, g.pol_prd_id, g.cov_type_abbr)
  JOIN model_period m ON l.pol_prd_id = m.cv_plcy_period_id
),
{name}_parts AS (SELECT *, {", ".join(adj)} FROM {name}_shares),
{name} AS (SELECT *, {ttl} AS adj_ttl_pp FROM {name}_parts)"""


def _sql(body, extra):
    return S.with_ctes(["loss"], body, extra)


def alloc(spark, d, digits=None, partitions=None):
    """The allocation; every sort and aggregation by period keeps the loss rows' tasks."""
    partitions = S.loss_partitions(spark, d) if partitions is None else partitions
    return R.allocate_prediction(ulm_loss(spark, d, partitions), model_period(spark, d), digits=digits)


_ADJ = [f"adj_{c}_pp" for c in R.MODEL_COVERAGES] + ["adj_ttl_pp"]
_W16_COLS = ["pol_id", "pol_prd_id", "cov_type_abbr", "earned_month", "ee", "ttl_cov_ee", "ee_percent", *_ADJ]
_W16_SQL = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in ("ee", "ttl_cov_ee") else c for c in _W16_COLS)


@register(
    "w16_allocate_prediction",
    _sql(
        f"SELECT {_W16_SQL} FROM alloc",
        [ULM_LOSS_SQL, model_period_sql(), _alloc_sql()],
    ),
)
def w16_allocate_prediction(spark, d):
    return finalize(alloc(spark, d).select(*_W16_COLS))


@register("w16_allocation_rounded", _sql(f"SELECT {_W16_SQL} FROM alloc", [ULM_LOSS_SQL, model_period_sql(), _alloc_sql(4)]))
def w16_allocation_rounded(spark, d):
    return finalize(alloc(spark, d, 4).select(*_W16_COLS))


def _exact(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(28,10))) AS DOUBLE)"


def _check_sql(within: bool) -> str:
    ops = ", ".join(f"{_exact(f'adj_{c}_pp')} AS {c}_op" for c in R.MODEL_COVERAGES)
    ulm = ", ".join(f"adj_{c}_pp_pred * {c}_exposure AS {c}_ulm" for c in R.MODEL_COVERAGES)
    ttl = " + ".join(f"{c}_ulm" for c in R.MODEL_COVERAGES)
    cond = " AND ".join(f"ABS({c}_op - {c}_ulm) <= 0.02" for c in R.MODEL_COVERAGES)
    outs = ", ".join(f"{rhu(c + '_op')} AS {c}_op, {rhu(c + '_ulm')} AS {c}_ulm" for c in [*R.MODEL_COVERAGES, "ttl"])
    return _sql(
        f"""SELECT pol_prd_id, {outs}
FROM (SELECT CAST(pol_prd_id AS VARCHAR) AS pol_prd_id, {ops}, {_exact('adj_ttl_pp')} AS ttl_op FROM alloc GROUP BY 1) op
JOIN (SELECT *, {ttl} AS ttl_ulm FROM (SELECT CAST(cv_plcy_period_id AS VARCHAR) AS pol_prd_id, {ulm} FROM model_period)) mu
USING (pol_prd_id)
WHERE {'' if within else 'NOT '}({cond})""",
        [ULM_LOSS_SQL, model_period_sql(), _alloc_sql()],
    )


register("w17_allocation_check", _check_sql(True))(
    lambda spark, d: R.allocation_check(alloc(spark, d), model_period(spark, d), 0.02, within=True)
)
register("w17_allocation_mismatch", _check_sql(False))(
    lambda spark, d: R.allocation_check(alloc(spark, d), model_period(spark, d), 0.02, within=False)
)


# ----------------------------------------------------------------------------- W18
_KEYS = ["pol_id", "pol_prd_id", "cov_type_abbr", "earned_month"]


@register(
    "w18_update_from",
    _sql(
        "SELECT t.pol_id, t.pol_prd_id, t.cov_type_abbr, t.earned_month, CAST(t.ee AS DOUBLE) AS ee, "
        + ", ".join(f"{rhu(f'COALESCE(s.{c} * t.part, 0.0)')} AS {c}" for c in _ADJ)
        + """
FROM (
  SELECT l.*, CASE WHEN COALESCE(k.ee_of_key, 0) = 0 THEN CAST(1.0 AS DOUBLE) / k.rows_of_key
                   ELSE COALESCE(CAST(l.ee AS DOUBLE), 0.0) / CAST(k.ee_of_key AS DOUBLE) END AS part
  FROM ulm_loss l JOIN (
    SELECT pol_id, pol_prd_id, cov_type_abbr, earned_month, SUM(ee) AS ee_of_key, COUNT(*) AS rows_of_key FROM ulm_loss GROUP BY ALL
  ) k ON (l.pol_id, l.pol_prd_id, l.cov_type_abbr, l.earned_month) IS NOT DISTINCT FROM (k.pol_id, k.pol_prd_id, k.cov_type_abbr, k.earned_month)
) t LEFT JOIN (
  SELECT pol_id, pol_prd_id, cov_type_abbr, earned_month, """
        + ", ".join(f"{_exact(c)} AS {c}" for c in _ADJ)
        + """
  FROM alloc GROUP BY ALL
) s ON t.pol_id = s.pol_id AND t.pol_prd_id IS NOT DISTINCT FROM s.pol_prd_id
   AND t.cov_type_abbr = s.cov_type_abbr AND t.earned_month = s.earned_month""",
        [ULM_LOSS_SQL, model_period_sql(), _alloc_sql()],
    ),
)
def w18_update_from(spark, d):
    n = S.loss_partitions(spark, d)
    target, source = ulm_loss(spark, d, n), alloc(spark, d, partitions=n)
    upd = R.update_from(target, source, _KEYS, {c: 0.0 for c in _ADJ}, null_safe=["pol_prd_id"], share="ee", partitions=n)
    return finalize(upd.select(*_KEYS, "ee", *[round_half_up(c, 4).alias(c) for c in _ADJ]))


# ----------------------------------------------------------------------------- W19
DEV_FILTER = "NOT (cov_type_abbr = 'R' AND glass_tow_cnt = 1)"


def _dev(lo):
    return lo.filter(~((F.col("cov_type_abbr") == "R") & (F.col("glass_tow_cnt") == 1)))


def _w19_sql(grain: str, ml: str, mr: str) -> str:
    if grain == "all":
        keys, sel, join = "", "", "FROM a CROSS JOIN b"
    elif grain == "year":
        keys = "CAST(year(earned_month_dt) AS INTEGER) AS year_earned"
        sel, join = "a.year_earned, ", "FROM a JOIN b ON a.year_earned = b.year_earned"
    else:
        keys = "CAST(year(earned_month_dt) AS INTEGER) AS year_earned, CAST(month(earned_month_dt) AS INTEGER) AS month_earned"
        sel = "a.year_earned, a.month_earned, "
        join = "FROM a JOIN b ON a.year_earned = b.year_earned AND a.month_earned = b.month_earned"
    gb = "" if grain == "all" else (" GROUP BY 1" if grain == "year" else " GROUP BY 1, 2")
    k = (keys + ", ") if keys else ""
    pct = ("ROUND(CASE WHEN CAST(a.left_total AS DOUBLE) = 0 THEN NULL ELSE (CAST(b.right_total AS DOUBLE) - "
           "CAST(a.left_total AS DOUBLE)) / CAST(a.left_total AS DOUBLE) * 100.0 END, 2)")
    nz_pct = f"CASE WHEN {pct} = 0 THEN 0.0 ELSE {pct} END"
    return S.with_ctes(
        ["loss"],
        f"""SELECT {sel}CAST(a.left_total AS DOUBLE) AS left_total, CAST(b.right_total AS DOUBLE) AS right_total,
       {nz_pct} AS pct_diff
{join}""",
        [
            f"a AS (SELECT {k}ROUND(SUM({ml}), 2) AS left_total FROM loss{gb})",
            f"b AS (SELECT {k}ROUND(SUM({mr}), 2) AS right_total FROM loss WHERE {DEV_FILTER}{gb})",
        ],
    )


def _w19(grain, ml, mr):
    def q(spark, d):
        lo = S.loss(spark, d)
        keys = []
        names = []
        if grain in ("year", "month"):
            keys.append(F.year("earned_month_dt"))
            names.append("year_earned")
        if grain == "month":
            keys.append(F.month("earned_month_dt"))
            names.append("month_earned")
        out = R.reconcile_metric(lo, _dev(lo), ml, mr, keys)
        for i, n in enumerate(names):
            out = out.withColumnRenamed(f"_g{i}", n)
        return out

    return q


register("w19_reconcile_all", _w19_sql("all", "ep", "epapr"))(_w19("all", "ep", "epapr"))
register("w19_reconcile_year", _w19_sql("year", "ep", "ep"))(_w19("year", "ep", "ep"))
register("w19_reconcile_month", _w19_sql("month", "ult_loss", "ult_loss"))(_w19("month", "ult_loss", "ult_loss"))
# the other metric x grain pairs
for _name, _grain, _left, _right in [
    ("ep_epapr", "year", "ep", "epapr"), ("ep_epapr", "month", "ep", "epapr"), ("ep", "all", "ep", "ep"), ("ep", "month", "ep", "ep"),
    ("ult_loss", "all", "ult_loss", "ult_loss"), ("ult_loss", "year", "ult_loss", "ult_loss"),
]:
    register(f"w19_reconcile_{_name}_{_grain}", _w19_sql(_grain, _left, _right))(_w19(_grain, _left, _right))


# every metric and grain in one long table
_PAIRS = {"ep_epapr": ("ep", "epapr"), "ep": ("ep", "ep"), "ult_loss": ("ult_loss", "ult_loss")}


def _long_sql() -> str:
    parts = []
    for grain, keys in (("all", ()), ("year", ("y",)), ("month", ("y", "m"))):
        on = " AND ".join(f"a.{k} = b.{k}" for k in keys) or "TRUE"
        for metric in _PAIRS:
            total = lambda side: f"CAST({side}.{metric} AS DOUBLE)"  # noqa: E731, B023
            parts.append(
                f"SELECT '{metric}' AS metric, '{grain}' AS grain, {'a.y' if 'y' in keys else 'NULL'} AS year_earned, {'a.m' if 'm' in keys else 'NULL'} AS month_earned, "
                f"{total('a')} AS left_total, {total('b')} AS right_total FROM a_{grain} a JOIN b_{grain} b ON {on}"
            )
    ctes = []
    for side, where, which in (("a", "", 0), ("b", f" WHERE {DEV_FILTER}", 1)):
        sums = ", ".join(f"ROUND(SUM({p[which]}), 2) AS {m}" for m, p in _PAIRS.items())
        for grain, keys, by in (("all", "", ""), ("year", "year(earned_month_dt) AS y, ", " GROUP BY 1"), ("month", "year(earned_month_dt) AS y, month(earned_month_dt) AS m, ", " GROUP BY 1, 2")):
            ctes.append(f"{side}_{grain} AS (SELECT {keys}{sums} FROM loss{where}{by})")
    return S.with_ctes(
        ["loss"],
        "SELECT metric, grain, CAST(year_earned AS DOUBLE) AS year_earned, CAST(month_earned AS DOUBLE) AS month_earned, left_total, right_total, "
        "ROUND((right_total - left_total) / NULLIF(left_total, 0) * 100.0, 2) + 0.0 AS pct_diff FROM (" + " UNION ALL ".join(parts) + ")",
        ctes,
    )


@register("w19_reconcile_long", _long_sql())
def w19_reconcile_long(spark, d):
    """All nine metric and grain pairs from one scan of each side."""
    lo = S.loss(spark, d)
    out = R.reconcile_all(lo, _dev(lo), _PAIRS, "earned_month_dt")
    return out.withColumns({c: F.col(c).cast("double") for c in ("year_earned", "month_earned")})


# ----------------------------------------------------------------------------- W20
INFORCE_AT_AS_OF = f"pol_eff_dt <= {A} AND pol_exp_dt > {A} AND (canc_eff_dt IS NULL OR canc_eff_dt > {A})"


@register(
    "w20_snapshot_vs_history",
    S.with_ctes(
        ["term"],
        """SELECT rate_plan_cd, mif_cnt, per_cnt,
       ROUND(CASE WHEN CAST(mif_cnt AS DOUBLE) + CAST(per_cnt AS DOUBLE) = 0 THEN NULL
                  ELSE ABS(CAST(mif_cnt AS DOUBLE) - CAST(per_cnt AS DOUBLE)) / ((CAST(mif_cnt AS DOUBLE) + CAST(per_cnt AS DOUBLE)) / 2.0) * 100.0 END, 2) AS pct_diff,
       ABS(mif_cnt - per_cnt) AS diff_cnt
FROM (
  SELECT rate_plan_cd, COUNT(DISTINCT policy_id) AS mif_cnt FROM inforce_monthend
  WHERE me_dt = (SELECT MAX(me_dt) FROM inforce_monthend) AND pol_status_cd = 'InForce' GROUP BY rate_plan_cd
) m JOIN (
  SELECT rate_plan_cd, COUNT(DISTINCT pol_id) AS per_cnt FROM (
    SELECT *, row_number() OVER (PARTITION BY pol_id ORDER BY pol_eff_dt DESC NULLS FIRST, pol_prd_id DESC NULLS FIRST) AS rn
    FROM term WHERE pol_eff_dt <= """ + A + """
  ) WHERE rn = 1 AND """ + INFORCE_AT_AS_OF + """ GROUP BY rate_plan_cd
) p USING (rate_plan_cd)""",
        [S.inforce_monthend_sql()],
    ),
)
def w20_snapshot_vs_history(spark, d):
    return against_history(spark, d, last_snapshot(spark, d), S.last_month_end(spark, d))


def last_snapshot(spark, d):
    """The snapshot of the last month end, from the terms in force then; no other
    month is built."""
    return SN.month_snapshot(S.term(spark, d), S.last_month_end(spark, d).scalar())


def against_history(spark, d, snap, latest=None):
    """A snapshot table's latest month against the history's latest rows."""
    t = S.term(spark, d).filter(F.col("pol_eff_dt") <= F.lit(S.AS_OF))
    history = SEL.latest_by_key(t, ["pol_id"], ["pol_eff_dt"], ["pol_prd_id"])
    a = F.lit(S.AS_OF)
    inforce = history.filter(
        (F.col("pol_eff_dt") <= a) & (F.col("pol_exp_dt") > a) & (F.col("canc_eff_dt").isNull() | (F.col("canc_eff_dt") > a))
    )
    return R.snapshot_vs_history_counts(snap, inforce, snapshot_filter=F.col("pol_status_cd") == "InForce", latest=latest)


# ----------------------------------------------------------------------------- W16 sample (ORDER BY ... LIMIT)
SAMPLE_N = 500
_SAMPLE_ORDER = ["pol_id", "pol_prd_id", "cov_type_abbr", "earned_month", "ee", "adj_ttl_pp"]


@register(
    "w16_allocation_sample",
    _sql(
        f"SELECT {_W16_SQL} FROM alloc ORDER BY {', '.join(_SAMPLE_ORDER)} LIMIT {SAMPLE_N}",
        [ULM_LOSS_SQL, model_period_sql(), _alloc_sql()],
    ),
)
def w16_allocation_sample(spark, d):
    """The first rows of the allocation in key order, for inspection (the limit is the feature)."""
    from inforce.operators.maintenance import top_rows

    return top_rows(finalize(alloc(spark, d).select(*_W16_COLS)), SAMPLE_N, _SAMPLE_ORDER)
