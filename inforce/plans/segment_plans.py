"""Registered segmentation queries (W21-W23) on an emulated score mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from inforce.functions.bands import band_expr, band_sql
from inforce.operators import segment as G
from inforce.operators import selection as SEL
from inforce.plans.registry import register
from inforce.session import written
from inforce.sources import staging as S
from inforce.sources.tables import read_table

A = S.AS_OF_SQL

# ----------------------------------------------------------------------------- fixed values
# Age bands (interval rules, first match wins).
AGE_BANDS = [
    {"label": "<50", "hi": 50},
    {"label": "50-59", "lo": 50, "hi": 60},
    {"label": "60-69", "lo": 60, "hi": 70},
    {"label": "70-79", "lo": 70, "hi": 80},
    {"label": "80+", "lo": 80},
]
# Insurance-score decile cut points (upper bounds, inclusive) from Decile 10 up to Decile 02;
# 0 and >= 998 mean no hit / no score.
DECILE_CUTS = [504, 603, 670, 714, 744, 766, 785, 804, 825]
HOME_DECILE_CUTS = [557, 654, 705, 735, 757, 776, 793, 810, 832]
ROOF_CONDITIONS = ["-2", "-1", "0", "1", "2", "not_available", "unknown"]
QUINTILE_OF_DECILE = {
    "Decile 01": "Quintile 1", "Decile 02": "Quintile 1", "Decile 03": "Quintile 2", "Decile 04": "Quintile 2",
    "Decile 05": "Quintile 3", "Decile 06": "Quintile 3", "Decile 07": "Quintile 4", "Decile 08": "Quintile 4",
    "Decile 09": "Quintile 5", "Decile 10": "Quintile 5", "NH/NS": "NH/NS",
}
HH_COMPOSITION = {
    "AUTOMOBILE": "1 Car, 1 Driver",
    "BUILDING": "1 Car, 2+ Drivers",
    "FURNITURE": "Multi Car, Cars = Drivers",
    "HOUSEHOLD": "Multi Car, Cars > Drivers",
    "MACHINERY": "Multi Car, Cars < Drivers",
}
TELEMATICS_ACTIVE = ["Full Participation", "Partial Participation", "Enrollment Window"]
TELEMATICS_INACTIVE = ["Issued but Never Activated", "Activated with Score but Unenrolled"]
# Coverage-limit groups x square-footage groups (2-D band); default 'no_coverage'.
LIMIT_GROUPS = [(None, 300000, "<$300k"), (300000, 450000, "$300k-$449k"), (450000, 650000, "$450k-$649k"),
                (650000, None, "$650k+")]
SQFT_GROUPS = [(0, 1500, "0-1500"), (1501, 2000, "1501-2000"), (2001, 2500, "2001-2500"), (2500, None, "2501+")]


def decile_rules(cuts: list[int] = DECILE_CUTS) -> list[dict]:
    rules = [{"label": "NH/NS", "eq": 0}, {"label": "NH/NS", "lo": 998}]
    lo = 0
    for i, hi in enumerate(cuts):
        rules.append({"label": f"Decile {10 - i:02d}", "lo": lo, "lo_incl": False, "hi": hi, "hi_incl": True})
        lo = hi
    rules.append({"label": "Decile 01", "lo": lo, "lo_incl": False, "hi": 998})
    return rules


def ubi_rules() -> list[dict]:
    rules = [{"label": "1-9", "lo": 1, "hi": 10}]
    rules += [{"label": f"{n}-{n + 9}", "lo": n, "hi": n + 10} for n in range(10, 90, 10)]
    return rules + [{"label": "90+", "lo": 90}]


def dwelling_age_rules() -> list[dict]:
    edges = [(0, 5), (6, 10), (11, 15), (16, 20), (21, 25), (26, 30), (31, 35), (36, 40), (41, 50), (51, 60),
             (61, 70), (71, 80), (81, 90), (91, 100)]
    rules = [{"label": f"{a}-{b}", "lo": a, "hi": b, "hi_incl": True} for a, b in edges]
    return rules + [{"label": "100+", "lo": 100, "lo_incl": False}]


def coverage_sqft_rules(limit_col: str = "dwelling_lmt_num") -> list[dict]:
    rules = []
    for llo, lhi, llab in LIMIT_GROUPS:
        lim = {}
        if llo is not None:
            lim["lo"] = llo
        if lhi is not None:
            lim["hi"] = lhi
        for slo, shi, slab in SQFT_GROUPS:
            r = {"label": f"{llab} and sqft {slab}", "and_": [(limit_col, lim)]}
            if shi is None:
                r.update({"lo": slo, "lo_incl": False})
            else:
                r.update({"lo": slo, "hi": shi, "hi_incl": True})
            rules.append(r)
    return rules


def band_rules():
    """out column -> (input column, rules, default)."""
    return {
        "pni_age_grp": ("pni_age", AGE_BANDS, None),
        "cv_decile": ("ins_scr_cd", decile_rules(), None),
        "ubi_score_grp": ("ubi_score", ubi_rules(), None),
        "dwell_age_grp": ("dwell_age_num", dwelling_age_rules(), None),
        "cov_a_sq_ft": ("sqft_num", coverage_sqft_rules(), "no_coverage"),
    }


# ----------------------------------------------------------------------------- score mart fixture
def scoremart(spark, d):
    """One quote row per policy: customer attributes + the policy's latest term up to AS_OF."""
    c = read_table(spark, d, "customer")
    t = S.term(spark, d).filter(F.col("pol_eff_dt") <= F.lit(S.AS_OF))
    latest = SEL.latest_by_key(t, ["pol_id"], ["pol_eff_dt"], ["pol_prd_id"]).select("pol_id", "pol_eff_dt")
    k = F.col("c_custkey")
    base = c.select(
        k.alias("qcn"),
        k.cast("string").alias("pol_id"),
        F.col("c_nationkey").alias("state"),
        ((F.col("c_acctbal") + 1000.0) / 5000.0).cast("decimal(18,6)").alias("expected_loss_ratio"),
        ((F.col("c_acctbal") + 1500.0) / 6000.0).cast("decimal(18,6)").alias("ol_expected_loss_ratio"),
        (F.lit(20) + (k * 7) % 70).cast("int").alias("pni_age"),
        ((k * 7919) % 1001).cast("int").alias("ins_scr_cd"),
        ((k * 13) % 100).cast("int").alias("ubi_score"),
        F.when(k % 6 < 3, F.element_at(F.array(*[F.lit(x) for x in TELEMATICS_ACTIVE]), (k % 6 + 1).cast("int")))
        .when(k % 6 < 5, F.element_at(F.array(*[F.lit(x) for x in TELEMATICS_INACTIVE]), (k % 6 - 2).cast("int")))
        .alias("tlmtc_pol_bucket_cd"),
        F.col("c_mktsegment").alias("hh_composition"),
        F.when(k % 4 == 0, F.lit("H")).when(k % 4 == 1, F.lit("None")).otherwise(F.lit("C")).alias("account_credit"),
        F.when(k % 11 == 0, F.lit("None")).otherwise(((k * 7919) % 900 * 1000 + 100000).cast("string")).alias("dwelling_lmt"),
        F.when(k % 13 == 0, F.lit("None")).otherwise((500 + (k * 31) % 3000).cast("string")).alias("sqft"),
        F.when(k % 17 == 0, F.lit("None")).otherwise(((k * 17) % 120).cast("string")).alias("dwell_age"),
        F.when(k % 5 == 0, F.lit(None).cast("int")).otherwise(F.lit(1)).alias("compl_qte_ind"),
    )
    return base.join(latest, "pol_id", "inner")


def _tl_sql() -> str:
    act = ", ".join(f"'{x}'" for x in TELEMATICS_ACTIVE)
    ina = ", ".join(f"'{x}'" for x in TELEMATICS_INACTIVE)
    return (
        f"CASE WHEN c_custkey % 6 < 3 THEN list_extract([{act}], CAST(c_custkey % 6 + 1 AS INTEGER)) "
        f"WHEN c_custkey % 6 < 5 THEN list_extract([{ina}], CAST(c_custkey % 6 - 2 AS INTEGER)) END"
    )


SCOREMART_SQL = f"""scoremart AS (
  SELECT c.c_custkey AS qcn, CAST(c.c_custkey AS VARCHAR) AS pol_id, c.c_nationkey AS state,
         CAST((c.c_acctbal + 1000.0) / 5000.0 AS DECIMAL(18,6)) AS expected_loss_ratio,
         CAST((c.c_acctbal + 1500.0) / 6000.0 AS DECIMAL(18,6)) AS ol_expected_loss_ratio,
         CAST(20 + (c.c_custkey * 7) % 70 AS INTEGER) AS pni_age,
         CAST((c.c_custkey * 7919) % 1001 AS INTEGER) AS ins_scr_cd,
         CAST((c.c_custkey * 13) % 100 AS INTEGER) AS ubi_score,
         {_tl_sql()} AS tlmtc_pol_bucket_cd,
         c.c_mktsegment AS hh_composition,
         CASE WHEN c.c_custkey % 4 = 0 THEN 'H' WHEN c.c_custkey % 4 = 1 THEN 'None' ELSE 'C' END AS account_credit,
         CASE WHEN c.c_custkey % 11 = 0 THEN 'None' ELSE CAST((c.c_custkey * 7919) % 900 * 1000 + 100000 AS VARCHAR) END AS dwelling_lmt,
         CASE WHEN c.c_custkey % 13 = 0 THEN 'None' ELSE CAST(500 + (c.c_custkey * 31) % 3000 AS VARCHAR) END AS sqft,
         CASE WHEN c.c_custkey % 17 = 0 THEN 'None' ELSE CAST((c.c_custkey * 17) % 120 AS VARCHAR) END AS dwell_age,
         CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE 1 END AS compl_qte_ind,
         l.pol_eff_dt
  FROM customer c JOIN (
    SELECT pol_id, pol_eff_dt FROM (
      SELECT *, row_number() OVER (PARTITION BY pol_id ORDER BY pol_eff_dt DESC NULLS FIRST, pol_prd_id DESC NULLS FIRST) AS rn
      FROM term WHERE pol_eff_dt <= {A}
    ) WHERE rn = 1
  ) l ON CAST(c.c_custkey AS VARCHAR) = l.pol_id
)"""


def _num_sql(col: str) -> str:
    return f"CASE WHEN {col} = 'None' THEN CAST(0 AS DOUBLE) ELSE CAST({col} AS DOUBLE) END"


REL_SQL = """rel AS (
  SELECT s.*,
         ROUND(m.m1, 6) AS elrr_mean,
         ROUND(CASE WHEN m.m1 = 0 THEN NULL ELSE CAST(s.expected_loss_ratio AS DOUBLE) / m.m1 END, 6) AS elrr,
         ROUND(m.m2, 6) AS ol_elrr_mean,
         ROUND(CASE WHEN m.m2 = 0 THEN NULL ELSE CAST(s.ol_expected_loss_ratio AS DOUBLE) / m.m2 END, 6) AS ol_elrr
  FROM scoremart s LEFT JOIN (
    SELECT state,
           CAST(SUM(expected_loss_ratio) AS DOUBLE) / CAST(COUNT(expected_loss_ratio) AS DOUBLE) AS m1,
           CAST(SUM(ol_expected_loss_ratio) AS DOUBLE) / CAST(COUNT(ol_expected_loss_ratio) AS DOUBLE) AS m2
    FROM scoremart WHERE state IS NOT NULL GROUP BY state
  ) m ON s.state = m.state
)"""


def rel(spark, d, store=False):
    # states: a fixed, small domain (nation keys), so the means are broadcast back;
    # stored, the score table is built once for its rows and for the means
    rows = scoremart(spark, d)
    return G.relativity_rows(
        written(rows, "scoremart") if store else rows, "state", {"expected_loss_ratio": "elrr", "ol_expected_loss_ratio": "ol_elrr"},
    )


def banded(spark, d, store=False):
    df = rel(spark, d, store).select(
        F.col("*"),
        G.numeric_from_text("dwelling_lmt").alias("dwelling_lmt_num"),
        G.numeric_from_text("sqft").alias("sqft_num"),
        G.numeric_from_text("dwell_age").alias("dwell_age_num"),
    )
    df = G.segment_bands(df, band_rules())
    tl = F.when(F.col("tlmtc_pol_bucket_cd").isin(TELEMATICS_ACTIVE), F.col("tlmtc_pol_bucket_cd")).when(
        F.col("tlmtc_pol_bucket_cd").isin(TELEMATICS_INACTIVE), F.lit("Issued but not active")
    ).otherwise(F.lit("Not Active"))
    return df.select(
        F.col("*"),
        G.category_map("cv_decile", QUINTILE_OF_DECILE).alias("cv_quintile"),
        tl.alias("tlmtc_bucket_cd"),
        G.category_map("hh_composition", HH_COMPOSITION).alias("hh_comp"),
        F.when(F.col("account_credit").isin("H", "None"), F.lit("No")).otherwise(F.lit("Yes")).alias("acct_credit"),
    )


def banded_sql_ctes() -> list[str]:
    rules = band_rules()
    bands = ", ".join(
        band_sql(src, rl, default=dflt) + f" AS {name}" for name, (src, rl, dflt) in rules.items()
    )
    quint = "CASE " + " ".join(f"WHEN cv_decile = '{k}' THEN '{v}'" for k, v in QUINTILE_OF_DECILE.items()) + " END"
    hh = "CASE " + " ".join(f"WHEN hh_composition = '{k}' THEN '{v}'" for k, v in HH_COMPOSITION.items()) + " END"
    act = ", ".join(f"'{x}'" for x in TELEMATICS_ACTIVE)
    ina = ", ".join(f"'{x}'" for x in TELEMATICS_INACTIVE)
    return [
        SCOREMART_SQL,
        REL_SQL,
        f"""nums AS (SELECT *, {_num_sql('dwelling_lmt')} AS dwelling_lmt_num, {_num_sql('sqft')} AS sqft_num,
                   {_num_sql('dwell_age')} AS dwell_age_num FROM rel)""",
        f"b1 AS (SELECT *, {bands} FROM nums)",
        f"""banded AS (SELECT *, {quint} AS cv_quintile,
       CASE WHEN tlmtc_pol_bucket_cd IN ({act}) THEN tlmtc_pol_bucket_cd
            WHEN tlmtc_pol_bucket_cd IN ({ina}) THEN 'Issued but not active' ELSE 'Not Active' END AS tlmtc_bucket_cd,
       {hh} AS hh_comp,
       CASE WHEN account_credit IN ('H', 'None') THEN 'No' ELSE 'Yes' END AS acct_credit
FROM b1)""",
    ]


def _sql(body, extra):
    return S.with_ctes(["term"], body, extra)


# ----------------------------------------------------------------------------- W22
_W22 = ["qcn", "state", "elrr_mean", "elrr", "ol_elrr_mean", "ol_elrr"]


@register("w22_relativity_rows", _sql(f"SELECT {', '.join(_W22)} FROM rel", [SCOREMART_SQL, REL_SQL]))
def w22_relativity_rows(spark, d):
    return rel(spark, d).select(*_W22)


# ----------------------------------------------------------------------------- W21
SEGMENTATIONS = ["pni_age_grp", "cv_decile", "cv_quintile", "ubi_score_grp", "dwell_age_grp", "cov_a_sq_ft",
                 "tlmtc_bucket_cd", "hh_comp", "acct_credit"]


@register("w21_segment_bands", _sql(f"SELECT qcn, {', '.join(SEGMENTATIONS)} FROM banded", banded_sql_ctes()))
def w21_segment_bands(spark, d):
    return banded(spark, d).select("qcn", *SEGMENTATIONS)


# ----------------------------------------------------------------------------- W23
W23_SQL = _sql(
    " UNION ALL ".join(
        f"SELECT '{b}' AS segmentation, CAST({b} AS VARCHAR) AS band, COUNT(compl_qte_ind) AS cnt, "
        f"sign(CAST(SUM(CAST(elrr AS DECIMAL(18,6))) AS DOUBLE) / CAST(COUNT(elrr) AS DOUBLE)) * floor(abs(CAST(SUM(CAST(elrr AS DECIMAL(18,6))) AS DOUBLE) / CAST(COUNT(elrr) AS DOUBLE)) * CAST(1000000 AS DOUBLE) + 0.5) / CAST(1000000 AS DOUBLE) AS lrr "
        f"FROM banded WHERE {b} IS NOT NULL GROUP BY {b}"
        for b in SEGMENTATIONS
    ),
    banded_sql_ctes(),
)


@register("w23_segment_summary", W23_SQL)
def w23_segment_summary(spark, d):
    return G.segment_summary(banded(spark, d, store=True), SEGMENTATIONS, "compl_qte_ind", "elrr")


# ----------------------------------------------------------------------------- W21 value counts
@register(
    "w21_band_value_counts",
    _sql(
        " UNION ALL ".join(
            f"SELECT '{b}' AS segmentation, CAST({b} AS VARCHAR) AS band, COUNT(*) AS cnt FROM banded "
            f"WHERE {b} IS NOT NULL GROUP BY {b}"
            for b in ("pni_age_grp", "cv_decile", "ubi_score_grp", "tlmtc_bucket_cd")
        ),
        banded_sql_ctes(),
    ),
)
def w21_band_value_counts(spark, d):
    """Rows per band of each banding (the notebooks' ``value_counts()`` checks), in one pass."""
    from inforce.operators.maintenance import value_counts

    b = banded(spark, d)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("segmentation"), F.col(c).cast("string").alias("band"))
        for c in ("pni_age_grp", "cv_decile", "ubi_score_grp", "tlmtc_bucket_cd")
    ])).alias("_p")
    long = b.select(pairs).select("_p.segmentation", "_p.band")
    return value_counts(long, "band", by=["segmentation"])


# ----------------------------------------------------------------------------- W21 (home line and the SQL variant of the bands)
def home_band_rules():
    """out column -> (input column, rules, default); a NULL age counts as the oldest."""
    return {
        "home_decile": ("ins_scr_cd", decile_rules(HOME_DECILE_CUTS), None),
        "ttl_bath_cnt": ("bath_num", [{"label": str(n), "eq": n} for n in range(1, 9)] + [{"label": "9+", "lo": 9}], None),
        "roof_cond": ("roof", [{"label": c, "eq": c} for c in ROOF_CONDITIONS], None),
        "ubi_grp": ("ubi_score", [{"label": "0-0.99", "lo": 0, "hi": 1}, *ubi_rules()], None),
        "age_grp": ("age", AGE_BANDS, "80+"),
    }


HOME_CHARS_SQL = f"""home_chars AS (
  SELECT c_custkey AS qcn, CAST(c_custkey * 37 % 1000 AS INTEGER) AS ins_scr_cd,
         CASE WHEN c_custkey % 11 = 0 THEN 0.0 ELSE CAST(c_custkey % 12 AS DOUBLE) END AS bath_num,
         {ROOF_CONDITIONS!r}[CAST(c_custkey % 8 + 1 AS INTEGER)] AS roof,
         CAST(c_custkey % 1000 AS DOUBLE) / 10.0 AS ubi_score,
         CASE WHEN c_custkey % 13 <> 0 THEN CAST(40 + c_custkey % 50 AS INTEGER) END AS age
  FROM customer
)"""


@register(
    "w21_home_bands",
    "WITH " + HOME_CHARS_SQL + " SELECT qcn, "
    + ", ".join(f"{band_sql(c, rules, default)} AS {out}" for out, (c, rules, default) in home_band_rules().items()) + " FROM home_chars",
)
def w21_home_bands(spark, d):
    """Bath counts come as text with 'None'; roof condition is a direct segment."""
    k = F.col("c_custkey")
    chars = read_table(spark, d, "customer").select(
        k.alias("qcn"), (k * 37 % 1000).cast("int").alias("ins_scr_cd"),
        F.when(k % 11 == 0, "None").otherwise((k % 12).cast("string")).alias("bath"),
        F.get(F.array(*[F.lit(c) for c in ROOF_CONDITIONS]), (k % 8).cast("int")).alias("roof"),
        ((k % 1000).cast("double") / 10.0).alias("ubi_score"), F.when(k % 13 != 0, (k % 50 + 40).cast("int")).alias("age"),
    ).withColumn("bath_num", G.numeric_from_text("bath"))
    return chars.select("qcn", *[band_expr(c, rules, default=default).alias(out) for out, (c, rules, default) in home_band_rules().items()])


# ----------------------------------------------------------------------------- W23 (home line's sheets)
HOME_SEGMENTATIONS = ["cv_decile", "cv_quintile", "cov_a_sq_ft", "dwell_age_grp", "ttl_bath_cnt", "roof_cond"]


@register(
    "w23_home_summary",
    _sql(
        " UNION ALL ".join(
            f"SELECT '{b}' AS segmentation, CAST({b} AS VARCHAR) AS band, COUNT(compl_qte_ind) AS cnt, SUM(CAST(elrr AS DECIMAL(18,6))) AS total, COUNT(elrr) AS n "
            f"FROM home_banded WHERE {b} IS NOT NULL GROUP BY {b}"
            for b in HOME_SEGMENTATIONS
        ),
        [
            *banded_sql_ctes(),
            HOME_CHARS_SQL,
            "home_bands AS (SELECT qcn, " + ", ".join(f"{band_sql(c, rules, default)} AS {out}" for out, (c, rules, default) in home_band_rules().items() if out in HOME_SEGMENTATIONS) + " FROM home_chars)",
            "home_banded AS (SELECT b.*, h.ttl_bath_cnt, h.roof_cond FROM banded b JOIN home_bands h ON h.qcn = b.qcn)",
        ],
    ).replace("WITH ", "SELECT segmentation, band, cnt, sign(CAST(total AS DOUBLE) / n) * floor(abs(CAST(total AS DOUBLE) / n) * CAST(1000000 AS DOUBLE) + 0.5) / CAST(1000000 AS DOUBLE) AS lrr FROM (WITH ", 1)
    + ")",
)
def w23_home_summary(spark, d):
    """The home workbook's sheets: its two own bands beside the shared ones. The bands
    are columns of the same rows, so nothing is joined."""
    k = F.col("qcn")
    rules = home_band_rules()
    df = banded(spark, d, store=True).withColumn("bath", F.when(k % 11 == 0, "None").otherwise((k % 12).cast("string"))).withColumn("bath_num", G.numeric_from_text("bath"))
    df = df.withColumn("roof", F.get(F.array(*[F.lit(c) for c in ROOF_CONDITIONS]), (k % 8).cast("int")))
    for out in ("ttl_bath_cnt", "roof_cond"):
        src, rule_list, default = rules[out]
        df = df.withColumn(out, band_expr(src, rule_list, default=default))
    return G.segment_summary(df, HOME_SEGMENTATIONS, "compl_qte_ind", "elrr")
