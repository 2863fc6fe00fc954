"""Explicit schemas of the domain tables the operators consume (FIXTURES.md §1).

Deployments that hold the real warehouse extracts read them with these
schemas (no inference, stable types, ids kept as strings so leading zeros and
letters survive). Column names are the operators' lower-case names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, L, D, DT, TS = StringType(), IntegerType(), LongType(), DoubleType(), DateType(), TimestampType()
MONEY, MONEY4 = DecimalType(18, 2), DecimalType(18, 4)

SCHEMAS: dict[str, StructType] = {
    "auto_policy_latest": _s(
        ("pol_id", S), ("pol_prd_id", L), ("risk_st", S), ("orig_pol_eff_dt", DT), ("pol_eff_dt", DT),
        ("trans_stat_desc", S), ("clean_dirty_cd", S), ("spd_vio_cnt", I), ("nspd_vio_cnt", I),
        ("uw_afa_cnt", I), ("uw_naf_cnt", I), ("uw_comp_cnt", I), ("uw_mltry_cnt", I), ("uw_perm_cnt", I),
        ("uw_rentl_cnt", I),
    ),
    "operational_loss": _s(
        ("pol_id", S), ("pol_prd_id", L), ("pol_eff_dt", DT), ("cov_type_abbr", S), ("earned_month", S),
        ("ee", DecimalType(38, 4)), ("incur_clm_cnt", I), ("incur_loss", MONEY4), ("glass_tow_cnt", I),
        ("glass_tow_loss", MONEY4), ("ep", MONEY), ("epapr", MONEY4), ("ult_loss", MONEY4),
        ("earned_month_dt", DT), ("newco_ind", S),
    ),
    "term_history": _s(
        ("pol_id", S), ("pol_prd_id", L), ("pol_eff_dt", DT), ("pol_exp_dt", DT), ("canc_eff_dt", DT),
        ("canc_trans_dt", DT), ("prem", MONEY), ("rate_plan_cd", S), ("pol_form_cd", S), ("acct_cr_ind", I),
        ("risk_st", S), ("new_rnw_cd", S), ("term_mo_cnt", I), ("newco_ind", S),
    ),
    "dev_factor": _s(("persistency_period", S), ("pol_new_renew_cd", S), ("dev_fctr", D)),
    "inforce_monthend": _s(
        ("policy_id", S), ("me_dt", DT), ("pol_prd_id", L), ("rate_plan_cd", S), ("pol_form_cd", S),
        ("pol_status_cd", S),
    ),
    "model_period": _s(
        ("cv_plcy_period_id", L),
        *[(f"adj_{c}_pp_pred", D) for c in ("bi", "coll", "comp", "mp", "pd", "pip", "um")],
        *[(f"{c}_exposure", D) for c in ("bi", "coll", "comp", "mp", "pd", "pip", "um")],
    ),
    "scoremart": _s(
        ("qcn", L), ("pol_id", S), ("state", S), ("expected_loss_ratio", DecimalType(18, 6)),
        ("ol_expected_loss_ratio", DecimalType(18, 6)), ("pni_age", I), ("ins_scr_cd", I), ("ubi_score", I),
        ("tlmtc_pol_bucket_cd", S), ("hh_composition", S), ("account_credit", S), ("dwelling_lmt", S),
        ("sqft", S), ("dwell_age", S), ("compl_qte_ind", I),
    ),
    "campaign_extract": _s(
        ("pol_id", S), ("extract_id", L), ("ctrl_test_cd", S), ("loi_cd", S), ("bill_extrct_typ_desc", S),
        ("do_not_call_cntct_list_ind", S), ("bill_instal_typ_desc", S),
    ),
    "billing_account": _s(("bill_acct_id", L), ("bill_acct_plan_typ_cd", S)),
    "billing_term": _s(("pol_term_id", L), ("pol_id", S), ("pol_eff_dt", DT), ("pol_exp_dt", DT), ("orig_bill_acct_id", L)),
    "billing_term_data": _s(("pol_term_id", L), ("bill_instal_typ_desc", S)),
    "quotes": _s(("qcn", L), ("pol_id", S), ("qte_dt", DT)),
    "party_link": _s(("auto_qcn", L), ("home_qcn", L)),
    "policy_transactions": _s(
        ("qcn", S), ("trans_dt", DT), ("trans_id", L), ("version_id", L), ("trans_typ_desc", S),
        ("trans_stat_desc", S), ("orig_pol_eff_dt", DT), ("canc_eff_dt", DT),
    ),
    "transaction_reasons": _s(("qcn", S), ("trans_dt", DT), ("trans_rsn_desc", S)),
    "web_events": _s(
        ("policy_num", S), ("event_day", DT), ("web_site_identifier", S), ("internal_traffic", S),
        ("app_user_access_role", S), ("event_id", S), ("page_name", S), ("event_detail", S), ("session_id", S),
    ),
    "uw_rule_hits": _s(("pol_id", S), ("pol_eff_dt", DT), ("hit_prd_id", L), ("hit_line", I), ("uw_ref_decl_rule_id", L)),
    "uw_rule_ref": _s(("rule_id", L), ("msg", S), ("nb", S), ("rw", S), ("uw_rule_trig_rsn_desc", S)),
    "claims": _s(
        ("clm_id", L), ("loss_evnt_num", I), ("pol_id", S), ("cov_typ_desc", S), ("loss_dt", TS), ("rpt_tmsp", TS),
        ("clm_ttl_inc_amt", MONEY4),
    ),
}


def read_domain(spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read a domain table with its declared schema (no inference)."""
    return spark.read.format(fmt).schema(SCHEMAS[name]).options(**options).load(path)


def conform(df: DataFrame, name: str, absent: tuple[str, ...] = ()) -> DataFrame:
    """Select and cast a frame to a domain schema by name. A column that the frame
    lacks is an error, unless ``absent`` names it: those become NULL."""
    from pyspark.sql import functions as F

    missing = [f.name for f in SCHEMAS[name].fields if f.name not in df.columns and f.name not in absent]
    if missing:
        raise ValueError(f"{name}: columns missing from the input: {', '.join(missing)}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields])
