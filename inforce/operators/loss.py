"""Loss and premium rollups.

Scale notes
-----------
* The cohort configuration is one row per state, so it is broadcast; the
  per-group start dates become a join + filter instead of one query per group.
* Loss rows are joined on the policy key *and* effective date, then grouped by
  policy x month with partial aggregation before that second shuffle. Hashing
  on (policy, term) and (policy, month) rather than on the policy alone
  spreads a hot policy over its terms and months.
* Ratios over few segment keys (state, segment) are computed from aggregated
  rows, never with a window over raw rows: the window input is the small
  aggregate, so a hot state cannot land a third of the data in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inforce.functions.columns import earned_exposure, ratio, round_half_up
from inforce.operators.common import bounded_broadcast

# Fixed values used by the source dashboard (labels must match exactly).
NB_LABEL = "NB"
RENEWAL_LABEL = "Renewal"
NO_ACC_LABEL = "No Acc/Viol/Comp"
YES_ACC_LABEL = "Yes Acc/Viol/Comp"
SEG_CLEAN_CLEAN = "Clean/Clean"
SEG_CLEAN_DIRTY = "Clean/Dirty"
SEG_DIRTY_DIRTY = "Dirty/Dirty"

ELIG_COLS = ["uw_afa_cnt", "uw_naf_cnt", "uw_comp_cnt", "uw_mltry_cnt", "uw_perm_cnt", "uw_rentl_cnt"]
# the derived total sums the first five eligibility counts (rental/tow/glass is not part of it)
DERIVED_PARTS = ELIG_COLS[:5]
ATTR_COLS = [
    "risk_st", "orig_pol_eff_dt", "pol_eff_dt", "trans_stat_desc", "pol_type", "clean_dirty_cd",
    "spd_vio_cnt", "nspd_vio_cnt", *ELIG_COLS, "derived_ttl_cnt", "derived_yes_no_flag",
]
LOSS_MEASURES = ["incur_clm_cnt", "incur_loss", "glass_tow_cnt", "glass_tow_loss", "ep", "epapr"]


# --------------------------------------------------------------------------- W09
def version_overlaps(config: DataFrame, key: Sequence[str], valid: tuple[str, str]) -> DataFrame:
    """Versions of a configuration that begin before an earlier version of the same key
    ends (``valid``: first and last day, both included; NULL: open)."""
    start = F.coalesce(F.col(valid[0]), F.lit("0001-01-01").cast("date"))
    end = F.coalesce(F.col(valid[1]), F.lit("9999-12-31").cast("date"))
    rows = config.select(*key, start.alias("_from"), end.alias("_to"))
    w = Window.partitionBy(*key).orderBy("_from", "_to")
    before = F.max("_to").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("_before", before).filter(F.col("_before") >= F.col("_from"))


def effective_config(
    df: DataFrame, config: DataFrame, key: Sequence[str], at: str, valid: tuple[str, str], columns: Sequence[str], config_rows: int | None = None
) -> DataFrame:
    """Rows of ``df`` with the ``columns`` of the configuration version that is valid at
    the row's date: an equi-join on the key with a range test. Rows without a valid
    version, a key or a date are dropped. At most one version matches a row: versions
    of one key that overlap are an error, found when this is called (one small query
    of the configuration)."""
    if not version_overlaps(config, key, valid).isEmpty():
        raise ValueError("configuration versions of one key overlap")
    cfg = bounded_broadcast(config.select(*key, *columns, F.col(valid[0]).alias("_from"), F.col(valid[1]).alias("_to")), config_rows)
    inside = (F.col("_from").isNull() | (F.col(at) >= F.col("_from"))) & (F.col("_to").isNull() | (F.col(at) <= F.col("_to"))) & F.col(at).isNotNull()
    return df.join(cfg, list(key), "inner").filter(inside).drop("_from", "_to")


def cohort_extract(
    policies: DataFrame,
    config: DataFrame,
    as_of: dt.date,
    config_rows: int | None = None,
    nb_months: int = 6,
    valid: tuple[str, str] | None = None,
) -> DataFrame:
    """Per-state start dates drive the extraction (one broadcast join instead of
    a query per state group). NB when the origin date is within ``nb_months`` of
    ``as_of`` (strictly after), rows with any NULL eligibility count dropped.
    ``valid``: the columns of a configuration with versions that say from and until
    which effective date a version applies (see ``effective_config``)."""
    total = None
    for c in DERIVED_PARTS:
        total = F.col(c) if total is None else total + F.col(c)
    not_null = None
    for c in ELIG_COLS:
        cond = F.col(c).isNotNull()
        not_null = cond if not_null is None else not_null & cond
    if valid is None:
        started = policies.join(bounded_broadcast(config.select("risk_st", "start_dt", "start_month"), config_rows), "risk_st", "inner")
    else:
        started = effective_config(policies, config, ["risk_st"], "pol_eff_dt", valid, ["start_dt", "start_month"], config_rows)
    return (
        started.filter((F.col("pol_eff_dt") >= F.col("start_dt")) & not_null)
        .withColumn(
            "pol_type",
            F.when(F.col("orig_pol_eff_dt") > F.add_months(F.lit(as_of), -nb_months), F.lit(NB_LABEL)).otherwise(
                F.lit(RENEWAL_LABEL)
            ),
        )
        .withColumn("derived_ttl_cnt", total.cast("int"))
        .withColumn(
            "derived_yes_no_flag",
            F.when(F.col("derived_ttl_cnt") == 0, F.lit(NO_ACC_LABEL)).otherwise(F.lit(YES_ACC_LABEL)),
        )
    )


# --------------------------------------------------------------------------- W10
def loss_rollup(loss: DataFrame, cohort: DataFrame, exclude_cov: Sequence[str] = ("R",)) -> DataFrame:
    """Policy x earned-month rollup: attributes by MIN, measures by SUM, plus
    earned exposure of the month. ``cohort`` is the W09 output (it carries each
    row's ``start_month``); all cohorts are handled by one join."""
    lo = loss.filter(~F.col("cov_type_abbr").isin(list(exclude_cov))).select(
        "pol_id", "pol_eff_dt", "earned_month", *LOSS_MEASURES
    )
    co = cohort.select("pol_id", "start_month", *ATTR_COLS)
    j = lo.join(co, ["pol_id", "pol_eff_dt"], "inner").filter(F.col("earned_month") >= F.col("start_month"))
    aggs = [F.min(c).alias("latest_pol_eff_dt" if c == "pol_eff_dt" else c) for c in ATTR_COLS]
    aggs += [F.sum(c).alias(c) for c in LOSS_MEASURES]
    # exposure carried as an exact decimal so later sums do not depend on row order
    ee = earned_exposure("earned_month").cast("decimal(18,12)")
    return j.groupBy("pol_id", "earned_month").agg(*aggs).withColumn("ee", ee)


# --------------------------------------------------------------------------- W11
def reclassify(df: DataFrame, where: Column, col: str, value) -> DataFrame:
    """Post-hoc conditional update (``UPDATE t SET col = value WHERE ...``)."""
    return df.withColumn(col, F.when(where, F.lit(value)).otherwise(F.col(col)))


def segment_label(clean_dirty: str = "clean_dirty_cd", flag: str = "derived_yes_no_flag") -> Column:
    """Chargeability/UW segment from the clean/dirty code and the yes/no flag."""
    cd = F.col(clean_dirty)
    fl = F.col(flag)
    return (
        F.when((cd == "C") & (fl == NO_ACC_LABEL), F.lit(SEG_CLEAN_CLEAN))
        .when((cd == "C") & (fl == YES_ACC_LABEL), F.lit(SEG_CLEAN_DIRTY))
        .otherwise(F.lit(SEG_DIRTY_DIRTY))
    )


# --------------------------------------------------------------------------- W12
def running_ratio(
    rollup: DataFrame,
    segment: Column | None = None,
    month: str = "earned_month",
    loss_col: str = "incur_loss",
    prem_col: str = "epapr",
    ee_col: str = "ee",
    id_col: str = "pol_id",
    business_type: str = "Both",
    states: Sequence | None = None,
    type_col: str = "pol_type",
    state_col: str = "risk_st",
) -> DataFrame:
    """Segment x month: running loss, running premium, running LR, running EE and
    the month's distinct policy count. The window runs over the (segment, month)
    aggregate, which has at most #segments x #months rows.

    ``business_type`` ('NB', 'Renewal' or 'Both') and ``states`` are the
    dashboard's filters; they are row filters applied before aggregation."""
    seg = segment if segment is not None else segment_label()
    if business_type != "Both":
        rollup = rollup.filter(F.col(type_col) == business_type)
    if states is not None:
        rollup = rollup.filter(F.col(state_col).isin(list(states)))
    per_month = (
        rollup.withColumn("segment", seg)
        .groupBy("segment", month)
        .agg(
            F.sum(loss_col).alias("_loss"),
            F.sum(prem_col).alias("_prem"),
            F.sum(ee_col).alias("_ee"),
            F.countDistinct(id_col).alias("pol_cnt"),
        )
    )
    w = Window.partitionBy("segment").orderBy(month).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cum_loss = F.sum("_loss").over(w)
    cum_prem = F.sum("_prem").over(w)
    return per_month.select(
        "segment",
        month,
        cum_loss.cast("double").alias("cum_loss"),
        cum_prem.cast("double").alias("cum_epapr"),
        ratio(cum_loss, cum_prem, 6).alias("cum_loss_ratio"),
        round_half_up(F.sum("_ee").over(w).cast("double"), 6).alias("cum_ee"),
        F.col("pol_cnt"),
    )


# --------------------------------------------------------------------------- W13
def relativity(
    rollup: DataFrame,
    dims: Sequence[str],
    parent: Sequence[str],
    business_type: str = "Both",
    type_col: str = "pol_type",
    loss_col: str = "incur_loss",
    prem_col: str = "epapr",
) -> DataFrame:
    """Segment LR / parent LR (LRR), with the NB / Renewal / Both switch applied as
    conditional sums. Two-step: aggregate to ``dims`` first, then the parent
    totals by a window over that small aggregate."""

    def pick(c: str) -> Column:
        if business_type == "Both":
            return F.col(c)
        return F.when(F.col(type_col) == business_type, F.col(c))

    seg = rollup.groupBy(*dims).agg(F.sum(pick(loss_col)).alias("_l"), F.sum(pick(prem_col)).alias("_p"))
    wp = Window.partitionBy(*parent)
    seg_lr = ratio(F.col("_l"), F.col("_p"), None)
    par_lr = ratio(F.sum("_l").over(wp), F.sum("_p").over(wp), None)
    return seg.select(
        *dims,
        F.round(seg_lr, 6).alias("segment_lr"),
        F.round(par_lr, 6).alias("parent_lr"),
        F.round(ratio(seg_lr, par_lr, None), 4).alias("lrr"),
    )


# --------------------------------------------------------------------------- W14
def share_of_total(
    df: DataFrame,
    dims: Sequence[str],
    measure: str,
    business_type: str = "Both",
    type_col: str = "pol_type",
) -> DataFrame:
    """Segment share of the grand total (``SUM(x) / TOTAL(SUM(x))``). The grand
    total is a scalar subquery over the report rows: with partial sums, however
    many segments there are, no task gets all of them."""
    m = F.col(measure) if business_type == "Both" else F.when(F.col(type_col) == business_type, F.col(measure))
    seg = df.groupBy(*dims).agg(F.sum(m).alias("_m"))
    seg = seg.withColumn("_total", seg.agg(F.sum("_m")).scalar())
    return seg.select(*dims, F.col("_m").cast("double").alias("segment_total"), ratio(F.col("_m"), F.col("_total"), 6).alias("share"))


# --------------------------------------------------------------------------- W15
def segment_loss_ratio(
    chars: DataFrame,
    loss_ts: DataFrame,
    dims: Sequence[str],
    keys: Sequence[str] = ("pol_id", "pol_prd_id"),
) -> DataFrame:
    """Pre-aggregate loss to policy-period, join to characteristics (JOIN USING),
    then per segment: earned exposure, ultimate and incurred LR, EE share."""
    ru = loss_ts.groupBy(*keys).agg(
        F.sum("ee").alias("ee"),
        F.sum("incur_loss").alias("incur_loss"),
        F.sum("ult_loss").alias("ult_loss"),
        F.sum("ep").alias("ep"),
    )
    j = chars.join(ru, list(keys), "inner")
    seg = j.groupBy(*dims).agg(
        F.sum("ee").alias("_ee"), F.sum("ult_loss").alias("_ult"), F.sum("incur_loss").alias("_inc"),
        F.sum("ep").alias("_ep"),
    )
    # the grand total is a scalar subquery with partial sums, not a window in one task
    seg = seg.withColumn("_total", seg.agg(F.sum("_ee")).scalar())
    tot = F.col("_total")
    return seg.select(
        *dims,
        F.col("_ee").cast("double").alias("earned_exposure"),
        ratio("_ult", "_ep", 4).alias("ult_loss_ratio"),
        ratio("_inc", "_ep", 4).alias("incur_loss_ratio"),
        F.round(F.col("_ee").cast("double") / tot.cast("double") * 100.0, 2).alias("ee_pct"),
        # the worksheet's text form, one decimal and a percent sign
        F.concat(
            F.format_string("%.1f", round_half_up(F.col("_ee").cast("double") / tot.cast("double") * 100.0, 1)), F.lit("%")
        ).alias("ee_pct_text"),
    )


# --------------------------------------------------------------------------- W37
def premium_change_by_year(terms: DataFrame, change_col: str, eff_col: str = "pol_eff_dt") -> DataFrame:
    """Σ change / COUNT(*) by effective year (NULL changes count in the divisor).
    The 6-place changes are summed as exact decimals, so the result does not
    depend on the order rows arrive in."""
    exact = F.col(change_col).cast("decimal(18,6)")
    return terms.groupBy(F.year(eff_col).alias("eff_year")).agg(
        round_half_up(F.sum(exact).cast("double") / F.count(F.lit(1)), 6).alias("avg_prem_change"),
        F.count(F.lit(1)).alias("term_cnt"),
    )


# --------------------------------------------------------------------------- W40
def loss_by_source(ids: DataFrame, losses: DataFrame, id_col: str = "pol_id") -> DataFrame:
    """Keep every listed id (left join), Σ premium and loss by id x month x source.

    Losses are summed to id x month *before* the join: the sums are
    distributive, a hot id ships one partial row per task and month, and the
    right side of the left join (which AQE cannot split) is small per key."""
    lo = losses.groupBy(id_col, "earned_month").agg(F.sum("ep").alias("_ep"), F.sum("incur_loss").alias("_il"))
    j = ids.join(lo, id_col, "left")
    return j.groupBy(id_col, "earned_month", "source").agg(
        F.sum("_ep").cast("double").alias("ep"), F.sum("_il").cast("double").alias("incur_loss")
    )
