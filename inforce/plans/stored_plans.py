"""Registered queries on stored tables: snapshots by month, code histories as runs,
INSERT / UPDATE / DELETE, re-aggregated distinct counts, appended running totals
(W11, W12, W18, W20, W30, W38, W39, W41, W43). The tables are written to the shared
folder when a query is built, from the given tables alone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from inforce.functions.columns import ratio, round_half_up
from inforce.operators import distinct as DC
from inforce.operators import linkage as LK
from inforce.operators import loss as L
from inforce.operators import reconcile as R
from inforce.operators import snapshots as SN
from inforce.operators import totals as TT
from inforce.plans import loss_plans as LP
from inforce.plans import maintenance_plans as MP
from inforce.plans import persistency_plans as PP
from inforce.plans import reconcile_plans as RP
from inforce.plans.registry import ORACLES, finalize, register
from inforce.session import scratch_path, written
from inforce.sources import staging as S
from inforce.sources.stored import StoredTable


# ----------------------------------------------------------------------------- month-end snapshots
def stored_snapshots(spark, d) -> StoredTable:
    """All months in one write, then the newest month once more, as a monthly job does
    when it is repeated."""
    terms = S.term(spark, d)
    table = SN.snapshot_table(spark, scratch_path(spark, "snapshots"))
    table.replace(SN.all_snapshots(terms, S.last_month_end(spark, d).scalar()))
    SN.append_month(table, terms, dt.date.fromisoformat(table.partitions()[-1]))
    return table


@register("w20_stored_snapshot", ORACLES["w20_snapshot_vs_history"])
def w20_stored_snapshot(spark, d):
    """The latest month from its partition alone, against the history."""
    return RP.against_history(spark, d, SN.latest_snapshot(stored_snapshots(spark, d)))


@register("w43_stored_inforce_by_status", ORACLES["w43_inforce_by_status"])
def w43_stored_inforce_by_status(spark, d):
    return LK.inforce_by_status(SN.latest_snapshot(stored_snapshots(spark, d)), ["InForce", "A"])


# ----------------------------------------------------------------------------- code histories as runs
def runs(spark, d):
    return SN.code_runs(S.term(spark, d), S.last_month_end(spark, d).scalar())


@register(
    "w30_code_runs",
    S.with_ctes(
        ["term"],
        """SELECT policy_id, pol_form_cd, pol_status_cd, MIN(me_dt) AS from_me, MAX(me_dt) AS to_me
FROM (
  SELECT *, date_diff('month', DATE '1970-01-01', me_dt) - row_number() OVER (PARTITION BY policy_id, pol_form_cd, pol_status_cd ORDER BY me_dt) AS island
  FROM inforce_monthend
) GROUP BY policy_id, pol_form_cd, pol_status_cd, island""",
        [S.inforce_monthend_sql()],
    ),
)
def w30_code_runs(spark, d):
    return runs(spark, d)


@register("w30_transitions_from_runs", ORACLES["w30_code_transitions"])
def w30_transitions_from_runs(spark, d):
    table = written(runs(spark, d), "code-runs")
    return SN.run_transitions(table, PP.W30_FROM_ME, label="MEDIUM", last=S.last_month_end(spark, d).scalar())


@register(
    "w41_inforce_by_month",
    S.with_ctes(
        ["term"],
        "SELECT me_dt, pol_form_cd, pol_status_cd, COUNT(*) AS policies FROM inforce_monthend GROUP BY ALL",
        [S.inforce_monthend_sql()],
    ),
)
def w41_inforce_by_month(spark, d):
    """Policies per month end, code and status from the runs' ends, without a row per
    policy and month."""
    return SN.counts_by_month(runs(spark, d))


# ----------------------------------------------------------------------------- INSERT, UPDATE, DELETE
@register("w11_stored_update", ORACLES["w11_reclassify"])
def w11_stored_update(spark, d):
    """The dirty code's update as a stored ``UPDATE``."""
    table = StoredTable(spark, scratch_path(spark, "uw-rollup"), "risk_st")
    table.insert(LP.uw_rollup(spark, d).select("pol_id", "earned_month", "clean_dirty_cd", "derived_yes_no_flag", "risk_st"))
    table.update({"derived_yes_no_flag": F.lit(L.YES_ACC_LABEL)}, F.col("clean_dirty_cd") == "D")
    return table.read().select("pol_id", "earned_month", "clean_dirty_cd", "derived_yes_no_flag", L.segment_label().alias("segment"))


@register("w18_stored_update", ORACLES["w18_update_from"])
def w18_stored_update(spark, d):
    """Columns added with a default, then ``UPDATE ... FROM`` the allocation, on a table
    partitioned by year."""
    table = StoredTable(spark, scratch_path(spark, "ulm-loss"), "year_earned")
    table.insert(RP.ulm_loss(spark, d).withColumn("year_earned", F.substring("earned_month", 1, 4)))
    table.add_columns({c: F.lit(0.0) for c in RP._ADJ})
    n = S.loss_partitions(spark, d)
    source = written(RP.alloc(spark, d, partitions=n).select(*RP._KEYS, *RP._ADJ), "allocation")

    def change(rows, src):
        return R.update_from(rows, src, RP._KEYS, {c: 0.0 for c in RP._ADJ}, null_safe=["pol_prd_id"], share="ee", partitions=n)

    table.update_from(source, RP._KEYS, change)
    return finalize(table.read().select(*RP._KEYS, "ee", *[round_half_up(c, 4).alias(c) for c in RP._ADJ]))


def stored_ids(spark, d) -> StoredTable:
    """The stacked id list, one ``INSERT`` per source."""
    removed, reinstated = MP.id_lists(spark, d)
    table = StoredTable(spark, scratch_path(spark, "id-list"), "source")
    table.insert(removed.distinct().withColumn("source", F.lit("credit_removed")))
    table.insert(reinstated.withColumn("source", F.lit("reinstated")))
    return table


@register("w38_stored_insert", ORACLES["w38_tag_and_stack"])
def w38_stored_insert(spark, d):
    return stored_ids(spark, d).read()


@register("w39_stored_delete", ORACLES["w39_exclude_members"])
def w39_stored_delete(spark, d):
    table = stored_ids(spark, d)
    table.delete_in(PP.members(spark, d), "pol_id")
    return table.read()


# ----------------------------------------------------------------------------- distinct counts that aggregate again
GRAINS = {
    "all": ((), None),
    "state": (("risk_st",), None),
    "segment": (("segment",), None),
    "segment month": (("segment", "earned_month"), None),
    "renewal state": (("risk_st",), "Renewal"),
}
_DIMS = ["segment", "risk_st", "pol_type", "earned_month"]


def policy_bitmaps(spark, d):
    rows = written(LP.uw_fixed(spark, d).select(L.segment_label().alias("segment"), "risk_st", "pol_type", "earned_month", "pol_id"), "uw-policies")
    return written(DC.distinct_bitmaps(rows, _DIMS, "pol_id", DC.number_ids(rows, "pol_id")), "policy-bitmaps")


def _grain_sql(grain, dims, kind):
    cols = ", ".join(f"{c} AS {c}" if c in dims else f"NULL AS {c}" for c in ("segment", "risk_st", "earned_month"))
    where = f" WHERE pol_type = '{kind}'" if kind else ""
    return f"SELECT '{grain}' AS grain, {cols}, COUNT(DISTINCT pol_id) AS pol_cnt FROM seg_rows{where}" + (f" GROUP BY {', '.join(dims)}" if dims else "")


@register(
    "w12_distinct_policies",
    LP._uw_sql(
        "SELECT grain, CAST(segment AS VARCHAR) AS segment, CAST(risk_st AS DOUBLE) AS risk_st, CAST(earned_month AS VARCHAR) AS earned_month, pol_cnt FROM ("
        + " UNION ALL ".join(_grain_sql(g, dims, kind) for g, (dims, kind) in GRAINS.items()) + ")",
        more=[f"seg_rows AS (SELECT {LP.SEGMENT_SQL} AS segment, risk_st, pol_type, earned_month, pol_id FROM fixed)"],
    ),
)
def w12_distinct_policies(spark, d):
    """Distinct policies at five grains, all from one table of bitmaps."""
    bitmaps, out = policy_bitmaps(spark, d), None
    for grain, (dims, kind) in GRAINS.items():
        part = DC.count_ids(bitmaps, dims, None if kind is None else F.col("pol_type") == kind, "pol_cnt")
        kinds = {"segment": "string", "risk_st": "double", "earned_month": "string"}
        cols = [(F.col(c) if c in dims else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()]
        part = part.select(F.lit(grain).alias("grain"), *cols, "pol_cnt")
        out = part if out is None else out.unionByName(part)
    return out


# ----------------------------------------------------------------------------- running totals that take new months
_MEASURES = ["incur_loss", "epapr", "ee"]
APPEND_FROM, LATE_MONTH = "200002", "199911"


@register(
    "w12_appended_months",
    "SELECT segment, earned_month, cum_loss, cum_epapr, cum_loss_ratio, cum_ee FROM (" + LP.W12_SQL + ")",
)
def w12_appended_months(spark, d):
    """The running ratio from stored totals: first the months before one, without a
    month that is late; then the newer months; then the late one."""
    rows = written(LP.uw_fixed(spark, d).select(L.segment_label().alias("segment"), "earned_month", *_MEASURES), "uw-months")
    month, by = F.col("earned_month"), ["segment"]
    table = written(TT.running_totals(rows.filter((month < APPEND_FROM) & (month != LATE_MONTH)), by, "earned_month", _MEASURES), "totals")
    table = written(TT.add_months(table, rows.filter(month >= APPEND_FROM), by, "earned_month", _MEASURES), "totals")
    table = TT.add_months(table, rows.filter(month == LATE_MONTH), by, "earned_month", _MEASURES)
    return table.select(
        "segment", "earned_month", F.col("cum_incur_loss").cast("double").alias("cum_loss"), F.col("cum_epapr").cast("double").alias("cum_epapr"),
        ratio(F.col("cum_incur_loss"), F.col("cum_epapr"), 6).alias("cum_loss_ratio"), round_half_up(F.col("cum_ee").cast("double"), 6).alias("cum_ee"),
    )
