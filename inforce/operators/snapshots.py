"""Month-end snapshots and code histories.

* ``month_snapshot``: the policies in force at one month end, from the terms.
* ``append_month`` / ``latest_snapshot``: the periodic snapshot table, partitioned by
  month end. Writing a month twice gives the same table, and a query of the latest
  month opens that month's files only.
* ``code_runs``: the whole history as one row per policy and unbroken stretch of
  months with the same code and status, in place of one row per policy and month.
* ``extend_runs``: a month's snapshot added to the runs.

Scale notes
-----------
* One aggregation per policy (and month) with ``max_by`` picks the newest term: it is
  combined before the shuffle, so a policy with very many terms ships a row per task
  and month, not all its rows.
* Runs come from interval arithmetic on month numbers. After the first aggregation a
  policy has at most one row per month of the calendar, which bounds every later
  window. Only policies where an older term outlives a newer one are laid out by
  month, and they alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inforce.session import written
from inforce.sources.stored import StoredTable

STATUS_IN_FORCE, STATUS_CANCELLED = "InForce", "Cancelled"


def month_number(c: Column | str) -> Column:
    """Months since year 0 of a date: the month end of the same month has it too."""
    return F.year(c) * 12 + F.month(c) - 1


def month_end(number: Column | str) -> Column:
    """The last day of a month number."""
    n = F.col(number) if isinstance(number, str) else number
    return F.last_day(F.make_date(F.floor(n / 12).cast("int"), (F.pmod(n, F.lit(12)) + 1).cast("int"), F.lit(1)))


def _status(me: Column) -> Column:
    left = F.col("canc_eff_dt").isNotNull() & (F.col("canc_eff_dt") <= me)
    return F.when(left, F.lit(STATUS_CANCELLED)).otherwise(F.lit(STATUS_IN_FORCE))


def month_snapshot(terms: DataFrame, me, key: str = "pol_id", codes: Sequence[str] = ("rate_plan_cd", "pol_form_cd")) -> DataFrame:
    """(policy_id, pol_prd_id, <codes>, pol_status_cd, me_dt) of the policies with a
    term in force at the month end ``me`` (effective date <= me < expiry): the newest
    such term. A cancelled term stays in the snapshot, with its status."""
    me = F.lit(me).cast("date") if not isinstance(me, Column) else me
    row = F.struct("pol_prd_id", "canc_eff_dt", *codes)
    held = terms.filter((F.col("pol_eff_dt") <= me) & (F.col("pol_exp_dt") > me))
    newest = held.groupBy(F.col(key).alias("policy_id")).agg(F.max_by(row, F.struct("pol_eff_dt", "pol_prd_id")).alias("r"))
    return newest.select("policy_id", "r.*").select("policy_id", "pol_prd_id", *codes, _status(me).alias("pol_status_cd"), me.alias("me_dt"))


def all_snapshots(terms: DataFrame, last: Column, key: str = "pol_id", codes: Sequence[str] = ("rate_plan_cd", "pol_form_cd")) -> DataFrame:
    """``month_snapshot`` for every month end up to ``last`` in one pass."""
    months = F.sequence(F.trunc("pol_eff_dt", "month"), F.trunc("pol_exp_dt", "month"), F.expr("interval 1 month"))
    covered = F.filter(F.transform(months, F.last_day), lambda m: (F.col("pol_eff_dt") <= m) & (F.col("pol_exp_dt") > m) & (m <= F.col("_last")))
    row = F.struct("pol_prd_id", "canc_eff_dt", *codes)
    laid = terms.withColumn("_last", last).select(F.col(key).alias("policy_id"), "pol_eff_dt", "pol_prd_id", row.alias("row"), F.explode(covered).alias("me_dt"))
    newest = laid.groupBy("policy_id", "me_dt").agg(F.max_by("row", F.struct("pol_eff_dt", "pol_prd_id")).alias("r"))
    return newest.select("policy_id", "me_dt", "r.*").select("policy_id", "pol_prd_id", *codes, _status(F.col("me_dt")).alias("pol_status_cd"), "me_dt")


# --------------------------------------------------------------------------- the stored table
def snapshot_table(spark: SparkSession, path: str) -> StoredTable:
    return StoredTable(spark, path, "me_dt")


def append_month(table: StoredTable, terms: DataFrame, me) -> int:
    """Writes one month's snapshot, in place of the month's earlier one if there is
    one. A month without policies in force leaves the table as it is."""
    return table.replace(month_snapshot(terms, me))


def latest_snapshot(table: StoredTable) -> DataFrame:
    """The snapshot of the newest month; no other month's files are opened."""
    return table.latest_partition()


# --------------------------------------------------------------------------- runs
def _islands(pieces: DataFrame, code: str) -> DataFrame:
    """Pieces (policy_id, code, status, lo, hi), disjoint within a policy, with
    neighbours of equal code and status joined."""
    w = Window.partitionBy("policy_id").orderBy("lo")
    same = F.col(code).eqNullSafe(F.lag(code).over(w)) & (F.col("pol_status_cd") == F.lag("pol_status_cd").over(w)) & (F.col("lo") == F.lag("hi").over(w) + 1)
    marked = pieces.withColumn("_new", F.when(same, 0).otherwise(1))
    runs = marked.withColumn("_run", F.sum("_new").over(w)).groupBy("policy_id", "_run")
    return runs.agg(F.first(code).alias(code), F.first("pol_status_cd").alias("pol_status_cd"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_run")


def code_runs(terms: DataFrame, last: Column, key: str = "pol_id", code: str = "pol_form_cd") -> DataFrame:
    """(policy_id, <code>, pol_status_cd, from_me, to_me): the unbroken stretches of
    month ends at which a policy's newest term in force has the same code and status,
    up to the month end ``last`` (a one-row scalar or literal). Laying the runs out by
    month gives ``all_snapshots``. Terms without an effective or expiry date have no
    months; a null code is a value like any other. Intermediate rows are written to the
    shared folder when this is called."""
    # the month end of an expiry's own month is not before the expiry
    hi = F.least(month_number("pol_exp_dt") - 1, month_number(F.col("_last")))
    spans = terms.withColumn("_last", last).select(
        F.col(key).alias("policy_id"), F.col(code).alias(code), "pol_eff_dt", "pol_prd_id", month_number("pol_eff_dt").alias("lo"),
        F.when(F.col("pol_exp_dt").isNotNull(), hi).alias("hi"), month_number("canc_eff_dt").alias("gone"),
    ).filter(F.col("lo") <= F.col("hi"))
    # three branches read the spans and two the rows per first month: written once each
    spans = written(spans, "term-months")
    rank = F.struct("pol_eff_dt", "pol_prd_id")
    row = F.struct("hi", code, "gone")
    # one row per policy and first month: the newest term, and how far any other reaches
    starts = spans.groupBy("policy_id", "lo").agg(F.max_by(row, rank).alias("r"), F.max("hi").alias("reach")).select("policy_id", "lo", "r.*", "reach")
    w = Window.partitionBy("policy_id").orderBy("lo")
    before = F.max("reach").over(w.rowsBetween(Window.unboundedPreceding, -1))
    ordered = starts.withColumn("_next", F.lead("lo").over(w)).withColumn("_outlived", (F.col("reach") > F.col("hi")) | (F.coalesce(before, F.col("hi")) > F.col("hi")))
    odd = F.max("_outlived").over(Window.partitionBy("policy_id"))
    ordered = written(ordered.withColumn("_odd", odd), "term-starts")
    plain = ordered.filter(~F.col("_odd")).select("policy_id", code, "gone", "lo", F.least("hi", F.coalesce(F.col("_next") - 1, F.col("hi"))).alias("hi"))
    # an older term that outlives a newer one comes back: these policies month by month
    names = ordered.filter("_odd").select(F.col("policy_id").alias("_odd_id")).distinct()
    laid = spans.join(names, F.col("policy_id").eqNullSafe(F.col("_odd_id")), "left_semi").withColumn("month", F.explode(F.sequence("lo", "hi")))
    laid = laid.groupBy("policy_id", "month").agg(F.max_by(F.struct(code, "gone"), rank).alias("r")).select("policy_id", "r.*", F.col("month").alias("lo"), F.col("month").alias("hi"))
    pieces = plain.unionByName(laid)
    # in force before the month of the cancellation, cancelled from then on
    gone = F.coalesce(F.col("gone"), F.col("hi") + 1)
    parts = F.array(
        F.struct(F.lit(STATUS_IN_FORCE).alias("pol_status_cd"), F.col("lo"), F.least(F.col("hi"), gone - 1).alias("hi")),
        F.struct(F.lit(STATUS_CANCELLED).alias("pol_status_cd"), F.greatest(F.col("lo"), gone).alias("lo"), F.col("hi")),
    )
    pieces = pieces.select("policy_id", code, F.explode(parts).alias("p")).select("policy_id", code, "p.*").filter(F.col("lo") <= F.col("hi"))
    return _as_dates(_islands(pieces, code), code)


def _as_dates(runs: DataFrame, code: str) -> DataFrame:
    return runs.select("policy_id", code, "pol_status_cd", month_end("lo").alias("from_me"), month_end("hi").alias("to_me"))


def extend_runs(runs: DataFrame, snapshot: DataFrame, code: str = "pol_form_cd") -> DataFrame:
    """The runs with one more month's snapshot (all its rows have one month end): a
    run that ended the month before goes on if code and status are the same, else a
    new one begins. A month that the runs already hold is replaced from there on, so
    adding the newest month twice changes nothing; months after it are dropped."""
    month = snapshot.agg(F.max("me_dt")).scalar()
    kept = runs.withColumn("_month", month).filter(F.col("_month").isNull() | (F.col("from_me") < F.col("_month")))
    before = F.last_day(F.add_months("_month", -1))
    kept = kept.select("policy_id", code, "pol_status_cd", "from_me", F.when(F.col("to_me") >= F.col("_month"), before).otherwise(F.col("to_me")).alias("to_me"))
    new = snapshot.select("policy_id", F.col(code), "pol_status_cd", F.col("me_dt").alias("from_me"), F.col("me_dt").alias("to_me"))
    pieces = kept.unionByName(new).select("policy_id", code, "pol_status_cd", month_number("from_me").alias("lo"), month_number("to_me").alias("hi"))
    return _as_dates(_islands(pieces, code), code)


def runs_at(runs: DataFrame, me) -> DataFrame:
    """The runs that cover a month end: its snapshot's policies, codes and statuses."""
    me = F.lit(me).cast("date") if not isinstance(me, Column) else me
    return runs.filter((F.col("from_me") <= me) & (F.col("to_me") >= me))


def run_transitions(runs: DataFrame, since, code: str = "pol_form_cd", from_code: str = "3-MEDIUM", none_code: str = "0", label: str | None = None, last=None) -> DataFrame:
    """``persistency.code_transitions`` from runs: per policy in force after ``since``
    the first and the last code, the month end of the latest change, whether it is
    out of force at the month end ``last``, and the transition's bucket. Months out of
    force are passed over: the code after them is compared with the one before."""
    from inforce.operators.persistency import transition_bucket

    since = F.lit(since).cast("date")
    first = F.when(F.last_day(since) > since, F.last_day(since)).otherwise(F.last_day(F.add_months(since, 1)))
    held = runs.filter((F.col("pol_status_cd") == STATUS_IN_FORCE) & (F.col("to_me") >= first))
    held = held.withColumn("from_me", F.greatest("from_me", first))
    w = Window.partitionBy("policy_id").orderBy("from_me")
    held = held.withColumn("_changed", F.when(F.col(code) != F.lag(code).over(w), F.col("from_me")))
    now = (F.col("to_me") >= last) & (F.col("from_me") <= last)
    per = held.withColumn("_now", F.coalesce(now, F.lit(False))).groupBy("policy_id").agg(
        F.min_by(code, "from_me").alias("initial_code"), F.max_by(code, "from_me").alias("current_code"), F.max("_changed").alias("change_dt"), F.max("_now").alias("_now")
    )
    per = per.filter(F.col("change_dt").isNotNull())
    return per.select(
        "policy_id", "initial_code", "current_code", F.date_format("change_dt", "MMM").alias("change_month"), "change_dt",
        F.when(F.col("_now") & F.col("policy_id").isNotNull(), 0).otherwise(1).alias("cancel_flag"), transition_bucket(from_code, none_code, label).alias("bucket"),
    )


def counts_by_month(runs: DataFrame, by: Sequence[str] = ("pol_form_cd", "pol_status_cd"), name: str = "policies") -> DataFrame:
    """(me_dt, <by>, <name>): policies per month end and group, from the runs' ends: +1
    where a run begins, -1 in the month after it ends, then a running sum over the
    calendar. No row per policy and month is made; groups without policies in a month
    have no row."""
    ends = F.explode(F.array(F.struct(month_number("from_me").alias("at"), F.lit(1).alias("step")), F.struct((month_number("to_me") + 1).alias("at"), F.lit(-1).alias("step"))))
    steps = runs.select(*by, ends.alias("e")).groupBy(*by, F.col("e.at").alias("at")).agg(F.sum("e.step").alias("step"))
    w = Window.partitionBy(*by).orderBy("at")
    level = steps.withColumn(name, F.sum("step").over(w)).withColumn("_next", F.lead("at").over(w))
    # between two steps the count stays: one row per month of the calendar and group
    held = level.filter(F.col(name) > 0).withColumn("at", F.explode(F.sequence("at", F.col("_next") - 1)))
    return held.select(month_end("at").alias("me_dt"), *by, F.col(name).cast("bigint").alias(name))
