"""Allocation of model predictions, allocation checks, joined updates and
reconciliation between datasets (W16-W20).

Scale notes
-----------
* The exposure share is a window over (period, policy, coverage) on rows that the
  join has partitioned by period: no exchange of its own, and no skew-prone key.
* Reconciliation totals are aggregated on each side *before* they meet, so
  the join is between two small aggregates (partial aggregation happens
  map-side), never between the raw tables.
* The joined update sums the source to its key first, and target rows that
  repeat a key share its value, so totals are kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inforce.functions.columns import null_safe_parts, pct_diff_signed, pct_diff_symmetric, round_half_up

# Coverage code in the loss data -> model coverage (prediction and
# exposure columns are ``adj_<m>_pp_pred`` and ``<m>_exposure``).
COVERAGE_MAP = {"BI": "bi", "COLL": "coll", "COMP": "comp", "MED": "mp", "PD": "pd", "PIP": "pip", "UMBI": "um"}
MODEL_COVERAGES = ["bi", "coll", "comp", "mp", "pd", "pip", "um"]


def exact_sum(c: str) -> Column:
    """The sum of doubles as decimals of ten places: independent of the order of rows."""
    return F.sum(F.col(c).cast("decimal(28,10)")).cast("double")


def _as(c: Column, t: str | None) -> Column:
    return c if t is None else c.cast(t)


# --------------------------------------------------------------------------- W16
def allocate_prediction(
    loss: DataFrame,
    model: DataFrame,
    keys: Sequence[str] = ("pol_id", "pol_prd_id", "cov_type_abbr"),
    ee_col: str = "ee",
    period_col: str = "pol_prd_id",
    model_key: str = "cv_plcy_period_id",
    digits: int | None = None,
) -> DataFrame:
    """Spread each period-level coverage prediction over the period's month rows
    in proportion to earned exposure (``ttl_cov_ee``: the group's exposure); add the
    total over the seven coverages. Without exposure the share, and what is allocated,
    is NULL; the total is NULL too for unrounded values (``digits=None``), while with
    rounding a NULL counts as 0 in it."""
    # the source compares the two ids as text; when both sides already have the
    # same type the native key is equivalent and hashes faster
    same = dict(loss.dtypes)[period_col] == dict(model.dtypes)[model_key]
    key_type = None if same else "string"
    m = model.select(
        _as(F.col(model_key), key_type).alias("_mk"),
        *[F.col(f"adj_{c}_pp_pred") for c in MODEL_COVERAGES],
        *[F.col(f"{c}_exposure") for c in MODEL_COVERAGES],
    )
    j = loss.withColumn("_lk", _as(F.col(period_col), key_type)).join(m, F.col("_lk") == F.col("_mk"), "inner")
    # total exposure per (policy, period, coverage): the joined rows are already
    # partitioned by period, so the window needs no exchange of its own; a group is
    # the months of one period
    w = Window.partitionBy("_lk", *[k for k in keys if k != period_col])
    j = j.withColumn("ttl_cov_ee", F.sum(ee_col).over(w))
    total_ee = F.col("ttl_cov_ee").cast("double")
    share = F.when(total_ee == 0, F.lit(None).cast("double")).otherwise(F.col(ee_col).cast("double") / total_ee)
    j = j.withColumn("ee_percent", share)
    alloc = []
    for code, c in COVERAGE_MAP.items():
        v = F.when(
            F.col("cov_type_abbr") == code, F.col("ee_percent") * F.col(f"adj_{c}_pp_pred") * F.col(f"{c}_exposure")
        ).otherwise(F.lit(0.0))
        alloc.append((round_half_up(v, digits) if digits is not None else v).alias(f"adj_{c}_pp"))
    j = j.select(F.col("*"), *alloc)
    total = None
    for c in MODEL_COVERAGES:
        v = F.col(f"adj_{c}_pp") if digits is None else F.coalesce(F.col(f"adj_{c}_pp"), F.lit(0.0))
        total = v if total is None else total + v
    return j.withColumn("adj_ttl_pp", total).drop("_lk", "_mk")


def model_values(model: DataFrame, model_key: str = "cv_plcy_period_id", key_type: str | None = "string") -> DataFrame:
    """Per-period model value per coverage: prediction x exposure, and the total."""
    cols = [(F.col(f"adj_{c}_pp_pred") * F.col(f"{c}_exposure")).alias(f"{c}_ulm") for c in MODEL_COVERAGES]
    df = model.select(_as(F.col(model_key), key_type).alias("pol_prd_id"), *cols)
    total = None
    for c in MODEL_COVERAGES:
        total = F.col(f"{c}_ulm") if total is None else total + F.col(f"{c}_ulm")
    return df.withColumn("ttl_ulm", total)


# --------------------------------------------------------------------------- W17
def allocation_check(alloc: DataFrame, model: DataFrame, tol: float = 0.02, within: bool = True) -> DataFrame:
    """Re-sum the allocation per period and compare with the model value per
    coverage; keep periods where every coverage is within ``tol`` (or, with
    ``within=False``, where any coverage is outside it)."""
    # ids are compared as text (as the source does); with equal native types the
    # native key is equivalent, and the text form is produced only for the output
    same = dict(alloc.dtypes)["pol_prd_id"] == dict(model.dtypes)["cv_plcy_period_id"]
    key_type = None if same else "string"
    op = alloc.groupBy(_as(F.col("pol_prd_id"), key_type).alias("pol_prd_id")).agg(
        *[exact_sum(f"adj_{c}_pp").alias(f"{c}_op") for c in MODEL_COVERAGES], exact_sum("adj_ttl_pp").alias("ttl_op")
    )
    j = op.join(model_values(model, key_type=key_type), "pol_prd_id", "inner")
    ok = None
    for c in MODEL_COVERAGES:
        cond = F.abs(F.col(f"{c}_op") - F.col(f"{c}_ulm")) <= tol
        ok = cond if ok is None else ok & cond
    j = j.filter(ok if within else ~ok)
    out = [F.col("pol_prd_id").cast("string").alias("pol_prd_id")]
    for c in [*MODEL_COVERAGES, "ttl"]:
        out += [round_half_up(f"{c}_op", 4).alias(f"{c}_op"), round_half_up(f"{c}_ulm", 4).alias(f"{c}_ulm")]
    return j.select(*out)


# --------------------------------------------------------------------------- W18
def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    cols: Mapping[str, float],
    null_safe: Sequence[str] = (),
    share: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``ALTER TABLE ADD COLUMN c DEFAULT d`` + ``UPDATE target FROM source``.

    The source is summed to one row per key. Target rows that repeat a key share
    its value, in proportion to ``share`` (a column of the target), or equally where
    there is none or it adds up to nothing: an update keeps the source's total. Keys
    listed in ``null_safe`` match NULL to NULL; rows without a source row get the
    default. With ``partitions`` both sides are dealt by the keys into so many tasks
    (see ``partitions_for``)."""
    # a window, an aggregation and a join on the same columns: NULL keys as a flag and
    # a stand-in, so that all three share one partitioning of each side
    types = {f.name: f.dataType for f in target.schema.fields}
    names, of_target, of_source = [], [], []
    for i, k in enumerate(keys):
        flag, value = null_safe_parts(F.col(k), types[k])
        names += [f"_kf{i}", f"_kv{i}"] if k in null_safe else [f"_kv{i}"]
        plain = F.col(k)
        of_target += [flag.alias(f"_kf{i}"), value.alias(f"_kv{i}")] if k in null_safe else [plain.alias(f"_kv{i}")]
        flag, value = null_safe_parts(F.col(k).cast(types[k]), types[k])
        of_source += [flag.alias(f"_kf{i}"), value.alias(f"_kv{i}")] if k in null_safe else [plain.cast(types[k]).alias(f"_kv{i}")]

    def dealt(df: DataFrame) -> DataFrame:
        return df if partitions is None else df.repartition(partitions, *names)

    src = dealt(source.select(*of_source, *cols)).groupBy(*names).agg(*[exact_sum(c).alias(f"_src_{c}") for c in cols])
    w = Window.partitionBy(*names)
    equal = F.lit(1.0) / F.count(F.lit(1)).over(w)
    if share is None:
        part = equal
    else:
        whole = F.sum(share).over(w).cast("double")
        part = F.when(F.coalesce(whole, F.lit(0.0)) == 0, equal).otherwise(F.coalesce(F.col(share).cast("double"), F.lit(0.0)) / whole)
    j = dealt(target.select("*", *of_target)).withColumn("_part", part).join(src, names, "left")
    kept = [F.col(c) for c in target.columns if c not in cols]
    return j.select(*kept, *[F.coalesce(F.col(f"_src_{c}") * F.col("_part"), F.lit(default)).alias(c) for c, default in cols.items()])


# --------------------------------------------------------------------------- W19
def reconcile_metric(
    left: DataFrame,
    right: DataFrame,
    metric_l: str,
    metric_r: str,
    keys: Sequence[Column | str] = (),
    names: tuple[str, str] = ("left_total", "right_total"),
    digits: int = 2,
) -> DataFrame:
    """Totals of a metric on two datasets at a grain (none, year, year+month),
    with the signed percent difference (right - left) / left × 100."""
    kcols = [F.col(k) if isinstance(k, str) else k for k in keys]
    kn = [f"_g{i}" for i in range(len(kcols))]
    a = left.groupBy(*[c.alias(n) for c, n in zip(kcols, kn)]).agg(F.round(F.sum(metric_l), digits).alias(names[0]))
    b = right.groupBy(*[c.alias(n) for c, n in zip(kcols, kn)]).agg(F.round(F.sum(metric_r), digits).alias(names[1]))
    if kn:
        j = a.join(b, kn, "inner")
    else:
        # grand totals: one scalar subquery per side, no join at all
        j = a.select(F.col(names[0]), b.select(names[1]).scalar().alias(names[1]))
    return j.select(
        *kn, F.col(names[0]).cast("double").alias(names[0]), F.col(names[1]).cast("double").alias(names[1]),
        pct_diff_signed(F.col(names[0]), F.col(names[1]), 2).alias("pct_diff"),
    )


def reconcile_all(
    left: DataFrame,
    right: DataFrame,
    metrics: Mapping[str, tuple[str, str]],
    date_col: str,
    digits: int = 2,
) -> DataFrame:
    """Every metric at every grain (all, year, month) from one scan of each side.

    ``metrics``: name -> (column on the left, column on the right). Each side is summed
    once to the months, as exact decimals; years and the total are sums of those few
    rows (grouping sets), so no row of the data is expanded. The result is long:
    metric, grain, year_earned, month_earned (NULL where the grain has none),
    left_total, right_total, pct_diff. A year or month that only one side has gives no
    row, nor does a missing date at those grains; it counts in the total."""

    def side(df: DataFrame, which: int) -> DataFrame:
        months = df.groupBy(F.year(date_col).alias("y"), F.month(date_col).alias("m")).agg(*[F.sum(pair[which]).alias(name) for name, pair in metrics.items()])
        sums = [F.sum(name).alias(name) for name in metrics]
        g = months.groupingSets([[], ["y"], ["y", "m"]], "y", "m").agg(F.grouping_id().alias("g"), *sums)
        g = g.filter((F.col("g") == 3) | F.col("y").isNotNull())
        # stand-ins for what a grain does not have: a plain equi-join
        rows = F.explode(F.array(*[F.struct(F.lit(name).alias("metric"), F.round(F.col(name), digits).cast("double").alias("total")) for name in metrics])).alias("r")
        return g.select("g", F.coalesce("y", F.lit(-1)).alias("y"), F.coalesce("m", F.lit(-1)).alias("m"), rows).select("g", "y", "m", "r.metric", "r.total")

    one = side(left, 0).withColumnRenamed("total", "left_total")
    other = side(right, 1).withColumnRenamed("total", "right_total")
    j = one.join(other, ["metric", "g", "y", "m"])
    return j.select(
        "metric", F.when(F.col("g") == 3, "all").when(F.col("g") == 1, "year").otherwise("month").alias("grain"),
        F.when(F.col("y") >= 0, F.col("y")).alias("year_earned"), F.when(F.col("m") >= 0, F.col("m")).alias("month_earned"),
        "left_total", "right_total", pct_diff_signed(F.col("left_total"), F.col("right_total"), 2).alias("pct_diff"),
    )


# --------------------------------------------------------------------------- W20
def at_latest(snapshot: DataFrame, latest: DataFrame | None = None, when_col: str = "me_dt") -> DataFrame:
    """The rows of the latest snapshot; ``latest``: one row, one column, with its date."""
    latest = snapshot.agg(F.max(when_col)) if latest is None else latest
    return snapshot.filter(F.col(when_col) == latest.scalar())


def snapshot_vs_history_counts(
    snapshot: DataFrame,
    history_latest: DataFrame,
    by: str = "rate_plan_cd",
    snap_key: str = "policy_id",
    hist_key: str = "pol_id",
    snapshot_filter: Column | None = None,
    latest: DataFrame | None = None,
) -> DataFrame:
    """Distinct counts per ``by`` from the latest snapshot and from the latest
    history row per policy; symmetric % difference and absolute difference.
    ``latest``: one row with the latest snapshot date; without it the snapshots are
    read once more to find it. As a scalar it is a filter on the month, which goes
    below the snapshot's window and into the scan of a stored one."""
    snap = at_latest(snapshot, latest)
    if snapshot_filter is not None:
        snap = snap.filter(snapshot_filter)
    a = snap.groupBy(by).agg(F.countDistinct(snap_key).alias("mif_cnt"))
    b = history_latest.groupBy(by).agg(F.countDistinct(hist_key).alias("per_cnt"))
    j = a.join(b, by, "inner")
    return j.select(
        by, "mif_cnt", "per_cnt",
        pct_diff_symmetric(F.col("mif_cnt"), F.col("per_cnt"), 2).alias("pct_diff"),
        F.abs(F.col("mif_cnt") - F.col("per_cnt")).alias("diff_cnt"),
    )
