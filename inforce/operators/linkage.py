"""Cross-line linkage and enrichment: crosswalk between product lines,
household credit flags, attribute mismatches, line stacking, quote funnel,
rule enrichment, premium/in-force breakdowns (W28, W29, W33, W34, W36,
W42, W43).

Scale notes
-----------
* Multi-hop chains are plain inner joins; Catalyst reorders nothing across
  them but AQE turns each into a broadcast hash join when one side is small
  at run time (e.g. the other-line quote table), which also neutralises a
  hot link key: the large side is never shuffled on it.
* A DISTINCT over a chain is replaced by de-duplicating each side on the
  columns it contributes. When every join key is kept in the output (or is
  determined by a kept column), ``distinct(π(A ⋈ B)) = distinct(π(A)) ⋈
  distinct(π(B))`` and the join of distinct sides is already distinct — so
  the big chain output is never aggregated, and a policy's many terms are not
  multiplied by its many quotes first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inforce.operators.reconcile import at_latest


def try_decimal_id(col: str | Column) -> Column:
    """``TRY_TO_DECIMAL(id)``: numeric ids -> decimal(38,0), anything else -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("decimal(38,0)")


# --------------------------------------------------------------------------- W28
def crosswalk(
    start: DataFrame,
    quotes_from: DataFrame,
    link: DataFrame,
    quotes_to: DataFrame,
    inforce_to: DataFrame,
    link_from: str,
    link_to: str,
    start_label: str,
    end_label: str,
) -> DataFrame:
    """Policy -> its quotes -> party link -> other-line quotes -> other-line
    policy, kept when that policy is in force (ids compared as decimals, so
    non-numeric ids never match). ``start`` has ``pol_id``; quote tables have
    ``qcn, pol_id`` (+ ``qte_dt``); ``inforce_to`` has ``pol_id``."""
    # each side de-duplicated on what it contributes; all join keys are kept in
    # the output, so the chain is distinct without a DISTINCT over its rows
    s = start.select(F.col("pol_id").alias("start_pol_id")).distinct()
    qa = quotes_from.select(F.col("pol_id").alias("start_pol_id"), F.col("qcn").alias("start_qcn"),
                            F.col("qte_dt").alias("start_orig_qte_dt")).distinct()
    lk = link.select(F.col(link_from).alias("start_qcn"), F.col(link_to).alias("end_qcn")).distinct()
    qb = quotes_to.select(F.col("qcn").alias("end_qcn"), F.col("pol_id").alias("end_pol_id"),
                          F.col("qte_dt").alias("end_orig_qte_dt")).distinct()
    inf = inforce_to.select(try_decimal_id("pol_id").alias("_inf")).filter(F.col("_inf").isNotNull())
    chain = s.join(qa, "start_pol_id").join(lk, "start_qcn").join(qb, "end_qcn").filter(F.col("end_pol_id").isNotNull())
    chain = chain.join(inf, try_decimal_id("end_pol_id") == F.col("_inf"), "left_semi")
    return chain.select(
        F.lit(start_label).alias("pol_start"), "start_pol_id", "start_orig_qte_dt", "start_qcn", "end_qcn",
        "end_orig_qte_dt", "end_pol_id", F.lit(end_label).alias("pol_end"),
    )


def quote_pairs(auto_quotes: DataFrame, link: DataFrame, home_quotes: DataFrame) -> DataFrame:
    """The linked quotes of both lines that name a policy: (auto_qcn, auto_pol_id,
    auto_dt, home_qcn, home_pol_id, home_dt), distinct. Both directions of the
    crosswalk start from this table."""
    def side(quotes: DataFrame, line: str) -> DataFrame:
        return quotes.select(F.col("qcn").alias(f"{line}_qcn"), F.col("pol_id").alias(f"{line}_pol_id"), F.col("qte_dt").alias(f"{line}_dt")).filter(F.col(f"{line}_pol_id").isNotNull())

    # one distinct over the pairs: their rows are few beside the quotes' (every pair needs a link)
    return side(auto_quotes, "auto").join(link.select("auto_qcn", "home_qcn"), "auto_qcn").join(side(home_quotes, "home"), "home_qcn").distinct()


def crosswalk_from_pairs(pairs: DataFrame, start: DataFrame, inforce_to: DataFrame, line: str, other: str, labels: tuple[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Policies of ``start`` (``pol_id`` and the ``keep`` columns) with their quotes of
    ``line``, the linked quotes of the ``other`` line, and that line's policy, where it
    is in force (ids compared as decimals, so non-numeric ids never match)."""
    s = start.select(F.col("pol_id").alias(f"{line}_pol_id"), *keep).distinct()
    inf = inforce_to.select(try_decimal_id("pol_id").alias("_inf")).filter(F.col("_inf").isNotNull())
    chain = pairs.join(s, f"{line}_pol_id").join(inf, try_decimal_id(f"{other}_pol_id") == F.col("_inf"), "left_semi")
    return chain.select(
        F.lit(labels[0]).alias("pol_start"), F.col(f"{line}_pol_id").alias("start_pol_id"), *keep, F.col(f"{line}_dt").alias("start_orig_qte_dt"),
        F.col(f"{line}_qcn").alias("start_qcn"), F.col(f"{other}_qcn").alias("end_qcn"), F.col(f"{other}_dt").alias("end_orig_qte_dt"),
        F.col(f"{other}_pol_id").alias("end_pol_id"), F.lit(labels[1]).alias("pol_end"),
    )


# --------------------------------------------------------------------------- W29
def household_credit_issues(
    linked: DataFrame,
    future_start,
    future_end,
    hist_cutoff,
) -> DataFrame:
    """Priority flags on linked (line A, line B) policy pairs.

    FUTURE_IND: renewing in [future_start, future_end] with a credit conflict
    (both in force and either indicator 'N', or only A in force with 'Y').
    ACCT_ISSUE_IND: evaluated in order — older A terms (<= hist_cutoff) that
    are not future-flagged are forced to 0 first (kept as in the source)."""
    a_in = F.col("auto_status") == "InForce"
    h_in = F.col("home_status") == "InForce"
    a_left = F.col("auto_status") == "Left"
    h_left = F.col("home_status") == "Left"
    a_y, a_n = F.col("auto_acct_cr_ind") == "Y", F.col("auto_acct_cr_ind") == "N"
    h_y, h_n = F.col("home_acct_cr_ind") == "Y", F.col("home_acct_cr_ind") == "N"
    conflict = a_in & ((h_in & (a_n | h_n)) | (h_left & a_y))
    eff = F.col("auto_eff_dt")
    future = F.when(conflict & (eff >= F.lit(future_start)) & (eff <= F.lit(future_end)), 1).otherwise(0)
    df = linked.withColumn("future_ind", future)
    issue = (
        F.when((eff <= F.lit(hist_cutoff)) & (F.col("future_ind") == 0), 0)
        .when(conflict, 1)
        .when(h_in & a_left & h_y, 1)
        .when(a_left & h_left & (a_y | h_y), 1)
        .otherwise(0)
    )
    return df.withColumn("acct_issue_ind", issue)


# --------------------------------------------------------------------------- W42
def attribute_mismatch(connected: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Row count of the de-duplicated linked table and, per attribute pair, the
    rows where the two sides differ (``<>``: NULL pairs do not count), plus
    rows differing in any pair."""
    aggs = [F.count(F.lit(1)).alias("total_cnt")]
    any_diff = None
    for a, b in pairs:
        d = F.col(a) != F.col(b)
        aggs.append(F.count_if(d).alias(f"{a}_diff_cnt"))
        any_diff = d if any_diff is None else (any_diff | d)
    aggs.append(F.count_if(any_diff).alias("any_diff_cnt"))
    return connected.agg(*aggs)


# --------------------------------------------------------------------------- W33
def stack_lines(
    cohort: DataFrame,
    line_a: DataFrame,
    line_b: DataFrame,
    columns: dict[str, tuple[str | None, str | None]],
    key: str = "pol_id",
) -> DataFrame:
    """Left-join the cohort to two product lines (latest row each) and coalesce
    the matching columns into one schema (line A wins). ``columns`` maps the
    output name to (column in A or None, column in B or None). Rows matching
    neither line are dropped (``pol_type`` NULL)."""
    a = line_a.select(F.col(key).alias("_ka"), *[F.col(ca).alias(f"_a_{o}") for o, (ca, _) in columns.items() if ca])
    b = line_b.select(F.col(key).alias("_kb"), *[F.col(cb).alias(f"_b_{o}") for o, (_, cb) in columns.items() if cb])
    j = cohort.join(a, cohort[key] == a._ka, "left").join(b, cohort[key] == b._kb, "left")
    out = [F.col(c) for c in cohort.columns]
    for o, (ca, cb) in columns.items():
        parts = ([F.col(f"_a_{o}")] if ca else []) + ([F.col(f"_b_{o}")] if cb else [])
        out.append((F.coalesce(*parts) if len(parts) > 1 else parts[0]).alias(o))
    return j.select(*out).filter(F.col("pol_type").isNotNull())


# --------------------------------------------------------------------------- W34
def quote_funnel(
    latest_quotes: DataFrame,
    rater: DataFrame,
    first_terms: DataFrame,
    quote_flow: DataFrame | None = None,
) -> DataFrame:
    """Latest quote row + per-quote max response/issue counts + comparative
    rater (left) + the policy's first term persistency (left) + match flag.
    When ``quote_flow`` is given the counts are aggregated from it; otherwise
    ``latest_quotes`` already carries them (see ``selection.latest_with_aggs``)."""
    a = latest_quotes
    if quote_flow is not None:
        agg = quote_flow.groupBy("qcn").agg(
            F.max("resp_ind_cnt").alias("resp_ind_cnt"), F.max("iss_ind_cnt").alias("iss_ind_cnt")
        )
        a = latest_quotes.join(agg, "qcn", "inner")
    c = first_terms.withColumnRenamed("pol_id", "policy_id")
    j = a.join(rater, "qcn", "left").join(c, a.pol_id == c.policy_id, "left")
    return j.withColumn("pol_cnt_issue_match", F.when(F.col("pol_id") == F.col("policy_id"), 1).otherwise(0))


# --------------------------------------------------------------------------- W36
def enrich_rules(hits: DataFrame, ref: DataFrame, terms: DataFrame, rule_col: str = "uw_ref_decl_rule_id") -> DataFrame:
    """Rule hits + reference text (left join on rule id) + term attributes
    (inner join on policy id and effective date)."""
    j = hits.join(ref, hits[rule_col] == ref["rule_id"], "left").drop("rule_id")
    return j.join(terms, ["pol_id", "pol_eff_dt"], "inner")


# --------------------------------------------------------------------------- W43
def premium_by(df: DataFrame, dims: Sequence[str], measure: str) -> DataFrame:
    return df.groupBy(*dims).agg(F.sum(measure).alias(f"sum_{measure}"))


def inforce_by_status(snapshot: DataFrame, statuses: Sequence[str], key: str = "policy_id", latest: DataFrame | None = None) -> DataFrame:
    """Distinct ids by plan x status on the latest snapshot. The status test is
    parenthesised, so every status is restricted to the latest snapshot. ``latest``:
    one row with its date; without it the snapshots are read once more."""
    snap = at_latest(snapshot, latest).filter(F.col("pol_status_cd").isin(list(statuses)))
    return snap.groupBy("rate_plan_cd", "pol_status_cd").agg(F.countDistinct(key).alias("cnt"))
