"""The persistency table build (term history + development flags + ultimate
cancellations) as one job with a materialisation point.

The source created this table once (CTAS) and ran its yearly premium-change
report from it. Here the table is written to the cluster's shared folder
(``spark.checkpoint.dir``) and the reports read it back, so an executor loss
after the write never recomputes the term-history windows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inforce.operators import persistency as P
from inforce.plans.persistency_plans import history, yearly_change
from inforce.session import ensure_checkpoint_dir
from inforce.sources import staging as S
from inforce.sources.stored import StoredTable


def build_persistency_table(spark: SparkSession, sf_dir: str, name: str = "persistency", rewritten: bool = False) -> dict[str, DataFrame]:
    """Write history + flags + ultimate cancellations, then the reports from the written
    table. ``rewritten``: first terms of policies that replaced another one are
    renewals, compared with the replaced policy's latest premium."""
    terms = S.renewal_terms(spark, sf_dir) if rewritten else S.term(spark, sf_dir)
    keep = [c for c in terms.columns if c != "replaced_prem"]
    lagged = history(spark, sf_dir, keep=keep, terms=terms, previous_prem="replaced_prem" if rewritten else None).drop("cancel_flag")
    flat = F.coalesce((F.col("canc_eff_dt") == F.col("pol_eff_dt")).cast("int"), F.lit(0))
    flags = P.development_flags(lagged, S.AS_OF, flat_cancel=flat)
    stored = StoredTable(spark, os.path.join(ensure_checkpoint_dir(spark), name), "risk_st")
    stored.overwrite(P.ultimate_cancel(flags, S.dev_factors(spark), factor_rows=len(S.dev_factor_rows())))
    t = stored.read()
    change = yearly_change(t)
    return {
        "table": t,
        "premium_change_by_year": change,
        "ultimate": t.groupBy("persistency_period").agg(
            F.sum("ult_canc_cnt").alias("ult_canc_cnt"), F.sum("ult_atr_cnt").alias("ult_atr_cnt")
        ),
    }
