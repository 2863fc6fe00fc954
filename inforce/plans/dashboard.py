"""The underwriting dashboard build as one job with a materialisation point.

The source built a transient table (cohort extraction -> policy x month
rollup -> dirty-flag update) and let the BI layer compute running loss
ratios, relativities and shares from it. Here the rollup is written once to
the cluster's shared folder (``spark.checkpoint.dir``) and the three reports
read it back: the expensive joins run once, later stages restart from the
written table after an executor loss instead of recomputing the lineage.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inforce.operators import loss as L
from inforce.plans.loss_plans import uw_fixed
from inforce.session import ensure_checkpoint_dir
from inforce.sources.stored import StoredTable


def build_uw_dashboard(spark: SparkSession, sf_dir: str, name: str = "uw_rollup") -> dict[str, DataFrame]:
    """Write the reclassified rollup, then return the reports computed from it."""
    table = StoredTable(spark, os.path.join(ensure_checkpoint_dir(spark), name), "risk_st")
    table.overwrite(uw_fixed(spark, sf_dir))  # readers of the last build keep its files
    rollup = table.read()
    seg = rollup.withColumn("segment", L.segment_label())
    return {
        "running_ratio": L.running_ratio(rollup),
        "relativity": L.relativity(seg, ["risk_st", "segment"], ["risk_st"], business_type="Renewal"),
        "share": L.share_of_total(seg, ["segment", "pol_type"], "epapr"),
        "policies_per_state": rollup.groupBy("risk_st").agg(F.countDistinct("pol_id").alias("pol_cnt")),
    }
