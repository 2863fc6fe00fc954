"""Definitions shared by several plan modules: the latest persistency row per
policy (DataFrame and SQL twin) and the oracle-SQL composer."""

from __future__ import annotations

from inforce.operators import selection as SEL
from inforce.plans.persistency_plans import pers
from inforce.sources import staging as S

A = S.AS_OF_SQL
LATEST = "row_number() OVER (PARTITION BY pol_id ORDER BY pol_eff_dt DESC NULLS FIRST, pol_prd_id DESC NULLS FIRST)"


def _sql(body, extra, base=("term",)):
    return S.with_ctes(list(base), body, extra)


def latest_pers(spark, d):
    return SEL.latest_by_key(pers(spark, d), ["pol_id"], ["pol_eff_dt"], ["pol_prd_id"])


LATEST_PERS_SQL = f"latest_pers AS (SELECT * EXCLUDE (rn) FROM (SELECT *, {LATEST} AS rn FROM pers) WHERE rn = 1)"
