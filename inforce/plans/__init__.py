"""Registered queries: importing this package fills ``QUERIES`` / ``ORACLES``."""

from inforce.plans import (  # noqa: F401
    campaign_plans,
    event_plans,
    linkage_plans,
    loss_plans,
    maintenance_plans,
    persistency_plans,
    reconcile_plans,
    segment_plans,
    stored_plans,
)
from inforce.plans.registry import ORACLES, QUERIES, finalize, register  # noqa: F401
