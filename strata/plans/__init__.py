"""Named plans over the driver tables (queries + SQL oracles)."""

from strata.plans import (contract_plans, graph_plans, history_plans, landing_plans, reconcile_plans,  # noqa: F401
                          rules_plans, state_plans, steps_plans, telemetry_plans, write_plans)
from strata.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
