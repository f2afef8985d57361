"""Registry of named plans over the driver tables.

``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame; ``ORACLE[name]`` is
the same result written as plain SQL over the driver's tables.  Every plan
reads whole tables: no id subsets, samples or row caps, except where the
limit is the feature itself (top-k).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLE: dict[str, str] = {}


def plan(name: str, oracle: str | None = None):
    """Register a plan builder under ``name`` with its SQL oracle (if any)."""

    def wrap(fn: Plan) -> Plan:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return wrap
