"""Visual step pipelines as chained DataFrame transforms.

A payload is ``{"source_dataset": name, "steps": [{"type", "config"}, ...]}``.
Each step is folded into a lazy DataFrame, so the whole chain is a single
logical plan: Catalyst prunes the ``SELECT *`` of every step down to the
columns the last step needs, pushes filters into the scan, and picks the join
strategy from statistics (AQE re-plans with measured sizes, splits skewed
join partitions).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

Resolver = Callable[[str], DataFrame]

# Filter operator names and their SQL meaning.
FILTER_OPERATORS = ("EQUALS", "GREATER_THAN", "LESS_THAN", "CONTAINS", "IS_NOT_NULL")
# Join types that form valid SQL in the step language.
JOIN_TYPES = {"INNER": "inner", "LEFT": "left", "RIGHT": "right", "FULL": "full",
              "LEFT OUTER": "left", "RIGHT OUTER": "right", "FULL OUTER": "full"}


def filter_condition(column: str, operator: str | None, value=None) -> Column:
    """P1 condition.  Unknown operators fall back to equality.

    ``CONTAINS`` is ``LIKE '%value%'``: ``%`` and ``_`` inside the value keep
    their wildcard meaning, as in the step language.
    """
    c = F.col(column)
    if operator == "CONTAINS":
        return c.like(f"%{value}%")
    if operator == "IS_NOT_NULL":
        return c.isNotNull()
    if operator == "GREATER_THAN":
        return c > F.lit(value)
    if operator == "LESS_THAN":
        return c < F.lit(value)
    return c == F.lit(value)


def step_filter(df: DataFrame, column: str, operator: str | None = None,
                value=None) -> DataFrame:
    """P1 FILTER step."""
    return df.filter(filter_condition(column, operator, value))


def step_join(df: DataFrame, right: DataFrame, how: str = "LEFT",
              left_key: str | None = None, right_key: str | None = None,
              right_prefix: str = "r_", skew_safe: bool | None = None) -> DataFrame:
    """J1 JOIN step: ``L.*, R.*`` on one equality key.

    Right-side columns whose names clash with the left get ``right_prefix``
    (a DataFrame cannot carry two columns with one name downstream).

    ``skew_safe`` (default: on for FULL, off otherwise) builds an outer join
    from parts adaptive execution can split when one key holds a large share
    of the rows: the inner join (skew-split on both sides) plus the unmatched
    rows of each preserved side (an anti join against the other side's
    distinct keys, which collapse a hot key to one row per task before the
    shuffle).  A plain full outer join cannot be split at all, and a plain
    left / right join only on its preserved side.
    """
    kind = JOIN_TYPES.get((how or "LEFT").upper())
    if kind is None:
        raise ValueError(f"unsupported join type {how!r}")
    left_cols = set(df.columns)
    renamed = right.select(*[
        F.col(c).alias(f"{right_prefix}{c}" if c in left_cols else c)
        for c in right.columns])
    rk = f"{right_prefix}{right_key}" if right_key in left_cols else right_key
    if skew_safe is None:
        skew_safe = kind == "full"
    if kind == "inner" or not skew_safe:
        return df.join(renamed, df[left_key] == renamed[rk], kind)
    return _outer_in_parts(df, renamed, left_key, rk, kind)


def _outer_in_parts(left: DataFrame, right: DataFrame, lk: str, rk: str,
                    kind: str) -> DataFrame:
    """``left <kind> JOIN right`` = inner join + unmatched preserved rows."""
    parts = [left.join(right, left[lk] == right[rk], "inner")]
    if kind in ("left", "full"):
        keys = right.select(F.col(rk).alias("_k")).distinct()
        only = left.join(keys, left[lk] == keys["_k"], "left_anti")
        parts.append(only.select(*left.columns, *[
            F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]))
    if kind in ("right", "full"):
        keys = left.select(F.col(lk).alias("_k")).distinct()
        only = right.join(keys, right[rk] == keys["_k"], "left_anti")
        parts.append(only.select(*[
            F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields],
            *right.columns))
    return reduce(lambda a, b: a.unionByName(b), parts)


def aggregation_column(function: str, column: str, alias: str | None = None) -> Column:
    """A1 aggregate: any SQL aggregate over the column text.

    The column text is free SQL, so ``DISTINCT x`` gives a distinct count.
    The alias defaults to ``lower(function_column)``.
    """
    name = alias or f"{function}_{column}".lower()
    return F.expr(f"{function}({column})").alias(name)


def step_aggregate(df: DataFrame, group_by: Sequence[str] = (),
                   aggregations: Sequence[Mapping] = ()) -> DataFrame:
    """A1 AGGREGATE step; an empty group list gives one global row."""
    aggs = [aggregation_column(a["function"], a["column"], a.get("alias"))
            for a in aggregations]
    if not aggs:
        return df.select(*group_by).distinct()
    return df.groupBy(*group_by).agg(*aggs)


def apply_step(df: DataFrame, step: Mapping, resolve: Resolver) -> DataFrame:
    """Apply one ``{type, config}`` step.  Unknown types pass through."""
    kind = step["type"]
    config = step.get("config", {}) or {}
    if kind == "FILTER":
        return step_filter(df, config.get("column"), config.get("operator"),
                           config.get("value"))
    if kind == "JOIN":
        return step_join(df, resolve(config.get("right_dataset")),
                         config.get("type", "LEFT"), config.get("left_key"),
                         config.get("right_key"))
    if kind == "AGGREGATE":
        return step_aggregate(df, config.get("group_by", []),
                              config.get("aggregations", []))
    log.warning("unsupported step type %s; passing rows through", kind)
    return df


def run_steps(payload: Mapping, resolve: Resolver) -> DataFrame:
    """Fold the steps over the source dataset into one lazy plan."""
    source = resolve(payload["source_dataset"])
    return reduce(lambda acc, s: apply_step(acc, s, resolve),
                  payload.get("steps", []) or [], source)
