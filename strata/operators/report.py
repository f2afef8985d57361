"""Audit report, audit pass rate, daily cost roll-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default report size and status selection.
REPORT_DEFAULT = 50
DEFAULT_STATUSES = ("PASS", "FAIL")


def audit_report(audit: DataFrame, statuses: Sequence[str] = (), n: int = REPORT_DEFAULT,
                 tie_break: Sequence[str] = ("row_key", "rule_id", "audit_id")) -> DataFrame:
    """Audit rows with a status in ``statuses``, newest first, first ``n``.

    The limit is the feature (a top-n report): Spark plans it as a per-task
    top-n followed by one small merge (TakeOrderedAndProject), never a full
    sort of the audit table.  ``tie_break`` makes the order total.
    """
    chosen = list(statuses) or list(DEFAULT_STATUSES)
    order = [F.col("evaluated_at").desc()] + [F.col(c).desc() if i == 0 else F.col(c)
                                              for i, c in enumerate(tie_break)
                                              if c in audit.columns]
    return audit.filter(F.col("status").isin(chosen)).orderBy(*order).limit(n)


def audit_stats(audit: DataFrame) -> DataFrame:
    """PASS / FAIL / WARN counts and pass rate in percent (0 when empty)."""
    s = F.col("status")
    return audit.agg(
        F.count_if(s == "PASS").alias("passed"),
        F.count_if(s == "FAIL").alias("failed"),
        F.count_if(s == "WARN").alias("warned"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn(
        "pass_pct",
        F.when(F.col("total") == 0, F.lit(0.0))
        .otherwise(F.round(F.col("passed") * 100.0 / F.col("total"), 2)))


def daily_cost(billing: DataFrame, service: str | None = None, day=None,
               ts: str = "usage_start_time", cost: str = "cost",
               service_field: str = "service.description") -> DataFrame:
    """sum(cost) per usage date, optionally one service and one day.

    The service filter reads a struct field; the day filter compares the date
    so a date-partitioned billing table is pruned.
    """
    df = billing
    if service is not None:
        df = df.filter(F.col(service_field) == F.lit(service))
    d = F.to_date(F.col(ts))
    if day is not None:
        df = df.filter(d == F.lit(day).cast("date"))
    return (df.groupBy(d.alias("usage_date"))
              .agg(F.round(F.sum(F.col(cost)), 2).alias("total_cost"))
              .orderBy("usage_date"))
