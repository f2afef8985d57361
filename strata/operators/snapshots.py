"""Dated snapshots of a ledger's state, and reading any time as the nearest snapshot plus later changes.

A snapshot is a partition of a plain table, one row a live key with the mark of its last change.  Writing one replaces that
date's partition alone (dynamic partition overwrite), so a repeated run leaves one snapshot.  The ledger may
be partitioned by date: only its changes after the snapshot are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.history import DELETE
from strata.sinks.writes import existing_table

AS_OF = "snapshot_at"
_NOT_DELETE = "SNAPSHOT"


def _last(changes: DataFrame, key: str, seq: Sequence[str], op: str, columns: Sequence[str]) -> DataFrame:
    """The last change of each key, deletions too: ``(key, seq..., op, columns...)``; of equal ``seq`` a delete wins."""
    order = [F.col(c).alias(f"_s{i}") for i, c in enumerate(seq)]
    packed = F.struct(*order, F.col(op).eqNullSafe(F.lit(DELETE)).alias("_gone"), F.col(op).alias("_op"),
                      *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    return changes.groupBy(key).agg(F.max(packed).alias("_r")).select(
        key, *[F.col(f"_r._s{i}").alias(f"_s{i}") for i in range(len(seq))], F.col("_r._op").alias("_op"),
        *[F.col(f"_r._c{i}").alias(c) for i, c in enumerate(columns)])


def _live(last: DataFrame) -> DataFrame:
    return last.filter(~F.col("_op").eqNullSafe(F.lit(DELETE)))


def _marked(ledger: DataFrame, key: str, seq: Sequence[str], op: str, columns: Sequence[str]) -> DataFrame:
    return ledger.select(key, *[F.col(c).alias(f"_s{i}") for i, c in enumerate(seq)], F.col(op).alias("_op"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(columns)])


def _as_last(rows: DataFrame, key: str, seq: Sequence[str], columns: Sequence[str]) -> DataFrame:
    marks = [f"_s{i}" for i in range(len(seq))]
    return _last(rows, key, marks, "_op", [f"_v{i}" for i in range(len(columns))])


def write_snapshot(spark: SparkSession, ledger: DataFrame, path: str, at: str, key: str, seq: Sequence[str], op: str,
                   columns: Sequence[str], ts: str) -> None:
    """Write the state at ``at`` (text of a local time) as that time's partition of the table at ``path``.

    It is built from the nearest earlier snapshot, if there is one, and the changes since.
    """
    rows = _state(spark, ledger, path, at, key, seq, op, columns, ts, strictly=True)
    out = _live(rows).withColumn("_op", F.lit(_NOT_DELETE)).withColumn(AS_OF, F.lit(at).cast("timestamp_ntz").cast("string"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(AS_OF).parquet(path)


def nearest_snapshot(spark: SparkSession, path: str, at: str, strictly: bool = False) -> str | None:
    """The time of the last snapshot up to ``at`` (before it, if ``strictly``); None if there is none."""
    table = existing_table(spark, path, spark.createDataFrame([], f"{AS_OF} string"))
    if table is None:
        return None
    mark, when = F.col(AS_OF).cast("timestamp_ntz"), F.lit(at).cast("timestamp_ntz")
    found = table.filter(mark < when if strictly else mark <= when).agg(F.max(mark).cast("string").alias("m")).first()
    return found["m"]


def _state(spark, ledger, path, at, key, seq, op, columns, ts, strictly=False) -> DataFrame:
    base = nearest_snapshot(spark, path, at, strictly)
    kind = ledger.schema[ts].dataType
    later = ledger.filter(F.col(ts) <= F.lit(at).cast(kind))
    if base is not None:
        later = later.filter(F.col(ts) > F.lit(base).cast(kind))
    changes = _marked(later, key, seq, op, columns)
    if base is not None:
        held = spark.read.parquet(path).filter(F.col(AS_OF).cast("timestamp_ntz") == F.lit(base).cast("timestamp_ntz")).drop(AS_OF)
        changes = changes.unionByName(held.select(changes.columns))
    return _as_last(changes, key, seq, columns)


def state_at(spark: SparkSession, ledger: DataFrame, path: str, at: str, key: str, seq: Sequence[str], op: str,
             columns: Sequence[str], ts: str) -> DataFrame:
    """``(key, columns...)`` of the keys that live at ``at``: the nearest snapshot with the changes after it.

    The result is that of ``current_state`` over the whole ledger.  ``at`` is the text of a time without zone; later
    corrections of changes that a snapshot covers need that snapshot to be written again.
    """
    rows = _live(_state(spark, ledger, path, at, key, seq, op, columns, ts))
    return rows.select(key, *[F.col(f"_v{i}").alias(c) for i, c in enumerate(columns)])
