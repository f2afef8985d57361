"""K3-K7: table writes.

Every write is one set-wise job.  Outputs that a later step of the same run
reads back go to a new path, never over the path being read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def full_refresh(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K3: replace the table's contents (delete-all + insert in one commit)."""
    df.write.mode("overwrite").format(fmt).save(path)


def append_audit(audit: DataFrame, path: str) -> None:
    """K4: append rule-audit rows, partitioned by table name."""
    audit.write.mode("append").partitionBy("table_name").parquet(path)


def high_water_mark(target: DataFrame | None, column: str = "event_timestamp"):
    """Largest ``column`` value already loaded (None when empty)."""
    if target is None:
        return None
    return target.agg(F.max(column).alias("m")).first()["m"]


def _mark_literal(target: DataFrame, column: str) -> Column | None:
    """The mark as a literal of the column's type, None when there is none.

    It leaves and enters the JVM as text (instants: as microseconds), never as a
    Python time, which would be read in the zone of the JVM or the session.
    """
    kind = target.schema[column].dataType
    top = F.max(F.col(f"`{column}`"))
    if isinstance(kind, T.TimestampType):
        micros = target.agg(F.unix_micros(top).alias("m")).first()["m"]
        return None if micros is None else F.timestamp_micros(F.lit(micros))
    text = target.agg(top.cast("string").alias("m")).first()["m"]
    return None if text is None else F.lit(text).cast(kind)


def existing_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    """The table at ``path``; None only if there is no such path.  A folder that
    holds no data file yet is an empty table with the columns of ``like``."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return spark.createDataFrame([], like.schema)
        raise


def incremental_rows(source: DataFrame, target: DataFrame | None,
                     column: str = "event_timestamp") -> DataFrame:
    """K5: rows of ``source`` newer than the target's high-water mark.

    First run (no target) takes everything.  An existing but empty target has
    no mark (NULL) and, like ``ts > NULL``, admits nothing.  Rows with a time
    equal to the mark are not loaded again (strict ``>``).  The mark is one
    scalar computed from the target; it reaches the scan as a literal, so
    Parquet row-group statistics prune old files.
    """
    if target is None:
        return source
    mark = _mark_literal(target, column)
    if mark is None:
        return source.limit(0)
    return source.filter(F.col(f"`{column}`") > mark)


def incremental_append(spark: SparkSession, source: DataFrame, target_path: str,
                       column: str = "event_timestamp", exists: bool | None = None) -> int:
    """K5 writer: append the new rows to ``target_path``; returns rows written.

    Only a missing path is a first run; any other failure to read the target is raised.
    """
    target = None if exists is False else existing_table(spark, target_path, source)
    if exists and target is None:
        raise FileNotFoundError(target_path)
    written = Observation()
    rows = incremental_rows(source, target, column).observe(written, F.count(F.lit(1)).alias("n"))
    rows.write.mode("append").parquet(target_path)
    return written.get["n"]


# Dataset build types (compared exactly; any other value,
# default SNAPSHOT, builds a full table) and the incremental mark column,
# which stays ``event_timestamp`` whatever the partition field is.
BUILD_APPEND, BUILD_VIEW, BUILD_DEFAULT = "APPEND", "VIEW", "SNAPSHOT"
MARK_COLUMN = "event_timestamp"


def build_dataset(spark: SparkSession, source: DataFrame, target_path: str,
                  build_type: str | None = None, partition_field: str | None = None,
                  view_name: str | None = None) -> str:
    """K5 / K6: build a dataset from its build settings; returns the kind built.

    ``APPEND`` -> ``incremental``: only source rows with ``event_timestamp``
    above the target's mark are appended (first run: all; an existing empty
    target: none).  ``VIEW`` -> ``view``: ``view_name`` names a temp view over
    the source and nothing is written.  Anything else -> ``table``: the whole
    source replaces the target.  With ``partition_field`` the table and the
    increments are written partitioned by ``DATE(partition_field)`` (K6).
    """
    kind = build_type or BUILD_DEFAULT
    if kind == BUILD_VIEW:
        source.createOrReplaceTempView(view_name)
        return "view"
    if kind == BUILD_APPEND:
        target = existing_table(spark, target_path, source)
        rows, mode = incremental_rows(source, target, MARK_COLUMN), "append"
    else:
        rows, mode = source, "overwrite"
    if partition_field:
        write_date_partitioned(rows, target_path, partition_field, mode=mode)
    else:
        rows.write.mode(mode).parquet(target_path)
    return "incremental" if kind == BUILD_APPEND else "table"


def write_date_partitioned(df: DataFrame, path: str, field: str,
                           partition_col: str = "partition_date",
                           mode: str = "append") -> None:
    """K6: ``partitionBy DATE(field)``; readers filtering the date prune folders.

    Rows are rebalanced by date before the write (Spark's ``REBALANCE`` hint),
    so each task writes into few date folders.  With adaptive execution on
    (the session policy) Spark splits a date holding a large share of the
    rows into pieces of the advisory partition size and merges small dates,
    so one hot date is written by as many tasks as its size needs -- not by
    one, and not by a fixed count.
    """
    (df.withColumn(partition_col, F.to_date(F.col(field)))
       .hint("rebalance", partition_col)
       .write.mode(mode).partitionBy(partition_col).parquet(path))


def export_csv(df: DataFrame, path: str) -> None:
    """K7: CSV export with a header line (no index column)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
