"""R1, R2 and W1 on Structured Streaming: telemetry stream -> keyed state.

The stream applies the same stateless ``parse_telemetry`` projection as the batch twin.  R2 writes each micro-batch,
one row per ``row_key``, as its own partition of a table of changes (``strata.streaming.changes``), and
``current_store`` reads one row per key by an aggregate that does not depend on the order of arrival: replayed
batches, repeated messages and events out of order give what the batch gives.  W1 is an update-mode aggregate,
whose state Spark keeps.  ``deduplicated`` drops repeated messages before they are written, at the price
of dropping what comes later than its watermark.

Checkpoints live under the shared ``spark.checkpoint.dir`` unless a path is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.telemetry import parse_telemetry
from strata.streaming.changes import EPOCH, newest, read_changes, run_changes

MESSAGE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def read_messages(spark: SparkSession, path: str | None = None, fmt: str = "text",
                  options: dict[str, str] | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of messages with one ``value`` column (text or bytes).

    File sources (``text`` / ``json`` lines under ``path``) serve tests and
    landing folders; a message bus plugs in through ``fmt`` and ``options``
    (e.g. ``fmt="kafka"`` with ``kafka.bootstrap.servers`` and ``subscribe``
    -- its ``value`` column is bytes, which the parser accepts).
    """
    reader = spark.readStream.format(fmt)
    if options:
        reader = reader.options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt in ("text", "kafka"):
        df = reader.load(path) if path else reader.load()
    else:
        df = reader.schema(MESSAGE_SCHEMA).load(path)
    return df.select("value")


def telemetry_stream(spark: SparkSession, path: str | None = None, fmt: str = "text",
                     options: dict[str, str] | None = None) -> DataFrame:
    """Parsed telemetry rows as an unbounded DataFrame."""
    return parse_telemetry(read_messages(spark, path, fmt, options))


def deduplicated(stream: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Messages without their repeats, for a bus that delivers more than once.

    A repeat has all columns equal and comes within ``delay`` of event time.  Messages without a time are dropped,
    and so are those later than ``delay`` after the newest one seen: use it only where that is meant.
    """
    timed = stream.withColumn("_event_time", F.try_to_timestamp("timestamp")).withWatermark("_event_time", delay)
    return timed.dropDuplicatesWithinWatermark(stream.columns).drop("_event_time")


def _one_per_key(rows: DataFrame) -> DataFrame:
    """The greatest row of each ``row_key``: the same whatever the order in which rows came."""
    columns = [c for c in rows.columns if c not in ("row_key", EPOCH)]
    return rows.groupBy("row_key").agg(F.max(F.struct(*columns)).alias("_r")).select("row_key", "_r.*")


def run_to_store(stream: DataFrame, store_path: str, checkpoint: str | None = None, available_now: bool = True):
    """R2: write the stream into the keyed store at ``store_path``; returns the StreamingQuery."""
    return run_changes(stream, store_path, "telemetry-store", "append", checkpoint, available_now, _one_per_key)


def current_store(spark: SparkSession, store_path: str) -> DataFrame | None:
    """One row per ``row_key`` (``None`` before the first batch)."""
    changes = read_changes(spark, store_path)
    return None if changes is None else _one_per_key(changes)


def latest_per_package(stream: DataFrame) -> DataFrame:
    """W1 on a stream: newest status per package (update mode).

    State is one row per package; ``max(struct(ts, ...))`` is the same
    partial aggregate as the batch version.
    """
    return (stream.groupBy("package_id")
            .agg(F.max(F.struct("timestamp", "status", "sla_breach", "row_key")).alias("_s"))
            .select("package_id", "_s.timestamp", "_s.status", "_s.sla_breach", "_s.row_key"))


def run_latest(stream: DataFrame, path: str, checkpoint: str | None = None, available_now: bool = True):
    """Keep the newest status of each package at ``path``, from an update-mode aggregate."""
    return run_changes(latest_per_package(stream), path, "latest-status", "update", checkpoint, available_now)


def current_latest(spark: SparkSession, path: str) -> DataFrame | None:
    """Each package's newest status so far (``None`` before the first batch)."""
    changes = read_changes(spark, path)
    return None if changes is None else newest(changes, "package_id")


def compact_store(spark: SparkSession, store_path: str, out_path: str) -> None:
    """Write the current store (one row per key) as one table elsewhere."""
    current_store(spark, store_path).write.mode("overwrite").parquet(out_path)
