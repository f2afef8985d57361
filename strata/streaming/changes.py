"""Keyed results of streams as tables of changes.

A stream's ``foreachBatch`` writes the rows a micro-batch changed to the partition ``epoch=<id>`` of a plain
table, replacing that partition alone; a batch that is replayed after a failure so rewrites its own rows.
``newest`` reads one row per key with the aggregate of the ledger operators, and ``merge_changes``
folds the changes into a table by the keyed merge (K1).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir
from strata.sinks.upsert import latest_per_key, upsert
from strata.sinks.writes import existing_table

EPOCH = "epoch"


def write_changes(path: str, reduce: Callable[[DataFrame], DataFrame] = lambda batch: batch):
    """A ``foreachBatch`` function that writes ``reduce(batch)`` as the batch's partition of the table at ``path``."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        (reduce(batch).withColumn(EPOCH, F.lit(int(epoch_id)).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(EPOCH).parquet(path))
    return write


def run_changes(rows: DataFrame, path: str, name: str, mode: str, checkpoint: str | None, available_now: bool,
                reduce: Callable[[DataFrame], DataFrame] = lambda batch: batch):
    """Start the stream ``rows`` into the table of changes at ``path``; the StreamingQuery."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(rows.sparkSession).rstrip('/')}/streams/{name}"
    w = rows.writeStream.outputMode(mode).foreachBatch(write_changes(path, reduce)).option("checkpointLocation", ckpt)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def read_changes(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame | None:
    """The changes written so far, None if there are none yet. An error other than a missing path is raised."""
    empty = like if like is not None else spark.createDataFrame([], "epoch long")
    return existing_table(spark, path, empty)


def newest(changes: DataFrame, key: str) -> DataFrame:
    """The row of each key's last epoch. A batch holds at most one row a key."""
    return latest_per_key(changes.withColumn(EPOCH, F.col(EPOCH).cast("long")), key, EPOCH).drop(EPOCH)


def merge_changes(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """K1 / K2: ``target`` with each key's newest change in it, to be written as a new table."""
    return upsert(target, newest(changes, key), key, mode="replace")
