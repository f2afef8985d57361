"""Session construction and cluster-wide policies.

The library never assumes a local machine: shuffle width, adaptive execution,
skew handling and the checkpoint location are all read from (or written to)
the session configuration.  ``local_session`` exists for tests and the
benchmark; production code receives an existing ``SparkSession``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale.  AQE re-plans joins from real shuffle sizes
# (broadcast only when the measured side is below the threshold), coalesces
# small partitions and splits skewed ones, so a hot key holding a third of the
# rows is cut into many tasks instead of one.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # The size bound for broadcasting a join side, stated rather than
    # implied: static plans check the estimate, AQE the measured shuffle.
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Static broadcast decisions estimate a Parquet side from its compressed
    # size; columnar compression often hides 3-5x.  Scale the estimate so a
    # "small" side is small in memory too (AQE still re-checks measured sizes).
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.parquet.filterPushdown": "true",
    # JSON text with a repeated key keeps its last value (as Python's json
    # does) instead of failing the parse
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # driver-side only: skip capturing a Python call site for every Column
    # built (a JVM round trip each); plan building gets several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def cluster_conf(shuffle_bytes: int, total_cores: int,
                 partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle sizing for a cluster run whose largest shuffle moves
    ``shuffle_bytes`` (after column pruning and map-side aggregation -- usually
    far below the input size).

    The width aims at ``partition_bytes`` per post-shuffle partition, is at
    least three tasks per core; AQE then coalesces small partitions and splits skewed ones.
    """
    width = -(-shuffle_bytes // partition_bytes)
    width = max(total_cores * 3, width)
    return {
        **SCALE_CONF,
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="strata-wh-"))
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, default=tempfile.mkdtemp(prefix="strata-ckpt-"))
    return spark


def ensure_checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system folder and is used as
    is.  Only when it is unset (tests, benchmarks) is ``default`` installed.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if default is None:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
    spark.conf.set("spark.checkpoint.dir", default)
    sc.setCheckpointDir(default)
    return sc.getCheckpointDir() or default


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the shared checkpoint folder (reliable checkpoint).

    Used where a plan holds non-deterministic columns (``uuid()``, time) that
    two outputs must agree on, and to keep re-computation after an executor
    loss from re-reading the sources.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/strata-tables/{name}"
