"""Warehouse table reads.

Parquet scans keep Catalyst's column pruning and filter pushdown: callers
select and filter after ``read_table`` and the scan's ``ReadSchema`` /
``PushedFilters`` shrink accordingly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The driver's table names.
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


# Tables of fixed cardinality.
FIXED_SIZE = ("region", "nation")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet`` (a file or a folder of parts), listed anew at each call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, d).orders`` reads orders on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def get(self, name: str) -> DataFrame:
        return getattr(self, name)


def register_views(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Expose the driver tables as temp views for ``spark.sql``."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
