"""K3: refresh of several related tables, all or none.

Tables are staged in the order of their foreign keys, parents first, in a folder of the refresh's own.  When all of them are
written and every foreign key finds its parent, one row appended to the list of versions makes them the current
ones together.  A refresh that fails before that row leaves the tables as they were, and a reader that
began on the old versions keeps reading them, as no file is ever replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.writes import existing_table

VERSIONS = "versions_published"
_VERSION = "seq long, refresh string, paths map<string,string>"


@dataclass(frozen=True)
class ForeignKey:
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


class MissingParents(ValueError):
    """Rows whose foreign key has no parent; ``orphans`` maps each violated key to its number of rows."""

    def __init__(self, orphans: Mapping[ForeignKey, int]):
        self.orphans = dict(orphans)
        super().__init__("; ".join(f"{n} rows of {k.child}({', '.join(k.columns)}) without a row of {k.parent}" for k, n in orphans.items()))


def refresh_order(tables: Iterable[str], foreign_keys: Iterable[ForeignKey]) -> list[str]:
    """The tables, each after those it refers to, else by name. A cycle of different tables is an error."""
    graph: dict[str, set[str]] = {t: set() for t in sorted(tables)}
    for k in foreign_keys:
        if k.child in graph and k.parent in graph and k.child != k.parent:
            graph[k.child].add(k.parent)
    try:
        order, sorter = [], TopologicalSorter(graph)
        sorter.prepare()
        while sorter.is_active():
            ready = sorted(sorter.get_ready())
            order += ready
            sorter.done(*ready)
        return order
    except CycleError as e:
        raise ValueError(f"foreign keys form a cycle: {' -> '.join(e.args[1])}") from None


def current_paths(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """(number of the newest published refresh, {table: folder}); (0, {}) before the first."""
    published = existing_table(spark, f"{root.rstrip('/')}/{VERSIONS}", spark.createDataFrame([], _VERSION))
    last = published and published.agg(F.max_by(F.struct("seq", "paths"), F.struct("seq", "refresh")).alias("v")).first()["v"]
    return (last["seq"], dict(last["paths"])) if last else (0, {})


def read_refreshed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The current version of ``table``."""
    _, paths = current_paths(spark, root)
    if table not in paths:
        raise KeyError(f"{table} has not been published under {root}")
    return spark.read.parquet(paths[table])


def orphans(child: DataFrame, parent: DataFrame, key: ForeignKey) -> DataFrame:
    """Rows of ``child`` whose key is given in all columns and has no parent."""
    c = child.dropna(subset=list(key.columns))
    p = parent.select(*[F.col(b).alias(f"_p{i}") for i, b in enumerate(key.parent_columns)])
    match = [c[a] == p[f"_p{i}"] for i, a in enumerate(key.columns)]
    return c.join(p, match, "left_anti")


def refresh_tables(spark: SparkSession, root: str, tables: Mapping[str, DataFrame],
                   foreign_keys: Iterable[ForeignKey] = ()) -> int:
    """Replace the contents of ``tables`` together; the number of the refresh.

    Tables that are not given keep their version, and foreign keys to or from them are checked against it.  One
    refresh runs at a time.
    """
    root, keys = root.rstrip("/"), list(foreign_keys)
    seq, paths = current_paths(spark, root)
    name = f"{seq + 1:09d}-{uuid.uuid4().hex}"
    staged = {}
    for t in refresh_order(tables, keys):
        staged[t] = f"{root}/refresh={name}/{t}"
        tables[t].write.mode("errorifexists").parquet(staged[t])
    now = {**paths, **staged}
    missing = {}
    for k in keys:
        if (k.child in staged or k.parent in staged) and k.child in now:
            child = spark.read.parquet(now[k.child])
            n = orphans(child, spark.read.parquet(now[k.parent]), k).count() if k.parent in now else child.dropna(subset=list(k.columns)).count()
            if n:
                missing[k] = n
    if missing:
        raise MissingParents(missing)
    spark.createDataFrame([(seq + 1, name, now)], _VERSION).coalesce(1).write.mode("append").parquet(f"{root}/{VERSIONS}")
    return seq + 1
