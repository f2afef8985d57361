"""Ordered dataset digest as a Merkle tree over key ranges.

Rows are put in key order by a range partitioning and a sort inside each partition.  A row's place in the whole order is its
place in its partition plus the rows of the partitions before, which one small aggregate gives.  Every ``fanout``
rows in a row are a leaf, whose digest folds their row hashes in order; every ``fanout`` nodes are folded to one of the next
level, up to the root.  The tree depends on the rows and their order alone, not on how they were partitioned,
and no task holds more than ``fanout`` hashes of a node.  Two tables whose roots differ are compared by their
leaves, which name the key ranges that differ.

The row hash is ``md5(concat_ws('||', every column as text))``; ``concat_ws`` skips NULLs, so ``null_safe``
is there to tell (NULL, 'a') from ('a', NULL).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.reconcile import HashMismatch, row_hash
from strata.session import cut_lineage

FANOUT = 1024


def ordered_rows(df: DataFrame, key: Sequence[str] | str, columns: Sequence[str] | None = None,
                 null_safe: bool = False) -> DataFrame:
    """``(place, key, hash)``: each row's place in key order, from 0, its key as a struct and its hash.

    Rows with one key are ordered by their hash, NULL keys come first.  The rows are checkpointed once, as the bounds
    of a range partitioning are drawn anew when it is computed again.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.select(F.struct(*[F.col(f"`{k}`").alias(k) for k in keys]).alias("key"), row_hash(df, columns, null_safe).alias("hash"))
    dealt = rows.repartitionByRange("key", "hash").sortWithinPartitions("key", "hash")
    dealt = cut_lineage(dealt.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")))
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n"))  # one row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return dealt.join(offsets, F.col("part") == F.col("of")).select((F.col("base") + F.col("at")).alias("place"), "key", "hash")


def _fold(nodes: DataFrame, level: int, fanout: int) -> DataFrame:
    """The next level: ``fanout`` nodes, in order, to one."""
    at = F.floor(F.col("node") / fanout).cast("long")
    listed = F.sort_array(F.collect_list(F.struct("node", "digest")))  # at most ``fanout`` of them
    return nodes.groupBy(at.alias("up")).agg(
        F.sum("n_rows").alias("n_rows"), F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"),
        F.md5(F.array_join(F.transform(listed, lambda x: x["digest"]), "")).alias("digest")).select(
        F.lit(level).alias("level"), F.col("up").alias("node"), "n_rows", "first_key", "last_key", "digest")


def leaves(df: DataFrame, key: Sequence[str] | str, columns: Sequence[str] | None = None, fanout: int = FANOUT,
           null_safe: bool = False) -> DataFrame:
    """``(level, node, n_rows, first_key, last_key, digest)`` of the ranges of ``fanout`` rows in key order."""
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    rows = ordered_rows(df, key, columns, null_safe)
    return _fold(rows.select(F.col("place").alias("node"), F.lit(1).cast("long").alias("n_rows"), F.col("key").alias("first_key"),
                             F.col("key").alias("last_key"), F.col("hash").alias("digest")), 0, fanout)


def root(tree: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``(n_rows, dataset_hash)``, one row, of a tree's leaves; no rows hash like an empty text."""
    level, nodes = 0, tree
    n = tree.count()
    while n > 1:  # the logarithm of the row count to the base ``fanout``
        level, n = level + 1, -(-n // fanout)
        nodes = _fold(nodes, level, fanout)
    return nodes.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.max("digest"), F.md5(F.lit(""))).alias("dataset_hash"))


def ordered_digest(df: DataFrame, key: Sequence[str] | str, columns: Sequence[str] | None = None, fanout: int = FANOUT,
                   null_safe: bool = False) -> DataFrame:
    """A5: ``(n_rows, dataset_hash)`` of all rows in key order."""
    return root(leaves(df, key, columns, fanout, null_safe), fanout)


def differing_ranges(source: DataFrame, target: DataFrame) -> DataFrame:
    """The leaves of two trees (of one fanout) that differ: ``(node, first_key, last_key, source_rows, target_rows,
    source_digest, target_digest)``.

    Rows before the first of them agree.  A row that only one side has shifts all later leaves; rows changed in
    place leave the others alone.
    """
    s, t = (x.select("node", "first_key", "last_key", F.col("n_rows").alias(f"{side}_rows"), F.col("digest").alias(f"{side}_digest"))
            for x, side in ((source, "source"), (target, "target")))
    s, t = s.alias("s"), t.alias("t")
    both = s.join(t, F.col("s.node") == F.col("t.node"), "full_outer").filter(~F.col("source_digest").eqNullSafe(F.col("target_digest")))
    return both.select(F.coalesce("s.node", "t.node").alias("node"), F.least("s.first_key", "t.first_key").alias("first_key"),
                       F.greatest("s.last_key", "t.last_key").alias("last_key"), "source_rows", "target_rows", "source_digest", "target_digest")


def first_difference(source: DataFrame, target: DataFrame):
    """The first differing range of two trees as a Row, None if they agree."""
    return differing_ranges(source, target).orderBy("node").first()


def assert_same(source: DataFrame, target: DataFrame, key: Sequence[str] | str, columns: Sequence[str] | None = None,
                fanout: int = FANOUT, null_safe: bool = False) -> None:
    """Raise ``HashMismatch``, naming the first key range that differs, unless both hold the same rows in key order."""
    at = first_difference(*(leaves(x, key, columns, fanout, null_safe) for x in (source, target)))
    if at is not None:
        raise HashMismatch(f"tables differ from {tuple(at.first_key)} to {tuple(at.last_key)} "
                           f"({at.source_rows} rows against {at.target_rows})")
