"""The ordered digest and the ranges it names."""

import hashlib

import pytest
from pyspark.sql import functions as F

from strata.operators.merkle import assert_same, differing_ranges, first_difference, leaves, ordered_digest
from strata.operators.reconcile import HashMismatch


def brute(rows, fanout, null_safe=False):
    def text(v):
        return v if v is None else str(v)
    hashes = []
    for r in rows:
        parts = ["\\N" if v is None and null_safe else text(v) for v in r]
        hashes.append((r[0], hashlib.md5("||".join(p for p in parts if p is not None).encode()).hexdigest()))
    nodes = [h for _, h in sorted(hashes, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]
    nodes = [hashlib.md5("".join(nodes[i:i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]
    while len(nodes) > 1:
        nodes = [hashlib.md5("".join(nodes[i:i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]
    return nodes[0] if nodes else hashlib.md5(b"").hexdigest()


@pytest.mark.parametrize("n, fanout", [(0, 4), (1, 4), (4, 4), (5, 4), (64, 4), (65, 4), (700, 8), (700, 1024)])
def test_root_equals_one_fold_whatever_the_partitions(spark, n, fanout):
    rows = [((i * 7919) % 1009, f"v{i % 13}" if i % 5 else None, i * 10) for i in range(n)]
    if n > 100:
        rows += [rows[3], (None, "x", 1), (None, None, 2)]
    df = spark.createDataFrame(rows, "k long, a string, b long")
    want = [(len(rows), brute(rows, fanout))]
    for parts in (1, 7):
        assert [tuple(r) for r in ordered_digest(df.repartition(parts), "k", fanout=fanout).collect()] == want
    assert ordered_digest(df, "k", fanout=fanout, null_safe=True).first().dataset_hash == brute(rows, fanout, True)


def test_swaps_changes_and_gaps_are_named(spark):
    base = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 3 % 11).alias("v"))
    tree = leaves(base, "k", fanout=16)
    assert first_difference(tree, leaves(base.repartition(5), "k", fanout=16)) is None

    def other(v):
        return leaves(base.withColumn("v", v), "k", fanout=16)

    swapped = other(F.when(F.col("k") == 500, F.lit(501 * 3 % 11)).when(F.col("k") == 501, F.lit(500 * 3 % 11)).otherwise(F.col("v")))
    at = differing_ranges(tree, swapped).collect()
    assert [(r.node, r.first_key.k, r.last_key.k, r.source_rows, r.target_rows) for r in at] == [(31, 496, 511, 16, 16)]
    gone = leaves(base.filter("k <> 100"), "k", fanout=16)
    assert first_difference(tree, gone).node == 6 and differing_ranges(tree, gone).count() == 1000 // 16 + 1 - 6
    more = leaves(base.union(spark.range(1000, 1100).select("id", F.lit(0).cast("long"))), "k", fanout=16)
    assert first_difference(tree, more).first_key.k == 992
    with pytest.raises(HashMismatch, match=r"from \(496,\) to \(511,\)"):
        assert_same(base, base.withColumn("v", F.when(F.col("k") == 500, 99).otherwise(F.col("v"))), "k", fanout=16)
    assert_same(base, base.repartition(3), "k")


def test_null_places_and_two_keys(spark):
    a = spark.createDataFrame([(1, "x", None, "a"), (1, "y", "b", None)], "k long, s string, c string, d string")
    b = spark.createDataFrame([(1, "x", "a", None), (1, "y", "b", None)], "k long, s string, c string, d string")
    plain = [ordered_digest(x, ["k", "s"]).first().dataset_hash for x in (a, b)]
    safe = [ordered_digest(x, ["k", "s"], null_safe=True).first().dataset_hash for x in (a, b)]
    assert plain[0] == plain[1] and safe[0] != safe[1]
    with pytest.raises(ValueError):
        leaves(a, "k", fanout=1)


def test_no_task_holds_the_table(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    plan = leaves(df, "k", fanout=64)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" in plan  # over one row a partition only
    assert leaves(df, "k", fanout=64).agg(F.max("n_rows")).first()[0] == 64
