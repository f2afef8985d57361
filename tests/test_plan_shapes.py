"""Guards on the physical plans of every registered query.

No cartesian products or nested-loop joins (all joins are keyed), no Python
evaluation in the plan (no UDFs), no window operators (a window sorts a whole
key in one task), collected arrays only where the array is the bounded output
(chunked nesting, route text blocks), row limits only where a top-k is the
feature, and predicates reach the Parquet scan for the flagship.
"""

import pytest

import __spark_entry__ as E
from strata.plans import QUERIES

from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas",
             "Window")
# Plans whose output is a collected array or text: nested children (chunked),
# route text built from blocks of 4096 legs, one table's columns or changed paths, a hit's links by chunk,
# the hashes under one node of a digest tree (its fan-out bounds them).
COLLECTS = {"nested_children", "route_prompts", "route_summary", "route_summary_parts", "route_context_prompts",
            "canonical_objects", "contract_diff", "schema_change_log", "document_evidence", "ordered_digest", "differing_ranges"}
# Plans where the limit is the feature: newest-n audit report, top-k vectors.
TOP_K = {"audit_report", "evidence", "vector_topk", "document_evidence"}
# Plans with a window over one row a partition (the rows before each range).
ROW_A_PARTITION = {"ordered_digest", "differing_ranges"}
# Plans whose result is read from a checkpoint that they wrote while they were built.
CHECKPOINTED = {"ordered_digest", "differing_ranges", "drift_verdict", "schema_change_log"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_forbidden_nodes(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        if node != "Window" or name not in ROW_A_PARTITION:
            assert node not in plan, f"{name}: {node}"
    if name not in COLLECTS:
        assert "collect_list" not in plan and "collect_set" not in plan, name
    if name not in TOP_K:
        assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan, name
        assert "Sample" not in plan, name


def test_flagship_pushes_filter_and_prunes_columns(spark):
    df = E.entry(spark)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string," \
           "o_orderpriority:string>" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_round_robin_exchange(spark, name):
    """No plan shuffles its input just to balance it."""
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in plan


def test_cluster_conf_sizes_shuffles_from_bytes():
    from strata.session import cluster_conf

    gib = 1024 ** 3
    # 100 TB shuffled at 256 MiB per partition
    big = cluster_conf(100 * 1024 * gib, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 * 4
    # 1 TB: bytes / 256 MiB = 4096 partitions, above 3 per core for 1000 cores
    mid = cluster_conf(1024 * gib, total_cores=1000)
    assert int(mid["spark.sql.shuffle.partitions"]) == 4096
    # tiny shuffle: still three tasks per core
    small = cluster_conf(gib, total_cores=1000)
    assert int(small["spark.sql.shuffle.partitions"]) == 3000
    assert big["spark.sql.adaptive.enabled"] == "true"
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_reads_a_table_that_grows(spark, name, monkeypatch):
    """Every plan's work grows with the data: it reads at least one table
    whose size follows the scale factor (region and nation are fixed)."""
    from strata.sources import tables as source
    from strata.sources.tables import FIXED_SIZE

    seen, read = set(), source.read_table
    monkeypatch.setattr(source, "read_table", lambda spark, sf_dir, table: seen.add(table) or read(spark, sf_dir, table))
    files = QUERIES[name](spark, SF_SMALL).inputFiles()
    tables = seen if name in CHECKPOINTED else {f.rsplit("/", 1)[-1].removesuffix(".parquet") for f in files}
    assert tables - set(FIXED_SIZE), f"{name} reads only {sorted(tables)}"


SKEW_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def _final_plan_with_hot_key(spark, build):
    """Run ``build(src, tgt)`` (a join) where key 0 holds 80% of ``src`` and
    return (row count, final physical plan text)."""
    from pyspark.sql import functions as F

    src = spark.range(200_000).select(
        F.col("id"), F.when(F.col("id") % 10 < 8, F.lit(0)).otherwise(F.col("id") % 97)
        .alias("fk"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    tgt = spark.range(97).select(F.col("id").alias("tk"), F.lit("x").alias("name"))
    old = {k: spark.conf.get(k) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        # max(pad) keeps the incompressible column in the shuffle
        out = build(src, tgt).agg(F.count(F.lit(1)).alias("n"), F.max("pad").alias("m"))
        n = out.collect()[0].n  # runs this DataFrame's own plan
        return n, out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hot_key_join_is_split_by_aqe(spark):
    """A relationship join (J8) where one key holds most rows runs as a
    skew-split sort-merge join: the hot key's rows are spread over tasks."""
    from strata.ontology import Relationship
    from strata.operators.graph import follow

    rel = Relationship("to", "TO", "Tgt", "many_to_one", "fk", "tk")
    n, plan = _final_plan_with_hot_key(spark, lambda s, t: follow(s, t, rel, how="left"))
    assert n == 200_000 and "skew=true" in plan, plan


def test_full_join_step_is_split_by_aqe(spark):
    """A FULL join step with a hot key: the plain full outer join cannot be
    split; the default parts form is."""
    from strata.operators.steps import step_join

    n, plain = _final_plan_with_hot_key(
        spark, lambda s, t: step_join(s, t, "FULL", "fk", "tk", skew_safe=False))
    m, parts = _final_plan_with_hot_key(spark, lambda s, t: step_join(s, t, "FULL", "fk", "tk"))
    assert n == m == 200_000
    assert "FullOuter" in plain and "skew=true" not in plain
    assert "FullOuter" not in parts and "skew=true" in parts


# Keyed reductions that must combine map-side, so a key holding a third of the
# rows costs one row per task before the shuffle.
PARTIAL = ("latest_state", "ledger_state", "point_in_time", "active_packages",
           "delayed_over_2h", "document_registry", "apply_actions", "upsert_merge",
           "route_summary", "route_summary_parts", "nested_children", "dataset_hash",
           "key_duplicates", "daily_cost", "follow_links", "reconcile")


@pytest.mark.parametrize("name", PARTIAL)
def test_keyed_reductions_combine_map_side(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan, name
