import os

from pyspark.sql import functions as F

from strata.sinks.upsert import apply_actions, latest_per_key, upsert
from strata.sinks.writes import (append_audit, export_csv, full_refresh, incremental_append,
                                 incremental_rows, write_date_partitioned)


def test_upsert_non_empty_keeps_old_values(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k long, c1 string, c2 string")
    batch = spark.createDataFrame([(2, "", "Y"), (3, "c", None)], "k long, c1 string, c2 string")
    got = {r.k: (r.c1, r.c2) for r in upsert(target, batch, "k").collect()}
    assert got == {1: ("a", "x"), 2: ("b", "Y"), 3: ("c", None)}


def test_upsert_replace_takes_batch_row(spark):
    target = spark.createDataFrame([(1, "a", "x")], "k long, c1 string, c2 string")
    batch = spark.createDataFrame([(1, None, "z")], "k long, c1 string, c2 string")
    got = upsert(target, batch, "k", mode="replace").collect()[0]
    assert (got.c1, got.c2) == (None, "z")


def test_batch_duplicates_last_wins(spark):
    batch = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "z", 1)],
                                  "k long, v string, seq int")
    got = {r.k: r.v for r in latest_per_key(batch, "k", "seq").collect()}
    assert got == {1: "new", 2: "z"}
    target = spark.createDataFrame([(1, "t")], "k long, v string")
    out = {r.k: r.v for r in upsert(target, batch, "k", order_by="seq").collect()}
    assert out == {1: "new", 2: "z"}


def test_apply_actions(spark):
    target = spark.createDataFrame([(1, "p0"), (2, "q0")], "id long, properties string")
    actions = spark.createDataFrame([(1, "p1", 1), (1, "p2", 2), (9, "zz", 1)],
                                    "id long, properties string, seq int")
    got = {r.id: r.properties for r in apply_actions(target, actions, "id", "properties",
                                                     "seq").collect()}
    assert got == {1: "p2", 2: "q0"}  # unknown id 9 is a no-op


def test_incremental_append_semantics(spark, tmp_dir):
    src = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00"), (3, "2024-01-03 00:00:00")],
        "id int, event_timestamp string").withColumn(
        "event_timestamp", F.col("event_timestamp").cast("timestamp"))
    path = os.path.join(tmp_dir, "inc")
    assert incremental_append(spark, src.filter("id <= 2"), path) == 2  # first run: all
    assert incremental_append(spark, src, path) == 1  # only id 3 is newer
    assert incremental_append(spark, src, path) == 0  # nothing new
    assert spark.read.parquet(path).count() == 3
    # an existing but empty target has no mark: nothing is loaded
    empty = src.limit(0)
    assert incremental_rows(src, empty).count() == 0
    # rows equal to the mark are not loaded again
    assert incremental_rows(src, src.filter("id = 2")).count() == 1


def test_date_partitioned_write_prunes(spark, tmp_dir):
    df = spark.createDataFrame(
        [("f1", "2024-01-01 10:00:00", 100), ("f2", "2024-01-02 11:00:00", 200)],
        "flight_id string, event_timestamp string, altitude int").withColumn(
        "event_timestamp", F.col("event_timestamp").cast("timestamp"))
    path = os.path.join(tmp_dir, "part")
    write_date_partitioned(df, path, "event_timestamp")
    back = spark.read.parquet(path).filter(F.col("partition_date") == "2024-01-02")
    assert [r.flight_id for r in back.collect()] == ["f2"]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan and "= 2024-01-02)]" in plan
    assert sorted(os.listdir(path))[-1].startswith("partition_date=")


def test_full_refresh_audit_append_csv(spark, tmp_dir):
    df = spark.createDataFrame([("t1", "a"), ("t2", "b")], "table_name string, v string")
    full_refresh(df, os.path.join(tmp_dir, "fr"))
    full_refresh(df.limit(1), os.path.join(tmp_dir, "fr"))
    assert spark.read.parquet(os.path.join(tmp_dir, "fr")).count() == 1
    append_audit(df, os.path.join(tmp_dir, "audit"))
    append_audit(df, os.path.join(tmp_dir, "audit"))
    assert spark.read.parquet(os.path.join(tmp_dir, "audit")).count() == 4
    export_csv(df, os.path.join(tmp_dir, "csv"))
    back = spark.read.option("header", True).csv(os.path.join(tmp_dir, "csv"))
    assert back.columns == ["table_name", "v"] and back.count() == 2


def test_date_partitioned_write_splits_a_hot_date(spark, tmp_dir):
    """A date holding most rows is written by several tasks (AQE splits the
    rebalanced partition to the advisory size), small dates are merged."""
    import datetime as dt

    rows = [(i, dt.datetime(2024, 1, 1, 12) if i % 10 else dt.datetime(2024, 1, 2 + i % 7, 8))
            for i in range(40_000)]
    df = spark.createDataFrame(rows, "id long, event_timestamp timestamp").repartition(8)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        path = os.path.join(tmp_dir, "hot")
        write_date_partitioned(df, path, "event_timestamp")
    finally:
        spark.conf.set(key, old)
    hot = [f for f in os.listdir(os.path.join(path, "partition_date=2024-01-01"))
           if f.endswith(".parquet")]
    assert len(hot) > 1
    back = spark.read.parquet(path)
    assert back.count() == 40_000
    assert back.filter(F.col("partition_date") == "2024-01-01").count() == 36_000


def test_merge_into_bucketed_target_does_not_shuffle_it(spark):
    """K1 into a table bucketed by the key: same result as the plain upsert,
    and the plan shuffles the batch only (the target scan is bucketed)."""
    from strata.sinks.upsert import merge_bucketed, write_bucketed

    target = spark.range(20_000).select(F.col("id").alias("k"),
                                        (F.col("id") % 7).cast("string").alias("v"))
    batch = spark.range(10_000, 30_000, 3).select(F.col("id").alias("k"),
                                                  F.lit("new").alias("v"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        write_bucketed(target, "kv_v1", "k", 8)
        merge = upsert(spark.table("kv_v1"), batch, "k")
        plan = merge._jdf.queryExecution().executedPlan().toString()
        plain = upsert(target, batch, "k")._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert plan.count("Exchange hashpartitioning") < plain.count("Exchange hashpartitioning")
        merge_bucketed(spark, "kv_v1", batch, "k", "kv_v2", 8)
        got = sorted(map(tuple, spark.table("kv_v2").collect()))
        want = sorted(map(tuple, upsert(target, batch, "k").collect()))
        assert got == want and len(got) == 20_000 + len(range(20_001, 30_000, 3))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        spark.sql("DROP TABLE IF EXISTS kv_v1")
        spark.sql("DROP TABLE IF EXISTS kv_v2")


def test_build_dataset_by_build_type(spark, tmp_dir):
    """APPEND -> incremental on event_timestamp (whatever the partition field),
    VIEW -> temp view only, anything else (also 'append') -> full table."""
    import datetime as dt

    from strata.sinks.writes import build_dataset

    def rows(n):
        return spark.createDataFrame(
            [(f"f{i}", dt.datetime(2024, 1, 1 + i % 3, 10), dt.datetime(2024, 2, 1, i))
             for i in range(n)], "flight_id string, event_timestamp timestamp, "
                                 "ingested timestamp")
    inc = os.path.join(tmp_dir, "inc")
    assert build_dataset(spark, rows(2), inc, "APPEND", partition_field="ingested") == \
        "incremental"
    assert spark.read.parquet(inc).count() == 2  # first run: everything
    build_dataset(spark, rows(6), inc, "APPEND", partition_field="ingested")
    # only event_timestamp above the mark (2024-01-02 10:00) is added: i = 2, 5
    assert sorted(r.flight_id for r in spark.read.parquet(inc).collect()) == [
        "f0", "f1", "f2", "f5"]
    assert any(d.startswith("partition_date=") for d in os.listdir(inc))
    tab = os.path.join(tmp_dir, "tab")
    for n in (4, 3):
        assert build_dataset(spark, rows(n), tab, "append") == "table"  # exact match only
    assert spark.read.parquet(tab).count() == 3
    assert build_dataset(spark, rows(5), os.path.join(tmp_dir, "v"), "VIEW",
                         view_name="flight_view") == "view"
    assert spark.table("flight_view").count() == 5
    assert not os.path.exists(os.path.join(tmp_dir, "v"))
