from pyspark.sql import functions as F

import pytest

from strata.operators.reconcile import (HashMismatch, assert_digest, bucket_digests,
                                        check_columns, check_row_count, dataset_digest,
                                        duplicate_keys, overall_status, reconcile)


def _t(spark):
    return spark.createDataFrame([(i, f"n{i}", float(i) / 3) for i in range(200)],
                                 "id long, name string, v double")


def test_digest_is_partitioning_and_order_free(spark):
    df = _t(spark)
    a = dataset_digest(df).first().dataset_hash
    b = dataset_digest(df.repartition(7).orderBy(F.desc("id"))).first().dataset_hash
    assert a == b


def test_digest_detects_changes_and_duplicates(spark):
    df = _t(spark)
    base = dataset_digest(df).first().dataset_hash
    assert dataset_digest(df.union(df.limit(1))).first().dataset_hash != base
    changed = df.withColumn("name", F.when(F.col("id") == 5, "X").otherwise(F.col("name")))
    assert dataset_digest(changed).first().dataset_hash != base
    with pytest.raises(HashMismatch):
        assert_digest(changed, base)
    assert assert_digest(df, base) == base


def test_concat_ws_skips_nulls_unless_null_safe(spark):
    a = spark.createDataFrame([(None, "a")], "x string, y string")
    b = spark.createDataFrame([("a", None)], "x string, y string")
    assert dataset_digest(a).first().dataset_hash == dataset_digest(b).first().dataset_hash
    assert (dataset_digest(a, null_safe=True).first().dataset_hash
            != dataset_digest(b, null_safe=True).first().dataset_hash)


def test_bucket_digests_locate_difference(spark):
    df = _t(spark)
    changed = df.withColumn("name", F.when(F.col("id") == 5, "X").otherwise(F.col("name")))
    a = {r.bucket: r.digest for r in bucket_digests(df, "id", 16).collect()}
    b = {r.bucket: r.digest for r in bucket_digests(changed, "id", 16).collect()}
    assert len([k for k in a if a[k] != b[k]]) == 1


def test_row_and_column_checks(spark):
    df = _t(spark)
    rc = check_row_count(df, df.limit(150)).first()
    assert (rc.source_rows, rc.target_rows, rc.row_count_ok) == (200, 150, False)
    cc = check_columns(df, df)
    assert cc.filter("NOT ok").count() == 0
    assert cc.count() == 1 + 3 + 3 * 2  # count(*), count per col, sum/min/max numeric
    cc2 = check_columns(df, df.withColumn("v", F.col("v") + 1))
    assert {r.agg for r in cc2.filter("NOT ok").collect()} == {"sum", "min", "max"}
    # contract type text decides which columns are numeric
    cc3 = check_columns(df, df, types={"id": "STRING(10)", "v": "FLOAT64", "name": "STRING"})
    assert cc3.filter("column_name = 'id'").count() == 1


def test_reconcile_rollup(spark):
    df = _t(spark)
    out = reconcile({"same": (df, df), "lossy": (df, df.filter("id > 0"))})
    got = {r.table_name: r.status for r in out.collect()}
    assert got == {"same": "SUCCESS", "lossy": "FAIL"}
    assert overall_status(out) == "FAIL"
    assert overall_status(out.filter("table_name = 'same'")) == "SUCCESS"
    assert overall_status(None) == "NO_ENTITIES"
    assert overall_status(out.limit(0)) == "NO_ENTITIES"


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert [(r.a, r.b, r.n_rows) for r in duplicate_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]
