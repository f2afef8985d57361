"""Values at the edges: exact checks, marks across zones, rejected rows, merges with NULLs and ties."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.ontology import Attribute, ObjectType
from strata.operators.contracts import catalog_drift, drift_verdict, scan_catalog
from strata.operators.history import current_state, schema_checked
from strata.operators.project import coerce_loose, conform, props_json
from strata.operators.reconcile import check_columns, compare_checksums, file_checksums, reconcile
from strata.operators.registry import register
from strata.operators.retrieve import index_documents, rejected_documents
from strata.sinks.upsert import apply_actions, upsert
from strata.sinks.writes import incremental_append, incremental_rows, write_date_partitioned
from strata.sources.csv import TypedColumn, load_typed_checked, scan_csv


def test_a_difference_of_one_in_ten_billion_fails(spark):
    a = spark.createDataFrame([(10_000_000_000, 1.0)], "k long, x double")
    b = spark.createDataFrame([(10_000_000_001, 1.0 + 1e-12)], "k long, x double")
    ok = {(r.column_name, r.agg): r.ok for r in check_columns(a, b).collect()}
    assert not ok["k", "sum"] and not ok["k", "min"] and not ok["k", "max"] and ok["k", "count"]
    assert ok["x", "sum"] and not ok["x", "max"]
    assert reconcile({"t": (a, b)}).first().status == "FAIL"


def test_integer_sums_past_64_bits(spark):
    top = 2 ** 63 - 1
    a = spark.createDataFrame([(top,), (top,), (top,)], "k long")
    b = spark.createDataFrame([(top,), (top,), (top - 1,)], "k long")
    assert reconcile({"t": (a, a)}).first().status == "SUCCESS"
    assert reconcile({"t": (a, b)}).first().status == "FAIL"


def test_marks_do_not_depend_on_a_zone(spark):
    src = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-03-10 02:30:00.000001'), "
                    "(2, TIMESTAMP_NTZ'2024-03-10 02:30:00.000002') t(id, event_timestamp)")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r.id for r in incremental_rows(src, src.filter("id = 1")).collect()] == [2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_an_empty_partitioned_target_loads_nothing(spark, tmp_dir):
    src = spark.sql("SELECT 1 id, TIMESTAMP'2024-01-01 00:00:00' event_timestamp")
    path = os.path.join(tmp_dir, "t")
    write_date_partitioned(src.limit(0), path, "event_timestamp")
    assert incremental_append(spark, src, path) == 0
    os.makedirs(os.path.join(tmp_dir, "broken"))
    with open(os.path.join(tmp_dir, "broken", "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        incremental_append(spark, src, os.path.join(tmp_dir, "broken"))


def test_rejected_rows_carry_a_reason(spark):
    raw = spark.createDataFrame([("1", "2024-01-01"), ("x", "2024-13-01"), ("", "")], "n string, d string")
    got = load_typed_checked(raw, [TypedColumn("n", "n", "bigint"), TypedColumn("d", "d", "date")])
    assert [(r.n, r.d) for r in got.rows.collect()] == [(1, dt.date(2024, 1, 1)), (None, None)]
    assert [(r.n, r.reasons) for r in got.rejected.collect()] == [("x", ["n: not bigint", "d: not date"])]
    c = conform(raw, ObjectType("T", "t", "n", (Attribute("n", "INT64"), Attribute("d", "STRING(MAX)"))))
    assert [r.violations for r in c.bad.filter("d = '2024-13-01'").collect()] == [["n: not INT64"]]
    docs = spark.createDataFrame([("a", "t"), ("b" * 51, "t"), (None, "t"), ("c", "")], "id string, text string")
    assert index_documents(None, docs).count() == 1
    assert sorted(r.reason for r in rejected_documents(docs).collect()) == ["id over 50 characters", "no id", "no text"]


def test_json_types_are_checked_as_written(spark):
    rows = ['{"k": 5}', '{"k": 5.7}', '{"k": "5"}', '{"k": true}', '{"k": 3000000000}', "{}", "[1]", "nope", None]
    got = schema_checked(spark.createDataFrame([(r,) for r in rows], "j string"), "j",
                         T.StructType([T.StructField("k", T.IntegerType())]))
    assert [r.parsed.k for r in got.good.collect()] == [5]
    assert got.rejected.count() == 8


def test_number_texts(spark):
    texts = ["7", "1.5", "1.5f", "1.5d", "0x1p3", "12\n", "9" * 40, "-3", "1e3", "1.e3", ".5"]
    got = {r.s: r.k for r in spark.createDataFrame([(t,) for t in texts], "s string")
           .select("s", coerce_loose(F.col("s"))["kind"].alias("k")).collect()}
    assert got == {"7": "int", "1.5": "float", "1.5f": "str", "1.5d": "str", "0x1p3": "str", "12\n": "str",
                   "9" * 40: "str", "-3": "str", "1e3": "str", "1.e3": "float", ".5": "float"}


def test_times_in_json_are_iso(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 03:04:05' a, TIMESTAMP_NTZ'2024-01-02 03:04:05.5' b, DATE'2024-01-02' c")
    assert df.select(props_json(df, ["a", "b", "c"]).alias("p")).first().p == (
        '{"a":"2024-01-02T03:04:05","b":"2024-01-02T03:04:05.500000","c":"2024-01-02"}')


def test_live_table_equal_to_its_contract_shows_no_drift(spark):
    spark.sql("SELECT 1L id, 'a' name, 1.5D x, DATE'2024-01-01' d").createOrReplaceTempView("drift_live")
    live = scan_catalog(spark, tables=["drift_live"])
    contract = spark.createDataFrame([("drift_live", "id", "INT64"), ("drift_live", "name", "STRING(MAX)"),
                                      ("drift_live", "x", "FLOAT64"), ("drift_live", "d", "DATE")],
                                     "table_name string, column_name string, type string")
    report = catalog_drift(contract, live)
    assert {r.kind for r in report.collect()} == {"OK"} and drift_verdict(report).first().status == "NO_DRIFT"


def test_null_keys_are_refused_and_null_payloads_set(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    with pytest.raises(Exception, match="NULL key"):
        upsert(t, spark.createDataFrame([(None, "x")], "id int, v string"), "id").collect()
    acts = spark.createDataFrame([(1, "z", 1), (1, None, 2), (9, "q", 1)], "id int, v string, n int")
    assert sorted((r.id, r.v) for r in apply_actions(t, acts, "id", "v", "n").collect()) == [(1, None), (2, "b")]


def test_registry_keeps_the_first_and_adds_copies(spark):
    first = register(None, spark.createDataFrame([("f1", "t"), ("f2", "t")], "path string, text string"))
    again = register(first, spark.createDataFrame([("f0", "t"), ("f9", "u")], "path string, text string"))
    assert sorted((r.first_path, r.n_copies, r.text) for r in again.collect()) == [("f1", 3, "t"), ("f9", 1, "u")]


def test_a_delete_wins_a_tie(spark):
    led = spark.createDataFrame([(1, 5, "DELETE", "a"), (1, 5, "UPDATE", "b"), (2, 5, None, "c")],
                                "k int, s int, op string, v string")
    assert [(r.k, r.v) for r in current_state(led, "k", ["s"], "op", ["v"]).collect()] == [(2, "c")]


def test_files_are_paired_by_the_path_below_the_root(spark, tmp_dir):
    for root, texts in (("l", {"x": "1", "y": "2"}), ("r", {"x": "1", "y": "3"})):
        for sub, text in texts.items():
            os.makedirs(os.path.join(tmp_dir, root, sub))
            with open(os.path.join(tmp_dir, root, sub, "part-0"), "w") as f:
                f.write(text)
    for end in ("", "/*/part-*"):
        left, right = (file_checksums(spark, os.path.join(tmp_dir, r) + end) for r in "lr")
        assert sorted((r.file_name, r.status) for r in compare_checksums(left, right).collect()) == [
            ("x/part-0", "MATCH"), ("y/part-0", "DIFFERENT")]


def test_headers_with_dots(spark, tmp_dir):
    path = os.path.join(tmp_dir, "d.csv")
    with open(path, "w") as f:
        f.write("a.b,c\n1,2\n")
    assert [tuple(r) for r in scan_csv(spark, path).rows.collect()] == [("1", "2")]
