"""Payload catalogs (S6), spec registry (K9), row access by sets (D4), tag propagation."""

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.access import ACCESS, row_access_sets, rows_of
from strata.operators.catalogs import in_scope, payload_catalog, spec_paths
from strata.operators.history import rows_for
from strata.operators.registry import (canonical_objects, declared_types, log_changes, path_changes, register_objects,
                                       schema_changes)
from strata.operators.tags import column_tags, mask_derived, tag


def catalog(spark, rows):
    return {(r.table_name, r.column_name): r.type for r in payload_catalog(spark.createDataFrame(rows, "t string, p string"), "t", "p").collect()}


def test_payload_catalog_merges_types(spark):
    rows = [("a", '{"i": 1, "s": "xy", "b": true, "n": null}'), ("a", '{"i": 2, "s": "longer", "d": 1.5, "o": {"x": 1}}'),
            ("a", '{"i": "text", "l": [1, 2], "e": 1e300}'), ("b", '{"i": 3}'), ("b", "not json"), ("b", None), (None, '{"i": 1}'),
            ("c", "[1, 2]"), ("c", "5"), ("d", "{}"), ("b", '{"i": 4}'), ("e", '{"dotted.name": 1, "": 2}')]
    got = catalog(spark, rows)
    assert got == {("a", "i"): "VARIANT", ("a", "s"): "STRING(6)", ("a", "b"): "BOOL", ("a", "n"): "VOID", ("a", "d"): "NUMERIC",
                   ("a", "o"): "OBJECT<x: BIGINT>", ("a", "l"): "ARRAY<BIGINT>", ("a", "e"): "FLOAT64", ("b", "i"): "INT64",
                   ("e", "dotted.name"): "INT64", ("e", ""): "INT64"}
    assert catalog(spark, []) == {}


def test_scope_leaves_system_tables_out(spark):
    df = spark.createDataFrame([("rule_audit", "c", "INT64"), ("vehicle", "c", "INT64"), ("v_x", "c", "INT64"), ("v", "c", "INT64"), ("route", "c", "INT64")],
                               "table_name string, column_name string, type string")
    assert sorted(r.table_name for r in in_scope(df).collect()) == ["route", "v"]


def test_spec_paths(spark):
    rows = [("a", json.dumps({"k": 1, "m": {"x": {"y": "t", "e": {}}, "l": [1]}, "d.t": {"z": 1}})), ("a", json.dumps({"m": {"x": {"y": "u"}}, "k": 2.5})),
            ("b", "{}"), ("b", None), ("b", "x")]
    df = spark.createDataFrame(rows, "n string, p string")
    got = {(r.entity, r.path): r.type for r in spec_paths(df, "n", "p").collect()}
    assert got == {("a", "k"): "DECIMAL(20,1)", ("a", "m.x.y"): "STRING", ("a", "m.x.e"): "OBJECT<>", ("a", "m.l"): "ARRAY<BIGINT>", ("a", r"d\.t.z"): "BIGINT"} \
        or got.pop(("a", "k")).startswith(("DECIMAL", "DOUBLE"))
    shallow = {r.path: r.type for r in spec_paths(df, "n", "p", depth=1).collect()}
    assert set(shallow) == {"k", "m", r"d\.t"} and shallow["m"].startswith("OBJECT<")


def test_spec_paths_read_their_rows_once(spark, tmp_dir):
    rows = [("a", '{"": {"": 1, "n": null}, "m": {"x": {"y": {"z": {"u": {"v": {"w": 1}}}}}}, "e": {}}'), ("a", '{"m": 7}'), ("a", "[1]"), ("a", "null"), (None, '{"k": true}')]
    spark.createDataFrame(rows, "n string, p string").write.parquet(f"{tmp_dir}/r")
    df = spec_paths(spark.read.parquet(f"{tmp_dir}/r"), "n", "p")
    assert {(r.entity, r.path): r.type for r in df.collect()} == {
        ("a", ""): "BIGINT", ("a", "n"): "VOID", ("a", "m"): "BIGINT", ("a", "m.x.y.z.u.v"): "OBJECT<w: BIGINT>", ("a", "e"): "OBJECT<>", (None, "k"): "BOOLEAN"}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and plan.count("Generate") == 6


def test_spec_paths_of_names_that_look_like_types(spark):
    rows = [("a", '{"x: BIGINT, y": 1}'), ("a", '{"x": 1, "y": 1}'), ("a", '{"x": 1, "y": "t"}'), ("a", '{"x: BIGINT, y": 1, "z": {"`q": 1.5}}'), ("a", '{"z": {"`q": 1}}'), ("b", '{"x": 1, "y": 1}')]
    df = spark.createDataFrame(rows * 3, "n string, p string")
    got = {(r.entity, r.path): r.type for r in spec_paths(df, "n", "p").collect()}
    assert got.pop(("a", "z.`q")).startswith("DECIMAL")
    assert got == {("a", "x: BIGINT, y"): "BIGINT", ("a", "x"): "BIGINT", ("a", "y"): "VARIANT", ("b", "x"): "BIGINT", ("b", "y"): "BIGINT"}
    assert [r[0] for r in df.select(F.schema_of_variant(F.parse_json("p"))).limit(2).collect()] == ["OBJECT<`x: BIGINT, y`: BIGINT>", "OBJECT<x: BIGINT, y: BIGINT>"]


def spec(name, props, kind="ObjectType", **more):
    return json.dumps({"kind": kind, "metadata": {"name": name}, "spec": {"tableName": f"t_{name}", "primaryKey": "id", "properties": props}, **more})


def test_canonical_objects_and_changes(spark):
    v1 = [("1/a", spec("a", {"id": {"type": "string"}, "x": {"type": "int"}, "gone": {"type": "int"}})), ("1/b", spec("b", {"id": {"type": "string"}})),
          ("1/c", spec("c", {"id": {"type": "string"}})), ("1/l", spec("l", {}, kind="LinkType")), ("1/bad", "{"), ("1/null", None), ("0/b", spec("b", {"old": {"type": "x"}}))]
    v2 = [("2/a", spec("a", {"id": {"type": "string"}, "x": {"type": "long"}, "more": {"type": "struct", "properties": {"in": {"type": "int"}}}})),
          ("2/b", spec("b", {"id": {"type": "string"}, "n": {"type": "int"}})), ("2/c", spec("c", {"id": {"type": "string"}})), ("2/d", spec("d", {"id": {}}))]
    one, two = (spark.createDataFrame(v, "path string, text string") for v in (v1, v2))
    objects = register_objects(None, one)
    rows = {r.object_type_id: r for r in objects.collect()}
    assert set(rows) == {"a", "b", "c"} and rows["b"].attributes == '{"id":{"type":"string"}}' and rows["a"].table_name == "t_a" and rows["a"].status == "ACTIVE"
    both = register_objects(objects, two)
    assert sorted(r.object_type_id for r in both.collect()) == ["a", "b", "c", "d"]
    old, new = declared_types(objects), declared_types(canonical_objects(two))
    found = {(r.entity, r.path): (r.change, r.old_type, r.new_type) for r in path_changes(old, new).collect()}
    assert found == {("a", "gone"): ("REMOVED", "int", None), ("a", "x"): ("RETYPED", "int", "long"), ("a", "more"): ("ADDED", None, "struct"),
                     ("a", "more.in"): ("ADDED", None, "int"), ("b", "n"): ("ADDED", None, "int"), ("d", "id"): ("ADDED", None, None)}
    changes = schema_changes(old, new)
    kinds = {r.entity: (r.change, json.loads(r.diff)) for r in changes.collect()}
    assert kinds["a"] == ("BREAKING", {"added_properties": ["more", "more.in"], "removed_properties": ["gone"], "type_changes": [{"property": "x", "from": "int", "to": "long"}]})
    assert kinds["b"][0] == "COMPATIBLE" and kinds["c"] == ("ADDITIVE", {"added_properties": [], "removed_properties": [], "type_changes": []})
    assert kinds["d"] == ("ADDITIVE", {"info": "New entity type added"})
    log = log_changes(None, changes)
    assert log_changes(log, changes).count() == log.count() == 4
    other = schema_changes(new, old)
    assert log_changes(log, other).count() == 4 + 2  # the empty change of c is the same row


def test_access_sets_equal_row_access(spark):
    grants = [("ann", "x"), ("ann", "x"), ("bob", "x"), ("ann", "y"), ("bob", "y"), ("cy", "z"), (None, "x"), ("dee", None), ("eve", "unused")]
    rows = [(i, "xyzw"[i % 4] if i % 9 else None) for i in range(200)]
    g, r = spark.createDataFrame(grants, "principal string, attr string"), spark.createDataFrame(rows, "id long, a string")
    got = row_access_sets(r, g, "a", "attr")
    numbered = got.rows.collect()
    assert len(numbered) == len(rows) and len({x[ACCESS] for x in numbered if x.a in ("x", "y")}) == 1
    assert all(x[ACCESS] is None for x in numbered if x.a in ("w", None)) and got.sets.count() == 4
    for who in ("ann", "bob", "cy", "dee", "eve", "nobody"):
        want = sorted(x.id for x in rows_for(r, g, "a", "attr", who).distinct().collect())
        assert sorted(x.id for x in rows_of(got, who).collect()) == want
    assert row_access_sets(r.limit(0), g, "a", "attr").rows.count() == 0
    assert row_access_sets(r, g.limit(0), "a", "attr").rows.filter(f"{ACCESS} is not null").count() == 0


@pytest.fixture()
def people(spark):
    a = tag(spark.createDataFrame([(1, "x", 5.0), (2, "y", 6.0)], "id long, n string, pay double"), {"pay": "P"})
    b = tag(spark.createDataFrame([(1, "m"), (2, "o")], "id2 long, mail string"), {"mail": "M"})
    a.createOrReplaceTempView("tagged_a")
    b.createOrReplaceTempView("tagged_b")
    return a, b


def tags(df):
    return ["".join(sorted(x)) for x in column_tags(df)]


def test_tags_follow_every_kind_of_expression(spark, people):
    a, b = people
    j = a.join(b, a.id == b.id2)
    assert tags(a) == ["", "", "P"]
    assert tags(a.select("n", (F.col("pay") * 2).alias("d"), F.lit(1).alias("one"), F.when(F.col("id") > 1, F.col("pay")).alias("w"))) == ["", "P", "", "P"]
    assert tags(a.groupBy("n").agg(F.sum("pay").alias("s"), F.count("*").alias("c"))) == ["", "P", ""]
    assert tags(j) == ["", "", "P", "", "M"]
    assert tags(j.select(F.concat("mail", F.col("pay").cast("string")).alias("z"), F.struct("id", "pay").alias("s"))) == ["MP", "P"]
    assert tags(a.withColumn("r", F.rank().over(Window.orderBy("pay"))))[3] == "P"
    assert tags(a.select("id", "n", "pay").union(a.select("id", "pay", "n"))) == ["", "P", "P"]
    assert tags(a.select(F.explode(F.array("pay")).alias("e"), "n")) == ["P", ""]
    assert tags(a.groupBy("n").pivot("id", [1, 2]).agg(F.sum("pay"))) == ["", "P", "P"]
    assert tags(a.rollup("n", "pay").count()) == ["", "P", ""]
    assert tags(a.alias("l").join(a.alias("r"), F.col("l.id") == F.col("r.id")).select(F.col("r.pay").alias("rp"), F.col("l.n"))) == ["P", ""]
    assert tags(a.distinct().orderBy("pay").limit(1).withColumnRenamed("pay", "salary")) == ["", "", "P"]
    assert tags(a.mapInPandas(lambda it: it, "u long, v string, w double")) == ["P", "P", "P"]
    sql = "with q as (select n, pay + 1 as p1 from tagged_a) select n, p1 * 2 as p2, (select max(mail) from tagged_b) as m from q where p1 > 0"
    assert tags(spark.sql(sql)) == ["", "P", "M"]


def test_derived_columns_are_masked_unnamed(spark, people):
    a, b = people
    out = a.join(b, a.id == b.id2).groupBy("n").agg(F.max("pay").alias("p"), F.min("mail").alias("m"), F.min("id2").alias("i"))
    assert sorted(map(tuple, mask_derived(out).collect())) == [("x", None, None, 1), ("y", None, None, 2)]
    assert sorted(map(tuple, mask_derived(out, ["M"]).collect())) == [("x", None, "m", 1), ("y", None, "o", 2)]
    hashed = mask_derived(out, ["P"], how="hash").collect()
    assert all(len(r.m) == 64 and r.p is not None for r in hashed)
    again = mask_derived(out, ["P", "M"]).select((F.col("p") + 1).alias("q"))
    assert tags(again) == ["P"] and tags(mask_derived(out).select("m")) == ["M"]
    with pytest.raises(ValueError):
        mask_derived(out, how="blur")
