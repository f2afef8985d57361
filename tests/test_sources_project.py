import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.project import (coerce_loose, conform, edge_view, get_object,
                                      get_objects, mask, props_json, retag_like, tag_columns,
                                      view_of)
from strata.ontology import Attribute, LOCATION, ObjectType
from strata.sources.csv import TypedColumn, drop_blank_rows, load_typed, scan_csv
from strata.sources.landing import land

from conftest import FIXTURES


def test_scan_csv_header_and_bad_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t.csv")
    with open(p, "w") as f:
        f.write('a,b,c\n1,,x\na,b,c\n2,"q,uo",y\n3,too,many,fields\n4,short\n')
    scan = scan_csv(spark, p)
    rows = sorted(map(tuple, scan.rows.collect()))
    assert rows == [("1", "", "x"), ("2", "q,uo", "y")]
    assert scan.rejected.count() == 2
    assert scan.header == ["a", "b", "c"]


def test_typed_load_and_blank_rows(spark):
    scan = scan_csv(spark, os.path.join(FIXTURES, "bulk", "vehicle.csv"))
    typed = load_typed(scan.rows, [TypedColumn("vehicle_id", "vehicle_id", "string"),
                                   TypedColumn("capacity_kg", "max_weight_capacity", "bigint")])
    assert typed.columns == ["vehicle_id", "max_weight_capacity"]
    assert typed.schema["max_weight_capacity"].dataType == T.LongType()
    seg = scan_csv(spark, os.path.join(FIXTURES, "bulk", "network_routing_segment.csv")).rows
    t2 = load_typed(seg, [TypedColumn("weight", "weight", "decimal(38,9)"),
                          TypedColumn("zulu_day", "zulu_day", "date")])
    assert t2.filter(F.col("weight").isNull() | F.col("zulu_day").isNull()).count() == 0
    blanks = spark.createDataFrame([("", " "), ("a", ""), (None, None)], "x string, y string")
    assert drop_blank_rows(blanks).count() == 1


def test_landing_dead_letter(spark, tmp_dir):
    d = os.path.join(tmp_dir, "land")
    os.makedirs(d)
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('{"id": 1, "v": "x"}\n{broken\n{"id": 2, "v": "y"}\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    out = land(spark, "ds1", d, schema)
    assert out.good.count() == 2
    dl = out.dead_letter.collect()
    assert len(dl) == 1 and dl[0].file_path.endswith("a.json") and dl[0].record == "{broken"
    missing = land(spark, "ds2", os.path.join(tmp_dir, "nope"), schema)
    assert missing.dead_letter.first().file_path == "ALL_FILES"


def test_coerce_loose(spark):
    df = spark.createDataFrame([("007",), ("1.5",), ("1.x",), ("-3",), ("",), (None,)], "v string")
    got = [(r.c.kind, r.c.as_long, r.c.as_double, r.c.as_text)
           for r in df.select(coerce_loose(F.col("v")).alias("c")).collect()]
    assert got[0][:2] == ("int", 7)
    assert got[1][0] == "float" and got[1][2] == 1.5
    assert got[2] == ("str", None, None, "1.x")
    assert got[3] == ("str", None, None, "-3")
    assert got[4][0] is None and got[5][0] is None


def test_view_lookup_conform(spark):
    df = spark.createDataFrame([("OAK", "x", "USA", "s", "extra")],
                               "location_cd string, owner string, country string, source string, z string")
    v = view_of(df, LOCATION, spark)
    assert v.columns == ["location_cd", "owner", "country", "source"]
    assert spark.table("v_location").count() == 1
    assert edge_view(df, "location_cd", "owner", "owner", ["country", "location_cd"]).columns == [
        "location_cd", "owner", "country"]
    assert get_object(df, "location_cd", "OAK").count() == 1
    assert get_objects(df, "location_cd", spark.createDataFrame([("OAK",)], "k string")).count() == 1
    contract = ObjectType("Hub", "hub", "hub_id", (Attribute("hub_id", "STRING(3)", True),
                                                   Attribute("tons", "INT64")))
    rows = spark.createDataFrame([("MEM", "5"), ("LONG", "x"), (None, "1")], "hub_id string, tons string")
    c = conform(rows, contract)
    assert [r.hub_id for r in c.good.collect()] == ["MEM"]
    bad = {r.hub_id: r.violations for r in c.bad.collect()}
    assert bad == {"LONG": ["hub_id: longer than 3", "tons: not INT64"], None: ["hub_id: required"]}


def test_props_json_and_masking(spark):
    df = spark.createDataFrame([(1, None, "2024-01-02")], "id long, n string, d string").withColumn(
        "d", F.col("d").cast("date")).withColumn("dec", F.lit(1.25).cast("decimal(10,2)"))
    js = df.select(props_json(df, ["n", "d", "dec"]).alias("j")).first().j
    assert js == '{"n":null,"d":"2024-01-02","dec":1.25}'
    tagged, changed = tag_columns(df, {"n": "Confidential/Finance/Payroll"})
    assert changed and not tag_columns(tagged, {"n": "Confidential/Finance/Payroll"})[1]
    assert mask(tagged).first().n is None
    assert mask(tagged, allowed_tags=["Confidential/Finance/Payroll"]).schema["n"].metadata
    derived = retag_like(tagged.withColumn("n2", F.upper("n")), "n2", "n")
    assert derived.schema["n2"].metadata["policy_tag"] == "Confidential/Finance/Payroll"
    # tags survive a plain projection
    assert tagged.select("n").schema["n"].metadata["policy_tag"]


def test_seed_tables_typed_load(spark):
    """S2 over the fixture CSVs: FK order, counts, renames, types, and which
    empty texts stay '' (keys) or become NULL (optional text)."""
    from strata.sources.csv import load_seed_tables
    got = load_seed_tables(spark, os.path.join(FIXTURES, "bulk"))
    assert list(got) == ["operation", "network_routing", "network_routing_segment",
                         "transit_path", "vehicle", "driver", "maintenance_log"]
    assert {t: df.count() for t, df in got.items()} == {
        "operation": 12, "network_routing": 8, "network_routing_segment": 10,
        "transit_path": 7, "vehicle": 9, "driver": 7, "maintenance_log": 7}
    assert got.rejected.count() == 0
    assert got["vehicle"].columns == ["vehicle_id", "vehicle_type", "max_weight_capacity"]
    assert got["driver"].columns == ["driver_id", "vehicle_id", "certification_level", "status"]
    seg = got["network_routing_segment"].schema
    assert [seg[c].dataType.simpleString() for c in ("weight", "pieces", "zulu_day")] == [
        "decimal(38,9)", "bigint", "date"]
    nr = {r.routing_id: r for r in got["network_routing"].collect()}
    assert nr["R-4"].origin_operation_id == ""          # key column: '' kept
    drv = {r.driver_id: r for r in got["driver"].collect()}
    assert drv["D3"].vehicle_id is None               # optional text: '' -> NULL
    sev = {r.log_id: r.severity for r in got["maintenance_log"].collect()}
    assert sorted(v for v in sev.values() if v is not None)[0] == 0 and max(sev.values()) == 9


def test_seed_tables_reject_what_does_not_parse(spark, tmp_dir):
    """Bad values and malformed lines leave their tables with a reason; the other rows stay."""
    import shutil

    from strata.sources.csv import load_seed_tables
    shutil.copytree(os.path.join(FIXTURES, "bulk"), os.path.join(tmp_dir, "bulk"))

    def add(table, *lines):
        with open(os.path.join(tmp_dir, "bulk", f"{table}.csv"), "a") as f:
            f.write("\n".join(lines) + "\n")
    add("vehicle", "V90,LORRY,x,12 tons,ALT-A,ACTIVE", "V91,LORRY,x,5.7,ALT-A,ACTIVE", "V92,LORRY,x, 70 ,ALT-A,ACTIVE", "V93,LORRY,x,,ALT-A,ACTIVE", " ,,,,, ")
    add("network_routing", "R-90,A,B,X,2025-13-01,W", "R-91,A,B,X,,W", "R-92,A,B")
    add("network_routing_segment", "G90,R-1,A,B,ROAD,heavy,many,2025-01-01")
    got = load_seed_tables(spark, os.path.join(tmp_dir, "bulk"))
    caps = {r.vehicle_id: r.max_weight_capacity for r in got["vehicle"].collect()}
    assert len(caps) == 11 and caps["V92"] == 70 and caps["V93"] is None
    assert got["network_routing"].count() == 8 and got["network_routing_segment"].count() == 10
    bad = sorted((r.table_name, r.record[:40], tuple(r.reasons)) for r in got.rejected.collect())
    assert [(t, why) for t, _, why in bad] == [
        ("network_routing", ("malformed line",)), ("network_routing", ("zulu_day: not date",)), ("network_routing", ("zulu_day: not date",)),
        ("network_routing_segment", ("weight: not decimal(38,9)", "pieces: not bigint")),
        ("vehicle", ("capacity_kg: not bigint",)), ("vehicle", ("capacity_kg: not bigint",))]
    assert bad[0][1] == "R-92,A,B"


def test_get_object_by_type_name(spark):
    from strata.operators.project import get_object_by_type
    spark.createDataFrame([("H1", "Memphis"), ("H2", "Louisville")],
                          "id string, name string").createOrReplaceTempView("hub")
    assert [r.name for r in get_object_by_type(spark, "Hub", "H2").collect()] == ["Louisville"]
    assert get_object_by_type(spark, "HUB", "nope").count() == 0
