from pyspark.sql import functions as F

from strata.ontology import ROUTE, WAYPOINT, catalog_frame, from_spec, normalize_type, to_struct
from strata.operators.contracts import (catalog_drift, contract_diff, drift_verdict,
                                        plan_gate, scan_catalog)
from strata.operators.graph import (EdgeTable, NodeTable, edge_union, expand, follow,
                                    ghost_nodes, graph_counts, match_path, nest, node_union,
                                    path_elements, route_context, route_summary)


def _cat(spark, rows):
    return spark.createDataFrame(rows, "table_name string, column_name string, type string")


def test_contract_diff_kinds(spark):
    old = _cat(spark, [("hub", "id", "STRING"), ("hub", "cap", "INT64"),
                       ("route", "id", "STRING"), ("loc", "id", "STRING"), ("loc", "x", "INT64")])
    new = _cat(spark, [("hub", "id", "STRING"), ("hub", "cap", "INT64"), ("hub", "name", "STRING"),
                       ("route", "id", "string"), ("loc", "id", "STRING"),
                       ("fresh", "id", "STRING")])
    got = {r.table_name: (r.kind, r.added, r.removed, r.type_changes)
           for r in contract_diff(old, new).collect()}
    assert got["hub"] == ("COMPATIBLE", ["name"], [], [])
    assert got["route"][0] == "BREAKING" and got["route"][3] == ["id"]  # raw-text compare
    assert got["loc"] == ("BREAKING", [], ["x"], [])
    assert got["fresh"][0] == "ADDITIVE"
    assert plan_gate(contract_diff(old, new)) == "BLOCKED"
    assert plan_gate(contract_diff(old, old)) == "VALID"


def test_catalog_drift_and_verdict(spark):
    contract = _cat(spark, [("t", "a", "INT64"), ("t", "b", "STRING(10)"), ("t", "d", "DATE"),
                            ("t", "w", "string(max)"), ("new_t", "x", "INT64")])
    live = _cat(spark, [("t", "a", "INT64"), ("t", "b", "INT64"), ("t", "e", "DATE"),
                        ("t", "w", "STRING(20)"), ("old_t", "y", "INT64")])
    rep = catalog_drift(contract, live)
    got = {(r.table_name, r.column_name): r.kind for r in rep.collect()}
    assert got == {("new_t", None): "CREATE_TABLE", ("old_t", None): "EXTRA_TABLE",
                   ("t", "a"): "OK", ("t", "b"): "BREAKING", ("t", "d"): "ADD_COLUMN",
                   ("t", "e"): "EXTRA_COLUMN", ("t", "w"): "COMPATIBLE_CHANGE"}
    assert drift_verdict(rep).first().status == "BREAKING_DRIFT"
    only_evo = catalog_drift(contract, live, tables=["new_t"])
    assert drift_verdict(only_evo).first().ok is True
    assert drift_verdict(only_evo, "strict").first().status == "EVOLUTION_BLOCKED"
    assert drift_verdict(only_evo, "manual").first().ok is True
    none = catalog_drift(live, live)
    assert drift_verdict(none).first().status == "NO_DRIFT"
    # narrowing a string is breaking
    narrow = catalog_drift(_cat(spark, [("t", "s", "STRING(5)")]),
                           _cat(spark, [("t", "s", "STRING(9)")]))
    assert narrow.first().kind == "BREAKING"


def test_scan_catalog_skips_views_and_wildcard(spark):
    for name in ("vehicle", "v_route", "hub", "rule_audit"):
        spark.range(1).createOrReplaceTempView(name)
    names = {r.table_name for r in scan_catalog(spark).collect()}
    assert "hub" in names
    assert not names & {"vehicle", "v_route", "rule_audit"}  # '_' is a wildcard


def test_spec_shapes_and_types(spark):
    a = from_spec({"metadata": {"name": "Hub"}, "spec": {"table": "hub", "primaryKey": ["id", "x"],
                   "attributes": [{"name": "id", "type": "STRING(64)", "required": True}]}})
    b = from_spec({"name": "Hub", "tableName": "hub", "primaryKey": "id",
                   "properties": {"id": {"type": "STRING(64)", "required": True}}})
    assert a.primary_key == b.primary_key == "id" and a.attributes == b.attributes
    assert a.storage == "managed_by_platform"
    assert normalize_type(None) == "STRING(MAX)" and normalize_type("string (10)") == "STRING(10)"
    st = to_struct(from_spec({"table": "x", "attributes": [
        {"name": "n", "type": "NUMERIC"}, {"name": "d", "type": "DATE"},
        {"name": "b", "type": "bytes"}]}))
    assert [f.dataType.simpleString() for f in st.fields] == ["decimal(38,9)", "date", "string"]
    assert catalog_frame(spark, [ROUTE, WAYPOINT]).count() == 4 + 11


def test_route_context_and_summary(spark):
    routes = spark.createDataFrame([("R1",), ("R2",)], "route_id_txt string")
    wps = spark.createDataFrame(
        [("R1", "2", "MEM", "T2"), ("R1", "10", "SEA", "T3"), ("R1", "1", "OAK", "T1")],
        "route_id_txt string, leg_no string, location_cd string, transit_id string")
    tcs = spark.createDataFrame([("T1", "AIR", "C1"), ("T2", "", "C2"), ("T3", "GROUND", None)],
                                "transit_id string, mode string, carrier string")
    cols = ["route_id_txt", "leg_no", "location_cd", "mode", "carrier"]
    ctx = route_context(routes, wps, tcs, "route_id_txt", "route_id_txt", "transit_id",
                        "transit_id", "leg_no", [routes["route_id_txt"], "leg_no",
                                                 "location_cd", "mode", "carrier"], route_id="R1")
    assert [r.leg_no for r in ctx.collect()] == ["1", "2", "10"]  # numeric order
    s = route_summary(ctx.toDF(*cols), "route_id_txt", "leg_no", "location_cd", "mode",
                      "carrier").first()
    assert s.stops == "OAK -> MEM -> SEA"
    assert (s.last_mode, s.last_carrier) == ("GROUND", "C2")  # last non-empty in leg order


def test_graph_union_ghosts_counts(spark):
    people = spark.createDataFrame([(1, "a"), (None, "b")], "id long, name string")
    links = spark.createDataFrame([(1, 2, 5), (1, None, 6)], "src long, dst long, w int")
    nodes = node_union([NodeTable("person", people, "id")])
    edges = edge_union([EdgeTable("knows", links, "person", "src", "person", "dst")],
                       with_props=True)
    assert {r.node_key for r in nodes.collect()} == {"1", ""}
    e = {r.edge_key: (r.target, r.props) for r in edges.collect()}
    assert e == {"1-2": ("2", '{"w":5}'), "1-None": ("None", '{"w":6}')}
    ghosts = {(r.node_type, r.node_key) for r in ghost_nodes(nodes, edges).collect()}
    assert ghosts == {("person", "2"), ("person", "None")}
    c = graph_counts(nodes, edges).first()
    assert (c.n_nodes, c.n_edges) == (2, 2)


def test_match_path_elements_and_expand(spark):
    d = spark.createDataFrame([("d1", "v1"), ("d2", "v1")], "driver_id string, vehicle_id string")
    v = spark.createDataFrame([("v1", "h1")], "vid string, hub string")
    h = spark.createDataFrame([("h1", "Memphis")], "hub_id string, hub_name string")
    m = match_path(d, ("vehicle_id", "vid"), v, ("hub", "hub_id"), h)
    assert m.count() == 2
    nodes, edges = path_elements(m, [("driver", "driver_id"), ("vehicle", "vid"),
                                     ("hub", "hub_id")], ["operates", "stationed_at"])
    assert nodes.count() == 6 and edges.count() == 4  # duplicates kept
    assert {r.edge_key for r in edges.collect()} == {"d1-v1", "d2-v1", "v1-h1"}
    nd = spark.createDataFrame([("v1", "truck"), ("h1", "hub")], "key string, kind string")
    ed = spark.createDataFrame([("d1", "v1"), ("v1", "h1")], "source string, target string")
    starts = spark.createDataFrame([("d1",), ("zz",)], "k string")
    out = expand(nd, ed, "key", starts=starts)
    assert [(r.source, r.target_kind) for r in out.collect()] == [("d1", "truck")]
    assert nest(out, "source", ["target_key", "target_kind"]).first().neighbours[0].target_kind \
        == "truck"


def test_follow_declared_relationship(spark):
    rel = ROUTE.relationships[1]  # route -> waypoint via route_id_txt
    r = spark.createDataFrame([("R1", "s")], "route_id_txt string, source_cd string")
    w = spark.createDataFrame([("W1", "R1"), ("W2", "R9")], "waypoint_id string, route_id_txt string")
    out = follow(r, w, rel)
    assert [r.waypoint_id for r in out.collect()] == ["W1"]


def test_route_summary_across_blocks(spark):
    rows = [("R", str(i), f"S{i}", "AIR" if i in (2, 5) else "", "C" if i == 1 else None)
            for i in (7, 3, 1, 6, 2, 5, 4, 11)]
    df = spark.createDataFrame(rows, "r string, leg string, stop string, mode string, carrier string")
    s = route_summary(df, "r", "leg", "stop", "mode", "carrier", block=2).first()
    assert s.stops == " -> ".join(f"S{i}" for i in (1, 2, 3, 4, 5, 6, 7, 11))
    assert (s.last_mode, s.last_carrier) == ("AIR", "C")
    parts = route_summary(df, "r", "leg", "stop", "mode", "carrier", block=2,
                          parts=True).orderBy("part").collect()
    assert [p.part for p in parts] == [0, 1, 2, 3, 5]
    assert " -> ".join(p.stops for p in parts) == s.stops
    assert {(p.last_mode, p.last_carrier) for p in parts} == {("AIR", "C")}
    # a NULL route keeps its rows in both forms
    nulls = spark.createDataFrame([(None, "1", "A", "SEA", None), (None, "2", "B", "", None)],
                                  "r string, leg string, stop string, mode string, carrier string")
    whole = route_summary(nulls, "r", "leg", "stop", "mode", "carrier").collect()
    split = route_summary(nulls, "r", "leg", "stop", "mode", "carrier", parts=True).collect()
    assert [(w.r, w.stops, w.last_mode) for w in whole] == [(None, "A -> B", "SEA")]
    assert [(p.r, p.stops, p.last_mode) for p in split] == [(None, "A -> B", "SEA")]


def test_route_text():
    from strata.operators.graph import route_text
    assert route_text(None, "r", "m", "c") == "No route data found"
    row = {"r": "R1", "stops": "OAK -> MEM", "m": "AIR", "c": None}
    assert route_text(row, "r", "m", "c") == (
        "Route:\nR1\n\nCarrier:\n\n\nMode:\nAIR\n\nStops:\nOAK -> MEM")


def test_unions_skip_a_failing_table(spark):
    ok = spark.createDataFrame([(1, 2)], "a long, b long")
    nodes = node_union([NodeTable("good", ok, "a"), NodeTable("bad", ok, "missing")],
                       with_props=False)
    assert [(r.node_type, r.node_key) for r in nodes.collect()] == [("good", "1")]
    edges = edge_union([EdgeTable("bad", ok, "x", "nope", "y", "b"),
                        EdgeTable("good", ok, "x", "a", "y", "b")])
    assert [(r.rel_type, r.edge_key) for r in edges.collect()] == [("good", "1-2")]
    empty = node_union([NodeTable("bad", ok, "missing")])
    assert empty.count() == 0 and empty.columns == ["node_type", "node_key", "props"]


def test_traverse_link_by_name(spark):
    import pytest

    from strata.operators.graph import traverse_link
    one = spark.createDataFrame([("P1", "F1"), ("P2", "F2")], "source_id string, target_id string")
    multi = spark.createDataFrame([("P1", "F1", "C9")],
                                  "source_id string, flight string, target_id string")
    tables = {("Package", "to_flight"): (one, "source_id"),
              ("Package", "to_flight_to_customer"): (multi, "source_id")}
    assert [r.target_id for r in traverse_link(tables, "Package", "to_flight",
                                               key="P2").collect()] == ["F2"]
    keys = spark.createDataFrame([("P1",)], "k string")
    assert [r.target_id for r in traverse_link(tables, "Package", "to_flight_to_customer",
                                               keys=keys).collect()] == ["C9"]
    with pytest.raises(ValueError, match="not supported"):
        traverse_link(tables, "Flight", "to_flight", key="P1")
