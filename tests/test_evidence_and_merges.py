"""Repeats, missing values and branches that the driver's tables do not show."""

from pyspark.sql import functions as F

from strata.operators.graph import route_summary, route_texts
from strata.operators.reconcile import column_aggregates
from strata.operators.retrieve import document_evidence, index_documents
from strata.sinks.upsert import latest_per_key


def test_repeats_keep_the_same_row_on_every_run(spark):
    rows = [("a", 1, "x"), ("a", 2, None), ("a", 2, "b"), ("b", None, "q"), ("b", None, None), (None, 5, "z")]
    want = [(None, 5, "z"), ("a", 2, "b"), ("b", None, "q")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, n long, s string").repartition(4)
        assert sorted(map(tuple, latest_per_key(df, "k").collect()), key=repr) == sorted(want, key=repr)
        assert latest_per_key(df, "k").columns == ["k", "n", "s"]
    with_map = spark.createDataFrame([("a", {"x": 1})], "k string, m map<string,int>")
    assert latest_per_key(with_map, "k").count() == 1


def test_index_takes_the_newest_of_repeats(spark):
    rows = [("1", "old", 1), ("1", "new", 3), ("1", "mid", 2), ("2", "t", 1), ("", "t", 1), ("x" * 51, "t", 1), ("3", "", 1)]
    docs = spark.createDataFrame(rows, "id string, text string, at long")
    for df in (docs, docs.orderBy(F.desc("at"))):
        assert sorted((r.id, r.text) for r in index_documents(None, df, order_by="at").collect()) == [("1", "new"), ("2", "t")]
        assert sorted((r.id, r.text) for r in index_documents(None, df).collect()) == [("1", "old"), ("2", "t")]
    held = index_documents(None, docs, order_by="at")
    more = spark.createDataFrame([("2", "u", 9), ("2", "v", 8), ("4", "w", 1)], "id string, text string, at long")
    assert sorted((r.id, r.text) for r in index_documents(held, more, order_by="at").collect()) == [("1", "new"), ("2", "u"), ("4", "w")]


def test_evidence_has_all_links_and_misses_none(spark):
    hits = spark.createDataFrame([(1, "e1", "text one"), (2, "e2", "text two"), (3, "nobody", "text three"), (4, None, "text four")], "id long, e string, t string")
    entities = spark.createDataFrame([("e1", "first"), ("e2", "second"), ("e9", "other")], "key string, name string")
    links = spark.createDataFrame([("e1", i, f"seg {i:02d}") for i in range(10)] + [("e9", 1, "seg x")], "of string, n long, line string")

    def run(chunk=None):
        out = document_evidence(hits, entities, links, "id", "e", "key", "of", F.col("t"), F.concat(F.lit("entity "), F.col("name")), F.col("line"), chunk)
        return {(r.id, r.part): r.evidence.split("\n") for r in out.collect()}
    got = run()
    assert got[1, 0] == ["text one", "entity first", *[f"seg {i:02d}" for i in range(10)]]
    assert got[2, 0] == ["text two", "entity second"] and got[3, 0] == ["text three"] and got[4, 0] == ["text four"] and len(got) == 4
    parts = run(F.col("n") % 3)
    assert {k for k in parts if k[0] == 1} == {(1, 0), (1, 1), (1, 2)}
    assert sorted(x for k, v in parts.items() if k[0] == 1 for x in v[2:]) == [f"seg {i:02d}" for i in range(10)]


def test_route_text_shows_missing_stops(spark):
    legs = spark.createDataFrame([("r", 1, "a", "", "c1"), ("r", 2, None, "AIR", None), ("r", 3, "c", None, ""), ("q", 1, None, None, None)],
                                 "route string, leg long, stop string, mode string, carrier string")
    s = route_summary(legs, "route", "leg", "stop", mode="mode", carrier="carrier")
    got = {r.route: r.t for r in s.select("route", route_texts(s, "route", "last_mode", "last_carrier").alias("t")).collect()}
    assert got["r"] == "Route:\nr\n\nCarrier:\nc1\n\nMode:\nAIR\n\nStops:\na -> None -> c"
    assert got["q"] == "Route:\nq\n\nCarrier:\n\n\nMode:\n\n\nStops:\nNone"


def test_whole_numbers_are_exact(spark):
    big = 2**53
    df = spark.createDataFrame([(big + 1, "1.10"), (big + 3, "2.20")], "n long, d string").select("n", F.col("d").cast("decimal(20,2)").alias("d"))
    other = df.withColumn("n", F.col("n") + F.when(F.col("n") == big + 1, 1).otherwise(0))
    exact, changed = ({(r.column_name, r.agg): r.exact for r in column_aggregates(x).collect()} for x in (df, other))
    assert exact["n", "sum"] == str(2 * big + 4) and exact["n", "min"] == str(big + 1) and exact["d", "sum"] == "3.30" and exact["*", "count"] == "2"
    assert changed["n", "sum"] != exact["n", "sum"] and changed["n", "min"] != exact["n", "min"]
    assert {(r.column_name, r.agg): r.exact for r in column_aggregates(df.limit(0)).collect()}["n", "sum"] is None
