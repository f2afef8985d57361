from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.history import (current_state, hash_sample, nested_children,
                                      retention_tier, row_access, rows_for, schema_checked,
                                      time_bounded_join, unused, usage_parity)
from strata.operators.registry import log_changes, raw_registry, register
from strata.operators.retrieve import (index_documents, match_band, prompt, query_vector,
                                       vector_literal, vector_topk)


def test_ledger_state_and_time_travel(spark):
    led = spark.createDataFrame(
        [("k1", 1, "INSERT", "a"), ("k1", 2, "UPDATE", "b"), ("k2", 1, "INSERT", "x"),
         ("k2", 3, "DELETE", None)], "k string, seq int, op string, v string")
    now = {r.k: r.v for r in current_state(led, "k", ["seq"], "op", ["v"]).collect()}
    assert now == {"k1": "b"}
    then = {r.k: r.v for r in current_state(led, "k", ["seq"], "op", ["v"], as_of=F.lit(1),
                                            ts="seq").collect()}
    assert then == {"k1": "a", "k2": "x"}


def test_row_access_and_time_bounded(spark):
    rows = spark.createDataFrame([(1, "EU"), (2, "US")], "id int, region string")
    grants = spark.createDataFrame([("ann", "EU"), ("bob", "US"), ("bob", "EU")],
                                   "principal string, region string")
    assert row_access(rows, grants, "region", "region").count() == 3
    assert [r.id for r in rows_for(rows, grants, "region", "region", "ann").collect()] == [1]
    ev = spark.createDataFrame([(1, 5), (1, 15), (2, 5)], "k int, t int")
    link = spark.createDataFrame([(1, 0, 10)], "lk int, a int, b int")
    assert time_bounded_join(ev, link, "k", "lk", "t", "a", "b").count() == 1


def test_nested_children_empty_parent(spark):
    p = spark.createDataFrame([(1,), (2,)], "pk int")
    c = spark.createDataFrame([(1, "b"), (1, "a")], "fk int, name string")
    got = {r.pk: [x.name for x in r.children] for r in
           nested_children(p, c, "pk", "fk", ["name"]).collect()}
    assert got == {1: ["a", "b"], 2: []}


def test_schema_checked(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": "x"}',), ("[1]",), ("nope",)], "p string")
    c = schema_checked(df, "p", T.StructType([T.StructField("k", T.IntegerType())]))
    assert [r.parsed.k for r in c.good.collect()] == [1]
    assert c.rejected.count() == 3


def test_unused_tiers_parity_sample(spark):
    ds = spark.createDataFrame([("a",), ("b",)], "name string")
    use = spark.createDataFrame([("a", 100), ("b", 5)], "name string, day int")
    assert [r.name for r in unused(ds, use, "name", "name", "day", F.lit(10)).collect()] == ["b"]
    ages = spark.createDataFrame([(0,), (31,), (400,), (2000,), (3000,)], "d int")
    assert [r.t for r in ages.select(retention_tier(F.col("d")).alias("t")).collect()] == [
        "0-30d", "31-365d", "1-3y", "3-7y", "7y+"]
    ev = spark.createDataFrame([("x", 1), ("x", 5), ("x", 6), ("y", 9)], "g string, t int")
    got = {r.g: (r.historical, r.recent, r.ratio) for r in
           usage_parity(ev, "g", "t", F.lit(5)).collect()}
    assert got == {"x": (1, 2, 2.0), "y": (0, 1, None)}
    big = spark.range(2000)
    s1 = {r.id for r in hash_sample(big, "id", 10).collect()}
    assert s1 == {r.id for r in hash_sample(big.repartition(5), "id", 10).collect()}
    assert 100 < len(s1) < 300


def test_registry_collapses_copies(spark):
    texts = spark.createDataFrame([("f1", "spec A"), ("f2", "spec A"), ("f3", "spec B")],
                                  "path string, text string")
    reg = raw_registry(texts)
    assert {(r.first_path, r.n_copies) for r in reg.collect()} == {("f1", 2), ("f3", 1)}
    again = register(reg, spark.createDataFrame([("f9", "spec C")], "path string, text string"))
    assert again.count() == 3
    ch = spark.createDataFrame([("hub", "ADD", '{"c":1}'), ("hub", "ADD", '{"c":1}')],
                               "entity string, change string, diff string")
    log = log_changes(None, ch)
    assert log.count() == 1 and log_changes(log, ch).count() == 1


def test_vector_topk(spark):
    vecs = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]),
                                  (3, [0.0, 0.0]), (4, [2.0, 0.0])], "id int, v array<float>")
    top = vector_topk(vecs, "id", "v", vector_literal([1.0, 0.0]), 3).collect()
    assert [r.id for r in top] == [0, 4, 2]  # tie at 1.0 broken by id
    assert abs(top[2].score - 0.7071) < 1e-3
    allrows = vector_topk(vecs, "id", "v", query_vector(vecs, "id", "v", 1), 99).collect()
    assert len(allrows) == 5 and [r for r in allrows if r.id == 3][0].score == 0.0
    bands = vecs.select(match_band(F.lit(0.51)).alias("a"), match_band(F.lit(0.5)).alias("b")).first()
    assert (bands.a, bands.b) == ("Match", "Partial")


def test_index_documents_and_prompt(spark):
    docs = spark.createDataFrame([("d1", "t1"), ("", "t"), ("x" * 51, "t"), ("d2", None)],
                                 "id string, text string")
    idx = index_documents(None, docs)
    assert [r.id for r in idx.collect()] == ["d1"]
    idx2 = index_documents(idx, spark.createDataFrame([("d1", "t1b")], "id string, text string"))
    assert idx2.first().text == "t1b"
    p = spark.range(1).select(prompt(F.lit("Q?"), F.lit("CTX")).alias("p")).first().p
    assert p.endswith("Question:\nQ?\n\nGraph Context:\nCTX")


def test_nested_children_splits_a_hot_parent(spark):
    from strata.functions.nesting import chunked_collect

    # parent 1 holds most children (a hot key); parent 2 a few; parent 3 none
    kids = [(1, f"n{i:03d}", i) for i in range(60)] + [(2, "b", 1), (2, "a", 2)]
    c = spark.createDataFrame(kids, "fk int, name string, id int")
    p = spark.createDataFrame([(1,), (2,), (3,)], "pk int")
    rows = nested_children(p, c, "pk", "fk", ["name", "id"], chunks=4).collect()
    by_parent = {}
    for r in rows:
        by_parent.setdefault(r.pk, []).append(r)
    # the same layout for every parent: each child in the chunk of its hash
    assert sorted(x.name for r in by_parent[2] for x in r.children) == ["a", "b"]
    whole = nested_children(p, c, "pk", "fk", ["name", "id"]).collect()
    assert sorted((r.pk, len(r.children)) for r in whole) == [(1, 60), (2, 2), (3, 0)]
    assert [(r.children_chunk, r.children) for r in by_parent[3]] == [(0, [])]
    # the hot parent: 4 chunk numbers, every child exactly once
    hot = by_parent[1]
    assert {r.children_chunk for r in hot} <= {0, 1, 2, 3} and len(hot) > 1
    names = sorted(x.name for r in hot for x in r.children)
    assert names == [f"n{i:03d}" for i in range(60)]
    assert all(list(r.children) == sorted(r.children) for r in hot)
    # same chunks on recomputation (pure function of the child's values)
    again = chunked_collect(c, "fk", ["name", "id"], "children", 4).collect()
    assert sorted((r.fk, r.children_chunk, tuple(r.children)) for r in again) == sorted(
        (r.pk, r.children_chunk, tuple(r.children)) for r in rows if r.children)


def test_nested_children_plan_splits_a_hot_customer(spark, tmp_path, monkeypatch):
    from strata.plans import QUERIES, history_plans

    spark.range(1, 4).withColumnRenamed("id", "c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(3000).select(F.col("id").alias("o_orderkey"), F.when(F.col("id") < 2990, 1).otherwise(2).cast("long").alias("o_custkey"),
                             F.expr("DATE'1995-01-01' + CAST(id % 900 AS INT)").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    seen = []
    monkeypatch.setattr(history_plans, "nested_children", lambda *a, **k: seen.append(nested_children(*a, **k)) or seen[-1])
    got = {r.c_custkey: (r.n_children, str(r.first_child)) for r in QUERIES["nested_children"](spark, str(tmp_path)).collect()}
    assert {k: n for k, (n, _) in got.items()} == {1: 2990, 2: 10, 3: 0} and got[1][1][:10] == "1995-01-01" and got[3][1] == "None"
    sizes = [r[0] for r in seen[0].filter("c_custkey = 1").select(F.size("orders")).collect()]
    assert sum(sizes) == 2990 and len(sizes) > 32 and max(sizes) < 150


def test_bucketed_time_bounded_join_equals_plain(spark):
    import datetime as dt
    import random

    rnd = random.Random(7)
    # key 0 is hot on both sides: many events and many validity periods
    ev = [(0 if rnd.random() < 0.5 else rnd.randint(1, 5), rnd.randint(0, 1000), i)
          for i in range(400)]
    periods = []
    for k in range(6):
        start = 0
        for _ in range(30 if k == 0 else 3):
            length = rnd.randint(1, 80)
            periods.append((k, start, start + length, len(periods)))
            start += length + rnd.randint(-10, 20)  # overlaps and gaps
    periods.append((1, 50, 40, len(periods)))  # inverted period: never matches
    left = spark.createDataFrame(ev, "k int, t int, eid int")
    right = spark.createDataFrame(periods, "lk int, a int, b int, pid int")

    def pairs(df):
        return sorted((r.eid, r.pid) for r in df.select("eid", "pid").collect())

    plain = pairs(time_bounded_join(left, right, "k", "lk", "t", "a", "b"))
    brute = sorted((e, p) for (k, t, e) in ev for (lk, a, b, p) in periods
                   if k == lk and a <= t < b)
    assert plain == brute
    for width in (1, 7, 25, 500):
        assert pairs(time_bounded_join(left, right, "k", "lk", "t", "a", "b",
                                       bucket=width)) == brute

    # dates (bucket in days) and timestamps (bucket in seconds)
    day0 = dt.date(2024, 1, 1)
    dl = left.select("k", "eid", F.date_add(F.lit(day0), F.col("t")).alias("t"))
    dr = right.select("lk", "pid", F.date_add(F.lit(day0), F.col("a")).alias("a"),
                      F.date_add(F.lit(day0), F.col("b")).alias("b"))
    assert pairs(time_bounded_join(dl, dr, "k", "lk", "t", "a", "b", bucket=10)) == brute
    tl = dl.withColumn("t", F.col("t").cast("timestamp"))
    tr = dr.withColumn("a", F.col("a").cast("timestamp")).withColumn(
        "b", F.col("b").cast("timestamp"))
    assert pairs(time_bounded_join(tl, tr, "k", "lk", "t", "a", "b",
                                   bucket=3 * 86400)) == brute


def test_nested_children_chunks_fold_to_whole_result(spark):
    """With 3 chunks a customer, folding the chunks per customer gives
    the same counts and first order as one array per customer."""
    sf = "/root/testdata/sf0.001"
    cust = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey")
    orders = spark.read.parquet(f"{sf}/orders.parquet")

    def folded(chunks):
        n = nested_children(cust, orders, "c_custkey", "o_custkey",
                            ["o_orderdate", "o_orderkey"], "orders", chunks=chunks)
        first = F.try_element_at("orders", F.lit(1))
        return {r.c_custkey: (r.n, r.first, r.chunks) for r in n.groupBy("c_custkey").agg(
            F.sum(F.size("orders")).alias("n"), F.min(first["o_orderdate"]).alias("first"),
            F.count(F.lit(1)).alias("chunks")).collect()}
    whole, chunked = folded(1), folded(3)
    assert {k: v[:2] for k, v in whole.items()} == {k: v[:2] for k, v in chunked.items()}
    assert max(v[2] for v in chunked.values()) > 1 and max(v[2] for v in whole.values()) == 1


def test_chunked_collect_keeps_a_null_key_group(spark):
    from strata.functions.nesting import chunked_collect
    df = spark.createDataFrame([(None, "x"), (None, "y"), ("a", "z")], "k string, v string")
    got = {r.k: [x.v for x in r.items] for r in chunked_collect(df, "k", ["v"], "items").collect()}
    assert got == {None: ["x", "y"], "a": ["z"]}


def test_bucketed_time_bounded_join_across_a_dst_gap(spark):
    """Local (NTZ) times around a daylight-saving gap: a period starting at
    02:30 (a time that does not exist that night) still contains 03:00."""
    ev = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ'2024-03-10 03:00:00' AS t, 7 AS eid")
    per = spark.sql("SELECT 1 AS lk, TIMESTAMP_NTZ'2024-03-10 02:30:00' AS a, "
                    "TIMESTAMP_NTZ'2024-03-10 04:00:00' AS b, 9 AS pid")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for width in (None, 1800, 600):
            got = time_bounded_join(ev, per, "k", "lk", "t", "a", "b", bucket=width)
            assert [(r.eid, r.pid) for r in got.collect()] == [(7, 9)], width
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
