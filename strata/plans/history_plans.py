"""Plans for projections, history and governance operators
(P4 P9 P10 P11 K9 D1 D2 D4 D6 D7 D9 D10 D11 D12 D13)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.ontology import Attribute, ObjectType
from strata.operators.history import (current_state, hash_sample, nested_children,
                                      retention_tier, row_access, schema_checked,
                                      time_bounded_join, unused, usage_parity)
from strata.operators.project import (coerce_loose, conform, edge_view, mask, props_json,
                                      tag_columns, view_of)
from strata.operators.registry import raw_registry
from strata.plans.registry import plan
from strata.sources.tables import Tables

# Event type -> ledger operation for the events-as-ledger view.
OP_OF = {"signup": "INSERT", "error": "DELETE"}
_OP_SQL = "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END"


def _ledger(t):
    op = F.lit("UPDATE")
    for k, v in OP_OF.items():
        op = F.when(F.col("event_type") == k, F.lit(v)).otherwise(op)
    return t.events.withColumn("op", op)


@plan("ledger_state", f"""
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, {_OP_SQL} AS op,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1 AND op <> 'DELETE'
""")
def ledger_state(spark, sf_dir):
    return current_state(_ledger(Tables(spark, sf_dir)), "user_id", ["ts", "event_id"], "op",
                         ["event_id", "event_type", "value"])


@plan("point_in_time", f"""
SELECT user_id, event_id, event_type FROM (
  SELECT *, {_OP_SQL} AS op,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00') WHERE rn = 1 AND op <> 'DELETE'
""")
def point_in_time(spark, sf_dir):
    as_of = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return current_state(_ledger(Tables(spark, sf_dir)), "user_id", ["ts", "event_id"], "op",
                         ["event_id", "event_type"], as_of=as_of, ts="ts")


@plan("row_access", """
SELECT g.n_name AS principal, o.o_orderkey
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN nation g ON g.n_regionkey = cn.n_regionkey
""")
def row_access_plan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # every nation's analysts may read the orders of customers in their region
    grants = t.nation.select(F.col("n_name").alias("principal"),
                             F.col("n_regionkey").alias("region"))
    rows = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", F.col("n_regionkey").alias("order_region")))
    return row_access(rows, grants, "order_region", "region").select("principal", "o_orderkey")


@plan("time_bounded_link", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 90 DAY
""")
def time_bounded_link(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", F.col("o_orderdate").alias("valid_from"),
                        (F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")).alias("valid_to"))
    j = time_bounded_join(t.lineitem, o, "l_orderkey", "o_orderkey", "l_shipdate",
                          "valid_from", "valid_to")
    return j.select("l_orderkey", "l_linenumber", "l_partkey")


#: Chunks of a parent's children in the registered plan, whatever their number.
CHUNKS = 64


@plan("nested_children", """
SELECT c_custkey, count(o_orderkey) AS n_children, min(o_orderdate) AS first_child
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
""")
def nested_children_plan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # each customer's orders as an array, sorted by (date, key); customers
    # without orders keep an empty array; every customer's orders are dealt to the same
    # fixed number of chunks, so that a hot one is built by several tasks
    nested = nested_children(t.customer.select("c_custkey"), t.orders, "c_custkey",
                             "o_custkey", ["o_orderdate", "o_orderkey"], "orders", chunks=CHUNKS)
    # a parent may span several chunks: fold them (one small row per chunk)
    return nested.groupBy("c_custkey").agg(
        F.sum(F.size("orders")).cast("bigint").alias("n_children"),
        F.min(F.try_element_at("orders", F.lit(1))["o_orderdate"]).alias("first_child"))


@plan("schema_checked_ingest", """
SELECT CASE WHEN try_cast(json_extract(props, '$.k') AS INTEGER) IS NOT NULL
             AND json_type(props) = 'OBJECT' THEN 'good' ELSE 'rejected' END AS outcome,
       count(*) AS n_rows
FROM events GROUP BY 1
""")
def schema_checked_ingest(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    c = schema_checked(ev, "props", T.StructType([T.StructField("k", T.IntegerType())]))
    both = c.good.select(F.lit("good").alias("outcome")).unionByName(
        c.rejected.select(F.lit("rejected").alias("outcome")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"))


@plan("schema_checked_rejects", """
SELECT event_type, CASE WHEN event_id % 7 < 5 THEN 'rejected' ELSE 'good' END AS outcome, count(*) AS n_rows,
       sum(CASE WHEN event_id % 7 >= 5 THEN CAST(json_extract(props, '$.k') AS BIGINT) END)::BIGINT AS total
FROM events GROUP BY 1, 2
""")
def schema_checked_rejects(spark, sf_dir):
    """Payloads of another type, no JSON, without the field, with a fraction, out of range."""
    odd = ['{"k": "7"}', "no json", "{}", '{"k": 1.5}', '{"k": 99999999999}']
    text = F.col("props")
    for i, value in enumerate(odd):
        text = F.when(F.col("event_id") % 7 == i, value).otherwise(text)
    c = schema_checked(Tables(spark, sf_dir).events.select("event_type", text.alias("props")), "props", T.StructType([T.StructField("k", T.IntegerType())]))
    good = c.good.groupBy("event_type").agg(F.count("*").alias("n_rows"), F.sum("parsed.k").alias("total")).withColumn("outcome", F.lit("good"))
    bad = c.rejected.groupBy("event_type").agg(F.count("*").alias("n_rows")).withColumn("outcome", F.lit("rejected"))
    return good.unionByName(bad, allowMissingColumns=True)


@plan("unused_parts", """
SELECT p_partkey FROM part WHERE p_partkey NOT IN (
  SELECT l_partkey FROM lineitem
  WHERE l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 365 DAY)
""")
def unused_parts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    since = t.lineitem.agg(F.max("l_shipdate").alias("m")).scalar() - F.expr("INTERVAL 365 DAYS")
    return unused(t.part, t.lineitem, "p_partkey", "l_partkey", "l_shipdate", since).select(
        "p_partkey")


@plan("retention_tiers", """
WITH a AS (SELECT datediff('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS d
           FROM orders)
SELECT CASE WHEN d <= 30 THEN '0-30d' WHEN d <= 365 THEN '31-365d' WHEN d <= 1095 THEN '1-3y'
            WHEN d <= 2555 THEN '3-7y' ELSE '7y+' END AS tier, count(*) AS n_rows
FROM a GROUP BY 1
""")
def retention_tiers(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    ref = o.agg(F.max("o_orderdate").alias("m")).scalar()
    age = F.datediff(ref, F.col("o_orderdate"))
    return o.groupBy(retention_tier(age).alias("tier")).agg(F.count(F.lit(1)).alias("n_rows"))


@plan("usage_parity", """
SELECT event_type, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS historical,
       count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16') AS recent,
       round(count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16')
             / nullif(count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16'), 0), 4) AS ratio
FROM events GROUP BY event_type
""")
def usage_parity_plan(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return usage_parity(ev, "event_type", "ts", F.lit("2024-01-16").cast("timestamp_ntz"))


@plan("sampled_check", """
SELECT count(*) AS n_rows, round(sum(o_totalprice), 2) AS total_price FROM orders
WHERE ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 10
""")
def sampled_check(spark, sf_dir):
    s = hash_sample(Tables(spark, sf_dir).orders, "o_orderkey", 10)
    return s.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.round(F.sum("o_totalprice"), 2).alias("total_price"))


@plan("loose_types", """
WITH t AS (
  SELECT 'l_orderkey' AS column_name, CAST(l_orderkey AS VARCHAR) AS v FROM lineitem
  UNION ALL SELECT 'l_quantity', CAST(l_quantity AS VARCHAR) FROM lineitem
  UNION ALL SELECT 'l_returnflag', l_returnflag FROM lineitem
  UNION ALL SELECT 'k', CAST(json_extract(props, '$.k') AS VARCHAR) FROM events)
SELECT column_name,
       CASE WHEN v IS NULL OR v = '' THEN NULL WHEN regexp_full_match(v, '[0-9]+') THEN 'int'
            WHEN contains(v, '.') AND try_cast(v AS DOUBLE) IS NOT NULL THEN 'float'
            ELSE 'str' END AS kind,
       count(*) AS n_values
FROM t GROUP BY ALL
""")
def loose_types(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem
    pair = lambda name, value: F.struct(F.lit(name).alias("column_name"), value.alias("v"))
    vals = li.select(F.inline(F.array(  # one scan
        pair("l_orderkey", F.col("l_orderkey").cast("string")), pair("l_quantity", F.col("l_quantity").cast("string")),
        pair("l_returnflag", F.col("l_returnflag")))))
    vals = vals.unionByName(t.events.select(F.lit("k").alias("column_name"), F.get_json_object("props", "$.k").alias("v")))
    return vals.groupBy("column_name", coerce_loose(F.col("v"))["kind"].alias("kind")).agg(
        F.count(F.lit(1)).alias("n_values"))


# Contract for the customer table with a segment length limit.
CUSTOMER_CONTRACT = ObjectType("Customer", "customer", "c_custkey", (
    Attribute("c_custkey", "INT64", True), Attribute("c_name", "STRING(25)", True),
    Attribute("c_nationkey", "INT64", True), Attribute("c_acctbal", "NUMERIC"),
    Attribute("c_mktsegment", "STRING(9)")))


@plan("conform_violations", """
SELECT 'c_mktsegment: longer than 9' AS violation, count(*) AS n_rows FROM customer
WHERE length(c_mktsegment) > 9
""")
def conform_violations(spark, sf_dir):
    c = conform(Tables(spark, sf_dir).customer, CUSTOMER_CONTRACT)
    return (c.bad.select(F.explode("violations").alias("violation"))
            .groupBy("violation").agg(F.count(F.lit(1)).alias("n_rows")))


# Contract for documents with a length limit that the long ones break.
DOCUMENT_CONTRACT = ObjectType("Document", "documents", "doc_id", (
    Attribute("doc_id", "INT64", True), Attribute("text", "STRING(2000)", True),
    Attribute("source", "STRING(MAX)"), Attribute("lang", "STRING(2)")))


@plan("document_contract", """
SELECT outcome, count(*) AS n_rows FROM (
  SELECT unnest(CASE WHEN len(v) = 0 THEN ['good'] ELSE v END) AS outcome FROM (
    SELECT list_filter([
             CASE WHEN doc_id IS NULL THEN 'doc_id: required' END,
             CASE WHEN text IS NULL THEN 'text: required' END,
             CASE WHEN length(text) > 2000 THEN 'text: longer than 2000' END,
             CASE WHEN length(lang) > 2 THEN 'lang: longer than 2' END], lambda x: x IS NOT NULL) AS v
    FROM documents))
GROUP BY outcome
""")
def document_contract(spark, sf_dir):
    """Rows of documents that keep the contract, and those that break it by reason."""
    c = conform(Tables(spark, sf_dir).documents, DOCUMENT_CONTRACT)
    good = c.good.select(F.lit("good").alias("outcome"))
    bad = c.bad.select(F.explode("violations").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"))


# Contract view of the customer table (P5): one contract column the table
# does not have, so the view carries it as a typed NULL.
CUSTOMER_VIEW = ObjectType("Customer", "customer", "c_custkey", (
    Attribute("c_custkey", "INT64", True), Attribute("c_name", "STRING(25)", True),
    Attribute("c_mktsegment", "STRING(9)"), Attribute("c_status", "STRING(16)")))


@plan("contract_views", """
SELECT e.o_orderkey, e.o_custkey, e.o_orderstatus, v.c_name, v.c_mktsegment, v.c_status
FROM (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders) e
JOIN (SELECT c_custkey, c_name, c_mktsegment, CAST(NULL AS VARCHAR) AS c_status FROM customer) v
  ON e.o_custkey = v.c_custkey
""")
def contract_views(spark, sf_dir):
    t = Tables(spark, sf_dir)
    view_of(t.customer, CUSTOMER_VIEW, register=True)  # temp view v_customer
    # PLACED_BY edges: key, source, target, then properties (repeats dropped)
    edge_view(t.orders, "o_orderkey", "o_orderkey", "o_custkey",
              ["o_orderstatus", "o_custkey"]).createOrReplaceTempView("e_placed_by")
    return spark.sql("""
        SELECT e.o_orderkey, e.o_custkey, e.o_orderstatus, v.c_name, v.c_mktsegment, v.c_status
        FROM e_placed_by e JOIN v_customer v ON e.o_custkey = v.c_custkey""")


@plan("masked_customer", """
SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer
""")
def masked_customer(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_acctbal")
    tagged, _ = tag_columns(c, {"c_acctbal": "Confidential/Finance/Payroll"})
    return mask(tagged, allowed_tags=())


@plan("order_props", """
SELECT o_orderkey, to_json(struct_pack(o_orderstatus := o_orderstatus,
                                       o_orderdate := replace(CAST(o_orderdate AS VARCHAR), ' ', 'T'),
                                       o_orderpriority := o_orderpriority,
                                       o_custkey := o_custkey))::VARCHAR AS props
FROM orders
""")
def order_props(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", props_json(o, ["o_orderstatus", "o_orderdate",
                                                 "o_orderpriority", "o_custkey"]).alias("props"))


@plan("document_registry", """
SELECT sha256(text) AS text_hash, min(doc_id) AS first_doc_id, count(*) AS n_copies
FROM documents GROUP BY sha256(text)
""")
def document_registry(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return raw_registry(d, "text", "doc_id").select("text_hash", "first_doc_id", "n_copies")
