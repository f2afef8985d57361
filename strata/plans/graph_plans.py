"""Plans for the graph and retrieval operators.

Driver mapping: route = orders, waypoint = lineitem (leg = l_linenumber,
stop = l_partkey), transit = supplier; driver -> vehicle -> hub = supplier ->
nation -> region.  Vectors = embeddings.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.ontology import Relationship
from strata.operators.graph import (EdgeTable, NodeTable, edge_union, expand, follow,
                                    ghost_nodes, graph_counts, match_path, node_union,
                                    route_context, route_summary, route_texts, traverse)
from strata.operators.retrieve import (match_band, prompt, query_vector, vector_topk)
from strata.plans.registry import plan
from strata.sources.tables import Tables


@plan("route_context", """
SELECT o_orderkey, l_linenumber, l_partkey, s_name
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
""")
def route_context_plan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return route_context(t.orders, t.lineitem, t.supplier, "o_orderkey", "l_orderkey",
                         "l_suppkey", "s_suppkey", "l_linenumber",
                         ["o_orderkey", "l_linenumber", "l_partkey", "s_name"])


@plan("route_summary", """
SELECT l_orderkey,
       string_agg(CAST(l_partkey AS VARCHAR), ' -> '
                  ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS stops,
       arg_max(l_returnflag, (CAST(l_linenumber AS BIGINT), l_partkey, l_suppkey, l_returnflag))
         AS last_l_returnflag
FROM lineitem GROUP BY l_orderkey
""")
def route_summary_plan(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    # the flag itself closes the order: (order, line) is not unique in this data
    return route_summary(li, "l_orderkey", "l_linenumber", "l_partkey", mode="l_returnflag",
                         tie=["l_partkey", "l_suppkey", "l_returnflag"])


@plan("route_summary_parts", """
WITH b AS (
  SELECT l_orderkey, CAST(floor(l_linenumber / 4096) AS BIGINT) AS part,
         string_agg(CAST(l_partkey AS VARCHAR), ' -> '
                    ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS stops
  FROM lineitem GROUP BY l_orderkey, part),
l AS (
  SELECT l_orderkey,
         arg_max(l_returnflag, (CAST(l_linenumber AS BIGINT), l_partkey, l_suppkey, l_returnflag))
           AS last_l_returnflag
  FROM lineitem GROUP BY l_orderkey)
SELECT b.l_orderkey, b.part, b.stops, l.last_l_returnflag
FROM b JOIN l ON b.l_orderkey = l.l_orderkey
""")
def route_summary_parts(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    # bounded form of A11: one row per block of 4096 legs, never a whole route
    return route_summary(li, "l_orderkey", "l_linenumber", "l_partkey", mode="l_returnflag",
                         tie=["l_partkey", "l_suppkey", "l_returnflag"], parts=True)


@plan("route_prompts", """
WITH s AS (
  SELECT l_orderkey,
         string_agg(CAST(l_partkey AS VARCHAR), ' -> ' ORDER BY l_linenumber, l_partkey, l_suppkey)
           AS stops FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey,
       'You are a route analyst.' || chr(10) || chr(10) ||
       'Using only the supplied graph context,' || chr(10) || 'explain the route.' ||
       chr(10) || chr(10) || 'Question:' || chr(10) || 'Which stops does route ' ||
       CAST(l_orderkey AS VARCHAR) || ' visit?' || chr(10) || chr(10) ||
       'Graph Context:' || chr(10) || 'Route: ' || CAST(l_orderkey AS VARCHAR) || chr(10) ||
       'Stops: ' || stops AS prompt
FROM s
""")
def route_prompts(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    s = route_summary(li, "l_orderkey", "l_linenumber", "l_partkey",
                      tie=["l_partkey", "l_suppkey"])
    question = F.format_string("Which stops does route %s visit?", F.col("l_orderkey"))
    context = F.concat_ws("\n", F.concat(F.lit("Route: "), F.col("l_orderkey").cast("string")),
                          F.concat(F.lit("Stops: "), F.col("stops")))
    return s.select("l_orderkey", prompt(question, context).alias("prompt"))


@plan("route_context_prompts", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, l_linestatus,
                  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_partkey END AS stop FROM lineitem),
s AS (
  SELECT l_orderkey, string_agg(coalesce(CAST(stop AS VARCHAR), 'None'), ' -> ' ORDER BY l_linenumber, l_suppkey, coalesce(stop, -1), l_returnflag, l_linestatus) AS stops,
         arg_max(l_returnflag, (CAST(l_linenumber AS BIGINT), l_suppkey, coalesce(stop, -1), l_returnflag, l_linestatus)) FILTER (WHERE l_returnflag <> '') AS mode,
         arg_max(l_linestatus, (CAST(l_linenumber AS BIGINT), l_suppkey, coalesce(stop, -1), l_returnflag, l_linestatus)) FILTER (WHERE l_linestatus <> 'F') AS carrier
  FROM x GROUP BY l_orderkey)
SELECT l_orderkey,
       'You are a route analyst.' || chr(10) || chr(10) || 'Using only the supplied graph context,' || chr(10) || 'explain the route.' ||
       chr(10) || chr(10) || 'Question:' || chr(10) || 'Which stops does route ' || CAST(l_orderkey AS VARCHAR) || ' visit?' || chr(10) || chr(10) ||
       'Graph Context:' || chr(10) || 'Route:' || chr(10) || CAST(l_orderkey AS VARCHAR) || chr(10) || chr(10) || 'Carrier:' || chr(10) || coalesce(carrier, '') ||
       chr(10) || chr(10) || 'Mode:' || chr(10) || coalesce(mode, '') || chr(10) || chr(10) || 'Stops:' || chr(10) || stops AS prompt
FROM s
""")
def route_context_prompts(spark, sf_dir):
    """Every route's prompt, its context with carrier, mode and stops; some stops are NULL, some carriers empty."""
    li = Tables(spark, sf_dir).lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", F.col("l_linestatus").alias("_close"),
        F.when(F.col("l_linestatus") != "F", F.col("l_linestatus")).otherwise("").alias("carrier"),
        F.when(F.col("l_partkey") % 11 != 0, F.col("l_partkey")).alias("stop")).withColumn("_s", F.coalesce("stop", F.lit(-1)))
    s = route_summary(li, "l_orderkey", "l_linenumber", "stop", mode="l_returnflag", carrier="carrier", tie=["l_suppkey", "_s", "l_returnflag", "_close"])
    question = F.format_string("Which stops does route %s visit?", F.col("l_orderkey"))
    return s.select("l_orderkey", prompt(question, route_texts(s, "l_orderkey", "last_l_returnflag", "last_carrier")).alias("prompt"))


@plan("match_path", """
SELECT s_suppkey, n_nationkey, r_regionkey
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def match_path_plan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    m = match_path(t.supplier, ("s_nationkey", "n_nationkey"), t.nation,
                   ("n_regionkey", "r_regionkey"), t.region)
    return m.select("s_suppkey", "n_nationkey", "r_regionkey")


@plan("link_traversal", """
SELECT l_orderkey, l_linenumber, o_custkey, c_nationkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = 'O'
""")
def link_traversal(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # package -> flight -> customer, pre-joined; looked up for every open order
    links = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
             .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
             .select("l_orderkey", "l_linenumber", "o_custkey", "c_nationkey"))
    open_orders = t.orders.filter(F.col("o_orderstatus") == "O").select("o_orderkey")
    return traverse(links, "l_orderkey", keys=open_orders)


# Declared links of the driver schema.
PLACED_BY = Relationship("placed_by", "PLACED_BY", "Customer", "many_to_one",
                         "o_custkey", "c_custkey")
IN_NATION = Relationship("in_nation", "IN_NATION", "Nation", "many_to_one",
                         "c_nationkey", "n_nationkey")


@plan("follow_links", """
SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name
""")
def follow_links(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = follow(follow(t.orders, t.customer, PLACED_BY), t.nation, IN_NATION)
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_orders"),
                                   F.round(F.sum("o_totalprice"), 2).alias("total_price"))


@plan("expand_one_hop", """
SELECT c.c_custkey AS source, o.o_orderkey AS target_key, o.o_orderstatus AS target_status
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
""")
def expand_one_hop(spark, sf_dir):
    t = Tables(spark, sf_dir)
    edges = t.orders.select(F.col("o_custkey").alias("source"),
                            F.col("o_orderkey").alias("target"))
    nodes = t.orders.select(F.col("o_orderkey").alias("key"),
                            F.col("o_orderstatus").alias("status"))
    starts = t.customer.select("c_custkey")  # every customer is a start node
    out = expand(nodes, edges, "key", starts=starts)
    return out.select("source", "target_key", "target_status")


def _graph(t):
    nodes = node_union([NodeTable("customer", t.customer, "c_custkey"),
                        NodeTable("orders", t.orders, "o_orderkey"),
                        NodeTable("supplier", t.supplier, "s_suppkey"),
                        NodeTable("nation", t.nation, "n_nationkey"),
                        NodeTable("region", t.region, "r_regionkey")], with_props=False)
    edges = edge_union([
        EdgeTable("PLACED_BY", t.orders, "orders", "o_orderkey", "customer", "o_custkey"),
        EdgeTable("IN_NATION", t.customer, "customer", "c_custkey", "nation", "c_nationkey"),
        EdgeTable("SUPPLIER_IN", t.supplier, "supplier", "s_suppkey", "nation", "s_nationkey"),
        EdgeTable("IN_REGION", t.nation, "nation", "n_nationkey", "region", "n_regionkey"),
        # the part node table is not part of this graph: its endpoints are ghosts
        EdgeTable("CONTAINS", t.lineitem, "orders", "l_orderkey", "part", "l_partkey"),
        EdgeTable("SUPPLIED_BY", t.lineitem, "orders", "l_orderkey", "supplier", "l_suppkey"),
    ])
    return nodes, edges


@plan("ghost_nodes", """
SELECT DISTINCT 'part' AS node_type, CAST(l_partkey AS VARCHAR) AS node_key FROM lineitem
""")
def ghost_nodes_plan(spark, sf_dir):
    nodes, edges = _graph(Tables(spark, sf_dir))
    return ghost_nodes(nodes, edges)


@plan("graph_kpis", """
SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders)
       + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation)
       + (SELECT count(*) FROM region) AS n_nodes,
       (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer)
       + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation)
       + 2 * (SELECT count(*) FROM lineitem) AS n_edges
""")
def graph_kpis(spark, sf_dir):
    nodes, edges = _graph(Tables(spark, sf_dir))
    return graph_counts(nodes, edges)


@plan("vector_topk", """
SELECT e.vec_id,
       round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[])::DOUBLE, 3)
         AS score,
       CASE WHEN list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) > 0.5
            THEN 'Match' ELSE 'Partial' END AS band
FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q
ORDER BY list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, e.vec_id
LIMIT 10
""")
def vector_topk_plan(spark, sf_dir):
    emb = Tables(spark, sf_dir).embeddings
    top = vector_topk(emb, "vec_id", "embedding", query_vector(emb, "vec_id", "embedding", 0), 10)
    return top.select("vec_id", F.round("score", 3).alias("score"),
                      match_band(F.col("score")).alias("band"))


@plan("object_lookup", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def object_lookup(spark, sf_dir):
    from strata.operators.project import get_objects
    t = Tables(spark, sf_dir)
    keys = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    return get_objects(t.customer, "c_custkey", keys).select("c_custkey", "c_name")


@plan("document_index", """
SELECT CAST(doc_id AS VARCHAR) AS id, sha256(text) AS text_hash FROM documents
WHERE text IS NOT NULL AND length(text) > 0 AND length(CAST(doc_id AS VARCHAR)) <= 50
""")
def document_index(spark, sf_dir):
    from strata.operators.retrieve import index_documents
    d = Tables(spark, sf_dir).documents.select(F.col("doc_id").cast("string").alias("id"), "text")
    return index_documents(None, d).select("id", F.sha2("text", 256).alias("text_hash"))


@plan("evidence", """
WITH q AS (SELECT embedding FROM embeddings WHERE vec_id = 0),
top AS (
  SELECT e.vec_id, e.label,
         round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[])::DOUBLE, 3)
           AS score
  FROM embeddings e, q
  ORDER BY list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, e.vec_id
  LIMIT 5)
SELECT vec_id, 'item: ' || CAST(vec_id AS VARCHAR) || chr(10) || 'label: ' || CAST(label AS VARCHAR)
       || chr(10) || 'band: ' || CASE WHEN score > 0.5 THEN 'Match' ELSE 'Partial' END AS evidence
FROM top
""")
def evidence(spark, sf_dir):
    from strata.operators.retrieve import evidence_text
    emb = Tables(spark, sf_dir).embeddings
    top = vector_topk(emb, "vec_id", "embedding", query_vector(emb, "vec_id", "embedding", 0), 5,
                      keep=["label"])
    band = match_band(F.round("score", 3))
    return top.select("vec_id", evidence_text([("item", F.col("vec_id")), ("label", F.col("label")),
                                               ("band", band)]).alias("evidence"))


@plan("document_evidence", """
WITH q AS (SELECT embedding FROM embeddings WHERE vec_id = 0),
top AS (SELECT e.vec_id, e.label FROM embeddings e, q
        ORDER BY list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, e.vec_id LIMIT 5),
k AS (SELECT t.vec_id, 'Document: ' || CAST(label AS VARCHAR) AS document, c_custkey, 'Entity: ' || c_name AS entity FROM top t LEFT JOIN customer ON c_custkey = vec_id),
l AS (SELECT o_custkey, o_orderkey % 4 AS part, string_agg('Link: ' || o_orderkey || ' ' || o_orderstatus || ' ' || o_orderpriority, chr(10)
             ORDER BY 'Link: ' || o_orderkey || ' ' || o_orderstatus || ' ' || o_orderpriority) AS lines FROM orders GROUP BY 1, 2)
SELECT vec_id, coalesce(part, 0) AS part, concat_ws(chr(10), document, entity, lines) AS evidence FROM k LEFT JOIN l ON o_custkey = c_custkey
""")
def document_evidence_plan(spark, sf_dir):
    """The items nearest to one, each with its entity and all that the entity links to."""
    from strata.operators.retrieve import document_evidence
    t = Tables(spark, sf_dir)
    top = vector_topk(t.embeddings, "vec_id", "embedding", query_vector(t.embeddings, "vec_id", "embedding", 0), 5, keep=["label"])
    line = F.concat_ws(" ", F.lit("Link:"), F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority")
    return document_evidence(top, t.customer, t.orders, "vec_id", "vec_id", "c_custkey", "o_custkey",
                             F.concat(F.lit("Document: "), F.col("label").cast("string")), F.concat(F.lit("Entity: "), F.col("c_name")), line,
                             F.pmod("o_orderkey", F.lit(4)))
