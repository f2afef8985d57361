"""Plans for reconciliation, digests and table assertions."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.merkle import differing_ranges, leaves, ordered_digest
from strata.operators.reconcile import (
    column_aggregates, compare_checksums, dataset_digest, duplicate_keys, file_checksums,
    null_counts, reconcile, table_counts)
from strata.plans.registry import plan
from strata.sources.tables import DRIVER_TABLES, Tables


def _agg_sql(table: str, numeric: list[str], others: list[str], where: str = "") -> str:
    """Oracle text for one side of the column check, long format."""
    parts = [f"SELECT '*' AS column_name, 'count' AS agg, count(*)::DOUBLE AS value "
             f"FROM {table} {where}"]
    for c in numeric + others:
        parts.append(f"SELECT '{c}', 'count', count({c})::DOUBLE FROM {table} {where}")
    for c in numeric:
        for a in ("sum", "min", "max"):
            parts.append(f"SELECT '{c}', '{a}', {a}({c})::DOUBLE FROM {table} {where}")
    return "\nUNION ALL ".join(parts)


ORDERS_NUMERIC = ["o_orderkey", "o_custkey", "o_totalprice"]
ORDERS_OTHER = ["o_orderstatus", "o_orderdate", "o_orderpriority"]


@plan("column_check", f"""
SELECT column_name, agg, round(value, 2) AS value FROM (
{_agg_sql("orders", ORDERS_NUMERIC, ORDERS_OTHER)})
""")
def column_check(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return column_aggregates(o).select("column_name", "agg", F.round("value", 2).alias("value"))


@plan("column_check_exact", """
WITH t AS (SELECT event_id + 9007199254740993 AS big, CAST(value AS DECIMAL(18, 2)) AS cost, event_id FROM events)
SELECT 'big' AS column_name, 'sum' AS agg, CAST(sum(big) AS VARCHAR) AS exact FROM t UNION ALL SELECT 'big', 'min', CAST(min(big) AS VARCHAR) FROM t
UNION ALL SELECT 'big', 'max', CAST(max(big) AS VARCHAR) FROM t UNION ALL SELECT 'big', 'count', CAST(count(big) AS VARCHAR) FROM t
UNION ALL SELECT 'cost', 'sum', CAST(sum(cost) AS VARCHAR) FROM t UNION ALL SELECT 'cost', 'min', CAST(min(cost) AS VARCHAR) FROM t
UNION ALL SELECT 'cost', 'max', CAST(max(cost) AS VARCHAR) FROM t UNION ALL SELECT 'cost', 'count', CAST(count(cost) AS VARCHAR) FROM t
UNION ALL SELECT '*', 'count', CAST(count(*) AS VARCHAR) FROM t
""")
def column_check_exact(spark, sf_dir):
    """A3 in the columns' own types: whole numbers beyond 2^53 and decimals."""
    t = Tables(spark, sf_dir).events.select((F.col("event_id") + F.lit(9007199254740993)).alias("big"), F.col("value").cast("decimal(18,2)").alias("cost"))
    return column_aggregates(t).select("column_name", "agg", "exact")


def _side_sql(name, table, numeric, other, where=""):
    return f"SELECT '{name}' AS t, column_name, agg, value FROM ({_agg_sql(table, numeric, other, where)})"


CUSTOMER_NUMERIC = ["c_custkey", "c_nationkey", "c_acctbal"]
CUSTOMER_OTHER = ["c_name", "c_mktsegment"]
LINE_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax"]
LINE_OTHER = ["l_returnflag", "l_linestatus", "l_shipdate"]

_RECONCILE_ORACLE = f"""
WITH s AS (
  {_side_sql("customer", "customer", CUSTOMER_NUMERIC, CUSTOMER_OTHER)}
  UNION ALL {_side_sql("orders", "orders", ORDERS_NUMERIC, ORDERS_OTHER)}
  UNION ALL {_side_sql("lineitem", "lineitem", LINE_NUMERIC, LINE_OTHER)}),
tg AS (
  {_side_sql("customer", "(SELECT DISTINCT * FROM customer)", CUSTOMER_NUMERIC, CUSTOMER_OTHER)}
  UNION ALL {_side_sql("orders", "(SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))", ORDERS_NUMERIC, ORDERS_OTHER)}
  UNION ALL {_side_sql("lineitem", "(SELECT * FROM lineitem WHERE l_returnflag <> 'R')", LINE_NUMERIC, LINE_OTHER)}),
j AS (
  SELECT s.t, s.column_name, s.agg, s.value AS sv, tg.value AS tv,
         (s.value IS NOT DISTINCT FROM tg.value)
         OR s.agg = 'sum'
            AND abs(s.value - tg.value) <= greatest(abs(s.value), abs(tg.value)) * 1e-9 AS ok
  FROM s JOIN tg ON s.t = tg.t AND s.column_name = tg.column_name AND s.agg = tg.agg)
SELECT t AS table_name,
       max(sv) FILTER (WHERE column_name = '*' AND agg = 'count')::BIGINT AS source_rows,
       max(tv) FILTER (WHERE column_name = '*' AND agg = 'count')::BIGINT AS target_rows,
       max(sv) FILTER (WHERE column_name = '*' AND agg = 'count')
         = max(tv) FILTER (WHERE column_name = '*' AND agg = 'count') AS row_count_ok,
       bool_and(coalesce(ok, false)) AS columns_ok,
       CASE WHEN max(sv) FILTER (WHERE column_name = '*' AND agg = 'count')
                 = max(tv) FILTER (WHERE column_name = '*' AND agg = 'count')
             AND bool_and(coalesce(ok, false)) THEN 'SUCCESS' ELSE 'FAIL' END AS status
FROM j GROUP BY t
"""


@plan("reconcile", _RECONCILE_ORACLE)
def reconcile_plan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pairs = {
        # a de-duplicated copy must equal its source
        "customer": (t.customer, t.customer.dropDuplicates()),
        # orders kept by their customer link: every order has a customer
        "orders": (t.orders, t.orders.join(t.customer.select("c_custkey"),
                                           F.col("o_custkey") == F.col("c_custkey"),
                                           "left_semi")),
        # a lossy copy (returned lines dropped) must be flagged
        "lineitem": (t.lineitem, t.lineitem.filter(F.col("l_returnflag") != "R")),
    }
    return reconcile(pairs)


DIGEST_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@plan("dataset_hash", f"""
WITH h AS (SELECT md5(concat_ws('||', {", ".join(f"CAST({c} AS VARCHAR)" for c in DIGEST_COLS)})) AS h
           FROM orders)
SELECT count(*) AS n_rows,
       md5(concat_ws(':', CAST(count(*) AS VARCHAR),
         CAST(sum(('0x' || substr(h, 1, 8))::BIGINT) AS VARCHAR),
         CAST(sum(('0x' || substr(h, 9, 8))::BIGINT) AS VARCHAR),
         CAST(sum(('0x' || substr(h, 17, 8))::BIGINT) AS VARCHAR),
         CAST(sum(('0x' || substr(h, 25, 8))::BIGINT) AS VARCHAR))) AS dataset_hash
FROM h
""")
def dataset_hash(spark, sf_dir):
    return dataset_digest(Tables(spark, sf_dir).orders, DIGEST_COLS)


_TREE_FANOUT = 32


def _leaves_sql(name: str, table: str) -> str:
    return f"""
{name}_rows AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey, h) - 1 AS rn, h FROM (
    SELECT o_orderkey, md5(concat_ws('||', {", ".join(f"CAST({c} AS VARCHAR)" for c in DIGEST_COLS)})) AS h FROM {table})),
{name} AS (
  SELECT rn // {_TREE_FANOUT} AS node, count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
         md5(string_agg(h, '' ORDER BY rn)) AS digest
  FROM {name}_rows GROUP BY 1)"""


@plan("ordered_digest", f"""
WITH RECURSIVE {_leaves_sql("leaf", "orders")},
tree AS (
  SELECT 0 AS level, node, n_rows, digest FROM leaf
  UNION ALL
  SELECT level + 1, node // {_TREE_FANOUT}, sum(n_rows)::BIGINT, md5(string_agg(digest, '' ORDER BY node))
  FROM tree WHERE (SELECT count(*) FROM tree) > 1 GROUP BY level + 1, node // {_TREE_FANOUT})
SELECT n_rows, digest AS dataset_hash FROM tree WHERE level = (SELECT max(level) FROM tree)
""")
def ordered_digest_plan(spark, sf_dir):
    """A5: the digest of all columns of orders, in key order."""
    return ordered_digest(Tables(spark, sf_dir).orders, "o_orderkey", fanout=_TREE_FANOUT)


@plan("differing_ranges", f"""
WITH changed AS (SELECT * REPLACE (CASE WHEN o_orderkey % 997 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders),
{_leaves_sql("s", "orders")}, {_leaves_sql("t", "changed")}
SELECT s.node, s.first_key, s.last_key, s.n_rows AS source_rows, t.n_rows AS target_rows, s.digest AS source_digest, t.digest AS target_digest
FROM s JOIN t ON s.node = t.node WHERE s.digest <> t.digest
""")
def differing_ranges_plan(spark, sf_dir):
    """A5: the key ranges in which orders differ from a copy with some prices changed."""
    orders = Tables(spark, sf_dir).orders
    price = F.when(F.col("o_orderkey") % 997 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    source, target = (leaves(x, "o_orderkey", fanout=_TREE_FANOUT) for x in (orders, orders.withColumn("o_totalprice", price)))
    return differing_ranges(source, target).withColumns({k: F.col(f"{k}.o_orderkey") for k in ("first_key", "last_key")})


@plan("table_counts", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in DRIVER_TABLES))
def table_counts_plan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return table_counts({n: t.get(n) for n in DRIVER_TABLES})


@plan("key_duplicates", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def key_duplicates(spark, sf_dir):
    return duplicate_keys(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


@plan("null_counts", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM documents"
    for c in ["doc_id", "text", "lang", "source", "n_chars"]))
def null_counts_plan(spark, sf_dir):
    return null_counts(Tables(spark, sf_dir).documents)


@plan("null_counts_branches", """
SELECT 'event_id' AS column_name, count(*) FILTER (WHERE event_id % 10 = 0) AS n_null FROM events
UNION ALL SELECT 'value', count(*) FILTER (WHERE value > 10) FROM events UNION ALL SELECT 'props', count(*) FROM events
UNION ALL SELECT 'user_id', 0 FROM events HAVING count(*) > 0
""")
def null_counts_branches(spark, sf_dir):
    """Columns with some, all and no NULLs."""
    return null_counts(Tables(spark, sf_dir).events.select(
        F.when(F.col("event_id") % 10 != 0, F.col("event_id")).alias("event_id"), F.when(~(F.col("value") > 10), F.col("value")).alias("value"),
        F.lit(None).cast("string").alias("props"), "user_id"))


@plan("file_checksums")
def file_checksums_plan(spark, sf_dir):
    files = file_checksums(spark, f"{sf_dir.rstrip('/')}/*.parquet")
    return compare_checksums(files, file_checksums(spark, f"{sf_dir.rstrip('/')}/*.parquet"))


@plan("row_count_check", """
SELECT (SELECT count(*) FROM orders) AS source_rows,
       (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
         AS target_rows,
       (SELECT count(*) FROM orders)
         = (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
         AS row_count_ok
""")
def row_count_check(spark, sf_dir):
    from strata.operators.reconcile import check_row_count
    t = Tables(spark, sf_dir)
    # target: the orders that made it into the line-item table
    shipped = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    return check_row_count(t.orders, shipped)
