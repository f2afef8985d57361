"""Plans for the step-pipeline operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.steps import run_steps
from strata.plans.registry import plan
from strata.sources.tables import Tables

# The flagship: filter -> left join -> aggregate, the step language's own
# worked example re-aimed at orders/customer.
STEP_PIPELINE = {
    "source_dataset": "orders",
    "steps": [
        {"type": "FILTER",
         "config": {"column": "o_orderstatus", "operator": "EQUALS", "value": "F"}},
        {"type": "JOIN",
         "config": {"right_dataset": "customer", "type": "LEFT",
                    "left_key": "o_custkey", "right_key": "c_custkey"}},
        {"type": "AGGREGATE",
         "config": {"group_by": ["c_mktsegment", "o_orderpriority"],
                    "aggregations": [{"column": "o_orderkey", "function": "COUNT",
                                      "alias": "total_orders"}]}},
    ],
}


@plan("step_pipeline", """
SELECT c_mktsegment, o_orderpriority, count(o_orderkey) AS total_orders
FROM (SELECT * FROM orders WHERE o_orderstatus = 'F') l
LEFT JOIN customer r ON l.o_custkey = r.c_custkey
GROUP BY c_mktsegment, o_orderpriority
""")
def step_pipeline(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return run_steps(STEP_PIPELINE, t.get)


@plan("step_filter_contains", """
SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%a%'
""")
def step_filter_contains(spark, sf_dir):
    t = Tables(spark, sf_dir)
    payload = {"source_dataset": "part", "steps": [
        {"type": "FILTER", "config": {"column": "p_name", "operator": "CONTAINS",
                                      "value": "a"}}]}
    return run_steps(payload, t.get).select("p_partkey", "p_name")


# A pricing-summary report in the step language: numeric filters, a
# pass-through step of an unknown type, and several aggregate functions,
# including a distinct count written in the column text.
PRICING_STEPS = {
    "source_dataset": "lineitem",
    "steps": [
        {"type": "FILTER",
         "config": {"column": "l_quantity", "operator": "GREATER_THAN", "value": 5}},
        {"type": "FILTER",
         "config": {"column": "l_discount", "operator": "LESS_THAN", "value": 0.09}},
        {"type": "FILTER", "config": {"column": "l_shipdate", "operator": "IS_NOT_NULL"}},
        {"type": "SORT", "config": {}},
        {"type": "AGGREGATE",
         "config": {"group_by": ["l_returnflag", "l_linestatus"],
                    "aggregations": [
                        {"column": "l_quantity", "function": "SUM", "alias": "sum_qty"},
                        {"column": "l_extendedprice", "function": "MAX"},
                        {"column": "l_tax", "function": "MIN"},
                        {"column": "DISTINCT l_orderkey", "function": "COUNT",
                         "alias": "n_orders"},
                        {"column": "*", "function": "COUNT", "alias": "n_lines"},
                    ]}},
    ],
}


@plan("step_pricing_summary", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
       max(l_extendedprice) AS max_l_extendedprice, min(l_tax) AS min_l_tax,
       count(DISTINCT l_orderkey) AS n_orders, count(*) AS n_lines
FROM lineitem
WHERE l_quantity > 5 AND l_discount < 0.09 AND l_shipdate IS NOT NULL
GROUP BY l_returnflag, l_linestatus
""")
def step_pricing_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    out = run_steps(PRICING_STEPS, t.get)
    return out.withColumn("sum_qty", F.round("sum_qty", 2))


@plan("step_full_join", """
SELECT c_mktsegment, count(o_orderkey) AS n_orders, count(c_custkey) AS n_matched,
       count(*) AS n_rows
FROM (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') l
FULL OUTER JOIN customer r ON l.o_custkey = r.c_custkey
GROUP BY c_mktsegment
""")
def step_full_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    payload = {"source_dataset": "orders", "steps": [
        {"type": "FILTER", "config": {"column": "o_orderpriority", "operator": "EQUALS",
                                      "value": "1-URGENT"}},
        {"type": "JOIN", "config": {"right_dataset": "customer", "type": "FULL",
                                    "left_key": "o_custkey", "right_key": "c_custkey"}},
        {"type": "AGGREGATE", "config": {"group_by": ["c_mktsegment"], "aggregations": [
            {"column": "o_orderkey", "function": "COUNT", "alias": "n_orders"},
            {"column": "c_custkey", "function": "COUNT", "alias": "n_matched"},
            {"column": "*", "function": "COUNT", "alias": "n_rows"}]}},
    ]}
    return run_steps(payload, t.get)
