"""Plans for rule validation, audit reports and upserts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from strata.operators.report import audit_report, audit_stats
from strata.operators.rules import Rule, validate
from strata.plans.registry import plan
from strata.sinks.upsert import upsert
from strata.sources.tables import Tables

RUN_TIME = datetime(2024, 1, 1)

LINEITEM_RULES = [
    Rule("R1", "l_quantity > 10"),
    Rule("R2", "l_returnflag IN ('A','N')"),
]

# Compat-mode rules chosen to walk every branch of the loose evaluator.
COMPAT_RULES = [
    Rule("C1", "l_quantity > 10"),
    Rule("C2", "l_returnflag IN ('A', 'N')"),
    Rule("C3", "l_comment IS NOT NULL AND l_comment != ''"),
    Rule("C4", "l_linestatus != 'O'"),
    Rule("C5", "l_shipmode IS NULL OR l_shipmode IN ('AIR')"),
    Rule("C6", "l_discount >= 0.05"),
    Rule("C7", "COUNT(*) > 0"),
    Rule("C8", "l_tax < 0.02"),
    Rule("C9", "l_linestatus IS NULL OR l_returnflag IN ('R')"),
    Rule("C10", "l_returnflag != l_linestatus"),
]

ORDER_RULES = [
    Rule("O1", "o_totalprice > 1000"),
    Rule("O2", "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"),
]


def _lineitem_audit(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return validate(li, "lineitem", LINEITEM_RULES, mode="strict",
                    evaluated_at=RUN_TIME, carry=["l_linenumber"])


@plan("rule_audit", """
SELECT CAST(l_orderkey AS VARCHAR) AS row_key, l_linenumber, rule_id,
       CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT l_orderkey, l_linenumber, 'R1' AS rule_id, l_quantity > 10 AS ok FROM lineitem
      UNION ALL
      SELECT l_orderkey, l_linenumber, 'R2', l_returnflag IN ('A','N') FROM lineitem)
""")
def rule_audit(spark, sf_dir):
    return _lineitem_audit(spark, sf_dir).audit.select(
        "row_key", "l_linenumber", "rule_id", "status")


@plan("rule_valid", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_quantity > 10 AND l_returnflag IN ('A','N')
""")
def rule_valid(spark, sf_dir):
    return _lineitem_audit(spark, sf_dir).valid.select("l_orderkey", "l_linenumber")


@plan("audit_stats", """
SELECT count(*) FILTER (WHERE ok) AS passed, count(*) FILTER (WHERE NOT ok) AS failed,
       CAST(0 AS BIGINT) AS warned, count(*) AS total,
       round(count(*) FILTER (WHERE ok) * 100.0 / count(*), 2)::DOUBLE AS pass_pct
FROM (SELECT l_quantity > 10 AS ok FROM lineitem
      UNION ALL SELECT l_returnflag IN ('A','N') FROM lineitem)
""")
def audit_stats_plan(spark, sf_dir):
    return audit_stats(_lineitem_audit(spark, sf_dir).audit)


@plan("rule_audit_compat", """
WITH t AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS row_key, CAST(l_quantity AS VARCHAR) AS q,
         l_returnflag AS rf, l_linestatus AS ls, CAST(l_discount AS VARCHAR) AS d
  FROM lineitem)
SELECT row_key, rule_id, status, error_message FROM (
  SELECT row_key, 'C1' AS rule_id,
         CASE WHEN TRY_CAST(q AS DOUBLE) > 10 THEN 'PASS' ELSE 'FAIL' END AS status,
         CASE WHEN TRY_CAST(q AS DOUBLE) > 10 THEN '' ELSE 'l_quantity (' || q || ') <= 10' END
           AS error_message FROM t
  UNION ALL SELECT row_key, 'C2', CASE WHEN rf IN ('A','N') THEN 'PASS' ELSE 'FAIL' END,
         CASE WHEN rf IN ('A','N') THEN '' ELSE 'l_returnflag (' || rf || ') not in [''A'', ''N'']' END
         FROM t
  UNION ALL SELECT row_key, 'C3', 'FAIL', 'l_comment is null but required not to be' FROM t
  UNION ALL SELECT row_key, 'C4', CASE WHEN ls <> '''O''' THEN 'PASS' ELSE 'FAIL' END,
         CASE WHEN ls <> '''O''' THEN '' ELSE 'l_linestatus (' || ls || ') == ''O'' (''O'')' END FROM t
  UNION ALL SELECT row_key, 'C5', 'PASS', '' FROM t
  UNION ALL SELECT row_key, 'C6', CASE WHEN TRY_CAST(d AS DOUBLE) >= 0.05 THEN 'PASS' ELSE 'FAIL' END,
         CASE WHEN TRY_CAST(d AS DOUBLE) >= 0.05 THEN '' ELSE 'l_discount (' || d || ') < 0.05' END FROM t
  UNION ALL SELECT row_key, 'C7', 'PASS',
         'Skipped aggregation rule evaluation in single-row context' FROM t
  UNION ALL SELECT row_key, 'C8', 'PASS',
         'Rule too complex for simple evaluator, defaulted to PASS' FROM t
  UNION ALL SELECT row_key, 'C9', 'PASS', '' FROM t
  UNION ALL SELECT row_key, 'C10', CASE WHEN rf <> ls THEN 'PASS' ELSE 'FAIL' END,
         CASE WHEN rf <> ls THEN '' ELSE 'l_returnflag (' || rf || ') == l_linestatus (' || ls || ')' END
         FROM t)
""")
def rule_audit_compat(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    v = validate(li, "lineitem", COMPAT_RULES, mode="compat", evaluated_at=RUN_TIME)
    return v.audit.select("row_key", "rule_id", "status", "error_message")


@plan("audit_report", """
SELECT CAST(o_orderkey AS VARCHAR) AS row_key, rule_id, status
FROM (SELECT o_orderkey, 'O1' AS rule_id, o_totalprice > 1000 AS ok FROM orders
      UNION ALL SELECT o_orderkey, 'O2',
             o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') FROM orders) a,
     LATERAL (SELECT CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status) s
WHERE status IN ('FAIL')
ORDER BY row_key DESC, rule_id
LIMIT 50
""")
def audit_report_plan(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    v = validate(o, "orders", ORDER_RULES, mode="strict", evaluated_at=RUN_TIME,
                 audit_id="hash", run_id="report")
    return audit_report(v.audit, ["FAIL"], 50).select("row_key", "rule_id", "status")


@plan("upsert_merge", """
SELECT c_custkey, c_name,
       CASE WHEN c_acctbal < -500 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def upsert_merge(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    target = c.select("c_custkey", "c_name", "c_mktsegment")
    # Batch: every customer in debt; deep debt re-segments, shallow debt carries
    # an empty segment, which K1 must not write over the old value.
    batch = c.filter(F.col("c_acctbal") < 0).select(
        "c_custkey",
        F.when(F.col("c_acctbal") < -500, F.lit("NEW")).otherwise(F.lit("")).alias(
            "c_mktsegment"))
    return upsert(target, batch, "c_custkey", mode="non_empty")


_BATCH_SQL = """
WITH t AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0),
b AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'NEW' END AS c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 2 = 0)"""


def _merge_batch(spark, sf_dir):
    """Two thirds of the customers, and a batch of every second one, some of them new, each key twice."""
    c = Tables(spark, sf_dir).customer
    target = c.filter("c_custkey % 3 <> 0").select("c_custkey", "c_name", "c_mktsegment")
    new = c.filter("c_custkey % 2 = 0").select(
        "c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.lit("")).otherwise(F.lit("NEW")).alias("c_mktsegment"), "c_nationkey", F.lit(2).alias("seq"))
    return target, new.unionByName(new.withColumns({"c_mktsegment": F.lit("OLD"), "seq": F.lit(1)}))


@plan("upsert_inserts", _BATCH_SQL + """
SELECT coalesce(t.c_custkey, b.c_custkey) AS c_custkey, t.c_name,
       CASE WHEN b.c_custkey IS NULL OR (b.c_mktsegment = '' AND t.c_custkey IS NOT NULL) THEN t.c_mktsegment ELSE b.c_mktsegment END AS c_mktsegment,
       b.c_nationkey
FROM t FULL JOIN b ON t.c_custkey = b.c_custkey
""")
def upsert_inserts(spark, sf_dir):
    """K1: new keys inserted, empty values kept out, the last of repeated keys, a column that only the batch has."""
    target, batch = _merge_batch(spark, sf_dir)
    return upsert(target, batch, "c_custkey", mode="non_empty", order_by="seq")


@plan("upsert_replace_inserts", _BATCH_SQL + """
SELECT coalesce(t.c_custkey, b.c_custkey) AS c_custkey, t.c_name,
       CASE WHEN b.c_custkey IS NULL THEN t.c_mktsegment ELSE b.c_mktsegment END AS c_mktsegment, b.c_nationkey
FROM t FULL JOIN b ON t.c_custkey = b.c_custkey
""")
def upsert_replace_inserts(spark, sf_dir):
    """K2: new keys inserted, matched rows replaced with empty values too."""
    target, batch = _merge_batch(spark, sf_dir)
    return upsert(target, batch, "c_custkey", mode="replace", order_by="seq")


@plan("apply_actions_branches", """
WITH a AS (SELECT CASE WHEN event_id % 5 = 0 THEN user_id + 1000000000 ELSE user_id END AS id,
                  CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v, ts, event_id FROM events WHERE event_type = 'purchase'),
l AS (SELECT id, v FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS rn FROM a) WHERE rn = 1)
SELECT c_custkey, CASE WHEN l.id IS NULL THEN c_acctbal ELSE l.v END AS c_acctbal FROM customer LEFT JOIN l ON l.id = c_custkey
""")
def apply_actions_branches(spark, sf_dir):
    """K8: the last action counts, a NULL payload sets NULL, ids that no row has change nothing."""
    from strata.sinks.upsert import apply_actions
    t = Tables(spark, sf_dir)
    ident = F.when(F.col("event_id") % 5 == 0, F.col("user_id") + 1000000000).otherwise(F.col("user_id"))
    actions = t.events.filter("event_type = 'purchase'").select(
        ident.alias("c_custkey"), F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("c_acctbal"), F.struct("ts", "event_id").alias("seq"))
    return apply_actions(t.customer.select("c_custkey", "c_acctbal"), actions, "c_custkey", "c_acctbal", "seq")


@plan("audit_flatten", """
WITH a AS (
  SELECT 'lineitem' AS table_name, 'R1' AS rule_id, l_quantity > 10 AS ok FROM lineitem
  UNION ALL SELECT 'lineitem', 'R2', l_returnflag IN ('A','N') FROM lineitem
  UNION ALL SELECT 'orders', 'O1', o_totalprice > 1000 FROM orders
  UNION ALL SELECT 'orders', 'O2', o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') FROM orders)
SELECT table_name, rule_id, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS n_rows
FROM a GROUP BY ALL
""")
def audit_flatten(spark, sf_dir):
    from strata.operators.rules import flatten_audits
    t = Tables(spark, sf_dir)
    audits = [validate(t.lineitem, "lineitem", LINEITEM_RULES, mode="strict",
                       evaluated_at=RUN_TIME).audit,
              validate(t.orders, "orders", ORDER_RULES, mode="strict",
                       evaluated_at=RUN_TIME).audit]
    return flatten_audits(audits).groupBy("table_name", "rule_id", "status").agg(
        F.count(F.lit(1)).alias("n_rows"))


@plan("upsert_replace", """
SELECT c_custkey, c_name,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal
FROM customer
""")
def upsert_replace(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    target = c.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    # K2: the batch rows replace matched rows whole, NULLs included
    batch = c.filter(F.col("c_acctbal") < 0).select(
        "c_custkey", "c_name", F.lit(None).cast("string").alias("c_mktsegment"),
        F.lit(0.0).alias("c_acctbal"))
    return upsert(target, batch, "c_custkey", mode="replace")


@plan("apply_actions", """
SELECT c_custkey, coalesce(a.v, c.c_acctbal) AS c_acctbal
FROM customer c LEFT JOIN (
  SELECT user_id, arg_max(value, (ts, event_id)) AS v FROM events
  WHERE event_type = 'purchase' GROUP BY user_id) a ON a.user_id = c.c_custkey
""")
def apply_actions_plan(spark, sf_dir):
    from strata.sinks.upsert import apply_actions
    t = Tables(spark, sf_dir)
    actions = (t.events.filter(F.col("event_type") == "purchase")
               .select(F.col("user_id").alias("c_custkey"), F.col("value").alias("c_acctbal"),
                       F.struct("ts", "event_id").alias("seq")))
    return apply_actions(t.customer.select("c_custkey", "c_acctbal"), actions, "c_custkey",
                         "c_acctbal", "seq")


@plan("typed_reload", """
SELECT CAST(l_orderkey AS BIGINT) AS orderkey, CAST(l_quantity AS DECIMAL(38,9)) AS quantity,
       CAST(l_shipdate AS DATE) AS ship_day, l_returnflag AS return_flag
FROM lineitem
""")
def typed_reload(spark, sf_dir):
    from strata.operators.rules import as_text
    from strata.sources.csv import TypedColumn, load_typed
    # the all-string view a CSV bulk load produces, typed back by the seeder's rules
    text = as_text(Tables(spark, sf_dir).lineitem)
    return load_typed(text, [TypedColumn("l_orderkey", "orderkey", "bigint"),
                             TypedColumn("l_quantity", "quantity", "decimal(38,9)"),
                             TypedColumn("l_shipdate", "ship_day", "date"),
                             TypedColumn("l_returnflag", "return_flag", "string")])


@plan("drop_blank", """
SELECT conv_id, turn FROM conversations
WHERE trim(coalesce(role, '')) <> '' OR trim(coalesce(text, '')) <> ''
""")
def drop_blank(spark, sf_dir):
    from strata.sources.csv import drop_blank_rows
    conv = Tables(spark, sf_dir).conversations
    return drop_blank_rows(conv, ["role", "text"]).select("conv_id", "turn")


_TYPED_SQL = """
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey,
                  CASE WHEN l_partkey % 10 = 0 THEN 'n/a' WHEN l_partkey % 10 = 1 THEN '' ELSE CAST(l_quantity AS VARCHAR) END AS quantity,
                  CASE WHEN l_suppkey % 9 = 0 THEN '' WHEN l_suppkey % 9 = 1 THEN '31.12.2024' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS ship_day
           FROM lineitem)"""


@plan("typed_load_rejects", _TYPED_SQL + """
SELECT CASE WHEN quantity = 'n/a' AND ship_day IN ('', '31.12.2024') THEN 'quantity: not decimal(38,9), ship_day: not date'
            WHEN quantity = 'n/a' THEN 'quantity: not decimal(38,9)'
            WHEN ship_day IN ('', '31.12.2024') THEN 'ship_day: not date' ELSE 'loaded' END AS outcome,
       count(*) AS n_rows, CASE WHEN outcome = 'loaded' THEN count(try_cast(quantity AS DECIMAL(38, 9))) END AS with_quantity
FROM t GROUP BY 1
""")
def typed_load_rejects(spark, sf_dir):
    """Text rows typed, those with a value that does not parse kept apart with their reasons."""
    from strata.sources.csv import TypedColumn, load_typed_checked
    part, supp = F.col("l_partkey") % 10, F.col("l_suppkey") % 9
    text = Tables(spark, sf_dir).lineitem.select(
        F.col("l_orderkey").cast("string").alias("orderkey"),
        F.when(part == 0, "n/a").when(part == 1, "").otherwise(F.col("l_quantity").cast("string")).alias("quantity"),
        F.when(supp == 0, "").when(supp == 1, "31.12.2024").otherwise(F.to_date("l_shipdate").cast("string")).alias("ship_day"))
    load = load_typed_checked(text, [TypedColumn("orderkey", "orderkey", "bigint"), TypedColumn("quantity", "quantity", "decimal(38,9)"),
                                     TypedColumn("ship_day", "ship_day", "date", required=True)])
    good = load.rows.agg(F.count("*").alias("n_rows"), F.count("quantity").alias("with_quantity")).select(F.lit("loaded").alias("outcome"), "*")
    bad = load.rejected.groupBy(F.array_join("reasons", ", ").alias("outcome")).agg(F.count("*").alias("n_rows"))
    return good.unionByName(bad, allowMissingColumns=True)


@plan("blank_rows", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '  ' WHEN event_id % 3 = 1 THEN event_type END AS kind,
       CASE WHEN event_id % 5 > 0 THEN props ELSE '' END AS detail
FROM events WHERE event_id % 3 = 1 AND trim(event_type) <> '' OR event_id % 5 > 0 AND trim(props) <> ''
""")
def blank_rows(spark, sf_dir):
    """S3: rows whose every value is blank, missing or spaces alone are dropped."""
    from strata.sources.csv import drop_blank_rows
    rest = F.col("event_id") % 3
    rows = Tables(spark, sf_dir).events.select(
        "event_id", F.when(rest == 0, "  ").when(rest == 1, F.col("event_type")).alias("kind"),
        F.when(F.col("event_id") % 5 > 0, F.col("props")).otherwise("").alias("detail"))
    return drop_blank_rows(rows, ["kind", "detail"])


@plan("daily_cost", """
SELECT CAST(ts AS DATE) AS usage_date, round(sum(value), 2) AS total_cost
FROM events WHERE event_type = 'purchase' GROUP BY 1
""")
def daily_cost_plan(spark, sf_dir):
    from strata.operators.report import daily_cost
    # billing rows: a cost, a usage time and a service struct
    billing = Tables(spark, sf_dir).events.select(
        F.col("ts").alias("usage_start_time"), F.col("value").alias("cost"),
        F.struct(F.col("event_type").alias("description")).alias("service"))
    return daily_cost(billing, service="purchase")
