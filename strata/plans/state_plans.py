"""Plans for tables kept over time and who may read them: joint refresh (K3), dated snapshots (D2), periods of
validity (D6), row access by sets (D4), tags that follow the data (D5)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.operators.access import ACCESS, row_access_sets
from strata.operators.periods import events_in_periods
from strata.operators.snapshots import state_at, write_snapshot
from strata.operators.tags import mask_derived, tag
from strata.plans.history_plans import _OP_SQL, _ledger
from strata.plans.registry import plan
from strata.session import scratch_path
from strata.sinks.refresh import ForeignKey, MissingParents, read_refreshed, refresh_tables
from strata.sources.tables import Tables

_KEYS = [ForeignKey("customer", ("c_nationkey",), "nation", ("n_nationkey",)),
         ForeignKey("orders", ("o_custkey",), "customer", ("c_custkey",)),
         ForeignKey("lineitem", ("l_orderkey",), "orders", ("o_orderkey",))]


@plan("refresh_tables", """
WITH o AS (SELECT orders.* FROM orders JOIN customer ON o_custkey = c_custkey),
bad AS (SELECT count(*) AS n FROM o WHERE o_custkey % 7 = 3)
SELECT 'nation' AS table_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS refused FROM nation
UNION ALL SELECT 'customer', count(*), 0 FROM customer
UNION ALL SELECT 'orders', count(*), (SELECT n FROM bad) FROM o
UNION ALL SELECT 'lineitem', count(*), 0 FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o)
""")
def refresh_tables_plan(spark, sf_dir):
    """Related tables published together; then customers without some that orders refer to, which is refused whole."""
    t, root = Tables(spark, sf_dir), scratch_path(spark, f"refresh-{uuid.uuid4().hex}")
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    lines = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    refresh_tables(spark, root, {"lineitem": lines, "orders": orders, "customer": t.customer, "nation": t.nation}, _KEYS)
    refused = {}
    try:
        refresh_tables(spark, root, {"customer": t.customer.filter("c_custkey % 7 <> 3"), "nation": t.nation}, _KEYS)
    except MissingParents as e:
        refused = {k.child: n for k, n in e.orphans.items()}
    out = None
    for name in ("nation", "customer", "orders", "lineitem"):
        row = read_refreshed(spark, root, name).agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(refused.get(name, 0)).cast("long").alias("refused"))
        out = row if out is None else out.union(row)
    return out


@plan("state_from_snapshot", f"""
SELECT user_id, event_id, event_type FROM (
  SELECT *, {_OP_SQL} AS op, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts <= TIMESTAMP '2024-01-22 06:00:00') WHERE rn = 1 AND op <> 'DELETE'
""")
def state_from_snapshot(spark, sf_dir):
    """The state at a time, from the last of three dated snapshots before it and the changes since."""
    path = scratch_path(spark, f"snapshots-{uuid.uuid4().hex}")
    ledger = _ledger(Tables(spark, sf_dir))
    args = ("user_id", ["ts", "event_id"], "op", ["event_id", "event_type"], "ts")
    for day in ("2024-01-08", "2024-01-15", "2024-01-25"):
        write_snapshot(spark, ledger, path, f"{day} 00:00:00", *args)
    return state_at(spark, ledger, path, "2024-01-22 06:00:00", *args)


_PERIODS_SQL = """
p AS (SELECT event_id AS period_id, user_id % 3 AS grp, ts AS valid_from,
             CASE WHEN event_id % 5 <> 0 THEN ts + to_hours(event_id % 97) END AS valid_to
      FROM events WHERE event_type IN ('signup', 'error')),
e AS (SELECT event_id, user_id % 3 AS grp, ts, value FROM events WHERE event_type = 'purchase')"""


@plan("events_in_periods", f"""
WITH {_PERIODS_SQL}
SELECT period_id, count(*) AS n_events, round(sum(value), 2) AS total
FROM p JOIN e ON p.grp = e.grp AND e.ts >= p.valid_from AND (p.valid_to IS NULL OR e.ts < p.valid_to)
GROUP BY period_id
""")
def events_in_periods_plan(spark, sf_dir):
    """Purchases in overlapping periods of three hot keys, every fifth without an end."""
    ev = Tables(spark, sf_dir).events.withColumn("grp", F.col("user_id") % 3)
    then = F.when(F.col("event_id") % 5 != 0, F.expr("ts + make_dt_interval(0, cast(event_id % 97 as int))"))
    periods = ev.filter(F.col("event_type").isin("signup", "error")).select(
        F.col("event_id").alias("period_id"), F.col("grp").alias("period_grp"), F.col("ts").alias("valid_from"), then.alias("valid_to"))
    events = ev.filter("event_type = 'purchase'").select("event_id", "grp", "ts", "value")
    sums = {"n_events": F.lit(1).cast("long"), "total": F.col("value")}
    held = events_in_periods(events, periods, "grp", "period_grp", "ts", "valid_from", "valid_to", sums)
    return held.groupBy("period_id").agg(F.sum("n_events").alias("n_events"), F.round(F.sum("total"), 2).alias("total"))


@plan("row_access_sets", """
SELECT o.o_orderkey, count(*) AS n_principals, min(g.n_name) AS first_principal, max(g.n_name) AS last_principal
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN nation g ON g.n_regionkey = cn.n_regionkey GROUP BY o.o_orderkey
""")
def row_access_sets_plan(spark, sf_dir):
    """Orders with the number of the set of nations that may read them, one row an order."""
    t = Tables(spark, sf_dir)
    grants = t.nation.join(t.nation.select(F.col("n_nationkey").alias("attr"), F.col("n_regionkey").alias("of")), F.col("n_regionkey") == F.col("of")).select(
        F.col("n_name").alias("principal"), "attr")
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    a = row_access_sets(rows, grants, "c_nationkey", "attr")
    about = a.sets.groupBy(ACCESS).agg(F.count("*").alias("n_principals"), F.min("principal").alias("first_principal"), F.max("principal").alias("last_principal"))
    return a.rows.join(about, ACCESS).drop(ACCESS, "c_nationkey")


@plan("masked_derived", """
SELECT c_mktsegment, count(*) AS n_orders, CAST(NULL AS DOUBLE) AS balance, round(sum(o_totalprice), 2) AS total,
       CAST(NULL AS DOUBLE) AS share, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment
""")
def masked_derived(spark, sf_dir):
    """Of columns computed over a join, those that a tagged balance reaches are masked without being named."""
    t = Tables(spark, sf_dir)
    c = tag(t.customer, {"c_acctbal": "Confidential/Finance/Payroll"}).withColumn("half", F.col("c_acctbal") / 2)
    j = c.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
    out = j.groupBy("c_mktsegment").agg(
        F.count("*").alias("n_orders"), F.max("half").alias("balance"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        (F.sum("o_totalprice") / F.sum("half")).alias("share"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"))
    return mask_derived(out)
