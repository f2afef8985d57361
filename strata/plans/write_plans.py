"""Plans that write and read back: CSV scan (S1) and export (K7), audit append (K4), date partitions (K6), digest gate."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.operators.merkle import assert_same
from strata.operators.reconcile import HashMismatch, assert_digest, dataset_digest
from strata.operators.rules import Rule, validate
from strata.plans.registry import plan
from strata.plans.rules_plans import LINEITEM_RULES, RUN_TIME
from strata.session import scratch_path
from strata.sinks.writes import append_audit, export_csv, write_date_partitioned
from strata.sources.csv import scan_csv
from strata.sources.tables import Tables


def _path(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@plan("csv_scan", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ', "' || c_mktsegment || '"' AS label, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS nation, 'row' AS kind
FROM customer WHERE c_custkey % 11 <> 3 AND c_custkey % 13 <> 4
UNION ALL SELECT CAST(c_custkey AS VARCHAR) || ',x', NULL, NULL, 'rejected' FROM customer WHERE c_custkey % 11 = 3 AND c_custkey % 13 <> 4
""")
def csv_scan(spark, sf_dir):
    """Lines with quotes, empty values, a field too few, and the header among the rows."""
    c, root = Tables(spark, sf_dir).customer, _path(spark, "csv-scan")
    text = F.concat(F.lit('"'), F.col("c_name"), F.lit(', ""'), F.col("c_mktsegment"), F.lit('"""'))
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), text, F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_nationkey").cast("string")))
    bad = F.when(F.col("c_custkey") % 13 == 4, "c_custkey,label,nation").when(F.col("c_custkey") % 11 == 3, F.concat(F.col("c_custkey").cast("string"), F.lit(",x")))
    # each line as one value, under a header in each file, with signs that no line holds as delimiter and quote
    c.select(F.coalesce(bad, line).alias("c_custkey,label,nation")).write.option("header", True).option("quote", "`").option("delimiter", "\t").csv(root)
    scan = scan_csv(spark, root)
    return scan.rows.withColumn("kind", F.lit("row")).unionByName(
        scan.rejected.select(F.col("line").alias("c_custkey"), F.lit("rejected").alias("kind")), allowMissingColumns=True)


@plan("csv_export", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment || ', \"quoted\"' AS note FROM customer")
def csv_export(spark, sf_dir):
    """K7: exported with a header and read back as text."""
    root = _path(spark, "csv-export")
    export_csv(Tables(spark, sf_dir).customer.select("c_custkey", "c_name", F.concat(F.col("c_mktsegment"), F.lit(', "quoted"')).alias("note")), root)
    return scan_csv(spark, root).rows


@plan("audit_append", """
WITH a AS (SELECT 'lineitem' AS table_name, 'R1' AS rule_id, l_quantity > 10 AS ok FROM lineitem
           UNION ALL SELECT 'lineitem', 'R2', l_returnflag IN ('A','N') FROM lineitem
           UNION ALL SELECT 'orders', 'O1', o_totalprice > 1000 FROM orders)
SELECT table_name, rule_id, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS n_rows FROM a GROUP BY ALL
""")
def audit_append(spark, sf_dir):
    """K4: the audits of two loads appended one after the other."""
    t, root = Tables(spark, sf_dir), _path(spark, "audit")
    append_audit(validate(t.lineitem, "lineitem", LINEITEM_RULES, mode="strict", evaluated_at=RUN_TIME).audit, root)
    append_audit(validate(t.orders, "orders", [Rule("O1", "o_totalprice > 1000")], mode="strict", evaluated_at=RUN_TIME).audit, root)
    return spark.read.parquet(root).groupBy("table_name", "rule_id", "status").agg(F.count("*").alias("n_rows"))


@plan("date_partitions", """
SELECT CAST(ts AS DATE) AS partition_date, count(*) AS n_rows, sum(event_id)::BIGINT AS ids FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1
""")
def date_partitions(spark, sf_dir):
    """K6: events written by date in two appends; ten days read back."""
    events, root = Tables(spark, sf_dir).events, _path(spark, "dated")
    for rest in (0, 1):
        write_date_partitioned(events.filter(F.col("event_id") % 2 == rest), root, "ts")
    back = spark.read.parquet(root).filter(F.col("partition_date").between("2024-01-10", "2024-01-19"))
    return back.groupBy(F.col("partition_date").cast("date").alias("partition_date")).agg(F.count("*").alias("n_rows"), F.sum("event_id").alias("ids"))


@plan("digest_gate", """
SELECT 'same' AS case_name, true AS passed, count(*) AS n_rows FROM orders UNION ALL SELECT 'price changed', false, count(*) FROM orders
UNION ALL SELECT 'same, in order', true, count(*) FROM orders UNION ALL SELECT 'row lost', false, count(*) FROM orders
""")
def digest_gate(spark, sf_dir):
    """The gate passes equal tables, however they are partitioned, and stops changed ones."""
    o = Tables(spark, sf_dir).orders
    expected = dataset_digest(o).first()["dataset_hash"]
    least = o.agg(F.min("o_orderkey")).first()[0]
    changed = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") == least, 0.0).otherwise(F.col("o_totalprice")))

    def passes(gate) -> bool:
        try:
            gate()
            return True
        except HashMismatch:
            return False
    cases = {"same": lambda: assert_digest(o.repartition("o_custkey"), expected), "price changed": lambda: assert_digest(changed, expected),
             "same, in order": lambda: assert_same(o, o.repartition("o_custkey"), "o_orderkey"), "row lost": lambda: assert_same(o, o.filter(F.col("o_orderkey") > least), "o_orderkey")}
    n = o.agg(F.count("*").alias("n_rows"))
    out = None
    for name, gate in cases.items():
        row = n.select(F.lit(name).alias("case_name"), F.lit(passes(gate)).alias("passed"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out
