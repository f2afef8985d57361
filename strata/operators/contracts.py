"""Schema contract checks as joins over column catalogs.

A catalog is a DataFrame ``(table_name, column_name, type)`` -- one row per
column of every table in an estate.  Diff and drift are one full outer join
on ``(table_name, column_name)`` plus table-level anti joins, so they scale
with the number of columns, not with a script per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.ontology import STRING_MAX_LENGTH

# Catalog tables that the drift scan never reports.
SYSTEM_TABLES = (
    "raw_yaml_registry", "canonical_object_types", "canonical_relationship_types",
    "schema_change_log", "deployment_audit", "rule_audit", "ontology_object_registry",
    "file_processing_status", "rule_definitions", "transactions", "ontology_change_log",
)
# Change kinds and their severity order.
ADDITIVE, COMPATIBLE, BREAKING = "ADDITIVE", "COMPATIBLE", "BREAKING"
# Drift kinds.
CREATE_TABLE, EXTRA_TABLE = "CREATE_TABLE", "EXTRA_TABLE"
ADD_COLUMN, EXTRA_COLUMN = "ADD_COLUMN", "EXTRA_COLUMN"
SAME, WIDENING, TYPE_MISMATCH = "OK", "COMPATIBLE_CHANGE", "BREAKING"


def norm_type(c: Column) -> Column:
    """Upper case, no spaces; missing -> STRING(MAX)."""
    return F.when(c.isNull() | (c == ""), F.lit("STRING(MAX)")).otherwise(
        F.upper(F.regexp_replace(c, " ", "")))


def string_len(c: Column) -> Column:
    """Length of ``STRING(n)`` (MAX -> widest), NULL for other types."""
    inner = F.regexp_extract(c, r"^STRING\((.+)\)$", 1)
    return (F.when(inner == "", F.lit(None).cast("bigint"))
            .when(inner == "MAX", F.lit(STRING_MAX_LENGTH).cast("bigint"))
            .otherwise(inner.try_cast("bigint")))


def contract_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per entity of ``new``: added / removed / retyped properties and kind.

    Types compare as raw text (``string`` vs ``STRING`` is a change).  Removed
    or retyped -> BREAKING; else added -> COMPATIBLE; else (identical, or an
    entity absent from ``old``) -> ADDITIVE.
    """
    o = old.select(F.col("table_name").alias("t"), F.col("column_name").alias("c"),
                   F.col("type").alias("old_type"))
    n = new.select(F.col("table_name").alias("t"), F.col("column_name").alias("c"),
                   F.col("type").alias("new_type"))
    j = o.join(n, ["t", "c"], "full_outer")
    has_new = F.col("new_type").isNotNull()
    has_old = F.col("old_type").isNotNull()
    per = j.groupBy("t").agg(
        F.array_sort(F.collect_list(F.when(has_new & ~has_old, F.col("c")))).alias("added"),
        F.array_sort(F.collect_list(F.when(has_old & ~has_new, F.col("c")))).alias("removed"),
        F.array_sort(F.collect_list(F.when(has_old & has_new & (F.col("old_type") != F.col(
            "new_type")), F.col("c")))).alias("type_changes"),
        F.count_if(has_old).alias("_n_old"), F.count_if(has_new).alias("_n_new"))
    kind = (F.when(F.col("_n_old") == 0, F.lit(ADDITIVE))
            .when((F.size("removed") > 0) | (F.size("type_changes") > 0), F.lit(BREAKING))
            .when(F.size("added") > 0, F.lit(COMPATIBLE)).otherwise(F.lit(ADDITIVE)))
    return per.filter(F.col("_n_new") > 0).select(
        F.col("t").alias("table_name"), "added", "removed", "type_changes", kind.alias("kind"))


def plan_gate(diff: DataFrame) -> str:
    """Roll-up of C1: BLOCKED when any entity is BREAKING, else VALID."""
    r = diff.agg(F.bool_or(F.col("kind") == BREAKING).alias("b")).first()
    return "BLOCKED" if r and r["b"] else "VALID"


def catalog_drift(contract: DataFrame, live: DataFrame,
                  tables: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """C2 (+C4): drift of the live catalog against the contract catalog.

    Returns ``(table_name, column_name, kind, contract_type, live_type)`` with
    kinds CREATE_TABLE / EXTRA_TABLE (table level, column NULL), ADD_COLUMN,
    EXTRA_COLUMN (info only), OK, COMPATIBLE_CHANGE (``STRING(n)`` widening),
    BREAKING.  ``tables`` (C4) limits both sides to a changed-table list; an
    empty list means a full comparison.
    """
    if tables is not None:
        if not isinstance(tables, DataFrame):
            tables = list(tables)
            if tables:
                contract = contract.filter(F.col("table_name").isin(tables))
                live = live.filter(F.col("table_name").isin(tables))
        else:
            contract = contract.join(tables, "table_name", "left_semi")
            live = live.join(tables, "table_name", "left_semi")
    c = contract.select("table_name", "column_name", norm_type(F.col("type")).alias("ct"))
    lv = live.select("table_name", "column_name", norm_type(F.col("type")).alias("lt"))
    ct = c.select("table_name").distinct().withColumn("_in_c", F.lit(True))
    lt = lv.select("table_name").distinct().withColumn("_in_l", F.lit(True))
    tables_both = ct.join(lt, "table_name", "full_outer")
    table_rows = tables_both.filter(F.col("_in_c").isNull() | F.col("_in_l").isNull()).select(
        "table_name", F.lit(None).cast("string").alias("column_name"),
        F.when(F.col("_in_l").isNull(), F.lit(CREATE_TABLE)).otherwise(F.lit(EXTRA_TABLE))
        .alias("kind"), F.lit(None).cast("string").alias("contract_type"),
        F.lit(None).cast("string").alias("live_type"))
    common = tables_both.filter(F.col("_in_c") & F.col("_in_l")).select("table_name")
    cols = (c.join(common, "table_name", "left_semi")
            .join(lv.join(common, "table_name", "left_semi"), ["table_name", "column_name"],
                  "full_outer"))
    widen = (F.col("ct").startswith("STRING(") & F.col("lt").startswith("STRING(")
             & (string_len(F.col("ct")) >= string_len(F.col("lt"))))
    kind = (F.when(F.col("lt").isNull(), F.lit(ADD_COLUMN))
            .when(F.col("ct").isNull(), F.lit(EXTRA_COLUMN))
            .when(F.col("ct") == F.col("lt"), F.lit(SAME))
            .when(widen, F.lit(WIDENING)).otherwise(F.lit(TYPE_MISMATCH)))
    col_rows = cols.select("table_name", "column_name", kind.alias("kind"),
                           F.col("ct").alias("contract_type"), F.col("lt").alias("live_type"))
    return table_rows.unionByName(col_rows)


def drift_verdict(report: DataFrame, mode: str = "auto-additive") -> DataFrame:
    """One status row.  Breaking drift (extra tables, type mismatches) ->
    FAIL; only evolution (tables to create, columns to add, widenings) -> OK,
    or FAIL in ``strict`` mode; nothing -> OK.  ``manual`` acts as
    ``auto-additive``."""
    k = F.col("kind")
    agg = report.agg(
        F.coalesce(F.bool_or(k.isin(EXTRA_TABLE, TYPE_MISMATCH)), F.lit(False)).alias("drift"),
        F.coalesce(F.bool_or(k.isin(CREATE_TABLE, ADD_COLUMN, WIDENING)), F.lit(False))
        .alias("evolution"))
    strict = F.lit(mode == "strict")
    status = (F.when(F.col("drift"), F.lit("BREAKING_DRIFT"))
              .when(F.col("evolution") & strict, F.lit("EVOLUTION_BLOCKED"))
              .when(F.col("evolution"), F.lit("COMPATIBLE_EVOLUTION"))
              .otherwise(F.lit("NO_DRIFT")))
    ok = ~F.col("drift") & ~(F.col("evolution") & strict)
    return agg.select("drift", "evolution", status.alias("status"), ok.alias("ok"))


# Spark type -> catalog type name.
def catalog_type(dt: T.DataType) -> str:
    if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return "INT64"
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return "FLOAT64"
    if isinstance(dt, T.DecimalType):
        return "NUMERIC"
    if isinstance(dt, T.BooleanType):
        return "BOOL"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dt, (T.VarcharType, T.CharType)):
        return f"STRING({dt.length})"
    if isinstance(dt, T.StringType):
        return "STRING(MAX)"
    return dt.simpleString().upper()


def scan_catalog(spark: SparkSession, database: str | None = None,
                 tables: Sequence[str] | None = None) -> DataFrame:
    """``(table_name, column_name, type)`` of the session catalog, types by their contract names.

    System tables are skipped, and so is every name matching ``LIKE 'v_%'``
    -- where ``_`` is a one-character wildcard, so ``vehicle`` is skipped too.
    """
    rows = []
    for t in spark.catalog.listTables(database):
        for col in spark.catalog.listColumns(t.name, database):
            rows.append((t.name, col.name, catalog_type(T.DataType.fromDDL(col.dataType))))
    df = spark.createDataFrame(rows, "table_name string, column_name string, type string")
    df = df.filter(~F.col("table_name").isin(list(SYSTEM_TABLES))
                   & ~F.col("table_name").like("v_%"))
    if tables:
        df = df.filter(F.col("table_name").isin(list(tables)))
    return df.withColumn("type", norm_type(F.col("type")))


def schema_catalog(frames: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    """Catalog rows from DataFrame schemas (driver-side metadata)."""
    return [(name, f.name, catalog_type(f.dataType))
            for name, df in frames.items() for f in df.schema.fields]
