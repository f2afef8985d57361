"""Catalogs taken from the data: which columns the payloads of each table hold, and of which types.

Payloads are parsed to VARIANT, their top-level fields exploded, and ``schema_of_variant_agg`` merges the types of each
(table, field), combining in every task before the shuffle.  The result is a catalog ``(table_name, column_name, type)`` as
the contract checks (C1-C4) take it, without a loop over tables on the driver.  ``spec_paths`` goes below the top level:
a row for each path of a nested value, for specs that nest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.contracts import SYSTEM_TABLES


def contract_type(kind: Column, longest: Column) -> Column:
    """Contract name of a merged variant type; texts carry their greatest length.  What has no name of its own
    (mixed types, objects, arrays) keeps Spark's."""
    return (F.when(kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("INT64"))
            .when(kind.isin("DOUBLE", "FLOAT"), F.lit("FLOAT64"))
            .when(kind.startswith("DECIMAL"), F.lit("NUMERIC"))
            .when(kind == "BOOLEAN", F.lit("BOOL"))
            .when(kind == "DATE", F.lit("DATE"))
            .when(kind.startswith("TIMESTAMP"), F.lit("TIMESTAMP"))
            .when(kind == "STRING", F.concat(F.lit("STRING("), longest.cast("string"), F.lit(")")))
            .otherwise(kind))


def payload_catalog(rows: DataFrame, table: str, payload: str) -> DataFrame:
    """``(table_name, column_name, type)`` of the JSON objects in ``payload``, by the table that ``table`` names.

    Payloads that do not parse, or are no objects, add nothing, and neither does a NULL table name; a field that is
    only ever null has the type VOID.
    """
    spark = rows.sparkSession
    parsed = rows.select(F.col(table).alias("table_name"), F.try_parse_json(payload).alias("_v")).filter(
        F.col("table_name").isNotNull() & F.schema_of_variant("_v").startswith("OBJECT"))
    fields = parsed.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer())).select(
        "table_name", F.col("key").alias("column_name"), F.col("value"))
    text = F.when(F.schema_of_variant("value") == "STRING", F.length(F.try_variant_get("value", "$", "string")))
    merged = fields.groupBy("table_name", "column_name").agg(F.schema_of_variant_agg("value").alias("_k"), F.max(text).alias("_n"))
    return merged.select("table_name", "column_name", contract_type(F.col("_k"), F.coalesce("_n", F.lit(0))).alias("type"))


def in_scope(catalog: DataFrame) -> DataFrame:
    """Without system tables and names matching ``LIKE 'v_%'`` (``_`` stands for any one character)."""
    return catalog.filter(~F.col("table_name").isin(list(SYSTEM_TABLES)) & ~F.col("table_name").like("v_%"))


def spec_paths(rows: DataFrame, entity: str, payload: str, depth: int = 6) -> DataFrame:
    """``(entity, path, type)`` of all fields of the nested objects in ``payload``, merged over an entity's rows.

    A path joins field names with dots; a name that holds a dot or a backslash has a backslash before it.  Arrays count as
    values, and so do objects ``depth`` levels down.  Types are those of ``schema_of_variant_agg``; an empty object is one too.
    """
    spark = rows.sparkSession
    is_object = F.schema_of_variant("value").startswith("OBJECT") & (F.schema_of_variant("value") != "OBJECT<>")
    name = F.regexp_replace("key", r"([\\.])", r"\\$1")
    # Paths and types follow from a payload's own schema, so one payload of each schema is opened.
    parsed = rows.select(F.col(entity).alias("entity"), F.col(payload).alias("_text"), F.try_parse_json(payload).alias("value"))
    shapes = parsed.filter(is_object).select("entity", "_text", F.schema_of_variant("value").alias("_shape")).dropDuplicates(["entity", "_shape"])
    level = shapes.select("entity", F.lit("").alias("path"), F.try_parse_json("_text").alias("value"))
    for _ in range(depth):  # each step opens the objects and passes the other values on, so the rows are read once
        level = level.select("entity", "path", "value", F.when(is_object, F.col("value")).alias("_v"))
        inner = level.lateralJoin(spark.tvf.variant_explode_outer(F.col("_v").outer()).select("key", F.col("value").alias("_inner")))
        opened = F.col("_v").isNotNull()
        level = inner.select("entity", F.when(~opened, F.col("path")).when(F.col("path") == "", name).otherwise(F.concat_ws(".", "path", name)).alias("path"),
                             F.when(opened, F.col("_inner")).otherwise(F.col("value")).alias("value"))
    return level.groupBy("entity", "path").agg(F.schema_of_variant_agg("value").alias("type"))
