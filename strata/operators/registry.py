"""K9: raw-spec registry and change log as keyed, hash-addressed tables.

Raw texts are addressed by ``sha2(text, 256)`` so identical uploads collapse;
change rows are keyed by ``md5(entity-change-diff)`` so repeating the same
change is idempotent.  Both are merged with the keyed upsert (K1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.upsert import upsert


def read_specs(spark: SparkSession, path_glob: str) -> DataFrame:
    """Whole files as one text value each: ``(path, text)``."""
    return spark.read.text(path_glob, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def raw_registry(texts: DataFrame, text: str = "text", ident: str = "path") -> DataFrame:
    """One row per distinct text: hash, first identifier, number of copies.

    The hash covers the whole text; the grouping is on the 64-character hash,
    with partial aggregation, so a text copied a million times shuffles one
    row per task.
    """
    return (texts.select(F.sha2(F.col(text), 256).alias("text_hash"), F.col(ident), F.col(text))
            .groupBy("text_hash")
            .agg(F.min(ident).alias(f"first_{ident}"), F.count(F.lit(1)).alias("n_copies"),
                 F.min_by(F.col(text), F.col(ident)).alias("text")))


def register(registry: DataFrame | None, texts: DataFrame, text: str = "text",
             ident: str = "path") -> DataFrame:
    """Merge new texts into the registry keyed by ``text_hash``.

    A known text keeps its first identifier and text; its copies are added up.
    """
    new = raw_registry(texts, text, ident)
    if registry is None:
        return new
    more = new.select("text_hash", F.col("n_copies").alias("_more"))
    known = registry.join(more, "text_hash", "left").withColumn(
        "n_copies", F.col("n_copies") + F.coalesce("_more", F.lit(0))).select(*registry.columns)
    fresh = new.join(registry.select("text_hash"), "text_hash", "left_anti")
    return known.unionByName(fresh.select(*registry.columns))


def change_id(entity, change, diff_json):
    return F.md5(F.concat_ws("-", entity, change, diff_json))


def log_changes(log: DataFrame | None, changes: DataFrame) -> DataFrame:
    """Append change rows ``(entity, change, diff)`` keyed by their md5 id."""
    rows = changes.withColumn("change_id", change_id(F.col("entity"), F.col("change"),
                                                     F.col("diff")))
    if log is None:
        return rows.dropDuplicates(["change_id"])
    return upsert(log, rows, "change_id", mode="non_empty")


# The spec kind that describes a table, and the state of a registered one.
OBJECT_KIND, ACTIVE = "ObjectType", "ACTIVE"
ADDED, REMOVED, RETYPED = "ADDED", "REMOVED", "RETYPED"


def canonical_objects(specs: DataFrame, text: str = "text", order: str = "path") -> DataFrame:
    """``(object_type_id, text_hash, name, table_name, primary_key_field, attributes, status)`` of the object specs.

    ``specs`` holds JSON texts.  Texts that do not parse, are of another kind or have no name are left out; of specs
    with one name the one with the greatest ``order`` counts.  ``attributes`` is the JSON text of the properties.
    """
    v = F.try_parse_json(text)
    at = lambda path: F.try_variant_get(v, path, "string")
    rows = specs.select(
        at("$.metadata.name").alias("object_type_id"), F.sha2(F.col(text), 256).alias("text_hash"), at("$.metadata.name").alias("name"),
        at("$.spec.tableName").alias("table_name"), at("$.spec.primaryKey").alias("primary_key_field"),
        F.get_json_object(text, "$.spec.properties").alias("attributes"), F.lit(ACTIVE).alias("status"),
        F.coalesce(at("$.metadata.kind"), at("$.kind")).alias("_kind"), F.col(order).alias("_order"))
    rows = rows.filter((F.col("_kind") == OBJECT_KIND) & F.col("name").isNotNull()).drop("_kind")
    others = [c for c in rows.columns if c not in ("object_type_id", "_order")]
    return rows.groupBy("object_type_id").agg(F.max_by(F.struct(*others), F.struct("_order", "text_hash")).alias("_r")).select("object_type_id", "_r.*")


def register_objects(objects: DataFrame | None, specs: DataFrame, text: str = "text", order: str = "path") -> DataFrame:
    """K9: the canonical objects with those of ``specs`` merged in by name (K2)."""
    new = canonical_objects(specs, text, order)
    return new if objects is None else upsert(objects, new, "object_type_id", mode="replace")


def declared_types(objects: DataFrame, depth: int = 4) -> DataFrame:
    """``(entity, path, type)`` of the canonical objects' properties: the ``type`` each declares, and those of
    properties nested in it (under its own ``properties``) down to ``depth``, paths joined with dots."""
    spark = objects.sparkSession
    level = objects.select(F.col("object_type_id").alias("entity"), F.lit("").alias("path"), F.try_parse_json("attributes").alias("_v"))
    out = None
    for _ in range(depth):
        level = level.filter(F.schema_of_variant("_v").startswith("OBJECT<") & (F.schema_of_variant("_v") != "OBJECT<>"))
        level = level.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer())).select(
            "entity", F.when(F.col("path") == "", F.col("key")).otherwise(F.concat_ws(".", "path", "key")).alias("path"), "value")
        rows = level.select("entity", "path", F.try_variant_get("value", "$.type", "string").alias("type"))
        out = rows if out is None else out.unionByName(rows)
        level = level.select("entity", "path", F.try_variant_get("value", "$.properties", "variant").alias("_v"))
    return out


def path_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(entity, path, change, old_type, new_type)``: the paths that differ, of entities that ``new`` has.

    Both sides are ``(entity, path, type)`` with one row a path.  A missing type differs from any other.
    """
    o = old.select("entity", "path", F.col("type").alias("old_type"), F.lit(True).alias("_o")).join(
        new.select("entity").distinct(), "entity", "left_semi")
    n = new.select("entity", "path", F.col("type").alias("new_type"), F.lit(True).alias("_n"))
    change = (F.when(F.col("_o").isNull(), F.lit(ADDED)).when(F.col("_n").isNull(), F.lit(REMOVED))
              .when(~F.col("old_type").eqNullSafe(F.col("new_type")), F.lit(RETYPED)))
    return (o.join(n, ["entity", "path"], "full_outer").select("entity", "path", change.alias("change"), "old_type", "new_type")
            .filter("change is not null"))


def schema_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(entity, change, diff)``: one row for each entity of ``new``, to be logged with ``log_changes``.

    A path removed or retyped is BREAKING, else one added COMPATIBLE, else (nothing, or an entity that ``old`` lacks)
    ADDITIVE.  ``diff`` is JSON text with the sorted paths, so equal changes have equal texts.
    """
    known = old.select("entity").distinct().withColumn("_known", F.lit(True))
    entities = new.select("entity").distinct().join(known, "entity", "left")
    of = lambda kind, value: F.array_sort(F.collect_list(F.when(F.col("change") == kind, value)))
    retyped = F.struct(F.col("path").alias("property"), F.coalesce("old_type", F.lit("")).alias("from"), F.coalesce("new_type", F.lit("")).alias("to"))
    lists = path_changes(old, new).groupBy("entity").agg(  # the paths of one entity's spec
        of(ADDED, F.col("path")).alias("added_properties"), of(REMOVED, F.col("path")).alias("removed_properties"),
        of(RETYPED, retyped).alias("type_changes"))
    parts = ["added_properties", "removed_properties", "type_changes"]
    empty = {p: F.array().cast(lists.schema[p].dataType) for p in parts}
    j = entities.join(lists, "entity", "left").select("entity", "_known", *[F.coalesce(F.col(p), empty[p]).alias(p) for p in parts])
    kind = (F.when(F.col("_known").isNull(), F.lit("ADDITIVE"))
            .when((F.size("removed_properties") > 0) | (F.size("type_changes") > 0), F.lit("BREAKING"))
            .when(F.size("added_properties") > 0, F.lit("COMPATIBLE")).otherwise(F.lit("ADDITIVE")))
    diff = F.when(F.col("_known").isNull(), F.to_json(F.struct(F.lit("New entity type added").alias("info")))).otherwise(F.to_json(F.struct(*parts)))
    return j.select("entity", kind.alias("change"), diff.alias("diff"))
