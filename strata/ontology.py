"""Ontology contracts: object types, attributes, rules, relationships.

Contracts are small driver-side configuration (a few dozen entries per
object); the data they describe lives in DataFrames.  ``catalog_frame``
turns any number of contracts into a ``(table_name, column_name, type)``
DataFrame so contract checks run as joins, however large the estate.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.operators.rules import Rule

# The widest string length, used when comparing STRING(MAX).
STRING_MAX_LENGTH = 999999999
DEFAULT_TYPE = "STRING(MAX)"
DEFAULT_STORAGE = "managed_by_platform"


@dataclass(frozen=True)
class Attribute:
    name: str
    type: str = DEFAULT_TYPE
    required: bool = False


@dataclass(frozen=True)
class Relationship:
    name: str
    edge: str
    target: str
    cardinality: str
    local_key: str
    target_key: str


@dataclass(frozen=True)
class ObjectType:
    name: str
    table: str
    primary_key: str
    attributes: tuple[Attribute, ...]
    rules: tuple[Rule, ...] = ()
    relationships: tuple[Relationship, ...] = ()
    storage: str = DEFAULT_STORAGE

    @property
    def columns(self) -> list[str]:
        return [a.name for a in self.attributes]

    def attribute(self, name: str) -> Attribute | None:
        return next((a for a in self.attributes if a.name == name), None)


def normalize_type(type_text: str | None) -> str:
    """Upper case without spaces; missing -> STRING(MAX)."""
    if not type_text:
        return DEFAULT_TYPE
    return str(type_text).upper().replace(" ", "")


def string_length(type_text: str) -> int | None:
    """Declared length of ``STRING(n)`` (MAX -> the widest), else None."""
    m = re.match(r"STRING\((.+)\)", type_text)
    if not m:
        return None
    return STRING_MAX_LENGTH if m.group(1) == "MAX" else int(m.group(1))


def spark_type(type_text: str | None) -> T.DataType:
    """Contract type name -> Spark type; unknown names fall back to string."""
    t = normalize_type(type_text)
    if t in ("INT64", "INTEGER", "LONG", "INT", "BIGINT"):
        return T.LongType()
    if t in ("FLOAT64", "DOUBLE", "FLOAT"):
        return T.DoubleType()
    if t.startswith("NUMERIC") or t.startswith("DECIMAL"):
        return T.DecimalType(38, 9)
    if t in ("BOOLEAN", "BOOL"):
        return T.BooleanType()
    if t == "DATE":
        return T.DateType()
    if t == "TIMESTAMP":
        return T.TimestampType()
    return T.StringType()  # STRING(n), JSON, and anything unknown


def to_struct(obj: ObjectType) -> T.StructType:
    return T.StructType([T.StructField(a.name, spark_type(a.type), not a.required)
                         for a in obj.attributes])


def from_spec(spec: Mapping) -> ObjectType:
    """Accept either spec shape and normalise it.

    ``attributes`` list or ``properties`` mapping; ``table`` or ``tableName``;
    a list primary key keeps its first element; missing storage gets the
    default.
    """
    meta = spec.get("metadata", {}) or {}
    body = spec.get("spec", spec)
    if "attributes" in body:
        attrs = tuple(Attribute(a["name"], a.get("type", DEFAULT_TYPE), bool(a.get("required")))
                      for a in body["attributes"])
    else:
        attrs = tuple(Attribute(k, (v or {}).get("type", DEFAULT_TYPE),
                                bool((v or {}).get("required")))
                      for k, v in (body.get("properties") or {}).items())
    pk = body.get("primaryKey")
    if isinstance(pk, (list, tuple)):
        pk = pk[0] if pk else None
    rels = tuple(Relationship(r["name"], r.get("edge", ""), r.get("target", ""),
                              r.get("cardinality", ""), r["via"]["localKey"],
                              r["via"]["targetKey"])
                 for r in body.get("relationships", []) or [])
    rules = tuple(Rule.of(r) for r in body.get("rules", []) or [])
    return ObjectType(meta.get("name", body.get("name", "")),
                      body.get("tableName", body.get("table", "")), pk, attrs, rules, rels,
                      body.get("storage", DEFAULT_STORAGE))


def catalog_frame(spark: SparkSession, objects: Iterable[ObjectType]) -> DataFrame:
    """``(table_name, column_name, type)`` rows for the given contracts."""
    rows = [(o.table, a.name, a.type) for o in objects for a in o.attributes]
    return spark.createDataFrame(rows, "table_name string, column_name string, type string")


def _s(n=100):
    return f"STRING({n})"


# The four routing object types (columns, keys, rules, links).
LOCATION = ObjectType(
    "Location", "location", "location_cd",
    (Attribute("location_cd", _s(), True), Attribute("owner", _s()),
     Attribute("country", _s(200)), Attribute("source", _s(300))),
    (Rule("LOC-001", "location_cd IS NOT NULL AND location_cd != ''", "location_cd", "reject"),
     Rule("LOC-002", "country IS NULL OR LENGTH(country) <= 3", "country", "warn")))

ROUTE = ObjectType(
    "Route", "route", "route_id_txt",
    (Attribute("route_id_txt", _s(), True), Attribute("source_cd", _s()),
     Attribute("valid_routing_path", "STRING(MAX)"), Attribute("ursa_prefix_cd", _s())),
    (Rule("RT-001", "route_id_txt IS NOT NULL AND route_id_txt != ''", "route_id_txt", "reject"),
     Rule("RT-002", "source_cd IS NULL OR LENGTH(source_cd) <= 100", "source_cd", "warn")),
    (Relationship("has_transit_connections", "HAS_TRANSIT", "TransitConnection",
                  "one_to_many", "route_id_txt", "route_id_txt"),
     Relationship("has_waypoints", "HAS_WAYPOINT", "Waypoint", "one_to_many",
                  "route_id_txt", "route_id_txt")))

TRANSIT_CONNECTION = ObjectType(
    "TransitConnection", "transit_connection", "transit_id",
    tuple(Attribute(n, _s(), n in ("transit_id", "route_id_txt", "leg_no",
                                   "depart_location_cd", "arrive_location_cd"))
          for n in ("transit_id", "route_id_txt", "leg_no", "mode", "carrier", "depart_ts",
                    "depart_operation", "arrive_ts", "arrive_operation",
                    "depart_location_cd", "arrive_location_cd")),
    (Rule("TC-001", "depart_location_cd != arrive_location_cd", "depart_location_cd", "reject"),
     Rule("TC-002", "mode IS NULL OR mode IN ('AIR', 'GROUND', 'SEA', 'RAIL')", "mode", "warn"),
     Rule("TC-003", "leg_no IS NOT NULL AND leg_no != ''", "leg_no", "reject")),
    (Relationship("belongs_to_route", "BELONGS_TO", "Route", "many_to_one",
                  "route_id_txt", "route_id_txt"),
     Relationship("departs_from", "DEPARTS_FROM", "Location", "many_to_one",
                  "depart_location_cd", "location_cd"),
     Relationship("arrives_at", "ARRIVES_AT", "Location", "many_to_one",
                  "arrive_location_cd", "location_cd")))

WAYPOINT = ObjectType(
    "Waypoint", "waypoint", "waypoint_id",
    tuple(Attribute(n, _s(), n in ("waypoint_id", "route_id_txt", "leg_no", "sequence_no",
                                   "location_cd", "transit_id"))
          for n in ("waypoint_id", "route_id_txt", "leg_no", "sequence_no", "location_cd",
                    "operation", "begin_ts", "week_day", "days_offset", "handling_unit",
                    "transit_id")),
    (Rule("WP-001", "sequence_no IS NOT NULL AND sequence_no != ''", "sequence_no", "reject"),
     Rule("WP-002", "week_day IS NULL OR week_day IN ('MON', 'TUE', 'WED', 'THU', 'FRI', "
                    "'SAT', 'SUN')", "week_day", "warn"),
     Rule("WP-003", "days_offset IS NULL OR REGEXP_CONTAINS(days_offset, r'^-?[0-9]+$')",
          "days_offset", "warn")),
    (Relationship("belongs_to_route", "BELONGS_TO", "Route", "many_to_one",
                  "route_id_txt", "route_id_txt"),
     Relationship("at_location", "AT_LOCATION", "Location", "many_to_one",
                  "location_cd", "location_cd"),
     Relationship("part_of_transit", "PART_OF_TRANSIT", "TransitConnection", "many_to_one",
                  "transit_id", "transit_id")))

OBJECT_TYPES = {o.table: o for o in (LOCATION, ROUTE, TRANSIT_CONNECTION, WAYPOINT)}


def rules_by_table(objects: Iterable[ObjectType] = OBJECT_TYPES.values()) -> dict:
    return {o.table: list(o.rules) for o in objects}


@dataclass
class Ontology:
    objects: dict[str, ObjectType] = field(default_factory=lambda: dict(OBJECT_TYPES))

    def by_name(self, name: str) -> ObjectType:
        return next(o for o in self.objects.values() if o.name == name)
