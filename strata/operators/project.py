"""Projections -- coercion, views, lookups, contracts, JSON, masking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.numbers import NUMBER
from strata.ontology import ObjectType, spark_type, string_length


def coerce_loose(c: Column) -> Column:
    """The writer's value-based typing of one text value, as a struct.

    ``''`` -> dropped (all NULL); all digits -> ``as_long`` (leading zeros
    lost); a decimal number with ``.`` -> ``as_double``, else kept as text; anything
    else (negative whole numbers, ``1.5f``, more than 38 digits) stays text.  A Spark column has one
    type, so the typed value is spread over three typed fields plus ``kind``.
    """
    s = c.cast("string")
    as_long = F.when(s.rlike(r"\A[0-9]+\z"), s.try_cast("decimal(38,0)"))
    digits = as_long.isNotNull()
    dbl = F.when(s.rlike(NUMBER), s.try_cast("double"))
    is_float = ~digits & s.contains(".") & dbl.isNotNull()
    kind = (F.when(s.isNull() | (s == ""), F.lit(None))
            .when(digits, F.lit("int")).when(is_float, F.lit("float")).otherwise(F.lit("str")))
    return F.struct(kind.alias("kind"), as_long.alias("as_long"),
                    F.when(is_float, dbl).alias("as_double"),
                    F.when(kind == "str", s).alias("as_text"))


def view_of(df: DataFrame, obj: ObjectType, spark: SparkSession | None = None,
            register: bool = True) -> DataFrame:
    """P5: ``v_<table>`` with exactly the contract's columns (missing -> NULL)."""
    cols = [F.col(a.name) if a.name in df.columns else F.lit(None).cast(
        spark_type(a.type)).alias(a.name) for a in obj.attributes]
    v = df.select(*cols)
    if register:
        v.createOrReplaceTempView(f"v_{obj.table}")
    return v


def edge_view(df: DataFrame, key: str, source: str, target: str,
              props: Sequence[str]) -> DataFrame:
    """P5 for edges: key, source, target + properties, duplicates removed in order."""
    seen: list[str] = []
    for c in [key, source, target, *props]:
        if c not in seen:
            seen.append(c)
    return df.select(*seen)


def get_object(df: DataFrame, key: str, value) -> DataFrame:
    """One object by primary key (filter pushed to the scan, first match)."""
    return df.filter(F.col(key) == F.lit(value)).limit(1)


def get_object_by_type(spark: SparkSession, object_type: str, value,
                       key: str = "id") -> DataFrame:
    """P6 by name: the object of ``object_type`` with primary key ``value``,
    read from the catalog table named by the lower-cased type (first match)."""
    return get_object(spark.table(object_type.lower()), key, value)


def get_objects(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """P6 batch form: every object whose key is in ``keys`` (left-semi join)."""
    return df.join(keys, df[key] == keys[keys.columns[0]], "left_semi")


@dataclass
class Conformed:
    good: DataFrame
    bad: DataFrame


def conform(df: DataFrame, obj: ObjectType) -> Conformed:
    """Project + cast to the contract; split rows violating it.

    Violations: required column NULL (or not castable), an optional value that
    does not cast, ``STRING(n)`` longer than n.  Bad rows carry ``violations ARRAY<STRING>``.
    """
    cols, checks = [], []
    for a in obj.attributes:
        raw = F.col(a.name) if a.name in df.columns else F.lit(None)
        typed = raw.cast("string").try_cast(spark_type(a.type)) if not isinstance(
            spark_type(a.type), T.StringType) else raw.cast("string")
        cols.append(typed.alias(a.name))
        if a.required:
            checks.append(F.when(typed.isNull(), F.lit(f"{a.name}: required")))
        else:
            checks.append(F.when(raw.isNotNull() & typed.isNull(),
                                 F.lit(f"{a.name}: not {a.type}")))
        n = string_length(a.type.upper().replace(" ", "")) if a.type else None
        if n is not None:
            checks.append(F.when(F.length(typed) > n, F.lit(f"{a.name}: longer than {n}")))
    viol = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast(
        "array<string>")
    t = df.select(*cols, viol.alias("violations"))
    return Conformed(t.filter(F.size("violations") == 0).drop("violations"),
                     t.filter(F.size("violations") > 0))


def props_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """P10: columns as one JSON object text, NULLs kept, dates and times as
    ISO text (``T`` between them, six digits of a second's fraction or none), decimals as floating numbers."""
    types = {f.name: f.dataType for f in df.schema.fields}
    fields = []
    for c in columns:
        v = F.col(c)
        if isinstance(types[c], T.DecimalType):
            v = v.cast("double")
        elif isinstance(types[c], (T.DateType, T.TimestampType, T.TimestampNTZType)):
            v = F.replace(v.cast("string"), F.lit(" "), F.lit("T"))
            v = F.when(v.contains("."), F.rpad(v, 26, "0")).otherwise(v)
        fields.append(v.alias(c))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


# The payroll tag path of the column-tagging example.
TAG_PATH = ("Confidential", "Finance", "Payroll")


def tag_columns(df: DataFrame, tags: Mapping[str, str]) -> tuple[DataFrame, bool]:
    """Attach ``{"policy_tag": tag}`` metadata to listed columns only.

    Returns the frame and whether any column's tag changed.  Metadata rides on
    the schema and survives plain projections (D5).
    """
    changed = False
    out = df
    for f in df.schema.fields:
        if f.name in tags:
            if (f.metadata or {}).get("policy_tag") != tags[f.name]:
                changed = True
            out = out.withMetadata(f.name, {**(f.metadata or {}), "policy_tag": tags[f.name]})
    return out, changed


def mask(df: DataFrame, allowed_tags: Sequence[str] = (), how: str = "null") -> DataFrame:
    """P11 enforcement: tagged columns whose tag is not allowed are masked.

    ``how='null'`` -> NULL of the same type; ``'hash'`` -> sha2 of the text.
    """
    out = []
    for f in df.schema.fields:
        tag = (f.metadata or {}).get("policy_tag")
        if tag is not None and tag not in allowed_tags:
            v = (F.sha2(F.col(f.name).cast("string"), 256) if how == "hash"
                 else F.lit(None).cast(f.dataType))
            out.append(v.alias(f.name, metadata=f.metadata))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def retag_like(df: DataFrame, derived: str, source: str) -> DataFrame:
    """Give a derived column (built by an expression) its source's tag."""
    md = next(f.metadata for f in df.schema.fields if f.name == source) or {}
    if "policy_tag" not in md:
        return df
    return df.withMetadata(derived, {"policy_tag": md["policy_tag"]})
