"""Ledger state, time travel, access filters, time-bounded links,
nested children, schema-checked ingest, usage, retention, sampling.

All are aggregates, semi/anti joins or equi joins with a range condition --
no windows over unbounded partitions, no cross joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.clock import epoch_micros
from strata.functions.nesting import chunked_collect

# Ledger operation that removes a key.
DELETE = "DELETE"
# Retention tiers as (label, upper bound in days, exclusive of
# the previous bound); the last tier has no upper bound.
RETENTION_TIERS = (("0-30d", 30), ("31-365d", 365), ("1-3y", 3 * 365), ("3-7y", 7 * 365),
                   ("7y+", None))


def current_state(ledger: DataFrame, key: str, seq: Sequence[str], op: str,
                  columns: Sequence[str], as_of: Column | None = None,
                  ts: str | None = None) -> DataFrame:
    """D1 (and D2 with ``as_of``): the last change per key, deleted keys dropped.

    ``max(struct(seq..., op, columns...))`` is a partial aggregate, so a key
    with a third of all changes costs one row per task before the shuffle.
    Of changes with equal ``seq`` a delete wins.
    """
    src = ledger if as_of is None else ledger.filter(F.col(ts or seq[0]) <= as_of)
    packed = F.struct(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(seq)],
                      F.col(op).eqNullSafe(F.lit(DELETE)).alias("_gone"), F.col(op).alias("_op"),
                      *[F.col(c) for c in columns])
    last = src.groupBy(key).agg(F.max(packed).alias("_r"))
    return (last.filter(~F.col("_r._gone"))
                .select(key, *[F.col(f"_r.{c}").alias(c) for c in columns]))


def row_access(rows: DataFrame, grants: DataFrame, rows_attr: str, grant_attr: str,
               principal: str = "principal") -> DataFrame:
    """Every (principal, row) a grant table allows -- an equi join of the
    rows with ``grants(principal, attribute)``; for one principal filter the
    grants first and it becomes a semi join."""
    g = grants.select(F.col(principal), F.col(grant_attr).alias("_attr")).distinct()
    return rows.join(g, rows[rows_attr] == g["_attr"], "inner").drop("_attr")


def rows_for(rows: DataFrame, grants: DataFrame, rows_attr: str, grant_attr: str,
             who, principal: str = "principal") -> DataFrame:
    """D4 for one principal: rows whose attribute the principal is granted."""
    g = grants.filter(F.col(principal) == F.lit(who)).select(F.col(grant_attr).alias("_a"))
    return rows.join(g, rows[rows_attr] == g["_a"], "left_semi")


def _time_bucket(c: Column, dtype: T.DataType, width) -> Column:
    """Bucket number of a time or number for the bucketed range join."""
    if isinstance(dtype, T.TimestampNTZType | T.TimestampType):
        # local times count wall-clock microseconds: monotonic across
        # daylight-saving gaps, unlike a conversion through the session zone
        return F.floor(epoch_micros(c, dtype) / F.lit(int(width * 1_000_000)))
    if isinstance(dtype, T.DateType):
        return F.floor(F.unix_date(c) / F.lit(width))
    return F.floor(c / F.lit(width))


def time_bounded_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                      at: str, valid_from: str, valid_to: str,
                      how: str = "inner", bucket=None) -> DataFrame:
    """Link valid between two times -- equi join + range condition,
    ``valid_from <= at < valid_to``.

    The equality key drives the (sort-merge or hash) join; the range is a
    join filter, so no pair outside the key is ever formed.  When one key
    has many rows on both sides (a hot key with many validity periods), all
    of its pairs would still be formed and filtered; ``bucket`` (seconds for
    timestamps, days for dates, units for numbers) adds a time bucket to the
    join key: each validity period is listed once per bucket it overlaps and
    each left row joins only the periods listed in its own bucket.  The result
    is the same; pairs formed per key drop from ``n x m`` to about the pairs
    that overlap in time.  Choose a width near the typical period length (a
    period is repeated ``length / bucket`` times).  Inner joins only.
    """
    if bucket is None:
        cond = ((left[left_key] == right[right_key]) & (left[at] >= right[valid_from])
                & (left[at] < right[valid_to]))
        return left.join(right, cond, how)
    if how != "inner":
        raise ValueError("the bucketed time-bounded join supports inner joins only")
    at_t = left.schema[at].dataType
    lo = _time_bucket(F.col(valid_from).cast(at_t), at_t, bucket)
    hi = _time_bucket(F.col(valid_to).cast(at_t), at_t, bucket)
    r = right.withColumn("_tb", F.explode(F.when(hi >= lo, F.sequence(lo, hi))))
    lb = left.withColumn("_tb", _time_bucket(F.col(at), at_t, bucket))
    cond = ((lb[left_key] == r[right_key]) & (lb["_tb"] == r["_tb"])
            & (lb[at] >= r[valid_from]) & (lb[at] < r[valid_to]))
    return lb.join(r, cond, "inner").drop(lb["_tb"]).drop(r["_tb"])


def nested_children(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
                    fields: Sequence[str], name: str = "children",
                    chunks: int = 1) -> DataFrame:
    """Children as ``ARRAY<STRUCT>`` on the parent row (left join, sorted).

    Every parent's children are dealt to ``chunks`` chunks by a hash of the
    child, one row per non-empty chunk (``<name>_chunk``); with one chunk each
    parent is one row.  Give more where a parent may hold a large share of the
    children, so that no task builds its whole array (see
    ``strata.functions.nesting``).  A parent without children keeps one row
    with an empty array.
    """
    kids = chunked_collect(child, child_key, fields, name, chunks)
    chunk = f"{name}_chunk"
    out = parent.join(kids, parent[parent_key] == kids[child_key], "left").drop(child_key)
    return (out.withColumn(name, F.coalesce(F.col(name), F.array().cast(
        T.ArrayType(kids.schema[name].dataType.elementType))))
        .withColumn(chunk, F.coalesce(F.col(chunk), F.lit(0))))


@dataclass
class Checked:
    good: DataFrame
    rejected: DataFrame


def _json_kind_ok(kind: Column, dtype: T.DataType) -> Column:
    """Whether a JSON value of variant type ``kind`` is of the declared type."""
    if isinstance(dtype, T.IntegralType):
        return kind == "BIGINT"
    if isinstance(dtype, T.NumericType):
        return kind.rlike(r"\A(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    if isinstance(dtype, T.BooleanType):
        return kind == "BOOLEAN"
    if isinstance(dtype, T.ArrayType):
        return kind.startswith("ARRAY")
    if isinstance(dtype, (T.StructType, T.MapType)):
        return kind.startswith("OBJECT")
    return kind == "STRING"


def schema_checked(df: DataFrame, column: str, schema: T.StructType) -> Checked:
    """Parse JSON text against a schema; non-conforming rows are rejected.

    A row conforms when it parses as a JSON object and every schema field is
    present with a value of the declared type: an integer field takes only whole
    JSON numbers in its range, a text field only JSON text, and so on
    (``from_json`` in FAILFAST would stop the job; here a bad row is routed, not
    fatal).
    """
    v = F.try_parse_json(F.col(column))
    checks = [v.isNotNull(), F.schema_of_variant(v).startswith("OBJECT")]
    for f in schema.fields:
        path = f"$['{f.name}']"
        checks.append(_json_kind_ok(F.schema_of_variant(F.try_variant_get(v, path, "variant")),
                                    f.dataType))
        checks.append(F.try_variant_get(v, path, f.dataType.simpleString()).isNotNull())
    ok = F.coalesce(checks[0], F.lit(False))
    for c in checks[1:]:
        ok = ok & F.coalesce(c, F.lit(False))
    parsed = df.withColumn("_ok", ok)
    good = parsed.filter("_ok").drop("_ok").withColumn(
        "parsed", F.from_json(F.col(column), schema))
    bad = parsed.filter(~F.col("_ok")).drop("_ok")
    return Checked(good, bad)


def unused(datasets: DataFrame, usage: DataFrame, key: str, usage_key: str, at: str,
           since: Column) -> DataFrame:
    """Datasets with no use since ``since`` (left anti join)."""
    recent = usage.filter(F.col(at) >= since).select(F.col(usage_key).alias("_k"))
    return datasets.join(recent, datasets[key] == recent["_k"], "left_anti")


def retention_tier(age_days: Column) -> Column:
    """Tier label for an age in days."""
    out = None
    for label, upper in RETENTION_TIERS:
        if upper is None:
            out = out.otherwise(F.lit(label))
        elif out is None:
            out = F.when(age_days <= upper, F.lit(label))
        else:
            out = out.when(age_days <= upper, F.lit(label))
    return out


def usage_parity(events: DataFrame, group: str, at: str, split: Column) -> DataFrame:
    """Per group, counts before and from ``split`` and their ratio.

    One aggregate with two conditional counts (the 'two aggregates joined'
    fused into one pass).
    """
    return events.groupBy(group).agg(
        F.count_if(F.col(at) < split).alias("historical"),
        F.count_if(F.col(at) >= split).alias("recent")).withColumn(
        "ratio", F.round(F.col("recent") / F.nullif(F.col("historical"), F.lit(0)), 4))


def hash_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """Deterministic sample -- rows whose md5(key) bucket is below
    ``percent`` of 100.  The same keys are picked on every run and on both
    sides of a comparison (unlike ``sample``), and no row count is needed."""
    bucket = F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10)
                    .cast("bigint"), F.lit(100))
    return df.filter(bucket < F.lit(int(percent)))
