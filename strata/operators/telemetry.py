"""Telemetry events, SLA flags and latest state.

The transform is a stateless projection, so the same function serves a batch
DataFrame (R3) and a streaming one (R1, see ``strata.streaming``).

The message is parsed once into a VARIANT (``try_parse_json``), which keeps
what plain ``from_json`` loses: whether ``delay_reason`` was absent (-> ``''``)
or an explicit JSON null (-> NULL), and whether ``package_id`` was text (a
numeric id fails the key hashing of the source pipeline and is dropped).
Bad JSON parses to NULL and is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.clock import hours_between

# Telemetry statuses and the breach flag texts.
STATUSES = ("IN_TRANSIT", "AT_HUB", "DELAYED", "DELIVERED")
BREACH_TRUE, BREACH_FALSE = "TRUE", "FALSE"
DELAYED, DELIVERED = "DELAYED", "DELIVERED"


def salted_key(package_id: Column, ts_text: Column) -> Column:
    """``<first 4 hex of md5(id)>#<id>#<timestamp>``: spreads one package's rows
    (and neighbouring ids) over the key space of a sorted store."""
    return F.concat_ws("#", F.substring(F.md5(package_id), 1, 4), package_id, ts_text)


def _truthy(t: Column, s: Column, d: Column, present: Column) -> Column:
    """JSON value that is present, not null, not '' / 0 / false / [] / {}.

    ``t`` is the value's variant type name, ``s`` its text, ``d`` its number.
    """
    numeric = t.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)")
    falsy = (((t == "STRING") & (s == ""))
             | ((t == "BOOLEAN") & (s == "false"))
             | (numeric & (d == 0))
             | t.isin("ARRAY<VOID>", "OBJECT<>", "VOID"))
    return present & ~F.coalesce(falsy, F.lit(False))


OUTPUT_COLUMNS = ("row_key", "package_id", "status", "sla_breach", "timestamp", "delay_reason")


def parse_telemetry(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON text (or bytes) -> ``row_key, package_id, status, sla_breach,
    timestamp, delay_reason``; messages missing an id or time are skipped.

    Each message is parsed once.  The keep / drop decision is made by a
    generator (``inline`` of a zero- or one-element array) rather than a
    filter: a filter would be pushed below the projections and Catalyst would
    substitute -- and so re-evaluate -- the parse in every predicate.
    """
    parsed = messages.select(F.try_parse_json(F.col(value).cast("string")).alias("_v"))
    fields = parsed.select(*[
        F.variant_get(F.col("_v"), f"$.{k}", "variant").alias(k)
        for k in ("package_id", "timestamp", "status", "delay_reason")])
    typed = fields.select(
        F.schema_of_variant("package_id").alias("pid_t"),
        F.try_variant_get("package_id", "$", "string").alias("pid_s"),
        F.try_variant_get("package_id", "$", "double").alias("pid_d"),
        F.schema_of_variant("timestamp").alias("ts_t"),
        F.try_variant_get("timestamp", "$", "string").alias("ts_s"),
        F.try_variant_get("timestamp", "$", "double").alias("ts_d"),
        # any scalar status is kept as its text (the source keeps the value)
        F.try_variant_get("status", "$", "string").alias("status_s"),
        F.col("delay_reason").isNull().alias("reason_absent"),
        F.is_variant_null("delay_reason").alias("reason_null"),
        F.try_variant_get("delay_reason", "$", "string").alias("reason_s"))
    pid_t, pid_s, ts_s = F.col("pid_t"), F.col("pid_s"), F.col("ts_s")
    keep = ((pid_t == "STRING")
            & _truthy(pid_t, pid_s, F.col("pid_d"), pid_s.isNotNull())
            & _truthy(F.col("ts_t"), ts_s, F.col("ts_d"), F.col("ts_t").isNotNull()))
    reason = (F.when(F.col("reason_absent"), F.lit(""))
              .when(F.col("reason_null"), F.lit(None).cast("string"))
              .otherwise(F.col("reason_s")))
    row = F.struct(salted_key(pid_s, ts_s).alias("row_key"), pid_s.alias("package_id"),
                   F.col("status_s").alias("status"), sla_flag(F.col("status_s")).alias(
                       "sla_breach"), ts_s.alias("timestamp"), reason.alias("delay_reason"))
    rows = F.when(F.coalesce(keep, F.lit(False)), F.array(row)).otherwise(
        F.array().cast(T.ArrayType(row_type())))
    return typed.select(F.inline(rows))


def row_type() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in OUTPUT_COLUMNS])


def sla_flag(status: Column) -> Column:
    """``'TRUE'`` iff the status is DELAYED (NULL status -> ``'FALSE'``)."""
    return F.when(status.eqNullSafe(F.lit(DELAYED)), F.lit(BREACH_TRUE)).otherwise(
        F.lit(BREACH_FALSE))


def latest_state(events: DataFrame, key: str, order: list[str],
                 columns: list[str]) -> DataFrame:
    """Newest row per key by ``order`` (later columns break ties).

    ``max(struct(order..., columns...))`` is a partial aggregate: each task keeps
    one candidate per key before the shuffle, so a package holding a third of
    all events costs one row of shuffle per task, not a third of the data in
    one sort (as ``row_number`` over a window would).
    """
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in columns])
    return (events.groupBy(key).agg(F.max(packed).alias("_s"))
                  .select(key, *[F.col(f"_s.{c}").alias(c) for c in columns]))


def breaches(df: DataFrame) -> DataFrame:
    """Rows flagged as SLA breaches."""
    return df.filter(F.col("sla_breach") == BREACH_TRUE)


def active(df: DataFrame) -> DataFrame:
    """Rows not yet delivered."""
    return df.filter(~F.col("status").eqNullSafe(F.lit(DELIVERED)))


def sla_kpis(df: DataFrame) -> DataFrame:
    """A10: active = status != DELIVERED; breaches = flagged rows."""
    return df.agg(
        F.count_if(~F.col("status").eqNullSafe(F.lit(DELIVERED))).alias("active"),
        F.count_if(F.col("sla_breach") == BREACH_TRUE).alias("breaches"))


def delayed_longer_than(events: DataFrame, key: str, ts: str, status: str,
                        hours: float = 2.0, as_of: Column | None = None,
                        tie: str | None = None) -> DataFrame:
    """D3: packages whose current status is DELAYED and that have been delayed,
    without a non-DELAYED event in between, for more than ``hours`` as of
    ``as_of`` (default: the newest event time of the whole input).

    Two aggregate passes, no window: (1) per package the current status, the
    last non-DELAYED time; (2) the first DELAYED time after it, over the
    events joined to the (unique-key) result of (1).
    """
    order = [F.col(ts)] + ([F.col(tie)] if tie else [])
    cur = F.max_by(F.col(status), F.struct(*order))
    per = events.groupBy(key).agg(
        cur.alias("current_status"),
        F.max(F.when(~F.col(status).eqNullSafe(F.lit(DELAYED)), F.col(ts))).alias("last_ok"),
        F.max(F.col(ts)).alias("latest"))
    open_delays = per.filter(F.col("current_status") == DELAYED)
    since = (events.filter(F.col(status) == DELAYED)
             .join(open_delays.select(key, "last_ok"), key)
             .filter(F.col("last_ok").isNull() | (F.col(ts) > F.col("last_ok")))
             .groupBy(key).agg(F.min(ts).alias("delayed_since")))
    out = since.join(open_delays.select(key, "latest"), key)
    ts_type = events.schema[ts].dataType
    ref = (as_of if as_of is not None else events.agg(F.max(ts).alias("_m")).scalar()
           ).cast(ts_type)
    # local times: wall-clock hours; instants: elapsed hours -- either way
    # independent of the session time zone
    hours_delayed = hours_between(F.col("delayed_since"), ref, ts_type)
    return out.select(key, "delayed_since", F.round(hours_delayed, 4).alias("hours_delayed")
                      ).filter(F.col("hours_delayed") > F.lit(hours))
