"""Plans for the telemetry stream operators.

The driver's ``events`` table stands in for package telemetry: ``user_id`` is
the package, ``event_type`` maps to a status (error = DELAYED, purchase =
DELIVERED, view = AT_HUB, others IN_TRANSIT).  Messages are built as JSON
text from every event so the real parser runs on them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.clock import epoch_micros
from strata.operators.telemetry import (
    active, delayed_longer_than, latest_state, parse_telemetry, sla_kpis)
from strata.plans.registry import ORACLE, plan
from strata.session import scratch_path
from strata.sinks.writes import incremental_rows
from strata.sources.tables import Tables
from strata.streaming.delays import current_delay_state, delayed_packages, run_delay_state
from strata.streaming.telemetry import current_latest, current_store, read_messages, run_latest, run_to_store

# Event type -> telemetry status for the driver's events table.
STATUS_OF = {"error": "DELAYED", "purchase": "DELIVERED", "view": "AT_HUB"}
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

_STATUS_SQL = ("CASE event_type WHEN 'error' THEN 'DELAYED' WHEN 'purchase' THEN 'DELIVERED' "
               "WHEN 'view' THEN 'AT_HUB' ELSE 'IN_TRANSIT' END")


def _status(c):
    out = F.lit("IN_TRANSIT")
    for k, v in reversed(list(STATUS_OF.items())):
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def event_messages(events: DataFrame) -> DataFrame:
    """One JSON message per event.  Errors carry a delay reason, purchases an
    explicit ``null`` reason, other events none at all."""
    base = F.struct(
        F.concat(F.lit("PKG-"), F.col("user_id").cast("string")).alias("package_id"),
        F.date_format("ts", TS_FORMAT).alias("timestamp"),
        _status(F.col("event_type")).alias("status"))
    reason = F.concat(F.lit("CODE-"), F.get_json_object("props", "$.k"))
    with_reason = F.struct(base["package_id"].alias("package_id"),
                           base["timestamp"].alias("timestamp"),
                           base["status"].alias("status"), reason.alias("delay_reason"))
    null_reason = F.struct(base["package_id"].alias("package_id"),
                           base["timestamp"].alias("timestamp"),
                           base["status"].alias("status"),
                           F.lit(None).cast("string").alias("delay_reason"))
    msg = (F.when(F.col("event_type") == "error", F.to_json(with_reason))
           .when(F.col("event_type") == "purchase",
                 F.to_json(null_reason, {"ignoreNullFields": "false"}))
           .otherwise(F.to_json(base)))
    return events.select(msg.alias("value"))


_MSG_CTE = f"""
WITH m AS (
  SELECT 'PKG-' || CAST(user_id AS VARCHAR) AS package_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_text,
         {_STATUS_SQL} AS status,
         CASE WHEN event_type = 'error' THEN 'CODE-' || CAST(json_extract(props, '$.k') AS VARCHAR)
              WHEN event_type = 'purchase' THEN NULL ELSE '' END AS delay_reason
  FROM events)
"""


@plan("telemetry", _MSG_CTE + """
SELECT concat_ws('#', substr(md5(package_id), 1, 4), package_id, ts_text) AS row_key,
       package_id, status,
       CASE WHEN status = 'DELAYED' THEN 'TRUE' ELSE 'FALSE' END AS sla_breach,
       ts_text AS timestamp, delay_reason
FROM m
""")
def telemetry(spark, sf_dir):
    return parse_telemetry(event_messages(Tables(spark, sf_dir).events))


@plan("latest_state", """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""")
def latest_state_plan(spark, sf_dir):
    return latest_state(Tables(spark, sf_dir).events, "user_id", ["ts", "event_id"],
                        ["event_id", "event_type"])


@plan("sla_kpis", """
SELECT count(*) FILTER (WHERE event_type <> 'purchase') AS active,
       count(*) FILTER (WHERE event_type = 'error') AS breaches FROM events
""")
def sla_kpis_plan(spark, sf_dir):
    return sla_kpis(telemetry(spark, sf_dir))


@plan("active_packages", f"""
SELECT user_id, {_STATUS_SQL} AS status FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1 AND event_type <> 'purchase'
""")
def active_packages(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.withColumn("status", _status(F.col("event_type")))
    return active(latest_state(ev, "user_id", ["ts", "event_id"], ["status"]))


@plan("delayed_over_2h", f"""
WITH e AS (SELECT user_id, ts, event_id, {_STATUS_SQL} AS status FROM events),
per AS (SELECT user_id, arg_max(status, (ts, event_id)) AS cur,
               max(ts) FILTER (WHERE status <> 'DELAYED') AS last_ok FROM e GROUP BY user_id),
since AS (SELECT e.user_id, min(e.ts) AS delayed_since FROM e JOIN per USING (user_id)
          WHERE per.cur = 'DELAYED' AND e.status = 'DELAYED'
            AND (per.last_ok IS NULL OR e.ts > per.last_ok) GROUP BY e.user_id)
SELECT user_id, delayed_since,
       round((epoch_us((SELECT max(ts) FROM events)) - epoch_us(delayed_since)) / 3.6e9, 4)
         AS hours_delayed
FROM since
WHERE round((epoch_us((SELECT max(ts) FROM events)) - epoch_us(delayed_since)) / 3.6e9, 4) > 2
""")
def delayed_over_2h(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.withColumn("status", _status(F.col("event_type")))
    return delayed_longer_than(ev, "user_id", "ts", "status", 2.0, tie="event_id")


@plan("incremental_append", """
SELECT event_id FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')
""")
def incremental_append_plan(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    # The target already holds everything before the cut-off.
    target = ev.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return incremental_rows(ev, target, "ts").select("event_id")


def _message_stream(spark, sf_dir, root: str) -> DataFrame:
    """The events' messages as a stream of several micro-batches, each with messages of all times."""
    event_messages(Tables(spark, sf_dir).events).repartition(8).write.text(f"{root}/in")
    return parse_telemetry(read_messages(spark, f"{root}/in", max_files_per_trigger=3))


@plan("stream_store", ORACLE["telemetry"].replace("FROM m", "FROM (SELECT DISTINCT * FROM m)"))
def stream_store(spark, sf_dir):
    """R2: the keyed store after the stream has run: one row a key, whatever the order of the messages."""
    root = scratch_path(spark, f"stream-store-{uuid.uuid4().hex}")
    run_to_store(_message_stream(spark, sf_dir, root), f"{root}/store", f"{root}/checkpoint").awaitTermination()
    return current_store(spark, f"{root}/store")


@plan("stream_latest", f"""
SELECT 'PKG-' || CAST(user_id AS VARCHAR) AS package_id, status, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp FROM (
  SELECT user_id, {_STATUS_SQL} AS status, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, {_STATUS_SQL} DESC) AS rn
  FROM events) WHERE rn = 1
""")
def stream_latest(spark, sf_dir):
    """W1 on the stream: an update-mode aggregate, its changes merged by package."""
    root = scratch_path(spark, f"stream-latest-{uuid.uuid4().hex}")
    run_latest(_message_stream(spark, sf_dir, root), f"{root}/latest", f"{root}/checkpoint").awaitTermination()
    return current_latest(spark, f"{root}/latest").select("package_id", "status", "timestamp")


@plan("stream_delays", ORACLE["delayed_over_2h"].replace("SELECT user_id, delayed_since,", "SELECT 'PKG-' || CAST(user_id AS VARCHAR) AS package_id, delayed_since,"))
def stream_delays(spark, sf_dir):
    """D3 on the stream, from Spark's keyed state; events may be late by as much as the table spans."""
    root = scratch_path(spark, f"stream-delays-{uuid.uuid4().hex}")
    run_delay_state(_message_stream(spark, sf_dir, root), f"{root}/delays", f"{root}/checkpoint", delay="10000 days").awaitTermination()
    events = Tables(spark, sf_dir).events
    # the messages' times are the events' local times marked as UTC, whatever the session's zone
    newest = events.agg(F.timestamp_micros(epoch_micros(F.max("ts"), events.schema["ts"].dataType))).scalar()
    late = delayed_packages(current_delay_state(spark, f"{root}/delays"), 2.0, newest)
    return late.withColumn("delayed_since", F.expr("timestampadd(MICROSECOND, unix_micros(delayed_since), timestamp_ntz'1970-01-01 00:00:00')"))
