"""D3 on a stream: packages delayed for more than N hours, in Spark's keyed state.

"Delayed since" is the first DELAYED time after the last event with another status.  An event that comes late may
end a delay in its middle, so one least time is not enough: a package's state holds its last other time and the DELAYED
times after it.  Of those that the watermark has passed only the first is kept, as no event in time can part them any
more, so the state is bounded by what a package sends within the watermark's delay.  The results equal the
batch operator's for events at most ``delay`` late, whatever their order.

A call of the Python function costs far more than the few events of a package, so packages share a fixed number of
buckets, by a hash: a bucket's state holds the states of its packages, and one call takes all of its events in a micro-batch.

Changed packages go to a table of changes (``strata.streaming.changes``); repeated events change nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strata.functions.clock import hours_between
from strata.operators.telemetry import DELAYED
from strata.streaming.changes import newest, read_changes, run_changes

# Times travel as microseconds, which no session's time zone can shift.
STATE_SCHEMA = "package_id array<string>, last_ok array<long>, delayed array<array<long>>, latest array<long>, status array<string>"
#: Buckets of packages. Each is rewritten if one of its packages changes; the number is fixed for the life of a checkpoint.
BUCKETS = 1024
_NO_TIME = -(1 << 62)  # a missing time on its way out of Python
_ROW = "package_id string, current_status string, last_ok long, delayed_since long, latest long"
COLUMNS = ("package_id string, current_status string, last_ok timestamp, "
           "delayed_since timestamp, latest timestamp")


def advance(before: tuple | None, times: np.ndarray, statuses: np.ndarray, watermark: int) -> tuple:
    """State after more events of one package: (last_ok, DELAYED times after it, latest, its status).

    ``times`` and ``watermark`` are microseconds. Of statuses at one time the greatest text is the current one.
    """
    last_ok, delayed, latest, status = before if before else (None, [], None, None)
    is_delay = statuses == DELAYED
    if (~is_delay).any():
        other = int(times[~is_delay].max())
        last_ok = other if last_ok is None else max(last_ok, other)
    held = np.unique(np.concatenate([np.asarray(delayed, np.int64), times[is_delay]]))
    if last_ok is not None:
        held = held[held > last_ok]
    passed = int(np.searchsorted(held, watermark))  # an event at the watermark itself is still in time
    if passed > 1:  # nothing in time can come between the first of them and the others
        held = np.concatenate([held[:1], held[passed:]])
    top = int(times.max())
    if latest is None or top >= latest:
        known = [str(s) for s in statuses[times == top]] + ([status] if latest == top else [])
        latest, status = top, max(known)
    return last_ok, held.tolist(), latest, status


def _update(key, frames, state: GroupState):
    """The changed packages of one bucket."""
    known = {p: now for p, *now in zip(*state.get)} if state.exists else {}
    watermark = state.getCurrentWatermarkMs() * 1000
    changed = {}  # in order of arrival
    for f in frames:
        code, ids = pd.factorize(f["package_id"].to_numpy(object), use_na_sentinel=False)
        order = np.argsort(code, kind="stable")
        times, statuses = f["ts"].to_numpy(np.int64)[order], f["status"].to_numpy(object)[order]
        ends = np.cumsum(np.bincount(code, minlength=len(ids)))
        for p, a, z in zip(ids, [0, *ends[:-1]], ends):
            p = None if pd.isna(p) else p
            known[p] = changed[p] = advance(known.get(p), times[a:z], statuses[a:z], watermark)
    if not changed:
        return
    state.update((list(known), *(list(c) for c in zip(*known.values()))))
    since = [held[0] if status == DELAYED and held else _NO_TIME for _, held, _, status in changed.values()]
    yield pd.DataFrame({"package_id": list(changed), "current_status": [now[3] for now in changed.values()],
                        "last_ok": [_NO_TIME if now[0] is None else now[0] for now in changed.values()],
                        "delayed_since": since, "latest": [now[2] for now in changed.values()]})


def delay_states(stream: DataFrame, delay: str = "1 day", buckets: int = BUCKETS) -> DataFrame:
    """The state of each package that a micro-batch changes, from a parsed telemetry stream (update mode).

    Events without a time are left out.  Events more than ``delay`` late are still taken in, but one that ends a delay
    before the watermark may leave ``delayed_since`` at the first DELAYED time that is still held.
    """
    timed = stream.select("package_id", F.coalesce("status", F.lit("")).alias("status"),
                          F.try_to_timestamp("timestamp").alias("event_time")).filter("event_time is not null")
    timed = timed.withWatermark("event_time", delay).withColumn("ts", F.unix_micros("event_time"))
    timed = timed.withColumn("bucket", F.pmod(F.xxhash64("package_id"), F.lit(buckets)))
    rows = timed.groupBy("bucket").applyInPandasWithState(_update, _ROW, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)
    return rows.select("package_id", "current_status", *[
        F.when(F.col(c) != _NO_TIME, F.timestamp_micros(c)).alias(c) for c in ("last_ok", "delayed_since", "latest")])


def run_delay_state(stream: DataFrame, store_path: str, checkpoint: str | None = None, available_now: bool = True, delay: str = "1 day"):
    """Maintain the delay state of each package at ``store_path``; returns the StreamingQuery."""
    return run_changes(delay_states(stream, delay), store_path, "delay-state", "update", checkpoint, available_now)


def current_delay_state(spark: SparkSession, store_path: str) -> DataFrame:
    """Each package's newest state; empty before the first batch."""
    empty = spark.createDataFrame([], COLUMNS)
    changes = read_changes(spark, store_path, empty.withColumn("epoch", F.lit(0).cast("long")))
    return empty if changes is None else newest(changes, "package_id")


def delayed_packages(state: DataFrame, hours: float, as_of: Column) -> DataFrame:
    """Packages currently DELAYED for more than ``hours`` as of ``as_of``."""
    t = state.schema["delayed_since"].dataType
    h = hours_between(F.col("delayed_since"), as_of.cast(t), t)
    return (state.filter(F.col("current_status") == DELAYED)
            .select("package_id", "delayed_since", F.round(h, 4).alias("hours_delayed"))
            .filter(F.col("hours_delayed") > F.lit(hours)))
