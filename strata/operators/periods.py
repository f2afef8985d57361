"""Events within periods of validity, by dyadic decomposition of the periods.

The time axis is counted in units and cut in nodes: a node of level l covers ``2**l`` units.  A period is listed in the
fewest nodes that make it up, at most two a level, so about ``2 * log2(length)``; an event probes the one node of each level
that covers it.  A period's nodes do not overlap, so an event meets a period that covers it exactly once, and no other
period.  A key with a third of all events and periods is spread over its nodes, and a period without an end
costs no more than a long one.

The pairs grow with the product of both sides.  Who only wants sums over a period's events gives ``sums``: the events of each node
are added up once, and a period meets a row for each of its nodes, so the work grows with the sum of both sides.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.clock import epoch_micros


def _instant(c: Column, dtype: T.DataType) -> Column:
    """A time as a number: microseconds, days or the integer itself."""
    if isinstance(dtype, T.TimestampType | T.TimestampNTZType):
        return epoch_micros(c, dtype)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dtype, T.IntegralType):
        return c.cast("long")
    raise TypeError(f"periods need times, dates or integers, not {dtype.simpleString()}")


def _nodes_at(first: Column, end: Column, level: Column) -> Column:
    """Array of the at most two nodes of a level among those that make up the units from ``first`` to before ``end``, with NULLs."""
    lo = F.call_function("shiftright", first + F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1, level)
    hi = F.call_function("shiftright", end, level)
    return F.array(F.when((lo < hi) & (lo % 2 != 0), lo), F.when((lo < hi) & (hi % 2 != 0), hi - 1))


def dyadic_nodes(first: Column, end: Column, levels: int) -> Column:
    """Array of ``(level, node)`` that make up the units from ``first`` to before ``end``; empty if there are none.

    ``levels`` is such that ``end - first <= 2**levels``.
    """
    at = lambda level: F.transform(_nodes_at(first, end, level), lambda n: F.when(n.isNotNull(), F.struct(level.alias("level"), n.alias("node"))))
    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at)), lambda x: x.isNotNull())


def events_in_periods(events: DataFrame, periods: DataFrame, event_key: str, period_key: str, at: str,
                      valid_from: str, valid_to: str, sums: Mapping[str, Column] | None = None) -> DataFrame:
    """Each event with each period of its key that holds it: ``valid_from <= at < valid_to``; a NULL end is open.

    All columns of both sides are returned; names must differ, but for the key.  Events without a key or a time match
    nothing, nor do empty periods; repeated rows match like others.  Times of one kind are expected on both
    sides (instants, local times, dates or integers).

    With ``sums`` (name -> what an event adds) a period is returned with each of its nodes that holds events instead, beside the
    key and the sums of the node's events: no event is in two nodes of a period, so their sums add up to the period's.
    """
    if sums:
        events = events.select(event_key, at, *[c.alias(n) for n, c in sums.items()])
    none = (events.drop(at) if sums else events).join(periods, F.lit(False))
    none = none.drop(periods[period_key]) if event_key == period_key else none
    kind = events.schema[at].dataType
    at_ = _instant(F.col(at), kind)
    e = events.filter(F.col(event_key).isNotNull() & F.col(at).isNotNull()).withColumn("_at", at_)
    span = e.agg(F.min("_at").alias("lo"), F.max("_at").alias("hi")).first()  # one row
    if span["lo"] is None:
        return none
    # Periods are clipped to the events and counted from the first of them, which drops no match.
    lo, hi = span["lo"], span["hi"] + 1
    bound = lambda c, default: F.coalesce(_instant(F.col(c).cast(kind), kind), F.lit(default).cast("long")) - lo
    first, end = F.greatest(bound(valid_from, lo), F.lit(0).cast("long")), F.least(bound(valid_to, hi), F.lit(hi - lo).cast("long"))
    p = periods.filter(F.col(period_key).isNotNull()).withColumns({"_first": first, "_end": end}).filter("_first < _end")
    longest = p.agg(F.max(F.col("_end") - F.col("_first"))).first()[0]  # one row
    if longest is None:
        return none
    # A period of ``n`` units has nodes up to level log2(n).  Levels and nodes are exploded one after the other, as rows of plain columns.
    p = p.withColumn("_level", F.explode(F.sequence(F.lit(0), F.length(F.bin(F.col("_end") - F.col("_first"))) - 1)))
    p = p.withColumn("_node", F.explode(_nodes_at(F.col("_first"), F.col("_end"), F.col("_level")))).filter("_node is not null")
    e = e.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(longest.bit_length() - 1))))
    e = e.withColumn("_node", F.call_function("shiftright", F.col("_at") - lo, F.col("_level"))).drop("_at")
    if sums:
        e = e.groupBy(event_key, "_level", "_node").agg(*[F.sum(n).alias(n) for n in sums])
    p = p.drop("_first", "_end")
    cond = (e[event_key] == p[period_key]) & (e["_level"] == p["_level"]) & (e["_node"] == p["_node"])
    out = e.join(p, cond).drop(e["_level"]).drop(p["_level"]).drop(e["_node"]).drop(p["_node"])
    return out.drop(p[period_key]) if event_key == period_key else out
