"""The ontology graph as plain tables.

Nodes are ``(node_type, node_key, props)`` rows, edges are ``(rel_type,
edge_key, source_type, source, target_type, target, props)`` rows; patterns
are join chains.  Joins are equi-joins on declared keys: Catalyst chooses the
strategy and AQE broadcasts a side only when its measured size is under the
threshold, otherwise sort-merge with skew splitting.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.nesting import chunked_collect
from strata.ontology import Relationship
from strata.operators.project import props_json

log = logging.getLogger(__name__)

# Text for empty route context and the stop separator.
NO_ROUTE = "No route data found"
STOP_SEPARATOR = " -> "
NO_STOP = "None"  # how the context text shows a stop that is NULL


def route_context(routes: DataFrame, waypoints: DataFrame, transits: DataFrame,
                  route_key: str, waypoint_route_key: str, waypoint_transit_key: str,
                  transit_key: str, leg: str, columns: Sequence[str],
                  route_id=None) -> DataFrame:
    """Route ⋈ waypoint (inner) ⟕ transit, legs ordered numerically.

    With ``route_id`` the route is looked up (filter pushed to the scan);
    without, every route is expanded (batch form).  ``leg`` is ordered as a
    BIGINT; a non-numeric leg raises under ANSI, as in the source query.
    """
    r = routes if route_id is None else routes.filter(F.col(route_key) == F.lit(route_id))
    j = (r.join(waypoints, r[route_key] == waypoints[waypoint_route_key], "inner")
         .join(transits, waypoints[waypoint_transit_key] == transits[transit_key], "left"))
    out = j.select(*columns)
    if route_id is not None:
        out = out.orderBy(F.col(leg).cast("bigint"))
    return out


def route_summary(context: DataFrame, route_key: str, leg: str, stop: str,
                  mode: str | None = None, carrier: str | None = None,
                  tie: Sequence[str] = (), block: int = 4096,
                  parts: bool = False) -> DataFrame:
    """Per route the stops joined by `` -> `` in leg order and the last
    non-empty mode / carrier in leg order.

    Two levels, so no task sorts a whole long route: legs are grouped into
    blocks of ``block`` consecutive leg numbers, each block's stops are
    sorted and joined in parallel, and the second level concatenates the
    block texts in block order.  Mode and carrier are ``max_by`` partial
    aggregates carried through both levels.  The final text is the route's
    output value, so its size is the route's length.

    ``parts=True`` stops after the first level: one row per (route, ``part``)
    where ``part`` numbers the block of ``block`` consecutive legs and
    ``stops`` is that block's text (joining a route's parts in ``part`` order
    with `` -> `` gives the whole text).  The route's last mode / carrier come
    from a per-route partial aggregate over the blocks, joined back on the
    unique route key.  No value and no task then holds a whole route, which
    is the form to use when one route may hold a large share of all legs.
    """
    order = [F.col(leg).cast("bigint").alias("_leg")] + [F.col(c).alias(f"_t{i}")
                                                         for i, c in enumerate(tie)]
    names = ["_leg"] + [f"_t{i}" for i in range(len(tie))]
    extra = [c for c in (mode, carrier) if c]
    base = context.select(F.col(route_key), *order, F.coalesce(F.col(stop).cast("string"), F.lit(NO_STOP)).alias("_stop"),
                          *[F.col(c) for c in extra])
    base = base.withColumn("_blk", F.floor(F.col("_leg") / F.lit(block)))
    key = F.struct(*[F.col(n) for n in names])
    legs = F.array_sort(F.collect_list(F.struct(*[F.col(n) for n in names], F.col("_stop"))))
    lvl1 = [F.array_join(F.transform(legs, lambda x: x["_stop"]), STOP_SEPARATOR).alias("_part")]
    for c in extra:
        v = F.col(c)
        ok = v.isNotNull() & (v.cast("string") != "")
        lvl1.append(F.max_by(F.when(ok, v), F.when(ok, key)).alias(f"_v_{c}"))
        lvl1.append(F.max(F.when(ok, key)).alias(f"_k_{c}"))
    blocks = base.groupBy(route_key, "_blk").agg(*lvl1)
    lasts = [F.max_by(F.col(f"_v_{c}"), F.col(f"_k_{c}")).alias(f"last_{c}") for c in extra]
    if parts:
        out = blocks.select(F.col(route_key), F.col("_blk").cast("bigint").alias("part"),
                            F.col("_part").alias("stops"))
        if extra:
            # null-safe: a NULL route is one group, as in the whole-text form
            last = blocks.groupBy(route_key).agg(*lasts).withColumnRenamed(route_key, "_rk")
            out = out.join(last, out[route_key].eqNullSafe(last["_rk"])).drop("_rk")
        return out
    texts = F.array_sort(F.collect_list(F.struct("_blk", "_part")))
    lvl2 = [F.array_join(F.transform(texts, lambda x: x["_part"]), STOP_SEPARATOR)
            .alias("stops")]
    return blocks.groupBy(route_key).agg(*lvl2, *lasts)


def route_texts(summary: DataFrame, route_key: str, mode: str, carrier: str) -> Column:
    """The context text of each row of ``route_summary``, with carrier and mode (empty where a route has none)."""
    part = lambda label, c: F.concat(F.lit(f"{label}:\n"), F.coalesce(c.cast("string"), F.lit("")))
    return F.concat_ws("\n\n", part("Route", summary[route_key]), part("Carrier", summary[carrier]),
                       part("Mode", summary[mode]), part("Stops", summary["stops"]))


def route_text(summary_row: Mapping | None, route_key: str, mode: str, carrier: str) -> str:
    """Context text for one route (driver-side, one row)."""
    if not summary_row:
        return NO_ROUTE
    return (f"Route:\n{summary_row[route_key]}\n\nCarrier:\n{summary_row.get(carrier) or ''}"
            f"\n\nMode:\n{summary_row.get(mode) or ''}\n\nStops:\n{summary_row['stops']}")


def follow(source: DataFrame, target: DataFrame, rel: Relationship,
           how: str = "inner") -> DataFrame:
    """Follow a declared relationship over its ``via`` keys."""
    t = target.select(*[F.col(c).alias(f"{rel.target.lower()}_{c}") if c in source.columns
                        else F.col(c) for c in target.columns])
    tk = f"{rel.target.lower()}_{rel.target_key}" if rel.target_key in source.columns \
        else rel.target_key
    return source.join(t, source[rel.local_key] == t[tk], how)


def traverse(links: DataFrame, source_col: str, keys: DataFrame | None = None,
             key=None) -> DataFrame:
    """Look links up by source key in a pre-joined link table.

    One key -> a filter (pushed to the Parquet scan of a saved link table);
    a DataFrame of keys -> a left-semi join.
    """
    if keys is not None:
        return links.join(keys, links[source_col] == keys[keys.columns[0]], "left_semi")
    return links.filter(F.col(source_col) == F.lit(key))


def traverse_link(link_tables: Mapping[tuple[str, str], tuple[DataFrame, str]],
                  source_type: str, link: str, keys: DataFrame | None = None,
                  key=None) -> DataFrame:
    """J3/J4 by name: ``link_tables`` maps ``(source type, link id)`` to a
    pre-joined link table and its source-key column (one hop or multi hop);
    an unknown pair is an error, as in the source."""
    entry = link_tables.get((source_type, link))
    if entry is None:
        raise ValueError(f"traversal {link!r} from {source_type!r} is not supported "
                         "(no link table)")
    links, source_col = entry
    return traverse(links, source_col, keys=keys, key=key)


def expand(nodes: DataFrame, edges: DataFrame, node_key: str = "node_key",
           source: str = "source", target: str = "target",
           starts: DataFrame | None = None) -> DataFrame:
    """Start node -> outgoing edges -> target details (flat rows).

    ``starts`` (one key column) limits the start nodes with a semi join;
    an unknown start yields no rows.
    """
    e = edges if starts is None else edges.join(
        starts, edges[source] == starts[starts.columns[0]], "left_semi")
    tgt = nodes.select(*[F.col(c).alias(f"target_{c}") for c in nodes.columns])
    return e.join(tgt, e[target] == tgt[f"target_{node_key}"], "inner")


def nest(expanded: DataFrame, start: str, fields: Sequence[str],
         chunks: int = 1) -> DataFrame:
    """J6/D7 nested form: one row per start with its neighbours as a sorted
    array, or with ``chunks`` > 1 one row per (start, ``neighbours_chunk``), so
    that no task builds the whole array of a start with a huge fan-out."""
    return chunked_collect(expanded, start, fields, "neighbours", chunks)


@dataclass(frozen=True)
class NodeTable:
    node_type: str
    df: DataFrame
    key: str


@dataclass(frozen=True)
class EdgeTable:
    rel_type: str
    df: DataFrame
    source_type: str
    source: str
    target_type: str
    target: str
    key: str | None = None


def _union_or_empty(parts: list[DataFrame], tables: Sequence, schema: str) -> DataFrame:
    if parts:
        return reduce(lambda a, b: a.unionByName(b), parts)
    return tables[0].df.sparkSession.createDataFrame([], schema)


def node_union(tables: Sequence[NodeTable], with_props: bool = True) -> DataFrame:
    """Every node table as ``(node_type, node_key, props)``; NULL key -> ''.

    A table that does not resolve (missing key column, unreadable) is skipped
    with a warning, as in the source."""
    parts = []
    for t in tables:
        try:
            cols = [F.lit(t.node_type).alias("node_type"),
                    F.coalesce(F.col(t.key).cast("string"), F.lit("")).alias("node_key")]
            if with_props:
                cols.append(props_json(t.df, [c for c in t.df.columns if c != t.key])
                            .alias("props"))
            parts.append(t.df.select(*cols))
        except AnalysisException as e:
            log.warning("node table %s skipped: %s", t.node_type, str(e).splitlines()[0])
    schema = "node_type string, node_key string" + (", props string" if with_props else "")
    return _union_or_empty(parts, tables, schema)


def edge_union(tables: Sequence[EdgeTable], with_props: bool = False) -> DataFrame:
    """Every edge table as ``(rel_type, edge_key, source_type, source,
    target_type, target[, props])``; NULL endpoints become the text ``'None'``
    and the default edge key is ``source-target``.  A table that does not
    resolve is skipped with a warning."""
    parts = []
    for t in tables:
        src = F.coalesce(F.col(t.source).cast("string"), F.lit("None"))
        tgt = F.coalesce(F.col(t.target).cast("string"), F.lit("None"))
        key = (F.col(t.key).cast("string") if t.key else F.concat_ws("-", src, tgt))
        cols = [F.lit(t.rel_type).alias("rel_type"), key.alias("edge_key"),
                F.lit(t.source_type).alias("source_type"), src.alias("source"),
                F.lit(t.target_type).alias("target_type"), tgt.alias("target")]
        if with_props:
            cols.append(props_json(t.df, [c for c in t.df.columns
                                          if c not in (t.source, t.target)]).alias("props"))
        try:
            parts.append(t.df.select(*cols))
        except AnalysisException as e:
            log.warning("edge table %s skipped: %s", t.rel_type, str(e).splitlines()[0])
    schema = ("rel_type string, edge_key string, source_type string, source string, "
              "target_type string, target string" + (", props string" if with_props else ""))
    return _union_or_empty(parts, tables, schema)


def ghost_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edge endpoints that are not nodes, each once.

    Endpoints are typed, so equal raw keys of different types do not mask
    each other.  ``distinct`` pre-aggregates map-side; the anti join then
    shuffles each distinct endpoint once.
    """
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("source_type").alias("node_type"), F.col("source").alias("node_key")),
        F.struct(F.col("target_type").alias("node_type"), F.col("target").alias("node_key")),
    )).alias("e")).select("e.node_type", "e.node_key").distinct()
    return ends.join(nodes.select("node_type", "node_key"), ["node_type", "node_key"],
                     "left_anti")


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Node and edge totals in one job (tagged union, one aggregate)."""
    both = nodes.select(F.lit(True).alias("_n")).unionByName(edges.select(F.lit(False).alias("_n")))
    return both.agg(F.count_if(F.col("_n")).alias("n_nodes"),
                    F.count_if(~F.col("_n")).alias("n_edges"))


def match_path(a: DataFrame, ab: tuple[str, str], b: DataFrame, bc: tuple[str, str],
               c: DataFrame) -> DataFrame:
    """Two-hop pattern ``(a)-[ab]->(b)-[bc]->(c)`` as two inner joins.

    ``ab = (a_col, b_col)`` and ``bc = (b_col, c_col)`` name the join keys.
    """
    return (a.join(b, a[ab[0]] == b[ab[1]], "inner")
             .join(c, b[bc[0]] == c[bc[1]], "inner"))


def path_elements(matches: DataFrame, keys: Sequence[tuple[str, str]],
                  rels: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """J5 graph view: 3 nodes and 2 edges per match, duplicates kept.

    ``keys`` = [(type, column)] for the three nodes in path order; edge key
    is ``a-b``.
    """
    nodes = reduce(lambda x, y: x.unionByName(y), [
        matches.select(F.lit(t).alias("node_type"), F.col(c).cast("string").alias("node_key"))
        for t, c in keys])
    edges = reduce(lambda x, y: x.unionByName(y), [
        matches.select(F.lit(rels[i]).alias("rel_type"),
                       F.concat_ws("-", F.col(keys[i][1]).cast("string"),
                                   F.col(keys[i + 1][1]).cast("string")).alias("edge_key"),
                       F.col(keys[i][1]).cast("string").alias("source"),
                       F.col(keys[i + 1][1]).cast("string").alias("target"))
        for i in range(len(keys) - 1)])
    return nodes, edges
