"""Plans for catalogs, contract checks and the spec registry (S6 C1 C2 C3 C4 J9 U3 K9): the events' payloads before and after a date.

The stand-in payloads take their fields from the events; after the date each kind of change occurs once: a field
more (click), a field less (view), a longer text (purchase), another type (error), a table gone and one come (signup).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.catalogs import in_scope, payload_catalog, spec_paths
from strata.operators.contracts import (CREATE_TABLE, EXTRA_TABLE, catalog_drift, contract_diff, drift_verdict)
from strata.operators.registry import log_changes, register_objects, schema_changes
from strata.plans.registry import plan
from strata.session import cut_lineage
from strata.sources.tables import Tables

CUT = "2024-01-16 00:00:00"


def _payloads(events: DataFrame) -> DataFrame:
    """(table_name, after, payload): one JSON object an event."""
    after = F.col("ts") >= F.lit(CUT).cast("timestamp_ntz")
    kind = F.col("event_type")
    field = lambda cond, value: F.when(cond, value)  # noqa: E731  (null fields are left out of the JSON)
    payload = F.struct(
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        field((kind == "click") & after, F.lit(True)).alias("flag"),
        field((kind == "view") & ~after, F.col("event_id")).alias("ref"),
        field(kind == "purchase", F.when(after, F.lit("code")).otherwise(F.lit("cc"))).alias("code"),
        field((kind == "error") & ~after, F.col("user_id")).alias("owner"),
        field((kind == "error") & after, F.lit("u")).alias("owner2"))
    text = F.regexp_replace(F.to_json(payload), '"owner2"', '"owner"')
    name = F.when((kind == "signup") & after, F.lit("signup_two")).when(kind == "view", F.lit("look")).otherwise(kind)
    return events.select(name.alias("table_name"), after.alias("after"), text.alias("payload"))


def _catalogs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = _payloads(Tables(spark, sf_dir).events)
    return tuple(in_scope(payload_catalog(rows.filter(F.col("after") == side), "table_name", "payload")) for side in (False, True))


_CATALOG_SQL = f"""
x AS (
  SELECT event_type AS kind, ts >= TIMESTAMP '{CUT}' AS after, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
f AS (
  SELECT CASE WHEN kind = 'signup' AND after THEN 'signup_two' WHEN kind = 'view' THEN 'look' ELSE kind END AS table_name, after, kind, k FROM x),
c AS (
  SELECT DISTINCT table_name, after, 'k' AS column_name, 'INT64' AS type FROM f WHERE k IS NOT NULL
  UNION SELECT table_name, after, 'flag', 'BOOL' FROM f WHERE kind = 'click' AND after
  UNION SELECT table_name, after, 'ref', 'INT64' FROM f WHERE kind = 'view' AND NOT after
  UNION SELECT table_name, after, 'code', CASE WHEN after THEN 'STRING(4)' ELSE 'STRING(2)' END FROM f WHERE kind = 'purchase'
  UNION SELECT table_name, after, 'owner', CASE WHEN after THEN 'STRING(1)' ELSE 'INT64' END FROM f WHERE kind = 'error'),
old AS (SELECT * FROM c WHERE NOT after), new AS (SELECT * FROM c WHERE after)"""

# The old state is what is live, the new one the contract that it is checked against.
_DRIFT_SQL = _CATALOG_SQL + """,
tb AS (SELECT coalesce(n.t, o.t) AS t, n.t IS NOT NULL AS in_new, o.t IS NOT NULL AS in_old
       FROM (SELECT DISTINCT table_name AS t FROM new) n FULL JOIN (SELECT DISTINCT table_name AS t FROM old) o ON n.t = o.t),
drift AS (
  SELECT t AS table_name, NULL AS column_name, CASE WHEN in_new THEN 'CREATE_TABLE' ELSE 'EXTRA_TABLE' END AS kind,
         NULL AS contract_type, NULL AS live_type FROM tb WHERE NOT (in_new AND in_old)
  UNION ALL
  SELECT coalesce(n.table_name, o.table_name), coalesce(n.column_name, o.column_name),
         CASE WHEN o.type IS NULL THEN 'ADD_COLUMN' WHEN n.type IS NULL THEN 'EXTRA_COLUMN' WHEN n.type = o.type THEN 'OK'
              WHEN n.type LIKE 'STRING(%' AND o.type LIKE 'STRING(%'
                   AND CAST(regexp_extract(n.type, '[0-9]+') AS INT) >= CAST(regexp_extract(o.type, '[0-9]+') AS INT) THEN 'COMPATIBLE_CHANGE'
              ELSE 'BREAKING' END, n.type, o.type
  FROM (SELECT * FROM new WHERE table_name IN (SELECT t FROM tb WHERE in_old)) n
  FULL JOIN (SELECT * FROM old WHERE table_name IN (SELECT t FROM tb WHERE in_new)) o
    ON n.table_name = o.table_name AND n.column_name = o.column_name)"""


@plan("catalog_scan", f"WITH {_CATALOG_SQL} SELECT table_name, column_name, type FROM new")
def catalog_scan(spark, sf_dir):
    """The catalog of the payloads after the date."""
    return _catalogs(spark, sf_dir)[1]


@plan("contract_diff", f"""
WITH {_CATALOG_SQL},
j AS (SELECT coalesce(n.table_name, o.table_name) AS table_name, coalesce(n.column_name, o.column_name) AS col, n.type AS nt, o.type AS ot
      FROM new n FULL JOIN old o ON n.table_name = o.table_name AND n.column_name = o.column_name)
SELECT table_name,
       coalesce(string_agg(col, ',' ORDER BY col) FILTER (WHERE ot IS NULL), '') AS added,
       coalesce(string_agg(col, ',' ORDER BY col) FILTER (WHERE nt IS NULL), '') AS removed,
       coalesce(string_agg(col, ',' ORDER BY col) FILTER (WHERE nt <> ot), '') AS type_changes,
       CASE WHEN count(ot) = 0 THEN 'ADDITIVE' WHEN bool_or(nt IS NULL OR coalesce(nt <> ot, false)) THEN 'BREAKING'
            WHEN bool_or(ot IS NULL) THEN 'COMPATIBLE' ELSE 'ADDITIVE' END AS kind
FROM j GROUP BY table_name HAVING count(nt) > 0
""")
def contract_diff_plan(spark, sf_dir):
    """What changed in each table's payloads at the date."""
    old, new = _catalogs(spark, sf_dir)
    d = contract_diff(old, new)
    return d.select("table_name", *[F.array_join(c, ",").alias(c) for c in ("added", "removed", "type_changes")], "kind")


def _drift(spark, sf_dir, tables=None) -> DataFrame:
    old, new = _catalogs(spark, sf_dir)
    return catalog_drift(new, old, tables)


@plan("catalog_drift", f"WITH {_DRIFT_SQL} SELECT * FROM drift")
def catalog_drift_plan(spark, sf_dir):
    """The payloads before the date against those after it, both ways."""
    return _drift(spark, sf_dir)


@plan("catalog_tables", f"WITH {_DRIFT_SQL} SELECT table_name, kind FROM drift WHERE kind IN ('CREATE_TABLE', 'EXTRA_TABLE')")
def catalog_tables(spark, sf_dir):
    """Tables that only one side has."""
    return _drift(spark, sf_dir).filter(F.col("kind").isin(CREATE_TABLE, EXTRA_TABLE)).select("table_name", "kind")


@plan("catalog_drift_scoped", f"""
WITH {_DRIFT_SQL} SELECT * FROM drift WHERE table_name IN (SELECT DISTINCT event_type FROM events WHERE event_type IN ('click', 'purchase'))
""")
def catalog_drift_scoped(spark, sf_dir):
    """C4: the drift of the changed tables alone, given as a table."""
    changed = Tables(spark, sf_dir).events.filter(F.col("event_type").isin("click", "purchase")).select(
        F.col("event_type").alias("table_name")).distinct()
    return _drift(spark, sf_dir, changed)


@plan("drift_verdict", f"""
WITH {_DRIFT_SQL},
d AS (SELECT 'all' AS scope, kind FROM drift UNION ALL SELECT 'click', kind FROM drift WHERE table_name = 'click'
      UNION ALL SELECT 'none', kind FROM drift WHERE table_name = 'nowhere'),
s AS (SELECT scope, coalesce(bool_or(kind IN ('EXTRA_TABLE', 'BREAKING')), false) AS drift,
             coalesce(bool_or(kind IN ('CREATE_TABLE', 'ADD_COLUMN', 'COMPATIBLE_CHANGE')), false) AS evolution
      FROM (SELECT unnest(['all', 'click', 'none']) AS scope) LEFT JOIN d USING (scope) GROUP BY scope)
SELECT scope, mode, drift, evolution,
       CASE WHEN drift THEN 'BREAKING_DRIFT' WHEN evolution AND mode = 'strict' THEN 'EVOLUTION_BLOCKED'
            WHEN evolution THEN 'COMPATIBLE_EVOLUTION' ELSE 'NO_DRIFT' END AS status,
       NOT drift AND NOT (evolution AND mode = 'strict') AS ok
FROM s, (SELECT unnest(['auto-additive', 'strict', 'manual']) AS mode)
""")
def drift_verdict_plan(spark, sf_dir):
    """The verdict in each mode, for all tables, one that evolved, and none."""
    report = cut_lineage(_drift(spark, sf_dir))  # a row a column, read nine times
    out = None
    for scope in ("all", "click", "none"):
        rows = report if scope == "all" else report.filter(F.col("table_name") == (scope if scope != "none" else "nowhere"))
        for mode in ("auto-additive", "strict", "manual"):
            row = drift_verdict(rows, mode).select(F.lit(scope).alias("scope"), F.lit(mode).alias("mode"), "*")
            out = row if out is None else out.unionByName(row)
    return out


def _specs(catalog: DataFrame, version: str) -> DataFrame:
    """A spec text for each table of a catalog, as a source system would hand it in."""
    entry = F.concat(F.lit('"'), F.col("column_name"), F.lit('":{"type":"'), F.col("type"), F.lit('"}'))
    rows = catalog.groupBy("table_name").agg(F.array_join(F.array_sort(F.collect_list(entry)), ",").alias("p"))  # a table's columns
    text = F.concat(F.lit('{"kind":"ObjectType","metadata":{"name":"'), F.col("table_name"), F.lit('"},"spec":{"tableName":"t_'), F.col("table_name"),
                    F.lit('","primaryKey":"k","properties":{'), F.col("p"), F.lit("}}}"))
    return rows.select(F.concat(F.lit(f"{version}/"), F.col("table_name")).alias("path"), text.alias("text"))


@plan("canonical_objects", f"""
WITH {_CATALOG_SQL},
s AS (SELECT table_name, after, string_agg('"' || column_name || '":{{"type":"' || type || '"}}', ',' ORDER BY column_name) AS p FROM c GROUP BY 1, 2),
l AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY after DESC) = 1)
SELECT table_name AS object_type_id, table_name AS name, 't_' || table_name AS table_name, 'k' AS primary_key_field, 'ACTIVE' AS status,
       '{{' || p || '}}' AS attributes,
       sha256('{{"kind":"ObjectType","metadata":{{"name":"' || table_name || '"}},"spec":{{"tableName":"t_' || table_name
              || '","primaryKey":"k","properties":{{' || p || '}}}}}}') AS text_hash
FROM l
""")
def canonical_objects_plan(spark, sf_dir):
    """K9: canonical objects of the specs before the date, then those after it merged in by name."""
    old, new = _catalogs(spark, sf_dir)
    first = register_objects(None, _specs(old, "v1"))
    return register_objects(first, _specs(new, "v2"))


def _nested(events: DataFrame) -> DataFrame:
    """The payloads with all fields but ``k`` one level down, under ``meta``."""
    p = _payloads(events)
    rest = F.regexp_replace(F.regexp_replace("payload", r'"k":-?[0-9]+,?', ""), r"^$", "{}")
    return p.select("table_name", "after", F.concat(F.lit('{"k":'), F.get_json_object("payload", "$.k"), F.lit(',"meta":'), rest, F.lit("}")).alias("payload"))


@plan("schema_change_log", f"""
WITH {_CATALOG_SQL},
t AS (SELECT table_name AS entity, after, 'meta.' || column_name AS path,
             CASE WHEN type LIKE 'STRING%' THEN 'STRING' WHEN type = 'BOOL' THEN 'BOOLEAN' ELSE 'BIGINT' END AS type FROM c WHERE column_name <> 'k'),
n AS (SELECT * FROM t UNION ALL SELECT table_name, after, 'k', 'BIGINT' FROM c WHERE column_name = 'k'
      UNION ALL SELECT table_name, after, 'meta', 'OBJECT<>' FROM c WHERE column_name = 'k'
                AND NOT EXISTS (SELECT 1 FROM t WHERE t.entity = c.table_name AND t.after = c.after)),
j AS (SELECT coalesce(a.entity, b.entity) AS entity, coalesce(a.path, b.path) AS path, b.type AS ot, a.type AS nt
      FROM (SELECT * FROM n WHERE after) a FULL JOIN (SELECT * FROM n WHERE NOT after) b ON a.entity = b.entity AND a.path = b.path),
g AS (SELECT entity, count(ot) = 0 AS fresh, coalesce(bool_or(nt IS NULL OR nt <> ot), false) AS broken, bool_or(ot IS NULL) AS more,
             coalesce(string_agg('"' || path || '"', ',' ORDER BY path) FILTER (WHERE ot IS NULL), '') AS a,
             coalesce(string_agg('"' || path || '"', ',' ORDER BY path) FILTER (WHERE nt IS NULL), '') AS r,
             coalesce(string_agg('{{"property":"' || path || '","from":"' || ot || '","to":"' || nt || '"}}', ',' ORDER BY path) FILTER (WHERE nt <> ot), '') AS c
      FROM j GROUP BY entity HAVING count(nt) > 0),
d AS (SELECT entity, CASE WHEN fresh THEN 'ADDITIVE' WHEN broken THEN 'BREAKING' WHEN more THEN 'COMPATIBLE' ELSE 'ADDITIVE' END AS change,
             CASE WHEN fresh THEN '{{"info":"New entity type added"}}'
                  ELSE '{{"added_properties":[' || a || '],"removed_properties":[' || r || '],"type_changes":[' || c || ']}}' END AS diff FROM g)
SELECT entity, change, diff, md5(concat_ws('-', entity, change, diff)) AS change_id FROM d
""")
def schema_change_log(spark, sf_dir):
    """K9: the changes of the nested payloads at the date, path by path, logged twice: equal changes are one row."""
    rows = _nested(Tables(spark, sf_dir).events)
    # a row a path, read five times by the comparison
    old, new = (cut_lineage(spec_paths(rows.filter(F.col("after") == side), "table_name", "payload")) for side in (False, True))
    changes = cut_lineage(schema_changes(old, new))
    return log_changes(log_changes(None, changes), changes).select("entity", "change", "diff", "change_id")
