"""Bulk load end to end: CSV scan -> rule validation -> valid rows + audit.

Per table: one all-string scan, one map-only validation pass producing both
outputs, valid rows merged into the ontology table by key (K1), audit rows
unioned across tables (U1) and appended (K4).  The only shuffle is the
upsert's merge join.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from strata.operators.rules import Validation, flatten_audits, validate
from strata.sources.csv import scan_csv

# CSV file name -> ontology table of the bulk loader.
TABLE_MAP = {
    "operation": "location",
    "network_routing": "route",
    "network_routing_segment": "waypoint",
    "transit_path": "transit_connection",
}

LOG = logging.getLogger(__name__)


@dataclass
class BulkLoad:
    valid: dict[str, DataFrame] = field(default_factory=dict)
    rejected: dict[str, DataFrame] = field(default_factory=dict)
    results: dict[str, Validation] = field(default_factory=dict)
    audit: DataFrame | None = None


def bulk_load(spark: SparkSession, csv_dir: str, tables: Sequence[str],
              rules: Mapping[str, Sequence], table_map: Mapping[str, str] = TABLE_MAP,
              mode: str = "compat", audit_id: str = "uuid",
              run_id: str | None = None, materialize: bool = False) -> BulkLoad:
    """Scan and validate each ``<csv_dir>/<table>.csv``.

    Rules are looked up by the mapped ontology name; the audit's
    ``table_name`` is the CSV name.  A table without rules passes every row
    and writes no audit rows.  A missing file skips the table.  With
    ``materialize`` each table's rules are evaluated once into the shared
    checkpoint folder and the valid and audit outputs both read that copy.
    """
    out = BulkLoad()
    when = datetime.now(timezone.utc).replace(tzinfo=None)
    audits = []
    for table in tables:
        path = f"{csv_dir.rstrip('/')}/{table}.csv"
        try:
            scan = scan_csv(spark, path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            LOG.warning("bulk load: %s skipped, no file %s", table, path)
            continue
        onto = table_map.get(table, table)
        v = validate(scan.rows, table, rules.get(onto, []), mode=mode,
                     audit_id=audit_id, run_id=run_id, evaluated_at=when,
                     materialize=materialize and bool(rules.get(onto)))
        out.results[table] = v
        out.valid[table] = v.valid
        out.rejected[table] = scan.rejected
        if rules.get(onto):
            audits.append(v.audit)
    if audits:
        out.audit = flatten_audits(audits)
    return out


def commit_table(spark: SparkSession, valid: DataFrame, key: str, current_path: str | None,
                 new_path: str, mode: str = "non_empty") -> int:
    """K1 for a bulk load: merge the valid rows into the current version of
    the ontology table and write the result as a new version at ``new_path``
    (read and write paths differ; the caller then points readers at it).
    Returns the row count of the new version.
    """
    from strata.sinks.upsert import latest_per_key, upsert

    if current_path:
        merged = upsert(spark.read.parquet(current_path), valid, key, mode=mode)
    else:
        merged = latest_per_key(valid, key).select(*valid.columns)
    merged.write.mode("overwrite").parquet(new_path)
    return spark.read.parquet(new_path).count()
