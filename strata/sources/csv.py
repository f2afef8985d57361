"""CSV scans for bulk loads.

S1 reads every column as a string with the header of the first file, keeps
malformed lines (wrong field count, bad quoting) out of the rows and lets the
caller route them to a dead-letter output, drops lines equal to the header
and turns missing values into ``''``.  S2 applies the per-table typed
coercion of the seeder (``''`` -> NULL, ``try_cast`` to the target types,
renames).  S3 drops rows whose every value is blank.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def quoted(name: str) -> str:
    """A column name that may hold dots or back-ticks, as Spark reads it."""
    return "`" + name.replace("`", "``") + "`"


@dataclass
class CsvScan:
    rows: DataFrame       # all-string rows, '' for missing
    rejected: DataFrame   # (file_path, line) of malformed lines
    header: list[str]


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line of the first file (one small read)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def scan_csv(spark: SparkSession, path: str, header: Sequence[str] | None = None) -> CsvScan:
    """Read ``path`` (file, folder or glob) as all-string rows."""
    names = list(header) if header is not None else csv_header(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names]
                          + [T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT)
           .option("escape", '"').option("multiLine", False)
           .schema(schema).csv(path)
           .withColumn("_file", F.col("_metadata.file_path")))
    named = {n: F.col(quoted(n)) for n in names}
    every = F.concat_ws("", *[F.coalesce(named[n], F.lit("")) for n in names])
    good = raw.filter(F.col(CORRUPT).isNull() & (F.length(every) >= 0))
    not_header = ~reduce(lambda a, b: a & b,
                         [F.coalesce(named[n], F.lit("")) == F.lit(n) for n in names])
    rows = good.filter(not_header).select(
        *[F.coalesce(named[n], F.lit("")).alias(n) for n in names])
    # An always-true test over every data column, which Catalyst cannot fold:
    # it keeps count() from pruning the scan to the corrupt column alone, and
    # keeps the CSV parser tokenising whole lines (with pruning it checks only
    # the fields it reads, and a wrong field count would go unnoticed).
    bad = F.col(CORRUPT).isNotNull() & (F.length(every) >= 0)
    rejected = raw.filter(bad).select(
        F.col("_file").alias("file_path"), F.col(CORRUPT).alias("line"),
        F.struct(*[named[n].alias(n) for n in names]).alias("partial"))
    return CsvScan(rows, rejected, names)


@dataclass(frozen=True)
class TypedColumn:
    source: str
    target: str
    type: str  # Spark SQL type name: string, bigint, decimal(38,9), date, ...
    keep_empty: bool = False  # text kept as is ('' stays ''), as for keys
    required: bool = False    # an empty or missing value does not parse either


def load_typed(df: DataFrame, columns: Sequence[TypedColumn]) -> DataFrame:
    """Keep only the listed columns, typed and renamed.

    Text: exactly ``''`` -> NULL (other values, spaces included, kept), or kept
    as is with ``keep_empty``.  Numbers and dates: ``''`` -> NULL, otherwise
    ``try_cast`` of the trimmed text.  A value that does not parse is NULL here;
    ``load_typed_checked`` routes such rows to a rejected output (the seeder stopped
    on them).
    """
    return df.select(*[_typed(c).alias(c.target) for c in columns])


def _is_text(c: TypedColumn) -> bool:
    return c.type.lower() in ("string", "varchar")


def _typed(c: TypedColumn):
    col = F.col(quoted(c.source))
    if _is_text(c):
        return col if c.keep_empty else F.when(col == "", F.lit(None)).otherwise(col)
    cast = F.expr(f"try_cast(trim({quoted(c.source)}) AS {c.type})")
    if c.type.lower() in ("bigint", "int", "long", "integer"):  # a cast would cut 5.7 to 5
        cast = F.when(col.rlike(r"^\s*[+-]?[0-9]+\s*$"), cast)
    return F.when(col == "", F.lit(None)).otherwise(cast)


@dataclass
class TypedLoad:
    rows: DataFrame       # typed rows, every value parsed
    rejected: DataFrame   # the source rows with ``reasons ARRAY<STRING>``


def load_typed_checked(df: DataFrame, columns: Sequence[TypedColumn]) -> TypedLoad:
    """S2 with rejects: a row with a value that does not parse keeps its source
    columns, goes to ``rejected`` and names each such column with its type."""
    def given(c):
        return F.coalesce(F.col(quoted(c.source)), F.lit("")) != ""

    bad = [F.when((F.lit(c.required) | given(c)) & _typed(c).isNull(), F.lit(f"{c.source}: not {c.type}"))
           for c in columns if not _is_text(c)]
    reasons = F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else F.array().cast(
        "array<string>")
    return TypedLoad(load_typed(df.filter(F.size(reasons) == 0), columns),
                     df.withColumn("reasons", reasons).filter(F.size("reasons") > 0))


def _spec(*cols: tuple) -> tuple[TypedColumn, ...]:
    return tuple(TypedColumn(*c) for c in cols)


# The seeded tables in foreign-key order, each column as
# (CSV column, table column, type, keep '' as is).  Columns not listed are
# dropped; three are renamed.
SEED_TABLES = (
    ("operation", _spec(("operation_id", "operation_id", "string", True),
                        ("operation_type", "operation_type", "string"),
                        ("location_code", "location_code", "string"))),
    ("network_routing", _spec(("routing_id", "routing_id", "string", True),
                              ("origin_operation_id", "origin_operation_id", "string", True),
                              ("destination_operation_id", "destination_operation_id", "string",
                               True),
                              ("service_commit", "service_commit", "string"),
                              ("zulu_day", "zulu_day", "date", False, True))),
    ("network_routing_segment", _spec(("segment_id", "segment_id", "string", True),
                                      ("routing_id", "routing_id", "string", True),
                                      ("origin_operation_id", "origin_operation_id", "string",
                                       True),
                                      ("destination_operation_id", "destination_operation_id",
                                       "string", True),
                                      ("transport_mode", "transport_mode", "string"),
                                      ("weight", "weight", "decimal(38,9)"),
                                      ("pieces", "pieces", "bigint"),
                                      ("zulu_day", "zulu_day", "date", False, True))),
    ("transit_path", _spec(("transit_path_id", "transit_path_id", "string", True),
                           ("segment_id", "segment_id", "string", True),
                           ("total_transit_minutes", "total_transit_minutes", "bigint"))),
    ("vehicle", _spec(("vehicle_id", "vehicle_id", "string", True),
                      ("vehicle_type", "vehicle_type", "string"),
                      ("capacity_kg", "max_weight_capacity", "bigint"))),
    ("driver", _spec(("driver_id", "driver_id", "string", True),
                     ("assigned_vehicle_id", "vehicle_id", "string"),
                     ("license_type", "certification_level", "string"),
                     ("status", "status", "string"))),
    ("maintenance_log", _spec(("log_id", "log_id", "string", True),
                              ("vehicle_id", "vehicle_id", "string"),
                              ("issue_type", "issue_type", "string"),
                              ("severity", "severity", "bigint"))),
)


class SeedTables(dict):
    """Typed tables by name, in foreign-key order; ``rejected`` holds what none of them took:
    ``(table_name, reasons ARRAY<STRING>, record)``."""

    rejected: DataFrame


def load_seed_tables(spark: SparkSession, csv_dir: str, tables=SEED_TABLES) -> SeedTables:
    """S1 + S3 + S2 for every seeded table, in foreign-key order: scan ``<csv_dir>/<table>.csv``, drop blank rows, type
    and rename.

    A malformed line, and a row with a value that does not parse (a required one that is empty included), is in no
    table but in ``rejected``: the line itself, or the row as JSON text, with the reasons.
    """
    out, rejected = SeedTables(), []
    for table, columns in tables:
        scan = scan_csv(spark, f"{csv_dir.rstrip('/')}/{table}.csv")
        load = load_typed_checked(drop_blank_rows(scan.rows), columns)
        out[table] = load.rows
        name = F.lit(table).alias("table_name")
        rejected.append(scan.rejected.select(name, F.array(F.lit("malformed line")).alias("reasons"), F.col("line").alias("record")))
        rejected.append(load.rejected.select(name, "reasons", F.to_json(F.struct(*[F.col(quoted(c)) for c in scan.header])).alias("record")))
    out.rejected = reduce(DataFrame.unionByName, rejected)
    return out


def drop_blank_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """S3: drop rows whose every value is blank (NULL or only spaces)."""
    cols = list(columns or df.columns)
    arr = F.array(*[F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in cols])
    return df.filter(F.exists(arr, lambda x: F.trim(x) != ""))
