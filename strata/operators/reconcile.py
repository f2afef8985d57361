"""Table reconciliation, dataset digests, assertions.

Every check is a distributive aggregate: partial results are combined
map-side and only one small row per check crosses the network.  Source and
target are tagged and unioned, then aggregated once -- no join of the two
tables and no cross join of their aggregates.

Dataset digest (A5).  The row hash is the loader's:
``md5(concat_ws('||', every column as text))`` (``concat_ws`` skips NULLs,
so (NULL,'a') and ('a',NULL) hash alike).  A single md5 over every row hash
in key order is a sequential fold through one task; at 100 TB that is not an
option.  The digest here is a multiset hash: the count and the sums of the
four 32-bit words of every row hash (as DECIMAL, no overflow), folded into one
md5.  It is order-free, sensitive to duplicates, computed with partial
aggregation, and identical however the table is partitioned.  ``bucket_digests``
gives the same digest per key bucket to locate where two tables differ.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.file_md5 import file_md5


# Type-name fragments that make a column numeric for checks.
NUMERIC_MARKERS = ("INT", "NUMERIC", "FLOAT", "DOUBLE", "DECIMAL", "REAL")
# Roll-up statuses.
SUCCESS, FAILED, NO_ENTITIES = "SUCCESS", "FAIL", "NO_ENTITIES"
# Integers are summed as decimals: a BIGINT sum overflows on large tables, and
# 10^28 leaves room for 10^10 rows of the widest BIGINT (more of narrower ones).
SUM_TYPE = "decimal(28,0)"


class HashMismatch(AssertionError):
    """Raised when a dataset digest differs from the expected one."""


def row_hash(df: DataFrame, columns: Sequence[str] | None = None,
             null_safe: bool = False) -> Column:
    """md5 of the row's values joined by ``||``.

    ``null_safe=True`` writes a marker for NULL so that NULL positions count.
    """
    cols = list(columns or df.columns)
    parts = [F.col(c).cast("string") for c in cols]
    if null_safe:
        parts = [F.coalesce(p, F.lit("\\N")) for p in parts]
    return F.md5(F.concat_ws("||", *parts))


def _words(h: Column) -> list[Column]:
    return [F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")
            for i in range(4)]


def _digest_aggs(h: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("n")] + [
        F.sum(w).alias(f"w{i}") for i, w in enumerate(_words(h))]


def _fold(prefix: str = "") -> Column:
    return F.md5(F.concat_ws(":", *[F.col(f"{prefix}{c}").cast("string")
                                    for c in ("n", "w0", "w1", "w2", "w3")]))


def dataset_digest(df: DataFrame, columns: Sequence[str] | None = None,
                   null_safe: bool = False) -> DataFrame:
    """A5: one row ``(n_rows, dataset_hash)`` for the whole table."""
    h = row_hash(df, columns, null_safe)
    return (df.select(h.alias("_h")).agg(*_digest_aggs(F.col("_h")))
              .select(F.col("n").alias("n_rows"), _fold().alias("dataset_hash")))


def bucket_digests(df: DataFrame, key: str, buckets: int,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Digest per ``pmod(xxhash64(key), buckets)``: compare two tables bucket by
    bucket to find where they differ without moving their rows."""
    h = row_hash(df, columns)
    b = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets))
    return (df.select(b.alias("bucket"), h.alias("_h")).groupBy("bucket")
              .agg(*_digest_aggs(F.col("_h")))
              .select("bucket", F.col("n").alias("n_rows"), _fold().alias("digest")))


def assert_digest(df: DataFrame, expected: str, columns: Sequence[str] | None = None) -> str:
    """Compute the digest and raise ``HashMismatch`` when it differs."""
    got = dataset_digest(df, columns).first()["dataset_hash"]
    if got != expected:
        raise HashMismatch(f"dataset hash mismatch: expected {expected}, got {got}")
    return got


def _tagged(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    s = source.select(*columns, F.lit(True).alias("_src"))
    t = target.select(*columns, F.lit(False).alias("_src"))
    return s.unionByName(t)


def check_row_count(source: DataFrame, target: DataFrame) -> DataFrame:
    """A2: ``(source_rows, target_rows, row_count_ok)`` in one pass, threshold 0."""
    both = _tagged(source, target, [])
    return both.agg(F.count_if(F.col("_src")).alias("source_rows"),
                    F.count_if(~F.col("_src")).alias("target_rows")).withColumn(
        "row_count_ok", F.col("source_rows") == F.col("target_rows"))


def is_numeric(type_text: str) -> bool:
    """Substring test on the type name, as in the contract checks."""
    up = (type_text or "").upper()
    return any(m in up for m in NUMERIC_MARKERS)


def _spark_numeric(dtype) -> bool:
    return isinstance(dtype, T.NumericType)


def column_aggregates(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """A3 one side: ``(column_name, agg, value DOUBLE, exact STRING)`` rows.

    ``count(*)`` once, ``count(col)`` for every column, ``sum/min/max`` for
    numeric ones (by contract type text when given, else Spark type).  ``exact`` is the value in its own
    type, as text: whole numbers beyond 2^53 and decimals, which a DOUBLE rounds, compare by it.
    """
    specs: list[tuple[str, str, Column]] = [("*", "count", F.count(F.lit(1)))]
    for f in df.schema.fields:
        specs.append((f.name, "count", F.count(F.col(_q(f.name)))))
        numeric = is_numeric(types[f.name]) if types and f.name in types else _spark_numeric(
            f.dataType)
        if numeric:
            c = F.col(_q(f.name))
            wide = c.cast(SUM_TYPE) if isinstance(f.dataType, T.IntegralType) else c
            specs += [(f.name, "sum", F.sum(wide)), (f.name, "min", F.min(c)),
                      (f.name, "max", F.max(c))]
    row = df.agg(*[e.alias(f"a{i}") for i, (_, _, e) in enumerate(specs)])
    stack = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(a).alias("agg"),
                               F.col(f"a{i}").cast("double").alias("value"), F.col(f"a{i}").cast("string").alias("exact"))
                      for i, (c, a, _) in enumerate(specs)])
    return row.select(F.inline(stack))


def _check_specs(df: DataFrame, types: Mapping[str, str] | None):
    specs = [("*", "count", None)]
    for f in df.schema.fields:
        specs.append((f.name, "count", f.name))
        numeric = is_numeric(types[f.name]) if types and f.name in types else _spark_numeric(
            f.dataType)
        if numeric:
            specs += [(f.name, "sum", f.name), (f.name, "min", f.name), (f.name, "max", f.name)]
    return specs


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def check_columns(source: DataFrame, target: DataFrame,
                  types: Mapping[str, str] | None = None,
                  rel_tol: float = 1e-9) -> DataFrame:
    """A3: column aggregates of both sides side by side with a verdict.

    Both tables are tagged and unioned and ONE aggregate computes every
    (column, agg) for each side (``count_if`` / ``sum(CASE WHEN side ...)``):
    one pass, partial aggregation, no join.  Source columns missing from the
    target count as NULL.  Counts, minima, maxima and sums of integers and
    decimals compare exactly, in their own type; only sums of floating numbers
    (or of text taken as such) get a relative tolerance, because the order of
    addition differs between runs.  NULL aggregates compare null-safely.  The
    values are shown as DOUBLE.  Expressions are written as SQL text: one JVM
    call per aggregate keeps plan building fast for wide tables.
    """
    specs = _check_specs(source, types)
    cols = source.columns
    tcols = set(target.columns)
    s = source.selectExpr(*[_q(c) for c in cols], "true AS _src")
    t = target.selectExpr(*[_q(c) if c in tcols else f"NULL AS {_q(c)}" for c in cols],
                          "false AS _src")
    both = s.unionByName(t)
    kinds = {f.name: f.dataType for f in both.schema.fields}
    aggs, oks = [], []
    for i, (c, a, col) in enumerate(specs):
        kind = kinds.get(col)
        value = None if col is None else _q(col)
        if a == "sum" and isinstance(kind, T.IntegralType):
            value = f"CAST({value} AS {SUM_TYPE})"
        for side, flag in (("s", "_src"), ("t", "NOT _src")):
            e = f"count_if({flag})" if col is None else f"{a}(CASE WHEN {flag} THEN {value} END)"
            aggs.append(F.expr(f"{e} AS {side}{i}"))
        exact = f"s{i} <=> t{i}"
        loose = a == "sum" and not isinstance(kind, (T.IntegralType, T.DecimalType))
        oks.append(f"{exact} OR coalesce(abs(s{i} - t{i}) <= greatest(abs(s{i}), abs(t{i})) "
                   f"* {rel_tol!r}, false)" if loose else exact)
    row = both.agg(*aggs)
    stack = ", ".join(
        f"named_struct('column_name', {_lit(c)}, 'agg', {_lit(a)}, "
        f"'source_value', CAST(s{i} AS DOUBLE), 'target_value', CAST(t{i} AS DOUBLE), "
        f"'ok', {ok})" for i, ((c, a, _), ok) in enumerate(zip(specs, oks)))
    return row.selectExpr(f"inline(array({stack}))")


def reconcile(pairs: Mapping[str, tuple[DataFrame, DataFrame]],
              types: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """A4: per table SUCCESS iff row count and every column check pass.

    One aggregate pass per side: the row counts are the ``count(*)`` entries
    of the column check.  Returns ``(table_name, source_rows, target_rows,
    row_count_ok, columns_ok, status)``.
    """
    frames = []
    for name, (src, tgt) in pairs.items():
        cc = check_columns(src, tgt, (types or {}).get(name))
        star = (F.col("column_name") == "*") & (F.col("agg") == "count")
        frames.append(cc.agg(
            F.max(F.when(star, F.col("source_value"))).cast("bigint").alias("source_rows"),
            F.max(F.when(star, F.col("target_value"))).cast("bigint").alias("target_rows"),
            F.bool_and(F.when(star, F.col("ok"))).alias("row_count_ok"),
            F.bool_and("ok").alias("columns_ok"),
        ).select(F.lit(name).alias("table_name"), "source_rows", "target_rows", "row_count_ok",
                 "columns_ok"))
    if not frames:
        raise ValueError("no table pairs")
    out = reduce(lambda a, b: a.unionByName(b), frames)
    ok = F.col("row_count_ok") & F.col("columns_ok")
    return out.withColumn("status", F.when(ok, F.lit(SUCCESS)).otherwise(F.lit(FAILED)))


def overall_status(per_table: DataFrame | None) -> str:
    """A4 roll-up: SUCCESS iff every table succeeded; no tables -> NO_ENTITIES."""
    if per_table is None:
        return NO_ENTITIES
    r = per_table.agg(F.count(F.lit(1)).alias("n"),
                      F.bool_and(F.col("status") == SUCCESS).alias("ok")).first()
    if r["n"] == 0:
        return NO_ENTITIES
    return SUCCESS if r["ok"] else FAILED


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for each table, one union job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their multiplicity."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, n_null)`` for the given columns, one pass."""
    cols = list(columns or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_null"))
                      for i, c in enumerate(cols)])
    return row.select(F.inline(stack))


def file_checksums(spark, path_glob: str) -> DataFrame:
    """D14 one side: ``(file_name, size, md5)`` per file, its bytes streamed, so of any size.

    ``file_name`` is the path below the folder that the glob starts from, so files
    of one name in different subfolders stay apart.
    """
    fixed = re.split(r"[*?\[{]", path_glob, maxsplit=1)
    root = (fixed[0].rsplit("/", 1)[0] if len(fixed) > 1 else path_glob.rstrip("/")) + "/"
    root = re.sub(r"^[a-z0-9]+:/*", "/", root)
    below = F.substring_index(F.col("path"), root, -1)
    name = F.when(F.col("path").contains(root), below).otherwise(
        F.element_at(F.split(F.col("path"), "/"), -1))
    out = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path_glob)
           .select(name.alias("file_name"),
                   F.col("length").alias("size"), file_md5(spark, F.col("path")).alias("md5")))
    # a file that the session lets its readers ignore has no row
    flags = ("spark.sql.files.ignoreMissingFiles", "spark.sql.files.ignoreCorruptFiles")
    return out.filter(F.col("md5").isNotNull()) if any(spark.conf.get(c).lower() == "true" for c in flags) else out


def compare_checksums(source: DataFrame, target: DataFrame) -> DataFrame:
    """Full outer join on the path below each root; status MATCH / DIFFERENT / MISSING / EXTRA."""
    s = source.select("file_name", F.col("md5").alias("source_md5"))
    t = target.select("file_name", F.col("md5").alias("target_md5"))
    j = s.join(t, "file_name", "full_outer")
    return j.withColumn(
        "status",
        F.when(F.col("target_md5").isNull(), F.lit("MISSING"))
        .when(F.col("source_md5").isNull(), F.lit("EXTRA"))
        .when(F.col("source_md5") == F.col("target_md5"), F.lit("MATCH"))
        .otherwise(F.lit("DIFFERENT")))
