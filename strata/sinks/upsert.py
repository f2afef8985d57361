"""K1, K2, K8: keyed upserts as set-wise merges.

The batch is first reduced to one row per key (latest by an order column)
with a partial aggregate (``max_by``), so a key repeated across a third of
the batch collapses map-side before any shuffle.  After that both sides of
the merge hold unique keys, so the merge joins cannot be skewed; see
``upsert`` for how a small batch avoids shuffling the target at all.

Modes:

``non_empty`` (K1)
    Only non-empty batch values are written: an update keeps the old value
    where the batch has ``''`` or NULL.
``replace`` (K2)
    A matched key takes the batch row as is (NULLs included).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_per_key(batch: DataFrame, key: Sequence[str] | str,
                   order_by: str | None = None) -> DataFrame:
    """One row per key; the row with the greatest ``order_by`` wins.

    Without an order column the greatest row wins, its columns compared from left to right (NULLs are
    least): Spark has no arrival order, and so a rerun keeps the same row.  Columns that cannot be ordered (maps,
    variants) need an ``order_by`` if keys repeat.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in batch.columns if c not in keys]
    if order_by is None:
        if not others or not all(_ordered(batch.schema[c].dataType) for c in others):
            return batch.dropDuplicates(keys)
        return (batch.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in others])).alias("_row"))
                .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in batch.columns]))
    packed = F.struct(*[F.col(c) for c in others])
    return (batch.groupBy(*keys)
            .agg(F.max_by(packed, F.col(order_by)).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]))


def _ordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind.fields)
    return not isinstance(kind, T.MapType | T.VariantType)


def _blank(c: Column, dtype) -> Column:
    if isinstance(dtype, T.StringType):
        return c.isNull() | (c == F.lit(""))
    return c.isNull()


def _keys_given(batch: DataFrame, keys: Sequence[str]) -> Column:
    """True, or an error for a row with a NULL key."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | batch[k].isNull()
    return F.when(missing, F.raise_error(F.lit(f"upsert: NULL key in {', '.join(keys)}"))
                  .cast("boolean")).otherwise(F.lit(True))


def upsert(target: DataFrame, batch: DataFrame, key: Sequence[str] | str,
           mode: str = "non_empty", order_by: str | None = None) -> DataFrame:
    """Merge ``batch`` into ``target`` by ``key``; returns the new table state.

    Columns present only in the target keep their values; batch-only columns
    are added (NULL for untouched rows).  A batch row with a NULL key is refused
    (the job fails): it would match nothing and be inserted again at each merge.

    Plan: updates are ``target LEFT JOIN batch`` and inserts are the batch
    keys that no target key matches (a semi join of the target's key column
    with the batch, then an anti join of the batch with that small result).
    Unlike one full outer join -- which can never broadcast -- a batch small
    enough to broadcast (by plan statistics or AQE's measured size) leaves the
    huge target unshuffled; a large batch falls back to sort-merge joins.
    """
    keys = [key] if isinstance(key, str) else list(key)
    b = latest_per_key(batch.filter(_keys_given(batch, keys)), keys, order_by)
    if order_by and order_by not in target.columns:
        b = b.drop(order_by)
    t_types = {f.name: f.dataType for f in target.schema.fields}
    b_types = {f.name: f.dataType for f in b.schema.fields}
    cols = list(target.columns) + [c for c in b.columns if c not in t_types]
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns])
    n = b.select(*[F.col(c).alias(f"n_{c}") for c in b.columns], F.lit(True).alias("_in_n"))
    cond = None
    for k in keys:
        c = t[f"t_{k}"] == n[f"n_{k}"]
        cond = c if cond is None else cond & c
    updated = t.join(n, cond, "left")
    out = []
    for c in cols:
        if c in keys or c not in b_types:
            v = F.col(f"t_{c}")
        elif c not in t_types:
            v = F.col(f"n_{c}")
        elif mode == "replace":
            v = F.when(F.col("_in_n").isNotNull(), F.col(f"n_{c}")).otherwise(F.col(f"t_{c}"))
        elif mode == "non_empty":
            newv = F.col(f"n_{c}")
            v = F.when(_blank(newv, b_types[c]), F.col(f"t_{c}")).otherwise(newv)
        else:
            raise ValueError(f"unknown upsert mode {mode!r}")
        out.append(v.cast(t_types.get(c) or b_types[c]).alias(c))
    matched = target.select(*keys).join(b.select(*keys), keys, "left_semi")
    inserts = b.join(matched, keys, "left_anti").select(*[
        (F.col(c) if c in b_types else F.lit(None)).cast(t_types.get(c) or b_types[c]).alias(c)
        for c in cols])
    return updated.select(*out).unionByName(inserts)


def merge_bucketed(spark, target_table: str, batch: DataFrame, key: str, new_table: str,
                   buckets: int, mode: str = "non_empty",
                   order_by: str | None = None) -> None:
    """K1 / K2 into a catalog table bucketed by ``key``; writes ``new_table``.

    A target stored bucketed by the key (``bucketBy(buckets, key)``) is read
    bucket by bucket in place: the merge joins need no shuffle of the target,
    only the batch is shuffled into the same buckets.  The new version is
    written bucketed the same way, so the next merge is co-located too.  Read
    and write tables differ (swap names afterwards, or keep versions).
    """
    keys = [key]
    merged = upsert(spark.table(target_table), batch, keys, mode=mode, order_by=order_by)
    (merged.write.mode("overwrite").bucketBy(int(buckets), key).sortBy(key)
     .saveAsTable(new_table))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """First version of a bucketed target for ``merge_bucketed``."""
    df.write.mode("overwrite").bucketBy(int(buckets), key).sortBy(key).saveAsTable(table)


def apply_actions(target: DataFrame, actions: DataFrame, key: str, payload: str,
                  seq: str, into: str | None = None) -> DataFrame:
    """K8: set ``into`` (default ``payload``) to the last action's payload per id.

    An action for an unknown id is a no-op (left join), as for an UPDATE; a NULL
    payload sets NULL.  An action without a sequence number is ignored.
    """
    into = into or payload
    last = (actions.filter(F.col(seq).isNotNull()).groupBy(key)
            .agg(F.max_by(F.col(payload), F.col(seq)).alias("_payload"))
            .withColumn("_hit", F.lit(True)))
    joined = target.join(last, on=key, how="left")
    cols = [F.when(F.col("_hit"), F.col("_payload")).otherwise(F.col(c)).cast(
        dict((f.name, f.dataType) for f in target.schema.fields)[c]).alias(c)
        if c == into else F.col(c) for c in target.columns]
    return joined.select(*cols)
