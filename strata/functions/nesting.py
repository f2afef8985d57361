"""Nesting child rows into arrays, in a fixed number of chunks per parent.

``collect_list`` puts a whole group into one task and one value.  With ``chunks``
> 1 every parent's children are dealt to that many chunks by a hash of the
child's fields, whatever their number, and each chunk is built by its own task;
the layout is the same for every parent and needs no count of the children.  With
one chunk (the default) a parent has one array, as the plain nested form.

The chunk of a child is a pure function of its values, so recomputing a lost
task reproduces the same chunks.  Children that are exact duplicates share a
chunk; include the child's own key in ``fields`` to keep chunks balanced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunked_collect(child: DataFrame, key: str, fields: Sequence[str], name: str,
                    chunks: int = 1, chunk_col: str | None = None) -> DataFrame:
    """One row per (``key``, non-empty chunk): ``name`` = sorted ``ARRAY<STRUCT<fields>>``.

    Returns columns ``key``, ``chunk_col`` (default ``<name>_chunk``) and
    ``name``.  Concatenating a key's chunks gives all of its children.  A NULL key
    is one group, as in a plain ``groupBy``.
    """
    if chunks < 1:
        raise ValueError("chunks must be positive")
    chunk_col = chunk_col or f"{name}_chunk"
    item = F.struct(*[F.col(f) for f in fields])
    chunk = F.lit(0) if chunks == 1 else F.pmod(F.xxhash64(item), F.lit(chunks)).cast("int")
    return (child.select(F.col(key), item.alias("_item"), chunk.alias(chunk_col))
            .groupBy(key, chunk_col).agg(F.array_sort(F.collect_list("_item")).alias(name)))
