"""Row access by sets of principals.

Attributes that are granted to the same principals share one number.  Rows carry the number of their attribute, so there is one row a
row, and a dictionary lists each set's principals once, however many rows or attributes have it.  Sets are told apart by a
fingerprint that combines in every task (count, sum and exclusive or of two hashes), so no set is ever gathered in one place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCESS = "access_set"


@dataclass
class Access:
    """``rows`` with ``access_set`` (NULL where nobody may read), ``sets`` ``(access_set, principal)``."""
    rows: DataFrame
    sets: DataFrame


def set_numbers(grants: DataFrame, grant_attr: str, principal: str = "principal") -> DataFrame:
    """``(attribute, access_set)``: a number for each granted attribute, equal where the principals are."""
    g = grants.select(F.col(grant_attr).alias("attribute"), F.col(principal).alias("_p")).dropna().distinct()
    one, two = F.xxhash64("_p"), F.xxhash64(F.lit("2"), "_p")
    prints = g.groupBy("attribute").agg(F.count("*").alias("n"), F.sum(one.cast("decimal(20,0)")).alias("s"), F.bit_xor(two).alias("x"))
    return prints.select("attribute", F.md5(F.concat_ws(":", F.col("n").cast("string"), F.col("s").cast("string"), F.col("x").cast("string"))).alias(ACCESS))


def row_access_sets(rows: DataFrame, grants: DataFrame, rows_attr: str, grant_attr: str, principal: str = "principal") -> Access:
    """Number the rows by who may read them.  NULL attributes and principals grant nothing; repeated grants count once."""
    numbers = set_numbers(grants, grant_attr, principal)
    numbered = rows.join(numbers, rows[rows_attr] == numbers["attribute"], "left").drop("attribute")
    one = numbers.groupBy(ACCESS).agg(F.min("attribute").alias("attribute"))  # any attribute of the set
    sets = grants.join(one, grants[grant_attr] == one["attribute"]).select(ACCESS, F.col(principal)).dropna().distinct()
    return Access(numbered, sets)


def rows_of(access: Access, who, principal: str = "principal") -> DataFrame:
    """The rows that one principal may read."""
    mine = access.sets.filter(F.col(principal) == F.lit(who)).select(ACCESS)
    return access.rows.join(mine, ACCESS, "left_semi").drop(ACCESS)
