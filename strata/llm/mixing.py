"""Mixing sources to target weights, in DataFrame functions only.

Every source gets a weight and a target in words. A document's order within its source is a
random key: an MD5 of a seed and its id. The key's leading bits cut a source into ranges, a small
aggregate of (source, range) gives each range its offset, and a running sum inside a range
completes the prefix sum, so no task sorts a whole source. The source's words are then cut at its
exact target: all documents are taken ``floor(target / size)`` times, and in the last epoch the
document at the cut gives only the words up to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import pick, table

# Fixed values of the contract: weights repeat over the sources by name; a source counts thrice at most.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = 1.0) -> DataFrame:
    """``sizes`` (src, source_size) with ``target``: weights' shares of ``share`` of all words, at most
    ``max_epochs`` times the source, the excess going to the others by weight.

    The fixed point is water-filling: sources in the order of cap / weight are capped as long as the
    rest's level stays above them. Runs over one row a source.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("src").asc_nulls_last())
    w = sizes.withColumn("i", F.row_number().over(by_name) - 1).withColumn(
        "w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("i") % n + 1).cast("int"))).withColumn(
        "cap", F.col("source_size").cast("double") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("i"))
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("i")
    w = w.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share))).withColumn(
        "level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    w = w.withColumn("open", F.col("cap") / F.col("w") >= F.col("level"))
    level = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), F.col("i"), F.col("level")))).over(everything)["level"]
    return w.withColumn("lambda", level).select(
        "src", "source_size",
        F.when(F.col("lambda").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("lambda") * F.col("w"))).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = 1.0,
        seed: str = "mix-1", bits: int = 12) -> DataFrame:
    """(doc_id, source, size, source_size, target, epochs, taken) for every row of ``docs``.

    ``taken`` counts the words the mix takes of a document, repeats included; it never exceeds
    ``max_epochs`` times ``size``. A null text has size 0 and is taken 0 times; a null source is a
    source of its own and the last one; a null doc_id orders like an empty one. Ties of the key
    (repeated ids) go by size, so equal rows may swap but the result is the same. An empty table gives none.
    """
    rows = pick(docs, "doc_id", "text", "source").select(
        "doc_id", F.col("source").alias("src"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"))
    rows = rows.withColumn("range", F.substring("key", 1, max(1, bits // 4)))
    cut = rows.groupBy("src", "range").agg(F.sum("size").alias("n"))
    source = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    aims = targets(cut.groupBy("src").agg(F.sum("n").alias("source_size")), weights, max_epochs, share)
    offsets = cut.select("src", "range", F.coalesce(F.sum("n").over(source), F.lit(0)).alias("base"))
    offsets = offsets.alias("o").join(aims.alias("t"), F.col("o.src").eqNullSafe(F.col("t.src"))).select(
        F.col("o.src").alias("osrc"), F.col("range").alias("orange"), "base", "source_size", "target")
    inside = Window.partitionBy("src", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    run = rows.withColumn("run", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = run.join(offsets, F.col("src").eqNullSafe(F.col("osrc")) & (F.col("range") == F.col("orange")))
    goal = F.floor(F.col("target")).cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(F.lit(0))
    joined = joined.withColumn("epochs", whole.cast("long")).withColumn("left", goal - F.col("epochs") * F.col("source_size"))
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("base") - F.col("run")))
    return joined.select("doc_id", F.col("src").alias("source"), "size", "source_size", "target", "epochs",
                         (F.col("epochs") * F.col("size") + last).alias("taken"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source AS src, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM {docs}),
s AS (SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY src NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM s),
it AS (
  SELECT 0 AS step, src, source_size, w, false AS capped, 0.0::DOUBLE AS target FROM w
  UNION ALL
  SELECT step + 1, src, source_size, w, aim > 3.0 * source_size OR capped,
         CASE WHEN capped OR aim > 3.0 * source_size THEN 3.0 * source_size ELSE aim END
  FROM (SELECT *, w * (sum(source_size::DOUBLE) OVER ()
                  - coalesce(sum(CASE WHEN capped THEN 3.0 * source_size END) OVER (), 0))
                  / nullif(sum(CASE WHEN NOT capped THEN w END) OVER (), 0) AS aim FROM it)
  WHERE step <= (SELECT count(*) FROM w)),
t AS (SELECT src, source_size, target FROM it WHERE step = (SELECT max(step) FROM it)),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             coalesce(sum(d.size) OVER (PARTITION BY d.src ORDER BY d.key, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
             CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT // t.source_size ELSE 0 END AS epochs
      FROM d JOIN t ON d.src IS NOT DISTINCT FROM t.src)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM r
"""
ORACLE_SQL = _SQL.replace("{docs}", "documents")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of ``docs``: which words to take of each document, in (doc_id, source, ..., taken)."""
    return mix(docs)
