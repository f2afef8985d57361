"""Filter interaction audit: contingency tensors of filter outcomes, contracted for every order of the filters.

Spark's expressions judge every document by five filters and count the outcomes of each part in 32 cells.
A part's cells are a 2x2x2x2x2 tensor, one axis a filter, with 0 for pass and 1 for fail. What an order of
the filters does at one of its steps is a contraction of that tensor with one vector an axis: (1, 0) selects
what passes, (0, 1) what fails and (1, 1) all. One ``einsum`` gives a figure for all orders and steps.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import pick, table

FILTERS = "ABCDE"
# Fixed values of the contract.
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
WORD, CAPITAL, SIGN = r"[^\x20\x09-\x0D]+", "[A-Z]", "[#$%&*|]"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def outcomes(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, a, b, c, d) of each row; a to d tell whether the filter fails the text, by that text alone."""
    rows = pick(docs, "doc_id", "text", "lang").select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("w", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    n = F.size("w")
    return rows.select(
        "doc_id", "part", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        (n < MIN_WORDS).alias("a"), (100 * F.size(F.array_distinct("w")) < DISTINCT_PERCENT * n).alias("b"),
        (100 * F.regexp_count("text", F.lit(CAPITAL)) > CAPITAL_PERCENT * F.length("text")).alias("c"), F.col("text").rlike(SIGN).alias("d"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, a, b, c, d, e, n, good, toxic): rows of each part and outcome, and how many are labelled good or toxic.

    Filter E fails a row whose text a smaller doc_id has too. Rows of equal texts are first counted by part and label,
    with the least id and how many rows hold it, so a text that a third of the rows share leaves a few rows; no
    row goes back to its text. A null doc_id has no label and is smaller or larger than none, so E passes it.
    An id that is labelled twice is good, or toxic, if one of its labels says so.
    """
    rows = outcomes(docs)
    marks = pick(labels, "doc_id", "quality", "toxic").filter("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    mark = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    kind = ["part", "a", "b", "c", "d", "good", "toxic"]
    known = rows.filter("doc_id is not null").join(marks, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "digest", "part", "a", "b", "c", "d", mark("good"), mark("toxic"))
    copies = known.groupBy("doc_id", "digest", *kind).agg(F.count("*").alias("n")).groupBy("digest", *kind).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("held"))
    first = F.col("least") == F.min("least").over(Window.partitionBy("digest"))  # one row a part and label
    judged = copies.withColumn("kept", F.when(first, F.col("held")).otherwise(0)).select(*kind, F.explode(F.array(
        F.struct(F.lit(False).alias("e"), F.col("kept").alias("n")), F.struct(F.lit(True).alias("e"), (F.col("n") - F.col("kept")).alias("n")))).alias("x"))
    nameless = rows.filter("doc_id is null").groupBy("part", "a", "b", "c", "d").agg(F.count("*").alias("n"))
    both = judged.select(*kind, "x.e", "x.n").union(nameless.select("part", "a", "b", "c", "d", F.lit(False), F.lit(False), F.lit(False), "n"))
    return both.groupBy("part", "a", "b", "c", "d", "e").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def order_figures(counts: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order and step.

    The three tensors have one axis a filter, of length 2.
    """
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = [(o, k) for o in orders for k in range(len(FILTERS))]

    def contract(tensor, select) -> np.ndarray:  # select(order, step, filter's place in the order) -> vector
        v = np.array([[select(o, k, o.index(f)) for f in FILTERS] for o, k in steps], dtype=np.int64)
        return np.einsum("abcde,na,nb,nc,nd,ne->n", tensor, *v.transpose(1, 0, 2), optimize=True)

    here = lambda o, k, at: PASS if at < k else FAIL if at == k else ALL
    kept = contract(counts, lambda o, k, at: PASS if at <= k else ALL)
    removed, good_lost, toxic_lost = (contract(t, here) for t in (counts, good, toxic))
    failing = contract(counts, lambda o, k, at: FAIL if at == k else ALL)
    unique = contract(counts, lambda o, k, at: FAIL if at == k else PASS)
    shapley = dict.fromkeys(FILTERS, 0)
    for (o, k), x in zip(steps, removed.tolist()):
        shapley[o[k]] += x
    return [(o, k + 1, *row, shapley[o[k]]) for (o, k), row in zip(steps, zip(
        *(x.tolist() for x in (kept, removed, failing - removed, unique, good_lost, toxic_lost))))]


COLUMNS = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COLUMNS[2:])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): a row for each
    part, order of the filters and step, zeros included.

    A null text counts as empty, a null lang as the part with the empty name; repeated rows count as often as they
    occur; without documents there are no rows; other columns are not read. A part's tensor has 32 cells.
    """
    def solve(part: pd.DataFrame) -> pd.DataFrame:
        t = np.zeros((3,) + (2,) * len(FILTERS), np.int64)
        at = tuple(part[f.lower()].to_numpy(dtype=np.int64) for f in FILTERS)
        for i, c in enumerate(("n", "good", "toxic")):
            t[(i, *at)] = part[c].to_numpy(dtype=np.int64)
        out = pd.DataFrame(order_figures(*t), columns=COLUMNS)
        out.insert(0, "part", part["part"].iloc[0])
        return out

    return cells(docs, labels).groupBy("part").applyInPandas(solve, SCHEMA)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
f AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
s AS (SELECT filter_order, step::INT AS step, filter_order[step] AS here, filter_order[1:step - 1] AS before
      FROM o, range(1, 6) r(step)),
r AS (
  SELECT part, filter_order, step, here,
         sum(CASE WHEN translate(before || here, fails, '') = before || here THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN contains(fails, here) AND translate(before, fails, '') = before THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN contains(fails, here) AND translate(before, fails, '') <> before THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = here THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN contains(fails, here) AND translate(before, fails, '') = before THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN contains(fails, here) AND translate(before, fails, '') = before THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, here))::BIGINT AS shapley
FROM r
"""
