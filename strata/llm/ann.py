"""Nearest neighbours by stable projections of low dimension, indexed by a kd-tree.

Inner product becomes distance by one more coordinate, sqrt(M^2 - |x|^2) with M the longest norm, 0 for
queries. A Gaussian (2-stable) projection to ``DIMS`` dimensions scales squared distances by a chi-square
variable of DIMS degrees. Candidates come in the order of projected distance and are verified on the
original vectors, until the chi-square test says that an unseen vector as near as the k-th best would,
with probability ``CONFIDENCE``, have come already.

The top of the kd-tree (fitted on a bounded sample) splits the table into cells, and a cell's rows into
blocks; a block's task grows its own subtree. A query visits its home block for a first bound, then all
blocks whose cell may hold something nearer under the test. The queries of a block are split as well, by the
number that visit its cell, and the block's rows go to each part.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import settle, table

K, DIMS, CONFIDENCE = 20, 8, 0.97
#: Rows of a cell and of a block of it (aims), queries that a block sees in one task (aim), rows of a leaf, and the bound of the sample that the top of the tree is fitted on.
CELL, QUERIES, LEAF, SAMPLE, DEEPEST = 8192, 8192, 256, 20_000, 12


def chi2_quantile(p: float, dims: int) -> float:
    """Of an even number of degrees, by bisection of its closed form."""
    lo, hi = 0.0, 1000.0
    for _ in range(80):
        x = (lo + hi) / 2
        cdf = 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))
        lo, hi = (x, hi) if cdf < p else (lo, x)
    return hi


def fit_tree(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(dimension, threshold) of the inner nodes in heap order: medians along the widest dimension."""
    dim, cut = np.zeros(1 << depth, np.int64), np.full(1 << depth, np.inf)
    work = [(1, np.arange(len(points)))]
    while work:
        node, rows = work.pop()
        if node >= 1 << depth or not len(rows):
            continue
        x = points[rows]
        dim[node] = d = int(np.argmax(x.max(0) - x.min(0)))
        cut[node] = np.median(x[:, d])
        left = x[:, d] < cut[node]
        work += [(2 * node, rows[left]), (2 * node + 1, rows[~left])]
    return dim, cut


def cells_of(points: np.ndarray, dim: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    node = np.ones(len(points), np.int64)
    for _ in range(depth):
        node = 2 * node + (points[np.arange(len(points)), dim[node]] >= cut[node])
    return node - (1 << depth)


def cell_boxes(dim: np.ndarray, cut: np.ndarray, depth: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    lo, hi = np.full((2 << depth, dims), -np.inf), np.full((2 << depth, dims), np.inf)
    for node in range(1, 1 << depth):
        lo[2 * node], hi[2 * node], lo[2 * node + 1], hi[2 * node + 1] = lo[node], hi[node], lo[node], hi[node]
        hi[2 * node, dim[node]] = min(hi[2 * node, dim[node]], cut[node])
        lo[2 * node + 1, dim[node]] = max(lo[2 * node + 1, dim[node]], cut[node])
    return lo[1 << depth:], hi[1 << depth:]


def leaves(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    out, work = [], [np.arange(len(points))]
    while work:
        rows = work.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        x = points[rows]
        d = int(np.argmax(x.max(0) - x.min(0)))
        order = np.argpartition(x[:, d], len(rows) // 2)
        work += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
    return out


class Block:
    """The subtree of a block: leaves with the boxes of their projections."""

    def __init__(self, ids, vectors, projected, leaf=LEAF):
        groups = leaves(projected, leaf)
        order = np.concatenate(groups)
        self.ids, self.x = ids[order], vectors[order]
        self.at = np.concatenate([[0], np.cumsum([len(g) for g in groups])])
        self.lo = np.array([projected[g].min(0) for g in groups])
        self.hi = np.array([projected[g].max(0) for g in groups])

    def search(self, query_id, q, qp, k, span, quantile, bound):
        """The best k here as (scores, ids); ``span`` + |q|^2 - 2 score is the squared distance, ``bound`` a known k-th score.

        Leaves come by their least projected distance; the search stops when the next one fails the test."""
        gap = np.maximum(np.maximum(self.lo - qp, qp - self.hi), 0)
        near = (gap * gap).sum(1)
        qq = float(q @ q)
        slack = 4 * len(q) * np.finfo(float).eps * math.sqrt(qq * span)  # what the order of a sum may change of a score
        scores, ids = np.zeros(0), np.zeros(0, np.int64)
        for leaf in np.argsort(near, kind="stable"):
            if near[leaf] > quantile * max(span + qq - 2 * bound, 0):
                break
            a, b = self.at[leaf], self.at[leaf + 1]
            s, i = self.x[a:b] @ q, self.ids[a:b]
            keep = (s >= bound - slack) & (i != query_id)
            if not keep.any():
                continue
            s, i = np.concatenate([scores, (self.x[a:b][keep] * q).sum(1)]), np.concatenate([ids, i[keep]])
            if len(s) > k:
                top = np.lexsort((i, -s))[:k]
                s, i = s[top], i[top]
            scores, ids = s, i
            if len(s) == k:
                bound = max(bound, s.min())
        return scores, ids


def _matrix(values, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float64).reshape(-1, dims) if len(values) else np.zeros((0, dims))


def search(vectors: DataFrame, queries, k: int = K, dims: int = DIMS, confidence: float = CONFIDENCE, cell: int = CELL, seed: int = 11, per_task: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` (vec_id, embedding) that ``queries`` (a column) marks.

    Null ids, vectors that are null, empty, zero or hold null or non-finite components, and vectors whose
    length is not the most frequent one (the longer on a tie) take no part. Repeated rows are candidates
    each, but none of the rows with the query's own id. Fewer than k candidates are all returned, if the test
    lets them be seen: without a bound it never stops. An empty table gives none.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fine = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
            & F.exists("embedding", lambda x: x != 0))
    rows = vectors.filter(fine).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"), queries.alias("asks"))
    lengths = rows.groupBy(F.size("e").alias("d")).agg(F.count("*").alias("n"), F.max(F.aggregate("e", F.lit(0.0), lambda a, x: a + x * x)).alias("m"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if top is None:
        return empty
    width, n, span = top["d"], top["n"], top["m"] * (1 + 1e-12)
    rows = rows.filter(F.size("e") == width)
    rng = np.random.default_rng(seed)
    A = rng.normal(size=(width + 1, dims))
    quantile = chi2_quantile(confidence, dims)

    def project(x, point=True):
        extra = np.sqrt(np.maximum(span - (x * x).sum(1), 0)) if point else np.zeros(len(x))
        return x @ A[:-1] + extra[:, None] * A[-1]

    depth = min(DEEPEST, max(0, math.ceil(math.log2(max(n / cell, 1)))))
    share = min(1.0, SAMPLE / n)
    sample = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))).select("e").collect() if depth else []
    dim, cut = fit_tree(project(np.array([r[0] for r in sample]).reshape(-1, width)), depth)
    lo, hi = cell_boxes(dim, cut, depth, dims)

    def place(batches):
        for b in batches:
            x = np.asarray(b.column(1).flatten(), float).reshape(-1, width)
            raw = x.tobytes()
            step = width * 8
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([raw[i * step:(i + 1) * step] for i in range(len(x))], pa.binary()), b.column(2),
                 pa.array(cells_of(project(x), dim, cut, depth).astype(np.int32)), pa.array(cells_of(project(x, False), dim, cut, depth).astype(np.int32))],
                names=["vec_id", "v", "asks", "cell", "home"])

    placed = settle(rows.mapInArrow(place, "vec_id long, v binary, asks boolean, cell int, home int"), "vectors")
    counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}  # one a cell, at most 2^DEEPEST
    blocks = np.array([-(-counts.get(c, 0) // cell) for c in range(1 << depth)])
    of_cell = lambda x: F.element_at(F.array(*[F.lit(int(v)) for v in np.maximum(x, 1)]), F.col("cell") + 1)
    n_blocks = of_cell(blocks)
    points = placed.select("vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id"), n_blocks).cast("int").alias("block"))
    asked = placed.filter("asks").select(F.col("vec_id").alias("query_id"), "v", "home").dropDuplicates(["query_id"])

    def load(p):
        x = _matrix(p.v.to_list(), width)
        return Block(p.vec_id.to_numpy(np.int64), x, project(x))

    def meet(q: DataFrame, visitors: np.ndarray, *run) -> DataFrame:
        """Cogroups queries with the points of their blocks, in parts by hash of the query; ``visitors`` of a block, by cell."""
        parts = of_cell(-(-visitors // per_task))
        q = q.withColumn("part", F.pmod(F.xxhash64("query_id", F.lit(2)), parts).cast("int"))
        p = points.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        return q.groupBy("cell", "block", "part").cogroup(p.groupBy("cell", "block", "part")).applyInPandas(*run)

    def by_cell(rows: DataFrame) -> np.ndarray:
        """Sums of n of a cell; one row a cell comes to the driver, at most 2^DEEPEST."""
        got = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
        return np.array([got.get(c, 0) for c in range(1 << depth)])

    def first(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        bound = np.full(len(q), -np.inf)
        if len(q) and len(p):
            block, x = load(p), _matrix(q.v.to_list(), width)
            xp = project(x, False)
            for i, query in enumerate(q.query_id.to_numpy()):
                s, _ = block.search(query, x[i], xp[i], k, span, quantile, -np.inf)
                bound[i] = s.min() if len(s) == k else -np.inf
        return pd.DataFrame({"query_id": q.query_id, "v": q.v, "bound": bound})

    def every(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        block, x, out = load(p), _matrix(q.v.to_list(), width), []
        xp = project(x, False)
        for i, (query, bound) in enumerate(zip(q.query_id.to_numpy(), q.bound.to_numpy())):
            s, ids = block.search(query, x[i], xp[i], k, span, quantile, bound)
            out.append((np.full(len(s), query), ids, s))
        a, b, c = (np.concatenate(z) for z in zip(*out))
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": c})

    def reach(b):
        """(query, cell): whether the cell's box passes the test."""
        x = _matrix(b.column(1).to_pylist(), width)
        xp, bound = project(x, False), b.column(2).to_numpy()
        gap = np.maximum(np.maximum(lo[None] - xp[:, None], xp[:, None] - hi[None]), 0)
        return ((gap * gap).sum(2) <= (quantile * np.maximum(span + (x * x).sum(1) - 2 * bound, 0))[:, None]) & (blocks > 0)[None]

    def visitors(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(1 << depth, dtype=np.int32)), pa.array(reach(b).sum(0).astype(np.int64))], names=["cell", "n"])

    def visits(batches):
        """The blocks that a query still has to see."""
        for b in batches:
            q, c = np.nonzero(reach(b))
            each = np.repeat(np.arange(len(q)), blocks[c])
            at = np.arange(len(each)) - np.repeat(np.cumsum(blocks[c]) - blocks[c], blocks[c])
            t = b.take(pa.array(q[each]))
            yield pa.RecordBatch.from_arrays([*t.columns, pa.array(c[each].astype(np.int32)), pa.array(at.astype(np.int32))], names=["query_id", "v", "bound", "cell", "block"])

    # home: the query's own cell, or the first with rows; one of its blocks by hash
    some = int(np.flatnonzero(blocks)[0])
    homes = F.element_at(F.array(*[F.lit(int(c if blocks[c] else some)) for c in range(1 << depth)]), F.col("home") + 1)
    starts = asked.withColumn("cell", homes).withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(1)), n_blocks).cast("int"))
    share = -(-by_cell(starts.select("cell", F.lit(1).alias("n"))) // np.maximum(blocks, 1))
    bounds = settle(meet(starts, share, first, "query_id long, v binary, bound double"), "bounds")
    pairs = bounds.mapInArrow(visits, "query_id long, v binary, bound double, cell int, block int")
    found = meet(pairs, by_cell(bounds.mapInArrow(visitors, "cell int, n long")), every, "query_id long, vec_id long, score double")
    best = lambda df, *by: df.groupBy(*by).agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("m"), F.col("vec_id")))), 1, k).alias("t")).select(
        "query_id", F.posexplode("t").alias("i", "t")).select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), (-F.col("t.m")).alias("score"))
    return best(best(found.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(64))), "query_id", "part"), "query_id")


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)
