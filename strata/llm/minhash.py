"""Near-duplicate groups by ProbMinHash, banding and exact verification.

Each shingle is a Poisson process whose rate is its weight: its arrivals fall on random registers,
each register keeps its earliest arrival, and a shingle stops as soon as its next arrival comes
later than the latest register (early termination). Two texts agree in a register with
the probability Jaccard similarity of their weighted shingles. Registers are banded; members of a
bucket are verified on their whole shingle sets, first against the bucket's least member, then,
where a bucket still holds several components, all across components in blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BASE, U64, buffers, mix64, pieces, prefix_hash, settle, signed, span_hash, table, words
from strata.llm.graph import components

WORDS, SIMILARITY = 5, 0.8
#: 25 bands of 4 registers: a pair at similarity 0.8 shares no bucket with probability (1 - 0.8^4)^25 < 2e-6.
BANDS, ROWS = 25, 4
BLOCK = 1000


def shingles(data: np.ndarray, off: np.ndarray, n: int = WORDS):
    """(row, hash, count) of the distinct word n-grams of each row, sorted by row and hash.

    A row of 1 to n-1 words has one shingle, all its words; a row without words has none.
    """
    starts, ends, row = words(data, off)
    w = span_hash(prefix_hash(data), starts, ends)
    at = np.searchsorted(row, np.arange(len(off)))
    size = at[1:] - at[:-1]
    first = np.flatnonzero(row[:max(0, len(row) - n + 1)] == row[n - 1:]) if len(row) >= n else np.zeros(0, np.int64)
    h = np.zeros(len(first), U64)
    for j in range(n):
        h = h * U64(BASE) + w[first + j]
    short = np.flatnonzero((size > 0) & (size < n))
    hs = np.full(len(short), 77, U64)
    for j in range(n - 1):
        has = size[short] > j
        hs[has] = hs[has] * U64(BASE) + w[at[short[has]] + j]
    rows, h = np.concatenate([row[first], short]), mix64(np.concatenate([h, hs]))
    order = np.lexsort((h, rows))
    rows, h = rows[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, np.int64)
    return rows[new], h[new], np.diff(np.append(new, len(h)))


def prob_min_hash(rows: np.ndarray, items: np.ndarray, weights: np.ndarray, n_rows: int, k: int) -> np.ndarray:
    """(n_rows, k) register winners; rows without items keep 0."""
    time = np.full(n_rows * k, np.inf)
    won = np.zeros(n_rows * k, U64)
    r, h, w, t = rows, items, weights.astype(float), np.zeros(len(rows))
    j = 0
    while len(r):
        j += 1
        x = mix64(h + U64(j * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        t = t - np.log(((x >> U64(11)).astype(float) + 1) / 2.0**53) / w
        at = r * k + ((mix64(x) >> U64(32)) % U64(k)).astype(np.int64)
        np.minimum.at(time, at, t)
        here = t == time[at]
        won[at[here]] = h[here]
        late = time.reshape(n_rows, k).max(1)
        go = t < late[r]
        r, h, w, t = r[go], h[go], w[go], t[go]
    return won.reshape(n_rows, k)


def _sketch(bands: int, rows_a_band: int, weighted: bool):
    def run(batches):
        for b in batches:
            data, off = buffers(b.column(2))
            n, key, sums = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, np.int64), np.zeros((b.num_rows, bands), np.int64)
            for i, d, o in pieces(data, off):
                r, h, c = shingles(d, o)
                m = len(o) - 1
                n[i:i + m] = np.bincount(r, minlength=m)
                total = np.zeros(m, U64)
                np.add.at(total, r, mix64(h ^ U64(0xABCDEF)) * (c.astype(U64) if weighted else U64(1)))
                key[i:i + m] = signed(total)
                sig = prob_min_hash(r, h, c if weighted else np.ones(len(r)), m, bands * rows_a_band).reshape(m, bands, rows_a_band)
                s = np.broadcast_to(np.arange(1, bands + 1, dtype=U64), (m, bands)).copy()
                for q in range(rows_a_band):
                    s = mix64(s * U64(BASE) + sig[:, :, q])
                sums[i:i + m] = signed(s)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * bands), pa.array(sums.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), pa.array(key), lists],
                                             names=["rid", "doc_id", "n", "set_key", "bands"])
    return run


def _sets(batches):
    for b in batches:
        data, off = buffers(b.column(1))
        for i, d, o in pieces(data, off):
            r, h, c = shingles(d, o)
            at = np.searchsorted(r, np.arange(len(o))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, len(o) - 1), pa.ListArray.from_arrays(pa.array(at), pa.array(signed(h))),
                                              pa.ListArray.from_arrays(pa.array(at), pa.array(c.astype(np.int32)))], names=["rid", "items", "counts"])


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """J_P of two weight vectors over the same items: the sum over shared items d of 1 / sum_e max(x_e / x_d, y_e / y_d)."""
    both = np.flatnonzero((x > 0) & (y > 0))
    if not len(both):
        return 0.0
    # max(x_e / x_d, y_e / y_d) is y_e / y_d where y_e / x_e >= y_d / x_d: two prefix sums over items in the order of that ratio
    with np.errstate(divide="ignore"):
        ratio = np.where(x > 0, y / np.where(x > 0, x, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    xs, ys = np.concatenate([[0], np.cumsum(x[order])]), np.concatenate([np.cumsum(y[order][::-1])[::-1], [0]])
    k = np.searchsorted(ratio[order], ratio[both], "left")
    return float((1 / (xs[k] / x[both] + ys[k] / y[both])).sum())


def _verify(weighted: bool, threshold: float):
    if not weighted:
        common = F.size(F.array_intersect("ia", "ib"))
        return lambda p: p.filter(common >= threshold * (F.size("ia") + F.size("ib") - common) - 1e-9).select("a", "b")

    def run(batches):
        for p in batches:
            keep = []
            for ia, ca, ib, cb in zip(p.ia, p.ca, p.ib, p.cb):
                u = np.union1d(ia, ib)
                x, y = np.zeros(len(u)), np.zeros(len(u))
                x[np.searchsorted(u, ia)], y[np.searchsorted(u, ib)] = ca, cb
                keep.append(probability_jaccard(x, y) >= threshold - 1e-9)
            yield p.loc[np.array(keep, bool), ["a", "b"]]
    return lambda p: p.mapInPandas(run, "a long, b long")


def _across(threshold: float, weighted: bool):
    """Links between components among the members of a bucket's pair of blocks, each pair of components once."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("rep").reset_index(drop=True)
        comp = pd.factorize(group.comp)[0]
        if not len(comp) or comp.max() == 0:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        sizes = group["items"].str.len().to_numpy()
        flat, owner = np.concatenate(group["items"].to_list()), np.repeat(np.arange(len(group)), sizes)
        counts = np.concatenate(group["counts"].to_list())
        order = np.lexsort((owner, flat))
        flat, owner, counts = flat[order], owner[order], counts[order]
        up = np.arange(comp.max() + 1)

        def find(c):
            while up[c] != c:
                up[c] = c = up[up[c]]
            return c

        out, most = [], np.bincount(comp).argmax()
        for i in np.flatnonzero(comp != most):
            lo, hi = np.searchsorted(flat, group["items"][i], "left"), np.searchsorted(flat, group["items"][i], "right")
            n = hi - lo
            idx = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            common = np.bincount(owner[idx], minlength=len(group))
            # J_P is at most the shared items over the larger set's, for weights as for sets after scaling: only sets use the bound
            near = common > 0 if weighted else common >= threshold * (sizes[i] + sizes - common) - 1e-9
            for j in np.flatnonzero(near & (comp != comp[i])):
                if find(comp[i]) == find(comp[j]):
                    continue
                if weighted:
                    u = np.union1d(group["items"][i], group["items"][j])
                    x, y = np.zeros(len(u)), np.zeros(len(u))
                    x[np.searchsorted(u, group["items"][i])], y[np.searchsorted(u, group["items"][j])] = group["counts"][i], group["counts"][j]
                    if probability_jaccard(x, y) < threshold - 1e-9:
                        continue
                up[find(comp[j])] = find(comp[i])
                out.append((group.rep[i], group.rep[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def near_groups(docs: DataFrame, threshold: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, weighted: bool = False) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, n (distinct shingles), class_rid, class_id, class_size, keep.

    Classes are the components of the links whose similarity is at least ``threshold``: the
    probability Jaccard of shingle counts (``weighted``), or of shingle sets, where it is the plain
    Jaccard. ``class_id`` is the least doc_id of the class, ``keep`` marks its first row. A text that is
    null or without words has no shingle and is a class of its own; repeated rows are copies of each
    other. ``docs`` must be a stable scan: rows are numbered by their place in it.
    """
    base = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id"), F.col("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    sketch = settle(base.mapInArrow(_sketch(bands, rows, weighted), f"rid long, doc_id {kind}, n int, set_key long, bands array<long>"), "sketch")
    keyed = sketch.filter("n > 0").groupBy("set_key", "n").agg(F.min("rid").alias("rep"), F.min_by("bands", "rid").alias("bands"))
    buckets = keyed.select("rep", F.explode("bands").alias("key"))
    heads = buckets.groupBy("key").agg(F.min("rep").alias("head"), F.count("*").alias("m"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who")).filter("m > 1")
    # the same members meet in many bands: one bucket of each set of members is enough
    heads = heads.groupBy("m", "who", "head").agg(F.min("key").alias("key"))
    shared = settle(buckets.join(heads, "key").select("key", "rep", "head", "m"), "buckets")
    pairs = settle(shared.filter("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    members = pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    sets = settle(base.select("rid", "text").join(members, "rid", "left_semi").mapInArrow(_sets, "rid long, items array<long>, counts array<int>"), "sets")
    verify = _verify(weighted, threshold)
    side = lambda x: sets.select(F.col("rid").alias(x), F.col("items").alias(f"i{x}"), *([F.col("counts").alias(f"c{x}")] if weighted else []))
    links = settle(verify(pairs.join(side("b"), "b").join(side("a"), "a")), "links")
    labels = components(links)
    placed = shared.filter("m > 2").join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    split = placed.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1").select("key")
    n_blocks = F.ceil(F.col("m") / BLOCK)
    blocks = placed.join(split, "key", "left_semi").withColumn("o", F.explode(F.sequence(F.lit(0), (n_blocks - 1).cast("int")))).withColumn(
        "i", F.pmod(F.xxhash64("rep"), n_blocks).cast("int")).select("key", "rep", "comp", F.least("i", "o").alias("bi"), F.greatest("i", "o").alias("bj"))
    work = blocks.join(sets.withColumnRenamed("rid", "rep"), "rep")
    more = work.groupBy("key", "bi", "bj").applyInPandas(_across(threshold, weighted), "a long, b long")
    labels = settle(components(links.union(more)), "labels")
    whole = sketch.drop("bands").join(keyed.drop("bands"), ["set_key", "n"], "left").withColumn("rep", F.coalesce("rep", "rid"))
    whole = whole.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("class_rid", F.coalesce("comp", "rep"))
    classes = whole.groupBy("class_rid").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return whole.join(classes, "class_rid").select("rid", "doc_id", "n", "class_rid", "class_id", "class_size", (F.col("rid") == F.col("class_rid")).alias("keep"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group, with its columns, whatever their names. Null and empty texts are groups of their
    own kind; a null id is an id like others; repeated rows are copies; an empty table gives none."""
    gone = settle(near_groups(docs).filter("not keep").select("rid"), "copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("rid"))
    return rows.join(gone, "rid", "left_anti").select("row.*")
