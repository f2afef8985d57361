"""Hierarchical Pitman-Yor language model, with seatings sampled by Gibbs sweeps.

A word is drawn from the restaurant of its context, the word before; context restaurants share one parent
restaurant over all words, whose base is uniform. Every word of the texts that are learnt from is a context
of its own, at every size.

Work is split in a grid of cells: the row from the hash of the context, the column from that of the word. A cell
holds counts of its (context, word) pairs, never their occurrences, so neither a frequent word nor a frequent pair
fills one. After each sweep the totals by context are summed over a row of cells and those by word over a column,
and go back to the cells; the driver sees four sums. A sweep re-seats the customers of every pair under the totals
of the sweep before. The score averages the predictive probabilities of the sampled seatings.

A text's score is summed where the text is: packs of texts ask the cells once for each of their pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import LOWER, U64, buffers, give_back, pieces, prefix_hash, settle, span_hash, table, words

#: Discounts and strengths of context restaurants and of the parent.
DISCOUNT, STRENGTH, DISCOUNT0, STRENGTH0 = 0.75, 5.0, 0.6, 50.0
SWEEPS = 2
#: Bytes of text to a cell, and tokens that a map task packs at once.
SHARD_BYTES, PACK = 16 << 20, 2_000_000
START, END = U64(0x57A257A257A257A3), U64(0xE2D0E2D0E2D0E2D1)


def tokens(data: np.ndarray, off: np.ndarray):
    """(word, context, row) of every token of every row: its words, lower-case in A-Z, then one end."""
    data = LOWER[data]
    starts, ends, row = words(data, off)
    h = span_hash(prefix_hash(data), starts, ends)
    n = np.bincount(row, minlength=len(off) - 1) + 1
    w = np.full(len(h) + len(n), END, U64)
    w[np.arange(len(h)) + row] = h
    c = np.empty_like(w)
    c[1:] = w[:-1]
    c[np.cumsum(n) - n] = START
    return w, c, np.repeat(np.arange(len(n)), n)


def _pack(*arrays) -> bytes:
    return zstandard.ZstdCompressor(3).compress(b"".join([np.array([len(a) for a in arrays], np.int64).tobytes(), *[np.ascontiguousarray(a).tobytes() for a in arrays]]))


def _planes(x: np.ndarray) -> np.ndarray:
    """Bytes of ascending 64-bit numbers' differences, all first bytes, then all second ones, and so on: they compress well."""
    return np.diff(x, prepend=x.dtype.type(0)).view(np.uint8).reshape(-1, 8).T.ravel()


def _whole(planes: np.ndarray, kind) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(kind), dtype=kind)


def _unpack(blob, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    at, out = 8 * len(kinds), []
    for n, k in zip(sizes, kinds):
        out.append(np.frombuffer(raw, k, n, at))
        at += int(n) * np.dtype(k).itemsize
    return out


def _line(x: np.ndarray, side: int) -> np.ndarray:
    return ((x >> U64(32)) * U64(side) >> U64(32)).astype(np.int64)


def _deal(side: int, ask: bool):
    """Packs of texts, numbered by their first text. With ``ask``, (cell, pack, blob): the pack's different pairs of each
    cell and how often they are learnt. Else (-1, pack, blob): of each token its pair's place among the pack's, and the texts."""
    def flush(held):
        w, c, rid, out = (np.concatenate(x) for x in zip(*held))
        first = int(rid[0])
        cell = (_line(c, side) * side + _line(w, side)).astype(np.int32)
        order = np.lexsort((w, c, cell))
        w, c, cell = w[order], c[order], cell[order]
        new = np.concatenate([[True], (w[1:] != w[:-1]) | (c[1:] != c[:-1])])
        if not ask:
            at = np.empty(len(w), np.uint32)
            at[order] = np.cumsum(new) - 1
            ids = np.flatnonzero(np.concatenate([[True], rid[1:] != rid[:-1]]))
            yield -1, first, _pack(_planes(rid[ids]), np.diff(np.append(ids, len(rid))).astype(np.uint32), *[(at >> 8 * k).astype(np.uint8) for k in range(4)])
            return
        new = np.flatnonzero(new)
        learnt = np.add.reduceat((~out[order]).astype(np.int64), new).astype(np.uint32)
        w, c, cell = w[new], c[new], cell[new]
        cut = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]])
        for a, b in zip(cut[:-1], cut[1:]):
            u, per = np.unique(c[a:b], return_counts=True)
            yield int(cell[a]), first, _pack(_planes(u), per.astype(np.uint32), w[a:b], learnt[a:b])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            rid, held_out = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            data, off = buffers(b.column(2))
            held, size, out = [], 0, []
            for i, d, o in pieces(data, off):
                w, c, row = tokens(d, o)
                held.append((w, c, rid[i + row], held_out[i + row]))
                size += len(w)
                if size >= PACK:
                    out += flush(held)
                    held, size = [], 0
            if held:
                out += flush(held)
            del data, held
            for k in range(0, len(out), 64):
                s, f, x = zip(*out[k:k + 64])
                yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(f, pa.int64()), pa.array(x, pa.binary())], names=["cell", "pack", "blob"])
    return run


def _join(part: pd.DataFrame) -> pd.DataFrame:
    """All packs' pairs of one cell as one row: its contexts, words, and pairs with their learnt counts; and which pairs each pack asks for."""
    give_back()
    ws, cs, ns = [], [], []
    for blob in part["blob"]:
        u, per, w, n = _unpack(blob, np.uint8, np.uint32, U64, np.uint32)
        ws.append(w), cs.append(np.repeat(_whole(u, U64), per)), ns.append(n)
    cut = np.cumsum([len(x) for x in ws])[:-1]
    w, c, n = (np.concatenate(x) for x in (ws, cs, ns))
    del ws, cs, ns
    order = np.lexsort((w, c))
    w, c = w[order], c[order]
    new = np.concatenate([[True], (w[1:] != w[:-1]) | (c[1:] != c[:-1])])
    at = np.empty(len(w), np.int64)
    at[order] = np.cumsum(new) - 1
    new = np.flatnonzero(new)
    learnt = np.add.reduceat(n[order].astype(np.int64), new)
    own, per = np.unique(c[new], return_counts=True)
    vocabulary, word = np.unique(w[new], return_inverse=True)
    return pd.DataFrame({"cell": [int(part["cell"].iloc[0])], "pairs": [_pack(_planes(own), per.astype(np.uint32), _planes(vocabulary), word.astype(np.uint32), learnt)],
                         "packs": [part["pack"].tolist()], "asked": [[_pack(_planes(x)) for x in np.split(at, cut)]]})


def seat(rng, customers: np.ndarray, open_: np.ndarray, discount: float) -> np.ndarray:
    """Tables of each dish after its customers sat down one by one; ``open_`` is (strength + discount * tables in the
    restaurant) times the parent's probability: the weight of a new table. Past 64 customers they come in groups of an
    eighth of those there, each group under one probability."""
    t = (customers > 0).astype(np.float64)
    at = np.flatnonzero(customers > 1)
    j, o, s = 1, open_[at], np.ones(len(at))
    n = customers[at].astype(np.int64)
    while len(at):
        step = 1 if j < 64 else j // 8
        p = o / (o + np.maximum(j - discount * s, 1e-9))
        s = s + (rng.random(len(at)) < p if step == 1 else rng.binomial(np.minimum(step, n - j), p))
        j += step
        go = n > j
        t[at[~go]] = s[~go]
        at, o, s, n = at[go], o[go], s[go], n[go]
    return t


def _parent(T, t0, total):
    return (T - DISCOUNT0 * t0) / (STRENGTH0 + total["T"]) + (STRENGTH0 + DISCOUNT0 * total["t0"]) / (STRENGTH0 + total["T"]) / (total["V"] + 1)


def _read(blob):
    """(contexts, words, each pair's context and word by place, its learnt count)."""
    own, per, vocabulary, word, learnt = _unpack(blob, np.uint8, np.uint32, np.uint8, np.uint32, np.int64)
    return _whole(own, U64), _whole(vocabulary, U64), np.repeat(np.arange(len(per)), per), word.astype(np.int64), learnt


def _slices(part: pd.DataFrame) -> dict:
    """A cell's slices of the totals after each sweep: {(sweep, kind): arrays}; kind 0 is by context, 1 by word."""
    return {(s, k): _unpack(b, *[np.int64] * (2 + k)) for s, k, b in zip(part["sweep"], part["kind"], part["blob"]) if k < 2}


def _reseat(cell, sweep, got, totals, c, w, learnt):
    """Tables of a cell's pairs in a sweep. The random numbers depend on cell and sweep alone."""
    (_, tables), (_, T, t0) = got[sweep - 1, 0], got[sweep - 1, 1]
    return seat(np.random.default_rng((cell, sweep)), learnt, (STRENGTH + DISCOUNT * tables[c]) * _parent(T, t0, totals[sweep - 1])[w], DISCOUNT)


def _sweep(totals: list, side: int):
    """A cell's customers and tables by context, for its row of the grid, and by word, for its column, after the next sweep.
    The first seating has one table a dish."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        give_back()
        cell = int(part["cell"].iloc[0])
        own, vocabulary, c, w, learnt = _read(part["blob"][part["kind"] == 2].iloc[0])
        t = _reseat(cell, len(totals), _slices(part), totals, c, w, learnt) if totals else (learnt > 0).astype(np.float64)
        blobs = [_pack(_planes(keys), *[np.bincount(at, x, len(keys)).astype(np.int64) for x in (learnt, t)]) for keys, at in ((own, c), (vocabulary, w))]
        return pd.DataFrame({"kind": [0, 1], "line": [cell // side, cell % side], "cell": [cell] * 2, "blob": blobs})
    return run


def _exchange(totals: list):
    """Sums over one line of the grid, cut to what each of its cells holds; words are seated in the parent as well."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        give_back()
        kind, line, sweep = int(part["kind"].iloc[0]), int(part["line"].iloc[0]), len(totals)
        got = [_unpack(b, np.uint8, np.int64, np.int64) for b in part["blob"]]
        keys, at = np.unique(np.concatenate([_whole(g[0], U64) for g in got]), return_inverse=True)
        cols = [np.bincount(at, np.concatenate([g[k] for g in got]), len(keys)).astype(np.int64) for k in (1, 2)]
        sums = np.zeros((len(part), 4))
        if kind:
            n, T = cols
            t0 = seat(np.random.default_rng((line, sweep, 1)), T, np.full(len(T), (STRENGTH0 + DISCOUNT0 * totals[-1]["t0"]) / (totals[-1]["V"] + 1)), DISCOUNT0) if totals else T > 0
            cols.append(t0.astype(np.int64))
            sums[0] = n.sum(), (n > 0).sum(), T.sum(), t0.sum()
        cut = np.cumsum([len(g[1]) for g in got])[:-1]
        return pd.DataFrame({"cell": part["cell"].to_numpy(), "sweep": sweep, "kind": kind, "blob": [_pack(*[x[i] for x in cols]) for i in np.split(at, cut)],
                             **dict(zip(("N", "V", "T", "t0"), sums.T))})
    return run


def _answer(totals: list):
    """(cell, pack, blob): learnt count of the word and score, of each pair that a pack asked of the cell."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        give_back()
        cell, got = int(part["cell"].iloc[0]), _slices(part)
        own = part[part["kind"] == 2].iloc[0]
        _, _, c, w, learnt = _read(own["blob"])
        seen, p = got[0, 1][0][w], np.zeros(len(c))
        for s in range(1, len(totals)):  # the first seating is the start, not a sample
            t = _reseat(cell, s, got, totals, c, w, learnt)
            (customers, tables), (_, T, t0) = got[s, 0], got[s, 1]
            p += (np.maximum(learnt - DISCOUNT * t, 0) + (STRENGTH + DISCOUNT * tables[c]) * _parent(T, t0, totals[s])[w]) / (STRENGTH + customers[c])
        score = np.log10(p / (len(totals) - 1))
        at = [_whole(*_unpack(b, np.uint8), np.int64) for b in own["asked"]]
        return pd.DataFrame({"cell": cell, "pack": np.asarray(own["packs"], np.int64), "blob": [_pack(seen[i], score[i]) for i in at]})
    return run


def _sum(total: dict):
    """Sums by text of one pack, from the cells' answers in their order."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        give_back()
        part = part.sort_values("cell")
        ids, n, *at = _unpack(part["blob"].iloc[0], np.uint8, np.uint32, *[np.uint8] * 4)
        at = sum(x.astype(np.uint32) << 8 * k for k, x in enumerate(at))
        seen, score = (np.concatenate(x) for x in zip(*[_unpack(b, np.int64, np.float64) for b in part["blob"].iloc[1:]]))
        base = np.log10((seen + 0.1) / (total["N"] + 0.1 * (total["V"] + 1)))
        first = np.cumsum(n, dtype=np.int64) - n
        add = lambda x: np.add.reduceat(x[at], first)
        return pd.DataFrame({"rid": _whole(ids, np.int64), "n_tokens": n.astype(np.int64), "n_known": add((seen > 0).astype(np.int64)), "base": add(base), "score": add(score)})
    return run


def score_texts(docs: DataFrame, held_out, sweeps: int = SWEEPS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Learns from the rows where the column ``held_out`` is false. A null or empty text is one token, its end.
    Equal rows score alike. Without training tokens the model is the uniform base over one word.
    An empty table gives none. ``docs`` must be a stable scan: rows are numbered by place.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id"), held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long") + 8)).first()[0] or 0
    side = max(1, math.ceil(math.sqrt(size / shard_bytes)))
    packs = lambda ask: rows.select("rid", "held_out", "text").mapInArrow(_deal(side, ask), "cell int, pack long, blob binary")
    model = settle(packs(True).groupBy("cell").applyInPandas(_join, "cell int, pairs binary, packs array<long>, asked array<binary>"), "restaurants")
    none = F.lit(None)
    pairs = model.select("cell", F.lit(-1).alias("sweep"), F.lit(2).alias("kind"), F.col("pairs").alias("blob"))
    totals, slices = [], []
    for s in range(sweeps + 1):
        cells = pairs.unionByName(slices[-1]) if slices else pairs
        lines = cells.groupBy("cell").applyInPandas(_sweep(totals, side), "kind int, line int, cell int, blob binary")
        got = settle(lines.groupBy("kind", "line").applyInPandas(_exchange(totals), "cell int, sweep int, kind int, blob binary, N double, V double, T double, t0 double"), f"totals{s}")
        slices.append(got.select("cell", "sweep", "kind", "blob"))
        totals.append({k: v or 0.0 for k, v in got.agg(*[F.sum(x).alias(x) for x in ("N", "V", "T", "t0")]).first().asDict().items()})
    cells = model.select("cell", F.lit(-1).alias("sweep"), F.lit(2).alias("kind"), F.col("pairs").alias("blob"), "packs", "asked")
    for x in slices:
        cells = cells.unionByName(x.withColumns({"packs": none.cast("array<long>"), "asked": none.cast("array<binary>")}))
    answers = cells.groupBy("cell").applyInPandas(_answer(totals), "cell int, pack long, blob binary")
    sums = packs(False).unionByName(answers).groupBy("pack").applyInPandas(_sum(totals[0]), "rid long, n_tokens long, n_known long, base double, score double")
    return rows.select("rid", "doc_id", "held_out").join(sums, "rid").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(totals[0]["N"])).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def held_out():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0


def op6_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), held_out())
