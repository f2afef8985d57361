"""Exact removal of long repeated byte strings, by longest-previous-factor arrays over sampled suffixes.

A byte goes if some ``width``-byte string over it starts elsewhere too. Finding those starts needs, for each
suffix, the longest earlier (and later) match: its neighbours in suffix order whose position is smaller
(larger). Only depth ``width`` matters, so equal neighbours are what is looked for.

To avoid sorting every suffix of the corpus, each ``width``-byte window names one of its ``GRAM``-byte
grams, the leftmost of least hash (a minimizer). Equal windows name the same gram at the same place, so
only windows around equal grams can match:

1. each text emits its named grams (anchors), with a hash of the anchor's context, the bytes that the
   windows naming it can cover;
2. contexts that occur twice are wholly repeated, whatever their number: an aggregate and a join settle them;
3. for the other contexts whose anchor occurs elsewhere, one copy of each context goes to the anchor's
   task, which orders the suffixes at window starts and takes the previous and next smaller position
   there. Anchors with over ``HOT`` different contexts are settled by an aggregate on window hashes instead.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BASE, U64, _WORD_TABLE, buffers, give_back, mix64, pieces, prefix_hash, settle, signed, span_hash, table

WIDTH, GRAM = 400, 32
#: Width of the pipeline's stage: under the bytes of a passage of 50 words, which take about 5 to 7 each.
STAGE_WIDTH = 200
#: Contexts of one anchor that one task holds (under 800 bytes each); anchors with more take the aggregate.
#: Windows are matched about so many at a time, by their distance to the anchor, which equal ones share.
HOT, WINDOWS = 10_000, 300_000


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest earlier smaller value, -1 if none (all nearest smaller values, by a stack)."""
    out, stack = np.full(len(values), -1), []
    for i, v in enumerate(values.tolist()):
        while stack and values[stack[-1]] >= v:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return out


def longest_previous_factor(text: bytes) -> np.ndarray:
    """LPF of a whole small text: suffix array, common prefixes, then the better of the previous and next
    smaller position in suffix order. The reference that the sampled form is tested against."""
    n = len(text)
    sa = np.array(sorted(range(n), key=lambda i: text[i:]), dtype=np.int64)
    back, fore = previous_smaller(sa), previous_smaller(sa[::-1])[::-1]
    fore = np.where(fore >= 0, n - 1 - fore, -1)

    def common(i, j):
        k = 0
        while max(i, j) + k < n and text[i + k] == text[j + k]:
            k += 1
        return k

    lpf = np.zeros(n, np.int64)
    for r, p in enumerate(sa):
        lpf[p] = max([common(p, sa[q]) for q in (back[r], fore[r]) if q >= 0], default=0)
    return lpf


def matches_at_depth(key: np.ndarray, text: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(has an earlier equal suffix, has a later one), for suffixes cut at one depth.

    ``key`` is the hash of each suffix's prefix. In the order of (key, text, position), the previous smaller
    position of a suffix within its key reaches the depth, and so does the next larger one. A suffix
    that is listed twice is not its own match: the ends of its key's run are what it is compared with.
    """
    order = np.lexsort((position, text, key))
    k, t, p = key[order], text[order], position[order]
    new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    run = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(k)) - 1
    differs = lambda i: (t != t[i[run]]) | (p != p[i[run]])
    earlier, later = np.zeros(len(k), bool), np.zeros(len(k), bool)
    if len(k):
        earlier[order], later[order] = differs(first), differs(last)
    return earlier, later


def anchors(data: np.ndarray, off: np.ndarray, width: int, gram: int):
    """(row, position in the row) of the grams that windows name. Texts under ``width`` have none."""
    if len(data) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, step, m = _WORD_TABLE[data], 1, BASE
    while step < gram:  # doubling: hash of 2k bytes from two of k
        h = h[:-step] * U64(m) + h[step:]
        step, m = step * 2, m * m & 0xFFFFFFFFFFFFFFFF
    key = (mix64(h) & U64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=U64)
    span = width - gram + 1  # grams in a window; least of each span by running minima from both ends of blocks
    pad = -len(key) % span
    full = np.concatenate([key, np.full(pad, 0xFFFFFFFFFFFFFFFF, U64)]).reshape(-1, span)
    fore = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(key) - span + 1
    named = np.minimum(back[:n], fore[span - 1:span - 1 + n]) & U64(0xFFFFFFFF)
    row = np.searchsorted(off, np.arange(n), "right") - 1
    whole = np.arange(n) + width <= off[row + 1]
    named = np.unique(named[whole]).astype(np.int64)
    row = np.searchsorted(off, named, "right") - 1
    return row, named - off[row]


def _bounds(off, row, pos, width, gram):
    return np.maximum(0, pos - (width - gram)), np.minimum(off[row + 1] - off[row], pos + width)


def _emit_anchors(width: int, gram: int):
    def run(batches):
        for b in batches:
            data, off = buffers(b.column(1))
            for i, d, o in pieces(data, off):
                row, pos = anchors(d, o, width, gram)
                if not len(row):
                    continue
                lo, hi = _bounds(o, row, pos, width, gram)
                at = o[row]
                view, key = memoryview(d), np.zeros(len(row), U64)
                ctx = np.array([xxhash.xxh3_64_intdigest(view[a:z], int(s)) for a, z, s in zip((at + lo).tolist(), (at + hi).tolist(), (pos - lo).tolist())], U64)
                for k in range(gram // 8):
                    word = np.zeros(len(row), U64)
                    for j in range(8):
                        word = word << U64(8) | d[at + pos + 8 * k + j].astype(U64)
                    key = mix64(key * U64(BASE) + word)
                rid = b.column(0).to_numpy()[i + row]
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(signed(ctx)), pa.array(rid), pa.array(pos.astype(np.int32)),
                                                  pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["anchor", "ctx", "rid", "pos", "lo", "hi"])
    return run


def _emit_contexts(batches):
    """For each text and the list of its contexts wanted: one row a context, with its bytes."""
    for b in batches:
        data, off = buffers(b.column(1))
        lists = b.column(2)
        for i in range(b.num_rows):
            text, want = data[off[i]:off[i + 1]].tobytes(), lists.slice(i, 1).flatten()
            cols = {n: want.field(n) for n in ("anchor", "pos", "lo", "hi", "single")}
            yield pa.RecordBatch.from_arrays(
                [cols["anchor"], pa.array(np.full(len(want), b.column(0)[i].as_py(), np.int64)), cols["pos"], cols["lo"], cols["single"],
                 pa.array([text[a:z] for a, z in zip(cols["lo"].to_pylist(), cols["hi"].to_pylist())], pa.binary())],
                names=["anchor", "rid", "pos", "lo", "single", "bytes"])


def _windows(bytes_col, pos, lo, width, gram, blocks=None):
    """(context, start in the context, hash) of the windows of each context over its anchor's gram, for one range
    after another of the distance from a window's start to the anchor."""
    data, off = buffers(bytes_col)
    c = prefix_hash(data)
    size, at = off[1:] - off[:-1], pos - lo
    span = width - gram + 1
    blocks = blocks or max(1, -(-len(pos) * span // WINDOWS))
    cuts = np.linspace(0, span, min(blocks, span) + 1).astype(int)
    for a, z in zip(cuts[:-1], cuts[1:]):  # distances a..z-1
        first = np.maximum(0, at - (z - 1))
        n = np.maximum(0, np.minimum(at - a, size - width) - first + 1)
        who = np.repeat(np.arange(len(n)), n)
        start = first[who] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        i = off[:-1][who] + start
        yield who, start, span_hash(c, i, i + width)


def _runs(who, start, width):
    """Covered intervals of marked windows, neighbours and overlaps joined: (context, from, to)."""
    if not len(who):
        return who, start, start
    new = np.concatenate([[True], (who[1:] != who[:-1]) | (start[1:] > start[:-1] + width)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(who)) - 1
    return who[first], start[first], start[last] + width


def _spans(rid, lo, who, a, z):
    return pa.RecordBatch.from_arrays([pa.array(rid[who]), pa.array((lo[who] + a).astype(np.int32)), pa.array((lo[who] + z).astype(np.int32))], names=["rid", "a", "z"])


def _match(width: int, gram: int, keep_first: bool):
    """Spans repeated among the contexts of each anchor. Rows come sorted by anchor; whole anchors are taken at a time."""
    def solve(t):
        anchor = t.column("anchor").to_numpy()
        rid, pos, lo = (t.column(n).to_numpy().astype(np.int64) for n in ("rid", "pos", "lo"))
        single = t.column("single").to_numpy(zero_copy_only=False)
        marked = []
        for who, start, h in _windows(t.column("bytes"), pos, lo, width, gram):
            earlier, later = matches_at_depth(mix64(h ^ anchor[who].view(U64)), rid[who], lo[who] + start)
            mark = earlier if keep_first else (earlier | later) & single[who]
            marked.append((who[mark], start[mark]))
        who, start = (np.concatenate(x) for x in zip(*marked))
        order = np.lexsort((start, who))
        return _spans(rid, lo, *_runs(who[order], start[order], width))

    def run(batches):
        held = []
        for b in batches:
            held.append(b)
            if sum(x.nbytes for x in held) < 2 << 20:
                continue
            t = pa.Table.from_batches(held)
            anchor = t.column("anchor").to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))
            held = t.slice(cut).to_batches()
            if cut:
                yield solve(t.slice(0, cut))
        if held:
            yield solve(pa.Table.from_batches(held))
    return run


def _window_rows(width: int, gram: int):
    def run(batches):
        for b in batches:
            n = max(1, b.num_rows // 500)
            for k in range(0, b.num_rows, -(-b.num_rows // n)):
                t = b.slice(k, -(-b.num_rows // n))
                rid, pos, lo = (t.column(x).to_numpy().astype(np.int64) for x in (1, 2, 3))
                who, start, h = next(_windows(t.column(5), pos, lo, width, gram, 1))
                yield pa.RecordBatch.from_arrays([pa.array(signed(mix64(h ^ t.column(0).to_numpy()[who].view(U64)))), pa.array(rid[who]), pa.array((lo[who] + start).astype(np.int32)),
                                                  pa.array(t.column(4).to_numpy(zero_copy_only=False)[who])], names=["h", "rid", "s", "single"])
    return run


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, keep_first: bool = False, hot: int = HOT) -> DataFrame:
    """(rid, a, z): byte spans, possibly overlapping, covered by ``width``-byte strings that start elsewhere too.

    ``keep_first`` spares the first occurrence, in the order of (rid, position). ``docs`` has rid and text.
    """
    found = settle(docs.mapInArrow(_emit_anchors(width, gram), "anchor long, ctx long, rid long, pos int, lo int, hi int"), "anchors")
    kinds = found.groupBy("anchor", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("rid", "pos", "lo", "hi")).alias("one"))
    kinds = settle(kinds.join(found.groupBy("anchor").agg(F.count("*").alias("all")).filter("all > 1"), "anchor"), "contexts")
    again = kinds.filter("n > 1").select("anchor", "ctx", F.col("one.rid").alias("r0"), F.col("one.pos").alias("p0"))
    copies = found.join(again, ["anchor", "ctx"])
    if keep_first:
        copies = copies.filter("rid <> r0 or pos <> p0")
    copies = copies.select("rid", F.col("lo").alias("a"), F.col("hi").alias("z"))
    # contexts still open: of anchors that have several, one of each; where all are kept out anyway, only if one occurs once
    open_ = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter("kinds > 1" + ("" if keep_first else " and least = 1")).drop("least")
    wanted = kinds.join(open_, "anchor").select("anchor", "one.*", (F.col("n") == 1).alias("single"), (F.col("kinds") > hot).alias("hot"))
    lists = wanted.groupBy("rid").agg(F.collect_list(F.struct("anchor", "pos", "lo", "hi", "single")).alias("want"))
    texts = docs.join(lists, "rid").select("rid", F.col("text").cast("binary"), "want")
    contexts = texts.mapInArrow(_emit_contexts, "anchor long, rid long, pos int, lo int, single boolean, bytes binary")
    heavy = settle(open_.filter(F.col("kinds") > hot).select("anchor"), "heavy")
    if heavy.isEmpty():
        cold, spans = contexts, copies
    else:
        contexts = settle(contexts, "texts")
        cold = contexts.join(heavy, "anchor", "left_anti")
        rows = contexts.join(heavy, "anchor", "left_semi").select("anchor", "rid", "pos", "lo", "single", "bytes").mapInArrow(_window_rows(width, gram), "h long, rid long, s int, single boolean")
        shared = rows.groupBy("h").agg(F.min(F.struct("rid", "s")).alias("f"), F.max(F.struct("rid", "s")).alias("g")).filter("f <> g")
        late = rows.join(shared, "h").filter((F.struct("rid", "s") != F.col("f")) if keep_first else F.col("single"))
        spans = copies.union(late.select("rid", F.col("s").alias("a"), (F.col("s") + width).alias("z")))
    n = max(cold.sparkSession.sparkContext.defaultParallelism, int(cold.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = cold.repartition(n, "anchor").sortWithinPartitions("anchor")
    return spans.union(dealt.mapInArrow(_match(width, gram, keep_first), "rid long, a int, z int"))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    keep, at = [], 0
    for a, z in spans:
        keep.append(raw[at:a])
        at = z
    return b"".join([*keep, raw[at:]])


def _finish(whole_chars: bool):
    """Each text without its spans. ``whole_chars`` narrows spans so that no character is cut."""
    def one(raw: bytes, a: np.ndarray, z: np.ndarray):
        runs = _merge(list(zip(a.tolist(), z.tolist())))
        if whole_chars:
            inside = lambda p: p < len(raw) and raw[p] & 0xC0 == 0x80
            fixed = []
            for a, z in runs:
                while inside(a):
                    a += 1
                while z > a and inside(z):
                    z -= 1
                if z > a:
                    fixed.append((a, z))
            runs = fixed
        kept = _cut(raw, runs)
        return len(raw), len(raw) - len(kept), runs, kept

    def run(batches):
        for whole in batches:
            give_back()
            for k in range(0, whole.num_rows, 200):
                b = whole.slice(k, 200)
                lists = b.column(2)
                at, flat = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]), lists.flatten()
                a, z = flat.field("a").to_numpy(), flat.field("z").to_numpy()
                n, gone, runs, kept = zip(*[one(b.column(1)[i].as_py() or b"", a[at[i]:at[i + 1]], z[at[i]:at[i + 1]]) for i in range(b.num_rows)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array([len(r) for r in runs], pa.int64()),
                     pa.array([[{"a": a, "z": z} for a, z in r] for r in runs], pa.list_(pa.struct([("a", pa.int32()), ("z", pa.int32())]))), pa.array(kept, pa.binary())],
                    names=["rid", "n_bytes", "n_removed", "n_spans", "spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, keep_first: bool = False, whole_chars: bool = False) -> DataFrame:
    """Columns of ``docs`` but text, and n_bytes, n_removed, n_spans, spans (merged, from and to in bytes), kept (bytes).

    A null text counts as empty; texts under ``width`` bytes are never touched; equal rows are copies of
    each other; matches never cross rows. ``docs`` must be a stable scan, whose rows are numbered by place.
    """
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
                       F.coalesce("text", F.lit("")).alias("text")).withColumn("rid", F.monotonically_increasing_id())
    spans = repeated_spans(base.select("rid", F.col("text").cast("binary").alias("text")), width, GRAM, keep_first)
    spans = settle(spans.groupBy("rid").agg(F.sort_array(F.collect_set(F.struct("a", "z"))).alias("spans")), "spans")
    changed = base.select("rid", F.col("text").cast("binary").alias("text")).join(spans, "rid").select("rid", "text", "spans")
    return base, changed.mapInArrow(_finish(whole_chars), "rid long, n_bytes long, n_removed long, n_spans long, spans array<struct<a:int,z:int>>, kept binary")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, cut = remove_repeats(table(spark, sf_dir, "documents"))
    plain = base.select("rid", "row.doc_id", F.octet_length("text").cast("long").alias("b"), F.sha2(F.col("text").cast("binary"), 256).alias("h"))
    cut = cut.select("rid", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    return plain.join(cut, "rid", "left").select(
        "doc_id", F.col("b").alias("n_bytes"), F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "h").alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with later copies of repeated passages cut out of the texts, the first one kept; n_chars follows the text.

    Passages count from ``STAGE_WIDTH`` bytes on. A null text becomes an empty one; repeated rows lose their copies'
    text but stay rows; an empty table gives none."""
    base, cut = remove_repeats(docs, STAGE_WIDTH, keep_first=True, whole_chars=True)
    kept = settle(cut.select("rid", F.col("kept").cast("string").alias("kept")), "kept")
    full = base.join(kept, "rid", "left").withColumn("text", F.coalesce("kept", "text"))
    cols = [F.col("text") if c == "text" else F.length("text").cast("long").alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns]
    return full.select(*cols)
