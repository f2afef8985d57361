"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap checks.

The test items form an inverted index; every training passage is a query. Impacts are divided by the
item's own score, so one threshold means the same share of any item. Passages are windows of twice the
longest item's words, one window each such length, so any stretch of that length lies whole in one.
An upper bound over the rare terms rules out, array-wise, the items that a passage cannot reach; passages
left over are answered by block-max WAND over the full index, and what it retrieves is verified on word
5-grams of question and answer against the words around the passage.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BASE, LOWER, PUNCT, U64, buffers, mix64, pick, pieces, prefix_hash, settle, signed, span_hash, table, words

K1, B = 1.2, 0.75
REACH, OVERLAP, GRAM = 0.5, 0.8, 5
#: Share of the reach that terms outside the array-wise bound may give.
COMMON = 0.5
#: Items in one index, and postings in one block of it. More items make more indexes, each used in a pass of its own.
SHARD, BLOCK = 20_000, 16


def hashed_words(data: np.ndarray, off: np.ndarray):
    """(hash, row) of each word; case and punctuation do not count."""
    data = LOWER[data]
    starts, ends, row = words(data, off, PUNCT)
    return span_hash(prefix_hash(data), starts, ends), row


def text_hashes(text: str) -> np.ndarray:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return hashed_words(raw, np.array([0, len(raw)]))[0]


def grams(h: np.ndarray, n: int = GRAM) -> np.ndarray:
    n = min(n, len(h))
    if not n:
        return np.zeros(0, U64)
    g = np.zeros(len(h) - n + 1, U64)
    for j in range(n):
        g = g * U64(BASE) + h[j:len(h) - n + 1 + j]
    return np.unique(mix64(g + U64(n)))


def parts(text: str) -> tuple[str, str]:
    """(question, answer): up to the last question mark and the rest; without one, the last sentence is the answer."""
    if "?" in text.rstrip(" ?\n"):
        at = text.rstrip(" ?\n").rindex("?") + 1
        return text[:at], text[at:]
    cuts = [m.end() for m in re.finditer(r"[.!?\n]+\s+", text.rstrip())]
    return (text[:cuts[-1]], text[cuts[-1]:]) if cuts else (text, text)


class Index:
    """Postings by term, with impacts, in blocks that know their greatest impact."""

    def __init__(self, items: list[tuple[int, str]], whole: tuple[int, float, dict[int, int]] | None = None):
        """``whole``: number of all items, their mean length and {term: items that have it}, where these items are a part."""
        items = sorted(items, key=lambda x: x[0])
        self.ids = [i for i, _ in items]
        toks = [text_hashes(t) for _, t in items]
        self.grams = [grams(t) for t in toks]
        self.halves = [tuple(grams(text_hashes(p)) for p in parts(t)) for _, t in items]
        n, sizes = len(items), np.array([len(t) for t in toks] or [0])
        self.width = max(8, int(sizes.max()))
        doc, term, tf = [], [], []
        for d, t in enumerate(toks):
            u, c = np.unique(t, return_counts=True)
            doc.append(np.full(len(u), d)), term.append(u), tf.append(c)
        doc, term, tf = (np.concatenate(x) if x else np.zeros(0) for x in (doc, term, tf))
        self.terms, term = np.unique(term.astype(U64), return_inverse=True)
        doc = doc.astype(np.int64)
        df, total, mean = np.bincount(term, minlength=len(self.terms)), n, sizes.mean()
        if whole:
            total, mean, of = whole
            df = np.array([of[t] for t in signed(self.terms).tolist()], np.int64)
        idf = np.log(1 + (total - df + 0.5) / (df + 0.5))
        w = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[doc] / max(mean, 1)))
        w = w / np.bincount(doc, w, minlength=n)[doc]
        order = np.lexsort((doc, term))
        self.doc, self.w = doc[order], w[order]
        self.at = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        # Rare terms: the least df bound at which the common terms give every item at most COMMON of the reach.
        by_df = np.sort(np.unique(df))
        for d in by_df if len(by_df) else [0]:
            common = np.bincount(doc, w * (df[term] > d), minlength=n)
            if (common <= REACH * COMMON).all():
                break
        self.need = REACH - common if n and len(by_df) else np.zeros(n)
        self.rare = np.zeros(len(self.terms), bool)
        self.rare[df <= d] = True
        self.blooms = np.zeros(1 << 16, bool)
        self.blooms[(self.terms[self.rare] & U64(0xFFFF)).astype(np.int64)] = True
        self.max = np.zeros(len(self.terms))
        self.blocks = []
        for t in range(len(self.terms)):
            a, b = self.at[t], self.at[t + 1]
            self.max[t] = self.w[a:b].max()
            cut = np.arange(a, b, BLOCK)
            self.blocks.append((self.doc[np.minimum(cut + BLOCK, b) - 1].tolist(), np.maximum.reduceat(self.w[a:b], cut - a).tolist()))
        self.doc_list, self.w_list, self.at_list, self.max_list = self.doc.tolist(), self.w.tolist(), self.at.tolist(), self.max.tolist()

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Term numbers of word hashes that are in the index, -1 for the rest."""
        if not len(self.terms):
            return np.full(len(h), -1)
        i = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[i] == h, i, -1)

    def wand(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """All items whose score reaches ``least``, by block-max WAND over the distinct ``terms``."""
        doc, w, at, top, end = self.doc_list, self.w_list, self.at_list, self.max_list, len(self.ids)
        cursors = [[doc[at[t]], at[t], t] for t in terms]  # next item, its posting, term
        found = []
        while cursors:
            cursors.sort()
            bound, p = 0.0, -1
            for k, c in enumerate(cursors):
                bound += top[c[2]]
                if bound >= least:
                    p = k
                    break
            if p < 0:
                break
            pivot = cursors[p][0]
            while p + 1 < len(cursors) and cursors[p + 1][0] == pivot:
                p += 1
            bound, edge = 0.0, end
            for c in cursors[:p + 1]:
                last, best = self.blocks[c[2]]
                b = bisect_left(last, pivot)
                if b < len(last):
                    bound += best[b]
                    edge = min(edge, last[b])
            if bound < least:  # nothing up to the nearest end of a block, or the next list, can reach it
                target = max(pivot + 1, min(edge + 1, cursors[p + 1][0] if p + 1 < len(cursors) else end))
            elif cursors[0][0] == pivot:
                score = sum(w[c[1]] for c in cursors[:p + 1])
                if score >= least:
                    found.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            for c in cursors[:p + 1]:
                if c[0] < target:
                    c[1] = bisect_left(doc, target, c[1], at[c[2] + 1])
                    c[0] = doc[c[1]] if c[1] < at[c[2] + 1] else end
            cursors = [c for c in cursors if c[0] < end]
        return found

    def overlaps(self, item: int, g: np.ndarray) -> tuple[float, float, float]:
        share = lambda x: float(np.isin(x, g).mean()) if len(x) else 0.0
        q, a = self.halves[item]
        return share(self.grams[item]), share(q), share(a)

    def scan(self, data: np.ndarray, off: np.ndarray):
        """Verified (row, item, score, overlap, question overlap, answer overlap, first word of the passage); one per row and item."""
        h, row = hashed_words(data, off)
        if not len(h) or not len(self.ids):
            return
        at = np.searchsorted(row, np.arange(len(off)))
        seg_n = -(-(at[1:] - at[:-1]) // self.width) + 1  # a spare one parts the rows
        seg0 = np.cumsum(seg_n) - seg_n
        some = np.flatnonzero(self.blooms[(h & U64(0xFFFF)).astype(np.int64)])
        term = self.lookup(h[some])
        ok = term >= 0
        ok[ok] &= self.rare[term[ok]]
        some, term = some[ok], term[ok]
        seg = seg0[row[some]] + (some - at[row[some]]) // self.width
        seg, term = np.divmod(np.unique(seg * len(self.terms) + term), len(self.terms))
        n = self.at[term + 1] - self.at[term]
        post = np.repeat(self.at[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
        m = len(self.ids)
        keys, inv = np.unique(np.repeat(seg, n) * m + self.doc[post], return_inverse=True)
        mass = np.bincount(inv, self.w[post], minlength=len(keys))
        # a passage is two neighbouring segments
        both = np.unique(np.concatenate([keys, keys - m]))

        def get(k):
            i = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
            return np.where(keys[i] == k, mass[i], 0.0) if len(keys) else np.zeros(len(k))

        reach = (both >= 0) & (get(both) + get(both + m) >= self.need[both % m] - 1e-9)
        passages = np.unique(both[reach] // m)
        best = {}
        for s in passages:
            r = int(np.searchsorted(seg0, s, "right")) - 1
            a = at[r] + (s - seg0[r]) * self.width
            b = min(at[r + 1], a + 2 * self.width)
            if a >= b:
                continue
            t = self.lookup(np.unique(h[a:b]))
            got = self.wand(t[t >= 0].tolist(), REACH - 1e-9)
            if not got:
                continue
            g = None
            lo, hi = max(at[r], a - self.width), min(at[r + 1], b + self.width)
            for item, score in got:
                if g is None:
                    g = np.concatenate([grams(h[lo:hi], k) for k in range(1, GRAM + 1)])
                all_, q, ans = self.overlaps(item, g)
                if all_ >= OVERLAP - 1e-9 or (q >= OVERLAP - 1e-9 and ans >= OVERLAP - 1e-9):
                    if (r, item) not in best or best[r, item][0] < score:
                        best[r, item] = (score, all_, q, ans, int(a - at[r]))
        for (r, item), x in sorted(best.items()):
            yield (r, item, *x)


def _item_terms(batches):
    """A row for each item and distinct term of it; the item's length stands in its first row."""
    for b in batches:
        for i in range(b.num_rows):
            h = text_hashes(b.column("text")[i].as_py())
            terms = signed(np.unique(h)) if len(h) else np.zeros(0, np.int64)
            sizes = np.zeros(len(terms), np.int64)
            sizes[:1] = len(h)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(terms), b.column("shard")[i].as_py(), np.int32)), pa.array(terms), pa.array(sizes)], names=["shard", "term", "size"])


def hits(docs: DataFrame, benchmark: DataFrame, shard: int = SHARD) -> DataFrame:
    """(doc_id, item_id, score, overlap, question_overlap, answer_overlap, at_word): one row for each text that holds an item.

    An item is held if 80 % of its word 5-grams, or of its question's and its answer's, occur around a
    retrieved passage (items or halves under five words: all their words in a row). Null or empty texts and
    items hold nothing and are never found; repeated rows give a row each; a null id stays null. The index
    is built from at most about ``shard`` items; more items make more indexes, each a pass over ``docs``. Term counts and
    the mean length are those of all items, so the scores do not depend on how many indexes there are. Items without an
    id are left out.
    """
    items = pick(benchmark, "item_id", "text").filter(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    n = items.count()
    shards = max(1, -(-n // shard))
    of_shard, shares = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int"), None
    if shards > 1:
        terms = settle(items.select(of_shard.alias("shard"), "text").mapInArrow(_item_terms, "shard int, term long, size long"), "terms")
        shares = settle(terms.select("shard", "term").distinct().join(terms.groupBy("term").agg(F.count("*").alias("df")), "term"), "term-counts")
        mean = (terms.agg(F.sum("size")).first()[0] or 0) / max(n, 1)
    rows = pick(docs, "doc_id", "text")
    kind, item_kind = rows.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, score double, overlap double, question_overlap double, answer_overlap double, at_word int"
    out = None
    for s in range(shards):
        got = items.filter(of_shard == s).collect()
        whole = (n, mean, {r["term"]: r["df"] for r in shares.filter(F.col("shard") == s).collect()}) if shares is not None else None  # of this part's terms
        index = docs.sparkSession.sparkContext.broadcast(Index(sorted((r[0], r[1]) for r in got), whole))
        types = (pa.int64() if kind == "bigint" else None, pa.int64() if item_kind == "bigint" else None)

        def run(batches, index=index, types=types):
            ix = index.value
            for b in batches:
                data, off = buffers(b.column(1))
                found = [(i + x[0], *x[1:]) for i, d, o in pieces(data, off) for x in ix.scan(d, o)]
                if found:
                    r, item, *rest = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(r)), pa.array([ix.ids[i] for i in item], types[1]), *[pa.array(x, pa.float64()) for x in rest[:4]], pa.array(rest[4], pa.int32())],
                        names=["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap", "at_word"])

        one = rows.mapInArrow(run, schema)
        out = one if out is None else out.union(one)
    return out


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item, with their columns. Rows sharing a contaminated row's doc_id go with it, rows
    without an id with any such row; null and empty texts hold nothing; an empty table, or no items, changes nothing."""
    bad = settle(hits(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("bad")).distinct(), "leaks")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"))
    return rows.join(bad, rows["id"].eqNullSafe(bad["bad"]), "left_anti").select("row.*")
