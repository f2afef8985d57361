"""Byte-level BPE, fill-in-middle and the filter audit against the tokenizer's library and brute force."""

import collections
import hashlib
import itertools
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from strata.llm import byte_bpe, filter_audit, fim

RNG = np.random.default_rng(11)
ROWS = [(1, "The quick brown fox, don't stop 1234!\n\n  it's we'll"), (2, None), (3, ""), (4, "  \t\n \r\n x "), (5, "naïve façade 東京 🙂🙂 é"),
        (5, "naïve façade 東京 🙂🙂 é"), (None, "no id\nat all"), (6, "x" * 3000 + "ab" * 700 + " " * 900), (7, "word " * 40_000 + "end"),
        (8, "<P> a\nb\n"), (9, "one line"), (10, "\n\n\n"), (11, "a\nb\nc\nd\n" * 500), (12, "tail <S"), (13, "<|endoftext|> £ ½ Ⅷ ²  \u0085z")]
SCHEMA = "doc_id long, text string, key string, ids string, block string, n string, row string"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d.parquet")
    spark.createDataFrame([(i, t, "k", "i", "b", "n", "r") for i, t in ROWS], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name, long", [("byte_bpe_50k.tiktoken", 512), ("byte_bpe_multi_50k.tiktoken", 3)])
def test_bpe_equals_the_library(spark, docs, none, name, long):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(name))
    enc = library(ranks)
    coded = byte_bpe.encode(docs, ranks, long=long)
    got = [(r.doc_id, r.ids, bytes(r.b)) for r in byte_bpe.decode(coded, ranks, into="b").collect()]
    assert sorted(got, key=repr) == sorted([(i, enc.encode_ordinary(t or ""), (t or "").encode()) for i, t in ROWS], key=repr)
    assert byte_bpe.encode(none, ranks).count() == 0


def test_bpe_parts_of_blocks(spark, docs):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
    enc = library(ranks)
    got = sorted(((r.doc_id, r.ids) for r in byte_bpe.encode(docs, ranks, part_words=7).collect()), key=repr)
    assert got == sorted(((i, enc.encode_ordinary(t or "")) for i, t in ROWS), key=repr)


def test_bpe_folds_every_word(spark, docs, monkeypatch):
    # the main path gives no word to the heap
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
    words = [w for _, t in ROWS for w in library(ranks).decode_batch([[x] for x in library(ranks).encode_ordinary(t or "")])]
    words = [w for w in {*words, " unbelievably", "qqqqzzzzqqqq", "aaaaaaaaaaaaaaaa", "東京都", "🙂", "", " ", "mississippi"}]
    got = {r.w: r.ids for r in spark.createDataFrame([(w,) for w in words] + [(None,)], "w string").select("w", byte_bpe.fold(F.col("w"), ranks).alias("ids")).collect()}
    assert got[None] is None and got[""] == []
    for w in words:
        if w:
            assert got[w] == byte_bpe.merge_long(w.encode(), ranks), w


def test_bpe_of_a_token_that_merges_miss(spark):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abcd": 258, b"abc": 259}
    ranks[b"xyz"] = 260  # no pair of tokens joins to it
    rows = [("xyz",), ("abcd",), ("xyzx",), ("abcab",), ("bcbcab",)]
    got = {r.w: r.ids for r in spark.createDataFrame(rows, "w string").select("w", byte_bpe.fold(F.col("w"), ranks).alias("ids")).collect()}
    enc = library(ranks)
    assert got == {w: enc.encode_ordinary(w) for w, in rows}


def test_bpe_splits_every_code_point_as_the_library(spark):
    ranks = {bytes([b]): b for b in range(256)}
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    rows = [(c, f"a{chr(c)}a 1{chr(c)}1.{chr(c)}. {chr(c)}") for c in codes]
    enc = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    parts = {r.c: r.w for r in spark.createDataFrame(rows, "c int, t string").select("c", byte_bpe.split(F.col("t")).alias("w")).collect()}
    letter, number = (tiktoken.Encoding(k, pat_str=k, mergeable_ranks=ranks, special_tokens={}) for k in (r"\p{L}", r"\p{N}"))
    space = tiktoken.Encoding("s", pat_str=r"\s", mergeable_ranks=ranks, special_tokens={})
    every = "".join(map(chr, codes))
    letters, numbers, spaces = (set(bytes(e.encode_ordinary(every)).decode()) for e in (letter, number, space))
    assert len(letters) > 100_000 and enc.encode_ordinary("a") == [97]
    for c, t in rows:
        x = chr(c)
        kind = "L" if x in letters else "N" if x in numbers else "S" if x in spaces else "O"
        joined = {"L": [f"a{x}a", " 1", x, "1", ".", x, ".", f" {x}"], "N": ["a", x, "a", f" 1{x}1", ".", x, ".", f" {x}"],
                  "O": ["a", x, "a", " 1", x, "1", f".{x}.", f" {x}"]}.get(kind)
        if joined:
            assert parts[c] == joined, (hex(c), kind, parts[c])
        else:
            assert "".join(parts[c]) == t and parts[c][0] == "a" and parts[c][-1] == f" {x}", (hex(c), parts[c])


def test_decode_odd_ids(spark):
    ranks = {bytes([b]): b for b in range(256)}
    rows = spark.createDataFrame([(1, [104, 105]), (2, []), (3, None)], "i int, ids array<int>")
    assert {r.i: r.b for r in byte_bpe.decode(rows.withColumn("b", F.lit("clash")), ranks, into="b").collect()} == {1: b"hi", 2: b"", 3: None}
    assert byte_bpe.decode(rows.limit(0), ranks).count() == 0
    for odd in (999, -1):
        with pytest.raises(Exception, match=f"no token has the id {odd}"):
            byte_bpe.decode(spark.createDataFrame([([104, odd],)], "ids array<int>"), ranks).collect()
    with pytest.raises(Exception, match="no token has the id 300"):
        byte_bpe.decode(spark.createDataFrame([([300],)], "ids array<int>"), {**ranks, b"long": 301}).collect()


def test_skip_list():
    for n in [0, 1, 2, 7, 8, 9, 63, 64, 65, 1000]:
        widths = RNG.integers(1, 50, n).tolist()
        for fan in (2, 8):
            s = fim.SkipList(widths, fan)
            assert [s.locate(r) for r in range(n + 1)] == [0, *np.cumsum(widths).tolist()]
            assert len(s.lanes) <= 1 + np.ceil(np.log(max(n, 2)) / np.log(fan))
    with pytest.raises(IndexError):
        fim.SkipList([1]).locate(2)


@pytest.mark.parametrize("rate, spm", [(100, 50), (40, 0), (100, 100), (0, 50)])
def test_fill_in_middle(docs, none, rate, spm):
    got = fim.restored(fim.fill_in_middle(docs, rate=rate, spm=spm)).collect()
    assert len(got) == len(ROWS) and fim.fill_in_middle(none).count() == 0
    want = []
    for i, t in ROWS:
        t = t or ""
        u = re.findall(r"[^\n]*\n|[^\n]+", t)
        h = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
        a, z = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
        p, m, s = "".join(u[:a]), "".join(u[a:z]), "".join(u[z:])
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
            want.append((i, len(u), "plain", None, None, t, t))
        elif h4 % 100 < spm:
            want.append((i, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", t))
        else:
            want.append((i, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", t))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_restore_where_signs_touch_the_cut():
    for p, m, s in itertools.product(["<", "a<S", "<P", ""], ["<M", "<S", "", "b"], ["M>", "S>x", ""]):
        text = p + m + s
        if not any(x in text for x in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE)):
            assert fim.restore("psm", f"<P>{p}<S>{s}<M>{m}") == fim.restore("spm", f"<S>{s}<P>{p}<M>{m}") == text
    with pytest.raises(ValueError):
        fim.restore("psm", "no signs")


def audit_rows():
    words = ["w%d" % i for i in range(200)]
    texts = [" ".join(RNG.choice(words, RNG.integers(1, 260))) for _ in range(40)]
    texts += [t.upper() for t in texts[:10]] + [t + " #" for t in texts[:10]] + [" ".join(words), "ABC", None, "", "é" * 9 + "A", "a b " * 120]
    rows = [(int(i), texts[int(RNG.integers(len(texts)))], ["en", "de", None, "", "fr"][int(RNG.integers(5))]) for i in RNG.integers(0, 400, 600)]
    rows += [(None, texts[0], "en")] * 3 + [(None, "only here", "en")] + [(-5, texts[1], "xx"), (-5, texts[1], "xx"), (-5, texts[1], "en"), (7, "word " * 50_000, "en")]
    labels = [(int(i), int(RNG.integers(2)), int(RNG.integers(2))) for i in RNG.integers(0, 400, 200)] + [(None, 1, 1), (-5, None, 1), (-5, 1, None)]
    return rows, labels


def test_filter_audit(spark):
    rows, labels = audit_rows()
    docs = spark.createDataFrame([(i, t, p, "x", 1, "y") for i, t, p in rows], "doc_id long, text string, lang string, part string, n long, digest string").repartition(5)
    marks = spark.createDataFrame([(i, q, x, 1) for i, q, x in labels], "doc_id long, quality int, toxic int, id int").repartition(2)
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.audit(docs, marks).collect()}
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    by = collections.defaultdict(list)
    for i, t, p in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and any(j is not None and j < i and (s or "") == t for j, s, _ in rows)}
        by[p or ""].append(({f for f in fails if fails[f]}, i in good, i in toxic))
    want = {}
    for part, seen in by.items():
        shares = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = seen
            for k, f in enumerate(order):
                out = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shares[f] += len(out)
                want[part, "".join(order), k + 1] = [len(left), len(out), sum(f in x[0] for x in seen) - len(out), sum(x[0] == {f} for x in seen), sum(x[1] for x in out), sum(x[2] for x in out)]
        for (p, order, k), v in want.items():
            if p == part:
                v.append(shares[order[k - 1]])
    assert got == {k: tuple(v) for k, v in want.items()}
    assert len(got) == 600 * len(by)
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    assert filter_audit.audit(docs, marks.limit(0)).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_tensor_figures_by_counting():
    t = RNG.integers(0, 9, (3, 2, 2, 2, 2, 2))
    rows = filter_audit.order_figures(*t)
    assert len(rows) == 600 and sum(r[3] for r in rows if r[0] == "ABCDE") + next(r[2] for r in rows if r[:2] == ("ABCDE", 5)) == t[0].sum()
    o, k, kept, removed, redundant, unique, good, toxic, _ = next(r for r in rows if r[:2] == ("CADBE", 3))
    n = t[0]  # third filter is D, after C and A
    assert removed == n[0, :, 0, 1, :].sum() and kept == n[0, :, 0, 0, :].sum() and redundant == n[:, :, :, 1, :].sum() - removed and unique == n[0, 0, 0, 1, 0]
    assert good == t[1][0, :, 0, 1, :].sum() and toxic == t[2][0, :, 0, 1, :].sum()


def test_words_travel_in_packs():
    """A pack names each block's words in order with their ids, long words merged; texts of blocks with other words are an error."""
    ranks = byte_bpe.read_ranks(byte_bpe.public_tokenizers.path(byte_bpe.VOCABULARY))
    at = [[{"block": 1, "mark": None, "place": 1}, {"block": 0, "mark": 5, "place": 0}], [{"block": 1, "mark": 6, "place": 0}]]
    kind = byte_bpe.pa.list_(byte_bpe.pa.struct([("block", byte_bpe.pa.int64()), ("mark", byte_bpe.pa.int64()), ("place", byte_bpe.pa.int32())]))
    ids = byte_bpe.pa.array([[7, 8], None], byte_bpe.pa.list_(byte_bpe.pa.int32()))
    batch = byte_bpe.pa.RecordBatch.from_arrays([byte_bpe.pa.array(at, kind), byte_bpe.pa.array([None, "hello"]), ids], names=["at", "word", "ids"])
    got = byte_bpe.pa.Table.from_batches(byte_bpe._deal(ranks)([batch, batch.slice(0, 0)])).to_pylist()
    numbers = lambda raw: byte_bpe.np.frombuffer(byte_bpe.zstandard.decompress(raw), byte_bpe.np.int32).tolist()
    hello = byte_bpe.merge_long(b"hello", ranks)
    assert [(r["block"], r["mark"], r["is_text"], *(numbers(r[c]) for c in ("keys", "sizes", "places"))) for r in got] == [
        (0, 5, False, [0], [2], [7, 8]), (1, 6, False, [0, 1], [len(hello), 2], [*hello, 7, 8])]
    at[0][0]["mark"] = 4
    with pytest.raises(ValueError, match="stable scan"):
        list(byte_bpe._deal(ranks)([byte_bpe.pa.RecordBatch.from_arrays([byte_bpe.pa.array(at, kind), byte_bpe.pa.array([None, "hello"]), ids], names=["at", "word", "ids"])]))
