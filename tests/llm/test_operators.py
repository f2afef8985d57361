"""Each training-data operator against a brute-force version on small tables with odd rows."""

import collections
import hashlib
import re
import tempfile
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import ann, decontam, hpylm, html_text, langid, licences, minhash, mixing, suffix_dedup, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rid string, row string"
RNG = np.random.default_rng(5)
VOCABULARY = ["".join(RNG.choice(list("abcdefghij"), 5)) for _ in range(400)]


def prose(n):
    return " ".join(RNG.choice(VOCABULARY, n))


@pytest.fixture(scope="module")
def texts():
    base, shared = [prose(200) for _ in range(6)], prose(90)
    near = base[0].split()
    near[100] = "changed"
    rows = [*base, base[0], " ".join(near), base[1] + " " + shared, shared + " " + prose(150), None, "", "one", "one", "x" * 1500,
            ("line of words again " * 80), "é" * 700 + base[2], prose(30000)]
    return list(enumerate(rows)) + [(3, base[3]), (None, prose(20))]


@pytest.fixture(scope="module")
def docs(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}" if i != 4 else None, 1, "clash", "clash") for i, t in texts], DOCS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], DOCS)


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute_spans(texts, width=400):
    raw = [(t or "").encode() for _, t in texts]
    seen = collections.Counter(t[i:i + width] for t in raw for i in range(len(t) - width + 1))
    out = []
    for t in raw:
        mark = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if seen[t[i:i + width]] > 1:
                mark[i:i + width] = True
        out.append((len(t), int(mark.sum()), int((np.diff(np.concatenate([[0], mark, [0]]).astype(int)) == 1).sum()), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~mark])).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [10_000, 1])
def test_suffix_dedup(docs, texts, none, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (400, 32, False, hot))
    _, cut = suffix_dedup.remove_repeats(docs)
    got = collections.Counter((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in cut.collect())
    assert got == collections.Counter(x for x in brute_spans(texts) if x[1])
    assert suffix_dedup.remove_repeats(none)[1].count() == 0


def test_suffix_dedup_keeps_the_first(docs, texts):
    _, cut = suffix_dedup.remove_repeats(docs, keep_first=True, whole_chars=True)
    assert 0 < sum(r.n_removed for r in cut.collect()) < sum(x[1] for x in brute_spans(texts))
    stage = suffix_dedup.stage(docs.sparkSession, docs, "")
    assert stage.columns == docs.columns and stage.count() == len(texts)


def test_longest_previous_factor():
    t = b"abracadabra"
    want = [max([0, *[next(k for k in range(len(t) + 1) if i + k >= len(t) or t[i + k] != t[j + k]) for j in range(i)]]) for i in range(len(t))]
    assert suffix_dedup.longest_previous_factor(t).tolist() == want


def test_near_groups(docs, texts, none):
    sets = [frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if (w := tokens(t)) else frozenset() for _, t in texts]
    up = list(range(len(sets)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) >= 0.8 * len(a | b):
                up[max(find(i), find(j))] = min(find(i), find(j))
    sizes = collections.Counter(find(i) for i in range(len(sets)))
    rows = minhash.near_groups(docs).collect()
    assert sorted(r.class_size for r in rows) == sorted(sizes[find(i)] for i in range(len(sets)))
    assert len({r.class_rid for r in rows}) == len(sizes) == sum(r.keep for r in rows)
    assert minhash.near_groups(none).count() == 0
    weighted = minhash.near_groups(docs, weighted=True).collect()
    assert len({r.class_rid for r in weighted}) == len(sizes)


def test_prob_min_hash_estimates_probability_jaccard():
    x, y = np.array([3.0, 1, 2, 0, 4]), np.array([1.0, 1, 0, 5, 4])
    truth = sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in range(5)) for d in range(5) if x[d] and y[d])
    assert minhash.probability_jaccard(x, y) == pytest.approx(truth)
    items = np.arange(1, 6, dtype=np.uint64) * np.uint64(7919)
    a, b = x > 0, y > 0
    sig = minhash.prob_min_hash(np.repeat([0, 1], [a.sum(), b.sum()]), np.concatenate([items[a], items[b]]), np.concatenate([x[a], y[b]]), 2, 4000)
    assert (sig[0] == sig[1]).mean() == pytest.approx(truth, abs=0.04)


def test_mixing(docs, texts, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(texts) and rows == mixing.mix(docs).collect() or sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert 0 <= r.taken <= 3 * r.size and r["size"] >= 0
    assert sum(r["size"] for r in rows) == sum(len(tokens(t)) for _, t in texts)
    for v in by.values():
        assert sum(r.taken for r in v) == int(v[0].target) and v[0].target <= 3 * v[0].source_size
    assert mixing.mix(none).count() == 0


def test_language_id(spark, none):
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["zwk", "qxv", "jyh"]}
    rows = [(i, " ".join(RNG.choice(words[l], 30)), l) for i in range(300) for l in [("aa", "bb")[i % 2]]]
    rows += [(1000, None, "aa"), (1001, "12 34", "bb"), (1002, "lorem " * 3000, None), (None, "zwk qxv jyh " * 9, "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert len(got) == len(rows)
    held = [(i, l) for i, _, l in rows[:300] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i].lang_pred == l for i, l in held]) > 0.97
    assert got[1000].lang_pred == got[1001].lang_pred == "und" and got[1002].lang_pred == "aa" and got[None].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.train(none) is None and {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    raw, model_of = b"zwk lorem", lambda o, d: langid.classify(np.frombuffer(d, np.uint8), np.array(o), model)
    assert np.allclose(model_of([0, 9], raw)[0], model_of([0, 100, 109], b"lorem " * 16 + b"lore" + raw)[1], atol=1e-5)
    runs = langid.positions("lorem ipsum", model)
    assert runs[0][0] == 0 and runs[-1][1] == 11


def test_decontamination(spark, docs, texts, none):
    items = [(1, texts[0][1][:300]), (2, prose(40)), (3, None), (4, "What is it? " + prose(30)), (4, "What is it? " + prose(30)), (5, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    extra = spark.createDataFrame([(100, prose(500) + " " + items[1][1].upper() + ". " + prose(500)), (101, items[3][1]), (101, items[3][1]), (102, None)], "doc_id long, text string")
    got = collections.Counter((r.doc_id, r.item_id) for r in decontam.hits(docs.select("doc_id", "text").union(extra), bench, shard=2).collect())
    assert got == {(0, 1): 1, (6, 1): 1, (7, 1): 1, (100, 2): 1, (101, 4): 2}
    assert decontam.hits(none, bench).count() == 0 and decontam.hits(docs, bench.limit(0)).count() == 0


def test_wand_finds_all_above_the_threshold():
    ix = decontam.Index([(i, prose(30)) for i in range(300)])
    for _ in range(20):
        t = [int(x) for x in ix.lookup(np.unique(decontam.text_hashes(prose(80)))) if x >= 0]
        scores = np.zeros(300)
        for x in t:
            scores[ix.doc[ix.at[x]:ix.at[x + 1]]] += ix.w[ix.at[x]:ix.at[x + 1]]
        got = dict(ix.wand(t, 0.25))
        assert set(got) == set(np.flatnonzero(scores >= 0.25).tolist()) and all(scores[d] == pytest.approx(s) for d, s in got.items())


def test_warc(spark, tmp_dir):
    long, odd = "<p>" + "x" * 2000, "WARC/1.1\r\n\r\n" * 100
    rows = [(1, "http://a.b/x", long), (2, "https://www.a.b/x", long), (3, None, None), (4, "u\r\nX: y%0A", odd), (5, "http://b", "short"), (6, "http://b", "short"),
            (None, "http://c", long), (7, "http://d", odd), (7, "http://d", odd), (8, "http://e", "é" * (1 << 17))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.index(spark, warc.write(pages, tmp_dir + "/w")).collect()
    assert len(got) == len(rows) and {(r.page_id, r.url) for r in got} == {(i, u) for i, u, _ in rows}
    keys = [(r.url_key, r.ts, r.page_id or 0) for r in got]
    assert keys == sorted(keys)
    by = {(r.page_id, r.payload_bytes): r for r in got}
    for i, _, h in rows:
        raw = (h or "").encode()
        r = by[i, len(raw)]
        latest = {long: 2, odd: 7}.get(h)
        assert r.payload_digest == hashlib.sha1(raw).hexdigest() and r.refers_to == (latest if latest not in (None, i) else None)
        assert r.record_type == ("response" if r.refers_to is None else "revisit")
    assert warc.index(spark, warc.write(pages.limit(0), tmp_dir + "/e")).count() == 0


def test_loser_tree():
    for _ in range(100):
        runs = [sorted((int(x), i) for x in RNG.integers(0, 9, RNG.integers(0, 6))) for i in range(RNG.integers(0, 9))]
        assert list(warc.loser_tree([[(x, x) for x in r] for r in runs])) == sorted(x for r in runs for x in r)


@pytest.mark.parametrize("cell", [8192, 100])
def test_ann(spark, cell):
    x = RNG.normal(size=(1500, 16)).astype("float32")
    x[100:160] = x[100]
    x[::7] *= 3
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(2000, None), (2020, []), (2040, [0.0] * 16), (2060, [float("nan")] * 16), (2080, [None] + [1.0] * 15), (2100, [1.0]), (None, [1.0] * 16)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.pmod("vec_id", F.lit(20)) == 0, cell=cell).collect()
    by = collections.defaultdict(dict)
    for r in got:
        by[r.query_id][r["rank"]] = (r.vec_id, r.score)
    d, hit = x.astype(float), 0
    assert sorted(by) == list(range(0, 1500, 20))
    for q, found in by.items():
        s = (d * d[q]).sum(1)
        order = [i for i in np.lexsort((np.arange(1500), -s)) if i != q][:20]
        assert sorted(found) == list(range(1, 21)) and all(v[1] == pytest.approx(s[v[0]], rel=1e-12) for v in found.values())
        keys = [(-v[1], v[0]) for _, v in sorted(found.items())]
        assert keys == sorted(keys)
        hit += len({v[0] for v in found.values()} & set(order))
    assert hit >= 0.9 * 20 * len(by)
    assert ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_ann_splits_the_queries_of_a_block(spark):
    x = np.random.default_rng(8).normal(size=(1200, 12)) * 1e6
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    ask = F.pmod("vec_id", F.lit(4)) == 0
    split = ann.search(rows, ask, cell=150, per_task=20)
    tasks = split._jdf.queryExecution().toString()
    assert len(re.findall(r"hashpartitioning\(cell#\d+, block#\d+, part#\d+", tasks)) >= 2
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in split.collect())
    assert got == sorted((r.query_id, r["rank"], r.vec_id) for r in ann.search(rows, ask, cell=150, per_task=10**6).collect())
    best = {q: [i for i in np.lexsort((np.arange(1200), -(x @ x[q]))) if i != q][:20] for q in range(0, 1200, 4)}
    assert len(got) == 300 * 20 and sum(v in best[q] for q, _, v in got) >= 0.9 * len(got)


def test_html_text(spark):
    body = "<p>First, one &amp; two   of the words that make a paragraph, long enough.<p>Second, with <b>bold</b><br>and <a href=x>link</a> text, long enough too."
    page = f"<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body><nav><a>menu</a></nav><div class='cookie-notice'>We, use, cookies, everywhere, always.</div><article><h1>Title</h1>{body}<div id=comments><p>Nice, very nice, so very nice, thanks.</div></article><footer>foot</footer></body>"
    want = "Title\nFirst, one & two of the words that make a paragraph, long enough.\nSecond, with bold and link text, long enough too."
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "<p>cut off <b"), (5, "u", page.replace("article", "div")), (1, "u", page), (6, "u", "<ul>" * 3000)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r.text for r in got if r.page_id in (1, 5)] == [want] * 3
    assert {r.page_id: r.text for r in got if r.page_id in (2, 3, 4, 6)} == {2: "", 3: "", 4: "cut off", 6: ""}
    assert all(r.n_chars == len(r.text) for r in got)


LONG = "A paragraph, with commas, that is long enough, by far, to be scored as text of the page."


@pytest.mark.parametrize("name", ["content has-sidebar", "no-comments", "header-fixed", "search-results", "legal-opinion"])
def test_html_text_wrapper_names(name):
    body = f"<h1>Title</h1><p>{LONG}</p><div class=comments><p>Nice, so nice, thanks for the text.</p></div>"
    assert html_text.extract(f"<body><div class='{name}'><article>{body}</article></div><div class=related><p>{LONG}</p></div></body>") == f"Title\n{LONG}"
    assert html_text.extract(f"<body><div class='{name}'>{body}<p>{LONG}</p></div><div class=top>Site</div></body>") == f"Title\n{LONG}\n{LONG}"
    assert html_text.extract(f"<body><article><p>{LONG}</p><div id=comments>{f'<p>{LONG}</p>' * 5}</div></article></body>") == LONG


def test_html_text_keeps_links_in_the_article():
    for tag in ("article", "main", "div"):
        page = f"<body><ul><li><a href=h>Home</a></ul><{tag}><p>{LONG}</p><p><a href=x>A linked title</a></p><ul><li><a href=y>Reference one</a></ul></{tag}></body>"
        assert html_text.extract(page) == f"{LONG}\nA linked title\nReference one"


def test_html_text_keeps_short_sections():
    parts = f"<section><h2>One</h2>{f'<p>{LONG}</p>' * 6}</section><section><h2>Two</h2><p>Short.</p></section><h2>Three</h2><ul><li>item</ul>"
    want = "\n".join(["One", *[LONG] * 6, "Two", "Short.", "Three", "item"])
    for tag in ("main", "div"):
        assert html_text.extract(f"<body><div><a href=h>Home</a></div><{tag}>{parts}</{tag}><div><a href=h>More</a></div></body>") == want


def test_hpylm(spark, docs, texts, none):
    rows = hpylm.score_texts(docs, hpylm.held_out(), shard_bytes=100_000).collect()
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i, _ in texts]
    toks = [[*tokens(t), None] for _, t in texts]
    c = collections.Counter(w for t, h in zip(toks, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((h, len(t), sum(w in c for w in t), round(sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for t, h in zip(toks, held))
    assert sorted((r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == want
    assert {r.train_tokens for r in rows} == {n} and all(r.score < 0 for r in rows)
    assert hpylm.score_texts(none, hpylm.held_out()).count() == 0


def scored(spark, rows, **kw):
    """{doc_id: row} of the scores; the texts of ``rows`` with a negative doc_id are held out."""
    path = tempfile.mkdtemp(prefix="hpylm-") + "/d.parquet"
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(path)
    return {r.doc_id: r for r in hpylm.score_texts(spark.read.parquet(path), F.col("doc_id") < 0, **kw).collect()}


@pytest.mark.parametrize("shard_bytes", [1 << 30, 100_000])
def test_hpylm_every_word_is_a_context(spark, shard_bytes):
    # 6000 words, each always before its own successor: more than any fixed number of contexts
    rows = [(i, f"a{i} b{i}") for i in range(6000)] * 10
    got = scored(spark, rows + [(-1 - i, f"a{i} b{i}") for i in range(50)], shard_bytes=shard_bytes)
    first, follows = np.log10((10 - 0.75) / 60005), np.log10((10 - 0.75) / 15)
    assert abs(np.mean([got[-1 - i].score for i in range(50)]) - first - 2 * follows) < 0.15


def test_hpylm_learns_nothing_from_held_out(spark):
    rows = [(k, " ".join(f"a{i} b{i}" for i in range(k, 1500, 5))) for k in range(5)] * 4
    plain = scored(spark, rows)
    more = scored(spark, rows + [(-1 - k, " ".join(f"w{i}" for i in range(1200))) for k in range(10)])
    assert all(more[k].train_tokens == r.train_tokens and abs(more[k].score - r.score) < 1e-6 for k, r in plain.items())


def test_hpylm_cells_hold_pairs_not_occurrences(spark):
    rows = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array([False] * 40), pa.array(["hot " * 5000] * 40)], names=["rid", "held_out", "text"])
    asked = [x for b in hpylm._deal(3, True)([rows]) for x in b.to_pylist()]
    cells = [hpylm._join(pd.DataFrame([x for x in asked if x["cell"] == c])).iloc[0] for c in {x["cell"] for x in asked}]
    learnt = [hpylm._read(c["pairs"])[4] for c in cells]
    assert sum(len(x) for x in learnt) == 3 and sorted(np.concatenate(learnt)) == [40, 40, 40 * 4999]
    assert sum(len(b) for c in cells for b in c["asked"]) < 1000


def test_seat_bounds():
    n = np.array([0, 1, 5, 1000, 100000])
    t = hpylm.seat(np.random.default_rng(1), n, np.full(5, 0.5), 0.5)
    assert t[0] == 0 and t[1] == 1 and (t <= n).all() and (t[1:] >= 1).all()


def test_licences(spark, docs, none):
    lines = ["Released under the MIT License.", "All rights reserved.", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3."]
    rows = [(1, prose(40) + "\n" + lines[0]), (2, lines[1] + "\n" + prose(50)), (3, None), (4, ""), (5, lines[2]), (5, lines[2]), (6, prose(20000) + "\n\n" + lines[3]), (7, "the work of the version is used in the form")]
    both = spark.createDataFrame(rows, "doc_id long, text string").union(docs.select("doc_id", "text"))
    got = sorted((r.doc_id, r.paragraph, r.family) for r in licences.scan(both, licences.train(both)).collect() if r.confirmed)
    assert got == [(1, 1, "MIT"), (2, 0, "Proprietary"), (5, 0, "CC-BY-NC"), (5, 0, "CC-BY-NC"), (6, 2, "GPL")]
    assert licences.scan(none, licences.train(none)).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as P

    assert [n for n, _ in P.STAGES] == ["language_id", "near_duplicates", "suffix_dedup", "decontamination", "mixing"]
    rows = P.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(0 <= r.taken <= 3 * r.size for r in rows)


def test_licences_wrapped_notices(spark, docs):
    notices = {
        "Apache-2.0": ["you may not use this file except in compliance with the License.", "You may obtain a copy of the License at", "http://www.apache.org/licenses/LICENSE-2.0"],
        "BSD": ["Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions are met"],
        "GPL": ["This program is free software: you can redistribute it and/or modify it", "under the terms of the GNU General Public License as published by the", "Free Software Foundation"]}
    rows, want = [], []
    for n, (family, lines) in enumerate(notices.items()):
        rows += [(3 * n, "\n".join(lines)), (3 * n + 1, "\n".join([prose(30), prose(30), "/*", *[f" * {x}" for x in lines], " */", prose(30)])),
                 (3 * n + 2, "\n".join([prose(12), *lines, prose(12), prose(12)]))]
        want += [(3 * n, 0, family), (3 * n + 1, 3, family), (3 * n + 2, 1, family)]
    one = [(90, prose(12) + "\nReleased under the MIT License.\n" + prose(12))]
    both = spark.createDataFrame(rows + one, "doc_id long, text string").union(docs.select("doc_id", "text"))
    model = licences.train(both)
    got = licences.scan(spark.createDataFrame(rows + one, "doc_id long, text string"), model).collect()
    assert sorted((r.doc_id, r.paragraph, r.family) for r in got if r.confirmed) == [*want, (90, 1, "MIT")]
    assert all(r.template_share == 1 and r.text.count("\n") == len(notices[r.family]) - 1 for r in got if r.confirmed and r.doc_id < 90)
