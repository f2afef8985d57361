"""Each stage of the pipeline against a brute-force version, on documents with planted cases and odd rows."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import decontam, langid, minhash, mixing, suffix_dedup

RNG = np.random.default_rng(21)
WORDS = ["".join(RNG.choice(list("abcdefghijklmnop"), RNG.integers(2, 9))) for _ in range(3000)]
#: A caller's own columns, with names that the stages use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, row string, `__rid` long, `__bad` string, bad long, id string, kept string"


def prose(n):
    return " ".join(RNG.choice(WORDS, n))


def frame(spark, texts, path, lang="en"):
    rows = [(i, t, lang, f"s{k % 3}", None, 7, "r", 8, "b", 9, "i", "k") for k, (i, t) in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def kept(df):
    return collections.Counter((r.doc_id, r.text) for r in df.collect())


def cut_later_copies(texts, width):
    """What is left if each byte goes that a ``width``-byte string covers which started before, in the order of the rows."""
    seen, out = set(), []
    marks = []
    for t in texts:
        raw = (t or "").encode()
        mark = np.zeros(len(raw), bool)
        for i in range(len(raw) - width + 1):
            s = raw[i:i + width]
            if s in seen:
                mark[i:i + width] = True
            seen.add(s)
        marks.append((raw, mark))
    for raw, mark in marks:
        out.append(bytes(b for b, m in zip(raw, mark) if not m).decode())
    return out


@pytest.mark.parametrize("n", [51, 60, 80, 150])
def test_suffix_stage_cuts_passages_of_over_50_words(spark, tmp_path, n):
    passages = [prose(n) for _ in range(4)]
    texts = [(i, f"{prose(80)} {p} {prose(70)}") for i, p in enumerate(passages)]
    texts += [(10 + i, f"{prose(30)} {p} {prose(40)}") for i, p in enumerate(passages)] + [(20, f"{passages[0]}")]
    texts += [(30, None), (31, ""), (32, prose(120)), (None, prose(90)), (40, "again " * 200), (41, passages[1][:150])]
    docs = frame(spark, texts, str(tmp_path / "d"))
    out = suffix_dedup.stage(spark, docs, "")
    assert out.columns == docs.columns
    rows = out.collect()
    want = cut_later_copies([t for _, t in texts], suffix_dedup.STAGE_WIDTH)
    assert kept(out) == collections.Counter(zip([i for i, _ in texts], want))
    assert all(r.n_chars == len(r.text) for r in rows)
    for i, p in enumerate(passages):
        held = [r.doc_id for r in rows if p in r.text]
        assert held == [i]
    untouched = {i: t for i, t in texts if i in (32, None, 41)}
    assert all(r.text == untouched[r.doc_id] for r in rows if r.doc_id in untouched)


def test_near_stage_leaves_one_of_each_group(spark, tmp_path):
    base = [prose(120) for _ in range(8)]
    texts = list(enumerate(base)) + [(20, base[0]), (21, base[0]), (22, base[1].replace(base[1].split()[60], "other")), (23, base[2] + " more"), (3, base[3]),
                                     (None, base[4]), (24, None), (25, ""), (26, None), (27, "short text"), (28, "short text")]
    docs = frame(spark, texts, str(tmp_path / "d"))
    sets = [frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if (w := re.findall(r"[^\x20\x09-\x0D]+", t or "")) else frozenset() for _, t in texts]
    up = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if (a and b and len(a & b) >= 0.8 * len(a | b)) and up[i] == i:
                up[i] = up[j]
    out = minhash.stage(spark, docs, "")
    rows = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == docs.columns
    held = collections.Counter(up[texts.index(x)] for x in rows if x[1])
    assert set(held.values()) == {1} and set(held) == {up[i] for i, s in enumerate(sets) if s}


def test_decontamination_stage(spark, tmp_path, monkeypatch):
    items = [prose(40) for _ in range(6)]
    texts = [(i, f"{prose(60)} {t} {prose(50)}") for i, t in enumerate(items[:4])] + [(10, prose(300)), (11, None), (12, ""), (2, prose(50)), (None, prose(60)), (13, items[4][:80])]
    docs = frame(spark, texts, str(tmp_path / "d"))
    spark.createDataFrame([*enumerate(items), (None, prose(40)), (9, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = decontam.stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and kept(out) == collections.Counter((i, t) for i, t in texts if i not in (0, 1, 2, 3))
    assert decontam.stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_scores_do_not_depend_on_the_number_of_indexes(spark):
    common = prose(27)
    items = spark.createDataFrame([(i, f"{common} {prose(3)}") for i in range(100)] + [(200 + i, prose(40)) for i in range(20)], "item_id long, text string")
    texts = [(1, common), (2, prose(200)), (3, f"{prose(20)} {common} {prose(5)}")] + [(10 + r.item_id, f"{prose(9)} {r.text} {prose(9)}") for r in items.collect()]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    runs = [sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in decontam.hits(docs, items, shard=n).collect()) for n in (1000, 30, 3)]
    assert runs[0] == runs[1] == runs[2] and {(d, i) for d, i, _ in runs[0]} >= {(10 + i, i) for i in range(200, 220)}


def test_language_stage(spark, tmp_path):
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["zwk", "qxv", "jyh"]}
    texts = [(i, " ".join(RNG.choice(words[("aa", "bb")[i % 2]], 30)), ("aa", "bb")[i % 2]) for i in range(200)] + [(300, None, "aa"), (301, "12 34", "bb")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    model = langid.train(docs)
    sure = {r.doc_id for r in langid.identify(docs, model).collect() if r.lang_pred != "und" and r.score >= 0.4}
    out = langid.stage(spark, docs, "")
    assert {r.doc_id for r in out.collect()} == sure == set(range(200)) and out.columns == docs.columns


def test_language_stage_without_labels_keeps_all(spark, tmp_path):
    docs = frame(spark, [(i, prose(20)) for i in range(30)] + [(40, None)], str(tmp_path / "d"), lang=None)
    assert kept(langid.stage(spark, docs, "")) == kept(docs)


def test_mixing_stage(spark, tmp_path):
    texts = [(i, prose(int(RNG.integers(1, 60)))) for i in range(60)] + [(70, None), (71, ""), (3, prose(10)), (None, prose(5))]
    docs = frame(spark, texts, str(tmp_path / "d"))
    rows = mixing.stage(spark, docs, "").collect()
    sizes = collections.Counter()
    for k, (_, t) in enumerate(texts):
        sizes[f"s{k % 3}"] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total, weights, capped = sum(sizes.values()), dict(zip(sorted(sizes), (5, 2, 1))), {}
    while True:  # caps one after another, the excess to the others by weight
        left = total - sum(capped.values())
        open_ = {s: w for s, w in weights.items() if s not in capped}
        aim = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = {s: 3.0 * sizes[s] for s, x in aim.items() if x > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    aim |= capped
    assert len(rows) == len(texts)
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert own[0].target == pytest.approx(aim[s]) and sum(r.taken for r in own) == int(own[0].target + 1e-9)
        assert all(r.target // sizes[s] * r["size"] <= r.taken <= (r.target // sizes[s] + 1) * r["size"] for r in own)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.stage(spark, docs, "").collect()))


@pytest.mark.parametrize("stage", ["near_duplicates", "suffix_dedup", "mixing", "language_id"])
def test_stages_take_empty_tables(spark, stage):
    none = spark.createDataFrame([], SCHEMA)
    assert dict(corpus_pipeline.STAGES)[stage](spark, none, "").count() == 0


def test_pipeline_catches_what_is_planted(spark, tmp_path):
    item, passage = prose(40), prose(60)
    base = [prose(150) for _ in range(30)]
    texts = [*enumerate(base), (100, base[0]), (101, base[1].replace(base[1].split()[5], "changed")), (102, f"{prose(60)} {item} {prose(60)}"),
             (103, f"{prose(70)} {passage} {prose(30)}"), (104, f"{prose(50)} {passage} {prose(60)}"), (105, None), (106, "")]
    frame(spark, texts, str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(range(30)) - set(rows) <= {0, 1} and len({0, 100} & set(rows)) == len({1, 101} & set(rows)) == 1
    assert 102 not in rows and {103, 104} <= set(rows) and not {105, 106} & set(rows)
    assert all(rows[i]["size"] == 150 for i in range(2, 30)) and {rows[103]["size"], rows[104]["size"]} & {110, 109, 111} and max(rows[103]["size"], rows[104]["size"]) >= 160
