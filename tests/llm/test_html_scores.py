"""Main text: sizes and scores against plain recursion, the article's own sections, deep and odd pages."""

import time

import numpy as np
import pytest

from strata.llm import html_text as H

LONG = "A paragraph, with commas, that is long enough, by far, to be scored as text of the page."
RNG = np.random.default_rng(4)


def random_page(n):
    tags, out, open_ = ["div", "p", "ul", "li", "section", "a", "b", "blockquote", "td", "article", "h2"], [], []
    for _ in range(n):
        if open_ and RNG.random() < 0.4:
            out.append(f"</{open_.pop()}>")
        elif RNG.random() < 0.5:
            t = str(RNG.choice(tags))
            open_.append(t)
            out.append(f"<{t} class={RNG.choice(['x', 'ad', 'legal', 'sidebar', 'related-work'])}>")
        else:
            out.append(str(RNG.choice([" ", "short, ", LONG, "  padded  ", "no comma here at all but rather long", "，"])))
    return "<body>" + "".join(out)


def plain_size(node):
    def walk(k, linked):
        if isinstance(k, str):
            return len(k.strip()), len(k.strip()) * linked, False, k
        if k.drop:
            return 0, 0, False, ""
        parts = [walk(x, linked or k.tag == "a") for x in k.kids]
        return sum(p[0] for p in parts), sum(p[1] for p in parts), k.tag in H.BLOCK or any(p[2] for p in parts), "".join(p[3] for p in parts)
    parts = [walk(k, False) for k in node.kids]
    text = "".join(p[3] for p in parts)
    return sum(p[0] for p in parts), sum(p[1] for p in parts), any(p[2] for p in parts), len(text.strip()), text.count(",") + text.count("，")


def test_sizes_and_scores_equal_plain_recursion():
    for n in [0, 1, 5, *RNG.integers(5, 200, 60)]:
        root = H.parse(random_page(int(n)))
        H._drop_named(root)
        order = H._measure(root)
        for x in order:
            bare = max(0, x.size.raw - x.size.lead - x.size.trail)
            assert (x.size.total, x.size.links, x.size.block, bare, x.size.commas) == plain_size(x)
        points = dict(H._paragraphs(order))
        want = {}
        for node, p in points.items():
            up, level = node.parent, 0
            while up and level < H.LEVELS:
                base = want.setdefault(id(up), 5.0 if up.tag in ("article", "main") else 0.0)
                want[id(up)] = base + p / (1 if level == 0 else 2 if level == 1 else 3 * level)
                up, level = up.parent, level + 1
        got = {id(x): x.score for x in H._score(order)}
        assert got == pytest.approx(want)


def test_sections_of_the_article_stay():
    own = "".join(f"<section class='{c}'><h2>{c}</h2><p>{LONG}</p></section>" for c in ("related-work", "legal", "search-results"))
    page = f"<body><div class=legal>Terms</div><article><p>{LONG}</p><p class=legal>A legal text.</p>{own}<div class=related><a href=x>More of this</a></div>" \
           f"<div class='newsletter'><p>{LONG}</p></div><div class=comments><p>{LONG}</p></div></article><div class=related><p>{LONG}</p></div></body>"
    want = [LONG, "A legal text."] + [x for c in ("related-work", "legal", "search-results") for x in (c, LONG)]
    assert H.extract(page) == "\n".join(want)


def test_links_of_a_layout_table_go():
    page = f"<body><table><tr><td><a href=/>Home</a></td><td><p>{LONG}</p><p>{LONG}</p></td></tr></table></body>"
    assert H.extract(page) == f"{LONG}\n{LONG}"


def test_time_grows_with_the_page_not_its_depth():
    for opening in ("<div><p>", "<blockquote>", "<article><div class=related>"):
        began = time.perf_counter()
        assert H.extract("<body>" + (opening + LONG) * 4000).count(LONG) == 4000
        assert time.perf_counter() - began < 5


def test_odd_tables(spark):
    rows = [(1, "u", f"<article><p>{LONG}</article>", "x"), (1, "v", f"<article><p>{LONG}</article>", "x"), (None, None, None, None), (2, "w", "", ""),
            (3, "y", f"<div><p>{LONG}</p></div><div><p>{LONG}</p></div>", ""), (4, "z", "<p>" + "words, and more words " * 60_000, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url or "", r.n_chars, r.text[:len(LONG)]) for r in H.main_text(df).collect())
    assert [(i, u) for i, u, _, _ in got] == [(0, ""), (1, "u"), (1, "v"), (2, "w"), (3, "y"), (4, "z")]
    assert got[1][3] == got[2][3] == got[4][3] == LONG and got[0][2] == got[3][2] == 0 and got[5][2] == len("words, and more words " * 60_000) - 1
    assert H.main_text(df.limit(0)).count() == 0
