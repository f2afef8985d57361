"""Main text of web pages by tree scoring.

Paragraphs give points for length and commas to their ancestors, less to farther ones; a container's
points are discounted by its share of link text. From the best one the whole of its ``main``, its article, or the
container that it shares with related blocks is kept. Page furniture (menus, adverts, forms, comments, ...) is cut out
by element, role, class or id first; a class or id alone never cuts an element that holds the article, and inside an
article or main a name that its own sections may bear (``legal``, ``related-work``) cuts only what is mostly links.
Sizes of all elements come from one pass from the leaves up, so the time grows with the page, not with its depth.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table

# Fixed values of HTML: elements without content, raw text, and block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"body", "html", "option", "td", "th", "tr", "tbody", "thead", "tfoot"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("article aside body blockquote button details dialog div dl fieldset figure footer form header html main menu nav ol section table td th ul".split())
# Furniture.
DROP = frozenset("script style noscript template head title nav aside footer form button select input textarea iframe object embed svg canvas map menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
NAMES = re.compile(
    r"(?<![a-z])(?:ads?|adverts?|advertise(?:ment)?s?|advertising|banners?|breadcrumbs?|byline|comments?|commentlist|consent|cookies?|copyright|disclaimer|disqus|foot|footer|gdpr|"
    r"header|legal|masthead|menus?|modal|nav|navbar|navigation|newsletter|notices?|outbrain|pagination|pager|popups?|promos?|promoted|recommended|related|replies|reply|respond|"
    r"search|share|sharing|shoutbox|sidebars?|signup|skip|social|sponsors?|sponsored|subscribe|subscription|taboola|toolbar|widgets?)(?![a-z])", re.I)
# Of these names, those that an article's own sections bear too.
OWN = re.compile(r"(?<![a-z])(?:banners?|copyright|disclaimer|foot|header|legal|recommended|related|reply|respond|search|skip|social|sponsors?)(?![a-z])", re.I)
KEEP = frozenset("article main body html".split())
#: Ancestors that a paragraph gives points to; the last of them gets under a hundredth.
LEVELS = 40
# Blocks that belong to the text beside them, short or not.
PARTS = frozenset("h1 h2 h3 h4 h5 h6 p ul ol dl table pre blockquote figure section".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S)
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
SPACE = re.compile(r"\s+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "parent", "kids", "drop", "named", "score", "size")

    def __init__(self, tag, parent, drop=False, named=0):
        self.tag, self.parent, self.kids, self.drop, self.named, self.score, self.size = tag, parent, [], drop, named, None, None


def _named(attrs: str) -> int:
    """Whether a class or id names furniture: 2, or 1 if only by a name that sections of an article bear too."""
    found = 0
    for name, *values in ATTR.findall(attrs):
        if name.lower() in ("class", "id"):
            for m in NAMES.finditer(re.sub(r"([a-z])([A-Z])", r"\1-\2", "".join(values))):
                found = max(found, 1 if OWN.fullmatch(m.group()) else 2)
    return found


def _furniture(tag: str, attrs: str, parent: Node) -> bool:
    if tag in DROP:
        return True
    if tag == "header":
        while parent:  # the heading of the article itself stays
            if parent.tag in ("article", "main"):
                return False
            parent = parent.parent
        return True
    if not attrs.strip() or tag in KEEP:
        return False
    for name, *values in ATTR.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and HIDDEN.search(value):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
    return False


def parse(page: str) -> Node:
    """The tree of a page; open elements end where HTML says so, and an unfinished tag at the end is dropped."""
    root = at = Node("html", None)
    pos, n = 0, len(page)
    while pos < n:
        m = TOKEN.search(page, pos)
        text = page[pos:m.start()] if m else page[pos:]
        if text:
            at.kids.append(text)
        if not m:
            break
        pos = m.end()
        close, tag, attrs, end = m.group(1, 2, 3, 4) if m.group(2) else m.group(5, 6, 7, 8)
        if not tag or not end:
            continue
        tag = tag.lower()
        if close:
            up = at
            while up and up.tag != tag:
                up = None if tag not in SCOPE and up.tag in SCOPE else up.parent
            if up and up.parent:
                at = up.parent
            continue
        if tag in ("html", "body"):
            continue
        ends = ({"p"} if tag in CLOSES_P else set()) | SAME.get(tag, set())
        if ends:
            up, last = at, None
            while up and (up.tag not in SCOPE or up.tag in ends):
                if up.tag in ends:
                    last = up
                up = up.parent
            if last:
                at = last.parent
        node = Node(tag, at, _furniture(tag, attrs, at), _named(attrs) if attrs.strip() else 0)
        at.kids.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, pos)
            pos = stop.end() if stop else n
            node.drop = True
        elif tag not in VOID:
            at = node
    return root


class Size:
    """Of an element without its furniture: characters of text, characters in links, whether a block is inside; and of its text as a
    whole, characters, how many of them are blank at its start and end, and commas."""
    __slots__ = ("total", "links", "block", "raw", "lead", "trail", "commas")

    def __init__(self):
        self.total = self.links = self.raw = self.lead = self.trail = self.commas = 0
        self.block = False

    def text(self, raw: int, lead: int, trail: int, commas: int) -> None:
        """Append a text of these numbers."""
        if self.lead == self.raw:
            self.lead += lead
        self.trail = trail if trail < raw else self.trail + raw
        self.raw += raw
        self.commas += commas


def _measure(root: Node) -> list[Node]:
    """Give every element its size, from the leaves up; the elements, ancestors first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(k for k in node.kids if not isinstance(k, str) and not k.drop)
    for node in reversed(order):
        size = node.size = Size()
        for k in node.kids:
            if isinstance(k, str):
                bare = len(k.strip())
                size.total += bare
                size.text(len(k), len(k) - len(k.lstrip()), len(k) - len(k.rstrip()), k.count(",") + k.count("，"))
            elif not k.drop:
                size.total += k.size.total
                size.links += k.size.total if k.tag == "a" else k.size.links
                size.block |= k.tag in BLOCK or k.size.block
                size.text(k.size.raw, k.size.lead, k.size.trail, k.size.commas)
    return order


def _paragraphs(order: list[Node]):
    """(paragraph, its points) of measured elements."""
    for node in order:
        if node.tag not in ("p", "pre", "blockquote", "h2", "h3"):
            if node.tag not in ("td", "div", "section", "article", "li", "dd") or any(not isinstance(k, str) and not k.drop and k.tag in BLOCK for k in node.kids):
                continue
        n = max(0, node.size.raw - node.size.lead - node.size.trail)
        if n >= 25:
            yield node, 1 + node.size.commas + n / 100


def _drop_named(root: Node):
    """Drops elements that a class or id names as furniture, but none that holds an article or main of no such name,
    and, where none of these stands outside it, none that holds most of the page's points. Inside an article or main
    a name that sections bear too drops only what is mostly links or empty."""
    order = _measure(root)
    if not any(x.named for x in order):
        return
    points = dict.fromkeys(map(id, order), 0.0)
    for node, n in _paragraphs(order):
        points[id(node)] += n
    texts = dict.fromkeys(points, 0)  # articles and mains with points of their own
    own = dict.fromkeys(points, 0)  # those of them without a furniture name
    for x in reversed(order):
        if x.tag in ("article", "main") and points[id(x)]:
            texts[id(x)] += 1
            own[id(x)] += not x.named
        if x.parent:
            for sums in (points, texts, own):
                sums[id(x.parent)] += sums[id(x)]
    total, among = points[id(root)], texts[id(root)]
    inside: dict[int, bool] = {}  # of an article or main
    for x in order:
        inside[id(x)] = x.tag in ("article", "main") or bool(x.parent) and inside[id(x.parent)]
        if x.named == 1 and x.tag not in KEEP and inside[id(x.parent)]:
            x.drop = x.size.links * 2 >= x.size.total
        elif x.named and x.tag not in KEEP:
            x.drop = not (own[id(x)] or points[id(x)] > 0.5 * total and texts[id(x)] == among)


def _score(order: list[Node]) -> list[Node]:
    """Points of paragraphs passed to ancestors: all to the parent, half to the next, then a third of their number up,
    over ``LEVELS`` of them."""
    found = []
    for node, points in _paragraphs(order):
        up, level = node.parent, 0
        while up and level < LEVELS:
            if up.score is None:
                up.score = 5.0 if up.tag in ("article", "main") else 0.0
                found.append(up)
            up.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = up.parent, level + 1
    return found


def _blocks(node, out: list[str], line: list[str], links_go: bool = False):
    """The texts of blocks, in page order; with ``links_go``, without lists and tables that are mostly links."""
    work = [("in", node)]
    flush = lambda: (out.append(t) if (t := SPACE.sub(" ", html.unescape("".join(line))).strip()) else None, line.clear())
    while work:
        what, k = work.pop()
        if what == "end":
            flush()
        elif isinstance(k, str):
            line.append(k)
        elif not k.drop:
            if k.tag == "br":
                line.append(" ")
                continue
            if links_go and k.tag in ("ul", "ol", "dl", "table", "td", "th", "li", "div", "section", "p") and k is not node and k.size.links > 0.5 * k.size.total:
                flush()
                continue
            if k.tag in BLOCK:
                flush()
                work.append(("end", None))
            work.extend(("in", x) for x in reversed(k.kids))
    flush()


def extract(page: str) -> str:
    """The main text of one page: its blocks joined by line ends; empty if there is none."""
    root = parse(page)
    _drop_named(root)
    found = _score(_measure(root))
    for node in found:
        node.score *= 1 - node.size.links / node.size.total if node.size.total else 0
    out: list[str] = []
    if not found:
        _blocks(root, out, [], links_go=True)
        return "\n".join(out)
    best = max(found, key=lambda x: x.score)
    least = max(10.0, 0.2 * best.score)

    def related(k) -> bool:
        if isinstance(k, str) or k.drop:
            return False
        return (k.score or 0) >= least or k.tag in PARTS and 0 < k.size.total and k.size.links <= 0.5 * k.size.total

    above = list(_up(best))
    whole = next((x for x in reversed(above) if x.tag == "main"), None) or next((x for x in reversed(above) if x.tag == "article"), None)
    if whole is None:
        whole = best
        while whole.parent and whole.parent.parent and any(k is not whole and related(k) for k in whole.parent.kids):
            whole = whole.parent
    if whole.parent is None:  # no container but the page: what is mostly links is not known to be inside the text
        _blocks(root, out, [], links_go=True)
    elif whole.tag == "main":
        _blocks(whole, out, [])
    else:
        for k in whole.parent.kids:
            if k is whole or related(k) and (whole.tag != "article" or k.tag == "article" and (k.score or 0) >= least):
                _blocks(k, out, [])
    return "\n".join(out)


def _up(node):
    while node:
        yield node
        node = node.parent


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row. A null or empty page, or one without text, gives the empty string;
    broken markup is read as browsers do; equal rows give equal results; of containers with equal points the first found
    counts; pages of any length are taken whole; other columns are not read; an empty table gives none."""
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                text = [extract(x) if x else "" for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
