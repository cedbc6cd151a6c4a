"""HTML extraction: gradient-boosted trees over DOM nodes, decoded so that no node contradicts its ancestors.

A node's features: its tag's kind, attribute tokens by what they hint at (its own and its ancestors'), depth, place among and
likeness to its siblings, and of its subtree the text, mark-up and link densities. The trees give the probability that a
node holds main text. Decoding keeps or drops whole subtrees: best(node) = max(drop all below, keep this node and
the best of each child), sums of log-probabilities, so a kept node's ancestors are kept and all below a dropped one goes.

The trees are trained in numpy on seeded made-up pages (``html_pages``), once in the driver; pages are scored where they are
read, without a shuffle, all nodes of a few hundred pages at once.
"""

from __future__ import annotations

import bisect
import functools
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm import html_pages as made
from termloom.llm.common import Carried
from termloom.runtime import table

TRAINING_PAGES = 1000
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Scripts, styles, the head and form controls: no text of the page. All else is for the trees to tell.
SKIP = frozenset("script style template noscript head title iframe xmp select option datalist textarea button".split())
#: What a head may hold; any other element, or text, ends it.
IN_HEAD = frozenset("base link meta title style script noscript template head".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr button select meta link".split()
)
#: A start tag here ends an open element of the set, if no element of ``SCOPE`` lies between.
_BLOCKS = "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
ENDS = {b: ("p",) for b in _BLOCKS} | {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
BLOCK = frozenset(_BLOCKS) | frozenset("html head body li dt dd tr td th thead tbody tfoot caption colgroup legend summary search option optgroup noframes frameset xmp title script style template noscript textarea".split())
SCOPE = frozenset("table td th ul ol dl div section article main aside nav header footer form body html button object figure blockquote".split())
_INSIDE = {"li": frozenset(("ul", "ol", "menu", "table", "td", "th", "html", "body")), "dt": frozenset(("dl", "table", "td", "html", "body")), "dd": frozenset(("dl", "table", "td", "html", "body")), "tr": frozenset(("table", "html", "body")), "td": frozenset(("tr", "table", "html", "body")), "th": frozenset(("tr", "table", "html", "body"))}
_INSIDE |= {"tbody": frozenset(("table",)), "tfoot": frozenset(("table",))}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_HINT = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s+")
_GROUPS = [made.GOOD, made.NAV, made.SIDE, made.AD, made.NOTICE, made.FOOT, made.HEAD, made.COMMENT, made.SHARE, made.FORM]
_WEAK = frozenset("site list slot box more stories area search page top main text body content item".split())
_MORE = [
    "articlebody hentry prose post articletext", "pagination pager crumbs dropdown", "recommend suggested read teaser promo-list", "sponsor outbrain taboola advertising adsense",
    "cookies privacy warning disclaimer message toast banner-cookie", "copy copyrights imprint", "brand", "commentary reactions guestbook thread", "sharebar facebook twitter", "signin register subscribe-form",
]
HINTS: dict[str, int] = {}
for _g, (_names, _extra) in enumerate(zip(_GROUPS, _MORE, strict=True)):
    for _name in [*_names, *_extra.split()]:
        for _part in _HINT.findall(_name):
            if _part not in _WEAK or _g == 0:
                HINTS.setdefault(_part, _g)
HINTS |= {"main": 0, "content": 0, "banner": 3, "complementary": 2, "contentinfo": 5, "search": 9, "top": 6}
TAGS = {t: k for k, ts in enumerate(["html body", "article main", "section div center td tr table tbody", "p blockquote pre", "h1 h2", "h3 h4 h5 h6", "ul ol dl menu", "li dt dd", "nav", "aside", "header hgroup", "footer", "form fieldset label input", "a", "figure figcaption img picture", "span b i em strong small"]) for t in ts.split()}
N_TAGS = 17
N_HINTS = len(_GROUPS)


def hints_of(attrs: str) -> int:
    """A bit for each group of words that class, id, role or itemprop have one of."""
    hints = 0
    for _, value in _ATTR.findall(attrs):
        for part in _HINT.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value)):
            g = HINTS.get(part.lower())
            if g is not None:
                hints |= 1 << g
    return hints


class Page:
    """Elements in document order: parent, tag, hints; and text pieces with their element and whether a block begins before them."""

    __slots__ = ("parent", "tag", "hint", "pieces", "depth")

    def __init__(self):
        self.parent, self.tag, self.hint, self.depth, self.pieces = [], [], [], [], []

    def open(self, parent: int, tag: str, attrs: str) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.hint.append(hints_of(attrs) if attrs else 0)
        self.depth.append(0 if parent < 0 else self.depth[parent] + 1)
        return len(self.parent) - 1


class _Open:
    """The open elements, outermost first, and where each name stands among them: no tag makes a walk over all of them."""

    def __init__(self, page: Page):
        self.page, self.stack, self.skip = page, [page.open(-1, "html", "")], 0
        self.at: dict[str, list[int]] = {}
        self.scopes: list[int] = []

    def push(self, node: int) -> None:
        tag = self.page.tag[node]
        self.at.setdefault(tag, []).append(len(self.stack))
        if tag in SCOPE:
            self.scopes.append(len(self.stack))
        self.skip += tag in SKIP
        self.stack.append(node)

    def cut(self, k: int) -> None:
        """Close all from place ``k`` on."""
        for node in reversed(self.stack[k:]):
            tag = self.page.tag[node]
            self.at[tag].pop()
            if tag in SCOPE:
                self.scopes.pop()
            self.skip -= tag in SKIP
        del self.stack[k:]

    def body(self) -> None:
        """The head, if any, ends here and the body begins."""
        self.cut(1)
        self.push(self.page.open(self.stack[0], "body", ""))

    def last(self, tag: str) -> int:
        held = self.at.get(tag)
        return held[-1] if held else 0

    def end(self, tag: str) -> None:
        """An end tag closes the last element of its name, if that is open and, for inline ones, in no outer scope."""
        k = self.last(tag)
        if k and not (tag in INLINE and self.scopes and self.scopes[-1] > k):
            self.cut(k)

    def begin(self, tag: str) -> None:
        """A start tag closes the elements that can't hold it."""
        enders = ENDS.get(tag)
        if enders:
            inside = _INSIDE.get(tag)
            stop = max(map(self.last, inside)) if inside else self.scopes[-1] if self.scopes else 0
            first = [held[k] for e in enders if (held := self.at.get(e)) and (k := bisect.bisect_right(held, stop)) < len(held)]
            if first:
                self.cut(min(first))


def parse(text: str) -> Page:
    """A forgiving reader: unclosed, misnested and stray tags give a tree for any input, in time that grows with its length.

    Tags of html, head and body may be left out: the first element or text that no head may hold begins the body.
    """
    page = Page()
    now = _Open(page)
    stack, tags, pieces = now.stack, page.tag, page.pieces
    at, fresh_block = 0, True
    find = _TOKEN.search
    while True:
        lt = text.find("<", at)
        m = find(text, lt) if lt >= 0 else None
        end = m.start() if m else len(text)
        if end > at:
            if (len(stack) == 1 or tags[stack[-1]] == "head") and not text[at:end].isspace():
                now.body()
            if not now.skip:
                pieces.append((stack[-1], text[at:end], fresh_block))
                fresh_block = False
        if m is None:
            return page
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            if tag == "br":
                continue
            if tag in BLOCK or "-" in tag:
                fresh_block = True
            if tag not in ("html", "body"):
                now.end(tag)
            continue
        if tag == "html":
            page.hint[0] |= hints_of(m.group(3))
            continue
        if tag not in IN_HEAD and (len(stack) == 1 or tags[stack[-1]] == "head"):
            now.body()
        if tag == "body":
            fresh_block = True
            page.hint[stack[min(1, len(stack) - 1)]] |= hints_of(m.group(3))
            continue
        if tag in BLOCK or "-" in tag:  # any other unknown element runs along with the text
            fresh_block = True
            now.begin(tag)
        if tag == "br":
            if not now.skip:
                pieces.append((stack[-1], " ", fresh_block))
                fresh_block = False
            continue
        attrs = m.group(3)
        node = page.open(stack[-1], tag, attrs)
        if tag in VOID or (attrs and attrs.endswith("/") and tag in SKIP and tag not in RAW):
            continue
        if tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(text, at)
            at = close.end() if close else len(text)
            continue
        now.push(node)


def node_features(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """A row for each element, and each element's own length of text."""
    n = len(page.parent)
    parent, depth = np.array(page.parent), np.array(page.depth, dtype=np.float64)
    own, commas, stops, linked = (np.zeros(n) for _ in range(4))
    tag = np.array([TAGS.get(t, N_TAGS - 1) for t in page.tag])
    is_link = tag == TAGS["a"]
    in_link = is_link.copy()
    hint = np.array(page.hint)
    above, form = np.zeros(n, dtype=np.int64), np.zeros(n)
    tag_above = np.zeros((n, 4))
    watch = {TAGS["nav"]: 0, TAGS["aside"]: 1, TAGS["footer"]: 2, TAGS["article"]: 3}
    for i in range(1, n):
        p = page.parent[i]
        above[i] = above[p] | hint[p]
        in_link[i] |= in_link[p]
        tag_above[i] = tag_above[p]
        k = watch.get(tag[p])
        if k is not None:
            tag_above[i, k] = 1
    for e, t, _ in page.pieces:
        size = len(t) - (t.isspace() and len(t))
        own[e] += size
        if size:
            commas[e] += t.count(",")
            stops[e] += t.count(".") + t.count("!") + t.count("?")
            if in_link[e]:
                linked[e] += size
    total, nodes, links, para, sub_commas, sub_stops, sub_linked, deep = own.copy(), np.ones(n), is_link * 1.0, (tag == 3) * 1.0, commas.copy(), stops.copy(), linked.copy(), depth.copy()
    form += tag == TAGS["form"]
    kids, heads = np.zeros(n), ((tag == 4) | (tag == 5)) * 1.0
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        total[p] += total[i]
        nodes[p] += nodes[i]
        links[p] += links[i]
        para[p] += para[i]
        sub_commas[p] += sub_commas[i]
        sub_stops[p] += sub_stops[i]
        sub_linked[p] += sub_linked[i]
        form[p] += form[i]
        heads[p] += heads[i]
        kids[p] += 1
        if deep[i] > deep[p]:
            deep[p] = deep[i]
    place, same = np.zeros(n), np.zeros(n)
    seen: dict[tuple[int, int], int] = {}
    count = np.zeros(n)
    before = np.zeros(n)
    running = 0.0
    for i in range(n):
        p = page.parent[i]
        if p >= 0:
            place[i] = count[p]
            count[p] += 1
            key = (p, int(tag[i]))
            seen[key] = seen.get(key, 0) + 1
        before[i] = running
        running += own[i]
    for i in range(1, n):
        same[i] = seen[(page.parent[i], int(tag[i]))]
    up = np.maximum(parent, 0)
    whole = max(1.0, total[0])
    columns = [
        *(tag == k for k in range(N_TAGS)),
        *((hint >> g) & 1 for g in range(N_HINTS)),
        *((above >> g) & 1 for g in range(N_HINTS)),
        *tag_above.T,
        depth, deep - depth, kids, place, kids[up] - place, same, same / np.maximum(1, kids[up]),
        np.log1p(own), np.log1p(total), total / whole, before / whole, total / np.maximum(1, total[up]),
        total / nodes, sub_linked / np.maximum(1, total), links / nodes, para, para / nodes,
        sub_commas / np.maximum(1, total) * 100, sub_stops / np.maximum(1, total) * 100, np.minimum(sub_stops, 50),
        form, heads, tag[up], sub_linked[up] / np.maximum(1, total[up]), np.log1p(total[up]),
    ]
    return np.stack([np.asarray(c, dtype=np.float32) for c in columns], axis=1), own


class Trees:
    """Boosted regression trees for log-odds, complete to ``depth``; arrays of features and cuts per level, leaves."""

    def __init__(self, base: float, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray):
        self.base, self.feature, self.cut, self.leaf = base, feature, cut, leaf

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1]))
        for f, c, v in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += v[at - (len(f))]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 110, depth: int = 4, rate: float = 0.2, bins: int = 32, share: float = 0.25) -> Trees:
    """Newton boosting of the log-loss on binned features; splits are found on a seeded ``share`` of the rows, leaves get all."""
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.int64)
    two = np.flatnonzero(binned.max(axis=0, initial=0) <= 1)  # columns of two values need no counting, only sums
    many = np.setdiff1d(np.arange(d), two)
    high = (binned[:, two] == 1).astype(np.float64)
    flat = binned[:, many] + np.arange(len(many)) * bins
    base = float(np.log((weight * y).sum() / (weight * (1 - y)).sum()))
    score = np.full(n, base)
    inner = (1 << depth) - 1
    features, cuts, leaves = [], [], []
    random = np.random.default_rng(5)

    def sums(values: tuple, local: np.ndarray, ones: np.ndarray, places: np.ndarray, nodes: int) -> list[np.ndarray]:
        """(node, feature, bin): the sums over rows, cumulated over bins."""
        key = ((local * (len(many) * bins))[:, None] + places).ravel()
        made = []
        for v in values:
            out = np.zeros((nodes, d, bins))
            by_node = np.zeros((nodes, len(local)))
            by_node[local, np.arange(len(local))] = v
            out[:, two, 1] = by_node @ ones
            out[:, two, 0] = by_node.sum(1)[:, None] - out[:, two, 1]
            out[:, many] = np.bincount(key, weights=np.repeat(v, len(many)), minlength=nodes * len(many) * bins).reshape(nodes, len(many), bins)
            made.append(out.cumsum(2))
        return made

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (p - y), np.maximum(weight * p * (1 - p), 1e-9)
        f, c = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf, dtype=np.float32)
        at = np.zeros(n, dtype=np.int64)
        rows = np.flatnonzero(random.random(n) < share) if n > 1000 else np.arange(n)
        ones, places = high[rows], flat[rows]
        for level in range(depth):
            first = (1 << level) - 1
            lg, lh = sums((g[rows], h[rows]), at[rows] - first, ones, places, 1 << level)
            tg, th = lg[:, :, -1:], lh[:, :, -1:]
            gain = lg**2 / (lh + 1) + (tg - lg) ** 2 / (th - lh + 1) - tg**2 / (th + 1)
            gain[(lh < 1) | (th - lh < 1)] = -1
            best = gain.reshape(1 << level, -1).argmax(1)
            for k, b in enumerate(best.tolist()):
                j, at_bin = divmod(b, bins)
                if gain[k, j, at_bin] > 1e-6 and at_bin < len(edges[j]):
                    f[first + k], c[first + k] = j, edges[j][at_bin]
            at = 2 * at + 1 + (x[np.arange(n), f[at]] > c[at])
        end = at - inner
        leaf = -rate * np.bincount(end, weights=g, minlength=inner + 1) / (np.bincount(end, weights=h, minlength=inner + 1) + 1)
        score += leaf[end]
        features.append(f)
        cuts.append(c)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(cuts), np.array(leaves))


@functools.cache
def trained(pages: int = TRAINING_PAGES) -> Trees:
    """The model of the made-up pages; a node is positive if main text lies in its subtree."""
    xs, ys, ws = [], [], []
    for seed in range(pages):
        marked = made.training_page(seed)
        page = parse(marked.replace("\ue000", "").replace("\ue001", ""))
        truth = parse(marked)
        x, _ = node_features(page)
        y = np.zeros(len(x))
        size = np.zeros(len(x))
        for (e, t, _), (_, plain, _) in zip(truth.pieces, page.pieces, strict=True):
            size[e] += len(plain.strip())
            if "\ue000" in t:
                y[e] = 1
        for i in range(len(x) - 1, 0, -1):
            y[page.parent[i]] = max(y[page.parent[i]], y[i])
            size[page.parent[i]] += size[i]
        told = (size > 0) & ~np.isin(np.array(page.tag), list(SKIP))
        told[0] = False
        xs.append(x[told])
        ys.append(y[told])
        ws.append(np.full(int(told.sum()), 20 / max(20, told.sum())))
    return boost(np.concatenate(xs), np.concatenate(ys), np.concatenate(ws))


def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """Kept elements: a subtree is dropped whole, or its root kept and each child decided on its own."""
    n = len(page.parent)
    yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    shown = [0.0] * n
    for e, t, _ in page.pieces:
        shown[e] += not t.isspace()
    for i in range(n - 1, 0, -1):
        shown[page.parent[i]] += shown[i]
    drop, keep = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        empty = not shown[i]
        drop[i] += 0.0 if empty else float(no[i])
        keep[i] += 0.0 if empty else float(yes[i])
        p = page.parent[i]
        if p >= 0:
            drop[p] += drop[i]
            keep[p] += max(drop[i], keep[i])
    kept = [False] * n
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and page.tag[i] not in SKIP and keep[i] > drop[i]
    return kept


def assemble(page: Page, kept: list[bool]) -> str:
    """Blocks of the kept elements' text, white space inside made one space, joined by line feeds."""
    blocks: list[str] = []
    own: list[str] = []

    def close() -> None:
        block = _SPACE.sub(" ", entities.unescape("".join(own))).strip() if own else ""
        if block:
            blocks.append(block)
        own.clear()

    for e, t, begins in page.pieces:
        if begins:
            close()
        if kept[e]:
            own.append(t)
    close()
    return "\n".join(blocks)


def extract(pages: list[str | None], trees: Trees) -> list[str]:
    """The main text of each page."""
    parsed = [parse((p or "").replace("\0", "�")) for p in pages]
    rows = [node_features(p)[0] for p in parsed]
    odds = trees.log_odds(np.concatenate(rows)) if rows else np.empty(0)
    out, at = [], 0
    for p, r in zip(parsed, rows, strict=True):
        out.append(assemble(p, decode(p, odds[at : at + len(r)])))
        at += len(r)
    return out


def extract_pages(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """Add ``text`` and ``n_chars`` to every row.

    Null or empty html, and pages in which nothing looks like an article, give the empty text. Equal pages give equal texts. An
    empty table gives an empty table. Extra columns pass through; an input column named ``text`` or ``n_chars`` gives way to the result.
    """
    carried = Carried(pages, "html")
    model = trees or trained()
    base, feature, cut, leaf = model.base, model.feature, model.cut, model.leaf

    @F.pandas_udf("string")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Trees(base, feature, cut, leaf)
        for html in batches:
            found: list[str] = []
            for lo in range(0, len(html), 200):
                found += extract([h if isinstance(h, str) else None for h in html.iloc[lo : lo + 200]], own)
            yield pd.Series(found, dtype=object)

    found = carried.frame.withColumn("text", main_text(F.coalesce(F.col("html"), F.lit(""))))
    return carried.back(found.withColumn("n_chars", F.length("text").cast("long")), "text", "n_chars")


def op2_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
