"""Made-up web pages with known main text: the training set of the extraction model.

Layouts, class names, tags, lengths and the order of parts vary; each text node is known to be the article's or not. The
generator is seeded, so every run trains the same model.
"""

from __future__ import annotations

import html
import random

_SYLLABLES = "ka lo mi ren ta sul ver no pha di gor bel un ist er ol qua zi mar te on al fri pen".split()
GOOD = "content article post entry story body main text page blog article-body post-content entry-content story-body main-content".split()
NEUTRAL = "wrap inner row col box block container section module grid layout outer clearfix item".split()
NAV = "nav menu navbar navigation breadcrumb breadcrumbs topnav tabs toc site-nav main-menu".split()
SIDE = "sidebar side widget related recommended aside popular trending more-stories rail secondary".split()
AD = "ad ads advert advertisement sponsor sponsored promo banner ad-slot adbox dfp".split()
NOTICE = "cookie consent notice gdpr popup modal alert newsletter subscribe paywall overlay cookie-banner".split()
FOOT = "footer foot copyright legal colophon bottom site-footer".split()
HEAD = "header masthead top branding site-header logo".split()
COMMENT = "comment comments reply replies discussion respond disqus comment-list comments-area".split()
SHARE = "share social sharing follow byline-share tags meta-links".split()
FORM = "form login search signup contact-form search-box".split()


class Node:
    """A training page's element; ``label`` is set on it and below."""

    def __init__(self, tag: str, attrs: str = "", main: bool = False):
        self.tag, self.attrs, self.main, self.kids = tag, attrs, main, []

    def add(self, *kids):
        self.kids.extend(kids)
        return self


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 3)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi)))

    def sentence(self) -> str:
        s = self.words(3, 16)
        if self.r.random() < 0.3:
            s = s.replace(" ", ", ", 1)
        return s.capitalize() + self.r.choice("....?!")

    def prose(self, lo: int, hi: int) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(lo, hi)))

    def attrs(self, names: list[str], chance: float = 0.85) -> str:
        if self.r.random() > chance:
            return ""
        name = self.r.choice(names)
        kind = self.r.choice(["class", "class", "class", "id"])
        more = f" {self.r.choice(NEUTRAL)}" if kind == "class" and self.r.random() < 0.3 else ""
        return f' {kind}="{name}{more}"'

    def links(self, lo: int, hi: int, tag: str = "ul") -> Node:
        out = Node(tag)
        for _ in range(self.r.randint(lo, hi)):
            out.add(Node("li").add(Node("a", ' href="/x"').add(self.words(1, 4))))
        return out

    def article(self) -> list[Node]:
        r = self.r
        kids: list[Node] = []
        if r.random() < 0.85:
            kids.append(Node("h1", main=True).add(self.words(2, 10)))
        for _ in range(r.choice([1, 1, 1, 1, 2, 3, 5, 8, 12, 20])):
            p = r.random()
            if p < 0.7:
                node = Node("p", main=True).add(self.prose(1, r.choice([1, 1, 2, 5, 12])))
                if r.random() < 0.25:
                    node.add(" ", Node("a", ' href="/y"', True).add(self.words(1, 3)), " ", self.sentence())
                if r.random() < 0.15:
                    node.add(" ", Node(r.choice(["b", "em", "strong", "i", "span"]), "", True).add(self.words(1, 5)), ".")
                kids.append(node)
            elif p < 0.78:
                kids.append(Node(r.choice(["h2", "h3", "h4"]), main=True).add(self.words(1, 7)))
            elif p < 0.86:
                lst = Node(r.choice(["ul", "ol"]), main=True)
                for _ in range(r.randint(2, 7)):
                    lst.add(Node("li", main=True).add(self.words(2, 14)))
                kids.append(lst)
            elif p < 0.9:
                kids.append(Node("blockquote", main=True).add(Node("p", main=True).add(self.prose(1, 3))))
            elif p < 0.93:
                kids.append(Node("figure", main=True).add(Node("figcaption", main=True).add(self.words(3, 10))))
            elif p < 0.96:
                t = Node("table", main=True)
                for _ in range(r.randint(2, 4)):
                    t.add(Node("tr", main=True).add(*(Node("td", main=True).add(self.words(1, 3)) for _ in range(3))))
                kids.append(t)
            else:
                kids.append(Node("div", main=True).add(self.prose(1, 4)))
            if r.random() < 0.05:
                kids.append(self.clutter())
        if r.random() < 0.15:
            kids.append(self.clutter())
        return kids

    def clutter(self) -> Node:
        r, kind = self.r, self.r.randint(0, 7)
        tag = r.choice(["div", "div", "section", "aside"])
        if kind == 0:
            return Node(tag, self.attrs(AD)).add(r.choice([self.words(1, 12), self.prose(1, 3)]))
        if kind == 1:
            return Node(tag, self.attrs(SHARE)).add(self.links(2, 5))
        if kind == 2:
            return Node(tag, self.attrs(SIDE)).add(Node("h3").add(self.words(1, 3)), self.links(2, 8))
        if kind == 3:
            return Node(r.choice(["div", "p", "section"]), self.attrs(NOTICE)).add(self.prose(1, 3), Node("button").add(self.words(1, 2)))
        if kind == 4:
            f = Node("form", self.attrs(FORM, 0.5)).add(Node("label").add(self.words(1, 3)), Node("input", ' type="text"'))
            return f.add(Node("button").add(self.words(1, 2)), Node("p").add(self.prose(1, 2)))
        if kind == 5:
            return Node(r.choice(["div", "section"]), self.attrs(COMMENT, 1)).add(*self.comments())
        if kind == 6:
            return Node(r.choice(["nav", "div"]), self.attrs(NAV, 0.9)).add(self.links(3, 9))
        return Node("aside", self.attrs(SIDE, 0.6)).add(Node("p").add(self.prose(1, 4)))

    def comments(self) -> list[Node]:
        out = [Node("h3").add(self.words(1, 3))] if self.r.random() < 0.6 else []
        holder = Node(self.r.choice(["ul", "ol", "div"]))
        for _ in range(self.r.randint(1, 5)):
            item = Node("li" if holder.tag != "div" else "div", self.attrs(["comment", "reply", "comment-body"], 0.7))
            holder.add(item.add(Node("p").add(self.prose(1, 4))))
        return [*out, holder]

    def page(self) -> Node:
        r = self.r
        body = Node("body")
        head = []
        if r.random() < 0.3:
            head.append(Node("div", self.attrs(NOTICE, 1)).add(r.choice([Node("p").add(self.prose(1, 3)), self.prose(1, 2)])))
        if r.random() < 0.5:
            h = Node(r.choice(["header", "div"]), self.attrs(HEAD, 0.9)).add(Node(r.choice(["a", "p", "span"])).add(self.words(1, 4)))
            head.append(h.add(self.links(2, 6)) if r.random() < 0.4 else h)
        if r.random() < 0.85:
            nav = Node(r.choice(["nav", "nav", "div"]), "")
            nav.attrs = self.attrs(NAV, 1 if nav.tag == "div" else 0.4)
            head.append(nav.add(self.links(3, 9)))
        if r.random() < 0.5:
            head.append(Node("div", self.attrs(AD, 1)).add(r.choice([self.words(2, 10), self.prose(1, 3)])))
        tag = r.choice(["article", "article", "main", "div", "div", "section", "td"])
        own = Node(tag, self.attrs(GOOD, 0.4 if tag in ("article", "main") else 0.8))
        own.add(*self.article())
        for _ in range(r.choice([0, 0, 1, 2])):
            own = Node(r.choice(["div", "main", "section"]), self.attrs(NEUTRAL + GOOD, 0.6)).add(own)
            if r.random() < 0.4:
                own.add(self.clutter())
            if r.random() < 0.2:
                own.kids.insert(0, self.clutter())
        side = [Node(r.choice(["aside", "div"]), self.attrs(SIDE, 0.9)).add(Node("h3").add(self.words(1, 3)), self.links(2, 9)) for _ in range(r.randint(0, 2))]
        if r.random() < 0.2:
            side.append(Node("aside", self.attrs(SIDE, 0.5)).add(Node("p").add(self.prose(1, 3))))
        tail = [self.clutter() for _ in range(r.choice([0, 0, 1, 2]))]
        if r.random() < 0.3:
            tail.append(Node(r.choice(["section", "div"]), self.attrs(COMMENT, 1)).add(*self.comments()))
        if r.random() < 0.85:
            foot = Node(r.choice(["footer", "footer", "div"]), "")
            foot.attrs = self.attrs(FOOT, 1 if foot.tag == "div" else 0.3)
            foot.add(r.choice([f"© {self.words(1, 3)} · {self.sentence()}", f"© {self.words(1, 2)} · {self.prose(1, 2)}", Node("p").add(self.words(3, 14)), self.prose(1, 2)]))
            tail.append(foot.add(self.links(2, 6)) if r.random() < 0.3 else foot)
        before = [s for s in side if r.random() < 0.4]
        if r.random() < 0.08:  # the article stands in the body itself, alone or among little
            return body.add(*(head if r.random() < 0.4 else []), *self.article(), *(tail if r.random() < 0.4 else []))
        return body.add(*head, *before, own, *[s for s in side if s not in before], *tail)


def render(node: Node | str, out: list[str], spans: list[str]) -> None:
    """Mark-up into ``out``; text nodes of the article into ``spans``, wrapped in sentinel characters in the mark-up."""
    for kid in node.kids:
        if isinstance(kid, str):
            text = html.escape(kid)
            out.append(f"\ue000{text}\ue001" if node.main else text)
        else:
            out.append(f"<{kid.tag}{kid.attrs}>")
            render(kid, out, spans)
            if kid.tag not in ("input", "img", "br"):
                out.append(f"</{kid.tag}>")


def training_page(seed: int) -> str:
    """A page whose main text nodes stand between U+E000 and U+E001."""
    m = Maker(seed)
    out: list[str] = ["<!DOCTYPE html><html><head><title>t</title></head><body>"]
    render(m.page(), out, [])
    return "".join([*out, "</body></html>"])
