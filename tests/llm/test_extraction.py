"""Extraction on held-out made-up pages, on hand-written ones, and the decoder's promise."""

from __future__ import annotations

import html
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from termloom.llm import extraction as X
from termloom.llm import html_pages
from termloom.runtime import table

OPEN, CLOSE = "\ue000", "\ue001"


@pytest.fixture(scope="module")
def trees():
    return X.trained(300)


def test_held_out_pages(trees):
    found = wanted = both = 0
    for seed in range(90_000, 90_120):
        marked = html_pages.training_page(seed)
        want = " ".join(html.unescape(t) for t in re.findall(f"{OPEN}(.*?){CLOSE}", marked, re.S)).split()
        got = X.extract([marked.replace(OPEN, "").replace(CLOSE, "")], trees)[0].split()
        found, wanted, both = found + len(got), wanted + len(want), both + sum((Counter(got) & Counter(want)).values())
    assert both / found > 0.95 and both / wanted > 0.95


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style><script>var t="<p>no</p>";</script></head><body>
<div class="cookie-banner"><p>We use cookies, dear reader. Accept them all now.</p><button>OK</button></div>
<header class="site-header"><a href="/">Site</a></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li><li><a href="/c">Three</a></li></ul></nav>
<div class="ad">Buy this thing today.</div>
<article><h1>A &lt;title&gt; &amp; more</h1>
<p>First  paragraph of the story,\n with <b>bold</b> words &#233;t&eacute;. It goes on for a while, as stories do.
<p>Second paragraph, unclosed, with a <a href="/x">link</a> in it. It also goes on for some time.</p>
<ul><li>an item of the list in the story</li><li>another item of the list</li></ul></article>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/r">Read this</a></li><li><a href="/s">Read that</a></li></ul></aside>
<section class="comments"><h3>Comments</h3><div class="comment"><p>I liked it. Well said, all of it.</p></div></section>
<form><label>Mail</label><input type="text"><p>Sign up for more.</p></form>
<footer>&copy; 2020 Site. All rights.</footer></body></html>"""


def test_hand_written_page(trees):
    assert X.extract([PAGE], trees)[0].split("\n") == [
        "A <title> & more",
        "First paragraph of the story, with bold words été. It goes on for a while, as stories do.",
        "Second paragraph, unclosed, with a link in it. It also goes on for some time.",
        "an item of the list in the story",
        "another item of the list",
    ]


def test_kept_elements_hang_together():
    r = random.Random(1)
    for seed in range(60):
        page = X.parse(html_pages.training_page(seed))
        odds = np.array([r.gauss(0, 3) for _ in page.parent])
        kept = X.decode(page, odds)
        assert all(kept[p] for k, p in zip(kept, page.parent, strict=True) if k and p >= 0)


def test_decoding_is_the_best_consistent_choice():
    """Against all choices on small trees."""
    from itertools import product

    r = random.Random(2)
    for _ in range(40):
        page = X.Page()
        page.open(-1, "html", "")
        for i in range(1, 8):
            page.open(r.randrange(i), "div", "")
        page.pieces = [(i, "x", True) for i in range(8)]
        odds = np.array([r.gauss(0, 2) for _ in range(8)])
        yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
        best = max(
            (c for c in product((False, True), repeat=7) if all(not k or page.parent[i + 1] == 0 or c[page.parent[i + 1] - 1] for i, k in enumerate(c))),
            key=lambda c: sum(yes[i + 1] if k else no[i + 1] for i, k in enumerate(c)),
        )
        assert tuple(X.decode(page, odds)[1:]) == best


@pytest.mark.parametrize("bad", ["", "<", "<p", "</p></p>", "<!--", "<script>", "<a href='", "<p>a<p>b</div></html>x", "<table><td>a<td>b", "<ul><li>a<li>b", "\x00<b>&#0;&bogus;&#xD800;"])
def test_any_markup_is_read(bad, trees):
    assert isinstance(X.extract([bad, None], trees)[0], str)


BARE = ["First paragraph of the story, long enough to be one. It goes on and on, as they do.", "Second paragraph of the story, which is also long. It ends here, at last."]


@pytest.mark.parametrize("lead", ["", "<html><head><title>t</title>", "<title>t</title>", "<!DOCTYPE html><html><head><meta charset=utf-8><title>t</title></head>", "<html><body>", "<head><script>x</script><body class=page>"])
def test_tags_that_may_be_left_out(lead, trees):
    assert X.extract([lead + "".join(f"<p>{t}</p>" for t in BARE)], trees) == ["\n".join(BARE)]


def test_text_ends_the_head(trees):
    assert X.extract([f"<html><head><title>t</title>{BARE[0]}<p>{BARE[1]}"], trees) == ["\n".join(BARE)]


@pytest.mark.parametrize("marked", ["<b>" * 30_000 + "</i>" * 30_000, "<i><div>" + "<b>" * 30_000 + "</i>" * 30_000, "<b>" * 30_000 + "<p>x" * 30_000, "<ul>" * 30_000 + "<li>x" * 30_000, "<table>" * 30_000 + "<td>" * 30_000])
def test_stray_and_deep_tags_take_linear_time(marked):
    begun = time.process_time()
    X.parse(marked)
    assert time.process_time() - begun < 10


def test_inline_mathematics_and_pictures_keep_their_text(trees):
    page = f"<article><h1>Story</h1><p>{BARE[0]} Here <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p><p>{BARE[1]}</p></article>"
    assert "Here x=2 holds." in X.extract([page], trees)[0]


WORDS = "river mountain winter station letter window garden morning harbour engine captain market village teacher doctor bridge".split()


def other_page(r: random.Random) -> tuple[str, list[str]]:
    """A page whose class names, words and layouts are none of the training generator's, and its main blocks."""
    prose = lambda lo, hi: " ".join(" ".join(r.choices(WORDS, k=r.randint(6, 18))).capitalize() + "." for _ in range(r.randint(lo, hi)))
    link = lambda: f'<a href="/{r.random()}">{" ".join(r.choices(WORDS, k=2))}</a>'
    want = [" ".join(r.choices(WORDS, k=5)).capitalize()] + [prose(2, 6) for _ in range(r.randint(3, 9))]
    name = lambda: "".join(r.choices("qxzjvk", k=6))
    main = f"<h1>{want[0]}</h1>" + "".join(f"<p>{t}</p>" for t in want[1:])
    wrap = r.choice(["article", "main", "div", "section"])
    bar = f'<{r.choice(["nav", "div"])} class="{name()}"><ul>{"".join(f"<li>{link()}</li>" for _ in range(r.randint(5, 12)))}</ul></{"div"}>'
    side = f'<aside class="{name()}"><h3>{r.choice(WORDS)}</h3><ul>{"".join(f"<li>{link()}</li>" for _ in range(6))}</ul></aside>'
    foot = f'<footer class="{name()}"><p>{" ".join(r.choices(WORDS, k=6))} {link()} {link()}</p></footer>'
    return f'<html><head><title>x</title></head><body><header class="{name()}">{link()}</header>{bar}<{wrap} class="{name()}">{main}</{wrap}>{side}{foot}</body></html>', want


def test_pages_of_another_make(trees):
    """F1 of blocks on pages that share no class name or word with the training pages."""
    r = random.Random(8)
    found = wanted = both = 0
    for _ in range(150):
        page, want = other_page(r)
        got = X.extract([page], trees)[0].split("\n")
        found, wanted, both = found + len(got), wanted + len(want), both + sum((Counter(got) & Counter(want)).values())
    print("other pages", both / found, both / wanted)
    assert 2 * both / (found + wanted) > 0.9


def test_driver_pages(spark, trees):
    pages = table(spark, "/root/testdata/sf0.001", "pages").select("page_id", "url", "html")
    for r in X.extract_pages(pages, trees).collect():
        title = " ".join(html.unescape(re.search("<h1>(.*?)</h1>", r["html"], re.S)[1]).split())
        assert r["text"].startswith(title) and r["n_chars"] == len(r["text"])
        assert "track(" not in r["text"] and "©" not in r["text"]
