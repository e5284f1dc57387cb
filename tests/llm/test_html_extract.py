from __future__ import annotations

import math
import random
import re
import time
from html import unescape

import pytest

from marquee.llm.html_extract import _densities, _Tree, extract_pages, main_text
from marquee.llm.queries import op1_html_extraction
from tests.conftest import SF_MID


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<p>", ""), ("plain &lt;b", "plain <b"), ("<html><body></body></html>", ""),
    ("<article><h1>A &amp; B</h1><p>x  y\n z<br>w</p></article>", "A & B\nx y z w"),
    ("<p>a<p>b<ul><li>c<li>d</ul>", "a\nb\nc\nd"),
    ("<article><p>&#233;&nbsp;x &copy; 2</p></article>", "é x © 2"),
    ("<article><p>one</p><!-- no --><script>var t='</p>';</script><style>p{}</style><p>two", "one\ntwo"),
    ("<article><table><tr><td>a</td><td>b</td></tr></table></article>", "a\nb"),
    ("<article><p>shown</p><p hidden>not</p><p style='display: none'>nor</p></article>", "shown"),
    ("<article><p>kept</p><p>trunc", "kept\ntrunc"),
])
def test_small_pages(html, text):
    assert main_text(html) == text


BODY = "<p>" + "Enough prose to be the article, with words and words. " * 4 + "</p>"


@pytest.mark.parametrize("junk", [
    "<nav><ul><li><a href=a>Home</a></li></ul></nav>", "<header><h1>Site</h1></header>", "<footer>c 2020</footer>",
    "<aside>more</aside>", "<div class='ad'>Buy this very long advert " + "now " * 80 + "</div>", "<form><label>q</label></form>",
    "<div id='comments'><p>" + "first! " * 90 + "</p></div>", "<div class='cookie-notice'>we use cookies</div>",
    "<div class='siteSidebar'>" + "side " * 90 + "</div>", "<div role='navigation'>x</div>", "<script>x</script>",
    "<ul class='related-links'><li><a href=b>b</a></li></ul>",
])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_boilerplate_goes(junk, tag):
    page = f"<html><head><title>t</title></head><body>{junk}<{tag}><h1>Title</h1>{BODY}{junk.replace('header', 'nav')}<p>End.</p></{tag}>{junk}</body></html>"
    text = main_text(page)
    assert text.startswith("Title\nEnough prose") and text.endswith("\nEnd.") and text.count("\n") == 2


@pytest.mark.parametrize("page", [
    "<div class='layout no-sidebar'><article>{}</article></div>", "<article class='post category-social'>{}</article>",
    "<main class='has-ads'>{}</main>", "<div id='search-page'><div>{}</div></div>", "<div id='search-page'>{}</div>",
    "<main><article class='post share'>{}</article></main>", "<div class='widget'><div class='popup'><main>{}</main></div></div>",
])
def test_wrappers_named_like_boilerplate_keep_the_article(page):
    junk = "<div class='sidebar'><p>more of the side</p></div><div class='ad'>Buy now</div>"
    inner = f"<h1>Title</h1>{BODY}{junk}<p>End.</p>"
    assert main_text(f"<body>{junk}{page.format(inner)}{junk}</body>") == main_text(f"<article>{inner}</article>")


def test_comments_go_however_long_and_articles_in_an_article():
    comment = "<div id='comments'>" + "<article class='comment'><p>" + "first! " * 90 + "</p></article></div>"
    assert "first" not in main_text(f"<body><article><h1>Title</h1>{BODY}{comment}</article></body>")
    assert "first" not in main_text(f"<body><main>{BODY}</main><div id='comments'><p>{'first! ' * 900}</p></div></body>")


def test_densest_part_wins_without_article_tag():
    links = "<div><ul>" + "<li><a href=x>some link text here</a></li>" * 30 + "</ul></div>"
    text = main_text(f"<body>{links}<div>{BODY}{BODY}<p>short</p></div>{links}</body>")
    assert "some link text" not in text and text.endswith("short") and text.count("Enough") == 8


def test_cells_are_blocks_and_a_page_in_a_form_is_kept():
    assert main_text("<table><tr><td>a</td><td>b</td></tr><tr><th>c<td>d</table>") == "a\nb\nc\nd"
    inner = f"<div><h1>Title</h1>{BODY}{BODY}</div>"
    assert main_text(f"<body><form action='/x'><input name=q>{inner}</form></body>") == main_text(f"<body>{inner}</body>")
    assert main_text(f"<body><form><main>{BODY}<form><label>q</label>Send it</form></main></form></body>").count("Enough") == 4
    assert "Send" not in main_text(f"<body><form><main>{BODY}<form><label>q</label>Send it</form></main></form></body>")


def test_menus_between_content_parts_stay_out():
    menu = "<div><ul>" + "<li><a href=x>menu entry</a></li>" * 12 + "</ul></div>"
    part = "<div>" + "<p>" + "Prose about things, with many words in every sentence of it. " * 6 + "</p>" * 1 + "</div>"
    text = main_text(f"<body>{menu}{part}{menu}{part}{menu}</body>")
    assert "menu entry" not in text and text.count("Prose about") == 12


def test_names_of_an_articles_own_parts():
    page = f"<body><article><h1 class='notice-title'>On notices</h1>{BODY}<section id='related-work'><h2>Related work</h2>{BODY}</section>{{}}</article></body>"
    text = main_text(page.format("<div class='related'><ul><li><a href=x>one</a><li><a href=y>two</a></ul></div><div class='notice'>cookies</div>"))
    assert text == main_text(page.format("")) and text.startswith("On notices\n") and "\nRelated work\nEnough" in text


def plain_densities(node, body_ratio=None):
    """The formula, over nested (tag, own text, children), with everything counted anew at each node."""
    def total(n, inside=False):
        tag, own, children = n
        inside |= tag == "a"
        c, t, lc, lt = len(own), 0, len(own) * inside, 0
        for x in children:
            a = total(x, inside)
            c, t, lc, lt = c + a[0], t + 1 + a[1], lc + a[2], lt + a[3] + (x[0] == "a")
        return c, t, lc, lt

    def density(n, ratio):
        c, t, lc, lt = total(n)
        t, lt = max(1, t), max(1, lt + (n[0] == "a"))
        base = math.log(c / max(1, c - lc) * lc + ratio * c + math.e)
        return c / t * math.log(max(c / max(1, lc) * t / lt, 1.0)) / base if c else 0.0

    c, _, lc, _ = total(node)
    return density, lc / max(1, c)


def test_densities_follow_the_formula():
    rng = random.Random(2)

    def grow(depth):
        tag = rng.choice(["div", "p", "a", "span"]) if depth else "body"
        children = [grow(depth + 1) for _ in range(rng.randint(0, 3))] if depth < 4 and tag != "a" else []
        return tag, "x" * rng.choice([0, 3, 40, 200]), [c for c in children if tag != "p" or c[0] in ("a", "span")]

    def html(n):
        return f"<{n[0]}>{n[1]}{''.join(map(html, n[2]))}</{n[0]}>"

    def walk(n):
        yield n
        for x in n[2]:
            yield from walk(x)

    for _ in range(60):
        page = grow(0)
        if any(n[0] == "p" for n in walk(page)) and any(n[0] in ("span",) and any(x[0] in ("div", "p") for x in walk(n) if x is not n) for n in walk(page)):
            continue                            # a paragraph may end early there
        tree = _Tree()
        tree.feed(html(page))
        density, sums, _ = _densities(tree)
        of, ratio = plain_densities(page)
        nodes = list(walk(page))
        assert tree.tag[1:] == [n[0] for n in nodes]
        for i, n in enumerate(nodes, 1):
            assert math.isclose(density[i], of(n, ratio), rel_tol=1e-9, abs_tol=1e-12)
            assert math.isclose(sums[i], sum(of(x, ratio) for x in n[2]), rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("page", [
    "<div>" * 64_000 + "</span>" * 64_000, "<b>" * 64_000 + "<i>x</i>" * 64_000, "<span><div>" + "<b>" * 64_000 + "</span>" * 64_000,
    "</p>" * 64_000 + "<p>" * 64_000, "<header>" * 64_000, "<ul>" + "<li>" * 64_000,
])
def test_hostile_markup_takes_linear_time(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 4


def test_very_long_and_deep_pages():
    assert len(main_text("<article>" + "<p>word word</p>" * 50_000 + "</article>").split("\n")) == 50_000
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def test_operator_cases(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    rows = [(1, "u", "<p>a b</p>", 1, "x"), (1, "u", "<p>a b</p>", 1, "x"), (None, None, None, None, None), (2, "v", "", 0, "")]
    got = sorted(map(tuple, extract_pages(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(1, "u", "a b", 3), (1, "u", "a b", 3), (None, None, "", 0), (2, "v", "", 0)], key=str)
    assert extract_pages(spark.createDataFrame([], schema)).count() == 0


def test_query_against_the_articles_markup(spark):
    """The test pages mark their article; stripping its tags by hand must give the same blocks."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    got = op1_html_extraction(spark, SF_MID).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S).group(1)
        blocks = (re.sub(r"</?b>", "", b) for b in re.split(r"</?(?:p|h1)>", inner))
        blocks = (re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in blocks)
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
