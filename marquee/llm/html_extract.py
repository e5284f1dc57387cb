"""Main text of web pages by composite text density.

Every node of the page's tree gets a density: its characters per tag, adjusted
for links (characters and tags inside anchors count against it). The densities
of a node's children are summed; the subtree with the largest sum is the
content, and the smallest density on the path from there up to the body is the
threshold: other parts of the page that reach it count as content too, each with
its own subtree of the largest sum, but not what lies between them.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements that never hold article text.
DROPPED = frozenset("""script style noscript template head title nav aside footer button select option textarea
    input label iframe object embed applet canvas svg audio video map dialog menu datalist progress meter""".split())
#: Elements that hold no article text unless they wrap the article or most of the page.
WRAPPERS = frozenset("form fieldset".split())
#: Elements without content or end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
BLOCK = frozenset("""html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody
    tfoot tr blockquote pre address figure figcaption details summary hgroup header footer nav aside form fieldset
    center hr menu dialog search td th""".split())
#: An open element (left) ends when one of those on the right starts inside it.
ENDED_BY = {
    "p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option"},
    "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body", "article", "main", "p", "div"},
}
#: Elements through which an implied end doesn't reach.
SCOPE = frozenset("html body article section main div table ul ol dl blockquote aside nav header footer form".split())
#: Words of class, id or role that name what isn't article text.
BOILERPLATE = frozenset("""ad ads advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo
    promotion nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar sidebars rail footer masthead topbar toolbar
    comment comments disqus replies respondform cookie cookies consent gdpr notice notices notification alert popup modal
    overlay newsletter subscribe signup login share sharing social related recommended recommendations pagination pager
    skip search widget complementary contentinfo""".split())
#: Of these, words that also occur in names of an article's own parts ("related-work"): there, links must show it too.
WEAK = frozenset("related recommended recommendations share sharing social search promotion rail widget skip".split())
ARTICLE = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WHITE = re.compile(r"\s+")


def _is_hidden(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    if tag in DROPPED:
        return True
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and value and HIDDEN.search(value):
            return True
    return False


#: Kinds of names: none, only weak words, others.
UNNAMED, WEAKLY, PLAINLY = range(3)


def _named(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """Whether words of class, id or role name the element boilerplate."""
    if tag in ("body", "html"):
        return UNNAMED
    if tag in WRAPPERS:
        return PLAINLY
    words = {x.lower() for name, value in attrs if name in ("class", "id", "role") and value for x in WORDS.findall(value)} & BOILERPLATE
    return PLAINLY if words - WEAK else WEAKLY if words else UNNAMED


#: For each element, the open ones that its start ends.
_ENDS = {tag: [above for above, by in ENDED_BY.items() if tag in by] for tag in frozenset().union(*ENDED_BY.values())}


class _Tree(HTMLParser):
    """The page as parallel lists in page order: a parent stands before its children."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.own, self.skipped, self.named = ["html"], [-1], [0], [False], [UNNAMED]
        self.parts: list[tuple[int, str]] = []      # (node, text) in page order; text of a break: ""
        self.open = [0]
        self.at: defaultdict[str, list[int]] = defaultdict(list)       # places in ``open`` of each element
        self.scopes = [0]                           # and of those through which no end reaches

    def _close(self, k: int) -> None:
        """End the open elements from the k-th on."""
        for node in self.open[k:]:
            self.at[self.tag[node]].pop()
            if self.tag[node] in SCOPE:
                self.scopes.pop()
        del self.open[k:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html" or tag == "body" and self.at["body"]:
            return
        k = max((self.at[above][-1] for above in _ENDS.get(tag, ()) if self.at[above]), default=0)
        if k > self.scopes[-1]:
            self._close(k)
        if tag == "br":
            self.parts.append((self.open[-1], " "))
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.own.append(0)
        skip = self.skipped[self.open[-1]] or _is_hidden(tag, attrs)
        self.named.append(_named(tag, attrs))
        # an article's own header holds its title; any other one is the page's
        self.skipped.append(skip or tag == "header" and not any(self.at[x] for x in ARTICLE))
        if tag in BLOCK:
            self.parts.append((node, ""))
        if tag not in VOID:
            self.at[tag].append(len(self.open))
            if tag in SCOPE:
                self.scopes.append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)    # "/>" has no meaning in HTML

    def handle_endtag(self, tag: str) -> None:
        if not self.at[tag]:
            return
        k = self.at[tag][-1]
        if k < self.scopes[-1] and tag not in BLOCK and tag not in DROPPED:
            return
        if tag in BLOCK:
            self.parts.append((self.open[k], ""))
        self._close(k)

    def handle_data(self, data: str) -> None:
        node = self.open[-1]
        if not self.skipped[node]:
            self.own[node] += len(data) - data.count(" ") - data.count("\n")
            self.parts.append((node, data))

    def skip_named(self) -> None:
        """Skip what class, id or role name boilerplate, once the whole page is read.

        The name alone never takes an element that is or holds the page's main element or an article (not an article in
        an article, as comments are), nor, on pages without these, one with most of the text: densities decide there.
        Inside an article it takes no heading, and a weak word only an element whose text is mostly links.
        """
        if not any(self.named):
            return
        n = len(self.tag)
        chars, links, holds = list(self.own), [0] * n, [False] * n
        in_article, in_content = [False] * n, [False] * n
        for i in range(1, n):
            p = self.parent[i]
            in_article[i] = in_article[p] or self.tag[p] == "article"
            in_content[i] = in_content[p] or self.tag[p] in ARTICLE
            holds[i] = not self.skipped[i] and (self.tag[i] == "main" or self.tag[i] == "article" and not in_article[i])
        for i in range(n - 1, 0, -1):
            if self.tag[i] == "a":
                links[i] = chars[i]
            chars[self.parent[i]] += chars[i]
            links[self.parent[i]] += links[i]
            holds[self.parent[i]] |= holds[i]
        for i in range(1, n):
            kept = holds[i] or not holds[0] and 2 * chars[i] > chars[0]
            if in_content[i]:
                kept |= self.tag[i] in HEADINGS or self.named[i] == WEAKLY and 2 * links[i] < chars[i]
            self.skipped[i] |= self.skipped[self.parent[i]] or self.named[i] != UNNAMED and not kept
            if self.skipped[i]:
                self.own[i] = 0


#: A block with so many links, and most of its text in them, is a menu if its density doesn't reach the threshold.
MENU_LINKS = 3


def _densities(tree: _Tree) -> tuple[list[float], list[float], list[bool]]:
    """(density, sum of the children's densities, many links hold most of the text) of every node."""
    n = len(tree.tag)
    chars, tags, link_chars, link_tags = list(tree.own), [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if tree.tag[i] == "a":
            link_chars[i], link_tags[i] = chars[i], link_tags[i] + 1
        if (p := tree.parent[i]) >= 0 and not tree.skipped[i]:
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i]
    body = next((i for i in range(n) if tree.tag[i] == "body"), 0)
    body_ratio = link_chars[body] / max(1, chars[body])
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if tree.skipped[i] or not chars[i]:
            continue
        c, t, lc, lt = chars[i], max(1, tags[i]), link_chars[i], max(1, link_tags[i])
        base = math.log(c / max(1, c - lc) * lc + body_ratio * c + math.e)
        density[i] = c / t * (math.log(max(c / max(1, lc) * t / lt, 1.0)) / base)
        if tree.parent[i] >= 0:
            sums[tree.parent[i]] += density[i]
    linked = [lt >= MENU_LINKS and 2 * lc > c for c, lc, lt in zip(chars, link_chars, link_tags, strict=True)]
    return density, sums, linked


def _content_roots(tree: _Tree) -> tuple[set[int], set[int]]:
    """The nodes whose text is the main text (none of them lies in another one), and the menus inside of these."""
    density, sums, linked = _densities(tree)
    n, parent = len(density), tree.parent
    if not any(density):
        return {0} if any(tree.own) else set(), set()
    best = list(range(n))                   # node of the largest sum below (or at) each node
    for i in range(n - 1, 0, -1):
        if sums[best[i]] >= sums[best[parent[i]]]:
            best[parent[i]] = best[i]
    top = best[0]
    path, threshold = top, density[top]
    while path > 0 and tree.tag[path] != "body":
        path = parent[path]
        if density[path] > 0:
            threshold = min(threshold, density[path])
    marked, reached = {top}, [True] + [False] * (n - 1)
    for i in range(n):
        if i and not reached[parent[i]] or tree.skipped[i] or density[i] < threshold:
            continue
        marked.add(best[i])
        reached[i] = best[i] != i           # below marked content nothing is left to mark
    # the article as a whole, with its headings and short paragraphs
    article = [-1] * n
    for i in range(n):
        above = article[parent[i]] if i else -1
        article[i] = above if above >= 0 else i if tree.tag[i] in ARTICLE and not tree.skipped[i] else -1
    if article[top] >= 0:
        return {article[top]}, set()
    menus = {i for i in range(n) if linked[i] and density[i] < threshold}
    roots, inside = set(), [False] * n
    for i in range(n):
        inside[i] = i > 0 and inside[parent[i]]
        if i in marked and not inside[i]:
            roots.add(i)
            inside[i] = True
    return roots - menus, menus


def main_text(html: str | None) -> str:
    """Main text of one page: its blocks in page order, one per line.

    Null, empty or textless pages give "". White space inside a block becomes
    one space; nothing is cut, however long the page.
    """
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    tree.skip_named()
    roots, menus = _content_roots(tree)
    inside = [False] * len(tree.tag)
    for i in range(len(inside)):
        inside[i] = i in roots or i > 0 and inside[tree.parent[i]] and not tree.skipped[i] and i not in menus
    blocks, line = [], []
    for node, text in tree.parts:
        if not text:
            blocks.append("".join(line))
            line = []
        elif inside[node]:
            line.append(text)
    blocks.append("".join(line))
    return "\n".join(b for x in blocks if (b := WHITE.sub(" ", x).strip()))


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) -> page_id, url, text, n_chars (code points of text).

    One row per input row: repeated rows are extracted each by itself, a null
    or empty html gives an empty text, null ids and urls pass through, an
    empty table gives an empty one. Other columns are not read.
    """
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html") \
        .mapInArrow(extract, "page_id long, url string, text string, n_chars long")
