"""Main text of web pages by tree scoring.

A page becomes a tree of elements.  Every paragraph passes points to its
ancestors: one, one per comma, and up to three for its length; the parent gets
all of them, its parent half, further ancestors ever less.  A container's
points are discounted by the share of its text that lies in links.  The best
container is kept, with the siblings that score well enough against it;
elements that are never part of an article (menus, headers, footers, sidebars,
notices, adverts, forms, reader comments) neither score nor stay.

Pages are independent of each other: one scan, no shuffle.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import carried, carried_schema, restored, worker_cache

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*+>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

# Element names of the HTML standard, by role.
SKIPPED = frozenset("html head body".split())  # the root stands for the body
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPE = frozenset("table td th caption button template".split())  # implied end tags do not reach beyond these
#: A start tag of this name ends an open element of the first names that none of the second hides.
IMPLIED = {"li": (frozenset(["li"]), SCOPE | frozenset("ul ol menu dir".split())),
           "dt": (frozenset("dt dd".split()), SCOPE | {"dl"}), "dd": (frozenset("dt dd".split()), SCOPE | {"dl"}),
           "td": (frozenset("td th".split()), frozenset("tr table".split())),
           "th": (frozenset("td th".split()), frozenset("tr table".split())),
           "tr": (frozenset(["tr"]), frozenset("table tbody thead tfoot".split()))}
#: Paragraph-like: their points go to the parent, not to themselves.
PARAGRAPH = HEADING | frozenset("p pre li dt dd blockquote figcaption caption address summary".split())
#: Never containers of an article by themselves.
PART = PARAGRAPH | frozenset("ul ol dl dir figure table tbody thead tfoot tr".split())

# What is not the article, by element, by role and by the words of class and id.
OUTSIDE = frozenset("nav aside footer menu dialog form fieldset button select input label template object canvas audio "
                    "video map datalist".split())
OUTSIDE_ROLE = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar "
                         "toolbar".split())
OUTSIDE_NAME = frozenset(
    "ad ads adbox adsbygoogle adslot adunit adsense advert adverts advertisement advertisements advertising alert alerts banner "
    "breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer discussion disqus "
    "footer form gdpr login menu menubar modal nav navbar navigation newsletter notice notices notification overlay "
    "pager pagination popup promo promos promoted promotion recommendations recommended related replies reply respond "
    "search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription toolbar "
    "widget".split())
#: Their parts may be marked as articles: other ones, or comments.
OTHER_NAME = frozenset("comment comments commentlist discussion disqus promo recommendations recommended related replies "
                       "reply respond sidebar".split())
HEADER_NAME = frozenset("header masthead topbar".split())
ARTICLE_NAME = frozenset("article body content entry main post story text".split())
#: Class names that tell the state of a page (``has-sidebar``), not what an element is.
STATE_NAME = frozenset("has with no not is without js layout".split())

#: A paragraph passes points to so many ancestors.
ANCESTORS = 6
#: A sibling stays with this share of the best container's score.
SIBLING_SHARE = 0.2


def traits(attributes: str) -> tuple[bool, bool, bool, bool, bool]:
    """(outside the article, with articles of its own, a header, article-like, the main part) by attributes."""
    outside = other = header = article = main = False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            for word in value.split():
                parts = {p.lower() for p in NAME_PART.findall(word)}
                if not parts & STATE_NAME:
                    outside |= bool(parts & OUTSIDE_NAME)
                    other |= bool(parts & OTHER_NAME)
                    header |= bool(parts & HEADER_NAME)
                    article |= bool(parts & ARTICLE_NAME)
        elif name == "role":
            outside |= value.lower() in OUTSIDE_ROLE
            main |= value.lower() == "main"
        elif name == "itemprop":
            main |= value.lower() == "articlebody"
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            outside = True
        elif name == "style":
            outside |= "display:none" in value.replace(" ", "").lower()
    return outside, other, header, article and not outside, main and not outside


class Page:
    """Elements in page order (element 0 is the body) and pieces of text
    ``(element, block number, text)``; a parent comes before its children."""

    def __init__(self, source: str) -> None:
        self.tag, self.parent, self.attributes, self.pieces = ["body"], [-1], [""], []
        self._open, self._count, self._block = [0], Counter(), 0
        at, last = 0, source.rfind(">")
        while at < len(source):
            tag = source.find("<", at)
            if tag < 0:
                self._text(source[at:])
                break
            m = TOKEN.match(source, tag) if tag <= last else None
            if m is None:
                if tag > last and re.match(r"[A-Za-z/!?]", source[tag + 1:tag + 2]):
                    self._text(source[at:tag])  # a tag that never ends swallows the rest
                    break
                self._text(source[at:tag + 1])
                at = tag + 1
                continue
            self._text(source[at:tag])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name or name in SKIPPED:
                continue
            if m[1] or m[4]:
                self._end(name)
                continue
            self._start(name, m[3] or m[6] or "")
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else len(source)

    def _text(self, text: str) -> None:
        if text:
            self.pieces.append((self._open[-1], self._block, text))

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._text(" ")
        if name in BLOCK:
            self._block += 1
            self._close(frozenset(["p"]), SCOPE)
            if name in IMPLIED:
                self._close(*IMPLIED[name])
        if name in VOID or name in RAW:
            return
        self.tag.append(name)
        self.parent.append(self._open[-1])
        self.attributes.append(attributes)
        self._open.append(len(self.tag) - 1)
        self._count[name] += 1

    def _close(self, names: frozenset, stop: frozenset) -> bool:
        """End the innermost open element of ``names`` that no element of ``stop`` hides."""
        if not any(self._count[x] for x in names):
            return False
        for k in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[k]]
            if tag in names:
                self._count.subtract(self.tag[i] for i in self._open[k:])
                del self._open[k:]
                return True
            if tag in stop:
                return False
        return False

    def _end(self, name: str) -> None:
        if name in BLOCK:
            free = name in SCOPE or name in ("tr", "tbody", "thead", "tfoot")
            if self._close(frozenset([name]), frozenset() if free else SCOPE) or name == "p":
                self._block += 1
        else:
            self._close(frozenset([name]), BLOCK)


def outside_elements(page: Page) -> tuple[list[bool], list[tuple]]:
    """Which elements are no part of an article, and the traits of all."""
    cache = worker_cache().setdefault("traits", {})
    n = len(page.tag)
    kinds = []
    for a in page.attributes:
        if a not in cache:
            if len(cache) > 10_000:
                cache.clear()
            cache[a] = traits(a) if a else (False,) * 5
        kinds.append(cache[a])
    holds_article, holds_heading = [False] * n, [False] * n
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        holds_article[up] |= holds_article[i] or page.tag[i] in ("article", "main") or kinds[i][4]
        holds_heading[up] |= holds_heading[i] or page.tag[i] in HEADING
    out, inside = [False] * n, [False] * n
    for i in range(1, n):
        up, tag, (outside, other, header, _, main) = page.parent[i], page.tag[i], kinds[i]
        inside[i] = inside[up] or tag in ("article", "main") or main
        if tag == "header" or header and tag not in ("article", "main"):
            # the head of an article holds its title
            drop = not (inside[i] and holds_heading[i]) and not holds_article[i]
        elif tag in OUTSIDE and tag != "form":
            drop = True
        elif tag == "main":
            drop = False
        else:
            drop = other or (outside or tag == "form") and not holds_article[i]
        out[i] = out[up] or drop
    return out, kinds


def main_text(source: str) -> str:
    """The article of a page: its blocks, one a line."""
    page = Page(source)
    n = len(page.tag)
    out, kinds = outside_elements(page)
    link, block = [False] * n, [0] * n
    for i in range(1, n):
        link[i] = link[page.parent[i]] or page.tag[i] == "a"
        block[i] = i if page.tag[i] in BLOCK else block[page.parent[i]]

    blocks: list[list] = []  # [block number, [text], element, first element, characters in links]
    pieces: list[list] = []
    for element, number, text in page.pieces:
        if out[element]:
            continue
        text = html.unescape(text) if "&" in text else text
        if not pieces or pieces[-1][0] != number:
            pieces.append([number, [], block[element], element, 0])
        pieces[-1][1].append(text)
        if link[element]:
            pieces[-1][4] += len(text.strip())
    for number, parts, element, first, linked in pieces:
        text = " ".join("".join(parts).split())
        if text:
            blocks.append([text, element, first, linked])

    points, chars, linked_chars = [0.0] * n, [0] * n, [0] * n
    for text, element, _, linked in blocks:
        chars[element] += len(text)
        linked_chars[element] += min(linked, len(text))
        worth = 1 + text.count(",") + text.count("，") + text.count("、") + min(len(text) / 100, 3)
        if page.tag[element] in HEADING:
            worth = 0.5
        at, level = (page.parent[element] if page.tag[element] in PARAGRAPH else element), 0
        while at >= 0 and level < ANCESTORS:
            points[at] += worth / (1 if level == 0 else 2 if level == 1 else 3 * level)
            at, level = page.parent[at], level + 1
    for i in range(n - 1, 0, -1):
        chars[page.parent[i]] += chars[i]
        linked_chars[page.parent[i]] += linked_chars[i]

    def density(i: int) -> float:
        return linked_chars[i] / chars[i] if chars[i] else 0.0

    def score(i: int) -> float:
        if out[i] or not points[i]:
            return 0.0
        bonus = 25 if page.tag[i] == "article" else 10 if page.tag[i] == "main" or kinds[i][3] or kinds[i][4] else 0
        return (points[i] + bonus) * (1 - density(i))

    scores = [score(i) if page.tag[i] in BLOCK or i == 0 else 0.0 for i in range(n)]
    best = max(range(n), key=lambda i: (scores[i], -i))
    if not scores[best]:
        best = 0
    # a part of a text is no container; the article or main element around the best one is the whole article
    top = best
    while top and page.tag[top] in PART:
        top = page.parent[top]
    for marked in (lambda i: page.tag[i] == "article", lambda i: page.tag[i] == "main" or kinds[i][4]):
        at = top
        while at > 0 and not marked(at):
            at = page.parent[at]
        if at > 0:
            top = at
            break

    kept = siblings(page, top, scores, density, chars, out)
    inside = [False] * n
    for i in range(n):
        inside[i] = i in kept or i > 0 and inside[page.parent[i]]
    return "\n".join(text for text, _, first, _ in blocks if inside[first])


def siblings(page: Page, top: int, scores: Sequence[float], density, chars: Sequence[int],
             out: Sequence[bool]) -> set[int]:
    """The container and those of its siblings that belong to the same text."""
    kept = {top}
    if top == 0:
        return kept
    near = [i for i in range(1, len(page.tag)) if page.parent[i] == page.parent[top] and not out[i] and chars[i]]
    titles = [i for i in range(len(page.tag)) if page.tag[i] == "h1" and not out[i]]
    for i in near:
        same = page.tag[i] == page.tag[top] and page.attributes[i] == page.attributes[top]
        if page.tag[i] in ("article", "main") or page.tag[top] in ("article", "main"):
            good = same and page.tag[i] == "main"  # another article is another article
        elif page.tag[i] in PARAGRAPH:
            good = page.tag[i] == "p" and density(i) < 0.25 and chars[i] > 80
        else:
            good = scores[i] + (SIBLING_SHARE * scores[top] if same else 0) >= max(10, SIBLING_SHARE * scores[top])
        if good or titles == [i] and i < top and not density(i):
            kept.add(i)
    # what stands between two kept siblings is the same text, unless it is links
    low, high = min(kept), max(kept)
    return kept | {i for i in near if low < i < high and density(i) < 0.5}


def extract_main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                      carry: Sequence[str] = ()) -> DataFrame:
    """``page_id, text`` of every page, and the columns named in ``carry``.

    ``text`` is the article without menus, headers, footers, sidebars,
    notices, adverts, forms, scripts, styles, markup and reader comments.
    Character references are decoded, white space inside a block becomes one
    space, blocks are joined in page order by one newline; nothing else is
    dropped and no length is capped.

    Null html is the empty page, and a page without text gives the empty
    text; html that ends in the middle, nests wrongly or holds no markup at
    all is read as far as it goes.  Repeated rows and null ids each give their
    row; further columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):  # few texts at a time, however large the batch
                part = batch.slice(start, 256)
                texts = [main_text(x.as_py() or "") for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), *part.columns[2:]],
                                                 names=["page_id", "text", *part.schema.names[2:]])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"),
                        *carried(carry))
    out = rows.mapInArrow(run, carried_schema(rows, "page_id long, text string"))
    return out.select("page_id", "text", *restored(carry))
