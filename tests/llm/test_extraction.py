"""Main text of pages: the given pages by a pattern for their one template,
and hand-made pages whose article is known."""

import html
import os
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from riskweave.llm.extraction import extract_main_text, main_text
from riskweave.llm.queries import op13_html_extraction

SF = "/root/testdata/sf0.001"
LONG = "A sentence with some words, a comma or two, and enough length to count as a paragraph of text. " * 3
TEXT = LONG.strip()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_given_pages(spark):
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    expected = []
    for page_id, url, source in pages:
        inner = re.search(r"<article>(.*)</article>", source, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
        text = "\n".join(x for x in blocks if x)
        expected.append((page_id, url, text, len(text)))
    assert sorted(map(tuple, op13_html_extraction(spark, SF).collect())) == sorted(expected)


AROUND = {
    "menu": "<nav><ul><li><a href='/'>Home</a></li></ul></nav>",
    "header": "<header><h1>The Site</h1><p>Daily news, every day, for all of us</p></header>",
    "masthead": "<div class='site-header'><p>{0}</p></div>",
    "footer": "<footer><p>{0}</p></footer>",
    "foot": "<div id='page-footer'><p>{0}</p></div>",
    "aside": "<aside><p>{0}</p></aside>",
    "sidebar": "<div class='col sidebar-left'><p>{0}</p></div>",
    "notice": "<div class='cookieNotice'><p>{0}</p></div>",
    "advert": "<div class='ad'>{0}</div><ins class='adsbygoogle'>{0}</ins>",
    "form": "<form action='/x'><label>Mail</label><input name=m><p>{0}</p><button>Go</button></form>",
    "script": "<script>var a = '</p><p>{0}';</script><style>p {{ color: red }}</style><noscript><p>{0}</p></noscript>",
    "comment": "<!-- <p>{0}</p> --><section class='comments'><h2>Comments</h2><article><p>{0}</p></article></section>",
    "hidden": "<div hidden><p>{0}</p></div><div style='display: none'><p>{0}</p></div>",
    "links": "<div class='x'><p><a href='/1'>{0}</a></p><p><a href='/2'>{0}</a></p></div>",
}


@pytest.mark.parametrize("kind", sorted(AROUND))
@pytest.mark.parametrize("shell", ["<article>{}</article>", "<main>{}</main>", "<div class='post-body'>{}</div>",
                                   "<div id=c><div>{}</div></div>"])
def test_what_is_not_the_article(kind, shell):
    part = AROUND[kind].format("Other words, also long, that do not belong to the text of the page at all. " * 4)
    article = shell.format(f"<p>{LONG}</p><p>Short.</p><ul><li>One</li><li>Two</li></ul><p>{LONG}</p>")
    wanted = "\n".join([TEXT, "Short.", "One", "Two", TEXT])
    head = "<!DOCTYPE html><html><head><title>T</title></head><body>"
    assert main_text(f"{head}{part}{article}</body></html>") == wanted
    assert main_text(f"{head}{article}{part}</body></html>") == wanted


@pytest.mark.parametrize("kind", sorted(set(AROUND) - {"header", "links"}))
def test_parts_inside_the_article(kind):
    part = AROUND[kind].format("Other words, also long, that do not belong to the text of the page at all. " * 2)
    page = f"<body><article><header><h1>Title</h1></header><p>{LONG}</p>{part}<p>End.</p></article></body>"
    assert main_text(page) == f"Title\n{TEXT}\nEnd."


@pytest.mark.parametrize("source, wanted", [
    ("", ""), ("   ", ""), ("<p>", ""), ("plain text only", "plain text only"), ("a < b & c", "a < b & c"),
    ("<p>one<p>two<p>three", "one\ntwo\nthree"),
    ("<article><h1>T</h1><p>a&nbsp;b &amp;amp; &lt;c&gt; &#233;&#x41; &copy &unknown; &am</p></article>",
     "T\na b &amp; <c> éA © &unknown; &am"),
    ("<article><p>a <b>b</b>c<i>d</i>\n\n e<br>f</p>tail</article>", "a bcd e f\ntail"),
    ("<article><p>x<!-- y > z -->w</p><p>1 < 2</p></article>", "xw\n1 < 2"),
    ("<article><p title='a > b'>kept</p><p class=\"x>text</p><p>more</p></article>", "kept\ntext\nmore"),
    ("<article><p>cut in the mid", "cut in the mid"), ("<article><p>cut</p><p in", "cut"),
    ("<article><p><b>T<br><p>one</p></article><footer>no</footer>", "T\none"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
    ("<ARTICLE><P>Upper</P><SCRIPT>x()</SCRIPT></ARTICLE>", "Upper"),
    ("<article><p>a</div></span>b</p></article>", "ab"),
    ("<article><script>never closed <p>x</p>", ""),
    ("<article><blockquote><p>q</p></blockquote><pre>c  d</pre></article>", "q\nc d"),
])
def test_small_pages(source, wanted):
    assert main_text(source) == wanted


def test_split_text_keeps_its_siblings():
    sections = "".join(f"<div class='sec'><h2>H{i}</h2><p>{LONG}</p></div>" for i in range(3))
    page = f"<body><nav><a href=x>m</a></nav><div id=w>{sections}<p>Between.</p><div class='sec'><p>{LONG}</p></div></div></body>"
    assert main_text(page) == "\n".join([f"H{i}\n{TEXT}" for i in range(3)] + ["Between.", TEXT])


def test_page_state_classes_do_not_hide_the_text():
    page = (f"<body class='has-sidebar'><div class='layout no-comments with-sidebar'><div class='main-content'>"
            f"<p>{LONG}</p></div></div></body>")
    assert main_text(page) == TEXT
    form = f"<form id=all><div class='main'><p>{LONG}</p></div><article><p>{LONG}</p></article></form>"
    assert TEXT in main_text(form)


@pytest.mark.parametrize("unit", ["<div>a", "<div>", "<a ", "<p><b>", "<", "</div>", "<!--", "<li>", "<a href=\"", "&", "<i>x</b>"])
def test_hard_pages_end(unit):
    began = time.time()
    main_text(unit * 60_000)
    assert time.time() - began < 20


def test_rows(spark):
    page = "<article><p>hello</p></article>"
    rows = [(1, page), (1, page), (None, page), (2, None), (3, ""), (4, f"<article><p>{'w ' * 200_000}</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumns({"text": F.lit("t"), "tag": F.lit(3)})
    out = extract_main_text(pages, carry=("tag",)).collect()
    got = sorted(((r.page_id is not None, r.page_id), len(r.text), r.tag) for r in out)
    assert got == [((False, None), 5, 3), ((True, 1), 5, 3), ((True, 1), 5, 3), ((True, 2), 0, 3), ((True, 3), 0, 3),
                   ((True, 4), 399_999, 3)]
    assert extract_main_text(pages.limit(0)).count() == 0
