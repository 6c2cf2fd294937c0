"""Main text of pages: the given pages against a plain cut, and pages made by hand."""

from __future__ import annotations

import html
import re
import time

import pytest

from macrotide.llm.html_extraction import extract_text, main_text
from tests.conftest import SF_DIR
from tests.llm.queries import run

LONG = "Some text with marks, quite long; it goes on and on. And there is more of it, as there should be."


def test_given_pages(spark):
    """Their articles hold paragraphs and a heading and nothing that is to go."""
    found = {r.page_id: (r.text, r.n_chars) for r in run(spark, "op13_html_main_text")}
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        article = re.search("<article>(.*)</article>", page.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        text = "\n".join(filter(None, blocks))
        assert found[page.page_id] == (text, len(text))


@pytest.mark.parametrize(("page", "text"), [
    ("", ""),
    ("no markup & <3 of it", "no markup & <3 of it"),
    ("<p>a<p>b<script>if(a<b){'</p>'}</script>c<!-- x -->d</p>e<br>f", "a\nbcd\ne f"),
    ("<p>&lt;b&gt; &amp;amp; &eacute;&#233;&copy</p>", "<b> &amp; éé©"),
    ("<div hidden>x</div><div style='display: none'>y</div>", ""),
    ("<article class=comment>c</article><article><header><h1>t</h1></header>x<section class=comments>no</section> y</article>", "x\ny"),
    ("<main><p>Main one.</p><aside>no</aside><div class='cookie-notice'>We use.</div></main>", "Main one."),
    ("<main><article><p>In.</p></article><p>Out.</p></main>", "In."),
    ("<article><h1>T</h1><form>f</form><nav>n</nav><ul><li>one<li>two</ul><table><tr><td>1<td>2</table><p>end", "T\none\ntwo\n1\n2\nend"),
    ("<article><p title='a>b'>q</p><div id=sideBar>s</div><div class=has-sidebar>k</div></article><footer>f</footer>", "q\nk"),
    ("<article>cut off <b", "cut off"),
    ("<title>t</title><p>x", "x"),
    ("<!-- open <p>x", ""),
    ("<ARTICLE><P>Up\t\n per &nbsp; case</P></ARTICLE>", "Up per case"),
])
def test_small_pages(page, text):
    assert main_text(page) == text


def test_paths_without_an_article():
    page = (
        "<body><div class=top><a href=1>Home</a> <a href=2>About</a></div><div id=x><h1>A title</h1>"
        + f"<p>{LONG}<p>Short.<p>{LONG} <a href=3>link</a><ul><li>item one<li>two</ul></div><div class=x9>Home | About</div></body>"
    )
    assert main_text(page) == "\n".join(["A title", LONG, "Short.", f"{LONG} link", "item one", "two"])


def test_ratios_decide_whether_an_article_is_the_main_text():
    """A teaser of another page is an article too, but not this page's."""
    teaser = "<article class=card><h3><a href=1>Other</a></h3><p>Read on.</p></article>"
    text = f"<div id=text><h2>A title</h2><p>{LONG}<p>Short.<p>{LONG}<p>{LONG}</div>"
    found = main_text(f"<body>{text}{teaser * 3}</body>").split("\n")
    assert found[:5] == ["A title", LONG, "Short.", LONG, LONG]
    assert main_text(f"<body><article>{text}</article><p>Read on.</body>").split("\n") == found[:5]


def test_odd_markup_takes_no_more_than_its_length():
    began = time.process_time()
    for page in ("<div>" * 100_000 + "x", '<a "' * 20_000, "</b>" * 100_000 + "<b><i>" * 20_000 + "</b>" * 20_000, "<p>" * 100_000, "<!--" * 50_000):
        main_text(page)
    assert time.process_time() - began < 20


def test_rows_are_kept(spark):
    rows = [(1, "u", "<article>a</article>"), (1, "u", "<article>a</article>"), (None, None, "<p>b"), (2, "v", None), (3, None, ""), (4, "w", f"<p>{LONG}" * 20_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    found = sorted([(r.page_id, r.url, r.text, r.n_chars) for r in extract_text(df).collect()], key=str)
    long = "\n".join([LONG] * 20_000)
    assert found == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "b", 1), (2, "v", "", 0), (3, None, "", 0), (4, "w", long, len(long))], key=str)
    assert extract_text(df.limit(0)).collect() == []
