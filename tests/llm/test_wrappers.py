"""Main text: planted pages, wrapper alignment, and the pages table by a plain rule."""

from __future__ import annotations

import html
import re

import pytest

from tests.llm.conftest import with_clashes
from voxelweave.llm import wrappers
from voxelweave.llm.queries import all_queries


def text_of(*pages, at=0):
    merged = None
    for page in pages:
        new = wrappers.wrapper_of(wrappers.parse(page))
        merged = wrappers.merge(merged, new) if merged else new
    return wrappers.extract(wrappers.parse(pages[at]), wrappers.mark_main(merged))


FULL = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></ul></nav><div class="content-sidebar-wrap"><div id="sidebar">links</div><main>
<article class="post"><h2>A &amp; B</h2><p>One &lt;two&gt;   <b>bold</b><span class="ad-slot">BUY</span> end<br>line<p>Second
<ul><li>x<li>y</ul><script>var t="</p>";</script><section class="comments"><p>c1</p></section><form>f<input></form></article>
</main></div><div role="alert">cookie notice</div><footer>z</footer>"""


def test_a_page_with_everything():
    assert text_of(FULL) == "A & B\nOne <two> bold end\nline\nSecond\nx\ny"


def test_without_article_the_largest_unlinked_part():
    page = (
        '<body><div class="menu"><a href=x>a</a></div><div id=c><p>Long text that is the main part of it</p><p>more of the main part'
        '</p></div><ul><li><a href=y>a long link text that goes elsewhere</a></li></ul><div class="footer">z</div>'
    )
    assert text_of(page) == "Long text that is the main part of it\nmore of the main part"


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<!-- x", "<script>a", "</p></div>", "<nav>only</nav>"])
def test_nothing_to_extract(page):
    assert wrappers.extract(wrappers.parse(page), wrappers.mark_main(wrappers.wrapper_of(wrappers.parse(page)))) in ("", page.strip())


def test_alignment_finds_slots_options_and_repeats():
    pages = [
        "<body><div><h2>t1</h2><p>a<p>b<p>c</div><footer>same</footer>",
        "<body><div><h2>t2</h2><img><blockquote>q</blockquote><p>d</div><footer>same</footer>",
    ]
    a, b = (wrappers.wrapper_of(wrappers.parse(p)) for p in pages)
    merged = wrappers.merge(a, b)
    assert merged[4] and merged[4][0][0] == "body"
    div, footer = merged[4][0][4]
    assert [(n[0], n[1], n[2]) for n in div[4]] == [("h2", False, False), ("blockquote", True, False), ("p", False, True)]
    assert div[4][0][4][0][3] is None and footer[4][0][3] == wrappers._digest("same")


def test_repeated_groups_fold():
    page = "<body><dl>" + "".join(f"<dt>k{i}<dd>v{i}" for i in range(5)) + "</dl>"
    node = wrappers.wrapper_of(wrappers.parse(page))[4][0][4][0]
    assert [c[0] for c in node[4]] == ["("] and [c[0] for c in node[4][0][4]] == ["dt", "dd"]


def test_deep_and_long_pages():
    deep = "<body><article>" + "<div>" * 5000 + "text" + "</div>" * 5000
    assert text_of(deep) == "text"
    long_page = "<article>" + "<p>word &amp; more</p>" * 20_000
    assert text_of(long_page).count("\n") == 19_999


def test_every_template_of_a_host_keeps_its_text(spark):
    kinds = [
        "<body><article class='post category-news'><p>{}</p></article></body>",
        "<body><article class='post category-sport'><p>{}</p></article></body>",
        "<body class='page sport'><div class='box'><article class='post category-news'><p>{}</p></article></div></body>",
        "<body class='plain'><nav>menu</nav><div class='story'><p>{}</p></div><footer>end</footer></body>",
    ]
    rows = [(i, f"http://h.example/{i}" if i % 2 else None, kinds[i % 7 % 4].format(f"text number {i} of the site")) for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(40)
    found = {r["page_id"]: r["text"] for r in wrappers.main_text(pages).collect()}
    assert found == {i: f"text number {i} of the site" for i in range(100)}


def test_query_over_the_table(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = all_queries()["op5_main_text"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)\b[^>]*>", article))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_odd_rows(spark):
    rows = [(1, "http://a.example/x", FULL), (1, "http://a.example/x", FULL), (2, None, None), (3, "", ""), (None, "nohost", FULL)]
    pages = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"))
    found = wrappers.main_text(pages).collect()
    assert len(found) == 5
    assert {r["text"] for r in found if r["page_id"] in (2, 3)} == {""}
    assert len({r["text"] for r in found if r["page_id"] in (1, None)}) == 1
    assert wrappers.main_text(pages.limit(0)).count() == 0


def hosted(spark, pages):
    rows = [(i, f"http://h.example/{i}", page) for i, page in enumerate(pages)]
    out = wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(out, key=lambda r: r["page_id"])]


def test_a_hidden_sibling_takes_nothing_else_along(spark):
    pages = [f"<article><h1>t{i}</h1><p>first {i}</p><p>second {i}</p></article>" for i in range(6)]
    pages[3] = "<article><h1>t3</h1><p hidden>secret</p><p>first 3</p><p style='display: none'>x</p><p>second 3</p></article>"
    assert hosted(spark, pages) == [f"t{i}\nfirst {i}\nsecond {i}" for i in range(6)]


@pytest.mark.parametrize("depth", [100, 200, 5000])
def test_deep_pages(depth):
    inner = "<div>" * depth + "<p>inner</p><nav>MENU</nav><p>more</p>" + "</div>" * depth
    assert text_of(f"<body><article><p>before</p>{inner}<p>after</p></article><footer>z</footer>") == "before\ninner\nmore\nafter"


def test_subjects_are_not_noise():
    names = ["related-work", "share-price", "article-header", "skip-list", "sidebar-theory"]
    sections = "".join(f'<section class="{n}"><p>{n} text</p></section>' for n in names)
    noise = "".join(f'<div class="{n}">GONE</div>' for n in ["related-posts", "share-buttons", "comments", "ad-slot", "newsletterSignup"])
    kept = "<math>x+1</math><svg><text>drawn</text></svg><object>fallback</object>"
    got = text_of(f"<body><article>{sections}{noise}<div>{kept}</div></article>")
    assert got == "\n".join([*(f"{n} text" for n in names), "x+1", "drawn", "fallback"])


def test_the_host_decides_what_is_constant(spark):
    """A notice without a telling name is seen by its repetition only: the page alone keeps it, its host's wrapper drops it."""
    notice = "<p>All rights belong to the editors of this page.</p>"
    pages = [f"<article><h1>t{i}</h1><p>body {i}</p>{notice}<p>end {i % 3}</p></article>" for i in range(20)]
    assert text_of(pages[0]) == "t0\nbody 0\nAll rights belong to the editors of this page.\nend 0"
    assert hosted(spark, pages) == [f"t{i}\nbody {i}\nend {i % 3}" for i in range(20)]
    few = pages[: wrappers.PAGES - 1]
    assert all("rights" in text for text in hosted(spark, few))
    same = ["<article><h1>copy</h1><p>one text on all pages</p></article>"] * 10
    assert hosted(spark, same) == ["copy\none text on all pages"] * 10


def test_the_main_part_comes_from_the_host(spark):
    """On one page the by-line has most text; the host shows where the text of its pages is."""
    page = "<body><div class=a><p>{0}</p></div><div class=b><p>{1}</p></div></body>"
    pages = [page.format(f"a long text of page {i} that goes on and on " * 4, f"extra {i}") for i in range(30)]
    pages.append(page.format("short one", "a very long by-line that only this page has in its second part " * 2))
    assert text_of(pages[30]).startswith("a very long")
    assert hosted(spark, pages)[30] == "short one"
