"""Extraction against expectations written by hand from the pages, not from
the patterns: what a reader of each page would expect to get."""

import pytest
from pyspark.sql import functions as F

from webledger.operators import discover as D
from webledger.operators import extract as E
from webledger.operators import monitor as M

SHOP = """<!DOCTYPE html>
<html lang="en"><head><title>Tea &amp; Co</title><style>p { color: red }</style></head>
<body><header><a href="/">Home</a></header>
<nav><ul><li><a href="/tea">Tea</a></li><li><a href="mugs.html">Mugs</a></li></ul></nav>
<!-- build 7 --><div class="ad big">Buy &lt;now&gt;!</div>
<main><h1>Green <em>tea</em></h1><p>Steep for 2&nbsp;min.<br>Then pour.</p>
<img src="data:image/gif;base64,R0lGOD" alt="dot"><img src="/cup.png" alt="cup">
<p>See <a href="https://other.test/x?a=1&amp;b=2" rel="n">more</a>.</p>
<script>document.write("<p>no</p>")</script></main>
<footer>&copy; Tea &middot; 2024</footer></body></html>"""
STORY = """<html lang="de"><head><title> </title></head><body><article class="post"><h2>Eins</h2><p>Erster Satz.</p>
<ul><li>a</li><li>b</li></ul></article><div class="sponsored">Werbung</div><footer>Fuß</footer></body></html>"""
CHANGED = STORY.replace("Erster Satz.", "Zweiter Satz.").replace("<li>b</li>", "<li>b</li><li>c</li>")


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(
        [(1, "https://shop.test/en/green.html", SHOP), (2, "https://news.test/s/eins", STORY)], "page_id long, url string, html string"
    )


def by_page(df, *columns):
    return {r["page_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_links(pages):
    got = [(r.page_id, r.pos, r.link) for r in E.extract_links(pages).orderBy("page_id", "pos").collect()]
    assert got[:3] == [(1, 0, "https://shop.test/"), (1, 1, "https://shop.test/tea"), (1, 2, "https://shop.test/en/mugs.html")]
    assert len(got) == 4 and got[3][2].startswith("https://other.test/x?a=1")


def test_markdown(pages):
    got = by_page(E.extract_markdown(pages), "markdown")
    assert got[2] == "## Eins\n\nErster Satz.\n\n- a\n- b\n\nWerbung\n\nFuß"
    text = got[1]
    assert "# Green tea\n" in text and "Steep for 2 min.\nThen pour." in text and "[more](https://other.test/x?a=1&b=2)" in text
    assert "- [Tea](/tea)\n- [Mugs](mugs.html)" in text and "© Tea · 2024" in text and "Buy <now>!" in text
    for gone in ("color", "build 7", "document.write", "Tea & Co"):
        assert gone not in text


def test_clean_and_raw_html(pages):
    got = by_page(E.extract_html(pages), "clean_html", "raw_html")
    assert got[1][1] == SHOP and got[2] == (STORY, STORY)
    assert "<h1>Green <em>tea</em></h1>" in got[1][0]
    for gone in ("<style", "build 7", "<script"):
        assert gone not in got[1][0]


def test_fields(pages):
    got = by_page(E.extract_json(pages), "title", "heading", "lang", "json")
    assert got[1] == ("Tea & Co", "Green tea", "en", '{"title":"Tea & Co","heading":"Green tea","lang":"en"}')
    assert got[2] == (None, None, "de", '{"lang":"de"}')


def test_main_content(pages):
    got = by_page(E.main_content(pages), "main_html")
    assert got[1].startswith("<h1>Green") and "<nav>" not in got[1] and "<footer>" not in got[1]
    assert got[2] == '<h2>Eins</h2><p>Erster Satz.</p>\n<ul><li>a</li><li>b</li></ul>'


def test_tags_by_pattern_and_by_tree_agree_where_nothing_nests(pages):
    flat = by_page(E.filter_tags(pages, exclude=["nav", "footer"]), "filtered_html")
    tree = by_page(E.filter_tags_tree(pages, exclude=["nav", "footer"]), "filtered_html")
    assert flat == tree  # doctype, comments and end tags included
    assert flat[2] == STORY.replace("<footer>Fuß</footer>", "")
    only = by_page(E.filter_tags(pages, include=["h1", "h2"]), "filtered_html")
    assert only == {1: "<h1>Green <em>tea</em></h1>", 2: "<h2>Eins</h2>"}


def test_nested_tags_are_matched_by_depth(spark):
    cases = [
        ("<div><div>inner</div>tail</div><p>keep<span>s</span></p>", [], ["div"], "<p>keep<span>s</span></p>"),
        ("a<DIV class='x > y'>b<div>c</DIV>d</div>e", [], ["div"], "ae"),
        ("a<div>b<div>c</div>d</div>e<div>f</div>", ["div"], [], "<div>b<div>c</div>d</div><div>f</div>"),
        ("<div>a<nav>b<div>c</div></nav>d</div>e", ["div"], ["nav"], "<div>ad</div>"),
        ("</nav>a<nav>b</nav></nav>c<nav>d", [], ["nav"], "ac"),
        ("<nav>x<!-- </nav> -->y<script>'</nav>'</script>z</nav>w", [], ["nav"], "w"),
        ("a<script>if (a<b) '<nav>'</script><navy>b</navy>", [], ["nav", "script"], "a<navy>b</navy>"),
        ("a<br>b<img src=x>c<nav/>d", [], ["br", "nav"], "ab<img src=x>cd"),
        ("a<br>b", ["br"], [], "<br>"),
        ("a < b <3 <", [], ["nav"], "a < b <3 <"),
        ("<p title=it's>don't</p><nav>x</nav>", [], ["nav"], "<p title=it's>don't</p>"),
        ("a<nav", [], ["nav"], "a<nav"),
        ("", [], ["nav"], ""),
        (None, [], ["nav"], None),
        ("<b>\u00e9\n\n\U0001f600</b>", [], [], "<b>\u00e9\n\n\U0001f600</b>"),
    ]
    for html, include, exclude, want in cases:
        df = spark.createDataFrame([(1, html, "s"), (2, html, "t")], "page_id long, html string, _tag string")
        got = E.filter_nested_tags(df, include, exclude).collect()
        assert sorted((r.page_id, r._tag) for r in got) == [(1, "s"), (2, "t")]
        assert {r.filtered_html for r in got} == {want}, html


def test_nested_tags_of_a_very_long_page(spark):
    html = "<div>" * 20_000 + "deep" + "</div>" * 20_000 + "<p>x</p>" * 20_000
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert E.filter_nested_tags(df, exclude=["div"]).first().filtered_html == "<p>x</p>" * 20_000
    assert E.filter_nested_tags(df, include=["div"], exclude=["p"]).first().filtered_html == html[: html.index("<p>")]


def test_nested_and_tree_mode_agree(pages):
    for include, exclude in ((["body"], ["nav", "footer"]), ([], ["div", "ul"]), (["article", "h1"], [])):
        nested = by_page(E.filter_nested_tags(pages, include, exclude), "filtered_html")
        assert nested == by_page(E.filter_tags_tree(pages, include, exclude), "filtered_html")


def test_images_and_adverts(pages):
    got = by_page(E.strip_base64_images(pages), "html")
    assert got == {1: SHOP.replace('<img src="data:image/gif;base64,R0lGOD" alt="dot">', ""), 2: STORY}
    got = by_page(E.block_ads(pages), "html")
    assert got == {1: SHOP.replace('<div class="ad big">Buy &lt;now&gt;!</div>', ""), 2: STORY.replace('<div class="sponsored">Werbung</div>', "")}


def test_scrape_gives_each_format_asked_for(pages):
    every = F.array(*[F.lit(f) for f in ("markdown", "html", "rawHtml", "links", "json")])
    out = {r.page_id: r for r in E.scrape(pages, every, only_main_content=True).collect()}
    assert out[1].raw_html == SHOP and out[2].raw_html == STORY  # as captured, whatever the options
    assert out[2].markdown == "## Eins\n\nErster Satz.\n\n- a\n- b"
    assert out[1].links == ["https://other.test/x?a=1&amp;b=2"] or out[1].links == ["https://other.test/x?a=1&b=2"]
    assert "Home" not in out[1].markdown and "dot" not in out[1].html_out and "cup.png" in out[1].html_out
    one = E.scrape(pages, F.array(F.lit("links"))).where("page_id = 2").first()
    assert (one.markdown, one.html_out, one.raw_html, one.json, one.links) == (None, None, None, None, [])


def test_line_diffs(spark, pages):
    new = spark.createDataFrame([(2, "https://news.test/s/eins", CHANGED)], pages.schema)
    got = sorted((r.kind, r.line) for r in M.diff_lines(pages, new).collect())
    assert got == [("added", "- c"), ("added", "Zweiter Satz."), ("removed", "Erster Satz.")]


def test_crawled_pages_are_extracted(spark, pages):
    links = E.extract_links(pages).select("page_url", "link")
    _, edges = D.scoped_links(pages, links, exclude_paths=["^/tea"], allow_external=True, ignore_sitemap=True, allow_backward=True)
    seeds = spark.createDataFrame([("https://shop.test/en/green.html",)], "node string")
    got = {r.node: r.depth for r in D.crawl(edges, seeds).collect()}
    assert got.pop("https://shop.test/en/green.html") == 0 and "https://shop.test/tea" not in got
    assert set(got.values()) == {1} and {"https://shop.test/", "https://shop.test/en/mugs.html"} < set(got) and len(got) == 3


def test_crawl_scope_options(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(
        ["https://a.test/d/", "https://a.test/d/x", "https://a.test/e/y", "https://www.a.test/d/x.html"])], "page_id long, url string")
    links = spark.createDataFrame([("https://a.test/d/", u) for u in (
        "https://a.test/d/x", "https://a.test/e/y", "https://b.test/d/z", "https://a.test/d/x?ref=1", "https://a.test/d/p.html")],
        "page_url string, link string")

    def reach(**options):
        _, edges = D.scoped_links(pages, links, ignore_sitemap=True, **options)
        return {r.dst for r in edges.collect()}

    assert reach() == {"https://a.test/d/x", "https://a.test/d/x?ref=1", "https://a.test/d/p.html"}
    assert "https://a.test/e/y" in reach(allow_backward=True) and "https://b.test/d/z" in reach(allow_external=True)
    assert reach(include_paths=[r"\.html$"]) == {"https://a.test/d/p.html"}
    assert reach(exclude_paths=[r"\.html$"]) == {"https://a.test/d/x", "https://a.test/d/x?ref=1"}
    assert reach(dedupe_similar=True) == {"https://a.test/d/x", "https://a.test/d/p.html"}
    _, edges = D.scoped_links(pages, links.limit(0))  # the sitemap alone
    assert {(r.src, r.dst) for r in edges.collect()} == {("https://a.test/d/", u) for u in ("https://a.test/d/x", "https://a.test/e/y")}
