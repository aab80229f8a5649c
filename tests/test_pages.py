"""Pages: extraction on synthetic HTML, tree-mode tag filter, crawl depth."""

import datetime as dt

from pyspark.sql import functions as F

from webledger.functions import html as H
from webledger.functions.urls import resolve
from webledger.operators import discover as D
from webledger.operators import extract as E


def _pages(spark, docs):
    return spark.createDataFrame([(i, "https://ex.test/a/b.html", d) for i, d in enumerate(docs)],
                                 "page_id long, url string, html string")


def test_markdown_rules(spark):
    doc = ('<html><head><title>T</title><script>var x="</p>";</script></head><body><h2>Sub &amp; more</h2>'
           '<p>One <a href="/x">link</a></p><ul><li>a</li><li>b</li></ul><!-- c --></body></html>')
    md = E.extract_markdown(_pages(spark, [doc])).first().markdown
    assert md == "## Sub & more\n\nOne [link](/x)\n\n- a\n- b"


def test_links_resolve(spark):
    df = spark.createDataFrame(
        [("https://ex.test/a/b.html?q=1", h) for h in ["/r", "rel", "//cdn.test/x", "#f", "?p=2", "mailto:a@b"]],
        "base string, href string",
    )
    got = [r.u for r in df.select(resolve(F.col("base"), F.col("href")).alias("u")).collect()]
    assert got == ["https://ex.test/r", "https://ex.test/a/rel", "https://cdn.test/x",
                   "https://ex.test/a/b.html?q=1#f", "https://ex.test/a/b.html?p=2", "mailto:a@b"]


def test_base64_images_and_ads(spark):
    doc = '<p>x<img src="data:image/png;base64,AAAA" alt="a"><img src="/y.png"></p><div class="ad x">buy</div><p>z</p>'
    out = E.block_ads(E.strip_base64_images(_pages(spark, [doc]))).first().html
    assert out == '<p>x<img src="/y.png"></p><p>z</p>'


def test_filter_tags_tree_handles_nesting(spark):
    doc = "<div><div>inner</div>tail</div><p>keep<span>s</span></p>"
    tree = E.filter_tags_tree(_pages(spark, [doc]), exclude=["div"]).first().filtered_html
    assert tree == "<p>keep<span>s</span></p>"
    regex = E.filter_tags(_pages(spark, [doc]), exclude=["div"]).first().filtered_html
    assert regex != tree  # the regex form stops at the first closing tag


def test_crawl_minimal_depth_and_limit(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (3, 4), (4, 1), (5, 6)], "src long, dst long")
    seeds = spark.createDataFrame([(1,)], "node long")
    got = {r.node: r.depth for r in D.crawl(edges, seeds, max_depth=5).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 2}
    top = [(r.node, r.depth) for r in D.crawl(edges, seeds, max_depth=5, limit=3).collect()]
    assert sorted(top) == [(1, 0), (2, 1), (3, 1)]


def test_canonical_urls(spark):
    df = spark.createDataFrame([(u,) for u in ["https://www.Ex.test/a/7.html?utm_source=x#top", "http://ex.test/a/7/",
                                               "https://m.ex.test/a/7?page=2&ref=x"]], "url string")
    got = sorted(r.c for r in df.select(D.canonical_url(F.col("url")).alias("c")).collect())
    assert got == ["ex.test/a/7", "ex.test/a/7", "ex.test/a/7?page=2"]


def test_markdown_sql_mirror_is_well_formed():
    sql = H.apply_steps_sql("html", H.MARKDOWN_STEPS)
    assert sql.count("regexp_replace") + sql.count("replace(") >= len(H.MARKDOWN_STEPS)


def test_schedule_slots_follow_the_monitor_timezone(spark):
    from webledger.operators import monitor as M

    m = spark.createDataFrame([(1, 360, "America/New_York"), (2, 360, None)],
                              "monitor_id long, every_minutes int, tz string")
    got = sorted((r.monitor_id, str(r.slot_ts)) for r in
                 M.schedule_slots(m, "2024-01-01 00:00:00", "2024-01-01 12:00:00", timezone="tz").collect())
    assert got == [(1, "2024-01-01 05:00:00"), (1, "2024-01-01 11:00:00"),
                   (2, "2024-01-01 00:00:00"), (2, "2024-01-01 06:00:00")]
    # every interval is at least five minutes
    fast = spark.createDataFrame([(3, 1)], "monitor_id long, every_minutes int")
    assert M.schedule_slots(fast, "2024-01-01 00:00:00", "2024-01-01 01:00:00").count() == 12


def test_extract_json_custom_fields(spark):
    doc = '<html lang="fr"><head><title>A &amp; B</title></head><body><h1>Big <b>news</b></h1><p>x</p></body></html>'
    fields = {"title": H.TITLE_PATTERN, "heading": H.H1_PATTERN, "lang": H.LANG_PATTERN,
              "missing": r"(?is)<nope>(.*?)</nope>"}
    r = E.extract_json(_pages(spark, [doc]), fields).first()
    assert (r.title, r.heading, r.lang, r.missing) == ("A & B", "Big news", "fr", None)
    assert r.json == '{"title":"A & B","heading":"Big news","lang":"fr"}'  # absent fields omitted


def test_main_content_falls_back_to_body_without_chrome(spark):
    with_article = "<body><nav>menu</nav><article><p>core</p></article><footer>f</footer></body>"
    without = "<body><header>h</header><nav>menu</nav><p>core</p><footer>f</footer></body>"
    got = [r.main_html for r in E.main_content(_pages(spark, [with_article, without])).orderBy("page_id").collect()]
    assert got == ["<p>core</p>", "<p>core</p>"]


def test_monitor_paging_rules(spark):
    import pytest

    from webledger.operators import monitor as M

    m = spark.createDataFrame([(i, f"m{i}") for i in range(40)], "monitor_id long, name string")
    c = spark.createDataFrame([(1, 1, dt.datetime(2024, 1, 1), "same")],
                              "check_id long, monitor_id long, checked_at timestamp_ntz, outcome string")
    assert M.list_monitors(m, c, limit=0).count() == 25          # a zero limit is not sent: default 25
    assert [r.monitor_id for r in M.list_monitors(m, c, limit=5, offset=38).collect()] == [38, 39]
    with pytest.raises(ValueError):
        M.list_monitors(m, c, limit=101)


def test_crawl_status_and_results(spark):
    jobs = spark.createDataFrame([(1,), (2,), (3,)], "job_id long")
    t = dt.datetime(2024, 1, 1)
    jp = spark.createDataFrame([
        (1, 1, 10, "completed", 2, t), (1, 2, 11, "completed", 3, t + dt.timedelta(days=1)),
        (2, 1, 20, "completed", 4, t), (2, 2, 21, "pending", 9, t), (2, 3, 22, "completed", 1, t),
    ], "job_id long, page_no int, page_ref long, status string, credits long, updated_at timestamp_ntz")
    got = {r.job_id: (r.status, r.completed, r.total, r.credits_used) for r in D.crawl_status(jobs, jp).collect()}
    assert got == {1: ("completed", 2, 2, 5), 2: ("scraping", 2, 3, 5), 3: ("pending", 0, 0, 0)}
    page = D.crawl_results(jp, spark.createDataFrame([(2,)], "job_id long"), limit=1, offset=1).collect()
    assert [(r.job_id, r.page_no) for r in page] == [(2, 3)]   # completed pages only, second one


def test_path_and_scope_filters(spark):
    urls = spark.createDataFrame([("https://s.test/en/a",), ("https://s.test/en/b.html",), ("https://s.test/fr/c",)],
                                 "url string")
    kept = sorted(r.url for r in D.filter_paths(urls, include=["^/en/"], exclude=[r"\.html$"]).collect())
    assert kept == ["https://s.test/en/a"]
    links = spark.createDataFrame([("https://s.test/docs/a", "https://s.test/docs/b"),
                                   ("https://s.test/docs/a", "https://s.test/blog/c"),
                                   ("https://s.test/docs/a", "https://other.test/docs/d")], "page_url string, link string")
    got = [(r.is_external, r.is_backward, r.in_scope) for r in D.filter_scope(links).collect()]
    assert got == [(False, False, True), (False, True, False), (True, False, False)]
    got = [r.in_scope for r in D.filter_scope(links, allow_backward=True, allow_external=True).collect()]
    assert got == [True, True, True]


def test_patterns_of_each_job_as_rows(spark):
    import re

    from webledger.operators import discover as D

    urls = [(j, f"https://a.test{p}") for j in (1, 2, 3, 4) for p in ("/en/a.html", "/en/b", "/de/b", "/en", "/enx/b", "/", "", "/fr/en/b", "/en//m")]
    urls += [(1, None), (None, "https://a.test/en/b"), (1, "https://a.test/en/b")]
    patterns = [(1, "include", "^/en/"), (1, "include", "^/en/"), (1, "exclude", r"\.html$"), (2, "exclude", "^/en/|^/de/"), (2, "exclude", None),
                (3, "include", "^/en/*m?$"), (3, "include", "/b$"), (3, "exclude", "^/fr/"), (9, "include", "^/x/")]
    got = D.filter_paths_by(spark.createDataFrame(urls, "job_id long, url string"), spark.createDataFrame(patterns, "job_id long, kind string, pattern string"))

    def keep(job, url):
        path = re.sub(r"^[a-z]+://[^/?#]+", "", url or "")
        kinds = {k: [p for j, kk, p in patterns if j == job and kk == k and p is not None] for k in ("include", "exclude")}
        return (not kinds["include"] or any(re.search(p, path) for p in kinds["include"])) and not any(re.search(p, path) for p in kinds["exclude"])

    want = sorted(((j, u) for j, u in urls if keep(j, u)), key=str)
    assert sorted(((r.job_id, r.url) for r in got.collect()), key=str) == want
