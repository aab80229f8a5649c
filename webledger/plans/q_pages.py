"""Queries over captured pages: extraction, URL filters, discovery, crawl
(E1-E10, F1, F2, D1-D8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from webledger.functions import html as H
from webledger.operators import discover as D
from webledger.operators import extract as E
from webledger.functions.urls import host
from webledger.plans.oracle import view
from webledger.plans.registry import query

# SQL forms of the URL helpers (oracle side) ---------------------------------


def host_sql(u: str) -> str:
    return f"lower(regexp_extract({u}, '^[a-z][a-z0-9+.-]*://([^/?#]+)', 1))"


def site_sql(u: str) -> str:
    return f"regexp_replace({host_sql(u)}, '^(www|m|blog)\\.', '')"


def path_sql(u: str) -> str:
    return f"regexp_extract({u}, '^[a-z][a-z0-9+.-]*://[^/?#]+([^?#]*)', 1)"


def resolve_sql(base: str, href: str) -> str:
    base_dir = f"regexp_replace(regexp_replace({base}, '[?#].*$', ''), '/[^/]*$', '/')"
    return f"""(case
  when regexp_matches({href}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') then {href}
  when starts_with({href}, '//') then regexp_extract({base}, '^([a-z][a-z0-9+.-]*):', 1) || ':' || {href}
  when starts_with({href}, '/') then regexp_extract({base}, '^([a-z][a-z0-9+.-]*://[^/?#]+)', 1) || {href}
  when starts_with({href}, '#') then regexp_replace({base}, '#.*$', '') || {href}
  when starts_with({href}, '?') then regexp_replace({base}, '[?#].*$', '') || {href}
  else (case when regexp_matches({base_dir}, '^[a-z][a-z0-9+.-]*://[^/]+/') then {base_dir}
             else {base} || '/' end) || {href} end)"""


def md_sql(h: str) -> str:
    return H.apply_steps_sql(h, H.MARKDOWN_STEPS)


def inline_sql(h: str) -> str:
    return H.apply_steps_sql(h, H.TEXT_STEPS[len(H.CLEAN_STEPS):])


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def field_sql(h: str, pat: str) -> str:
    return f"nullif({inline_sql(f'regexp_extract({h}, {_lit(pat)}, 1)')}, '')"


_ADS = f"regexp_replace(regexp_replace(html, {_lit(H.BASE64_IMG_PATTERN)}, '', 'g'), {_lit(H.ad_pattern())}, '', 'g')"

view("page_links", f"""
select page_id, url as page_url, pos, href, {resolve_sql('url', 'href')} as link
from (select page_id, url, unnest(l) as href, generate_subscripts(l, 1) - 1 as pos
      from (select page_id, url, regexp_extract_all(html, {_lit(H.LINK_PATTERN)}, 1) as l from pages) a) b
""")


def page_links(v):
    return E.extract_links(v.table("pages"))


@query("e1_extract_distinct", f"""
select capture, page_id, sha256(html) as content_sha, sha256({md_sql('html')}) as md_sha
from (select 'v1' as capture, page_id, html from capture_v1
      union all select 'v2' as capture, page_id, html from capture_v2) c
""")
def e1_extract_distinct(v):
    caps = v.capture_v1.withColumn("capture", F.lit("v1")).unionByName(v.capture_v2.withColumn("capture", F.lit("v2")))
    out = E.extract_distinct(caps, lambda d: d.withColumn("md_sha", F.sha2(H.markdown(F.col("html")), 256)))
    return out.select("capture", "page_id", "content_sha", "md_sha")


@query("e2_extract_links", "select page_id, pos, href, link from page_links")
def e2_extract_links(v):
    return page_links(v).select("page_id", "pos", "href", "link")


@query("e3_extract_markdown", f"select page_id, {md_sql('html')} as markdown from pages")
def e3_extract_markdown(v):
    return E.extract_markdown(v.table("pages")).select("page_id", "markdown")


@query("e4_extract_html", f"""
select page_id, {H.apply_steps_sql('html', H.CLEAN_STEPS)} as clean_html, length(html) as raw_chars from pages
""")
def e4_extract_html(v):
    return E.extract_html(v.table("pages")).select("page_id", "clean_html", F.length("raw_html").cast("bigint").alias("raw_chars"))


@query("e5_extract_json", f"""
select page_id, {field_sql('html', H.TITLE_PATTERN)} as title, {field_sql('html', H.H1_PATTERN)} as heading,
  {field_sql('html', H.LANG_PATTERN)} as lang
from pages
""")
def e5_extract_json(v):
    return E.extract_json(v.table("pages")).select("page_id", "title", "heading", "lang")


@query("e6_main_content", f"""
select page_id, {md_sql("coalesce(nullif(regexp_extract(html, '(?is)<article( [^>]*)?>(.*)</article>', 2), ''), nullif(regexp_extract(html, '(?is)<main( [^>]*)?>(.*)</main>', 2), ''), regexp_replace(regexp_extract(html, '(?is)<body( [^>]*)?>(.*?)(</body>|$)', 2), " + _lit(H.tag_block_pattern(['header', 'nav', 'footer'])) + ", '', 'g'))")} as main_markdown
from pages
""")
def e6_main_content(v):
    out = E.main_content(v.table("pages"))
    return out.select("page_id", H.markdown(F.col("main_html")).alias("main_markdown"))


@query("e7_filter_tags", f"""
select page_id, regexp_replace(array_to_string(regexp_extract_all(html, {_lit(H.tag_block_pattern(['article', 'footer']))}, 1), ''),
  {_lit(H.tag_block_pattern(['h1']))}, '', 'g') as filtered_html
from pages
""")
def e7_filter_tags(v):
    out = E.filter_tags(v.table("pages"), include=["article", "footer"], exclude=["h1"])
    return out.select("page_id", "filtered_html")


@query("e7_filter_tags_tree")
def e7_filter_tags_tree(v):
    out = E.filter_tags_tree(v.table("pages"), include=["body"], exclude=["nav", "footer", "script", "style"])
    return out.select("page_id", "filtered_html")


@query("e7_filter_nested_tags", """
select page_id, regexp_replace(regexp_extract(html, '(?s)<body>.*?(?:</body>|$)'),
  '(?s)<nav>.*?</nav>|<div class="ad">.*?</div>|<footer>.*?</footer>|<script>.*?</script>|<style>.*?</style>', '', 'g') as filtered_html
from pages
""")
def e7_filter_nested_tags(v):
    """Every page gets a menu within its menu and a box around its advert; without menus and boxes all is as before them."""
    boxed = F.replace(F.col("html"), F.lit("<nav>"), F.lit("<nav><NAV class='a > b'>top</NAV><!-- </nav> -->"))
    boxed = F.replace(boxed, F.lit("</div>"), F.lit("</div>ends here</div>"))
    boxed = F.replace(boxed, F.lit('<div class="ad">'), F.lit('<div>sponsored<div class="ad">'))
    out = E.filter_nested_tags(v.table("pages").withColumn("html", boxed), include=["body"], exclude=["nav", "div", "footer", "script", "style"])
    return out.select("page_id", "filtered_html")


@query("e8_strip_base64_images", "select page_id, sha256(html) as html_sha, page_id % 3 = 0 as had_image from pages")
def e8_strip_base64_images(v):
    """Inline images put into every third page come out again, and nothing else does."""
    image = F.lit('<img src="data:image/png;base64,iVBORw0KGgo=" alt="x">')
    had = F.col("page_id") % 3 == 0
    with_images = v.table("pages").withColumn("had_image", had).withColumn(
        "html", F.when(had, F.concat(F.replace(F.col("html"), F.lit("<h1>"), F.concat(image, F.lit("<h1>"))), image)).otherwise(F.col("html")))
    return E.strip_base64_images(with_images).select("page_id", F.sha2("html", 256).alias("html_sha"), "had_image")


@query("e9_block_ads", f"""
select page_id, regexp_replace(html, {_lit(H.ad_pattern())}, '', 'g') as html from pages
""")
def e9_block_ads(v):
    return E.block_ads(v.table("pages")).select("page_id", "html")


@query("e10_scrape", f"""
select r.request_id, r.format,
  case when r.format = 'markdown' then {md_sql(_ADS)} end as markdown,
  case when r.format = 'json' then json_object('title', {field_sql(_ADS, H.TITLE_PATTERN)},
       'heading', {field_sql(_ADS, H.H1_PATTERN)}, 'lang', {field_sql(_ADS, H.LANG_PATTERN)})::varchar end as json
from requests r join pages p on p.page_id = r.page_id
where r.tool = 'scrape'
""")
def e10_scrape(v):
    reqs = v.requests.where(F.col("tool") == "scrape").select("request_id", "page_id", "format")
    wanted = reqs.select("page_id", "format").distinct()
    pages = v.table("pages").join(wanted, "page_id")
    # Extract once per distinct (page, format); the exchange keeps codegen
    # from re-running the extraction for every matching request.
    out = E.scrape(pages, F.array("format")).select("page_id", "format", "markdown", "json")
    out = out.repartition("page_id", "format")
    return reqs.join(out, ["page_id", "format"]).select(
        "request_id", "format", "markdown", "json"
    )


@query("e10_scrape_formats", f"""
select page_id, sha256(html) as raw_sha, sha256({H.apply_steps_sql(_ADS, H.CLEAN_STEPS)}) as html_sha,
  coalesce(n, 0) as n_links, first_link
from pages left join (
  select page_id as pid, count(*) as n, min(case when pos = 0 then link end) as first_link from page_links group by 1) l
  on l.pid = page_id
""")
def e10_scrape_formats(v):
    """The other text formats of every page, asked for together: as captured, cleaned, and its links."""
    out = E.scrape(v.table("pages"), F.array(F.lit("rawHtml"), F.lit("html"), F.lit("links")))
    return out.select(
        "page_id", F.sha2("raw_html", 256).alias("raw_sha"), F.sha2("html_out", 256).alias("html_sha"),
        F.size("links").cast("bigint").alias("n_links"), F.get("links", F.lit(0)).alias("first_link"),
    )


@query("f1_filter_paths", f"""
select page_id, url from pages
where (regexp_matches({path_sql('url')}, '(^/en/)|(^/de/)')) and not regexp_matches({path_sql('url')}, '(\\.html$)')
""")
def f1_filter_paths(v):
    return D.filter_paths(v.table("pages"), include=["^/en/", "^/de/"], exclude=[r"\.html$"]).select("page_id", "url")


#: Patterns of five crawl jobs: anchored, free, with an alternative, of both kinds, and none at all.
_JOB_PATTERNS = [
    (0, "include", "^/en/"), (0, "exclude", r"\.html$"), (1, "include", "^/de/"), (1, "include", "^/[a-d]"), (2, "exclude", "^/en/.*[0-9]"),
    (3, "include", "^/en/|^/fr/"), (3, "exclude", "^/en/*[m-z]"),
]


@query("f1_filter_paths_by_job", f"""
select page_id % 5 as job_id, page_id, url from (select page_id, url, {path_sql('url')} as p from pages) x
where case page_id % 5
  when 0 then regexp_matches(p, '^/en/') and not regexp_matches(p, '\\.html$')
  when 1 then regexp_matches(p, '^/de/') or regexp_matches(p, '^/[a-d]')
  when 2 then not regexp_matches(p, '^/en/.*[0-9]')
  when 3 then regexp_matches(p, '^/en/|^/fr/') and not regexp_matches(p, '^/en/*[m-z]')
  else true end
""")
def f1_filter_paths_by_job(v):
    """Patterns as a table, one set for each crawl job."""
    urls = v.table("pages").select((F.col("page_id") % 5).alias("job_id"), "page_id", "url")
    patterns = v.spark.createDataFrame(_JOB_PATTERNS, "job_id long, kind string, pattern string")
    return D.filter_paths_by(urls, patterns)


@query("f2_filter_scope", f"""
select page_id, pos, link, is_external, is_backward, not is_external and not is_backward as in_scope
from (select page_id, pos, link, {host_sql('link')} <> {host_sql('page_url')} as is_external,
        not starts_with({path_sql('link')}, regexp_replace({path_sql('page_url')}, '[^/]*$', '')) as is_backward
      from page_links) x
""")
def f2_filter_scope(v):
    return D.filter_scope(page_links(v)).select("page_id", "pos", "link", "is_external", "is_backward", "in_scope")


def _all_urls(v):
    return v.table("pages").select("url").unionByName(page_links(v).select(F.col("link").alias("url")))


@query("d1_map_urls", f"""
select distinct url, {site_sql('url')} as site from (select url from pages union all select link from page_links) u
""")
def d1_map_urls(v):
    return D.map_urls(_all_urls(v))


@query("d1_map_urls_filtered", f"""
select url, site from (
  select url, site, row_number() over (partition by site order by url) as rn from (
    select distinct url, {site_sql('url')} as site from (select url from pages union all select link from page_links) u) a
  where ({host_sql('url')} = site or {host_sql('url')} = 'www.' || site) and contains(lower(url), 'en')) b
where rn <= 3
""")
def d1_map_urls_filtered(v):
    return D.map_urls(_all_urls(v), search="en", include_subdomains=False, limit=3)


@query("d2_url_sources", """
select url, array_to_string(list_sort(list(distinct source)), ',') as sources
from (select url, 'sitemap' as source from pages union all select link, 'link' from page_links) u
group by url
""")
def d2_url_sources(v):
    return D.url_sources(v.table("pages"), page_links(v))


@query("d2_url_sources_sitemap_only", "select url, 'sitemap' as sources from pages group by url")
def d2_url_sources_sitemap_only(v):
    return D.url_sources(v.table("pages"), page_links(v), sitemap_only=True)


def _crawl_seeds(v):
    # Seeds: every captured page on a blog host (many seeds in one run).
    pages = v.table("pages")
    return pages.where(F.regexp_extract("url", r"^[a-z][a-z0-9+.-]*://([^/?#]+)", 1).startswith("blog.")).select(
        F.col("page_id").alias("node")
    )


_CRAWL_SQL = """
with recursive walk(node, depth) as (
  select page_id, 0 from pages where starts_with(regexp_extract(url, '^[a-z][a-z0-9+.-]*://([^/?#]+)', 1), 'blog.')
  union all
  select e.dst, w.depth + 1 from walk w join link_edges e on e.src = w.node where w.depth < 3
)
"""


@query("d3_crawl", _CRAWL_SQL + "select node as page_id, min(depth) as depth from walk group by node")
def d3_crawl(v):
    out = D.crawl(v.link_edges, _crawl_seeds(v), max_depth=3)
    return out.select(F.col("node").alias("page_id"), "depth")


@query("d3_crawl_limit", _CRAWL_SQL + """
select node as page_id, min(depth) as depth from walk group by node order by depth, page_id limit 20
""")
def d3_crawl_limit(v):
    out = D.crawl(v.link_edges, _crawl_seeds(v), max_depth=3, limit=20)
    return out.select(F.col("node").alias("page_id"), "depth")


@query("d3_crawl_unbounded", """
with recursive walk(node, depth) as (
  select page_id, 0 from pages where page_id = 0
  union all
  select e.dst, w.depth + 1 from walk w join link_edges e on e.src = w.node)
select node as page_id, min(depth) as depth from walk group by node
""")
def d3_crawl_unbounded(v):
    """From the first page until nothing new is reached."""
    seeds = v.table("pages").where("page_id = 0").select(F.col("page_id").alias("node"))
    return D.crawl(v.link_edges, seeds).select(F.col("node").alias("page_id"), "depth")


_CANON_SQL = r"""
regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(lower(regexp_extract(ns, '^([^/?]*)', 1)), '^(www|m)\.', '') || regexp_replace(ns, '^[^/?]*', ''),
  '([?&])(utm_[A-Za-z0-9_]*|ref|fbclid|gclid)=[^&]*', '\1', 'g'), '&&+', '&', 'g'), '\?&', '?', 'g'),
  '[?&]+$', '', 'g'), '\.html?(\?|$)', '\1', 'g'), '/+(\?|$)', '\1', 'g')
"""


def _canon_of(u):
    ns = f"regexp_replace(regexp_replace({u}, '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '')"
    return "(" + _CANON_SQL.replace("(ns,", f"({ns},") + ")"


_SCOPED_SQL = f"""
with recursive scoped as (
  select page_url as src, link as dst from page_links
  where {host_sql('link')} = {host_sql('page_url')} and regexp_matches({path_sql('link')}, '^/(en|de|fr|es|[A-Za-z])')
    and not regexp_matches({path_sql('link')}, '(\\.html$)')
  union
  select r.root, p.url from pages p join (select {host_sql('url')} as h, min(url) as root from pages group by 1) r
    on r.h = {host_sql('p.url')}
  where regexp_matches({path_sql('p.url')}, '^/(en|de|fr|es|[A-Za-z])') and not regexp_matches({path_sql('p.url')}, '(\\.html$)')),
named as (select c, min(url) as name from (
  select url, {_canon_of('url')} as c from (select url from pages union select dst from scoped) u) x group by 1),
edge as (
  select distinct s.name as src, d.name as dst from (
    select {_canon_of('src')} as cs, {_canon_of('dst')} as cd from scoped) x
  join named s on s.c = x.cs join named d on d.c = x.cd where s.name <> d.name),
walk(node, depth) as (
  select distinct n.name, 0 from (select min(url) as url from pages group by {host_sql('url')}) r join named n on n.c = {_canon_of('r.url')}
  union
  select e.dst, w.depth + 1 from walk w join edge e on e.src = w.node where w.depth < 2)
select node as url, min(depth) as depth from walk group by node
"""


@query("d3_crawl_scope", _SCOPED_SQL)
def d3_crawl_scope(v):
    """Each host from its smallest URL: two hops over its sitemap and links,
    inside the host, by path patterns, similar URLs as one."""
    pages = v.table("pages")
    links = page_links(v).select("page_url", "link")
    _, edges = D.scoped_links(pages, links, ["^/(en|de|fr|es|[A-Za-z])"], [r"\.html$"], allow_backward=True, dedupe_similar=True)
    named = D.dedupe_similar_urls(pages.select("url").unionByName(edges.select(F.col("dst").alias("url"))))
    roots = pages.groupBy(host(F.col("url")).alias("h")).agg(F.min("url").alias("url"))
    seeds = roots.withColumn("canonical", D.canonical_url(F.col("url"))).join(
        named.select("canonical", F.col("url").alias("node")), "canonical").select("node")
    return D.crawl(edges, seeds, max_depth=2).select(F.col("node").alias("url"), "depth")


@query("d4_crawl_scrape", _CRAWL_SQL + f"""
select w.page_id, w.depth, {md_sql('p.html')} as markdown
from (select node as page_id, min(depth) as depth from walk group by node) w join pages p on p.page_id = w.page_id
""")
def d4_crawl_scrape(v):
    crawled = D.crawl(v.link_edges, _crawl_seeds(v), max_depth=3).withColumnRenamed("node", "page_id")
    pages = v.table("pages").join(crawled, "page_id")
    out = E.extract_distinct(pages, E.extract_markdown)
    return out.select("page_id", "depth", "markdown")


@query("d5_dedupe_similar_urls", f"""
select canonical, min(url) as url, count(distinct url) as n_variants from (
  select url, {_CANON_SQL} as canonical
  from (select url, regexp_replace(regexp_replace(url, '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') as ns
        from (select url from pages union all select link from page_links) u) a) b
group by canonical
""")
def d5_dedupe_similar_urls(v):
    return D.dedupe_similar_urls(_all_urls(v))


@query("d6_crawl_status", """
select j.job_id,
  case when coalesce(p.total, 0) = 0 then 'pending' when p.completed = p.total then 'completed' else 'scraping' end as status,
  coalesce(p.completed, 0) as completed, coalesce(p.total, 0) as total,
  coalesce(p.credits_used, 0)::bigint as credits_used, p.last_update
from jobs j left join (
  select job_id, count(*) as total, count(*) filter (where status = 'completed') as completed,
    sum(case when status = 'completed' then credits end) as credits_used, max(updated_at) as last_update
  from job_pages group by 1) p on p.job_id = j.job_id
""")
def d6_crawl_status(v):
    return D.crawl_status(v.jobs, v.job_pages)


@query("d7_crawl_results", """
select job_id, page_no, page_ref, status, credits, updated_at from (
  select *, row_number() over (partition by job_id order by page_no, page_ref) as rn
  from job_pages where status = 'completed' and job_id in (select job_id from jobs where priority = '1-URGENT')) x
where rn > 2 and rn <= 7
""")
def d7_crawl_results(v):
    ids = v.jobs.where(F.col("priority") == "1-URGENT").select("job_id")
    return D.crawl_results(v.job_pages, ids, limit=5, offset=2)


@query("d8_select_pages", f"""
select url, site, rank from (
  select url, {site_sql('url')} as site,
    row_number() over (partition by {site_sql('url')} order by contains(url, '/en/')::int desc, length(url), url) as rank
  from pages) x
where rank <= 3
""")
def d8_select_pages(v):
    return D.select_pages(v.table("pages").select("url"), "/en/", 3).select("url", "site", "rank")


@query("f2_filter_scope_allow_backward", f"""
select page_id, pos, link, {host_sql('link')} <> {host_sql('page_url')} as is_external,
  not starts_with({path_sql('link')}, regexp_replace({path_sql('page_url')}, '[^/]*$', '')) as is_backward,
  {host_sql('link')} = {host_sql('page_url')} as in_scope
from page_links
""")
def f2_filter_scope_allow_backward(v):
    out = D.filter_scope(page_links(v), allow_backward=True)
    return out.select("page_id", "pos", "link", "is_external", "is_backward", "in_scope")


@query("d2_url_sources_ignore_sitemap", "select link as url, 'link' as sources from page_links group by link")
def d2_url_sources_ignore_sitemap(v):
    return D.url_sources(v.table("pages"), page_links(v), ignore_sitemap=True)
