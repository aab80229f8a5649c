"""Queries for search and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from webledger.operators import search as S
from webledger.plans.oracle import VIEWS, view
from webledger.plans.q_pages import _ADS, _lit, md_sql
from webledger.functions import html as H
from webledger.plans.registry import query

view("bm25", r"""
select query_id, doc_id, score, row_number() over (partition by query_id order by score desc, doc_id) as rank from (
  select qt.query_id, t.doc_id,
    round(sum(ln(1 + ((select count(*) from documents) - f.df + 0.5) / (f.df + 0.5))
          * t.tf * 2.2 / (t.tf + 1.2 * (1 - 0.75 + 0.75 * t.dl / (select avg(len(list_filter(string_split_regex(lower(text), '[^\p{L}0-9]+'), lambda x: x <> ''))) from documents)))), 6) as score
  from (select doc_id, term, count(*) as tf, any_value(dl) as dl from (
          select doc_id, unnest(toks) as term, len(toks) as dl from (
            select doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}0-9]+'), lambda x: x <> '') as toks
            from documents) a) b
        where term in (select term from qterms) group by 1, 2) t
  join (select term, count(*) as df from (
          select distinct doc_id, unnest(list_filter(string_split_regex(lower(text), '[^\p{L}0-9]+'), lambda x: x <> '')) as term
          from documents) c where term in (select term from qterms) group by 1) f on f.term = t.term
  join qterms qt on qt.term = t.term
  group by 1, 2) s
""")

view("qterms", r"""
select distinct query_id, unnest(list_distinct(list_filter(string_split_regex(lower(query), '[^\p{L}0-9]+'), lambda x: x <> ''))) as term
from search_queries
""")


def bm25(v, limit=10):
    return S.search(v.table("documents"), v.search_queries, limit=limit)


@query("q1_search", "select query_id, doc_id, score, rank from bm25 where rank <= 10")
def q1_search(v):
    return bm25(v).select("query_id", "doc_id", "score", "rank")


@query("n6_search_then_scrape", f"""
select b.query_id, b.doc_id, b.rank,
  nullif({H.apply_steps_sql(f"regexp_extract(p.html, {_lit(H.TITLE_PATTERN)}, 1)", H.TEXT_STEPS[len(H.CLEAN_STEPS):])}, '') as title,
  sha256({md_sql(_ADS)}) as markdown_sha
from bm25 b left join pages p on p.page_id = b.doc_id
where b.rank <= 10
""")
def n6_search_then_scrape(v):
    res = bm25(v).select("query_id", "doc_id", "rank")
    out = S.search_then_scrape(res, v.table("pages"), ["markdown"])
    return out.select("query_id", "doc_id", "rank", "title", F.sha2("markdown", 256).alias("markdown_sha"))


view("documents_de", "select * from documents where lang = 'de'")
view("bm25_de", VIEWS["bm25"].replace("from documents", "from documents_de"))


@query("q1_search_filtered", "select query_id, doc_id, score, rank from bm25_de where rank <= 5")
def q1_search_filtered(v):
    out = S.search_filtered(v.table("documents"), v.search_queries, limit=5, lang="de")
    return out.select("query_id", "doc_id", "score", "rank")


@query("f3_filter_time_week", """
select request_id, ts from requests
where ts > timestamp '2024-01-31 00:00:00' - interval 7 days and ts <= timestamp '2024-01-31 00:00:00'
""")
def f3_filter_time_week(v):
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return S.filter_time(v.requests, "qdr:w", as_of).select("request_id", "ts")


@query("f3_filter_time_day", """
select request_id, ts from requests
where ts > timestamp '2024-01-20 12:00:00' - interval 1 day and ts <= timestamp '2024-01-20 12:00:00'
""")
def f3_filter_time_day(v):
    as_of = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return S.filter_time(v.requests, "qdr:d", as_of).select("request_id", "ts")


@query("f4_filter_location", "select doc_id, source, n_chars from documents where lang = 'de'")
def f4_filter_location(v):
    return S.filter_location(v.table("documents"), "de").select("doc_id", "source", "n_chars")


@query("p2_parse_limits", """
select doc_id, greatest(1, ceil(n_chars / 3000.0))::bigint as n_pages,
  least(greatest(1, ceil(n_chars / 3000.0)), 5)::bigint as billed_pages,
  least(greatest(1, ceil(n_chars / 3000.0)), 5)::bigint as credits
from documents
""")
def p2_parse_limits(v):
    return S.parse_limits(v.table("documents"), 5).select("doc_id", "n_pages", "billed_pages", "credits")


def _files(v):
    """The captured text as uploaded files: documents as .txt, pages as .html."""
    docs = v.table("documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
        F.lit("txt").alias("file_type"), F.encode("text", "UTF-8").alias("content"),
    )
    pages = v.table("pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".html")).alias("file_name"),
        F.lit("html").alias("file_type"), F.encode("html", "UTF-8").alias("content"),
    )
    return docs.unionByName(pages)


@query("p1_parse_documents", f"""
select 'doc-' || doc_id || '.txt' as file_name, 'txt' as file_type, text as markdown from documents
union all
select 'page-' || page_id || '.html', 'html', {md_sql('html')} from pages
""")
def p1_parse_documents(v):
    return S.parse_documents(_files(v)).select("file_name", "file_type", "markdown")


@query("p1_parse_uploads", """
select 'doc-' || doc_id || '.txt' as file_name, 'txt' as file_type, text as markdown from documents
""")
def p1_parse_uploads(v):
    """Documents sent as base64 uploads, decoded and parsed."""
    uploads = v.table("documents").select(
        F.base64(F.encode("text", "UTF-8")).alias("file"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
    )
    return S.parse_documents(S.uploads_to_files(uploads)).select("file_name", "file_type", "markdown")
