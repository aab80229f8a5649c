"""DuckDB oracle texts.

``VIEWS`` holds the fixture views (FIXTURES.md part B, plus ours) as SQL,
``ORACLE`` one statement per registered query.  ``with_views`` prefixes a
statement with the CTEs it needs, dependencies first.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql.strip()


def _deps(sql: str, seen: list[str]) -> None:
    for name in VIEWS:
        if name in seen:
            continue
        if re.search(rf"\b{name}\b", sql):
            _deps(VIEWS[name], seen)
            if name not in seen:
                seen.append(name)


def with_views(body: str) -> str:
    """Prefix ``body`` with every fixture CTE it mentions (transitively)."""
    body = body.strip()
    seen: list[str] = []
    _deps(body, seen)
    if not seen:
        return body
    ctes = ",\n".join(f"{n} as (\n{VIEWS[n]}\n)" for n in seen)
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


def oracle(name: str, body: str) -> None:
    ORACLE[name] = with_views(body)


# Fixture views (shared definitions) -----------------------------------------

view("requests", """
select event_id as request_id, ts, user_id as account_id,
  case event_type when 'view' then 'scrape' when 'click' then 'map' when 'purchase' then 'crawl'
       when 'signup' then 'search' else 'interact' end as tool,
  cast(floor(value) as int) + 1 as n,
  (event_id * 7919 + cast(regexp_extract(props, '([0-9]+)', 1) as int)) % (select count(*) from pages) as page_id,
  case cast(event_id % 4 as int) when 0 then 'json' when 1 then 'screenshot' else 'markdown' end as format,
  event_id % 3 = 0 as with_scrape,
  user_id % (select count(*) from supplier) as key_id,
  case when event_id % 13 = 0 then 429 when event_id % 97 = 0 then 500 when event_id % 17 = 5 then 201
       when event_id % 17 = 9 then 204 else 200 end as http_status,
  case when event_id % 26 = 0 then 'Monthly usage limit reached' when event_id % 13 = 0 then 'rate limited'
       when event_id % 17 = 9 then '' when event_id % 19 = 7 then '{"ok":true,"ok":false}'
       when event_id % 97 = 0 then null else '{"ok":true}' end as body
from events
""")

view("keys", """
select s_suppkey as key_id, s_nationkey as account_id, s_name as name,
  concat('wk-', repeat(cast(s_suppkey % 10 as string), 6), '-', cast(s_suppkey + 100000 as string)) as key_text,
  cast(s_suppkey % 5 + 1 as int) as priority,
  case when s_suppkey % 7 = 0 then null else cast(5000 as bigint) end as monthly_quota,
  case when s_suppkey % 9 = 0 then null else cast(floor(s_acctbal) as bigint) end as remaining_credits,
  cast(s_suppkey * 137 % 6000 as bigint) as used_credits,
  case when s_suppkey % 4 = 0 then '' else concat('2024-01-', cast(10 + s_suppkey % 20 as string), 'T00:00:00.000Z') end as last_checked,
  s_suppkey % 11 = 0 as disabled
from supplier
""")

view("accounts", """
select c_custkey as account_id, c_nationkey as nation_id, c_mktsegment as plan,
  cast(floor(c_acctbal) as bigint) as monthly_budget
from customer
""")

view("jobs", """
select o_orderkey as job_id, o_custkey as account_id, o_orderdate as started_at, o_orderpriority as priority
from orders
""")

view("job_pages", """
select l_orderkey as job_id, l_linenumber as page_no, l_partkey as page_ref,
  case l_linestatus when 'F' then 'completed' else 'pending' end as status,
  cast(l_quantity as bigint) as credits, l_shipdate as updated_at
from lineitem
""")

view("capture_v1", "select page_id, url, html from pages where page_id % 10 <> 9")

view("capture_v2", """
select page_id, url,
  case when page_id % 5 = 1 then replace(html, '<h1>', '<h1>Updated ') else html end as html
from pages where page_id % 10 <> 0
""")

view("link_edges", """
select a.page_id as src, b.page_id as dst
from pages b join pages a on a.page_id = cast(floor((b.page_id - 1) / 2.0) as bigint)
where b.page_id >= 1
""")

view("goals", """
select n_nationkey * 10 + t.i as goal_id, concat(t.txt, ' ', n_name) as goal
from nation cross join (values (0, 'List all URLs of'), (1, 'Find reviews about'), (2, 'Watch prices in'),
  (3, 'Upload the PDF for'), (4, 'Extract from this page'), (5, 'Get blog posts from'),
  (6, 'monitor and find news on'), (7, 'all pages to watch in')) as t(i, txt)
""")

view("intents", """
select cast(goal_id as bigint) as goal_id, goal, 'template' as source from goals
union all
select cast(1000000 + conv_id * 1000 + turn as bigint), text, 'conversation' from conversations where role = 'user'
""")

view("monitors", """
select c_custkey as monitor_id, concat('m-', c_name) as name, c_mktsegment as goal_topic,
  cast(30 + 30 * (c_custkey % 4) as int) as every_minutes,
  case cast(c_custkey % 3 as int) when 0 then 'scrape' when 1 then 'crawl' else 'search' end as target_type,
  cast(1 + c_custkey % 365 as int) as retention_days
from customer
""")

view("search_queries", """
select item_id as query_id, lower(text) as query from benchmark
""")

view("checks", """
select o_orderkey as check_id, o_custkey as monitor_id, o_orderdate as checked_at,
  case o_orderstatus when 'F' then 'same' when 'O' then 'changed' else 'new' end as outcome
from orders
""")

view("attempts", """
select request_id, 1 as attempt, key_id, http_status, body, ts from requests
union all
select request_id, 2 as attempt, (key_id + 1) % (select count(*) from supplier) as key_id,
  case when request_id % 3 = 0 then 500 else 200 end as http_status,
  case when request_id % 3 = 0 then 'server error' else '{"ok":true}' end as body, ts
from requests where http_status = 429
""")

view("key_feed", """
select concat('wk-', repeat(cast(s_suppkey % 10 as string), 6), '-',
    cast(s_suppkey + 100000 + case when s_suppkey % 6 = 0 then 50000 else 0 end as string)) as key_text,
  case when s_suppkey % 8 = 3 then null else cast(floor(s_acctbal) + 1000 as bigint) end as remaining_credits,
  case when s_suppkey % 5 = 2 then null when s_suppkey % 5 = 4 then cast(0 as bigint) else cast(6000 as bigint) end as plan_credits,
  case when s_suppkey % 10 = 7 then 'HTTP 401' else null end as error
from supplier
""")

view("key_candidates", """
select c_custkey as candidate_id, c_nationkey as account_id,
  concat('wk-', repeat(cast(c_custkey % 10 as string), 6), '-', cast(c_custkey % 400 + 100000 as string)) as key_text,
  case when c_custkey % 3 = 0 then null else cast(floor(abs(c_acctbal)) as bigint) end as plan_credits,
  case when c_custkey % 5 = 0 then null else cast(floor(abs(c_acctbal)) as bigint) // 2 end as remaining_credits,
  case when c_custkey % 11 = 4 then 'HTTP 401' else null end as quota_error
from customer
""")

view("key_removals", """
select c_nationkey as account_id, concat('Supplier#', lpad(cast(c_custkey % 200 as string), 9, '0')) as name
from customer
""")

# C1 priced requests, written out independently of the Spark expression tree.
view("priced", """
select r.*,
  cast(case tool
    when 'scrape' then 1 + case when format = 'json' then 4 else 0 end + case when format = 'screenshot' then 1 else 0 end
    when 'crawl' then n
    when 'search' then cast(ceil(n / 10.0) as bigint) * 2 + case when with_scrape then n else 0 end
    when 'map' then 1
    when 'interact' then cast(ceil(n / 60.0) as bigint) * 2
    else 1 end as bigint) as estimated_credits
from requests r
""")
