"""URL filters, discovery and crawl over captured link graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webledger.functions.urls import host, path, site_of
from webledger.session import append_bucketed, bucketed_table, cut_lineage, drop_bucketed, reread


def _any(patterns: list[str]) -> str:
    return "|".join(f"({p})" for p in patterns)


def filter_paths(urls: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None,
                 url: str = "url") -> DataFrame:
    """keep URLs whose path matches any include pattern and no exclude
    pattern (regexes, tested on the path)."""
    p = path(F.col(url))
    cond = F.lit(True)
    if include:
        cond = cond & p.rlike(_any(include))
    if exclude:
        cond = cond & ~p.rlike(_any(exclude))
    return urls.where(cond)


#: The first directory of a path, and of what an anchored pattern can match.
FIRST_DIR = r"^(/[A-Za-z0-9_-]+/)"
PATTERN_DIR = r"^\^(/[A-Za-z0-9_-]+/)(?![*?+{])"


def filter_paths_by(urls: DataFrame, patterns: DataFrame, by: str = "job_id", url: str = "url") -> DataFrame:
    """F1 with patterns as rows (``by``, kind ``include`` or ``exclude``,
    pattern): of each job's URLs, those whose path matches any of the job's
    include patterns, if it has some, and none of its exclude patterns.

    A pattern that is anchored to a directory, like ``^/en/``, meets only the
    paths under it: both are joined by job and first directory, and the
    pattern is tested on what they share.  Any other pattern meets all paths
    of its job.  A job without patterns keeps all; a null pattern is none; a
    URL without a path has the empty one.
    """
    known = patterns.where("pattern is not null").select(F.col(by).alias("_job"), "kind", "pattern").distinct()
    anchored = F.when(~F.col("pattern").contains("|"), F.regexp_extract("pattern", PATTERN_DIR, 1))
    keyed = known.withColumn("_dir", F.coalesce(anchored, F.lit("")))
    asks = known.where("kind = 'include'").select("_job").distinct().withColumn("_asks", F.lit(True))

    p = path(F.coalesce(F.col(url), F.lit("")))
    each = urls.select(F.col(by).alias("_of"), F.col(url).alias("_url"), p.alias("_path")).distinct()
    dirs = F.array_distinct(F.array(F.lit(""), F.regexp_extract("_path", FIRST_DIR, 1)))
    met = each.withColumn("_key", F.explode(dirs)).join(keyed, (F.col("_of") == F.col("_job")) & (F.col("_key") == F.col("_dir")))
    hits = met.where(F.expr("rlike(_path, pattern)")).groupBy("_of", "_url").agg(
        F.bool_or(F.col("kind") == "include").alias("_in"), F.bool_or(F.col("kind") == "exclude").alias("_out"))
    out = urls.join(hits, (F.col(by) == F.col("_of")) & F.col(url).eqNullSafe(F.col("_url")), "left").join(asks, F.col(by) == F.col("_job"), "left")
    keep = (F.col("_asks").isNull() | F.coalesce("_in", F.lit(False))) & ~F.coalesce("_out", F.lit(False))
    return out.where(keep).select(*urls.columns)


def filter_scope(links: DataFrame, seed: str = "page_url", link: str = "link", allow_backward: bool = False,
                 allow_external: bool = False) -> DataFrame:
    """a link is external when its host differs from the seed's, and
    backward when its path leaves the seed's directory."""
    seed_dir = F.regexp_replace(path(F.col(seed)), r"[^/]*$", "")
    external = host(F.col(link)) != host(F.col(seed))
    backward = ~path(F.col(link)).startswith(seed_dir)
    out = links.withColumns({"is_external": external, "is_backward": backward})
    keep = F.lit(True)
    if not allow_external:
        keep = keep & ~F.col("is_external")
    if not allow_backward:
        keep = keep & ~F.col("is_backward")
    return out.withColumn("in_scope", keep)


def map_urls(urls: DataFrame, search: str | None = None, include_subdomains: bool = True,
             limit: int | None = None, url: str = "url") -> DataFrame:
    """Distinct URLs per site, optional term filter and subdomain switch,
    at most ``limit`` per site in URL order.  The per-site limit plans as a
    window group limit, applied before the shuffle."""
    u = urls.select(F.col(url).alias("url")).distinct().withColumn("site", site_of(F.col("url")))
    if not include_subdomains:
        h = host(F.col("url"))
        u = u.where((h == F.col("site")) | (h == F.concat(F.lit("www."), F.col("site"))))
    if search:
        u = u.where(F.lower(F.col("url")).contains(search.lower()))
    if limit is not None:
        u = u.withColumn("_rn", F.row_number().over(Window.partitionBy("site").orderBy("url"))).where(
            F.col("_rn") <= limit
        ).drop("_rn")
    return u


def url_sources(captured: DataFrame, linked: DataFrame, ignore_sitemap: bool = False,
                sitemap_only: bool = False) -> DataFrame:
    """Tag URLs by where they were found - ``sitemap`` (captured) or
    ``link`` (anchors) - and choose sources."""
    parts = []
    if not ignore_sitemap:
        parts.append(captured.select(F.col("url"), F.lit("sitemap").alias("source")))
    if not sitemap_only:
        parts.append(linked.select(F.col("link").alias("url"), F.lit("link").alias("source")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("url").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


#: Out-degree from which a node's edges are dealt over several tasks, and the edges of one such piece, about.
HUB_EDGES = 100_000


def split_adjacency(edges: DataFrame, buckets: int, hub_edges: int = HUB_EDGES) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Edges (node, dst) as tables to hop over: those of ordinary nodes,
    bucketed by node; the hubs (node, pieces), nodes of more than
    ``hub_edges`` edges; the hubs' edges, dealt over their pieces and bucketed
    by (node, piece).  The last two are None where there is no hub."""
    degrees = edges.groupBy("node").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hub_edges)
    hubs = cut_lineage(degrees.select("node", F.ceil(F.col("_n") / hub_edges).cast("long").alias("pieces")))
    if hubs.isEmpty():
        return bucketed_table(edges, "node", buckets, "edges"), None, None
    plain = bucketed_table(edges.join(hubs, "node", "left_anti"), "node", buckets, "edges")
    piece = F.pmod(F.xxhash64("dst"), F.col("pieces")).alias("piece")
    return plain, hubs, bucketed_table(edges.join(hubs, "node").select("node", piece, "dst"), ["node", "piece"], buckets, "hub_edges")


def hop(last: DataFrame, plain: DataFrame, hubs: DataFrame | None, hub_edges: DataFrame | None) -> DataFrame:
    """Distinct nodes (node) that edges of the nodes ``last`` lead to.  Only
    hubs are copied, once for each piece of their edges; no edge is moved."""
    reached = last.join(plain, "node").select(F.col("dst").alias("node"))
    if hubs is not None:
        copies = last.join(hubs, "node").select("node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"))
        reached = reached.unionByName(copies.join(hub_edges, ["node", "piece"]).select(F.col("dst").alias("node")))
    return reached.distinct()


def crawl(edges: DataFrame, seeds: DataFrame, max_depth: int | None = None, limit: int | None = None,
          buckets: int | None = None, hub_edges: int = HUB_EDGES) -> DataFrame:
    """D3: breadth-first reach from many seeds at once with minimum depth,
    ``max_depth`` hops or until nothing new is reached.

    Edges are written once as a table bucketed by source (those of hubs, by
    source and piece, see ``split_adjacency``), and so are the nodes reached so
    far, which a hop appends to; all lie in the shared checkpoint folder.  A
    hop joins the last layer with the edges and leaves out what the
    table of reached nodes has; the only shuffle of a hop is the reached
    nodes' ``distinct``.  Only a layer's size reaches the driver.  ``limit`` is
    applied by (depth, node), so the result does not depend on partitioning,
    and the crawl ends after the hop that reaches it.
    """
    spark = edges.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    adjacency = split_adjacency(edges.select(F.col("src").alias("node"), F.col("dst")), n, hub_edges)
    visited = seeds.select(F.col("node")).distinct().withColumn("depth", F.lit(0))
    visited = bucketed_table(visited, "node", n, "visited")
    depth, total = 0, visited.count()
    while (max_depth is None or depth < max_depth) and (limit is None or total < limit):
        last = visited.where(F.col("depth") == depth).select("node")
        fresh = cut_lineage(hop(last, *adjacency).join(visited.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth + 1)))
        new = fresh.count()
        if not new:
            break
        append_bucketed(fresh, visited, "node", n)
        visited = reread(visited)
        depth, total = depth + 1, total + new
    for table in (adjacency[0], adjacency[2]):
        drop_bucketed(table)
    if limit is not None:
        visited = visited.orderBy("depth", "node").limit(limit)
    return visited


def scoped_links(pages: DataFrame, links: DataFrame, include_paths: list[str] | None = None,
                 exclude_paths: list[str] | None = None, allow_backward: bool = False, allow_external: bool = False,
                 dedupe_similar: bool = False, ignore_sitemap: bool = False) -> tuple[DataFrame, DataFrame]:
    """The crawl's options over captured pages (page_id, url) and their
    anchors (page_url, link): nodes and edges to crawl, by URL.

    Paths, backward and external links are decided for each link; with
    ``dedupe_similar`` URLs of one canonical form are one node, named by its
    smallest URL; unless ``ignore_sitemap``, the sitemap (the captured pages
    of a host) is linked from each of the host's pages that stands at its
    root, or from its smallest URL."""
    scoped = filter_scope(links, "page_url", "link", allow_backward, allow_external).where("in_scope")
    scoped = filter_paths(scoped, include_paths, exclude_paths, url="link").select(
        F.col("page_url").alias("src"), F.col("link").alias("dst")
    )
    nodes = filter_paths(pages.select("url"), include_paths, exclude_paths).distinct()
    if not ignore_sitemap:
        roots = pages.groupBy(host(F.col("url")).alias("h")).agg(F.min("url").alias("root"))
        site = nodes.withColumn("h", host(F.col("url"))).join(roots, "h").select(F.col("root").alias("src"), F.col("url").alias("dst"))
        scoped = scoped.unionByName(site)
    if dedupe_similar:
        every = pages.select("url").unionByName(scoped.select(F.col("dst").alias("url"))).distinct()
        named = dedupe_similar_urls(every).select("canonical", F.col("url").alias("name"))
        scoped = (
            scoped.withColumn("cs", canonical_url(F.col("src"))).withColumn("cd", canonical_url(F.col("dst")))
            .join(named.toDF("cs", "s"), "cs").join(named.toDF("cd", "d"), "cd")
            .select(F.col("s").alias("src"), F.col("d").alias("dst"))
        )
        nodes = nodes.withColumn("canonical", canonical_url(F.col("url"))).join(named, "canonical").select(F.col("name").alias("url")).distinct()
    return nodes, scoped.where("src <> dst").distinct()


def canonical_url(url: Column) -> Column:
    """D5 canonical form: no fragment or scheme, no ``www.``/``m.``, no
    tracking parameters, no ``.html`` and no trailing slash."""
    no_scheme = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host_part = F.lower(F.regexp_extract(no_scheme, r"^([^/?]*)", 1))
    rest = F.regexp_replace(no_scheme, r"^[^/?]*", "")
    c = F.concat(F.regexp_replace(host_part, r"^(www|m)\.", ""), rest)
    c = F.regexp_replace(c, r"([?&])(utm_[A-Za-z0-9_]*|ref|fbclid|gclid)=[^&]*", "$1")
    c = F.regexp_replace(c, r"&&+", "&")
    c = F.regexp_replace(c, r"\?&", "?")
    c = F.regexp_replace(c, r"[?&]+$", "")
    c = F.regexp_replace(c, r"\.html?(\?|$)", "$1")
    c = F.regexp_replace(c, r"/+(\?|$)", "$1")
    return c


def dedupe_similar_urls(urls: DataFrame, url: str = "url") -> DataFrame:
    """One URL (the smallest) per canonical form, and how many different URLs have it."""
    return urls.groupBy(canonical_url(F.col(url)).alias("canonical")).agg(
        F.min(url).alias("url"), F.count_distinct(url).alias("n_variants")
    )


def crawl_status(jobs: DataFrame, job_pages: DataFrame) -> DataFrame:
    """Per job - status, completed, total, credits used, newest update.
    Pages are aggregated before the join (one row per job crosses it)."""
    per = job_pages.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "completed").alias("completed"),
        F.sum(F.when(F.col("status") == "completed", F.col("credits"))).alias("credits_used"),
        F.max("updated_at").alias("last_update"),
    )
    j = jobs.select("job_id").join(per, "job_id", "left")
    total = F.coalesce(F.col("total"), F.lit(0))
    done = F.coalesce(F.col("completed"), F.lit(0))
    status = F.when(total == 0, "pending").when(done == total, "completed").otherwise("scraping")
    return j.select(
        "job_id", status.alias("status"), done.alias("completed"), total.alias("total"),
        F.coalesce(F.col("credits_used"), F.lit(0)).cast("bigint").alias("credits_used"), "last_update",
    )


def crawl_results(job_pages: DataFrame, job_ids: DataFrame, limit: int = 25, offset: int = 0) -> DataFrame:
    """Completed pages of the chosen jobs in page order, one page of
    ``limit`` rows after ``offset`` per job (a per-job window group limit)."""
    done = job_pages.where(F.col("status") == "completed").join(job_ids, "job_id", "left_semi")
    rn = F.row_number().over(Window.partitionBy("job_id").orderBy("page_no", "page_ref"))
    return done.withColumn("_rn", rn).where((F.col("_rn") > offset) & (F.col("_rn") <= offset + limit)).drop("_rn")


def select_pages(urls: DataFrame, search: str, k: int, url: str = "url") -> DataFrame:
    """Map, then scrape only the k best URLs per site: term matches
    first, then shorter, then alphabetical."""
    u = urls.withColumn("site", site_of(F.col(url)))
    score = F.col(url).contains(search).cast("int")
    w = Window.partitionBy("site").orderBy(score.desc(), F.length(url), F.col(url))
    return u.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
