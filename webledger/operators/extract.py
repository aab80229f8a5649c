"""Page extraction over captured pages.

Every extractor is a native column expression.  ``extract_distinct`` runs
an extractor once per distinct content (SHA-256, so identical pages under a
billion URLs are parsed once) and joins the result back to every row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webledger.functions import html as H
from webledger.functions.urls import resolve

FORMATS = ["markdown", "html", "rawHtml", "links", "json", "screenshot"]


def content_hash(html: Column) -> Column:
    return F.sha2(html, 256)


def extract_distinct(
    pages: DataFrame, extractor: Callable[[DataFrame], DataFrame], html: str = "html"
) -> DataFrame:
    """Hash content, extract each distinct content once, rejoin.

    ``extractor`` maps a frame with ``html`` to one with extra columns; it
    sees one row per distinct content.  The distinct step is a partial
    aggregate (hot content is combined map-side); the join back is on the
    hash, split by AQE if one content dominates.
    """
    keyed = pages.withColumn("content_sha", content_hash(F.col(html)))
    distinct = keyed.groupBy("content_sha").agg(F.first(html).alias(html))
    # The exchange materialises each extraction once: without it, codegen
    # defers the projection into the join and re-evaluates it per match.  A
    # sort-merge join on the hash reuses this partitioning.
    extracted = extractor(distinct).drop(html).repartition("content_sha")
    return keyed.join(extracted, "content_sha")


def extract_links(pages: DataFrame, base: str = "url") -> DataFrame:
    """One row per anchor, resolved to an absolute URL (order kept in ``pos``)."""
    return pages.select(
        "page_id", F.col(base).alias("page_url"), F.posexplode(H.links(F.col("html"))).alias("pos", "href")
    ).withColumns({"pos": F.col("pos").cast("bigint"), "link": resolve(F.col("page_url"), F.col("href"))})


def extract_markdown(pages: DataFrame) -> DataFrame:
    """Title, headings, paragraphs, list items and links as markdown."""
    return pages.withColumn("markdown", H.markdown(F.col("html")))


def extract_html(pages: DataFrame) -> DataFrame:
    """``html`` (scripts, styles, comments removed) and ``rawHtml``."""
    return pages.withColumns({"clean_html": H.clean_html(F.col("html")), "raw_html": F.col("html")})


DEFAULT_FIELDS = {
    "title": H.TITLE_PATTERN,
    "heading": H.H1_PATTERN,
    "lang": H.LANG_PATTERN,
}


def extract_json(pages: DataFrame, fields: dict[str, str] | None = None, json_col: str = "json") -> DataFrame:
    """E5: named fields from tag patterns (group 1, inline tags stripped) into
    a struct and its JSON text."""
    fields = fields or DEFAULT_FIELDS
    cols = {
        k: F.nullif(H.strip_inline(F.regexp_extract(F.col("html"), pat, 1)), F.lit("")) for k, pat in fields.items()
    }
    s = F.struct(*[c.alias(k) for k, c in cols.items()])
    return pages.withColumns({**cols, json_col: F.to_json(s)})


def main_content(pages: DataFrame, out: str = "main_html") -> DataFrame:
    """``onlyMainContent`` - the article, else main, else the body with
    header, nav and footer removed."""
    html = F.col("html")
    article = F.regexp_extract(html, r"(?is)<article( [^>]*)?>(.*)</article>", 2)
    main = F.regexp_extract(html, r"(?is)<main( [^>]*)?>(.*)</main>", 2)
    body = F.regexp_extract(html, r"(?is)<body( [^>]*)?>(.*?)(</body>|$)", 2)
    body = F.regexp_replace(body, H.tag_block_pattern(["header", "nav", "footer"]), "")
    return pages.withColumn(out, F.coalesce(F.nullif(article, F.lit("")), F.nullif(main, F.lit("")), body))


def filter_tags(pages: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None,
                out: str = "filtered_html") -> DataFrame:
    """E7 (regex mode): keep only ``include`` blocks (document order), then
    drop ``exclude`` blocks.  Correct for tags that do not nest in
    themselves; ``filter_tags_tree`` handles nesting."""
    c = F.col("html")
    if include:
        c = F.array_join(F.regexp_extract_all(c, F.lit(H.tag_block_pattern(include)), F.lit(1)), "")
    if exclude:
        c = F.regexp_replace(c, H.tag_block_pattern(exclude), "")
    return pages.withColumn(out, c)


def _tree_filter(include: list[str], exclude: list[str]):
    from html.parser import HTMLParser

    void = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    class Filter(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=False)
            self.out: list[str] = []
            self.stack: list[str] = []
            self.inc_depth = 0
            self.exc_depth = 0

        def _emit(self, s):
            if self.exc_depth == 0 and (not include or self.inc_depth > 0):
                self.out.append(s)

        def handle_starttag(self, tag, attrs):
            raw = self.get_starttag_text() or f"<{tag}>"
            if tag in void:
                self._emit(raw)
                return
            self.stack.append(tag)
            if tag in exclude:
                self.exc_depth += 1
            if tag in include:
                self.inc_depth += 1
            self._emit(raw) if tag not in exclude else None

        def handle_startendtag(self, tag, attrs):
            self._emit(self.get_starttag_text() or f"<{tag}/>")

        def handle_endtag(self, tag):
            if tag not in self.stack:
                return
            while self.stack:
                t = self.stack.pop()
                # Only the page's own end tags are written, none for what an outer one closes.
                if t not in exclude and t == tag:
                    self._emit(f"</{t}>")
                if t in include:
                    self.inc_depth -= 1
                if t in exclude:
                    self.exc_depth -= 1
                if t == tag:
                    break

        def handle_data(self, data):
            self._emit(data)

        def handle_decl(self, decl):
            self._emit(f"<!{decl}>")

        def handle_comment(self, data):
            self._emit(f"<!--{data}-->")

        def handle_entityref(self, name):
            self._emit(f"&{name};")

        def handle_charref(self, name):
            self._emit(f"&#{name};")

    def run(doc: str | None) -> str | None:
        if doc is None:
            return None
        p = Filter()
        p.feed(doc)
        p.close()
        return "".join(p.out)

    return run


def filter_tags_tree(pages: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None,
                     out: str = "filtered_html") -> DataFrame:
    """E7 (tree mode): a real parse for nested tags, per Arrow batch.

    Python runs only here; batches are whole partitions streamed through
    ``mapInPandas``, so no row crosses to the driver.
    """
    inc, exc = [t.lower() for t in include or []], [t.lower() for t in exclude or []]
    schema = T.StructType(pages.schema.fields + [T.StructField(out, T.StringType())])

    def per_batch(batches):
        fn = _tree_filter(inc, exc)
        for pdf in batches:
            pdf[out] = [fn(h) for h in pdf["html"]]
            yield pdf

    return pages.mapInPandas(per_batch, schema)


#: Elements without an end tag, and elements whose content is no markup.
VOID_TAGS = "area base br col embed hr img input link meta source track wbr".split()
RAW_TAGS = "script style textarea title".split()


def filter_nested_tags(pages: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None,
                       out: str = "filtered_html") -> DataFrame:
    """E7 (nested mode): keep only what stands in an ``include`` element, then
    drop what stands in an ``exclude`` element; both may nest in themselves.

    A distinct page becomes one row for each named tag and for the text
    between two of them.  Each name's depth is a running sum that never falls
    below zero, and the tokens that stay are joined again in page order.  Each
    step is partitioned by the page's hash, and a page is one row before and after.

    Tags in comments and in script, style, textarea and title elements are
    text.  An element that is never closed reaches the page's end; an end tag
    without a start is dropped.  A null page gives null, an empty one an empty
    text, repeated rows repeated results.
    """
    inc, exc = [t.lower() for t in include or []], [t.lower() for t in exclude or []]
    names = sorted({*inc, *exc})
    if not names:
        return pages.withColumn(out, F.col("html"))
    listed, raw = "|".join(names), "|".join(RAW_TAGS)
    special = rf"!--|(?:{raw})(?=[\s/>])|/?(?:{listed})(?=[\s/>])"
    attrs = r"""(?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+(?:>|\z)"""
    token = (
        rf"(?is)<!--.*?(?:-->|\z)|<({raw})(?=[\s/>])[^>]*+>.*?(?:</\1\s*+>|\z)|</?(?:{listed})(?=[\s/>]){attrs}"
        rf"|(?:[^<]++|<(?!{special}))++|<"
    )
    keyed = pages.withColumn("_sha", content_hash(F.col("html")))
    distinct = keyed.where(F.col("_sha").isNotNull()).groupBy("_sha").agg(F.first("html").alias("_page"))
    tokens = distinct.select("_sha", F.posexplode(F.regexp_extract_all("_page", F.lit(token), F.lit(0))).alias("_at", "_token"))
    named = F.lower(F.regexp_extract("_token", rf"(?i)^</?({listed})(?=[\s/>])", 1))
    tokens = tokens.withColumns({"_tag": named, "_end": F.col("_token").startswith("</")})
    whole = F.col("_tag").isin(*VOID_TAGS, *RAW_TAGS) | F.col("_token").endswith("/>")
    order = Window.partitionBy("_sha").orderBy("_at")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = {t: F.when((F.col("_tag") == t) & ~whole, F.when(F.col("_end"), -1).otherwise(1)).otherwise(0) for t in names}
    tokens = tokens.withColumns({f"_sum_{t}": F.sum(step[t]).over(so_far) for t in names})
    tokens = tokens.withColumns({f"_open_{t}": F.col(f"_sum_{t}") - F.least(F.lit(0), F.min(f"_sum_{t}").over(so_far)) for t in names})
    tokens = tokens.withColumns({f"_before_{t}": F.lag(f"_open_{t}", 1, 0).over(order) for t in names})

    def within(tags: list[str]) -> Column:
        found = F.lit(False)
        for t in tags:
            found = found | (F.col(f"_open_{t}") > 0) | ((F.col("_tag") == t) & (whole | (F.col(f"_before_{t}") > 0)))
        return found

    stray = F.lit(False)
    for t in names:
        stray = stray | ((F.col("_tag") == t) & F.col("_end") & (F.col(f"_before_{t}") == 0))
    keep = ~within(exc) & ~stray & (within(inc) if inc else F.lit(True))
    kept = tokens.where(keep).groupBy("_sha").agg(F.array_sort(F.collect_list(F.struct("_at", "_token"))).alias("_kept"))
    # Joined on another form of the hash, this side is dealt once more, and only then can Spark split a page that dominates.
    same = F.concat("_sha", F.lit("."))
    kept = kept.select(same.alias("_of"), F.array_join("_kept._token", "").alias("_text"))
    joined = keyed.join(kept, same == F.col("_of"), "left")
    return joined.select(*(F.col(c) for c in pages.columns if c != out), F.when(F.col("html").isNotNull(), F.coalesce("_text", F.lit(""))).alias(out))


def strip_base64_images(pages: DataFrame) -> DataFrame:
    """``removeBase64Images``."""
    return pages.withColumn("html", F.regexp_replace("html", H.BASE64_IMG_PATTERN, ""))


def block_ads(pages: DataFrame, markers: list[str] | None = None) -> DataFrame:
    """``blockAds`` - drop ad containers by class marker."""
    return pages.withColumn("html", F.regexp_replace("html", H.ad_pattern(markers or H.AD_MARKERS), ""))


def scrape(pages: DataFrame, formats: Column, only_main_content: bool = False, remove_base64_images: bool = True,
           block_ads_: bool = True, include_tags: list[str] | None = None,
           exclude_tags: list[str] | None = None, keep_formats: bool = False) -> DataFrame:
    """One output column per format, null unless requested in the row's
    ``formats`` array.  Options apply before extraction, but ``rawHtml`` is
    the page as captured; Catalyst prunes the columns a caller does not select."""
    df = pages.withColumns({"_formats": formats, "_raw": F.col("html")})
    if remove_base64_images:
        df = strip_base64_images(df)
    if block_ads_:
        df = block_ads(df)
    if only_main_content:
        df = main_content(df, out="html")
    if include_tags or exclude_tags:
        df = filter_tags(df, include_tags, exclude_tags, out="html")
    want = lambda f: F.array_contains(F.col("_formats"), f)
    h = F.col("html")
    fields = F.to_json(F.struct(*[
        F.nullif(H.strip_inline(F.regexp_extract(h, p, 1)), F.lit("")).alias(k) for k, p in DEFAULT_FIELDS.items()
    ]))
    return df.withColumns(
        {
            "markdown": F.when(want("markdown"), H.markdown(h)),
            "html_out": F.when(want("html"), H.clean_html(h)),
            "raw_html": F.when(want("rawHtml"), F.col("_raw")),
            "links": F.when(want("links"), F.transform(H.links(h), lambda x: resolve(F.col("url"), x))),
            "json": F.when(want("json"), fields),
        }
    ).drop("_raw", *([] if keep_formats else ["_formats"]))
