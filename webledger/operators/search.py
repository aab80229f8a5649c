"""Ranked retrieval over captured text and document handling.

BM25 is computed without exploding whole documents through a shuffle:
document length is an expression on the row, tokens meet the query terms in
a semi join that the engine broadcasts while the terms are small, and only
(doc, term) counts move across the network.  They form an index by document,
written once, on which queries are scored without moving its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webledger.functions import html as H
from webledger.session import bucketed_table, stored

TOKEN_SPLIT = r"[^\p{L}0-9]+"
K1 = 1.2
B = 0.75
SENTINEL = ""  # never a token: tokens are non-empty


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: t != "")


@dataclass
class Index:
    """A document-partitioned inverted index, written once.

    ``postings`` (doc_id, term, tf, dl) is a table bucketed by document, so a
    frequent term's list is spread evenly, and all that a document adds to a
    query meets in the task that reads it.  ``frequencies`` (term, df) and the
    number of documents and their mean length are of the whole corpus.
    """

    postings: DataFrame
    frequencies: DataFrame
    n_docs: int
    avgdl: float


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> Index:
    """The index of ``docs``, of all their terms or of those in ``vocabulary`` (term).

    One pass over the text: each document emits its tokens plus one sentinel
    row carrying its length, so N and the average length come out of the same
    (doc, term) aggregate as the term frequencies.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("toks"))
    hits = d.select("doc_id", F.size("toks").alias("dl"), F.explode(F.concat("toks", F.array(F.lit(SENTINEL)))).alias("term"))
    if vocabulary is not None:
        # The sentinel is one of the terms, so every document's length survives the join.
        hits = hits.join(vocabulary.select("term").unionByName(spark.range(1).select(F.lit(SENTINEL).alias("term"))), "term", "left_semi")
    tf = hits.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("dl").alias("dl"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    postings = bucketed_table(tf.repartition(buckets, "doc_id"), "doc_id", buckets, "postings")
    df_ = stored(postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("dl").alias("sum_dl")), "frequencies")
    corpus = df_.where(F.col("term") == SENTINEL).select("df", F.col("sum_dl") / F.col("df")).first() or (0, 1.0)
    return Index(postings, df_.where(F.col("term") != SENTINEL).select("term", "df"), *corpus)


def search_index(index: Index, queries: DataFrame, limit: int = 10, query_id: str = "query_id", query: str = "query",
                 k1: float = K1, b: float = B) -> DataFrame:
    """The ``limit`` best documents of each query by an index; exact.

    The queries' terms, with their idf, meet the postings where these lie
    (Spark sends the terms to them while they are small), scores are summed
    without moving a row, and a task passes on its ``limit`` best of a query.
    """
    qt = queries.select(F.col(query_id).alias("query_id"), F.explode(F.array_distinct(tokens(F.col(query)))).alias("term")).distinct()
    idf = F.log(1 + (F.lit(float(index.n_docs)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    own = stored(qt.join(index.frequencies, "term").select("query_id", "term", idf.alias("idf")), "query-terms")
    weight = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.lit(index.avgdl)))
    # Not the sentinel's rows, whose term no query has.
    scored = index.postings.join(own, "term").groupBy("query_id", "doc_id").agg(F.round(F.sum(weight), 6).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    ranked = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)  # an integer rank, or tasks would pass on all
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def search(docs: DataFrame, queries: DataFrame, limit: int = 10, doc_id: str = "doc_id", text: str = "text",
           query_id: str = "query_id", query: str = "query", k1: float = K1, b: float = B) -> DataFrame:
    """Q1: BM25 (idf ln(1 + (N - df + 0.5) / (df + 0.5))), top ``limit`` per
    query; scores rounded to 6 places, ties by document id.  The index is of
    the queries' terms only, and used once; for more queries over the same
    documents, keep what ``build_index`` returns."""
    vocabulary = queries.select(F.explode(F.array_distinct(tokens(F.col(query)))).alias("term")).distinct()
    return search_index(build_index(docs, vocabulary, doc_id, text), queries, limit, query_id, query, k1, b)


def search_versions(docs: DataFrame, versions: dict[str, Column], queries: DataFrame, limit: int = 10, doc_id: str = "doc_id", text: str = "text",
                    query_id: str = "query_id", query: str = "query", k1: float = K1, b: float = B) -> DataFrame:
    """(version, query_id, doc_id, score, rank): what ``search`` finds in each
    version of a corpus, a condition on its rows.  The texts are split once and
    the postings read once for all versions; each has its own frequencies,
    number of documents, mean length and ranks."""
    spark = docs.sparkSession
    qt = queries.select(F.col(query_id).alias("query_id"), F.explode(F.array_distinct(tokens(F.col(query)))).alias("term")).distinct()
    vocabulary = qt.select("term").distinct().unionByName(spark.range(1).select(F.lit(SENTINEL).alias("term")))
    each = list(enumerate(versions))
    d = docs.select(F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("toks"), *(versions[v].alias(f"in{i}") for i, v in each))
    hits = d.select("doc_id", *(f"in{i}" for i, _ in each), F.size("toks").alias("dl"), F.explode(F.concat("toks", F.array(F.lit(SENTINEL)))).alias("term"))
    tf = hits.join(vocabulary, "term", "left_semi").groupBy("doc_id", "term").agg(
        *(F.count_if(f"in{i}").alias(f"tf{i}") for i, _ in each), *(F.first(F.when(F.col(f"in{i}"), F.col("dl")), True).alias(f"dl{i}") for i, _ in each))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    postings = bucketed_table(tf.repartition(buckets, "doc_id"), "doc_id", buckets, "postings")
    frequencies = stored(postings.groupBy("term").agg(
        *(F.count(f"dl{i}").alias(f"df{i}") for i, _ in each), *(F.sum(f"dl{i}").alias(f"sum{i}") for i, _ in each)), "frequencies")
    corpus = frequencies.where(F.col("term") == SENTINEL).first()
    n_docs = [corpus[f"df{i}"] if corpus else 0 for i, _ in each]
    avgdl = [corpus[f"sum{i}"] / n if n else 1.0 for (i, _), n in zip(each, n_docs, strict=True)]
    idf = [F.log(1 + (F.lit(float(n_docs[i])) - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5)).alias(f"idf{i}") for i, _ in each]
    own = stored(qt.join(frequencies.where(F.col("term") != SENTINEL), "term").select("query_id", "term", *idf), "query-terms")
    weight = lambda i: F.col(f"idf{i}") * F.col(f"tf{i}") * (k1 + 1) / (
        F.col(f"tf{i}") + k1 * (1 - b + b * F.col(f"dl{i}") / F.lit(avgdl[i])))
    sums = postings.join(own, "term").groupBy("query_id", "doc_id").agg(*(F.round(F.sum(weight(i)), 6).alias(f"score{i}") for i, _ in each))
    found = F.explode(F.array(*(F.struct(F.lit(v).alias("version"), F.col(f"score{i}").alias("score")) for i, v in each))).alias("f")
    scored = sums.select("query_id", "doc_id", found).select("f.version", "query_id", "doc_id", "f.score").where(F.col("score").isNotNull())
    w = Window.partitionBy("version", "query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    ranked = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def search_then_scrape(results: DataFrame, pages: DataFrame, formats: list[str] | None = None, **options) -> DataFrame:
    """``scrapeOptions`` on search - the requested formats of each
    result's page, and its title.  The join runs first, so only result pages
    are parsed."""
    from webledger.operators import extract as E

    j = results.join(pages.select(F.col("page_id").alias("doc_id"), "url", "html"), "doc_id", "left")
    title = F.nullif(H.strip_inline(F.regexp_extract(F.col("html"), H.TITLE_PATTERN, 1)), F.lit(""))
    wanted = F.array(*[F.lit(f) for f in formats or ["markdown"]])
    return E.scrape(j.withColumn("title", title), wanted, **options).drop("html")


def search_filtered(docs: DataFrame, queries: DataFrame, limit: int = 10, lang: str | None = None, tbs: str | None = None,
                    as_of: Column | None = None, ts: str = "ts", lang_col: str = "lang", **bm25) -> DataFrame:
    """Q1 with the search's ``location`` and ``tbs``: only documents of the
    language and of the time range are searched (and counted)."""
    if lang is not None:
        docs = filter_location(docs, lang, lang_col)
    if tbs is not None:
        docs = filter_time(docs, tbs, as_of, ts)
    return search(docs, queries, limit, **bm25)


TBS_INTERVALS = {"qdr:h": "1 HOUR", "qdr:d": "1 DAY", "qdr:w": "7 DAYS", "qdr:m": "1 MONTH", "qdr:y": "1 YEAR"}


def filter_time(results: DataFrame, tbs: str, as_of: Column, ts: str = "ts") -> DataFrame:
    """Google-style ``tbs`` time ranges relative to ``as_of``; a plain
    timestamp predicate, so it reaches the Parquet scan."""
    if tbs not in TBS_INTERVALS:
        raise ValueError(f"unknown time range {tbs!r}; known: {', '.join(TBS_INTERVALS)}")
    start = as_of - F.expr(f"INTERVAL {TBS_INTERVALS[tbs]}")
    return results.where((F.col(ts) > start) & (F.col(ts) <= as_of))


def filter_location(docs: DataFrame, lang: str, col: str = "lang") -> DataFrame:
    """location as a language / country code equality (pushed down)."""
    return docs.where(F.col(col) == lang)


CHARS_PER_PAGE = 3000


def parse_limits(files: DataFrame, max_pages: int | None, n_chars: str = "n_chars") -> DataFrame:
    """Page count (``ceil(chars / 3000)``, at least 1), ``maxPages`` cap,
    1 credit per parsed page."""
    pages = F.greatest(F.lit(1), F.ceil(F.col(n_chars) / F.lit(float(CHARS_PER_PAGE)))).cast("bigint")
    billed = pages if max_pages is None else F.least(pages, F.lit(max_pages)).cast("bigint")
    return files.withColumns({"n_pages": pages, "billed_pages": billed, "credits": billed})


def _cells(line: Column) -> Column:
    """The cells of one line of CSV: quotes enclose commas, and two of them stand for one."""
    raw = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(r'(?s)("(?:[^"]|"")*"[^,]*|[^,]*),'), F.lit(1))
    plain = lambda c: F.regexp_replace(F.regexp_replace(c, r'(?s)^"(.*)"\s*$', "$1"), '""', '"')
    return F.transform(raw, lambda c: F.when(c.startswith('"'), plain(c)).otherwise(c))


def csv_to_markdown(text: Column) -> Column:
    """Comma-separated lines -> a markdown table (first line is the header);
    a line ends only outside quotes, and within a cell becomes a space."""
    lines = F.regexp_extract_all(F.concat(F.regexp_replace(text, r"\r", ""), F.lit("\n")),
                                 F.lit(r'((?:[^"\n]|"(?:[^"]|"")*"|")*)\n'), F.lit(1))
    rows = F.filter(lines, lambda r: r != "")
    cells = F.transform(rows, lambda r: F.concat(F.lit("| "), F.regexp_replace(F.array_join(_cells(r), " | "), "\n", " "),
                                                 F.lit(" |")))
    head = F.element_at(cells, 1)
    ncol = F.size(_cells(F.element_at(rows, 1)))
    sep = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), ncol))
    return F.when(F.size(rows) == 0, F.lit("")).otherwise(
        F.array_join(F.concat(F.array(head, sep), F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0)))), "\n")
    )


def parse_documents(files: DataFrame, only_main_content: bool = False, formats: Column | None = None,
                    include_tags: list[str] | None = None, exclude_tags: list[str] | None = None) -> DataFrame:
    """Files -> text by type.  HTML goes through the scrape rules with
    their options (main content, tags, formats: ``markdown``, ``html``,
    ``rawHtml``, ``links``, ``json``); CSV becomes a markdown table, JSON is
    fenced, plain text stays as it is.  Bytes that aren't UTF-8 and other types
    (PDF, DOCX, XLSX) are not decoded here: ``parsed`` is false."""
    from webledger.operators import extract as E

    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    t = F.col("file_type")
    is_html = t.isin("html", "htm")
    wanted = formats if formats is not None else F.array(F.lit("markdown"))
    base = files.withColumns({"_text": text, "_formats": wanted})
    if "url" not in files.columns:
        base = base.withColumn("url", F.lit(None).cast("string"))
    page = base.withColumn("html", F.when(is_html, F.col("_text")))
    out = E.scrape(page, F.col("_formats"), only_main_content, remove_base64_images=False, block_ads_=False,
                   include_tags=include_tags, exclude_tags=exclude_tags, keep_formats=True)
    other = (
        F.when(t.isin("txt", "md", "text"), F.col("_text"))
        .when(t == "csv", csv_to_markdown(F.col("_text")))
        .when(t == "json", F.concat(F.lit("```json\n"), F.col("_text"), F.lit("\n```")))
    )
    asked = F.array_contains("_formats", "markdown")
    known = F.col("_text").isNotNull() & t.isin("html", "htm", "txt", "md", "text", "csv", "json")
    out = out.withColumns({"markdown": F.when(is_html, F.col("markdown")).when(asked, other), "parsed": F.coalesce(known, F.lit(False))})
    return out.drop("_text", "_formats", "html", *([] if "url" in files.columns else ["url"]))


def uploads_to_files(uploads: DataFrame, file: str = "file", file_name: str = "file_name") -> DataFrame:
    """The parse request's upload form: a base64 ``file`` and an optional
    ``fileName`` (default ``uploaded-file``) -> the files shape of
    ``parse_documents`` (bytes, name, type by extension)."""
    name = F.coalesce(F.col(file_name), F.lit("uploaded-file"))
    ext = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    return uploads.withColumns(
        {
            "content": F.unbase64(F.col(file)),
            "file_name": name,
            "file_type": F.when(ext == "", F.lit("bin")).otherwise(ext),
        }
    ).drop(file)
