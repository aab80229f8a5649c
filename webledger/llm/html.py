"""Main text of web pages (operator 2): page structure, and host suffix arrays.

A page is cut into blocks in page order.  Structure settles most: what stands
in menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles or comments goes, and where the page marks its article, what stands in
it stays, repeated or not.  Blocks that structure leaves open (all others of
any page, beside its article too) are settled by repetition.  The token streams
of all pages of a host, all their blocks, are concatenated and the suffixes sorted by
their first ``WINDOW`` tokens.  Equal neighbours of distinct pages are repeated
text; what windows cover that stand on ``SHARE`` of the host's pages, and on
``LEAST`` at least, is boilerplate, and the other runs stay.
Suffix arrays are built over bounded groups of pages of a host.  A window on a
share of the host's pages is on that share of some group, so each array passes on
only the windows that reach it there, and all groups of the host count these: it
doesn't matter which pages shared an array.  Pages of a host with equal streams
count as one page, and so do pages with nearly equal ones: of pages that share most
of their pairs of tokens, copies with a few words changed, only one counts.

Input cases: a null html is empty; a page without text in its main part gives
the empty string; markup that never closes ends with the page; a null or bad
url is a host of its own name, ''; repeated rows give repeated results; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Container, Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webledger.llm.common import slices, splittable, table, with_python, written
from webledger.session import bucketed_table, shuffles_deleted

#: Tokens of the shortest repeated substring.
WINDOW = 8
#: Tokens of one suffix array, about, characters of a token with its markup, and pages that a group of a host's pages has at least, about.
ARRAY_TOKENS, TOKEN_CHARS, GROUP_PAGES = 200_000, 7, 8

#: Repeated text is boilerplate from this share of the host's distinct pages, and from this number of them.
SHARE, LEAST = 1 / 3, 3
#: Nearly equal streams: sketches of BANDS x ROWS minima over pairs of tokens, a band and NEAR of all minima in common.
BANDS, ROWS, NEAR = 8, 8, 0.75

RAW = "script|style|noscript|template|textarea|title|iframe|xmp|noembed|noframes"
#: A quote pairs with another only where a value starts; elsewhere in a tag it is a character like any other.
PART = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)|[^>])*+)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTR = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))|([^\s=/"']+)""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: An open element of the first kind ends where one of the second starts.
IMPLIED = {
    "p": BLOCK - {"body", "html", "head"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
    "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "head": {"body"},
}
#: Tags whose start can end an open element.
ENDING = frozenset().union(*IMPLIED.values())
#: A list item or cell ends only within the list or table it stands in.
FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
GONE_TAGS = frozenset("nav footer aside form menu head button select option dialog svg object audio video canvas map search datalist".split())
GONE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
GONE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored sponsors promo promotion promoted banner "
    "sidebar sidebars menu menus nav navbar navigation topnav subnav breadcrumb breadcrumbs crumbs cookie cookies consent gdpr notice notices "
    "alert newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist reply replies "
    "respond disqus footer footnav masthead popup modal overlay widget widgets toolbar pagination pager skip skiplink hidden "
    "copyright legal disclaimer".split()
)
#: Within an article, and on elements of running text anywhere, names are often made of its words (``related-work``,
#: ``social-history``): there ids say nothing, and a class counts as a whole, GONE_WORDS with these around them.
BEFORE = "article|post|entry|page|site|blog|wp|block|js"
FORMS = (
    "box|boxes|bar|bars|button|buttons|btn|icon|icons|link|links|list|item|items|container|wrapper|wrap|holder|area|panel|unit|units|slot|slots|"
    "block|blocks|row|inner|outer|form|thread|body|meta|count|tools|top|bottom|left|right|inline|desktop|mobile|google|facebook|twitter|whatsapp|"
    r"email|pinterest|linkedin|reddit|telegram|taboola|outbrain|x|\d+"
)
MORE = "(?:related|recommended|sponsored|promoted) (?:posts?|articles?|stor(?:y|ies)|news|reading|videos?|topics|content)"
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p section blockquote pre li dl dt dd figure figcaption table tr th td a span b i em strong".split())
#: A class or id that starts so says what a container has, not what it is.
ABOUT = re.compile(r"(?:has|with|without|no|is|js|layout)[-_]", re.IGNORECASE)
#: What else an article element can be.
NOT_ARTICLE = frozenset("ad ads advert comment comments reply related promo sponsored widget teaser".split())
WHOLE = rf"(?:{{0}})(?: (?:{{0}}|{FORMS}))*"
GONE_NAME = re.compile(rf"(?:(?:{BEFORE}) )*(?:{WHOLE.format('|'.join(sorted(GONE_WORDS)))}|{MORE}(?: (?:{FORMS}))*)")
NOT_ARTICLE_NAME = re.compile(WHOLE.format("|".join(sorted(NOT_ARTICLE))) + "|(?:related|sponsored) (?:posts?|articles?|stor(?:y|ies)|news|content)")
COMMENT_ID = re.compile(r"(?:comment|reply|ad|widget|teaser)[-_]?\d+", re.IGNORECASE)
HEADER_WORDS = frozenset(["header", "topbar"])
MAIN_WORDS = frozenset(["articlebody"])
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
GONE, OPEN, MAIN = range(3)


def attributes(raw: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(raw)}


def named(classes: list[str], name: re.Pattern) -> bool:
    """Whether a class as a whole has the form ``name``."""
    return any(name.fullmatch(" ".join(WORD.findall(n)).lower()) for n in classes)


def zone_of(tag: str, raw: str, outer: int) -> int:
    """The zone of an element that starts within zone ``outer``."""
    if outer == GONE or tag in GONE_TAGS or (tag in ("header", "fieldset") and outer != MAIN):
        return GONE
    found = attributes(raw) if raw.strip(" /") else {}
    if found:
        role = found.get("role", "").lower()
        classes, ids = ([n for n in found.get(name, "").split() if not ABOUT.match(n)] for name in ("class", "id"))
        names = classes + ids
        words = {w.lower() for n in names for w in WORD.findall(n)}
        style = found.get("style", "").replace(" ", "").lower()
        if (
            role in GONE_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style
            or "visibility:hidden" in style
        ):
            return GONE
        if tag == "article":
            if named(classes, NOT_ARTICLE_NAME) or any(COMMENT_ID.fullmatch(n) for n in ids):
                return GONE
        elif outer == MAIN or tag in PROSE:
            # Highlighted code calls its comments so.
            if tag not in ("html", "body", "main") and named([n for n in classes if (tag, n) != ("span", "comment")], GONE_NAME):
                return GONE
        elif tag not in ("html", "body", "main") and (words & GONE_WORDS or (outer != MAIN and words & HEADER_WORDS)):
            return GONE
        if role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody" or {n.lower() for n in names} & MAIN_WORDS:
            return MAIN
    return MAIN if tag in ("article", "main") else outer


class Blocks:
    """Collects the text of a page: ``add`` appends to the open block, ``close``
    ends it.  Text of another zone than the block's ends the block first."""

    def __init__(self):
        self.out: list[tuple[int, str]] = []
        self.text: list[str] = []
        self.zone = OPEN

    def add(self, zone: int, text: str) -> None:
        if self.text and zone != self.zone:
            self.close()
        self.zone = zone
        self.text.append(text)

    def close(self) -> None:
        joined = " ".join(html.unescape("".join(self.text)).split())
        if joined:
            self.out.append((self.zone, joined))
        self.text = []


def implied_end(stack: list[tuple[str, int, bool]], tag: str) -> int | None:
    """Where the stack is cut because the start of ``tag`` ends an open element, or None."""
    if tag not in ENDING:
        return None
    for i in range(len(stack) - 1, -1, -1):
        name = stack[i][0]
        if tag in IMPLIED.get(name, ()):
            return i
        if name in FENCE.get(tag, ()) or (name in BLOCK and tag not in FENCE):
            return None
    return None


def blocks_of(page: str | None) -> list[tuple[int, str]]:
    """(zone, text) of the page's blocks in page order; empty ones are left
    out.  An inline element that goes leaves no gap in the block around it."""
    page = page or ""
    blocks, at = Blocks(), 0
    stack: list[tuple[str, int, bool]] = []  # tag, zone, and whether it stands in an inline element that goes
    depth: Counter[str] = Counter()  # open elements of each tag

    def cut_at(i: int) -> None:
        depth.subtract(tag for tag, _, _ in stack[i:])
        del stack[i:]

    def text(start: int, end: int) -> None:
        zone, mute = stack[-1][1:] if stack else (OPEN, False)
        if end > start and not mute:
            blocks.add(zone, page[start:end])

    for m in PART.finditer(page):
        text(at, m.start())
        at = m.end()
        tag = (m["tag"] or "").lower()
        zone, mute = stack[-1][1:] if stack else (OPEN, False)
        if tag == "br" and not mute:
            blocks.add(zone, "\n")
        if tag in BLOCK and not mute:
            blocks.close()
        if not tag or tag in VOID:
            continue
        if m["end"]:
            for i in range(len(stack) - 1, -1, -1) if depth[tag] else ():
                if stack[i][0] == tag:
                    cut_at(i)
                    break
                if tag not in BLOCK and stack[i][0] in BLOCK:
                    break  # an inline end tag doesn't close blocks
            continue
        cut = implied_end(stack, tag)
        if cut is not None:
            cut_at(cut)
            zone, mute = stack[-1][1:] if stack else (OPEN, False)
        inner = zone_of(tag, m["attrs"] or "", zone)
        depth[tag] += 1
        stack.append((tag, inner, mute or (inner == GONE != zone and tag not in BLOCK)))
    text(at, len(page))
    blocks.close()
    return blocks.out


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def packed(blocks: list[tuple[int, str]]) -> bytes:
    """Zones and texts of a page's blocks; a block holds no line feed."""
    return "\n".join(["".join(str(z) for z, _ in blocks), *(t for _, t in blocks)]).encode("utf-8", "surrogatepass")


def unpacked(page: bytes) -> tuple[list[str], list[int]]:
    """The stream of a page's texts, and their zones."""
    zones, *stream = page.decode("utf-8", "surrogatepass").split("\n")
    return (stream, [int(z) for z in zones]) if zones else ([], [])


def parse(pages: DataFrame) -> DataFrame:
    """page_id, url, host, digest, packed, open: all blocks of each page with their
    zones (``packed``, compressed), a digest of both, and whether any block is left open."""
    schema = "page_id long, url string, host string, digest binary, packed binary, open boolean"
    names = ["page_id", "url", "host", "digest", "packed", "open"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=3, write_checksum=False)
        for batch in slices(batches):
            out: list[list] = [[], [], [], []]
            urls = batch.column("url").to_pylist()
            for url, page in zip(urls, batch.column("html").to_pylist(), strict=True):
                found = blocks_of(page)
                whole = packed(found)
                for column, value in zip(out, (host_of(url), xxhash.xxh3_128_digest(whole), small.compress(whole), any(z == OPEN for z, _ in found)), strict=True):
                    column.append(value)
            kinds = (pa.string(), pa.binary(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *map(pa.array, out, kinds)], names)

    return with_python(pages).select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, schema)


def blocks_in(pages: pa.Table) -> Iterator[tuple[list[str], list[int]]]:
    """Stream and zones of each row of a table with ``packed``, or with ``stream`` (and then no zones)."""
    large = zstandard.ZstdDecompressor()
    for batch in pages.to_batches(max_chunksize=1000):
        if "packed" in batch.schema.names:
            yield from (unpacked(large.decompress(page)) for page in batch.column("packed").to_pylist())
        else:
            yield from ((stream, []) for stream in batch.column("stream").to_pylist())


class Bins:
    """Where the pages of each host meet: a host's pages are dealt to as many
    groups as their length asks for, and the groups of all hosts to bins of
    about ``ARRAY_TOKENS`` tokens.  ``lengths`` has host and chars of each page."""

    def __init__(self, lengths: DataFrame) -> None:
        size = F.lit(ARRAY_TOKENS * TOKEN_CHARS)
        hosts = lengths.groupBy("host").agg(F.sum("chars").alias("chars"), F.least(F.ceil(F.sum("chars") / size), F.ceil(F.count("*") / GROUP_PAGES)).alias("groups"))
        hosts = written(hosts, "hosts")
        self.chars = hosts.agg(F.sum("chars")).first()[0] or 0
        self.count = max(1, -(-self.chars // (ARRAY_TOKENS * TOKEN_CHARS)))
        # At most one for each ``ARRAY_TOKENS``, so they fit in a broadcast.
        self.many = hosts.where("groups > 1").select(F.col("host").alias("mh"), "groups")

    def with_groups(self, df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(self.many), F.col("host") == F.col("mh"), "left").drop("mh").withColumn("groups", F.coalesce("groups", F.lit(1)).cast("long"))

    def bin(self, group) -> Column:
        return F.pmod(F.xxhash64("host", group), F.lit(self.count)).cast("int")

    def of_pages(self, df: DataFrame) -> DataFrame:
        """``df`` (host, digest, ...) with groups of the host, and the bin of the page."""
        return self.with_groups(df).withColumn("bin", self.bin(F.pmod(F.xxhash64("digest"), F.col("groups"))))

    def of_hosts(self, df: DataFrame) -> DataFrame:
        """A row of ``df`` (host, ...) for each bin with pages of the host."""
        all_of = self.with_groups(df).withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
        return all_of.withColumn("bin", self.bin(F.col("g"))).drop("g", "groups").distinct()


class TokenHashes(dict):
    """The hash of each token asked for, computed once."""

    def __missing__(self, token: str) -> int:
        self[token] = found = xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")) >> 1
        return found

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def window_digest(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))


def distinct_pages(pages: pa.Table, notes: pa.Table | None = None, hosts: Container[str] | None = None) -> Iterator[tuple[int, str, list[str], list[int]]]:
    """(row, host, stream, zones) of the pages of a bin that count, of ``hosts`` if given."""
    seen = set(zip(notes["host"].to_pylist(), notes["digest"].to_pylist(), strict=True)) if notes is not None else set()
    rows, names = [], pages["host"].to_pylist()
    for row, at in enumerate(zip(names, pages["digest"].to_pylist(), strict=True)):
        if at not in seen and (hosts is None or at[0] in hosts):
            seen.add(at)
            rows.append(row)
    for row, (stream, zones) in zip(rows, blocks_in(pages.take(pa.array(rows, pa.int64()))), strict=True):
        yield row, names[row], stream, zones


class Wanted:
    """The windows of a bin's notes, by host, and where they stand in a page."""

    def __init__(self, notes: pa.Table, window: int) -> None:
        self.window, self.hashes = window, TokenHashes()
        found: dict[str, list] = {}
        for row in notes.to_pylist():
            if row["window"] is not None:
                found.setdefault(row["host"], []).append((row["window"], row["head"], row["tail"]))
        self.hosts = {h: ({w for w, _, _ in x}, np.unique([a for _, a, _ in x]), np.unique([b for _, _, b in x])) for h, x in found.items()}

    def places(self, host: str, words: list[str]) -> list[tuple[int, bytes]]:
        n = len(words) - self.window + 1
        if host not in self.hosts or n <= 0:
            return []
        windows, heads, tails = self.hosts[host]
        each = self.hashes.of(words)
        at = np.flatnonzero(np.isin(each[:n], heads) & np.isin(each[self.window - 1 :], tails)).tolist()
        found = ((i, window_digest(words[i : i + self.window])) for i in at)
        return [(i, d) for i, d in found if d in windows]


def suffix_groups(tokens: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes sorted by their first ``window`` tokens, by doubling: the
    positions in that order, and the rank of each.  Suffixes with fewer tokens
    before their page's end (``ends``, for each position) are left out."""
    n, width = len(tokens), 1
    bits = n.bit_length()

    def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The positions by value, and the rank of each position's value."""
        if n and int(values.max()) >> (63 - bits) == 0:  # then value and position sort as one number, much faster
            both = np.sort(values << bits | np.arange(n))
            order, values = both & ((1 << bits) - 1), both >> bits
        else:
            order = np.argsort(values, kind="stable")
            values = values[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.diff(values, prepend=values[:1]) != 0)
        return order, rank

    order, rank = ranked(tokens.astype(np.int64))
    while width < window:
        step = min(width, window - width)
        after = np.full(n, -1, np.int64)
        after[: n - step] = rank[step:]
        order, rank = ranked(rank * (n + 1) + after + 1)
        width += step
    order = order[order + window <= ends[order]]
    return order, rank[order]


def windows_of(streams: DataFrame, window: int = WINDOW, notes: DataFrame | None = None, share: float = 0.0) -> DataFrame:
    """(host, window, head, tail, pages): each distinct window of an array and the number of its pages, to be added
    up.  With ``share``, only those on this share of the host's pages in the array, and on LEAST if they are all."""
    if "bin" not in streams.columns:
        streams = Bins(streams.select("host", F.length(F.array_join("stream", " ")).alias("chars"))).of_pages(streams)

    def array(pages: pa.Table, told: pa.Table | None = None) -> pa.Table:
        rows, hosts, words, size = [], [], [], []
        for row, host, stream, _ in distinct_pages(pages, told):
            own = " ".join(stream).split()
            words += own
            for column, value in zip((rows, hosts, size), (row, host, len(own)), strict=True):
                column.append(value)
        whole = dict(zip(hosts, (pages["groups"].take(pa.array(rows, pa.int64())).to_numpy() == 1).tolist(), strict=True))
        place = {w: i for i, w in enumerate(dict.fromkeys(words))}
        codes, size = np.fromiter(map(place.__getitem__, words), np.int64, len(words)), np.array(size, np.int64)
        stop = np.cumsum(size)
        page = np.repeat(np.arange(len(hosts)), size)
        first, pages_of = [], np.zeros(0, np.int64)
        if len(words):
            codes_of: dict[str, int] = {}
            of_page = np.array([codes_of.setdefault(h, len(codes_of)) for h in hosts], np.int64)
            n, host_code = np.bincount(of_page), of_page[page]
            # A host's tokens are its own, so windows of two hosts never meet.
            order, rank = suffix_groups(host_code * len(place) + codes, stop[page], window)
            # Within a rank the suffixes stand in page order.
            new_rank, new_page = np.diff(rank, prepend=-1) != 0, np.diff(page[order], prepend=-1) != 0
            begin = np.flatnonzero(new_rank)
            pages_of = np.add.reduceat((new_rank | new_page).astype(np.int64), begin) if len(order) else pages_of
            at = order[begin]
            if share:
                least = np.maximum(n * share - 1e-9, [LEAST if whole[h] else 1 for h in codes_of])
                some = pages_of >= least[host_code[at]]
                at, pages_of = at[some], pages_of[some]
            first = at.tolist()
        digest = [window_digest(words[i : i + window]) for i in first]
        ends = [TokenHashes().of([words[i + k] for i in first]) for k in (0, window - 1)]
        return pa.table(
            {"host": pa.array([hosts[page[i]] for i in first], pa.string()), "window": pa.array(digest, pa.binary()), "head": pa.array(ends[0], pa.int64()),
             "tail": pa.array(ends[1], pa.int64()), "pages": pa.array(pages_of, pa.int64())}
        )

    schema = "host string, window binary, head long, tail long, pages long"
    streams = with_python(streams).select("bin", "groups", "host", "digest", *({"packed", "stream"} & {*streams.columns}))
    if notes is None:
        return streams.groupBy("bin").applyInArrow(lambda t: array(t), schema)
    return streams.groupBy("bin").cogroup(notes.groupBy("bin")).applyInArrow(lambda t, told: array(t, told), schema)


def counted(streams: DataFrame, notes: DataFrame, window: int = WINDOW) -> DataFrame:
    """(host, window, pages): the number of pages in a bin with each window of its notes, to be added up."""

    def run(pages: pa.Table, told: pa.Table) -> pa.Table:
        wanted, found = Wanted(told, window), Counter()
        for _, host, stream, _ in distinct_pages(pages, told, wanted.hosts):
            found.update({(host, d) for _, d in wanted.places(host, " ".join(stream).split())})
        kinds = (pa.string(), pa.binary())
        columns = [pa.array([k[i] for k in found], kind) for i, kind in enumerate(kinds)]
        return pa.table({"host": columns[0], "window": columns[1], "pages": pa.array(list(found.values()), pa.int64())})

    return with_python(streams).select("bin", "host", "digest", "packed").groupBy("bin").cogroup(notes.groupBy("bin")).applyInArrow(run, "host string, window binary, pages long")


#: Factors and terms of the hash functions of sketches.
DRAW = np.random.default_rng(1).integers(0, 2**64, (2, BANDS * ROWS, 1), np.uint64)


def sketch(words: list[str], hashes: TokenHashes | None = None) -> np.ndarray:
    """The least hash of the words' pairs under each of BANDS * ROWS functions."""
    each = (TokenHashes() if hashes is None else hashes).of(words if len(words) > 1 else [*words, ""]).view(np.uint64)
    pairs = each[:-1] * np.uint64(0x9E3779B97F4A7C15) + each[1:]
    pairs = (pairs ^ (pairs >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    pairs ^= pairs >> np.uint64(32)
    return (pairs * (DRAW[0] | np.uint64(1)) + DRAW[1]).min(axis=1).view(np.int64)


def near_copies(streams: DataFrame) -> DataFrame:
    """(host, digest) of the pages that nearly equal another of their host, by what structure doesn't take away."""

    def run(pages: pa.Table) -> pa.Table:
        out: dict[str, list] = {"host": [], "digest": [], "minima": [], "keys": []}
        digests, hashes = pages["digest"].to_pylist(), TokenHashes()
        for row, host, stream, zones in distinct_pages(pages):
            words = " ".join(t for t, z in zip(stream, zones, strict=True) if z != GONE).split()
            if words:
                minima = sketch(words, hashes)
                name = host.encode("utf-8", "surrogatepass")
                keys = [xxhash.xxh3_64_intdigest(b"%d %b %b" % (i, b.tobytes(), name)) >> 1 for i, b in enumerate(minima.reshape(BANDS, ROWS))]
                for column, value in zip(out.values(), (host, digests[row], (minima >> 32).astype(np.int32), keys), strict=True):
                    column.append(value)
        kinds = (pa.string(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()))
        return pa.table({name: pa.array(x, kind) for (name, x), kind in zip(out.items(), kinds, strict=True)})

    told = with_python(streams).select("bin", "host", "digest", "packed").groupBy("bin")
    sketches = written(told.applyInArrow(run, "host string, digest binary, minima array<int>, keys array<long>"), "sketches")
    bands = sketches.select("host", "digest", F.explode("keys").alias("key"))
    first = bands.groupBy("key").agg(F.min("digest").alias("first"), F.count("*").alias("n")).where("n > 1").select(splittable("key").alias("k"), "first")
    first = written(first, "shared")  # few as a rule, and then the sketches needn't move to them
    pairs = bands.join(first, splittable("key") == F.col("k")).where(F.col("digest") > F.col("first")).select("host", "digest", "first").distinct()
    one, other = (sketches.select(F.col("host").alias(f"{x}h"), F.col("digest").alias(f"{x}d"), F.col("minima").alias(f"{x}m")) for x in "ab")
    pairs = pairs.join(one, (F.col("host") == F.col("ah")) & (F.col("digest") == F.col("ad"))).join(other, (F.col("host") == F.col("bh")) & (F.col("first") == F.col("bd")))
    same = F.size(F.filter(F.zip_with("am", "bm", lambda x, y: x == y), lambda x: x))
    return pairs.where(same >= NEAR * BANDS * ROWS).select("host", "digest").distinct()


def unique_runs(stream: list[str], zones: list[int], covered: list[int], window: int) -> str:
    """The article's blocks, and the open blocks without the tokens that the windows at ``covered`` cover."""
    size = [len(b.split()) for b in stream]
    gone = np.zeros(sum(size) + 1, np.int64)
    for at in covered:
        gone[at] += 1
        gone[at + window] -= 1
    keep, out, at = np.cumsum(gone) == 0, [], 0
    for block, zone, n in zip(stream, zones, size, strict=True):
        if zone == MAIN:
            out.append(block)
        elif zone == OPEN:
            left = [w for w, k in zip(block.split(), keep[at : at + n].tolist(), strict=True) if k]
            if left:
                out.append(" ".join(left))
        at += n
    return "\n\n".join(out)


def main_text(pages: DataFrame, window: int = WINDOW) -> DataFrame:
    """page_id, url, text of every row."""
    spark = pages.sparkSession

    def hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([host_of(u) for u in batch.column("url").to_pylist()], pa.string()), batch.column("chars")], ["host", "chars"])

    lengths = with_python(pages).select(F.col("url").cast("string"), F.coalesce(F.length(F.col("html").cast("string")), F.lit(0)).cast("long").alias("chars"))
    bins = Bins(lengths.mapInArrow(hosts, "host string, chars long"))
    buckets = min(bins.count, max(2 * spark.sparkContext.defaultParallelism, bins.chars >> 24))
    # The texts are shuffled once; all that follows reads them bin by bin.
    with shuffles_deleted(spark):
        parsed = bucketed_table(bins.of_pages(parse(pages)).repartition(buckets, "bin"), "bin", buckets, "parsed")

    # What else a bin is told: pages that don't count (digest), or windows with the hashes of their first and last tokens.
    def told(df: DataFrame, **columns: Column) -> DataFrame:
        given = {"digest": F.lit(None).cast("binary"), "window": F.lit(None).cast("binary"), "head": F.lit(None).cast("long"), "tail": F.lit(None).cast("long")} | columns
        return df.select("bin", "host", *(c.alias(k) for k, c in given.items())).repartition(buckets, "bin")

    alike = written(near_copies(parsed), "copies")
    copies = told(bins.of_pages(alike), digest=F.col("digest"))
    ends = {k: F.col(k) for k in ("window", "head", "tail")}
    common = written(windows_of(parsed, window, copies, SHARE), "common")
    # What is common in some group of a large host is counted in all its groups.
    split = common.join(F.broadcast(bins.many), F.col("host") == F.col("mh"), "left_semi").select("host", *ends).distinct()
    again = told(bins.of_hosts(split), **ends).unionByName(copies).repartition(buckets, "bin")
    whole = common.join(F.broadcast(bins.many), F.col("host") == F.col("mh"), "left_anti").select("host", "window", "pages")
    pages_with = whole.unionByName(counted(parsed, again, window)).groupBy("host", "window").agg(F.sum("pages").alias("pages"))
    sizes = parsed.select("host", "digest").distinct().join(alike, ["host", "digest"], "left_anti").groupBy(F.col("host").alias("sh")).agg(F.count("*").alias("n"))
    often = pages_with.where(F.col("pages") >= LEAST).join(sizes, F.col("host") == F.col("sh")).where(F.col("pages") >= F.col("n") * SHARE).select(F.col("host").alias("h"), F.col("window").alias("w"))
    named = common.select("host", *ends).distinct()
    repeated = written(named.join(often, (F.col("host") == F.col("h")) & (F.col("window") == F.col("w"))).select("host", *ends), "repeated")

    def strip(some: pa.Table, notes: pa.Table) -> pa.Table:
        wanted, text = Wanted(notes, window), []
        for host, (stream, zones) in zip(some["host"].to_pylist(), blocks_in(some), strict=True):
            covered = [i for i, _ in wanted.places(host, " ".join(stream).split())]
            text.append(unique_runs(stream, zones, covered, window))
        return pa.table({"page_id": some["page_id"], "url": some["url"], "text": pa.array(text, pa.string())})

    def article(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text = ["\n\n".join(t for t, z in zip(*page, strict=True) if z == MAIN) for page in blocks_in(pa.Table.from_batches([batch]))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string())], ["page_id", "url", "text"])

    schema = "page_id long, url string, text string"
    undecided = parsed.where("open").select("bin", "page_id", "url", "host", "packed").groupBy("bin")
    rest = undecided.cogroup(told(bins.of_hosts(repeated), **ends).groupBy("bin")).applyInArrow(strip, schema)
    return parsed.where(~F.col("open")).select("page_id", "url", "packed").mapInArrow(article, schema).unionByName(rest)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
