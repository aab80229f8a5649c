"""HTML -> markdown / clean html / links as native column expressions.

Each conversion is an ordered list of regex rewrites written in the subset
that Java regex and RE2 share (no lookaround, no back-references in
patterns), so the same rules run inside Spark's codegen and in the DuckDB
oracle.  Replacement groups are written ``{1}``.  Scripts are removed first:
the captured pages put ``</p>`` inside script strings.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

Step = tuple[str, str]  # (regex, replacement) or ("=" + literal, replacement)

CLEAN_STEPS: list[Step] = [
    (r"(?is)<script[^>]*>.*?</script>", ""),
    (r"(?is)<style[^>]*>.*?</style>", ""),
    (r"(?s)<!--.*?-->", ""),
]

# The HTML entities decoded in text output (``&amp;`` last).
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]

BLOCK_TAGS = "p|div|ul|ol|nav|article|section|footer|header|main|aside|table|tr|blockquote|pre"

MARKDOWN_STEPS: list[Step] = (
    CLEAN_STEPS
    + [(r"(?is)<head[^>]*>.*?</head>", "")]
    + [(rf"(?is)<h{n}( [^>]*)?>(.*?)</h{n}>", "\n" + "#" * n + " {2}\n") for n in range(1, 7)]
    + [
        (r'(?is)<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>', "[{2}]({1})"),
        (r"(?i)<li( [^>]*)?>", "\n- "),
        (r"(?i)<br[^>]*>", "\n"),
        (rf"(?i)</?({BLOCK_TAGS})( [^>]*)?>", "\n"),
        (r"<[^>]+>", ""),
    ]
    + [("=" + a, b) for a, b in ENTITIES]
    + [
        (r"[ \t\r\f]+", " "),
        (r" ?\n ?", "\n"),
        (r"\n{3,}", "\n\n"),
        (r"^[ \n]+|[ \n]+$", ""),
    ]
)

TEXT_STEPS: list[Step] = (
    CLEAN_STEPS
    + [(r"<[^>]+>", " ")]
    + [("=" + a, b) for a, b in ENTITIES]
    + [(r"[ \t\r\n\f]+", " "), (r"^ +| +$", "")]
)

LINK_PATTERN = r'(?is)<a [^>]*href="([^"]*)"'
TITLE_PATTERN = r"(?is)<title[^>]*>(.*?)</title>"
H1_PATTERN = r"(?is)<h1[^>]*>(.*?)</h1>"
LANG_PATTERN = r'(?is)<html[^>]*lang="([^"]*)"'
PARAGRAPH_PATTERN = r"(?is)<p( [^>]*)?>(.*?)</p>"
BASE64_IMG_PATTERN = r'(?i)<img[^>]*src="data:image/[^"]*"[^>]*>'

# Class names that mark ad containers.
AD_MARKERS = ["ad", "ads", "advert", "sponsored"]


def ad_pattern(markers: list[str] = AD_MARKERS) -> str:
    alt = "|".join(re.escape(m) for m in markers)
    return rf'(?is)<div[^>]*class="(({alt})|({alt}) [^"]*|[^"]* ({alt})|[^"]* ({alt}) [^"]*)"[^>]*>.*?</div>'


def tag_block_pattern(tags: list[str]) -> str:
    return "(?is)(" + "|".join(rf"<{t}( [^>]*)?>.*?</{t}>" for t in tags) + ")"


def _java_repl(r: str) -> str:
    return re.sub(r"\{(\d)\}", r"$\1", r.replace("\\", "\\\\").replace("$", "\\$"))


def apply_steps(col: Column, steps: list[Step]) -> Column:
    for pat, repl in steps:
        if pat.startswith("="):
            col = F.replace(col, F.lit(pat[1:]), F.lit(repl))
        else:
            col = F.regexp_replace(col, pat, _java_repl(repl))
    return col


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def apply_steps_sql(expr: str, steps: list[Step]) -> str:
    """The same rewrites as DuckDB SQL (oracle side)."""
    for pat, repl in steps:
        if pat.startswith("="):
            expr = f"replace({expr}, {_sql_lit(pat[1:])}, {_sql_lit(repl)})"
        else:
            r = re.sub(r"\{(\d)\}", r"\\\1", repl)
            expr = f"regexp_replace({expr}, {_sql_lit(pat)}, {_sql_lit(r)}, 'g')"
    return expr


def markdown(html: Column) -> Column:
    return apply_steps(html, MARKDOWN_STEPS)


def clean_html(html: Column) -> Column:
    return apply_steps(html, CLEAN_STEPS)


def plain_text(html: Column) -> Column:
    return apply_steps(html, TEXT_STEPS)


def strip_inline(fragment: Column) -> Column:
    """Text of an inline fragment: tags dropped, entities decoded, spaces collapsed."""
    return apply_steps(fragment, TEXT_STEPS[len(CLEAN_STEPS):])


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(LINK_PATTERN), F.lit(1))
