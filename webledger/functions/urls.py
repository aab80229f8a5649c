"""URL column expressions (regex subset shared by Java regex and RE2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEME_HOST = r"^([a-z][a-z0-9+.-]*://[^/?#]+)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://([^/?#]+)", 1))


def origin(url: Column) -> Column:
    return F.regexp_extract(url, SCHEME_HOST, 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://[^/?#]+([^?#]*)", 1)


def site_of(url: Column) -> Column:
    """Host without a leading ``www.``, ``m.`` or ``blog.`` label."""
    return F.regexp_replace(host(url), r"^(www|m|blog)\.", "")


def trim_url(url: Column) -> Column:
    """Trim, drop trailing slashes; blank becomes null (the reference's API URL rule)."""
    t = F.regexp_replace(F.trim(url), "/+$", "")
    return F.when(t == "", F.lit(None)).otherwise(t)


def resolve(base: Column, href: Column) -> Column:
    """Resolve an anchor against the page URL: absolute, scheme-relative,
    root-relative, query/fragment-only, or relative to the base directory."""
    base_dir = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"/[^/]*$", "/")
    base_nofrag = F.regexp_replace(base, r"#.*$", "")
    scheme = F.regexp_extract(base, r"^([a-z][a-z0-9+.-]*):", 1)
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin(base), href))
        .when(href.startswith("#"), F.concat(base_nofrag, href))
        .when(href.startswith("?"), F.concat(F.regexp_replace(base, r"[?#].*$", ""), href))
        .otherwise(F.concat(F.when(base_dir.rlike(r"^[a-z][a-z0-9+.-]*://[^/]+/"), base_dir)
                            .otherwise(F.concat(base, F.lit("/"))), href))
    )


# Characters ``encodeURIComponent`` leaves as they are besides
# letters and digits (Java's encoder escapes some of them, and a space as "+").
_UNRESERVED_MARKS = [("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~"), ("%2A", "*")]


def encode_component(c: Column) -> Column:
    """Percent-encode one path or query component like ``encodeURIComponent``
    (a space is ``%20``, not ``+``)."""
    out = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    for esc, ch in _UNRESERVED_MARKS:
        out = F.replace(out, F.lit(esc), F.lit(ch))
    return out
