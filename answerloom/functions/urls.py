"""URL expressions, following the component pattern of RFC 3986 appendix B.

Plain regular expressions are used instead of a URL parser: crawled links are
often malformed, and a parser error would fail the whole job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from answerloom.functions.markup import decode_entities

# URL component patterns.
SCHEME = r"\A([A-Za-z][A-Za-z0-9+.\-]*):"
AUTHORITY = r"\A[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
PATH = r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
# An anchor with its href in one of three quotings; the name is a whole attribute, not the end of another.
ANCHOR = r"(?i)<a\s(?:[^>]*?[\s\"'])??href\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
TARGET = r"(?is)href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))\z"
UNSEEN = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, SCHEME, 1))


def url_host(url: Column) -> Column:
    """Host without user and port, lower case."""
    authority = F.regexp_extract(url, AUTHORITY, 1)
    return F.lower(F.regexp_replace(authority, r"\A.*@|:[0-9]*\z", ""))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, PATH, 1)


def page_links(html: Column) -> Column:
    """All link targets of the anchors in a page, entities decoded; comments, scripts and styles hold none."""
    anchors = F.regexp_extract_all(F.regexp_replace(html, UNSEEN, " "), F.lit(ANCHOR), F.lit(0))
    return F.transform(anchors, lambda a: decode_entities(F.concat(
        *[F.regexp_extract(a, TARGET, group) for group in (1, 2, 3)])))


def page_file_name(url: Column) -> Column:
    """File name a crawled page is saved under: its path with underscores."""
    path = F.regexp_replace(url_path(url), r"\A/+|/+\z", "")
    return F.concat(F.regexp_replace(path, "/", "_"), F.lit(".html"))


def remove_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` inside a path."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(s))),
    )
    # A trailing "." or ".." names a directory, so it keeps its final slash.
    return F.concat(
        F.array_join(kept, "/"),
        F.when(path.rlike(r"(\A|/)\.{1,2}\z") & (F.size(kept) > 0), "/").otherwise(""),
    )


def resolve_url(base: Column, href: Column) -> Column:
    """The absolute URL a link on the page ``base`` points to."""
    root = F.regexp_extract(base, r"\A([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    no_fragment = F.regexp_extract(base, r"\A([^#]*)", 1)
    no_query = F.regexp_extract(base, r"\A([^?#]*)", 1)
    folder = F.regexp_extract(url_path(base), r"\A(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    link_path = F.regexp_extract(href, r"\A([^?#]*)", 1)
    link_rest = F.regexp_extract(href, r"\A[^?#]*(.*)\z", 1)

    def dotted(path: Column) -> Column:
        return F.when(path.contains("/."), remove_dot_segments(path)).otherwise(path)

    return (
        F.when(href.rlike(SCHEME), href)
        .when(href.startswith("//"), F.concat(url_scheme(base), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, dotted(link_path), link_rest))
        .when(href == "", no_fragment)
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .otherwise(F.concat(root, dotted(F.concat(folder, link_path)), link_rest))
    )
