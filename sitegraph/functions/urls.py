"""URL expressions (Catalyst Columns, no UDF).

Parsing is done with anchored regular expressions rather than
``parse_url``: the rules below follow ``java.net.URL``/``URI`` as the
crawler uses them, and the same text patterns run in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegraph.functions import patterns as P

SCHEME_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"
_HIER = r"^[a-zA-Z][a-zA-Z0-9+.-]*://"
HOST_RE = _HIER + r"(?:[^@/?#]*@)?(\[[^\]]*\]|[^:/?#]*)"
AUTHORITY_RE = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"
PATH_RE = _HIER + r"[^/?#]*([^?#]*)"
# A URL java.net.URI refuses: illegal characters, a second '#', bad escapes.
BAD_URI_RE = r"""[ "<>\\^`{|}\[\]]|#.*#|%(?:[^0-9a-fA-F]|[0-9a-fA-F][^0-9a-fA-F]|[0-9a-fA-F]?$)"""


def scheme(url: Column) -> Column:
    return F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)


def host(url: Column) -> Column:
    """Host of a hierarchical URL ('' when there is none)."""
    return F.regexp_extract(url, HOST_RE, 1)


def origin(url: Column) -> Column:
    """protocol://host, port dropped; NULL when the URL has no host part."""
    h = host(url)
    return F.when(url.rlike(_HIER), F.concat(F.lower(scheme(url)), F.lit("://"), h))


def path(url: Column) -> Column:
    return F.regexp_extract(url, PATH_RE, 1)


def _remove_dot_segments(p: Column) -> Column:
    """RFC 3986 dot-segment removal on a path starting with '/'."""
    p = F.regexp_replace(p, r"/\.\.?$", "$0/")
    segs = F.split(p, "/")
    init = F.array().cast("array<string>")

    def step(acc, x):
        return (F.when(x == ".", acc)
                .when(x == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1))
                      .otherwise(acc))
                .otherwise(F.concat(acc, F.array(x))))

    return F.array_join(F.aggregate(segs, init, step), "/")


def _dots(p: Column) -> Column:
    return F.when(p.rlike(r"(^|/)\.\.?(/|$)"), _remove_dot_segments(p)).otherwise(p)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` against page URL ``base``.

    Absolute references (any scheme, also javascript: and data:) are kept as
    written; '//x' takes the base scheme; '/p' the base authority; '?q' the
    base path; '#f' the base without its fragment; other paths are merged
    with the base directory.  Dot segments are removed from hierarchical
    results.
    """
    h = F.trim(href)
    b_auth = F.regexp_extract(base, AUTHORITY_RE, 1)
    b_nofrag = F.regexp_extract(base, r"^([^#]*)", 1)
    b_noquery = F.regexp_extract(base, r"^([^?#]*)", 1)
    b_path = path(base)
    b_dir = F.regexp_extract(b_path, r"^(.*/)", 1)
    h_path = F.regexp_extract(h, r"^([^?#]*)", 1)
    h_rest = F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    merged = F.concat(F.when(b_dir == "", F.lit("/")).otherwise(b_dir), h_path)
    return (F.when(h.rlike(SCHEME_RE), h)
            .when(h.startswith("//"), F.concat(scheme(base), F.lit(":"), h))
            .when(h.startswith("/"), F.concat(b_auth, _dots(h_path), h_rest))
            .when(h.startswith("?"), F.concat(b_noquery, h))
            .when(h.startswith("#"), F.concat(b_nofrag, h))
            .when(h == "", b_nofrag)
            .otherwise(F.concat(b_auth, _dots(merged), h_rest)))


def is_document(link: Column) -> Column:
    """Link path ends in one of the document extensions (case-insensitive)."""
    cut = F.lower(F.regexp_extract(link, r"^([^?#]*)", 1))
    ext = F.regexp_extract(cut, r"\.([a-z0-9]{1,5})$", 1)
    return F.coalesce(ext.isin(P.DOCUMENT_EXTENSIONS), F.lit(False))


def is_external(page_url: Column, link: Column) -> Column:
    """The page host does not occur anywhere in the link text."""
    return ~link.contains(host(page_url))


def is_reference(page_url: Column, link: Column) -> Column:
    """Same scheme, host and path as the page, and the link has a fragment."""
    ok = link.rlike(_HIER) & ~link.rlike(BAD_URI_RE) & ~page_url.rlike(BAD_URI_RE)
    return F.coalesce(
        ok & (scheme(page_url) == scheme(link)) & (host(page_url) == host(link))
        & (path(page_url) == path(link)) & link.contains("#"),
        F.lit(False))


def link_kind(page_url: Column, link: Column) -> Column:
    """Class of an <a href> link: documents, external, reference or internal."""
    return (F.when(is_document(link), F.lit("documents"))
            .when(is_external(page_url, link), F.lit("external"))
            .when(is_reference(page_url, link), F.lit("reference"))
            .otherwise(F.lit("internal")))


def url_filter(link: Column, patterns: list[str] | None, logic: str | None) -> Column:
    """True when the link survives the include/exclude pattern filter.

    Patterns must match the whole link.  No logic or no patterns: all pass.
    """
    if not logic or not patterns:
        return F.lit(True)
    whole = "^(?:" + "|".join("(?:" + p + ")" for p in patterns) + r")\z"
    hit = link.rlike(whole)
    if logic.lower() == "include":
        return hit
    if logic.lower() == "exclude":
        return ~hit
    raise ValueError(f"url filter logic must be include or exclude, not {logic!r}")


def _encode_chunks(u: Column) -> Column:
    """Percent-encode non-ASCII characters (UTF-8) and the characters a URI
    may not hold; everything else is kept as written."""
    chunks = F.regexp_extract_all(u, F.lit(r"[^\x00-\x7F]+|[\x00-\x7F]+"), 0)
    illegal = {" ": "%20", '"': "%22", "<": "%3C", ">": "%3E", "\\": "%5C",
               "^": "%5E", "`": "%60", "{": "%7B", "|": "%7C", "}": "%7D"}

    def enc(c):
        ascii_part = c
        for k, v in illegal.items():
            ascii_part = F.replace(ascii_part, F.lit(k), F.lit(v))
        return F.when(c.rlike(r"^[\x00-\x7F]"), ascii_part).otherwise(F.url_encode(c))

    return F.array_join(F.transform(chunks, enc), "")


def _encode_rest(u: Column) -> Column:
    """A ``%`` that starts no escape becomes ``%25``, and ``[ ]`` outside the authority are encoded."""
    parts = F.split(u, "%", -1)
    fixed = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.concat(
        F.when(p.rlike("^[0-9a-fA-F]{2}"), F.lit("%")).otherwise(F.lit("%25")), p))
    pct = F.concat(parts[0], F.array_join(fixed, ""))
    head = F.regexp_extract(pct, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?", 0)
    rest = F.replace(F.replace(F.substr(pct, F.length(head) + 1), F.lit("["), F.lit("%5B")), F.lit("]"), F.lit("%5D"))
    return F.concat(head, rest)


def clean_url(url: Column) -> Column:
    """Crawl key of a URL: '##+' -> '#', fragment dropped, non-ASCII and
    illegal characters percent-encoded; case, slashes, query order and
    existing escapes untouched.  Opaque URLs (mailto:, javascript:) give
    NULL: they cannot be crawled."""
    u = F.regexp_replace(F.trim(url), "##+", "#")
    u = F.regexp_extract(u, r"^([^#]*)", 1)
    enc = F.when(u.rlike("[^\\x21-\\x7E]|[\"<>\\\\^`{|}]"), _encode_chunks(u)).otherwise(u)
    enc = F.when(u.rlike(r"[%\[\]]"), _encode_rest(enc)).otherwise(enc)
    return F.when(u.rlike(_HIER) | ~u.rlike(SCHEME_RE), enc)


# Bytes that URL_PRESERVED brings back after encoding.
_RESTORED = {"%{:02X}".format(ord(c)): c for c in P.URL_PRESERVED}


def encode_component(part: Column) -> Column:
    """One URL component: form encoding with %20 for spaces, the preserved characters as written."""
    out = F.replace(F.url_encode(part), F.lit("+"), F.lit("%20"))
    for escape, c in _RESTORED.items():
        out = F.replace(out, F.lit(escape), F.lit(c))
    return out


def file_extension(name: Column) -> Column:
    """Text after the last '.', '' if none or if the name ends with '.'."""
    return F.regexp_extract(name, r"\.([^.]+)$", 1)


def mime_type(name: Column) -> Column:
    m = F.create_map(*[x for k, v in sorted(P.MIME_TYPES.items()) for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, F.lower(file_extension(name))), F.lit(P.DEFAULT_MIME))


def embedded_url(url: Column) -> Column:
    """Decoded value of a 'url=' query parameter (one '=' exactly), else the URL."""
    q = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    params = F.split(q, "&")
    # java's split drops trailing empty parts: 'url=x=' still has two parts
    vals = F.transform(params, lambda p: F.when(p.startswith("url="),
                                                F.regexp_replace(F.substring(p, 5, 1 << 30), "=+$", "")))
    hits = F.filter(vals, lambda v: (v != "") & ~v.contains("="))
    v = F.try_url_decode(F.try_element_at(hits, F.lit(1)))
    return F.when((q != "") & (F.size(hits) > 0) & v.isNotNull(), v).otherwise(url)


def image_file_name(url: Column) -> Column:
    """Last path segment up to '?'; '.jpg' appended when it has no dot."""
    name = F.regexp_extract(F.regexp_extract(url, r"^([^?]*)", 1), r"([^/]*)$", 1)
    return F.when(name.contains("."), name).otherwise(F.concat(name, F.lit(".jpg")))


def sanitize_file_name(title: Column) -> Column:
    """File-system safe name: \\ / : * ? " < > | -> '_', spaces removed."""
    return F.replace(F.translate(title, '\\/:*?"<>|', "_________"), F.lit(" "), F.lit(""))


def escape_xml(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def priority(depth: Column) -> Column:
    """Sitemap priority of a depth: clamp(1 - 0.1 * depth, 0, 1), one decimal."""
    tenths = F.greatest(F.lit(0), F.least(F.lit(10), F.lit(10) - depth.cast("int")))
    return F.when(tenths == 10, F.lit("1.0")).otherwise(F.concat(F.lit("0."), tenths.cast("string")))
