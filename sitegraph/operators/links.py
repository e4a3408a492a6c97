"""Link extraction and classification (row-local: no shuffle).

For every page the ``a[href]``, ``iframe[src]`` and ``img[src]`` attributes
are pulled out of the markup, made absolute against the page's base URL, passed
through the optional include/exclude pattern filter, de-duplicated inside
the row (first occurrence wins) and classified.  The result is an array of
``struct<kind, link, pos>`` per page; the long form is its ``inline``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegraph.functions import html as H
from sitegraph.functions import urls as U

A_KINDS = ["documents", "external", "reference", "internal"]
ALL_KINDS = A_KINDS + ["iframe", "images"]
# Insight kinds a caller may ask for (ALL or one of them).
INSIGHT_KINDS = {
    "all": ALL_KINDS, "documents": ["documents"], "internal": ["internal"],
    "external": ["external"], "reference": ["reference"], "iframe": ["iframe"],
    "images": ["images"], "element_counts": [],
}


def _attr_links(clean: Column, base: Column, tag: str, attribute: str,
                patterns, logic) -> Column:
    tags = H.start_tags(clean, tag)
    raw = F.filter(F.transform(tags, lambda t: H.attr(t, attribute)), lambda v: v.isNotNull())
    absolute = F.transform(raw, lambda h: U.resolve_url(base, h))
    kept = F.filter(absolute, lambda l: U.url_filter(l, patterns, logic))
    return F.array_distinct(kept)


def base_url(url: Column, clean: Column) -> Column:
    """What a page's links are resolved and judged against: its first ``<base href>``, else its URL."""
    hrefs = F.filter(F.transform(H.start_tags(clean, "base"), lambda t: H.attr(t, "href")),
                     lambda v: v.isNotNull() & (F.trim(v) != ""))
    first = H.let(F.try_element_at(hrefs, F.lit(1)), lambda h: F.when(h.isNotNull(), U.resolve_url(url, h)).otherwise(url))
    return F.when(clean.rlike("(?i)<base[ \t\n\r\f/]"), first).otherwise(url)


def _with_pos(arr: Column, kind_fn) -> Column:
    return F.transform(arr, lambda l, i: F.struct(kind_fn(l).alias("kind"), l.alias("link"),
                                                  i.cast("int").alias("pos")))


def link_array(url: Column, clean: Column, kinds: list[str] | None = None,
               url_patterns: list[str] | None = None, url_logic: str | None = None) -> Column:
    """``array<struct<kind, link, pos>>`` of a page's distinct links.

    ``pos`` is the order of first appearance among the links of the same
    element type (a, iframe or img).
    """
    kinds = ALL_KINDS if kinds is None else kinds
    parts = []
    if any(k in A_KINDS for k in kinds):
        a = _attr_links(clean, url, "a", "href", url_patterns, url_logic)
        parts.append(_with_pos(a, lambda l: U.link_kind(url, l)))
    if "iframe" in kinds:
        fr = _attr_links(clean, url, "iframe", "src", url_patterns, url_logic)
        parts.append(_with_pos(fr, lambda l: F.lit("iframe")))
    if "images" in kinds:
        im = _attr_links(clean, url, "img", "src", url_patterns, url_logic)
        parts.append(_with_pos(im, lambda l: F.lit("images")))
    if not parts:
        return F.array().cast("array<struct<kind:string,link:string,pos:int>>")
    allk = parts[0] if len(parts) == 1 else F.concat(*parts)
    if set(kinds) >= set(A_KINDS):
        return allk
    return F.filter(allk, lambda s: s["kind"].isin(kinds))


def with_links(pages_df: DataFrame, kinds: list[str] | None = None,
               url_patterns: list[str] | None = None, url_logic: str | None = None,
               col: str = "links") -> DataFrame:
    """Add the ``links`` array column to a page DataFrame."""
    clean = H.clean_html(F.col("html"))
    return pages_df.withColumn(col, page_link_array(F.col("url"), clean, kinds, url_patterns, url_logic))


def page_link_array(url: Column, clean: Column, kinds: list[str] | None = None,
                    url_patterns: list[str] | None = None, url_logic: str | None = None) -> Column:
    """``link_array`` against the page's base URL, which is worked out once (a lambda variable: the
    optimizer would copy a column into each of its uses)."""
    return H.let(F.struct(base_url(url, clean).alias("base"), clean.alias("clean")),
                 lambda x: link_array(x["base"], x["clean"], kinds, url_patterns, url_logic))


def page_links(pages_df: DataFrame, kinds: list[str] | str | None = None,
               url_patterns: list[str] | None = None, url_logic: str | None = None) -> DataFrame:
    """Long form: one row per (page, kind, distinct link)."""
    if isinstance(kinds, str):
        kinds = INSIGHT_KINDS[kinds.lower()]
    df = with_links(pages_df.select("page_id", "url", "html"), kinds, url_patterns, url_logic)
    return (df.select("page_id", "url", F.inline("links"))
            .select("page_id", "url", "kind", "link", "pos"))


def _kind_is(k: str):
    return lambda s: s["kind"] == k


def link_counts(links: Column) -> dict[str, Column]:
    """Distinct link counts per counted kind (documents are not counted)."""
    return {k: F.size(F.filter(links, _kind_is(k))).cast("bigint")
            for k in ["internal", "external", "reference", "iframe", "images"]}


def link_sets(links: Column) -> dict[str, Column]:
    """Sorted distinct link array per kind."""
    return {k: F.array_sort(F.transform(F.filter(links, _kind_is(k)),
                                        lambda s: s["link"]))
            for k in ALL_KINDS}


def crawl_links(links: Column, restrict: bool) -> Column:
    """Links a crawl follows: internal only when restricted, else internal,
    external and iframe links.  Never documents, references or images."""
    follow = ["internal"] if restrict else ["internal", "external", "iframe"]
    return F.array_distinct(F.transform(F.filter(links, lambda s: s["kind"].isin(follow)),
                                        lambda s: s["link"]))
