"""Page insights: element counts, link counts, word count, title, links.

Everything is computed inside the page row, so the plan is a single
scan-and-project stage: no exchange, no join, whatever the number of pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegraph.functions import html as H
from sitegraph.functions import patterns as P
from sitegraph.functions import selectors as S
from sitegraph.operators import dom
from sitegraph.operators import links as L
from sitegraph.operators.status import page_status


def page_insights(pages_df: DataFrame, selectors: list[str] | None = None, kinds: str = "all",
                  url_patterns: list[str] | None = None, url_logic: str | None = None,
                  with_link_sets: bool = True) -> DataFrame:
    """One row per page: ``page_id, url, title``, a count per selector
    (default div, p, h1-h5), distinct link counts per kind, ``word_count``
    and (optionally) the sorted link arrays per kind.

    ``kinds`` picks one insight kind (ALL, documents, internal, external,
    reference, iframe, images, element_counts) as the reference does; for
    element_counts no links are read, so their counts are 0.  ``status`` is
    ``bad_page`` where the page was not read or its URL gives no base to judge
    links by; such a row has no counts and no links.
    """
    kind = kinds.lower()
    if kind not in L.INSIGHT_KINDS:
        raise ValueError(f"unknown insight kind {kinds!r}")
    want_links = L.INSIGHT_KINDS[kind]
    want_counts = kind in ("all", "element_counts")
    clean = H.clean_html(F.col("html"))
    df = pages_df.select("page_id", "url", "html")
    nested = [t for t in selectors or [] if S.has_descendant(t)]
    if want_counts and selectors:  # descendant selectors and selected text need the page's tree
        df = dom.with_dom(df, text=selectors, counts=nested)
    df = df.withColumn("_clean", clean)
    df = df.withColumn("_links", L.page_link_array(F.col("url"), F.col("_clean"), want_links,
                                                   url_patterns, url_logic))
    good = page_status(F.col("url"), F.col("html")) == "ok"
    cols = [F.col("page_id"), F.col("url"), H.title_of(F.col("_clean")).alias("title")]
    if want_counts:
        tags = selectors if selectors else P.DEFAULT_COUNT_TAGS
        cols += [F.when(good, S.element_count(F.col("_clean"), t)).alias(t)
                 for t in tags if t not in nested]
        cols += [F.when(good, c).alias(k) for k, c in L.link_counts(F.col("_links")).items()]
        if not selectors:
            cols.append(F.when(good, H.word_count(H.text_of(F.col("_clean")))).alias("word_count"))
    if with_link_sets and want_links:
        sets = L.link_sets(F.col("_links"))
        cols += [F.when(good, sets[k]).alias(f"{k}_links") for k in want_links]
    if want_counts and selectors:
        cols += [F.when(good, F.col("_counts")[i]).alias(t) for i, t in enumerate(nested)]
        cols.append(F.when(good, H.word_count(F.col("_text"))).alias("word_count"))
    cols.append(page_status(F.col("url"), F.col("html")).alias("status"))
    return df.select(*cols)


def insights_json(insights_df: DataFrame, selectors: list[str] | None = None) -> DataFrame:
    """``page_id, json`` in the shape of the reference's insight response:
    ``{"pageStats": {<selector counts>, internal, external, reference, iframe,
    images, wordCount}, "links": {documents, internal, external, reference,
    iframe, images}, "title", "url"}`` (parts not computed are left out)."""
    tags = selectors if selectors else P.DEFAULT_COUNT_TAGS
    cols = set(insights_df.columns)
    stats = [F.col(f"`{t}`").alias(t) for t in tags if t in cols]
    stats += [F.col(k).alias(k) for k in ["internal", "external", "reference", "iframe", "images"] if k in cols]
    if "word_count" in cols:
        stats.append(F.col("word_count").alias("wordCount"))
    links = [F.col(f"{k}_links").alias(k) for k in L.ALL_KINDS if f"{k}_links" in cols]
    parts = []
    if stats:
        parts.append(F.struct(*stats).alias("pageStats"))
    if links:
        parts.append(F.struct(*links).alias("links"))
    parts += [F.col("title").alias("title"), F.col("url").alias("url")]
    return insights_df.select("page_id", F.to_json(F.struct(*parts)).alias("json"))
