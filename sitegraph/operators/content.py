"""Page content: TEXT, HTML and MARKDOWN outputs, whole page or by selectors.

* TEXT, no selectors: the page text (row-local, ``html.text_of``).
* TEXT, selectors: for each selector in list order, each matching element in
  document order adds its text and one space unless it lies inside an
  element taken before it; the result is trimmed.  (An element hit by two
  selectors is added twice; a parent taken after its child repeats it.)
* HTML: the markup of the first element of the first selector that matches;
  no selectors or no match: the whole page.
* MARKDOWN: the HTML output converted by ``markdown``.

Elements come from the page's own tree (``dom``), so every format is one pass
inside the scan's stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegraph.functions import html as H
from sitegraph.operators import dom

FORMATS = ("text", "html", "markdown")


def selector_counts(pages_df: DataFrame, selectors: list[str]) -> DataFrame:
    """``page_id`` plus one count column per selector (descendant selectors allowed)."""
    d = dom.with_dom(pages_df.select("page_id", "html"), counts=selectors)
    return d.select("page_id", *[F.col("_counts")[i].alias(s) for i, s in enumerate(selectors)])


def selected_text(pages_df: DataFrame, selectors: list[str]) -> DataFrame:
    """TEXT by selectors: ``page_id, content`` for every page."""
    d = dom.with_dom(pages_df.select("page_id", "html"), text=selectors)
    return d.select("page_id", F.col("_text").alias("content"))


def first_match_html(pages_df: DataFrame, selectors: list[str] | None) -> DataFrame:
    """HTML output: ``page_id, content``: markup of the first element of the
    first matching selector, else the whole page."""
    if not selectors:
        return pages_df.select("page_id", F.col("html").alias("content"))
    d = dom.with_dom(pages_df.select("page_id", "html"), first=selectors)
    return d.select("page_id", F.col("_first").alias("content"))


def with_content(pages_df: DataFrame, fmt: str = "text", selectors: list[str] | None = None) -> DataFrame:
    """``pages_df`` with ``title`` and ``content`` in TEXT, HTML or MARKDOWN; row-local, so it runs on a stream too.

    Columns of these names are replaced."""
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    clean = H.clean_html(F.col("html"))
    df, content = pages_df.drop("title", "content"), F.col("html")
    if not selectors and fmt == "text":
        content = H.text_of(clean)
    elif selectors or fmt == "markdown":
        asked = {"text": {"text": selectors}, "html": {"first": selectors}, "markdown": {"first": selectors or [], "markdown": True}}[fmt]
        df = dom.with_dom(df, **asked)
        content = F.col({"text": "_text", "html": "_first", "markdown": "_markdown"}[fmt])
    return df.withColumns({"title": H.title_of(clean), "content": content}).drop("_text", "_first", "_markdown")


def page_content(pages_df: DataFrame, fmt: str = "text", selectors: list[str] | None = None) -> DataFrame:
    """Page record ``page_id, url, title, content`` in TEXT, HTML or MARKDOWN."""
    return with_content(pages_df.select("page_id", "url", "html"), fmt, selectors).select("page_id", "url", "title", "content")
