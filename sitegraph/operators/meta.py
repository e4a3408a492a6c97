"""Meta tags of a page (row-local).

A ``<meta>`` element is kept when its content is non-empty and it has a
non-empty name or property; property wins over name.  Document order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegraph.functions import html as H

META_TYPE = "array<struct<name:string,property:string,content:string>>"


def meta_array(clean: Column) -> Column:
    """``array<struct<name, property, content>>``; exactly one of name and
    property is set in each element."""
    tags = H.start_tags(clean, "meta")

    def one(t):
        name = F.coalesce(H.attr(t, "name"), F.lit(""))
        prop = F.coalesce(H.attr(t, "property"), F.lit(""))
        content = F.coalesce(H.attr(t, "content"), F.lit(""))
        return F.struct(F.when(prop == "", name).alias("name"),
                        F.when(prop != "", prop).alias("property"),
                        F.when(((name != "") | (prop != "")) & (content != ""), content).alias("content"))

    return F.filter(F.transform(tags, one), lambda s: s["content"].isNotNull())


def page_meta_tags(pages_df: DataFrame) -> DataFrame:
    """Long form: ``page_id, url, pos, name, property, content``."""
    df = pages_df.select("page_id", "url", meta_array(H.clean_html(F.col("html"))).alias("m"))
    return df.select("page_id", "url", F.posexplode("m").alias("pos", "t")).select(
        "page_id", "url", F.col("pos").cast("bigint").alias("pos"),
        "t.name", "t.property", "t.content")


def meta_tags_json(pages_df: DataFrame) -> DataFrame:
    """``page_id, json``: the meta tag array as the reference returns it
    (each object has ``property`` or ``name``, and ``content``)."""
    m = meta_array(H.clean_html(F.col("html")))
    return pages_df.select("page_id", F.to_json(m).alias("json"))
