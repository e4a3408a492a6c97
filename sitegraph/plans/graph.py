"""Link graph over the page store: every page's links, canonicalised and
resolved to the stored page they point at (if any)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegraph.functions import urls as U
from sitegraph.operators import links as L


def page_keys(pages_df: DataFrame) -> DataFrame:
    """``k, page_id``: crawl key of each stored URL (smallest page_id wins)."""
    return (pages_df.select(U.clean_url(F.col("url")).alias("k"), "page_id")
            .where("k IS NOT NULL").groupBy("k").agg(F.min("page_id").alias("page_id")))


def link_graph(pages_df: DataFrame) -> DataFrame:
    """``src_page_id, kind, dst, dst_page_id`` (-1 when the target is not stored).

    The join is on the canonical target URL; a target linked from a large
    share of pages is a skewed key, which AQE's skew join splits."""
    e = (L.page_links(pages_df).select(F.col("page_id").alias("src_page_id"), "kind",
                                       U.clean_url(F.col("link")).alias("dst"))
         .where("dst IS NOT NULL").distinct())
    keys = page_keys(pages_df).withColumnRenamed("page_id", "dst_page_id")
    return (e.join(keys, e["dst"] == keys["k"], "left")
            .select("src_page_id", "kind", "dst", F.coalesce("dst_page_id", F.lit(-1).cast("bigint"))
                    .alias("dst_page_id")))
