"""Euler tour of crawl trees: subtrees as ranges of numbers.

A node's ``enter`` is its place in pre-order within its root, ``leave`` the last place of
its subtree.  Descendants, reach and the text of a subtree are then range predicates, with
no walk.  Places are prefix sums over range-partitioned slices (``plans.rank``), subtree
sizes a partial aggregate over each node's own ancestors (its path, at most ``max_depth``
long), so no site is held by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegraph.plans.crawl import with_paths
from sitegraph.plans.rank import split_row_number
from sitegraph.plans.sitemap import sort_key


def euler_tour(nodes: DataFrame) -> DataFrame:
    """``root_url, url, depth, enter, leave, size, reach`` per node: size counts the subtree with the node,
    reach is how many levels it goes down."""
    n = with_paths(nodes).select("root_url", "url", "depth", "path", sort_key().alias("_key"))
    below = (n.select("root_url", F.explode("path").alias("url"), "depth").groupBy("root_url", "url")
             .agg(F.count("*").alias("size"), F.max("depth").alias("_deepest")))
    placed = split_row_number(n.drop("path"), ["root_url"], ["_key"], "enter")
    out = placed.join(below, ["root_url", "url"])
    return out.select("root_url", "url", "depth", "enter", (F.col("enter") + F.col("size") - 1).alias("leave"), "size",
                      (F.col("_deepest") - F.col("depth")).cast("int").alias("reach"))


def descendants(tour: DataFrame, of: DataFrame) -> DataFrame:
    """``root_url, ancestor, url, depth`` of all nodes below the nodes ``of`` (root_url, url), by ranges.

    Joined by root and slice of places: a subtree's range is cut into the slices it covers,
    so a large site meets its ranges in many tasks."""
    width = 4096
    ranges = tour.join(of.select("root_url", "url"), ["root_url", "url"], "left_semi").select(
        "root_url", F.col("url").alias("ancestor"), F.col("enter").alias("_from"), F.col("leave").alias("_to"),
        F.explode(F.sequence(F.floor(F.col("enter") / width), F.floor(F.col("leave") / width))).alias("_slice"))
    at = tour.withColumn("_slice", F.floor(F.col("enter") / width))
    return (at.join(ranges, ["root_url", "_slice"]).where("enter > _from AND enter <= _to")
            .select("root_url", "ancestor", "url", "depth"))
