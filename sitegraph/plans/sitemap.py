"""Sitemaps, site trees and their summaries from crawl nodes.

Order: the reference writes the tree in pre-order, children in insertion
order.  We order children by URL (the reference's order is hash-set order),
so pre-order is the sort order of the node's root-to-node ``path``.  Paths are
turned into a string key joined with U+0001 (below every URL character), whose
byte order equals the array order.  XML fragments are written per node and
ordered by a global sort at the sink: no per-root collection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegraph.functions import patterns as P
from sitegraph.functions import urls as U

SEP = "\u0001"


def sort_key(path_col: str = "path"):
    return F.array_join(F.col(path_col), SEP)


def url_fragment(loc, priority):
    return F.concat(F.lit("  <url>\n    <loc>"), U.escape_xml(loc), F.lit("</loc>\n    <priority>"),
                    priority, F.lit("</priority>\n  </url>\n"))


def sitemap_entries(map_nodes: DataFrame) -> DataFrame:
    """``root_url, loc, depth, priority, sort_key, xml`` per sitemap entry."""
    from sitegraph.plans.crawl import with_paths
    return with_paths(map_nodes).select(
        "root_url", F.col("url").alias("loc"), "depth", U.priority(F.col("depth")).alias("priority"),
        sort_key().alias("sort_key"),
        url_fragment(F.col("url"), U.priority(F.col("depth"))).alias("xml"))


def sitemap_summary(map_nodes: DataFrame, max_depth: int, roots: DataFrame | None = None) -> DataFrame:
    """Response attributes of get-sitemap: url, entry count, requested depth,
    deepest level reached, status.

    With ``roots`` (root_url) every root has a row.  A root without entries
    gave none because its page failed: at depth 0 that is an empty sitemap
    (``ok``, count 0), deeper the crawl itself fails (``root_failed``).
    """
    s = map_nodes.groupBy("root_url").agg(F.count("*").alias("url_count"), F.max("depth").cast("int").alias("reached_depth"))
    if roots is not None:
        s = roots.select("root_url").distinct().join(s, "root_url", "left")
    failed = F.col("url_count").isNull() & F.lit(int(max_depth) > 0)
    return s.select("root_url", F.coalesce("url_count", F.lit(0)).cast("bigint").alias("url_count"),
                    F.lit(int(max_depth)).alias("max_depth"), "reached_depth",
                    F.when(failed, F.lit("root_failed")).otherwise(F.lit("ok")).alias("status"))


def site_children(nodes: DataFrame) -> DataFrame:
    """``root_url, parent_url, child_url, ord``: children of each node in
    order (by URL).  Window groups are the out-links of one page."""
    w = Window.partitionBy("root_url", "parent_url").orderBy("url")
    return (nodes.where(F.col("parent_url").isNotNull())
            .select("root_url", "parent_url", F.col("url").alias("child_url"),
                    (F.row_number().over(w) - 1).cast("bigint").alias("ord")))


def sitemap_folder(root_url):
    """Folder name of a root's sitemap: readable, and told apart from like names by a hash of the root URL."""
    return F.concat(F.regexp_replace(root_url, "[^A-Za-z0-9.-]", "_"), F.lit("-"), F.substring(F.sha2(root_url, 256), 1, 12))


def write_sitemaps(entries: DataFrame, path: str) -> None:
    """One XML document per root under ``path/root=<folder>/``.

    Lines are ordered by a global sort on (root, sort_key): range
    partitioning spreads a large site over many tasks; each task writes its
    slice in order, and header/footer rows bound every root.
    """
    head = entries.select("root_url").distinct().select(
        "root_url", F.lit("").alias("sort_key"), F.lit(P.SITEMAP_HEADER.rstrip("\n")).alias("xml"))
    foot = entries.select("root_url").distinct().select(
        "root_url", F.lit("\uffff").alias("sort_key"), F.lit(P.SITEMAP_FOOTER).alias("xml"))
    body = entries.select("root_url", "sort_key", F.regexp_replace("xml", "\n$", "").alias("xml"))
    allr = head.unionByName(body).unionByName(foot)
    (allr.withColumn("root", sitemap_folder(F.col("root_url")))
     .repartitionByRange("root", "sort_key").sortWithinPartitions("root", "sort_key")
     .select("root", "xml").write.mode("overwrite").partitionBy("root").text(path))


def tree_fragments(nodes: DataFrame, file_name_col: str | None = "file_name") -> DataFrame:
    """The nested crawl tree as one JSON fragment per node: ``root_url, sort_key, json``.

    In order of (root_url, sort_key) the fragments of a root spell its tree
    ``{url, fileName, children}``: a fragment opens its node, and closes what
    ended before it: a node's ``open`` children list ends with the last of its
    descendants, which is known from the depths of the node and of the next
    one.  No site is gathered in one task: the next depth comes from the slice
    of the sort that holds the row (``plans.rank``), as does a first child.
    """
    from sitegraph.plans.crawl import with_paths
    from sitegraph.plans.rank import split_row_number
    fn = F.col(file_name_col) if file_name_col and file_name_col in nodes.columns else F.lit(None)
    n = with_paths(nodes).select("root_url", sort_key().alias("sort_key"), "depth", "url", fn.cast("string").alias("file_name"))
    r = split_row_number(n, ["root_url"], ["sort_key"], "i")
    after = r.select("root_url", (F.col("i") - 1).alias("i"), F.col("depth").alias("_next"))
    r = r.join(after, ["root_url", "i"], "left")
    core = F.to_json(F.struct(F.col("url").alias("url"), F.nullif(F.col("file_name"), F.lit("")).alias("fileName")))
    ups = F.col("depth") - F.coalesce(F.col("_next"), F.lit(0))
    ends = F.when(F.col("_next").isNull(), F.concat(F.repeat(F.lit("}]"), F.col("depth")), F.lit("}"))) \
        .when(F.col("_next") > F.col("depth"), F.lit(',"children":[')) \
        .otherwise(F.concat(F.repeat(F.lit("}]"), ups.cast("int")), F.lit("},")))
    return r.select("root_url", "sort_key", F.concat(F.regexp_replace(core, "}$", ""), ends).alias("json"))


def write_site_trees(nodes: DataFrame, path: str, file_name_col: str | None = "file_name") -> None:
    """One JSON document per root under ``path/root=<folder>/``, its fragments in order, one a line."""
    (tree_fragments(nodes, file_name_col).withColumn("root", sitemap_folder(F.col("root_url")))
     .repartitionByRange("root", "sort_key").sortWithinPartitions("root", "sort_key")
     .select("root", "json").write.mode("overwrite").partitionBy("root").text(path))


def site_tree_json(nodes: DataFrame, file_name_col: str | None = "file_name") -> DataFrame:
    """Nested crawl tree ``{url, fileName, children}`` per root, empty fields
    left out (``root_url, tree_json``).

    Folded level by level from the deepest: each fold groups the children of
    one page (bounded by that page's links).  The result is one string per
    root, as the format demands; the adjacency table is the scalable form.
    """
    fn = F.col(file_name_col) if file_name_col and file_name_col in nodes.columns else F.lit(None)
    df = nodes.select("root_url", "url", "depth", "parent_url", fn.cast("string").alias("file_name"))
    max_d = df.agg(F.max("depth")).first()[0] or 0
    acc = None  # (root_url, url, parent_url, json) of the level below
    for d in range(max_d, -1, -1):
        lv = df.where(F.col("depth") == d)
        if acc is not None:
            kids = (acc.groupBy("root_url", "parent_url")
                    .agg(F.array_sort(F.collect_list(F.struct("url", "json"))).alias("k")))
            lv = lv.join(kids.withColumnRenamed("parent_url", "url"), ["root_url", "url"], "left")
            children = F.transform("k", lambda s: s["json"])
        else:
            children = F.lit(None).cast("array<string>")
        # to_json drops null fields; children are already rendered JSON
        core = F.to_json(F.struct(F.col("url").alias("url"),
                                  F.nullif(F.col("file_name"), F.lit("")).alias("fileName")))
        kids_json = F.when(F.size(children) > 0,
                           F.concat(F.lit(',"children":['), F.array_join(children, ","), F.lit("]")))
        json = F.concat(F.regexp_replace(core, "}$", ""), F.coalesce(kids_json, F.lit("")), F.lit("}"))
        acc = lv.select("root_url", "url", "parent_url", json.alias("json"))
    return acc.select("root_url", F.col("json").alias("tree_json"))
