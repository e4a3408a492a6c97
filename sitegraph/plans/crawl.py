"""Breadth-first crawl, site map and the plans around them.

The reference walks one site with an in-memory queue.  Here a crawl is a
level loop on the driver (at most ``max_depth`` rounds); every round is one
distributed job over all roots at once.  Roots are numbered and taken 64 to a
block; a row says which roots of a block have reached a URL, one bit for each, so
sites that many roots reach are walked once per block, not once per root:

1. frontier (url, block, bits) JOIN page graph on the URL -> expandable nodes
2. explode their out-links; rows of one (child, block, bits) leave the map side
   with their smallest parent only, so a link that every page carries, such as
   the site root, never piles up in one task
3. take the bits off that earlier levels hold for (child, block): these are tables
   bucketed by those columns, so only the candidates are shuffled
4. what is left goes to the parents in order: a parent gets the bits that no
   smaller one has (a running ``bit_or``)
5. write the level as a bucketed table in the shared folder (it survives executor
   loss; no local checkpoints)

Depth is the BFS distance (first discovery wins).  Where the reference picks a
parent by hash-set order, we take the smallest parent URL.  Bits become rows per
root once, when the levels are put together; paths come from the parents by
pointer jumping (``with_paths``) where they are asked for.

The page graph (node key -> out-links) is computed once from the HTML by
row-local expressions, so the loop never touches the wide ``html`` column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegraph.functions import html as H
from sitegraph.functions import urls as U
from sitegraph.operators import links as L
from sitegraph.operators import robots as R
from sitegraph.plans.buckets import bucketed
from sitegraph.session import checkpoint_dir


@dataclass
class CrawlOptions:
    """Crawl parameters (the reference's crawl options)."""
    max_depth: int
    restrict: bool = False
    url_patterns: list[str] | None = None
    url_logic: str | None = None
    enforce_robots: bool = False
    user_agent: str | None = None
    referrer: str | None = None
    delay_ms: int = 0

    def __post_init__(self):
        if self.max_depth is None or int(self.max_depth) < 0:
            raise ValueError("max_depth must be a non-negative integer")
        if self.url_logic and self.url_logic.lower() not in ("include", "exclude"):
            raise ValueError("url_logic must be include or exclude")


NODE_COLUMNS = ["root_url", "url", "depth", "parent_url", "referrer"]
#: Roots of a block: the bits of a long.
BLOCK = 64


def page_graph(store: DataFrame, opts: CrawlOptions) -> DataFrame:
    """``key, page_id, valid, title, children`` per fetchable URL.

    ``key`` is the crawl key of the stored URL (fragment dropped, escaped);
    ``valid`` means the stored fetch has status 200 (no status column: all
    valid); ``children`` are the cleaned links a crawl follows from the page,
    resolved against the key as the page's base URI.  When two stored pages
    share a key a valid one is used before others, then the smaller page_id.
    """
    key = U.clean_url(F.col("url"))
    status = F.col("status") if "status" in store.columns else F.lit(200)
    df = store.select("page_id", key.alias("key"), (status == 200).alias("valid"),
                      H.clean_html(F.col("html")).alias("_c")).where(F.col("key").isNotNull())
    kinds = ["internal"] if opts.restrict else ["internal", "external", "iframe"]
    links = L.page_link_array(F.col("key"), F.col("_c"), kinds, opts.url_patterns, opts.url_logic)
    follow = L.crawl_links(links, opts.restrict)
    children = F.array_distinct(F.filter(F.transform(follow, U.clean_url), lambda x: x.isNotNull()))
    df = df.select("page_id", "key", "valid", H.title_of(F.col("_c")).alias("title"),
                   children.alias("children"))
    best = F.min(F.struct((~F.col("valid")).alias("_bad"), "page_id", "valid", "title", "children")).alias("p")
    return df.groupBy("key").agg(best).select("key", "p.page_id", "p.valid", "p.title", "p.children")


def _save(df: DataFrame) -> DataFrame:
    """Cut lineage: reliable checkpoint into the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def numbered_roots(roots: DataFrame) -> DataFrame:
    """``root_url, url, block, bit`` per distinct root with a crawl key; neighbours by URL share a block, as they
    tend to share pages."""
    from sitegraph.plans.rank import split_row_number
    r = roots.select("root_url").distinct().select("root_url", U.clean_url(F.col("root_url")).alias("url")).where("url IS NOT NULL")
    r = split_row_number(r.withColumn("_all", F.lit(0)), ["_all"], ["root_url"], "_i")
    i = F.col("_i") - 1
    return r.select("root_url", "url", F.floor(i / BLOCK).alias("block"), (i % BLOCK).cast("int").alias("bit"))


def _unseen(cand: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Candidates (url, block, bits, parent_url) less the bits that the levels hold; the levels stay where they lie."""
    bits = F.col("bits")
    for i, lv in enumerate(levels):
        held = lv.groupBy("url", "block").agg(F.bit_or("bits").alias(f"_seen{i}"))
        cand = cand.join(held, ["url", "block"], "left")
        bits = bits.bitwiseAND(F.bitwise_not(F.coalesce(F.col(f"_seen{i}"), F.lit(0))))
    return cand.select("url", "block", bits.alias("bits"), "parent_url").where("bits <> 0")


def next_level(level: DataFrame, levels: list[DataFrame], graph: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """``url, block, bits, parent_url`` of the nodes one step behind ``level``."""
    f = level.groupBy("url", "block").agg(F.bit_or("bits").alias("bits"))
    f = f.join(graph, f["url"] == graph["key"]).where("valid")
    if rules is not None:
        f = R.allowed_by_rules(f, rules).where("allowed")
    kids = f.select(F.explode("children").alias("child"), F.col("url").alias("parent_url"), "block", "bits")
    cand = kids.groupBy("child", "block", "bits").agg(F.min("parent_url").alias("parent_url")).withColumnRenamed("child", "url")
    n = int(level.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    new = _unseen(cand.repartition(n, "url", "block"), levels)
    w = Window.partitionBy("url", "block").orderBy("parent_url", "bits").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.bit_or("bits").over(w), F.lit(0))
    return (new.withColumn("bits", F.col("bits").bitwiseAND(F.bitwise_not(taken))).where("bits <> 0")
            .select("url", "block", "bits", "parent_url"))


def with_status(nodes: DataFrame, graph: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Nodes with ``page_id, title, valid, allowed, status`` of their page."""
    nodes = nodes.join(graph.select(F.col("key").alias("url"), "page_id", "title", "valid"), "url", "left")
    nodes = R.allowed_by_rules(nodes, rules) if rules is not None else nodes.withColumn("allowed", F.lit(True))
    valid = F.coalesce(F.col("valid"), F.lit(False))
    status = (F.when(~F.col("allowed"), F.lit("disallowed"))
              .when(valid, F.lit("ok")).otherwise(F.lit("failed")))
    return nodes.withColumns({"valid": valid, "status": status})


def crawl_nodes(graph: DataFrame, roots: DataFrame, opts: CrawlOptions,
                robots: DataFrame | None = None, rules: DataFrame | None = None) -> DataFrame:
    """Crawl tree as an adjacency table.

    ``roots`` has a ``root_url`` column; ``rules`` are those of ``robots``
    (``rules_by_origin``) where they are made already.  Output: ``root_url, url, depth,
    parent_url, referrer, page_id, title, valid, allowed, status``
    where status is ``ok`` (page recorded), ``failed`` (no page or not 200)
    or ``disallowed`` (robots).  A node is expanded only when it is ok and
    below ``max_depth``.
    """
    named = _save(numbered_roots(roots))
    bit = F.expr("shiftleft(1L, bit)")
    first = named.groupBy("url", "block").agg(F.bit_or(bit).alias("bits")).withColumn("parent_url", F.lit(None).cast("string"))
    levels = [bucketed(first, "crawl_level", "url", "block")]
    g = graph.select("key", "valid", "children")
    if rules is None and opts.enforce_robots and robots is not None:
        rules = _save(R.rules_by_origin(robots, opts.user_agent))
    for _ in range(int(opts.max_depth)):
        new = bucketed(next_level(levels[-1], levels, g, rules), "crawl_level", "url", "block")
        if new.isEmpty():
            break
        levels.append(new)
    nodes = None
    for d, lv in enumerate(levels):
        lv = lv.withColumn("depth", F.lit(d))
        nodes = lv if nodes is None else nodes.unionByName(lv)
    each = F.explode(F.expr(f"filter(sequence(0, {BLOCK - 1}), i -> (shiftright(bits, i) & 1) = 1)")).alias("bit")
    nodes = nodes.select("url", "block", "depth", "parent_url", each).join(named.select("root_url", "block", "bit"), ["block", "bit"])
    referrer = F.when(F.col("depth") == 0, F.lit(opts.referrer).cast("string")).otherwise(F.col("parent_url"))
    nodes = with_status(nodes.withColumn("referrer", referrer), graph, rules)
    return nodes.select(*NODE_COLUMNS, "page_id", "title", "valid", "allowed", "status")


def with_paths(nodes: DataFrame) -> DataFrame:
    """Nodes with ``path``, the URLs from the root to the node, by pointer jumping: each round doubles the known part.

    Nodes that have a path column are returned as they are."""
    if "path" in nodes.columns:
        return nodes
    p = _save(nodes.select("root_url", "url", F.col("parent_url").alias("_up"), F.array("url").alias("path"), "depth"))
    deepest = p.agg(F.max("depth")).first()[0] or 0
    p = p.drop("depth")
    for _ in range(int(deepest).bit_length()):
        up = p.select("root_url", F.col("url").alias("_up"), F.col("_up").alias("_next"), F.col("path").alias("_above"))
        p = p.join(up, ["root_url", "_up"], "left").select(
            "root_url", "url", F.col("_next").alias("_up"), F.concat(F.coalesce("_above", F.array().cast("array<string>")), "path").alias("path"))
        p = _save(p)
    return nodes.join(p.select("root_url", "url", "path"), ["root_url", "url"])


def graph_table(graph: DataFrame) -> DataFrame:
    """The page graph as a table bucketed and sorted by key: a level's join shuffles the frontier
    to the buckets and reads the graph where it lies."""
    return bucketed(graph, "crawl_graph", "key")


def crawl(store: DataFrame, roots: DataFrame, opts: CrawlOptions,
          robots: DataFrame | None = None) -> DataFrame:
    """Full crawl from a page store (``page_id, url, html[, status]``).

    The page graph is materialised once, so the level loop reads only keys
    and out-link arrays, never the HTML."""
    return crawl_nodes(graph_table(page_graph(store, opts)), roots, opts, robots)


def site_map_nodes(nodes: DataFrame, opts: CrawlOptions) -> DataFrame:
    """Nodes of the site map: a child appears only once proved good (page
    loads below max depth, status 200 at max depth) and allowed.  The root
    stays when it is allowed and valid, or robots-forbidden (sitemap of
    one); a failing root gives no sitemap."""
    root = F.col("depth") == 0
    keep_root = F.col("valid") | (~F.col("allowed") & (F.lit(int(opts.max_depth) > 0) | F.col("valid")))
    keep = F.when(root, keep_root).otherwise(F.col("valid") & F.col("allowed"))
    return nodes.where(keep)


def request_plan(nodes: DataFrame) -> DataFrame:
    """Each request carries its parent as referrer; roots the configured one."""
    return nodes.select("root_url", "url", "depth", "referrer")


def politeness_plan(nodes: DataFrame, delay_ms: int) -> DataFrame:
    """Planned start offset of each fetch: the fixed delay times the number
    of fetches before it in crawl order (depth, then URL) within its root.

    The rank inside a root is built from range slices (``plans.rank``), so a
    site holding a large share of all nodes is not ranked by one task."""
    from sitegraph.plans.rank import split_row_number
    ranked = split_row_number(nodes.select("root_url", "url", "depth"), ["root_url"], ["depth", "url"], "i")
    return ranked.select("root_url", "url", "depth",
                         ((F.col("i") - 1) * F.lit(int(delay_ms))).cast("bigint").alias("start_ms"))


def valid_urls(urls: DataFrame, store: DataFrame, url_col: str = "url") -> DataFrame:
    """URLs whose stored fetch returns exactly 200 (semi join; reads no html)."""
    status = F.col("status") if "status" in store.columns else F.lit(200)
    ok = store.where(status == 200).select(U.clean_url(F.col("url")).alias("_k")).distinct()
    return urls.join(ok, U.clean_url(F.col(url_col)) == F.col("_k"), "left_semi")


def page_store(store: DataFrame) -> DataFrame:
    """The page store as a table bucketed and sorted by crawl key (``key, page_id, url, html, status``), written once;
    ``page_scan`` reads the HTML of wanted pages from it without a shuffle."""
    status = F.col("status") if "status" in store.columns else F.lit(200)
    s = store.select(U.clean_url(F.col("url")).alias("key"), "page_id", "url", "html", status.cast("int").alias("status"))
    return bucketed(s.where(F.col("key").isNotNull()), "page_store", "key")


#: Bits of the largest filter of wanted keys: one row of 1 MB; more keys than an eighth of it are not filtered so.
FILTER_BITS = 1 << 23


def might_hold(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``df`` without most rows whose ``key`` is not in ``wanted`` (only a later join is exact).

    The range of the wanted keys reaches the scan, where a file sorted by key skips row groups; a Bloom filter of two
    bits a key, a one-row table worked out at run time, thins the rest.  Its size follows the number of keys and is bounded.
    """
    n, low, high = wanted.agg(F.count(key), F.min(key), F.max(key)).first()
    if not n:
        return df.where(F.lit(False))
    df = df.where(F.col(key).between(low, high))
    bits = 1 << max(10, (16 * n - 1).bit_length())
    if bits > FILTER_BITS:
        return df
    spark = df.sparkSession

    def slots(c):
        h = F.xxhash64(c)
        return [F.shiftrightunsigned(h, by).bitwiseAND(F.lit(bits - 1)) for by in (0, 32)]
    words = wanted.select(F.explode(F.array(*slots(F.col(key)))).alias("s")).select(
        F.shiftright("s", 6).alias("id"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("b"))
    words = spark.range(bits // 64).join(words.groupBy("id").agg(F.bit_or("b").alias("b")), "id", "left")
    every = F.array_sort(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0)).alias("b"))))
    table = words.agg(F.transform(every, lambda x: x["b"]).alias("table")).scalar()
    for s in slots(F.col(key)):
        word = F.get(table, F.shiftright(s, 6).cast("int"))
        df = df.where(F.call_function("shiftright", word, s.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return df


def page_scan(urls: DataFrame, store: DataFrame, url_col: str = "url") -> DataFrame:
    """Fetch pages for URLs from a ``page_store`` (made from ``store`` if it is none): only status 200 counts, of several pages of a key the one with
    the smallest page_id; the page's base URI is the requested URL.

    What is wanted is settled on keys alone: the URLs' keys, each once, then the page_id of each from the store's
    narrow columns.  The HTML comes last, by a join with the store's own buckets; a Bloom
    filter of the wanted keys thins its scan.  Neither read of the store is shuffled, and a URL asked for a
    thousand times costs its page once until the end."""
    store = store if "key" in store.columns else page_store(store)
    # written once, as it is read twice; a filter on the key would else be pushed into what the URLs are made of
    wanted = _save(urls.withColumn("_k", U.clean_url(F.col(url_col)))).where(F.col("_k").isNotNull())
    keys = wanted.select(F.col("_k").alias("key")).distinct()
    ok = store.where("status = 200")
    best = keys.join(ok.select("key", "page_id"), "key").groupBy("key").agg(F.min("page_id").alias("page_id"))
    best = bucketed(best, "page_scan", "key")
    html = ok.select("key", "page_id", "html").where(F.col("key").isNotNull())
    # the page_id is compared as a difference: as a second join column it would make Spark shuffle by both
    html = (might_hold(html, best, "key").join(best.withColumnRenamed("page_id", "_best"), "key")
            .where(F.col("page_id") - F.col("_best") == 0).select("key", "page_id", "html").dropDuplicates(["key", "page_id"]))
    return wanted.join(html.withColumnRenamed("key", "_k"), "_k").select(*urls.columns, "page_id", "html")


def crawl_full(store: DataFrame, roots: DataFrame, opts: CrawlOptions, *, robots: DataFrame | None = None,
               assets: DataFrame | None = None, fmt: str = "text", selectors: list[str] | None = None,
               with_images: bool = False, with_documents: bool = False, with_meta: bool = False,
               max_images: int = 0, max_documents: int = 0,
               run_ts: str | None = None) -> dict[str, DataFrame]:
    """The full-scan crawl: ``nodes`` (adjacency table with ``file_name`` for
    recorded pages), ``records`` (one page record per recorded node, the
    JSON the reference saves, with its file name) and ``tree`` (the nested JSON
    of each root as fragments in order, one per node).  Records are computed once per
    stored page and joined to the nodes that reached it.  Saved names carry the time of
    the run (now, if ``run_ts`` is not given)."""
    from sitegraph.plans import fullscan as FS
    from sitegraph.plans import sitemap as SM
    from sitegraph.sources import sinks as SK
    run_ts = run_ts or SK.run_timestamp()
    nodes = _save(crawl(store, roots, opts, robots))
    ok = F.col("status") == "ok"
    nodes = nodes.withColumn("file_name", F.when(ok, SK.page_file_name(F.coalesce("title", F.lit("")),
                                                                        F.lit(run_ts))))
    pages = store.join(nodes.where(ok).select("page_id").distinct(), "page_id", "left_semi")
    rec = FS.full_scan_records(pages.select("page_id", "url", "html"), assets, fmt=fmt, selectors=selectors,
                               with_images=with_images, with_documents=with_documents, with_meta=with_meta,
                               max_images=max_images, max_documents=max_documents, run_ts=run_ts)
    records = (nodes.where(ok).select("root_url", F.col("url").alias("node_url"), "page_id", "file_name")
               .join(rec.drop("url"), "page_id")
               .withColumnRenamed("node_url", "url"))
    records = SK.page_records(records.drop("file_name"), F.lit(run_ts))
    return {"nodes": nodes, "records": records, "tree": SM.tree_fragments(nodes)}


def get_sitemap(store: DataFrame, roots: DataFrame, opts: CrawlOptions,
                robots: DataFrame | None = None) -> dict[str, DataFrame]:
    """get-sitemap: ``entries`` (loc, priority, XML fragment and sort key per
    URL) and ``summary`` (url, count, depth per root)."""
    from sitegraph.plans import sitemap as SM
    m = site_map_nodes(crawl(store, roots, opts, robots), opts)
    return {"entries": SM.sitemap_entries(m), "summary": SM.sitemap_summary(m, opts.max_depth, roots)}
