"""Plan checks and invariants over the registered queries."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sitegraph.registry import QUERIES
from sitegraph.operators import links as L
from sitegraph.sources import tables as T

ROW_LOCAL = ["page_insights", "link_counts", "page_links", "page_title", "content_text", "word_count",
             "element_counts", "page_meta_tags", "image_manifest", "image_topn", "page_content"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_or_nested_loops(spark, sf, name):
    if name.startswith("stream_") or name in ("crawl_stream", "crawl_stream_records", "site_tree_json"):
        pytest.skip("materialised by a stream or a fold before planning")
    p = plan_of(E.queries()[name](spark, sf))
    # reading saved files back is the only Python work of any plan
    python = ["BatchEvalPython", "ArrowEvalPython"] + ["MapInArrow", "MapInPandas", "PythonMapInArrow"] * (not name.startswith("saved_"))
    for bad in (*python, "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad}"


@pytest.mark.parametrize("name", ROW_LOCAL)
def test_row_local_operators_do_not_shuffle_by_key(spark, sf, name):
    """Per-page operators only shuffle to spread a small scan (REPARTITION_BY_NUM)."""
    p = plan_of(E.queries()[name](spark, sf))
    if name in ("page_insights", "page_title", "content_text", "word_count", "page_content"):
        assert "ENSURE_REQUIREMENTS" not in p, name


def test_link_kinds_disjoint(spark, sf):
    links = L.page_links(T.pages_plus(spark, sf), L.A_KINDS)
    dup = links.groupBy("page_id", "link").agg(F.countDistinct("kind").alias("k")).where("k > 1")
    assert dup.count() == 0


def test_include_exclude_partition_links(spark, sf):
    q = E.queries()
    allk = q["page_links"](spark, sf).count()
    assert q["url_filter_include"](spark, sf).count() + q["url_filter_exclude"](spark, sf).count() == allk


def test_crawl_invariants(spark, sf):
    q = E.queries()
    nodes = q["crawl_tree"](spark, sf)
    # every non-root node has a parent one level up in the same crawl
    kids = nodes.where("depth > 0").alias("c")
    par = nodes.select("root_url", F.col("url").alias("parent_url"), F.col("depth").alias("pd"))
    bad = kids.join(par, ["root_url", "parent_url"], "left").where("pd IS NULL OR pd <> depth - 1")
    assert bad.count() == 0
    # urls are unique per root; map is a subset of the crawl; sitemap count = entries
    assert nodes.groupBy("root_url", "url").count().where("count > 1").count() == 0
    sm = q["site_map"](spark, sf)
    summ = q["sitemap_summary"](spark, sf)
    assert sm.count() == summ.agg(F.sum("url_count")).first()[0]


def test_site_tree_json_is_nested(spark, sf):
    import json
    rows = E.queries()["site_tree_json"](spark, sf).collect()
    assert rows
    for r in rows[:5]:
        t = json.loads(r["tree_json"])
        assert "url" in t and t["url"]


def test_word_count_non_negative(spark, sf):
    assert E.queries()["word_count"](spark, sf).where("word_count < 0").count() == 0


def test_split_row_number_matches_window_on_a_hot_group(spark):
    from pyspark.sql import Window
    from sitegraph.plans.rank import split_row_number
    # group 0 holds 90% of the rows
    df = spark.range(5000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(0).alias("g"),
                                  (F.col("id") * 7919 % 5000).alias("o"))
    got = split_row_number(df, ["g"], ["o"], "rn", slices=16)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("bigint"))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def above(plan, needle):
    """Operators above each line of the plan tree that holds ``needle``."""
    out, stack = [], []
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" +-:"))
        stack = [(i, x) for i, x in stack if i < indent]
        if needle in line:
            out.append([x for _, x in stack])
        stack.append((indent, line.strip(" +-:")))
    return out


def test_levels_do_not_shuffle_the_graph(spark, sf, no_broadcast):
    """Only the frontier side of a level's join is exchanged."""
    from sitegraph.plans import crawl as C
    g = C.graph_table(C.page_graph(T.pages_plus(spark, sf).select("page_id", "url", "html"), C.CrawlOptions(max_depth=1)))
    level = spark.range(100).select(F.col("id").cast("string").alias("url"))
    p = plan_of(level.join(g.select("key", "children"), F.col("url") == F.col("key")))
    assert "SortMergeJoin" in p and p.count("Exchange hashpartitioning(") == 1 and "hashpartitioning(key" not in p


def _levels(spark, pages, roots, depth):
    from sitegraph.plans import crawl as C
    from sitegraph.plans.buckets import bucketed
    graph = C.graph_table(C.page_graph(pages.select("page_id", "url", "html"), C.CrawlOptions(max_depth=1)))
    named = C.numbered_roots(roots)
    first = named.groupBy("url", "block").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    levels = [bucketed(first.withColumn("parent_url", F.lit(None).cast("string")), "level", "url", "block")]
    for _ in range(depth):
        levels.append(bucketed(C.next_level(levels[-1], levels, graph), "level", "url", "block"))
    return C.next_level(levels[-1], levels, graph), levels


def test_levels_do_not_shuffle_what_was_visited(spark, sf, no_broadcast):
    """A level exchanges its frontier, the reduced links and the candidates: nothing above the visited levels."""
    pp = T.pages_plus(spark, sf)
    plan, _ = _levels(spark, pp, pp.select(F.col("url").alias("root_url")), 2)
    p = plan_of(plan)
    assert p.count("Exchange hashpartitioning(") == 3 and "BroadcastExchange" not in p
    seen = [ops for ops in above(p, "FileScan parquet") if not any("Exchange" in x for x in ops)]
    assert len(seen) == 3  # the three levels visited so far


def test_overlapping_crawls_share_rows(spark, sf):
    """Roots of one site: a row of a level stands for all that reach its URL, far fewer than a row per root."""
    from sitegraph.plans import crawl as C
    pages = [(i, f"https://h.org/{i}", "".join(f'<a href="/{j % 90}">x</a>' for j in (0, i + 1, 2 * i + 1, i * i + 7))) for i in range(90)]
    store = spark.createDataFrame(pages, "page_id long, url string, html string")
    roots = store.select(F.col("url").alias("root_url"))
    _, levels = _levels(spark, store, roots, 3)
    rows = sum(lv.count() for lv in levels)
    nodes = C.crawl(store, roots, C.CrawlOptions(max_depth=3))
    assert rows < nodes.count() / 2 and nodes.count() > 1000
    assert nodes.groupBy("root_url", "url").count().where("count > 1").isEmpty()


def test_page_scan_does_not_shuffle_html(spark, sf, no_broadcast):
    from sitegraph.plans import crawl as C
    store = C.page_store(T.page_status(T.pages(spark, sf)))
    urls = store.select("url").union(store.select("url"))
    out = C.page_scan(urls, store)
    p = plan_of(out)
    scans = [line for line in p.splitlines() if "FileScan parquet" in line and "html:string" in line]
    assert len(scans) == 1 and "PushedFilters" in scans[0] and "GreaterThanOrEqual(key" in scans[0]
    ops = above(p, scans[0].strip(" +-:"))[0]
    assert not any("Exchange" in x for x in ops) and any("SortMergeJoin" in x for x in ops)
    first = {}
    for r in sorted(store.where("status = 200").select("key", "page_id", "html").collect(), key=lambda r: r.page_id):
        first.setdefault(r.key, r)
    asked = [r.key for r in store.select("key").collect() if r.key in first]
    got = [(r.page_id, r.html) for r in out.collect()]
    assert sorted(got) == sorted((first[k].page_id, first[k].html) for k in asked for _ in range(2))


def test_page_scan_takes_one_page_of_a_key(spark):
    from sitegraph.plans import crawl as C
    rows = [(5, "https://h.org/a", "five", 200), (3, "https://h.org/a", "three", 200), (1, "https://h.org/a", "one", 404),
            (3, "https://h.org/a", "three", 200), (7, "https://h.org/b", "seven", 200), (8, None, "none", 200), (9, "https://h.org/c", None, 200)]
    store = C.page_store(spark.createDataFrame(rows, "page_id long, url string, html string, status int"))
    urls = spark.createDataFrame([("https://h.org/a#x",), ("https://h.org/a",), ("https://h.org/z",), (None,), ("https://h.org/c",)], "u string")
    got = sorted((r.u, r.page_id, r.html) for r in C.page_scan(urls, store, "u").collect())
    assert got == [("https://h.org/a", 3, "three"), ("https://h.org/a#x", 3, "three"), ("https://h.org/c", 9, None)]
    assert C.page_scan(urls.limit(0), store, "u").isEmpty() and C.page_scan(urls, store.limit(0), "u").isEmpty()
