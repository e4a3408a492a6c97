"""Streams over landing folders: the crawl in any landing order, records per format, bounded state, quarantine."""
import random

import pytest
from pyspark.sql import functions as F

from sitegraph.plans import crawl as C
from sitegraph.sources import tables as T
from sitegraph.streaming.incremental import CrawlStream

@pytest.fixture(autouse=True)
def few_partitions(spark):
    """A batch opens one state store per partition and side: two are enough here."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


NODE = ["root_url", "url", "depth", "parent_url", "page_id", "status"]


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def _land(spark, rows, folder):
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(folder)


def _page(i, *links, title=None):
    body = "".join(f'<a href="/{k}">{k}</a>' for k in links)
    return (i, f"https://h.org/{i}", f"<html><head><title>{title or i}</title></head><body>{body}</body></html>")


def _roots(spark, *urls):
    return spark.createDataFrame([(u,) for u in urls], "root_url string")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_landing_order_gives_the_batch_crawl(spark, sf, tmp_path, seed):
    pp = T.pages_plus(spark, sf)
    rows = [tuple(r) for r in pp.select("page_id", "url", "html").collect()]
    random.Random(seed).shuffle(rows)
    roots = pp.where("rn = 0").select(F.col("url").alias("root_url"))
    opts = C.CrawlOptions(max_depth=3, enforce_robots=seed == 2, user_agent="testbot", referrer="r")
    robots = T.robots_bodies(pp)
    landing = str(tmp_path / "landing")
    cut = [0, 20, 47, len(rows)]
    _land(spark, rows[:cut[1]], landing)
    crawl = CrawlStream(spark, landing, roots, opts, robots, T.page_status)
    try:
        reads = [crawl.settle()]
        for a, b in zip(cut[1:], cut[2:]):
            _land(spark, rows[a:b], landing)
            reads.append(crawl.settle())
        got = crawl.nodes()
        store = T.page_status(spark.createDataFrame(rows, "page_id long, url string, html string"))
        want = C.crawl(store, roots, opts, robots)
        assert _rows(got, *NODE, "referrer", "title") == _rows(want, *NODE, "referrer", "title")
        assert [r["pages"] for r in reads] == [20, 27, len(rows) - 47]
        assert crawl.settle() == {"pages": 0, "frontier": 0, "messages": 0}
    finally:
        crawl.close()


def test_rows_read_follow_the_batch(spark, tmp_path):
    """A late page costs its own links and what it improves, however much has landed."""
    landing = str(tmp_path / "landing")
    n = 400
    _land(spark, [_page(0, *range(1, 21))] + [_page(i, *range(20 * i + 1, 20 * i + 21)) for i in range(1, n)], landing)
    crawl = CrawlStream(spark, landing, _roots(spark, "https://h.org/0"), C.CrawlOptions(max_depth=9))
    try:
        first = crawl.settle()
        assert first["pages"] == n and first["frontier"] > 2000
        _land(spark, [_page(n, 1, 2)], landing)  # reached already, links to two pages that are nearer than it
        late = crawl.settle()
        assert late["pages"] == 1 and sum(late.values()) < 10
    finally:
        crawl.close()


def test_links_wait_for_their_page_and_depths_shrink(spark, tmp_path):
    landing = str(tmp_path / "landing")
    _land(spark, [_page(3, 4), _page(4, 5)], landing)
    crawl = CrawlStream(spark, landing, _roots(spark, "https://h.org/0"), C.CrawlOptions(max_depth=6))

    def depths():
        crawl.settle()
        return {r.url.rsplit("/")[-1]: (r.depth, r.status) for r in crawl.nodes().collect()}
    try:
        assert depths() == {"0": (0, "failed")}
        _land(spark, [_page(0, 1)], landing)
        assert depths() == {"0": (0, "ok"), "1": (1, "failed")}
        _land(spark, [_page(2, 3)], landing)
        _land(spark, [_page(1, 2, 7)], landing)  # the link to 2 wakes 2, 3, 4
        assert depths() == {"0": (0, "ok"), "1": (1, "ok"), "2": (2, "ok"), "3": (3, "ok"), "4": (4, "ok"), "5": (5, "failed"), "7": (2, "failed")}
        _land(spark, [_page(7, 4)], landing)  # a shorter way to 4 shortens 5
        assert depths() == {"0": (0, "ok"), "1": (1, "ok"), "2": (2, "ok"), "3": (3, "ok"), "4": (3, "ok"), "5": (4, "failed"), "7": (2, "ok")}
        before = crawl.base
        crawl.close()
        crawl = CrawlStream(spark, landing, _roots(spark, "https://h.org/0"), C.CrawlOptions(max_depth=6), base=before)  # goes on
        _land(spark, [_page(5, 0, 8)], landing)
        assert depths()["8"] == (5, "failed") and depths()["5"] == (4, "ok")
    finally:
        crawl.close()


def test_a_page_that_replaces_another_takes_its_links_back(spark, tmp_path):
    landing = str(tmp_path / "landing")
    _land(spark, [_page(0, 9), (9, "https://h.org/9", '<a href="/old">x</a>')], landing)
    roots, opts = _roots(spark, "https://h.org/0"), C.CrawlOptions(max_depth=4)
    crawl = CrawlStream(spark, landing, roots, opts)
    try:
        crawl.settle()
        _land(spark, [(8, "https://h.org/9#again", '<a href="/new">x</a>'), (10, "https://h.org/9", '<a href="/later">x</a>')], landing)
        crawl.settle()
        store = spark.read.parquet(landing)
        assert _rows(crawl.nodes(), *NODE) == _rows(C.crawl(store, roots, opts), *NODE)
        assert {r.url for r in crawl.nodes().collect()} == {f"https://h.org/{x}" for x in ("0", "9", "new")}
    finally:
        crawl.close()


@pytest.mark.parametrize("fmt", ["text", "html", "markdown"])
def test_records_run_with_the_stream_in_every_format(spark, tmp_path, fmt):
    from sitegraph.operators.content import page_content
    landing = str(tmp_path / "landing")
    pages = [_page(0, 1, 2, title="root"), _page(1, 3), _page(2, 0), _page(3, 1), _page(6, 0)]
    _land(spark, pages[2:], landing)
    crawl = CrawlStream(spark, landing, _roots(spark, "https://h.org/0", "https://h.org/2"), C.CrawlOptions(max_depth=2), fmt=fmt)

    def records():
        crawl.settle()
        return _rows(crawl.records(), "root_url", "url", "title", "content")
    try:
        assert [r[:2] for r in records()] == [("https://h.org/2", "https://h.org/2")]  # emitted before the rest lands
        _land(spark, pages[:2], landing)
        content = {r.url: (r.title, r.content) for r in page_content(spark.read.parquet(landing), fmt).collect()}
        ok = crawl.settle() and crawl.nodes().where("status = 'ok'").select("root_url", "url").collect()
        assert records() == sorted((r.root_url, r.url, *content[r.url]) for r in ok) and len(ok) == 7
    finally:
        crawl.close()


def test_dedup_state_is_bounded_by_the_delay(spark, tmp_path):
    """Keys come again within the delay and are emitted once; what the watermark has passed leaves the state."""
    from sitegraph.streaming import stream as ST
    minutes = [(i, f"https://h.org/{i}{tail}", i + late) for i in range(600) for late, tail in ((0, ""), (15, "#x"), (50, ""))]
    df = spark.createDataFrame(minutes, "page_id long, url string, m long").select("page_id", "url", F.timestamp_seconds(F.col("m") * 60).alias("landed_at"))
    landing, progress = ST.land_in_order(df, str(tmp_path / "in"), "landed_at", 12), []
    out = ST.dedup_stream(spark, landing, 1, "1 hour", progress)
    assert sorted(r.key for r in out.collect()) == sorted(f"https://h.org/{i}" for i in range(600))
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert len(held) >= 12 and max(held) < 250 and held[-1] < 250  # an hour and a file, not 600


def test_quarantine_takes_what_cannot_be_read(spark, tmp_path):
    from sitegraph.streaming import stream as ST
    rows = [(1, "https://h.org/1", "<p>x</p>"), (2, "https://h.org/2", None), (3, "not a url", "<p>y</p>"), (4, "https://h.org/4", ""), (5, None, "z"), (6, None, None)]
    landing = str(tmp_path / "in")
    for r in rows:
        _land(spark, [r], landing)
    good, bad = ST.quarantined_stream(spark, landing, 2)
    assert _rows(good, "page_id", "content") == [(1, "x"), (4, "")]
    assert _rows(bad, "page_id", "reason") == [(2, "no_html"), (3, "bad_url"), (5, "bad_url"), (6, "no_html")]
    assert good.count() + bad.count() == len(rows) and bad.select("batch_id").distinct().count() > 1
    empty, none = ST.quarantined_stream(spark, _empty(spark, tmp_path), 2)
    assert empty.isEmpty() and none.isEmpty()


def _empty(spark, tmp_path):
    folder = str(tmp_path / "empty")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(folder)
    return folder
