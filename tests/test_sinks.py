"""Sinks and fault handling."""
import glob
import json
import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from sitegraph.operators import content as C
from sitegraph.operators import search as SR
from sitegraph.plans import sitemap as SM
from sitegraph.sources import sinks as SK
from sitegraph.sources import tables as T


def test_write_sitemaps(spark, sf, tmp_path):
    entries = E.queries()["sitemap_xml"](spark, sf)
    n = entries.count()
    out = str(tmp_path / "sitemaps")
    SM.write_sitemaps(entries, out)
    docs = {}
    for f in sorted(glob.glob(os.path.join(out, "root=*", "part-*"))):
        docs.setdefault(os.path.dirname(f), []).append(open(f, encoding="utf-8").read())
    total = 0
    for parts in docs.values():
        text = "".join(parts)
        assert text.startswith('<?xml version="1.0" encoding="UTF-8"?>\n<urlset')
        assert text.rstrip().endswith("</urlset>")
        total += text.count("<url>")
    assert total == n


def test_bad_search_response_is_a_status(spark):
    df = spark.createDataFrame([(1, "{not json"), (2, '{"searchParameters":{"q":"x"},"organic":[]}')],
                               "query_id long, body string")
    st = {r["query_id"]: r["status"] for r in SR.search_summary(df).collect()}
    assert st == {1: "bad_response", 2: "ok"}


def test_page_without_markup_does_not_fail(spark):
    df = spark.createDataFrame([(1, "http://h.org/", ""), (2, "not a url", "<p>x"), (3, "http://h.org/b", None)],
                               "page_id long, url string, html string")
    from sitegraph.operators import insights as I
    rows = I.page_insights(df).collect()
    assert len(rows) == 3


def test_response_json_shapes(spark, sf):
    from sitegraph.operators import insights as I
    from sitegraph.operators import meta as M
    pp = T.pages_plus(spark, sf)
    row = I.insights_json(I.page_insights(pp)).first()
    j = json.loads(row["json"])
    assert set(j) == {"pageStats", "links", "title", "url"}
    assert {"div", "p", "h1", "h5", "internal", "wordCount"} <= set(j["pageStats"])
    assert set(j["links"]) == {"documents", "internal", "external", "reference", "iframe", "images"}
    metas = [json.loads(r["json"]) for r in M.meta_tags_json(pp).collect()]
    for arr in metas:
        for t in arr:
            assert t["content"] and (("name" in t) != ("property" in t))


def test_sitemap_folders_and_trees_of_like_roots(spark, tmp_path):
    rows = [("https://h.org/a/b", "https://h.org/a/b", 0, None, ["https://h.org/a/b"], "f"),
            ("https://h.org/a_b", "https://h.org/a_b", 0, None, ["https://h.org/a_b"], "g"),
            ("https://h.org/a_b", "https://h.org/1", 1, "https://h.org/a_b", ["https://h.org/a_b", "https://h.org/1"], ""),
            ("https://h.org/a_b", "https://h.org/2", 2, "https://h.org/1", ["https://h.org/a_b", "https://h.org/1", "https://h.org/2"], "i"),
            ("https://h.org/a_b", "https://h.org/3", 1, "https://h.org/a_b", ["https://h.org/a_b", "https://h.org/3"], "j")]
    nodes = spark.createDataFrame(rows, "root_url string, url string, depth int, parent_url string, path array<string>, file_name string")
    SM.write_sitemaps(SM.sitemap_entries(nodes), str(tmp_path / "maps"))
    SM.write_site_trees(nodes, str(tmp_path / "trees"))

    def documents(folder):
        by = {}
        for f in sorted(glob.glob(os.path.join(str(tmp_path / folder), "root=*", "part-*"))):
            by.setdefault(os.path.dirname(f), []).append(open(f, encoding="utf-8").read())
        return ["".join(x) for x in by.values()]
    maps = documents("maps")
    assert len(maps) == 2 and all(m.count("<urlset") == m.count("</urlset>") == 1 for m in maps)
    trees = sorted((json.loads(t) for t in documents("trees")), key=lambda t: t["url"])
    assert trees == [{"url": "https://h.org/a/b", "fileName": "f"}, {"url": "https://h.org/a_b", "fileName": "g", "children": [
        {"url": "https://h.org/1", "children": [{"url": "https://h.org/2", "fileName": "i"}]}, {"url": "https://h.org/3", "fileName": "j"}]}]


def test_summary_has_a_row_for_every_root(spark):
    nodes = spark.createDataFrame([("a", "a", 0, None, ["a"])], "root_url string, url string, depth int, parent_url string, path array<string>")
    roots = spark.createDataFrame([("a",), ("b",)], "root_url string")
    got = sorted(tuple(r) for r in SM.sitemap_summary(nodes, 2, roots).collect())
    assert got == [("a", 1, 2, 0, "ok"), ("b", 0, 2, None, "root_failed")]
    assert {r.status for r in SM.sitemap_summary(nodes.limit(0), 0, roots).collect()} == {"ok"}


def test_shared_folder_is_needed_off_a_local_master():
    import pytest

    from sitegraph.session import checkpoint_dir

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        checkpoint_dir(Session())
