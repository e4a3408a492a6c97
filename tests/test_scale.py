"""Work that must not grow with the number of parts, elements or operations: state stores, spread pages, shared values."""
import re

from pyspark.sql import functions as F

from sitegraph.operators import content as C
from sitegraph.operators import dom
from sitegraph.operators import markdown as MD
from sitegraph.registry import QUERIES
from sitegraph.streaming import stream as ST


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _pages(spark, *html):
    return spark.createDataFrame([(i, f"https://h.org/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string")


def test_a_query_with_state_has_no_more_partitions_than_cores(spark):
    name = "spark.sql.shuffle.partitions"
    old = spark.conf.get(name)
    try:
        spark.conf.set(name, "200")
        with ST.rocksdb(spark):
            assert int(spark.conf.get(name)) <= spark.sparkContext.defaultParallelism
        assert spark.conf.get(name) == "200"
        spark.conf.set(name, "2")
        with ST.rocksdb(spark):
            assert spark.conf.get(name) == "2"
    finally:
        spark.conf.set(name, old)


def test_insight_kinds_spreads_its_pages(spark, sf):
    parts = 8 * spark.sparkContext.defaultParallelism
    plan = QUERIES["insight_kinds"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"hashpartitioning\(page_id#\d+L?, url#\d+, {parts}\), REPARTITION_BY_NUM", plan)


def test_a_batch_of_one_file_is_many_tasks(spark, tmp_path):
    landing = ST.land_pages(_pages(spark, *[f"<html><body><p>t{i}</p></body></html>" for i in range(50)]), str(tmp_path / "one"), files=1)
    out = ST.page_content_stream(spark, landing)
    assert out.count() == 50
    assert len(out.inputFiles()) > 1


def test_what_a_step_gives_is_worked_out_once(spark):
    df = _pages(spark, "<p>a</p>").withColumn("s", dom.steps(F.col("html")))
    df = df.select(dom.operations(F.col("s"), m=lambda s: F.concat(s["mark"], F.lit("MARKER"))).alias("o"))
    assert _plan(df).count("MARKER") == 1


def test_selected_text_makes_the_page_once(spark):
    df = C.selected_text(_pages(spark, "<article><p>a</p><p>b</p></article>"), ["p", "article"])
    plan = _plan(df)
    assert "slice(lambda" in plan and "slice(flatten(" not in plan
    assert df.first()["content"] == "a b a b"


def test_code_in_and_out_of_a_pre(spark):
    got = MD.markdown(_pages(spark, "<body><p>x <code>a  b</code></p><pre><code data-language='c'>d  e</code></pre></body>")).first()["markdown"]
    assert got == "x `a b`\n\n```c\nd  e\n```\n\n"
