"""The crawl as streams that feed each other: pages may land in any order.

Four queries keep the crawl up to date; a batch of any of them costs what is new
in it, never what is there already:

* ``pages``    landed files -> key, page_id, valid, title and out-links of every page
  (row-local; the HTML is parsed once).
* ``frontier`` messages "root reaches url at depth from parent" -> a streaming aggregate
  keeps the least (depth, parent) of every (root, url).  Only rows improved in the
  batch leave it: those whose least struct, which ends with the batch's own time,
  was made in this batch.
* ``expand``   a stream-stream join of improved nodes and valid pages by URL; each pair
  gives the messages for the page's links.  Its state is the crawl's memory: a link
  waits there until its page lands, a page until a link to it is found.
* ``records``  a stream-stream join of the nodes, each once, and the page records in
  TEXT, HTML or MARKDOWN, emitted as soon as a page is reached and there.

A page that lands late may shorten depths below it: its messages carry lesser depths,
the aggregate lets them through, and only what they improve is expanded again.
Messages die out, since each adds one to the depth and nothing but an improvement
passes.  State lives in RocksDB stores under the checkpoint folder; a batch that is
tried again after a loss has the same time and gives the same rows.

One thing cannot be taken back from the streams: the links of a valid page that
another valid page of the same key, with a smaller page_id and other links, replaces.
Such keys are found in the page table; the node table is then crawled afresh from it.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegraph.functions import html as H
from sitegraph.functions import urls as U
from sitegraph.operators import links as L
from sitegraph.operators import robots as R
from sitegraph.plans import crawl as C
from sitegraph.session import checkpoint_dir
from sitegraph.streaming.stream import page_records, read_page_stream, rocksdb, spread

MESSAGE = "root_url string, url string, parent_url string, depth int"
PAGE = "key string, page_id bigint, valid boolean, title string, children array<string>"


def parsed_pages(store: DataFrame, opts: C.CrawlOptions) -> DataFrame:
    """key, page_id, valid, title, children of each page: the rows of ``page_graph`` before keys are made unique."""
    status = F.col("status") if "status" in store.columns else F.lit(200)
    key = U.clean_url(F.col("url"))
    df = store.select("page_id", key.alias("key"), (status == 200).alias("valid"),
                      H.clean_html(F.col("html")).alias("_c")).where(F.col("key").isNotNull())
    kinds = ["internal"] if opts.restrict else ["internal", "external", "iframe"]
    links = L.page_link_array(F.col("key"), F.col("_c"), kinds, opts.url_patterns, opts.url_logic)
    children = F.array_distinct(F.filter(F.transform(L.crawl_links(links, opts.restrict), U.clean_url), lambda x: x.isNotNull()))
    return df.select("key", "page_id", "valid", H.title_of(F.col("_c")).alias("title"), children.alias("children"))


class CrawlStream:
    """A crawl over a folder that pages land in.

    ``settle()`` waits until all that has landed is worked in, ``nodes()`` is the
    node table then, ``records()`` the page records emitted so far.  ``base`` names
    the folder of an earlier run to go on with.
    """

    def __init__(self, spark: SparkSession, landing: str, roots: DataFrame, opts: C.CrawlOptions, robots: DataFrame | None = None,
                 status_fn=None, max_files_per_trigger: int | None = None, fmt: str | None = None, selectors: list[str] | None = None,
                 base: str | None = None):
        self.spark, self.landing, self.opts = spark, landing, opts
        self.status_fn, self.files = status_fn or (lambda df: df), max_files_per_trigger
        self.base = base or os.path.join(checkpoint_dir(spark), f"crawl-stream-{uuid.uuid4().hex[:12]}")
        self.rules = None
        if opts.enforce_robots and robots is not None:
            self.rules = C._save(R.rules_by_origin(robots, opts.user_agent))
        self.roots = C._save(roots.select("root_url").distinct())
        self.queries: dict = {}
        self._seen: dict[str, int] = {}
        self._start(fmt, selectors)

    # ------------------------------------------------------------ queries
    def _at(self, name: str) -> str:
        return os.path.join(self.base, name)

    def _files(self, name: str) -> int:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._at(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path).getFileCount()

    def _sink(self, df: DataFrame, name: str, *partition: str):
        w = df.writeStream.format("parquet").option("path", self._at(name)).option("checkpointLocation", self._at(f"checkpoint-{name}"))
        self.queries[name] = (w.partitionBy(*partition) if partition else w).outputMode("append").start()

    def _start(self, fmt, selectors) -> None:
        spark = self.spark
        key = U.clean_url(F.col("root_url"))
        first = (self.roots.select("root_url", key.alias("url"), F.lit(None).cast("string").alias("parent_url"), F.lit(0).alias("depth"))
                 .where(F.col("url").isNotNull()))
        # folders that a stream reads must be there; a table by depth leaves no file where a batch has no rows
        first.write.mode("ignore").partitionBy("depth").parquet(self._at("seeds"))
        first.limit(0).write.mode("ignore").partitionBy("depth").parquet(self._at("nodes"))
        with rocksdb(spark):
            landed = self.status_fn(spread(read_page_stream(spark, self.landing, max_files_per_trigger=self.files)))
            self._sink(parsed_pages(landed, self.opts).withColumn("part", F.lit(0)), "pages", "part")
            self._sink(self._expand(), "messages", "depth")
            if fmt:
                self._sink(self._records(fmt, selectors), "records", "part")
            self._frontier()

    def _stream(self, name: str, schema: str) -> DataFrame:
        return self.spark.readStream.schema(schema).parquet(self._at(name))

    def _expand(self) -> DataFrame:
        nodes = self._stream("nodes", MESSAGE).where(F.col("depth") < int(self.opts.max_depth))
        if self.rules is not None:
            nodes = R.allowed_by_rules(nodes, self.rules).where("allowed")
        pages = self._stream("pages", PAGE + ", part int").where("valid").select("key", "children")
        pairs = nodes.select("root_url", "url", "depth").join(pages, F.col("url") == F.col("key"))
        return pairs.select("root_url", F.explode("children").alias("child"), F.col("url").alias("parent_url"),
                            (F.col("depth") + 1).alias("depth")).withColumnRenamed("child", "url")

    def _frontier(self) -> None:
        messages = self._stream("seeds", MESSAGE).union(self._stream("messages", MESSAGE))
        now = F.current_timestamp()  # of the micro-batch: all its rows have the same, also when it is tried again
        best = (messages.select("*", now.alias("at")).groupBy("root_url", "url")
                .agg(F.min(F.struct("depth", "parent_url", "at")).alias("best"), F.max("at").alias("last")))
        nodes = self._at("nodes")

        def keep(batch: DataFrame, _: int) -> None:
            new = batch.where(F.col("best.at") == F.col("last")).select("root_url", "url", "best.parent_url", "best.depth")
            new.write.mode("append").partitionBy("depth").parquet(nodes)

        self.queries["frontier"] = (best.writeStream.outputMode("update").foreachBatch(keep)
                                    .option("checkpointLocation", self._at("checkpoint-frontier")).start())

    def _records(self, fmt: str, selectors) -> DataFrame:
        nodes = self._stream("nodes", MESSAGE).select("root_url", "url")
        if self.rules is not None:
            nodes = R.allowed_by_rules(nodes, self.rules).where("allowed").select("root_url", "url")
        nodes = nodes.dropDuplicates(["root_url", "url"])
        landed = self.status_fn(spread(read_page_stream(self.spark, self.landing, max_files_per_trigger=self.files)))
        status = F.col("status") if "status" in landed.columns else F.lit(200)
        landed = landed.where(status == 200).select("page_id", "url", "html")
        made = page_records(landed, fmt, selectors).select(U.clean_url(F.col("url")).alias("key"), "page_id", "title", "content")
        return (nodes.join(made, F.col("url") == F.col("key"))
                .select("root_url", "url", "page_id", "title", "content", F.lit(0).alias("part")))

    # ------------------------------------------------------------ results
    def settle(self) -> dict[str, int]:
        """Waits until no query has anything left to do; rows that each has read since the last call."""
        order = ["pages", "frontier", "messages", *(["records"] if "records" in self.queries else [])]
        before = None
        while True:
            for name in order:
                self.queries[name].processAllAvailable()
            now = [self._files(n) for n in ("pages", "messages", "nodes")]
            if now == before:
                break
            before = now
        read = {}
        for name in order:
            progress = [p for p in self.queries[name].recentProgress if p["batchId"] > self._seen.get(name, -1) and p["numInputRows"] > 0]
            read[name] = sum({p["batchId"]: p["numInputRows"] for p in progress}.values())
            self._seen[name] = max([p["batchId"] for p in progress], default=self._seen.get(name, -1))
        return read

    def pages(self) -> DataFrame:
        """One row per key, as ``page_graph`` makes them."""
        df = self.spark.read.schema(PAGE + ", part int").parquet(self._at("pages")).drop("part")
        best = F.min(F.struct((~F.col("valid")).alias("_bad"), "page_id", "valid", "title", "children")).alias("p")
        return df.groupBy("key").agg(best).select("key", "p.page_id", "p.valid", "p.title", "p.children")

    def _replaced(self) -> bool:
        """Whether valid pages of one key have different links."""
        df = self.spark.read.schema(PAGE + ", part int").parquet(self._at("pages")).where("valid")
        links = F.xxhash64(F.array_sort("children"))
        return not df.groupBy("key").agg(F.min(links).alias("a"), F.max(links).alias("b")).where("a <> b").isEmpty()

    def nodes(self) -> DataFrame:
        """The node table of ``crawl_nodes`` without paths."""
        columns = ["root_url", "url", "depth", "parent_url", "referrer", "page_id", "title", "valid", "allowed", "status"]
        if self._replaced():
            graph = C.graph_table(self.pages())
            return C._save(C.crawl_nodes(graph, self.roots, self.opts, None, rules=self.rules).select(*columns))
        df = self.spark.read.schema(MESSAGE).parquet(self._at("nodes"))
        df = df.groupBy("root_url", "url").agg(F.min(F.struct("depth", "parent_url")).alias("n"))
        df = df.select("root_url", "url", "n.depth", "n.parent_url")
        referrer = F.when(F.col("depth") == 0, F.lit(self.opts.referrer).cast("string")).otherwise(F.col("parent_url"))
        df = C.with_status(df.withColumn("referrer", referrer), self.pages(), self.rules)
        return C._save(df.select(*columns))

    def records(self) -> DataFrame:
        """root_url, url, title, content of every node whose page has loaded."""
        df = self.spark.read.parquet(self._at("records"))
        best = df.groupBy("root_url", "url").agg(F.min(F.struct("page_id", "title", "content")).alias("r"))
        return best.select("root_url", "url", "r.title", "r.content")

    def close(self) -> None:
        for q in self.queries.values():
            q.stop()
