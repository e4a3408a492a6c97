"""Page store and the tables derived from it.

``pages(page_id, url, html)`` is the page store.  The crawler's other inputs
(fetch status, robots bodies, stored asset responses, search responses) are
derived from the given tables by deterministic Spark plans, so every query
grows with the data it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_COLUMNS = ["page_id", "url", "html"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def balanced(df: DataFrame, key: str = "page_id", partitions: int | None = None) -> DataFrame:
    """``df`` spread over ``partitions`` tasks by a hash of ``key``; as it is scanned without a number.

    Per-page work is CPU bound (regular expressions over whole documents), and a small file with one row group
    is one task.  The number is the caller's, by argument or by the session's ``sitegraph.scan.partitions``
    (``session.get_spark`` sets it for local masters); a large store is left as scanned."""
    n = partitions or int(df.sparkSession.conf.get("sitegraph.scan.partitions", "0"))
    return df.repartition(n, key) if n > 0 else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` in eight parts a core, each a task of its own: rows that are dear to work on are not put together by their
    bytes, and a task that begins by reading a large expression is not one of hundreds."""
    return df.repartition(8 * df.sparkSession.sparkContext.defaultParallelism, "page_id", "url")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced(read_table(spark, sf_dir, "pages").select(*PAGE_COLUMNS))


def _host(url):
    return F.regexp_extract(url, r"^[a-z]+://([^/:?#]+)", 1)


def _origin(url):
    return F.regexp_extract(url, r"^([a-z]+://[^/:?#]+)", 1)


def site_edges(pages_df: DataFrame) -> DataFrame:
    """In-site link plan over the page store: ``(page_id, dst)``.

    Within a host, pages are numbered ``rn`` by page_id (an exact rank built
    from range slices, so one huge host is not numbered by one task); page ``rn`` links to
    ``2rn+1``, ``2rn+2``, ``rn+5`` and (unless it is the root) back to ``0``.
    Targets are generated per page and equi-joined on ``(host, rn)``, so a
    host with many pages costs linear, not quadratic, work.
    """
    from sitegraph.plans.rank import split_row_number
    p1 = split_row_number(pages_df.select("page_id", "url", _host(F.col("url")).alias("host")),
                          ["host"], ["page_id"], "rn").withColumn("rn", F.col("rn") - 1)
    targets = p1.select(
        "page_id", "host",
        F.explode(F.array_distinct(F.filter(
            F.array(F.col("rn") * 2 + 1, F.col("rn") * 2 + 2, F.col("rn") + 5,
                    F.when(F.col("rn") > 0, F.lit(0))),
            lambda x: x.isNotNull()))).alias("trn"))
    dst = p1.select("host", F.col("rn").alias("trn"), F.col("url").alias("dst"))
    return p1, targets.join(dst, ["host", "trn"]).select("page_id", "dst")


def pages_plus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page store with in-site links, assets and meta tags added (F-PAGES+).

    Output: ``page_id, url, host, rn, html``.
    """
    base = pages(spark, sf_dir)
    p1, edges = site_edges(base)
    p1 = p1.join(base.select("page_id", "html"), "page_id")
    nav = (edges.groupBy("page_id")
           .agg(F.array_join(F.sort_array(F.collect_list(
               F.concat(F.lit('<a href="'), F.col("dst"), F.lit('">go</a>')))), "").alias("links")))
    pid = F.col("page_id")
    meta = F.concat(
        F.when(pid % 2 == 0, F.concat(F.lit('<meta name="description" content="d'),
                                      pid.cast("string"), F.lit('">'))).otherwise(F.lit("")),
        F.when(pid % 3 == 0, F.lit('<meta property="og:type" name="both" content="article">'))
        .otherwise(F.lit("")),
        F.when(pid % 5 == 0, F.lit('<meta name="robots" content="">')).otherwise(F.lit("")),
        F.lit("</head>"))
    extra = F.concat(
        F.lit("<article>"), F.coalesce(F.col("links"), F.lit("")),
        F.lit('<a href="#sec">s</a><a href="javascript:void(0)">j</a>'),
        F.concat(F.lit('<a href="/files/r'), (pid % 7).cast("string"), F.lit('.pdf?v=1">d</a>')),
        F.when(pid % 4 == 0, F.lit('<a href="https://other.example.edu/x">x</a>')).otherwise(F.lit("")),
        F.when(pid % 2 == 1, F.concat(F.lit('<img src="/img/'), pid.cast("string"), F.lit('.png">')))
        .otherwise(F.lit("")),
        F.when(pid % 6 == 0, F.lit('<img src="https://cdn.example.org/image?url=%2Fa%2Fb.jpg&w=10">'))
        .otherwise(F.lit("")),
        F.when(pid % 8 == 0, F.lit('<img src="data:image/png;base64,iVBORw0KGgo=">')).otherwise(F.lit("")),
        F.when(pid % 9 == 0, F.concat(F.lit('<iframe src="https://player.example.net/v/'),
                                      pid.cast("string"), F.lit('"></iframe>'))).otherwise(F.lit("")))
    html = F.replace(F.replace(F.col("html"), F.lit("</head>"), meta), F.lit("<article>"), extra)
    return (p1.join(nav, "page_id", "left")
            .select("page_id", "url", "host", F.col("rn").cast("bigint").alias("rn"), html.alias("html")))


def page_status(pages_df: DataFrame) -> DataFrame:
    """Fetch status per stored page (F-STATUS): some 404, some 500."""
    pid = F.col("page_id")
    status = F.when(pid % 13 == 5, 404).when(pid % 17 == 3, 500).otherwise(200)
    return pages_df.withColumn("status", status.cast("int"))


def robots_bodies(pages_df: DataFrame) -> DataFrame:
    """robots.txt body per origin (F-ROBOTS); some origins have none."""
    nl = "\n"
    o = pages_df.select(_origin(F.col("url")).alias("origin")).distinct()
    n = F.length("origin") % 4
    body = (F.when(n == 0, F.lit(f"User-agent: *{nl}Allow: /en/1{nl}Disallow: /en{nl}"))
            .when(n == 1, F.lit(f"# none{nl}User-agent: otherbot{nl}Disallow: /{nl}"
                                f"User-agent: testbot{nl}Disallow: /de{nl}"))
            .otherwise(F.lit(f"User-agent: *{nl}Disallow:{nl}")))
    return o.where(n != 3).select("origin", body.alias("body"))


def dense_robots_bodies(pages_df: DataFrame) -> DataFrame:
    """robots.txt per origin with a rule for each of its pages: the page's path or the beginning of it."""
    pid = F.col("page_id")
    path = F.regexp_replace(F.col("url"), r"^[a-z]+://[^/?#]*", "")
    p = pages_df.select("page_id", _origin(F.col("url")).alias("origin"), path.alias("path")).where("path <> ''")
    line = F.concat(F.when(pid % 3 == 0, "Allow: ").otherwise("Disallow: "),
                    F.when(pid % 2 == 0, F.col("path")).otherwise(F.expr("substring(path, 1, 4 + cast(page_id % 5 as int))")))
    lines = p.groupBy("origin").agg(F.sort_array(F.collect_list(F.struct("page_id", line.alias("line"))), asc=False).alias("l"))
    body = F.array_join(F.concat(F.array(F.lit("User-agent: *")), F.transform("l", lambda x: x["line"])), "\n")
    return lines.select("origin", body.alias("body"))


def unreadable_pages(pages_df: DataFrame) -> DataFrame:
    """Pages of which some have no URL to judge links by, some were not read and some are blank."""
    pid = F.col("page_id")
    return pages_df.select("page_id", F.when(pid % 7 == 3, "not a url").otherwise(F.col("url")).alias("url"),
                           F.when(pid % 5 == 2, F.lit(None)).when(pid % 11 == 4, "").otherwise(F.col("html")).alias("html"))


def stored_assets(pages_df: DataFrame) -> DataFrame:
    """Stored document responses (F-ASSETS): url, status, disposition, body."""
    o = pages_df.select(_origin(F.col("url")).alias("origin")).distinct()
    # document numbers 0..6 (page_id modulo 7), generated per origin
    n = F.col("n")
    return o.select("origin", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("n")).select(
        F.concat("origin", F.lit("/files/r"), n.cast("string"), F.lit(".pdf?v=1")).alias("url"),
        F.when(n % 3 == 0, 404).otherwise(200).cast("int").alias("status"),
        F.when(n % 2 == 0, F.concat(F.lit('attachment; filename="report%20'), n.cast("string"),
                                    F.lit('.pdf"'))).alias("disposition"),
        F.concat(F.lit("body "), n.cast("string")).alias("body"))


def stored_images(pages_df: DataFrame) -> DataFrame:
    """Stored image responses: one per image link of the pages, some of them failed, some without a body."""
    from sitegraph.operators import links as L
    u = L.page_links(pages_df, ["images"]).select(F.col("link").alias("url")).distinct()
    n = F.length("url") % 5
    return u.select("url", F.when(n == 1, 404).otherwise(200).cast("int").alias("status"),
                    F.lit(None).cast("string").alias("disposition"),
                    F.when(n != 2, F.concat(F.lit("image of "), F.col("url"))).alias("body"))


def search_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored web-search responses, one per document: ``query_id, body`` JSON."""
    d = read_table(spark, sf_dir, "documents")
    i = F.col("doc_id").cast("string")
    body = F.concat(
        F.lit('{"searchParameters":{"q":"'), F.col("lang"), F.lit(" "), i,
        F.lit('","engine":"google","type":"search"},"credits":1,'),
        F.lit('"knowledgeGraph":{"title":"t'), i, F.lit('","type":"'), F.col("source"), F.lit('"},'),
        F.lit('"organic":[{"position":1,"title":"a","link":"https://a.example.org/'), i,
        F.lit('","snippet":"s","sitelinks":[{"title":"x","link":"https://a.example.org/x"}]},'),
        F.lit('{"position":2,"title":"b","link":"https://b.example.org/'),
        (F.col("doc_id") % 9).cast("string"),
        F.lit('","snippet":"s","rating":4.5,"ratingCount":3}],'),
        F.lit('"peopleAlsoAsk":[{"question":"q","snippet":"s","link":"https://c.example.org/","title":"c"}],'
              '"images":[{"imageUrl":"https://img.example.org/'), i,
        F.lit('.png","link":"https://a.example.org/","title":"i"}],"extra":{"kept":[1,'),
        F.col("n_chars").cast("string"), F.lit("]}}"))
    return d.select(F.col("doc_id").alias("query_id"), body.alias("body"))


def _esc(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _conversation_page(spark: SparkSession, sf_dir: str, piece, head: str, tail: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations")
    per = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", piece.alias("h")))).alias("t"))
    body = F.array_join(F.transform("t", lambda x: x["h"]), "")
    html = F.concat(F.lit("<html><head><title>Conversation "), F.col("conv_id").cast("string"),
                    F.lit("</title></head><body><h2>Conversation "), F.col("conv_id").cast("string"),
                    F.lit("</h2>" + head), body, F.lit(tail + "</body></html>"))
    return per.select(F.col("conv_id").alias("page_id"), html.alias("html"))


def conversation_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per conversation: an ordered list of turns, each with a
    nested bullet list (role, turn number) and the whole turn text."""
    piece = F.concat(F.lit("<li><b>"), F.col("role"), F.lit("</b>: "), _esc(F.col("text")),
                     F.lit("<ul><li>"), F.col("role"), F.lit("</li><li>turn "), F.col("turn").cast("string"),
                     F.lit("</li></ul></li>"))
    return _conversation_page(spark, sf_dir, piece, "<ol>", "</ol>")


def conversation_table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per conversation: a table (header row, one row per turn)."""
    piece = F.concat(F.lit("<tr><td>"), F.col("turn").cast("string"), F.lit("</td><td><i>"), F.col("role"),
                     F.lit("</i></td><td>"), _esc(F.col("text")), F.lit("</td></tr>"))
    return _conversation_page(spark, sf_dir, piece, "<table><tr><th>turn</th><th>role</th><th>text</th></tr>",
                              "</table>")


def conversation_mixed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per conversation with what page authors leave out: an indented list of roles without
    li end tags, a quote in a quote, a table below the top level without cell end tags, a stray end
    tag, an a that the next a ends, padded inline code, references outside the short table."""
    c = read_table(spark, sf_dir, "conversations")
    per = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    cid = F.col("conv_id").cast("string")
    items = F.array_join(F.transform("t", lambda x: F.concat(F.lit(" <li>"), x["role"], F.lit("\n"))), "")
    quote = F.array_join(F.transform("t", lambda x: F.concat(F.lit("<p>"), _esc(x["text"]), F.lit("</p>"))), "")
    html = F.concat(F.lit("<html><body>\n<ul>\n"), items, F.lit("</ul>\n<blockquote>c <b>"), cid, F.lit("</b> <blockquote>"), quote,
                    F.lit("</blockquote></blockquote><div><table><tr><td>"), F.size("t").cast("string"),
                    F.lit('<td>turns</table></div></b><p><a href="/1">x<a href="/2">y</a></p><p><code> '), cid,
                    F.lit(" </code>&#128512;&check;</p></body></html>"))
    return per.select(F.col("conv_id").alias("page_id"), html.alias("html"))


def document_block_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per document: each line as a paragraph in a blockquote, then
    the whole text as a code block tagged with the document language."""
    d = balanced(read_table(spark, sf_dir, "documents"), "doc_id")
    lines = F.split(_esc(F.col("text")), "\n")
    quote = F.array_join(F.transform(lines, lambda l: F.concat(F.lit("<p>"), l, F.lit("</p>"))), "")
    html = F.concat(F.lit("<html><body><h3>"), F.col("source"), F.lit("</h3><blockquote>"), quote,
                    F.lit("</blockquote><pre><code data-language=\""), F.col("lang"), F.lit("\">"),
                    _esc(F.col("text")), F.lit("</code></pre></body></html>"))
    return d.select(F.col("doc_id").alias("page_id"), html.alias("html"))
