"""robots.txt rules as a join.

The rule order of the crawler is kept: lines are read top to bottom; a
``User-agent:`` line sets whether the following rules apply (``*`` or our
agent, case-insensitive; a later agent line replaces the earlier one); among
applying rules the *first* that hits decides.  ``Disallow:`` hits when its
path is empty or the URL starts with origin + path; ``Allow:`` hits when the
URL starts with origin + path.  No hit, or no robots body: allowed.

Plan: one row per origin holds an index of its applying rules (bounded by the size
of one robots file).  URLs are equi-joined to it on origin (AQE broadcasts it when
small, or splits a skewed origin) and the first hit is found inside the row, so URL
rows are never grouped or shuffled by URL.

The index is the origin's rule paths in byte order; each carries its *chain*, the rule
paths that it begins with and itself, with the first line of each.  All rules that hit a
URL are prefixes of its rest behind the origin, and the longest of them is in the chain of
the last path that is not above that rest: whatever stands between the two in byte order
begins with the longest prefix too.  So a URL costs one binary search and the filter of one
chain, whose length is the nesting of the rules, not their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegraph.functions import urls as U
from sitegraph.functions.html import let

INDEX_TYPE = "array<struct<path:string,chain:array<struct<len:int,line_no:int,rule:string>>>>"


def robots_rules(robots_df: DataFrame, user_agent: str | None) -> DataFrame:
    """Long rule table ``origin, line_no, agent_ok, rule, path`` (all rules)."""
    ua = (user_agent or "").lower()
    lines = robots_df.select("origin", F.posexplode(F.split("body", "\n")).alias("line_no", "raw"))
    line = F.regexp_replace(F.col("raw"), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    low = F.lower(line)
    df = lines.select("origin", "line_no", line.alias("line"), low.alias("low"))
    df = df.where((F.col("line") != "") & ~F.col("line").startswith("#"))
    agent = F.regexp_replace(F.substring("line", 12, 1 << 30), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    agent_ok = F.when(F.col("low").startswith("user-agent:"),
                      (agent == "*") | (F.lower(agent) == F.lit(ua)) if ua else (agent == "*"))
    w = Window.partitionBy("origin").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("is_agent", agent_ok.isNotNull()) \
           .withColumn("agent_ok", F.coalesce(F.last(agent_ok, ignorenulls=True).over(w), F.lit(False)))
    rule = (F.when(F.col("low").startswith("disallow:"), F.lit("disallow"))
            .when(F.col("low").startswith("allow:"), F.lit("allow")))
    rpath = F.when(rule == "disallow", F.substring("line", 10, 1 << 30)).otherwise(
        F.substring("line", 7, 1 << 30))
    rpath = F.regexp_replace(rpath, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    return (df.where(~F.col("is_agent"))
            .select("origin", F.col("line_no").cast("int").alias("line_no"), "agent_ok",
                    rule.alias("rule"), rpath.alias("path"))
            .where(F.col("rule").isNotNull()))


def rules_by_origin(robots_df: DataFrame, user_agent: str | None) -> DataFrame:
    """One row per origin with a body: ``origin``, ``rules`` (the index of its applying rules) and
    ``closed`` (an empty Disallow stands there, which also hits a URL that does not begin with the origin)."""
    r = robots_rules(robots_df, user_agent).where("agent_ok")
    closed = F.max((F.col("rule") == "disallow") & (F.col("path") == "")).alias("closed")
    flags = r.groupBy("origin").agg(closed)
    own = r.groupBy("origin", "path").agg(F.min(F.struct("line_no", "rule")).alias("first"))
    begins = own.select("origin", F.col("path").alias("whole"), F.explode(F.sequence(F.lit(0), F.length("path"))).alias("len"))
    begins = begins.withColumn("path", F.expr("substring(whole, 1, len)"))
    chains = begins.join(own, ["origin", "path"]).groupBy("origin", F.col("whole").alias("path")).agg(
        F.array_sort(F.collect_list(F.struct("len", "first.line_no", "first.rule"))).alias("chain"))
    per = chains.groupBy("origin").agg(F.array_sort(F.collect_list(F.struct("path", "chain"))).alias("rules"))
    # origins whose body has no applying rule still have a body
    return (robots_df.select("origin").distinct()
            .join(per, "origin", "left").join(flags, "origin", "left")
            .select("origin", F.coalesce("rules", F.array().cast(INDEX_TYPE)).alias("rules"),
                    F.coalesce("closed", F.lit(False)).alias("closed")))


def first_hit(rest: Column, rules: Column) -> Column:
    """``struct<line_no, rule, len>`` of the first rule whose path ``rest`` begins with, null if there is none."""
    def step(acc, _):
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        below = F.get(rules, mid)["path"] <= rest
        return F.struct(F.when((acc["lo"] < acc["hi"]) & below, mid + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when((acc["lo"] < acc["hi"]) & ~below, mid).otherwise(acc["hi"]).alias("hi"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(rules) + 1)).cast("int"))
    found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(rules).alias("hi")), step, lambda acc: F.get(rules, acc["lo"] - 1))

    def hits(entry):
        return F.filter(entry["chain"], lambda x: F.startswith(rest, F.substr(entry["path"], F.lit(1), x["len"])))
    return let(found, lambda e: F.array_min(F.transform(hits(e), lambda x: F.struct(x["line_no"], x["rule"], x["len"]))))


def robots_allowed(urls_df: DataFrame, robots_df: DataFrame, user_agent: str | None,
                   url_col: str = "url", out_col: str = "allowed") -> DataFrame:
    """Add a boolean ``allowed`` column to a DataFrame of URLs."""
    return allowed_by_rules(urls_df, rules_by_origin(robots_df, user_agent), url_col, out_col)


def allowed_by_rules(urls_df: DataFrame, rules_df: DataFrame, url_col: str = "url",
                     out_col: str = "allowed") -> DataFrame:
    """As ``robots_allowed`` with the per-origin rule table already built
    (``rules_by_origin``), e.g. once per crawl instead of once per level."""
    o = U.origin(F.col(url_col))
    rules = rules_df.select(F.col("origin").alias("_origin"), F.col("rules").alias("_rules"), F.col("closed").alias("_closed"))
    df = urls_df.withColumn("_origin", o).join(rules, "_origin", "left")
    url = F.col(url_col)
    rest = F.when(url.startswith(F.col("_origin")), F.substr(url, F.length("_origin") + 1))
    hit = let(F.struct(rest.alias("rest"), F.col("_rules").alias("rules")), lambda x: first_hit(x["rest"], x["rules"]))
    allowed = (F.when(F.col("_rules").isNull(), F.lit(True)).when(rest.isNull(), ~F.col("_closed"))
               .otherwise(F.coalesce(hit["rule"] == "allow", F.lit(True))))
    return df.withColumn(out_col, allowed).drop("_origin", "_rules", "_closed")


def robots_page_status(pages_df: DataFrame, robots_df: DataFrame, user_agent: str | None) -> DataFrame:
    """Page operations under robots enforcement: ``status`` is 'ok' or
    'disallowed' (the reference raises an error for the latter)."""
    df = robots_allowed(pages_df, robots_df, user_agent)
    return df.withColumn("status", F.when(F.col("allowed"), "ok").otherwise("disallowed")).drop("allowed")
