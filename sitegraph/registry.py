"""Registered queries (one per operator of the survey) and their DuckDB
oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the operator over the
whole given tables (or inputs Spark derives from them).  ``ORACLE[name]`` is
an independent DuckDB statement over the same tables that must give the same
rows (the crawl as a recursive CTE, the nested tree as a fixed-depth fold,
streams against their batch result).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from sitegraph.functions import html as H
from sitegraph.functions import patterns as P
from sitegraph.operators import insights as I
from sitegraph.operators import links as L
from sitegraph.oracle import duck as D
from sitegraph.oracle import fixtures_sql as FX
from sitegraph.sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# Parameters used by the registered queries (fixed, part of each query).
INCLUDE_PATTERNS = [r"https?://[^/]*/en/.*", r".*\.pdf\?v=1"]
EXCLUDE_PATTERNS = [r"https?://[^/]*/en/.*", r".*\.pdf\?v=1"]
COUNT_SELECTORS = ["div", "p", "h1", "h2", "h3", "h4", "h5", "a", "li", "b", "img", "meta"]


# ------------------------------------------------------------------ oracle
def _sql_links(src: str, kinds=None, patterns=None, logic=None) -> str:
    """Long link rows (page_id, url, kind, link, pos) from page source ``src``."""
    kinds = kinds or L.ALL_KINDS
    parts = []
    spec = [("a", "href", None), ("iframe", "src", "'iframe'"), ("img", "src", "'images'")]
    for tag, at, kexpr in spec:
        if tag == "a" and not any(k in L.A_KINDS for k in kinds):
            continue
        if tag == "iframe" and "iframe" not in kinds:
            continue
        if tag == "img" and "images" not in kinds:
            continue
        kind = kexpr or D.link_kind("url", "link")
        parts.append(f"""
SELECT page_id, url, {kind} AS kind, link,
       (row_number() OVER (PARTITION BY page_id ORDER BY o) - 1)::BIGINT AS pos
FROM (
  SELECT page_id, url, link, min(o) AS o FROM (
    SELECT page_id, url, {D.resolve_url('url', 'h')} AS link, o FROM (
      SELECT page_id, url, {D.attr('t', at)} AS h, o FROM (
        SELECT page_id, url, unnest(tags) AS t, unnest(range(1, len(tags) + 1)) AS o
        FROM (SELECT page_id, url, {D.start_tags(D.clean_html('html'), tag)} AS tags FROM {src}) s0
      ) s1
    ) s2 WHERE h IS NOT NULL
  ) s3 WHERE {D.url_filter('link', patterns, logic)}
  GROUP BY page_id, url, link
) s4""")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT * FROM ({body}) u WHERE kind IN ({', '.join(D.q(k) for k in kinds)})"


def _sql_text_cte(src: str) -> str:
    return f"ptext AS (SELECT page_id, url, {D.clean_html('html')} AS c FROM {src})"


def _json_sql(**fields: str) -> str:
    """A JSON object of strings without the empty ones."""
    parts = ", ".join(f"CASE WHEN coalesce({v}, '') <> '' THEN concat('\"{k}\":', CAST(to_json({v}) AS VARCHAR)) END" for k, v in fields.items())
    return f"concat('{{', concat_ws(',', {parts}), '}}')"


# ------------------------------------------------------------- insights
def _insights_sql(src_ctes: list[str], src: str) -> str:
    counts = ", ".join(f"len({D.start_tags('t.c', t)})::BIGINT AS {t}" for t in P.DEFAULT_COUNT_TAGS)
    lk = ", ".join(f"count(DISTINCT CASE WHEN l.kind = '{k}' THEN l.link END)::BIGINT AS {k}"
                   for k in ["internal", "external", "reference", "iframe", "images"])
    return with_ctes(*src_ctes, _sql_text_cte(src), f"lk AS ({_sql_links(src)})") + f"""
SELECT t.page_id, t.url, {D.title_of('t.c')} AS title, {counts},
       {', '.join(f'coalesce(x.{k}, 0)::BIGINT AS {k}' for k in ['internal', 'external', 'reference', 'iframe', 'images'])},
       {D.word_count(D.text_of('t.c'))} AS word_count
FROM ptext t LEFT JOIN (SELECT page_id, {lk} FROM lk l GROUP BY page_id) x ON t.page_id = x.page_id
"""


def _insights_cols():
    return (["page_id", "url", "title"] + P.DEFAULT_COUNT_TAGS
            + ["internal", "external", "reference", "iframe", "images", "word_count"])


@register("page_insights", _insights_sql([], "pages"))
def q_page_insights(spark, sf):
    return I.page_insights(T.pages(spark, sf), with_link_sets=False).select(*_insights_cols())


@register("page_insights_plus", _insights_sql([FX.PAGES_PLUS], "pplus"))
def q_page_insights_plus(spark, sf):
    return I.page_insights(T.pages_plus(spark, sf), with_link_sets=False).select(*_insights_cols())


@register("link_counts", with_ctes(FX.PAGES_PLUS, f"lk AS ({_sql_links('pplus')})") + """
SELECT p.page_id, """ + ", ".join(
    f"count(DISTINCT CASE WHEN l.kind = '{k}' THEN l.link END)::BIGINT AS {k}"
    for k in ["internal", "external", "reference", "iframe", "images"]) + """
FROM pplus p LEFT JOIN lk l ON p.page_id = l.page_id GROUP BY p.page_id
""")
def q_link_counts(spark, sf):
    df = L.with_links(T.pages_plus(spark, sf))
    return df.select("page_id", *[c.alias(k) for k, c in L.link_counts(F.col("links")).items()])


@register("page_links", with_ctes(FX.PAGES_PLUS) + _sql_links("pplus"))
def q_page_links(spark, sf):
    return L.page_links(T.pages_plus(spark, sf)).withColumn("pos", F.col("pos").cast("bigint"))


@register("link_kind", with_ctes(FX.PAGES_PLUS) +
          f"SELECT page_id, link, kind FROM ({_sql_links('pplus', L.A_KINDS)}) z")
def q_link_kind(spark, sf):
    return L.page_links(T.pages_plus(spark, sf), L.A_KINDS).select("page_id", "link", "kind")


@register("url_filter_include", with_ctes(FX.PAGES_PLUS) +
          _sql_links("pplus", None, INCLUDE_PATTERNS, "include"))
def q_url_filter_include(spark, sf):
    return (L.page_links(T.pages_plus(spark, sf), None, INCLUDE_PATTERNS, "include")
            .withColumn("pos", F.col("pos").cast("bigint")))


@register("url_filter_exclude", with_ctes(FX.PAGES_PLUS) +
          _sql_links("pplus", None, EXCLUDE_PATTERNS, "exclude"))
def q_url_filter_exclude(spark, sf):
    return (L.page_links(T.pages_plus(spark, sf), None, EXCLUDE_PATTERNS, "exclude")
            .withColumn("pos", F.col("pos").cast("bigint")))


@register("link_sets", with_ctes(FX.PAGES_PLUS) + f"""
SELECT page_id, kind, link,
       (row_number() OVER (PARTITION BY page_id, kind ORDER BY link) - 1)::BIGINT AS ord
FROM ({_sql_links('pplus')}) z
""")
def q_link_sets(spark, sf):
    df = L.with_links(T.pages_plus(spark, sf))
    sets = L.link_sets(F.col("links"))
    arr = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("ls")) for k, v in sets.items()])
    return (df.select("page_id", F.explode(arr).alias("s"))
            .select("page_id", "s.kind", F.posexplode("s.ls").alias("ord", "link"))
            .select("page_id", "kind", "link", F.col("ord").cast("bigint").alias("ord")))


_KINDS = ["all", "documents", "internal", "external", "reference", "iframe", "images", "element_counts"]


@register("insight_kinds", with_ctes(FX.PAGES_PLUS, _sql_text_cte("pplus"), f"lk AS ({_sql_links('pplus')})",
                                     "asked(asked) AS (VALUES " + ", ".join(f"('{k}')" for k in _KINDS) + ")") + f"""
, counted AS (
  SELECT a.asked, t.page_id, t.url, {D.title_of('t.c')} AS title,
         CASE WHEN a.asked IN ('all', 'element_counts') THEN len({D.start_tags('t.c', 'p')})::BIGINT END AS p,
         CASE WHEN a.asked IN ('all', 'element_counts') THEN {D.word_count(D.text_of('t.c'))} END AS word_count
  FROM asked a, ptext t)
SELECT c.asked, c.page_id, c.url, c.title, c.p, c.word_count, l.kind, l.link
FROM counted c LEFT JOIN lk l ON l.page_id = c.page_id AND (l.kind = c.asked OR c.asked = 'all')""")
def q_insight_kinds(spark, sf):
    """Each kind a caller may ask for: what it counts and the links it returns."""
    def tagged(kind):
        return lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("link"))

    pp, out = T.spread(T.pages_plus(spark, sf).select("page_id", "url", "html")), None
    for asked in _KINDS:
        df = I.page_insights(pp, kinds=asked)
        kinds = L.INSIGHT_KINDS[asked]
        links = F.concat(*[F.transform(f"{k}_links", tagged(k)) for k in kinds]) if kinds else F.lit(None).cast("array<struct<kind:string,link:string>>")
        count = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("bigint")  # noqa: B023, E731
        df = df.select(F.lit(asked).alias("asked"), "page_id", "url", "title", count("p").alias("p"),
                       count("word_count").alias("word_count"), F.inline_outer(links))
        out = df if out is None else out.unionByName(df)
    return out


_UNREADABLE = """
unreadable AS (
  SELECT page_id, CASE WHEN page_id % 7 = 3 THEN 'not a url' ELSE url END AS url,
         CASE WHEN page_id % 5 = 2 THEN NULL WHEN page_id % 11 = 4 THEN '' ELSE html END AS html FROM pages)"""
_REASON = "CASE WHEN u.html IS NULL THEN 'no_html' WHEN u.url = 'not a url' THEN 'bad_url' END"


@register("insights_status", with_ctes(_UNREADABLE, _sql_text_cte("unreadable"), f"lk AS ({_sql_links('unreadable')})") + f"""
SELECT u.page_id, u.url, CASE WHEN {_REASON} IS NULL THEN 'ok' ELSE 'bad_page' END AS status,
       CASE WHEN {_REASON} IS NULL THEN coalesce(x.internal, 0) END::BIGINT AS internal,
       CASE WHEN {_REASON} IS NULL THEN {D.word_count(D.text_of('t.c'))} END AS word_count
FROM unreadable u JOIN ptext t ON t.page_id = u.page_id
LEFT JOIN (SELECT page_id, count(DISTINCT CASE WHEN kind = 'internal' THEN link END) AS internal FROM lk GROUP BY page_id) x
  ON x.page_id = u.page_id""")
def q_insights_status(spark, sf):
    """Pages that were not read, or whose URL gives no base, among the others."""
    out = I.page_insights(T.unreadable_pages(T.pages(spark, sf)), with_link_sets=False)
    return out.select("page_id", "url", "status", "internal", "word_count")


def _cand_sql(restrict: bool) -> str:
    kinds = ["internal"] if restrict else ["internal", "external", "iframe"]
    return with_ctes(FX.PAGES_PLUS) + f"""
SELECT DISTINCT page_id, link FROM ({_sql_links('pplus', kinds)}) z
"""


@register("crawl_candidates", _cand_sql(False))
def q_crawl_candidates(spark, sf):
    df = L.with_links(T.pages_plus(spark, sf))
    return df.select("page_id", F.explode(L.crawl_links(F.col("links"), False)).alias("link"))


@register("crawl_restricted", _cand_sql(True))
def q_crawl_restricted(spark, sf):
    df = L.with_links(T.pages_plus(spark, sf), kinds=["internal"])
    return df.select("page_id", F.explode(L.crawl_links(F.col("links"), True)).alias("link"))


# ------------------------------------------------------------ text/title
@register("page_title", with_ctes(_sql_text_cte("pages")) +
          f"SELECT page_id, {D.title_of('c')} AS title FROM ptext")
def q_page_title(spark, sf):
    return T.pages(spark, sf).select("page_id", H.title_of(H.clean_html(F.col("html"))).alias("title"))


@register("content_text", with_ctes(_sql_text_cte("pages")) +
          f"SELECT page_id, url, {D.text_of('c')} AS content FROM ptext")
def q_content_text(spark, sf):
    return T.pages(spark, sf).select("page_id", "url",
                                     H.text_of(H.clean_html(F.col("html"))).alias("content"))


@register("word_count", with_ctes(_sql_text_cte("pages")) +
          f"SELECT page_id, {D.word_count(D.text_of('c'))} AS word_count FROM ptext")
def q_word_count(spark, sf):
    return T.pages(spark, sf).select(
        "page_id", H.word_count(H.text_of(H.clean_html(F.col("html")))).alias("word_count"))


@register("element_counts", with_ctes(FX.PAGES_PLUS, _sql_text_cte("pplus")) + " UNION ALL ".join(
    f"SELECT page_id, {D.q(t)} AS tag, len({D.start_tags('c', t)})::BIGINT AS n FROM ptext"
    for t in COUNT_SELECTORS))
def q_element_counts(spark, sf):
    from sitegraph.functions import selectors as S
    df = T.pages_plus(spark, sf).select("page_id", H.clean_html(F.col("html")).alias("c"))
    arr = F.array(*[F.struct(F.lit(t).alias("tag"), S.element_count(F.col("c"), t).alias("n"))
                    for t in COUNT_SELECTORS])
    return df.select("page_id", F.inline(arr))


# ------------------------------------------------------------------ meta
@register("page_meta_tags", with_ctes(FX.PAGES_PLUS) + f"""
, m AS (
  SELECT page_id, url, unnest(tags) AS t, unnest(range(1, len(tags) + 1)) AS o
  FROM (SELECT page_id, url, {D.start_tags(D.clean_html('html'), 'meta')} AS tags FROM pplus) s),
a AS (
  SELECT page_id, url, o, coalesce({D.attr('t', 'name')}, '') AS nm,
         coalesce({D.attr('t', 'property')}, '') AS pr, coalesce({D.attr('t', 'content')}, '') AS content
  FROM m)
SELECT page_id, url, (row_number() OVER (PARTITION BY page_id ORDER BY o) - 1)::BIGINT AS pos,
       CASE WHEN pr = '' THEN nm END AS name, CASE WHEN pr <> '' THEN pr END AS property, content
FROM a WHERE (nm <> '' OR pr <> '') AND content <> ''
""")
def q_page_meta_tags(spark, sf):
    from sitegraph.operators import meta as M
    return M.page_meta_tags(T.pages_plus(spark, sf))


# ---------------------------------------------------------------- robots
USER_AGENT = "testbot"


def _robots_rules_sql() -> str:
    tj = r"'^[\x00-\x20]+|[\x00-\x20]+$'"
    return f"""
rlines AS (
  SELECT origin, line_no, line, lower(line) AS low FROM (
    SELECT origin, o AS line_no, regexp_replace(raw, {tj}, '', 'g') AS line FROM (
      SELECT origin, unnest(string_split(body, chr(10))) AS raw,
             unnest(range(0, len(string_split(body, chr(10))))) AS o FROM robots) s) s2
  WHERE line <> '' AND NOT starts_with(line, '#')),
rflag AS (
  SELECT *, CASE WHEN starts_with(low, 'user-agent:') THEN
      (regexp_replace(line[12:], {tj}, '', 'g') = '*'
       OR lower(regexp_replace(line[12:], {tj}, '', 'g')) = {D.q(USER_AGENT)}) END AS ua
  FROM rlines),
rok AS (
  SELECT *, coalesce(last_value(ua IGNORE NULLS) OVER (PARTITION BY origin ORDER BY line_no
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS agent_ok FROM rflag),
rules AS (
  SELECT origin, line_no,
         CASE WHEN starts_with(low, 'disallow:') THEN 'disallow' WHEN starts_with(low, 'allow:') THEN 'allow' END AS rule,
         CASE WHEN starts_with(low, 'disallow:') THEN regexp_replace(line[10:], {tj}, '', 'g')
              ELSE regexp_replace(line[7:], {tj}, '', 'g') END AS path
  FROM rok WHERE agent_ok AND ua IS NULL
    AND (starts_with(low, 'disallow:') OR starts_with(low, 'allow:')))"""


def _robots_allowed_sql(urls_cte: str) -> str:
    """``urls_cte`` defines ``u(page_id, url)``; yields ``ra(page_id, url, allowed)``."""
    return f"""{urls_cte},
uo AS (SELECT page_id, url, {D.origin('url')} AS o FROM u),
hits AS (
  SELECT uo.page_id, min(r.line_no) AS first_line FROM uo JOIN rules r ON r.origin = uo.o
  WHERE (r.rule = 'disallow' AND (r.path = '' OR starts_with(uo.url, concat(r.origin, r.path))))
     OR (r.rule = 'allow' AND starts_with(uo.url, concat(r.origin, r.path)))
  GROUP BY uo.page_id),
ra AS (
  SELECT uo.page_id, uo.url, coalesce(r.rule = 'allow', true) AS allowed
  FROM uo LEFT JOIN hits h ON h.page_id = uo.page_id
  LEFT JOIN rules r ON r.origin = uo.o AND r.line_no = h.first_line)"""


@register("robots_allowed", with_ctes(FX.ROBOTS, _robots_rules_sql(),
                                      _robots_allowed_sql("u AS (SELECT page_id, url FROM pages)"))
          + "SELECT page_id, url, allowed FROM ra")
def q_robots_allowed(spark, sf):
    from sitegraph.operators import robots as R
    p = T.pages(spark, sf)
    return R.robots_allowed(p.select("page_id", "url"), T.robots_bodies(p), USER_AGENT)


@register("robots_page_status", with_ctes(FX.ROBOTS, _robots_rules_sql(),
                                          _robots_allowed_sql("u AS (SELECT page_id, url FROM pages)"))
          + "SELECT page_id, url, CASE WHEN allowed THEN 'ok' ELSE 'disallowed' END AS status FROM ra")
def q_robots_page_status(spark, sf):
    from sitegraph.operators import robots as R
    p = T.pages(spark, sf)
    return R.robots_page_status(p.select("page_id", "url"), T.robots_bodies(p), USER_AGENT)


def _dense_sql() -> str:
    return """
pl AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/:?#]+)', 1) AS origin,
              regexp_replace(url, '^[a-z]+://[^/?#]*', '') AS path FROM pages),
robots AS (
  SELECT origin, 'User-agent: *' || chr(10) || string_agg(
           CASE WHEN page_id % 3 = 0 THEN 'Allow: ' ELSE 'Disallow: ' END
           || CASE WHEN page_id % 2 = 0 THEN path ELSE substring(path, 1, 4 + (page_id % 5)::INTEGER) END, chr(10)
           ORDER BY page_id DESC) AS body
  FROM pl WHERE path <> '' GROUP BY origin)"""


@register("robots_dense", with_ctes(_dense_sql(), _robots_rules_sql(), _robots_allowed_sql("u AS (SELECT page_id, url FROM pages)"))
          + "SELECT page_id, url, allowed FROM ra")
def q_robots_dense(spark, sf):
    """Bodies with a rule for every page of the site, whole paths and beginnings of them."""
    from sitegraph.operators import robots as R
    p = T.pages(spark, sf)
    return R.robots_allowed(p.select("page_id", "url"), T.dense_robots_bodies(p), USER_AGENT)


# ----------------------------------------------------------------- crawl
# Fixed run timestamp of the registered queries (file names must be reproducible).
RUN_TS = "20260101000000000"
CRAWL_DEPTH = 3
REFERRER = "https://referrer.example/"


def _crawl_inputs(spark, sf):
    pp = T.pages_plus(spark, sf)
    store = T.page_status(pp.select("page_id", "url", "html"))
    roots = pp.where("rn = 0").select(F.col("url").alias("root_url"))
    return pp, store, roots


def _crawl(spark, sf, restrict=False, depth=CRAWL_DEPTH, robots=False):
    from sitegraph.plans import crawl as C
    pp, store, roots = _crawl_inputs(spark, sf)
    opts = C.CrawlOptions(max_depth=depth, restrict=restrict, referrer=REFERRER,
                          enforce_robots=robots, user_agent=USER_AGENT if robots else None,
                          delay_ms=250)
    rb = T.robots_bodies(pp) if robots else None
    return C.crawl(store, roots, opts, rb), opts


def _crawl_sql(restrict=False, depth=CRAWL_DEPTH, robots=False, roots="WHERE rn = 0") -> str:
    kinds = ["internal"] if restrict else ["internal", "external", "iframe"]
    pstat = """pstat AS (
  SELECT page_id, url, html,
         CASE WHEN page_id % 13 = 5 THEN 404 WHEN page_id % 17 = 3 THEN 500 ELSE 200 END AS status
  FROM pplus)"""
    ctes = [FX.PAGES_PLUS, pstat] + ([FX.ROBOTS, _robots_rules_sql()] if robots else [])
    rb_join = "JOIN ra ON ra.url = w.url AND ra.allowed" if robots else ""
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes) + f""",
gk AS (SELECT {D.clean_url('url')} AS key,
              arg_min(page_id, (CASE WHEN status = 200 THEN 0 ELSE 1 END, page_id)) AS page_id FROM pstat GROUP BY 1),
g AS (SELECT gk.key, gk.page_id, p.status = 200 AS valid, p.html FROM gk JOIN pstat p ON p.page_id = gk.page_id
      WHERE gk.key IS NOT NULL),
gsrc AS (SELECT page_id, key AS url, html FROM g),
cedges AS (SELECT DISTINCT url AS src, {D.clean_url('link')} AS dst
          FROM ({_sql_links('gsrc', kinds)}) z WHERE {D.clean_url('link')} IS NOT NULL),
roots AS (SELECT url AS root_url, {D.clean_url('url')} AS url FROM pplus {roots}),
{_robots_allowed_sql("""u AS (SELECT row_number() OVER (ORDER BY url) AS page_id, url FROM (
  SELECT key AS url FROM g UNION SELECT dst FROM cedges UNION SELECT url FROM roots) x)""") if robots
  else "ra AS (SELECT NULL AS url, true AS allowed)"},
walk(root_url, url, depth) AS (
  SELECT root_url, url, 0 FROM roots
  UNION
  SELECT w.root_url, e.dst, w.depth + 1 FROM walk w
  JOIN g ON g.key = w.url AND g.valid JOIN cedges e ON e.src = w.url {rb_join} WHERE w.depth < {depth}),
nodes AS (SELECT root_url, url, min(depth) AS depth FROM walk GROUP BY root_url, url),
parents AS (
  SELECT n.root_url, n.url, min(p.url) AS parent_url FROM nodes n
  JOIN nodes p ON p.root_url = n.root_url AND p.depth = n.depth - 1
  JOIN g ON g.key = p.url AND g.valid
  JOIN cedges e ON e.src = p.url AND e.dst = n.url
  {rb_join.replace("w.url", "p.url")}
  GROUP BY n.root_url, n.url),
cn AS (
  SELECT n.root_url, n.url, n.depth, pa.parent_url, g.page_id,
         coalesce(g.valid, false) AS valid, coalesce(ra.allowed, true) AS allowed,
         CASE WHEN NOT coalesce(ra.allowed, true) THEN 'disallowed'
              WHEN coalesce(g.valid, false) THEN 'ok' ELSE 'failed' END AS status
  FROM nodes n LEFT JOIN parents pa ON pa.root_url = n.root_url AND pa.url = n.url
  LEFT JOIN g ON g.key = n.url LEFT JOIN ra ON ra.url = n.url),
mn AS (
  SELECT * FROM cn WHERE CASE WHEN depth = 0 THEN valid OR (NOT allowed AND ({depth} > 0 OR valid))
                              ELSE valid AND allowed END),
pth(root_url, url, sort_key) AS (
  SELECT root_url, url, url FROM cn WHERE depth = 0
  UNION ALL
  SELECT c.root_url, c.url, concat(p.sort_key, chr(1), c.url) FROM pth p
  JOIN cn c ON c.root_url = p.root_url AND c.parent_url = p.url)
"""


@register("crawl_tree", _crawl_sql() +
          "SELECT root_url, url, depth, parent_url, coalesce(page_id, -1) AS page_id, status FROM cn")
def q_crawl_tree(spark, sf):
    nodes, _ = _crawl(spark, sf)
    return nodes.select("root_url", "url", "depth", "parent_url",
                        F.coalesce("page_id", F.lit(-1).cast("bigint")).alias("page_id"), "status")


@register("crawl_depth", _crawl_sql(restrict=True, depth=6)
          + "SELECT root_url, url, depth, parent_url FROM cn")
def q_crawl_depth(spark, sf):
    nodes, _ = _crawl(spark, sf, restrict=True, depth=6)
    return nodes.select("root_url", "url", "depth", "parent_url")


@register("crawl_overlapping", _crawl_sql(depth=4, roots="")
          + "SELECT root_url, url, depth, parent_url, status FROM cn")
def q_crawl_overlapping(spark, sf):
    """Every page is a root: crawls that walk the same pages, 64 of them to a row."""
    from sitegraph.plans import crawl as C
    pp, store, _ = _crawl_inputs(spark, sf)
    nodes = C.crawl(store, pp.select(F.col("url").alias("root_url")), C.CrawlOptions(max_depth=4, referrer=REFERRER))
    return nodes.select("root_url", "url", "depth", "parent_url", "status")


@register("request_plan", _crawl_sql() + f"""
SELECT root_url, url, depth, CASE WHEN depth = 0 THEN {D.q(REFERRER)} ELSE parent_url END AS referrer FROM cn""")
def q_request_plan(spark, sf):
    from sitegraph.plans import crawl as C
    nodes, _ = _crawl(spark, sf)
    return C.request_plan(nodes)


@register("politeness_plan", _crawl_sql() + """
SELECT root_url, url, depth,
       ((row_number() OVER (PARTITION BY root_url ORDER BY depth, url) - 1) * 250)::BIGINT AS start_ms FROM cn""")
def q_politeness_plan(spark, sf):
    from sitegraph.plans import crawl as C
    nodes, opts = _crawl(spark, sf)
    return C.politeness_plan(nodes, opts.delay_ms)


@register("site_children", _crawl_sql() + """
SELECT root_url, parent_url, url AS child_url,
       (row_number() OVER (PARTITION BY root_url, parent_url ORDER BY url) - 1)::BIGINT AS ord
FROM cn WHERE parent_url IS NOT NULL""")
def q_site_children(spark, sf):
    from sitegraph.plans import sitemap as SM
    nodes, _ = _crawl(spark, sf)
    return SM.site_children(nodes)


def _tree_sql() -> str:
    """Fold the crawl tree bottom-up, one level per CTE (depth is fixed)."""
    levels = []
    for d in range(CRAWL_DEPTH, -1, -1):
        kids = (f"LEFT JOIN (SELECT root_url, parent_url, string_agg(j, ',' ORDER BY url, j) AS k FROM t{d + 1} "
                f"GROUP BY root_url, parent_url) c ON c.root_url = n.root_url AND c.parent_url = n.url"
                if d < CRAWL_DEPTH else "")
        kid_json = "CASE WHEN c.k IS NOT NULL THEN concat(',\"children\":[', c.k, ']') ELSE '' END" \
            if d < CRAWL_DEPTH else "''"
        levels.append(f"""t{d} AS (
  SELECT n.root_url, n.url, n.parent_url,
         concat('{{"url":"', n.url, '"',
                CASE WHEN n.file_name IS NOT NULL AND n.file_name <> '' THEN concat(',"fileName":"', n.file_name, '"')
                     ELSE '' END, {kid_json}, '}}') AS j
  FROM tn n {kids} WHERE n.depth = {d})""")
    return _crawl_sql() + f""",
ptext AS (SELECT page_id, {D.clean_html('html')} AS c FROM pplus),
tn AS (SELECT cn.root_url, cn.url, cn.parent_url, cn.depth,
              CASE WHEN cn.status = 'ok' THEN concat({D.sanitize_file_name(D.title_of('p.c'))}, '_', {D.q(RUN_TS)}, '.json')
              END AS file_name
       FROM cn LEFT JOIN ptext p ON p.page_id = cn.page_id),
""" + ",\n".join(levels) + "\nSELECT root_url, j AS tree_json FROM t0"


@register("site_tree_json", _tree_sql())
def q_site_tree_json(spark, sf):
    from sitegraph.plans import sitemap as SM
    from sitegraph.sources import sinks as SK
    nodes, _ = _crawl(spark, sf)
    nodes = nodes.withColumn("file_name", F.when(F.col("status") == "ok", SK.page_file_name(
        F.coalesce("title", F.lit("")), F.lit(RUN_TS))))
    return SM.site_tree_json(nodes)



# --------------------------------------------------------------- sitemap
def _map(spark, sf):
    from sitegraph.plans import crawl as C
    nodes, opts = _crawl(spark, sf, robots=True)
    return C.site_map_nodes(nodes, opts), opts


@register("tree_fragments", _crawl_sql() + """,
up(root_url, url, depth, parent_url, path) AS (
  SELECT root_url, url, depth, parent_url, url FROM cn WHERE depth = 0
  UNION ALL
  SELECT c.root_url, c.url, c.depth, c.parent_url, u.path || chr(1) || c.url FROM up u
  JOIN cn c ON c.root_url = u.root_url AND c.parent_url = u.url AND c.depth = u.depth + 1),
nx AS (SELECT *, lead(depth) OVER (PARTITION BY root_url ORDER BY path) AS after FROM up)
SELECT root_url, path AS sort_key,
       concat('{"url":', CAST(to_json(url) AS VARCHAR),
              CASE WHEN after > depth THEN ',"children":['
                   WHEN after IS NULL THEN concat(repeat('}]', depth), '}')
                   ELSE concat(repeat('}]', depth - after), '},') END) AS json FROM nx""")
def q_tree_fragments(spark, sf):
    """Every fragment of every tree; in order of (root_url, sort_key) they spell the trees."""
    from sitegraph.plans import sitemap as SM
    return SM.tree_fragments(_crawl(spark, sf)[0])


@register("site_tour", _crawl_sql() + """,
up(root_url, anc, url, depth) AS (
  SELECT root_url, url, url, depth FROM cn
  UNION ALL
  SELECT c.root_url, u.anc, c.url, c.depth FROM up u JOIN cn c ON c.root_url = u.root_url AND c.parent_url = u.url),
below AS (SELECT root_url, anc AS url, count(*) AS size, max(depth) AS deepest FROM up GROUP BY root_url, anc),
placed AS (SELECT cn.root_url, cn.url, cn.depth, row_number() OVER (PARTITION BY cn.root_url ORDER BY p.sort_key) AS enter
           FROM cn JOIN pth p ON p.root_url = cn.root_url AND p.url = cn.url)
SELECT p.root_url, p.url, p.depth, p.enter::BIGINT AS enter, (p.enter + b.size - 1)::BIGINT AS leave, b.size::BIGINT AS size,
       (b.deepest - p.depth)::INTEGER AS reach
FROM placed p JOIN below b ON b.root_url = p.root_url AND b.url = p.url""")
def q_site_tour(spark, sf):
    from sitegraph.plans import tour
    return tour.euler_tour(_crawl(spark, sf)[0])


@register("site_descendants", _crawl_sql() + """,
up(root_url, anc, url, depth) AS (
  SELECT root_url, parent_url, url, depth FROM cn WHERE depth = 2
  UNION ALL
  SELECT c.root_url, u.anc, c.url, c.depth FROM up u JOIN cn c ON c.root_url = u.root_url AND c.parent_url = u.url)
SELECT root_url, anc AS ancestor, url, depth FROM up""")
def q_site_descendants(spark, sf):
    """All nodes below those one step from a root, as ranges of the tour."""
    from sitegraph.plans import tour
    t = tour.euler_tour(_crawl(spark, sf)[0])
    return tour.descendants(t, t.where("depth = 1"))


@register("site_map", _crawl_sql(robots=True) + f"""
SELECT root_url, url AS loc, depth, {D.priority('depth')} AS priority FROM mn""")
def q_site_map(spark, sf):
    from sitegraph.plans import sitemap as SM
    m, _ = _map(spark, sf)
    return SM.sitemap_entries(m).select("root_url", "loc", "depth", "priority")


@register("sitemap_xml", _crawl_sql(robots=True) + f"""
SELECT mn.root_url, p.sort_key, concat('  <url>', chr(10), '    <loc>', {D.escape_xml('mn.url')}, '</loc>', chr(10),
       '    <priority>', {D.priority('mn.depth')}, '</priority>', chr(10), '  </url>', chr(10)) AS xml
FROM mn JOIN pth p ON p.root_url = mn.root_url AND p.url = mn.url""")
def q_sitemap_xml(spark, sf):
    from sitegraph.plans import sitemap as SM
    m, _ = _map(spark, sf)
    return SM.sitemap_entries(m).select("root_url", "sort_key", "xml")


@register("sitemap_summary", _crawl_sql(robots=True) + f"""
SELECT r.root_url, coalesce(n, 0)::BIGINT AS url_count, {CRAWL_DEPTH} AS max_depth, reached::INTEGER AS reached_depth,
       CASE WHEN n IS NULL THEN 'root_failed' ELSE 'ok' END AS status
FROM (SELECT DISTINCT root_url FROM roots) r
LEFT JOIN (SELECT root_url, count(*) AS n, max(depth) AS reached FROM mn GROUP BY root_url) m ON m.root_url = r.root_url""")
def q_sitemap_summary(spark, sf):
    from sitegraph.plans import sitemap as SM
    m, opts = _map(spark, sf)
    return SM.sitemap_summary(m, opts.max_depth, _crawl_inputs(spark, sf)[2])


@register("crawl_robots", _crawl_sql(robots=True) +
          "SELECT root_url, url, depth, parent_url, status FROM cn")
def q_crawl_robots(spark, sf):
    nodes, _ = _crawl(spark, sf, robots=True)
    return nodes.select("root_url", "url", "depth", "parent_url", "status")


# ------------------------------------------------------- tokens, content
TEXT_SELECTORS = ["h1", "div.ad", "p", "article"]
HTML_SELECTORS = ["main", "article", "div"]


def _tokens_sql(src: str) -> str:
    from sitegraph.operators import tokens as TK
    void = ", ".join(D.q(t) for t in TK.VOID_TAGS)
    name = "lower(regexp_extract(tok, '^</?([a-zA-Z][a-zA-Z0-9:-]*)', 1))"
    kind = (f"CASE WHEN starts_with(tok, '<!--') THEN 'comment' "
            f"WHEN regexp_matches(tok, '(?is)^<(script|style)[ \t\n\r\f/>]') AND ends_with(tok, '>') "
            f"AND regexp_matches(tok, '(?is)</(script|style)[ \t\n\r\f]*>$') THEN 'raw' "
            f"WHEN regexp_matches(tok, '^</[a-zA-Z]') THEN 'close' "
            f"WHEN regexp_matches(tok, '^<[a-zA-Z]') AND {name} IN ({void}) THEN 'void' "
            f"WHEN regexp_matches(tok, '^<[a-zA-Z]') THEN 'open' "
            f"WHEN regexp_matches(tok, '^<[!?]') AND ends_with(tok, '>') THEN 'decl' ELSE 'text' END")
    return f"""
tk0 AS (
  SELECT page_id, len(t) - 1 AS last_pos, unnest(t) AS tok, unnest(range(0, len(t))) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, {D.q(TK.TOKEN_RE_RE2)}, 0) AS t FROM {src}) s),
tk1 AS (SELECT *, {kind} AS kind FROM tk0),
tk AS (
  SELECT *, CASE WHEN kind IN ('open', 'close', 'void', 'raw') THEN {name} END AS tag,
         coalesce(sum(length(tok)) OVER (PARTITION BY page_id ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_char
  FROM tk1),
tt AS (
  SELECT *, CASE WHEN kind = 'open' THEN depth ELSE depth + 1 END AS level FROM (
    SELECT *, sum(CASE WHEN kind = 'open' THEN 1 ELSE -1 END) OVER (PARTITION BY page_id, tag ORDER BY pos
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS depth
    FROM tk WHERE kind IN ('open', 'close')) s),
tt2 AS (
  SELECT *, lead(kind) OVER (PARTITION BY page_id, tag, level ORDER BY pos) AS nl_kind,
            lead(pos) OVER (PARTITION BY page_id, tag, level ORDER BY pos) AS nl_pos,
            lag(kind) OVER (PARTITION BY page_id, tag, level ORDER BY pos) AS pl_kind,
            lead(kind) OVER (PARTITION BY page_id, tag ORDER BY pos) AS nt_kind,
            lead(pos) OVER (PARTITION BY page_id, tag ORDER BY pos) AS nt_pos FROM tt),
tt3 AS (
  SELECT *, sum(CASE WHEN kind = 'open' AND nl_kind = 'close' THEN 1
                     WHEN kind = 'close' AND coalesce(pl_kind, '') = 'open' THEN -1 ELSE 0 END)
              OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gd
  FROM tt2),
tt4 AS (
  SELECT a.*, (SELECT min(b.pos) FROM tt3 b WHERE b.page_id = a.page_id AND b.kind = 'close'
                 AND coalesce(b.pl_kind, '') = 'open' AND b.gd = a.gd - 1 AND b.pos > a.pos) - 1 AS parent_end
  FROM tt3 a WHERE a.kind = 'open'),
sp0 AS (
  SELECT page_id, tag, pos AS start_pos,
         coalesce(CASE WHEN nl_kind = 'close' THEN nl_pos END,
                  CASE WHEN tag = 'p' THEN least(coalesce(CASE WHEN nt_kind = 'close' THEN nt_pos
                                                               WHEN nt_kind = 'open' THEN nt_pos - 1 END, last_pos),
                                                 coalesce(parent_end, last_pos))
                       ELSE parent_end END, last_pos) AS end_pos, tok, coalesce(nl_kind = 'close', false) AS explicit
  FROM tt4),
sp1 AS (
  SELECT *, last_value(CASE WHEN tag = 'p' AND NOT explicit THEN end_pos END IGNORE NULLS)
              OVER (PARTITION BY page_id ORDER BY start_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe,
            last_value(CASE WHEN tag = 'p' AND NOT explicit THEN start_pos END IGNORE NULLS)
              OVER (PARTITION BY page_id ORDER BY start_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ps
  FROM sp0),
sp2 AS (
  SELECT page_id, tag, start_pos, end_pos AS end_raw,
         CASE WHEN NOT explicit AND ps IS NOT NULL AND pe >= start_pos THEN least(end_pos, pe) ELSE end_pos END AS end_md,
         tok, explicit
  FROM sp1),
sp AS (
  SELECT page_id, tag, start_pos,
         CASE WHEN tag IN ({", ".join(D.q(t) for t in TK.FORMATTING_TAGS)}) THEN end_raw ELSE end_md END AS end_pos,
         end_md, tok, explicit
  FROM sp2
  UNION ALL
  SELECT page_id, tag, pos, pos, pos, tok, true FROM tk WHERE kind = 'void')"""


def _simple_pred_sql(s, tok: str) -> str:
    c = ["true"]
    if s.tag and s.tag != "*":
        c.append(f"{D.tag_name(tok)} = {D.q(s.tag)}")
    if s.cls:
        c.append(f"list_contains(string_split_regex(trim(coalesce({D.attr(tok, 'class')}, '')), "
                 f"'[ \t\n\r\f]+'), {D.q(s.cls)})")
    if s.id:
        c.append(f"coalesce({D.attr(tok, 'id')}, '') = {D.q(s.id)}")
    if s.attr:
        v = D.attr(tok, s.attr)
        c.append(f"{v} IS NOT NULL" if s.val is None else f"{v} = {D.q(s.val)}")
    return "(" + " AND ".join(c) + ")"


def _chain_pred_sql(chain, alias: str, depth: int = 0) -> str:
    """Last step matches ``alias``; every earlier step is an enclosing span
    (checked pairwise with EXISTS: an independent formulation)."""
    own = _simple_pred_sql(chain[-1], f"{alias}.tok")
    if len(chain) == 1:
        return own
    a = f"anc{depth}"
    inner = _chain_pred_sql(chain[:-1], a, depth + 1)
    return (f"({own} AND EXISTS (SELECT 1 FROM sp {a} WHERE {a}.page_id = {alias}.page_id "
            f"AND {a}.start_pos < {alias}.start_pos AND {a}.end_pos >= {alias}.end_pos AND {inner}))")


def _cands_sql(selectors) -> str:
    from sitegraph.functions import selectors as S
    parts = []
    for i, sel in enumerate(selectors):
        pred = " OR ".join(_chain_pred_sql(ch, "e") for ch in S.parse_chains(sel))
        parts.append(f"SELECT DISTINCT page_id, {i} AS si, start_pos, end_pos FROM sp e WHERE {pred}")
    return "cand AS (" + " UNION ALL ".join(parts) + ")"


def _selected_text_sql(src: str, selectors) -> str:
    ms = ", ".join(f"max(CASE WHEN si <= {s} THEN end_pos END) OVER (PARTITION BY page_id ORDER BY start_pos "
                   f"RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m{s}" for s in range(len(selectors)))
    pick = "CASE " + " ".join(f"WHEN si = {s} THEN m{s}" for s in range(len(selectors))) + " END"
    return f""",
{_cands_sql(selectors)},
km AS (SELECT *, {ms} FROM cand),
kept AS (SELECT page_id, si, start_pos, end_pos FROM km WHERE {pick} IS NULL OR {pick} < end_pos),
el AS (
  SELECT k.page_id, k.si, k.start_pos, string_agg(t.tok, '' ORDER BY t.pos) AS markup
  FROM kept k JOIN tk t ON t.page_id = k.page_id AND t.pos BETWEEN k.start_pos AND k.end_pos
  GROUP BY k.page_id, k.si, k.start_pos),
seltext AS (
  SELECT p.page_id, coalesce(trim(x.content), '') AS content FROM {src} p LEFT JOIN (
    SELECT page_id, string_agg({D.text_of(D.clean_html('markup'))}, ' ' ORDER BY si, start_pos) AS content
    FROM el GROUP BY page_id) x ON x.page_id = p.page_id)"""


@register("content_text_tags", "WITH " + _tokens_sql("pages").strip() + _selected_text_sql("pages", TEXT_SELECTORS)
          + "\nSELECT page_id, content FROM seltext")
def q_content_text_tags(spark, sf):
    from sitegraph.operators import content as C
    return C.selected_text(T.pages(spark, sf), TEXT_SELECTORS)


def _first_html_sql(src: str, selectors) -> str:
    return f""",
{_cands_sql(selectors)},
fc AS (SELECT page_id, arg_min(start_pos, (si, start_pos)) AS s, arg_min(end_pos, (si, start_pos)) AS e
       FROM cand GROUP BY page_id),
fm AS (SELECT fc.page_id, string_agg(t.tok, '' ORDER BY t.pos) AS m FROM fc
       JOIN tk t ON t.page_id = fc.page_id AND t.pos BETWEEN fc.s AND fc.e GROUP BY fc.page_id),
firsthtml AS (SELECT p.page_id, coalesce(fm.m, p.html) AS content FROM {src} p LEFT JOIN fm ON fm.page_id = p.page_id)"""


@register("content_html", "WITH " + _tokens_sql("pages").strip() + _first_html_sql("pages", HTML_SELECTORS)
          + "\nSELECT page_id, content FROM firsthtml")
def q_content_html(spark, sf):
    from sitegraph.operators import content as C
    return C.first_match_html(T.pages(spark, sf), HTML_SELECTORS)


@register("page_content", with_ctes(_sql_text_cte("pages")) +
          f"SELECT page_id, url, {D.title_of('c')} AS title, {D.text_of('c')} AS content FROM ptext")
def q_page_content(spark, sf):
    from sitegraph.operators import content as C
    return C.page_content(T.pages(spark, sf), "text")


@register("page_content_tags", "WITH " + _tokens_sql("pages").strip() + _selected_text_sql("pages", TEXT_SELECTORS)
          + f""",
{_sql_text_cte('pages')}
SELECT p.page_id, p.url, {D.title_of('p.c')} AS title, s.content FROM ptext p JOIN seltext s ON s.page_id = p.page_id""")
def q_page_content_tags(spark, sf):
    from sitegraph.operators import content as C
    return C.page_content(T.pages(spark, sf), "text", TEXT_SELECTORS)


# -------------------------------------------------------------- markdown
def _markdown_sql(src_tokens_cte: str) -> str:
    """CTE chain over ``tk`` ending in ``mdout(page_id, markdown)``."""
    from sitegraph.operators import markdown as MD
    w = "(PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def run(cond):
        return f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END) OVER {w}"

    def cmap(d):
        return "CASE tag " + " ".join(f"WHEN {D.q(k)} THEN {D.q(v)}" for k, v in sorted(d.items())) + " ELSE '' END"

    pre_map = cmap({k: v[0] for k, v in MD.RULES.items()})
    suf_map = cmap({k: v[1] for k, v in MD.RULES.items()})
    void_map = cmap(MD.VOID_RULES)
    href = D.attr("tok", "href")
    src, alt = f"coalesce({D.attr('tok', 'src')}, '')", f"coalesce({D.attr('tok', 'alt')}, '')"
    in_table = "(tb > 0)"
    counted = "(kind = 'open' AND tb > 0 AND tag IN ('td', 'th') AND (tr_n = 1 OR tag = 'td'))"
    dropped_th = f"({in_table} AND tr_n > 1 AND (th > 0 OR (tag = 'th' AND kind = 'close')))"
    depth_before = "(d - CASE WHEN kind = 'open' THEN 1 ELSE 0 END + CASE WHEN kind = 'close' THEN 1 ELSE 0 END)"
    text_ok = f"({depth_before} > 0 AND (NOT {in_table} OR cell > 0) AND NOT {dropped_th})"
    text_out = D.rx_replace(D.rx_replace(D.decode_entities("tok"), "[\u00ad\u200b]", ""), "[ \t\n\r\f\u00a0]+", " ")
    text_out = f"CASE WHEN pre > 0 AND code > 1 THEN trim({D.decode_entities('tok')}, ' ' || chr(10)) ELSE {text_out} END"
    conv = "(code - CASE WHEN kind = 'open' AND tag IN ('code', 'pre') THEN 1 ELSE 0 END <= 0)"
    conv_close = "(CASE WHEN tag IN ('code', 'pre') THEN code + 1 <= 1 ELSE code <= 0 END)"
    li_prefix = "(CASE WHEN ltype = 'ol' THEN concat(CAST(li_n AS VARCHAR), '. ') ELSE '* ' END)"
    head_rule = ("(CASE WHEN nhead > 0 THEN concat(array_to_string(list_transform(range(CAST(nhead AS BIGINT)), lambda x: '---'), ' | '), "
                 "chr(10)) END)")
    open_out = (f"CASE WHEN tag = 'a' THEN (CASE WHEN coalesce({href}, '') <> '' THEN '[' ELSE '' END) "
                f"WHEN tag = 'li' THEN (CASE WHEN ld > 0 THEN {li_prefix} ELSE '' END) "
                f"WHEN tag = 'code' THEN (CASE WHEN pre > 0 THEN '' ELSE '`' END) "
                f"WHEN tag = 'pre' THEN concat('```', coalesce(lang, ''), chr(10)) "
                f"WHEN tag = 'blockquote' THEN chr(2) "
                f"WHEN tag IN ('td', 'th') AND {in_table} THEN (CASE WHEN {counted} THEN "
                f"(CASE WHEN cell_n > 1 THEN ' | ' ELSE '' END) ELSE '' END) "
                f"ELSE {pre_map} END")
    close_out = (f"CASE WHEN tag = 'a' THEN (CASE WHEN coalesce(href, '') <> '' THEN concat('](', href, ')') ELSE '' END) "
                 f"WHEN tag = 'li' THEN (CASE WHEN ld > 0 THEN chr(10) ELSE '' END) "
                 f"WHEN tag IN ('ul', 'ol') THEN chr(10) "
                 f"WHEN tag = 'code' THEN (CASE WHEN pre > 0 THEN '' ELSE '`' END) "
                 f"WHEN tag = 'pre' THEN concat(chr(10), '```', chr(10), chr(10)) "
                 f"WHEN tag = 'blockquote' THEN chr(3) "
                 f"WHEN tag = 'tr' THEN (CASE WHEN {in_table} THEN concat(chr(10), CASE WHEN tr_n = 1 THEN "
                 f"coalesce({head_rule}, '') ELSE '' END) ELSE '' END) "
                 f"WHEN tag = 'table' THEN chr(10) ELSE {suf_map} END")
    void_out = (f"CASE WHEN tag = 'img' THEN (CASE WHEN {src} <> '' THEN concat('![', {alt}, '](', {src}, ')') "
                f"ELSE '' END) ELSE {void_map} END")
    out = (f"CASE WHEN kind = 'text' THEN (CASE WHEN {text_ok} THEN {text_out} ELSE '' END) "
           f"WHEN d > {MD.MAX_DEPTH} THEN '' "
           f"WHEN kind = 'open' THEN (CASE WHEN {conv} AND NOT {dropped_th} THEN {open_out} ELSE '' END) "
           f"WHEN kind = 'close' THEN (CASE WHEN {conv_close} AND NOT {dropped_th} THEN {close_out} ELSE '' END) "
           f"WHEN kind = 'void' THEN (CASE WHEN {conv} AND NOT {dropped_th} AND (NOT {in_table} OR cell > 0) "
           f"THEN {void_out} ELSE '' END) ELSE '' END")

    def quote_pass(s):
        parts = f"string_split({s}, chr(3))"
        inner = "regexp_extract(p, '[^\\x02]*$', 0)"
        before = f"p[1:length(p) - length({inner}) - 1]"
        quoted = (f"concat(array_to_string(list_transform(list_filter(string_split({inner}, chr(10)), "
                  f"lambda l: l <> ''), lambda l: concat('> ', l)), chr(10)), chr(10), chr(10))")
        return (f"array_to_string(list_transform({parts}, lambda p, i: CASE WHEN i < len({parts}) "
                f"AND contains(p, chr(2)) THEN concat({before}, {quoted}) ELSE p END), '')")

    md = quote_pass(quote_pass("m"))
    md = D.rx_replace(D.rx_replace(md, "[\x02\x03]", ""), MD.NEWLINES_RE, "\n\n")
    return f"""{src_tokens_cte},
mt0 AS (SELECT *, coalesce(min(CASE WHEN kind = 'open' AND tag = 'body' THEN pos END) OVER (PARTITION BY page_id),
                           min(CASE WHEN kind = 'close' AND tag = 'head' THEN pos END) OVER (PARTITION BY page_id), -1) AS b0
        FROM tk),
mt1 AS (SELECT *, coalesce(min(CASE WHEN kind = 'close' AND tag = 'body' AND pos > b0 THEN pos END)
                           OVER (PARTITION BY page_id), last_pos + 1) AS b1 FROM mt0),
m1 AS (SELECT * FROM mt1 WHERE pos > b0 AND pos < b1 AND kind IN ('open', 'close', 'void', 'text')),
m2 AS (
  SELECT *,
    {run("kind = 'open'")} - {run("kind = 'close'")} AS d,
    {run("kind = 'open' AND tag IN ('code', 'pre')")} - {run("kind = 'close' AND tag IN ('code', 'pre')")} AS code,
    {run("kind = 'open' AND tag = 'pre'")} - {run("kind = 'close' AND tag = 'pre'")} AS pre,
    {run("kind = 'open' AND tag = 'pre'")} AS pre_id,
    last_value(CASE WHEN kind = 'open' AND tag = 'a' THEN coalesce({href}, '') END IGNORE NULLS) OVER {w} AS href,
    {run("kind = 'open' AND tag IN ('ul', 'ol')")} - {run("kind = 'close' AND tag IN ('ul', 'ol')")} AS ld,
    {run("kind = 'open' AND tag = 'table'")} - {run("kind = 'close' AND tag = 'table'")} AS tb,
    {run("kind = 'open' AND tag = 'table'")} AS tb_id,
    {run("kind = 'open' AND tag IN ('td', 'th')")} - {run("kind = 'close' AND tag IN ('td', 'th')")} AS cell,
    {run("kind = 'open' AND tag = 'th'")} - {run("kind = 'close' AND tag = 'th'")} AS th
  FROM m1),
m3 AS (
  SELECT *,
    regexp_extract(min(CASE WHEN kind = 'open' AND tag = 'code' AND pre > 0 THEN
        concat(lpad(CAST(pos AS VARCHAR), 10, '0'), chr(1), {D.attr('tok', 'data-language')}) END)
        OVER (PARTITION BY page_id, pre_id), '[^\\x01]*$', 0) AS lang,
    last_value(CASE WHEN kind = 'open' AND tag IN ('ul', 'ol') THEN pos END IGNORE NULLS)
      OVER (PARTITION BY page_id, ld ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lpos,
    last_value(CASE WHEN kind = 'open' AND tag IN ('ul', 'ol') THEN tag END IGNORE NULLS)
      OVER (PARTITION BY page_id, ld ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ltype,
    sum(CASE WHEN kind = 'open' AND tag = 'tr' THEN 1 ELSE 0 END)
      OVER (PARTITION BY page_id, tb_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tr_n
  FROM m2),
m4 AS (
  SELECT *,
    sum(CASE WHEN kind = 'open' AND tag = 'li' AND ld > 0 THEN 1 ELSE 0 END)
      OVER (PARTITION BY page_id, lpos ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS li_n,
    sum(CASE WHEN {counted} THEN 1 ELSE 0 END)
      OVER (PARTITION BY page_id, tb_id, tr_n ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cell_n
  FROM m3),
m5 AS (SELECT *, max(CASE WHEN tr_n = 1 THEN cell_n END) OVER (PARTITION BY page_id, tb_id) AS nhead FROM m4),
mrows AS (
  SELECT page_id, pos, -4611686018427387904 AS sub, {out} AS o,
         (kind = 'open' AND {conv} AND NOT {dropped_th}) AS ok FROM m5),
mimpl AS (
  SELECT sp.page_id, sp.end_md AS pos, -sp.start_pos AS sub,
         coalesce(CASE sp.tag {" ".join(f"WHEN {D.q(k)} THEN {D.q(v[1])}" for k, v in sorted(MD.RULES.items()) if v[1])} END, '') AS o
  FROM sp JOIN mrows r ON r.page_id = sp.page_id AND r.pos = sp.start_pos AND r.ok
  WHERE NOT sp.explicit AND sp.tag IN ({", ".join(D.q(k) for k, v in sorted(MD.RULES.items()) if v[1])})),
magg AS (SELECT page_id, string_agg(o, '' ORDER BY pos, sub) AS m
         FROM (SELECT page_id, pos, sub, o FROM mrows UNION ALL SELECT * FROM mimpl) u GROUP BY page_id),
mdout AS (SELECT page_id, {md} AS markdown FROM magg)"""


@register("content_markdown", "WITH " + _markdown_sql(_tokens_sql("pages").strip()) + """
SELECT p.page_id, coalesce(m.markdown, '') AS markdown FROM pages p LEFT JOIN mdout m ON m.page_id = p.page_id""")
def q_content_markdown(spark, sf):
    from sitegraph.operators import markdown as MD
    return MD.markdown(T.pages(spark, sf))


def _md_fixture(cte: str) -> str:
    return "WITH " + cte.strip() + ",\n" + _markdown_sql(_tokens_sql("mdsrc").strip()) + """
SELECT p.page_id, coalesce(m.markdown, '') AS markdown FROM mdsrc p LEFT JOIN mdout m ON m.page_id = p.page_id"""


@register("markdown_lists", _md_fixture(FX.CONV_LISTS))
def q_markdown_lists(spark, sf):
    from sitegraph.operators import markdown as MD
    return MD.markdown(T.conversation_list_pages(spark, sf))


@register("markdown_tables", _md_fixture(FX.CONV_TABLES))
def q_markdown_tables(spark, sf):
    from sitegraph.operators import markdown as MD
    return MD.markdown(T.conversation_table_pages(spark, sf))


@register("markdown_blocks", _md_fixture(FX.DOC_BLOCKS))
def q_markdown_blocks(spark, sf):
    from sitegraph.operators import markdown as MD
    return MD.markdown(T.document_block_pages(spark, sf))


_MIXED_TEXT = "regexp_replace(replace(replace(text, chr(173), ''), chr(8203), ''), '[ \\t\\n\\r\\f' || chr(160) || ']+', ' ', 'g')"


@register("markdown_mixed", f"""
WITH t AS (SELECT conv_id, turn, role, {_MIXED_TEXT} AS line FROM conversations),
c AS (SELECT conv_id, string_agg('* ' || role || ' ' || chr(10), '' ORDER BY turn) AS items,
             string_agg(CASE WHEN line = '' THEN '' ELSE '> > ' || line || chr(10) END, '' ORDER BY turn) AS quoted,
             count(*) AS n FROM t GROUP BY conv_id)
SELECT conv_id AS page_id, items || chr(10) || '> c' || chr(10) || '> **' || conv_id || '**' || chr(10) || '> ' || chr(10)
       || quoted || chr(10) || n || ' turns' || chr(10) || chr(10) || '[x](/1)[y](/2)' || chr(10) || chr(10)
       || '`' || conv_id || '`' || chr(128512) || chr(10003) || chr(10) || chr(10) AS markdown
FROM c""")
def q_markdown_mixed(spark, sf):
    """Indented and unclosed lists, nested quotes, a table below the top level, stray and missing end tags."""
    from sitegraph.operators import markdown as MD
    return MD.markdown(T.conversation_mixed_pages(spark, sf))


@register("content_text_li", """
SELECT conv_id AS page_id, string_agg(role, ' ' ORDER BY turn) AS content FROM conversations GROUP BY conv_id""")
def q_content_text_li(spark, sf):
    from sitegraph.operators import content as C
    return C.selected_text(T.conversation_mixed_pages(spark, sf), ["li"])


# ---------------------------------------------------------------- assets
def _img_sql(link: str) -> dict:
    """SQL pieces of an image record for link expression ``link``."""
    is_data = f"starts_with({link}, 'data:image/')"
    payload = D.rx_extract(link, r"^[^,]*,(.*)$", 1)
    core = f"regexp_replace({payload}, '=+$', '')"
    semi = f"strpos({link}, ';')"
    d_ok = (f"({semi} > 0 AND regexp_matches({payload}, '^[A-Za-z0-9+/]*={{0,2}}$') AND length({core}) % 4 <> 1 "
            f"AND length({core}) >= 2 AND (length({payload}) = length({core}) OR length({payload}) % 4 = 0))")
    d_mime = f"(CASE WHEN {semi} > 0 THEN substring({link}, 6, greatest({semi} - 6, 0)) END)"
    d_ext = D.rx_extract(d_mime, r"([^/]*)$", 1)
    name = D.image_file_name(D.embedded_url(link))
    return {
        "file_name": f"(CASE WHEN {is_data} THEN concat('image_', {D.q(RUN_TS)}, '.', {d_ext}) ELSE {name} END)",
        "mime_type": f"(CASE WHEN {is_data} THEN {d_mime} ELSE {D.mime_type(name)} END)",
        "n_bytes": f"(CASE WHEN {is_data} AND {d_ok} THEN CAST(floor(length({core}) * 6 / 8) AS BIGINT) END)",
        "ok": f"(CASE WHEN {is_data} THEN {d_ok} ELSE regexp_matches({link}, '(?i)^(https?|ftp|file):') END)",
    }


def _image_manifest_sql(max_n: int) -> str:
    r = _img_sql("link")
    lim = f"WHERE pos < {max_n}" if max_n > 0 else ""
    return with_ctes(FX.PAGES_PLUS) + f"""
SELECT * FROM (
  SELECT page_id, url, (row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1)::BIGINT AS pos,
         image_url, NULL::VARCHAR AS relative_path, file_name, mime_type, n_bytes
  FROM (SELECT page_id, url, pos, link AS image_url, {r['file_name']} AS file_name, {r['mime_type']} AS mime_type,
               {r['n_bytes']} AS n_bytes, {r['ok']} AS ok FROM ({_sql_links('pplus', ['images'])}) z) y
  WHERE ok) x {lim}"""


@register("image_manifest", _image_manifest_sql(0))
def q_image_manifest(spark, sf):
    from sitegraph.operators import assets as A
    return A.image_manifest(T.pages_plus(spark, sf), 0, RUN_TS).drop("content")


_IMAGE_BODY = "'image of ' || image_url"


def _image_results_sql() -> str:
    r = _img_sql("link")
    return with_ctes(FX.PAGES_PLUS) + f"""
, im AS (SELECT page_id, pos, link AS image_url, {r['file_name']} AS file_name, {r['n_bytes']} AS data_bytes, {r['ok']} AS ok
         FROM ({_sql_links('pplus', ['images'])}) z),
res AS (SELECT page_id, pos::BIGINT AS pos, image_url, file_name,
               CASE WHEN starts_with(image_url, 'data:image/') THEN ok ELSE length(image_url) % 5 NOT IN (1, 2) END AS good,
               CASE WHEN starts_with(image_url, 'data:image/') THEN data_bytes ELSE strlen({_IMAGE_BODY}) END::BIGINT AS n_bytes,
               CASE WHEN NOT starts_with(image_url, 'data:image/') THEN sha256({_IMAGE_BODY}) END AS sha FROM im)"""


@register("image_results", _image_results_sql() + """
SELECT page_id, pos, image_url AS asset_url, CASE WHEN good THEN file_name END AS file_name,
       CASE WHEN good THEN n_bytes END AS n_bytes, CASE WHEN good THEN 'ok' ELSE 'asset_failed' END AS status FROM res""")
def q_image_results(spark, sf):
    from sitegraph.operators import assets as A
    pp = T.pages_plus(spark, sf)
    return A.asset_results(pp, T.stored_images(pp), "images", RUN_TS).select(
        "page_id", "pos", "asset_url", "file_name", "n_bytes", "status")


@register("image_topn", _image_results_sql() + f"""
, good AS (SELECT r.*, p.url, row_number() OVER (PARTITION BY r.page_id ORDER BY pos) - 1 AS n FROM res r JOIN pplus p ON p.page_id = r.page_id
           WHERE good)
SELECT page_id, url, n::BIGINT AS pos, image_url, NULL::VARCHAR AS relative_path, file_name,
       {_img_sql('image_url')['mime_type']} AS mime_type, n_bytes FROM good WHERE n < 1""")
def q_image_topn(spark, sf):
    from sitegraph.operators import assets as A
    pp = T.pages_plus(spark, sf)
    return A.image_manifest(pp, 1, RUN_TS, assets_df=T.stored_images(pp)).drop("content")


@register("saved_images", _image_results_sql() + """
SELECT image_url AS key, any_value(file_name) AS named, any_value(n_bytes)::BIGINT AS n_bytes,
       any_value(sha) AS content_sha256 FROM res WHERE good GROUP BY image_url""")
def q_saved_images(spark, sf):
    """Every fetched image as a file, read back from where it was saved."""
    from sitegraph.operators import assets as A
    from sitegraph.sources import files
    pp = T.pages_plus(spark, sf)
    saved = A.saved_assets(A.asset_downloads(pp, T.stored_images(pp), "images", 0, RUN_TS), _folder(spark, "saved-images"))
    named = F.regexp_replace("file_name", "~[0-9a-f]{8,}(?=[.]|$)", "")  # the mark that tells like names apart
    sha = F.when(~F.col("key").startswith("data:image/"), F.sha2("content", 256))
    return files.read_back(saved).select("key", named.alias("named"), "n_bytes", sha.alias("content_sha256"))


@register("image_downloads", _image_results_sql() + """
SELECT page_id, pos, image_url AS asset_url, file_name, n_bytes, sha AS content_sha256
FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS n FROM res WHERE good) g WHERE n <= 1""")
def q_image_downloads(spark, sf):
    from sitegraph.operators import assets as A
    pp = T.pages_plus(spark, sf)
    d = A.asset_downloads(pp, T.stored_images(pp), "images", 1, RUN_TS)
    sha = F.when(~F.col("asset_url").startswith("data:image/"), F.sha2("content", 256))
    return d.select("page_id", "pos", "asset_url", "file_name", "n_bytes", sha.alias("content_sha256"))


def _doc_name_sql(url: str, disp: str) -> str:
    from_disp = f"replace({D.rx_extract(disp, r'(?s)filename=(.*)$', 1)}, '\"', '')"
    from_url = D.rx_extract(f"split_part({url}, '?', 1)", r"([^/]*)$", 1)
    raw = f"(CASE WHEN coalesce(contains({disp}, 'filename='), false) THEN {from_disp} ELSE {from_url} END)"
    return f"try(url_decode(replace({raw}, '+', ' ')))"


@register("document_manifest", with_ctes(FX.PAGES_PLUS, FX.ASSETS) + f"""
SELECT page_id, url, pos, doc_url, NULL::VARCHAR AS relative_path, file_name, {D.mime_type('file_name')} AS mime_type
FROM (SELECT l.page_id, l.url, l.pos, l.link AS doc_url, {_doc_name_sql('l.link', 'a.disposition')} AS file_name
      FROM ({_sql_links('pplus', ['documents'])}) l JOIN assets a ON a.url = l.link WHERE a.status = 200) z
WHERE file_name IS NOT NULL""")
def q_document_manifest(spark, sf):
    from sitegraph.operators import assets as A
    pp = T.pages_plus(spark, sf)
    return A.document_manifest(pp, T.stored_assets(pp))


@register("document_downloads", with_ctes(FX.PAGES_PLUS, FX.ASSETS) + f"""
SELECT page_id, pos::BIGINT AS pos, doc_url AS asset_url, file_name, strlen(body)::BIGINT AS n_bytes, sha256(body) AS content_sha256
FROM (SELECT l.page_id, l.pos, l.link AS doc_url, a.body, {_doc_name_sql('l.link', 'a.disposition')} AS file_name
      FROM ({_sql_links('pplus', ['documents'])}) l JOIN assets a ON a.url = l.link WHERE a.status = 200) z
WHERE file_name IS NOT NULL""")
def q_document_downloads(spark, sf):
    from sitegraph.operators import assets as A
    pp = T.pages_plus(spark, sf)
    d = A.asset_downloads(pp, T.stored_assets(pp), "documents")
    return d.select("page_id", "pos", "asset_url", "file_name", "n_bytes", F.sha2("content", 256).alias("content_sha256"))


@register("single_asset", with_ctes(FX.PAGES_PLUS, FX.ASSETS) + f"""
, u AS (SELECT DISTINCT link AS url FROM ({_sql_links('pplus')}) z),
x AS (
  SELECT u.url, a.status, a.disposition, {_img_sql('u.url')['file_name']} AS ifn,
         {_img_sql('u.url')['mime_type']} AS imt, {_img_sql('u.url')['ok']} AS iok,
         {D.is_document('u.url')} AS is_doc
  FROM u LEFT JOIN assets a ON a.url = u.url),
y AS (SELECT *, (starts_with(url, 'data:image/') OR starts_with({D.mime_type('ifn')}, 'image/')) AS is_img,
             CASE WHEN status = 200 THEN {_doc_name_sql('url', 'disposition')} END AS dfn FROM x)
SELECT url, CASE WHEN is_doc THEN 'document' WHEN is_img THEN 'image' ELSE 'page' END AS kind,
       CASE WHEN is_doc THEN dfn WHEN is_img AND iok THEN ifn END AS file_name,
       CASE WHEN is_doc THEN {D.mime_type('dfn')} WHEN is_img AND iok THEN imt END AS mime_type
FROM y""")
def q_single_asset(spark, sf):
    from sitegraph.operators import assets as A
    pp = T.pages_plus(spark, sf)
    urls = L.page_links(pp).select(F.col("link").alias("url")).distinct()
    return A.single_asset(urls, T.stored_assets(pp), RUN_TS)


@register("mime_inventory", with_ctes(FX.PAGES_PLUS) + f"""
SELECT {D.host('link')} AS host,
       CASE WHEN starts_with(link, 'data:image/') THEN {_img_sql('link')['mime_type']}
            WHEN kind = 'images' THEN {D.mime_type(_img_sql('link')['file_name'])}
            ELSE {D.mime_type(D.rx_extract("split_part(link, '?', 1)", r'([^/]*)$', 1))} END AS mime_type,
       count(*)::BIGINT AS n_links, count(DISTINCT link)::BIGINT AS n_urls
FROM ({_sql_links('pplus', ['images', 'documents'])}) z GROUP BY 1, 2""")
def q_mime_inventory(spark, sf):
    from sitegraph.operators import assets as A
    return A.mime_inventory(T.pages_plus(spark, sf))


# ---------------------------------------------------------------- search
def _json_rows(arr_path: str, alias: str) -> str:
    return (f"unnest(json_extract(body, '{arr_path}[*]')) AS {alias}, "
            f"unnest(range(0, CAST(coalesce(json_array_length(body, '{arr_path}'), 0) AS BIGINT))) AS idx")


@register("search_organic", with_ctes(FX.SEARCH) + f"""
SELECT query_id, json_extract_string(body, '$.searchParameters.q') AS query, idx::BIGINT AS idx,
       CAST(json_extract(o, '$.position') AS INTEGER) AS position, json_extract_string(o, '$.title') AS title,
       json_extract_string(o, '$.link') AS link, json_extract_string(o, '$.snippet') AS snippet,
       CAST(json_extract(o, '$.rating') AS DOUBLE) AS rating,
       CAST(json_extract(o, '$.ratingCount') AS INTEGER) AS rating_count
FROM (SELECT query_id, body, {_json_rows('$.organic', 'o')} FROM search) s""")
def q_search_organic(spark, sf):
    from sitegraph.operators import search as SR
    return SR.organic(T.search_responses(spark, sf))


@register("search_sitelinks", with_ctes(FX.SEARCH) + """
, org AS (SELECT query_id, unnest(json_extract(body, '$.organic[*]')) AS o,
                 unnest(range(0, CAST(coalesce(json_array_length(body, '$.organic'), 0) AS BIGINT))) AS idx FROM search)
SELECT query_id, idx::BIGINT AS idx, sidx::BIGINT AS sidx, json_extract_string(s, '$.title') AS title,
       json_extract_string(s, '$.link') AS link
FROM (SELECT query_id, idx, unnest(json_extract(o, '$.sitelinks[*]')) AS s,
             unnest(range(0, CAST(coalesce(json_array_length(o, '$.sitelinks'), 0) AS BIGINT))) AS sidx FROM org) x""")
def q_search_sitelinks(spark, sf):
    from sitegraph.operators import search as SR
    return SR.sitelinks(T.search_responses(spark, sf))


@register("search_paa", with_ctes(FX.SEARCH) + f"""
SELECT query_id, idx::BIGINT AS idx, json_extract_string(a, '$.question') AS question,
       json_extract_string(a, '$.snippet') AS snippet, json_extract_string(a, '$.link') AS link,
       json_extract_string(a, '$.title') AS title
FROM (SELECT query_id, {_json_rows('$.peopleAlsoAsk', 'a')} FROM search) s""")
def q_search_paa(spark, sf):
    from sitegraph.operators import search as SR
    return SR.people_also_ask(T.search_responses(spark, sf))


@register("search_images", with_ctes(FX.SEARCH) + f"""
SELECT query_id, idx::BIGINT AS idx, json_extract_string(i, '$.imageUrl') AS image_url,
       json_extract_string(i, '$.link') AS link, json_extract_string(i, '$.title') AS title
FROM (SELECT query_id, {_json_rows('$.images', 'i')} FROM search) s""")
def q_search_images(spark, sf):
    from sitegraph.operators import search as SR
    return SR.images(T.search_responses(spark, sf))


@register("search_raw", with_ctes(FX.SEARCH) + """
SELECT query_id, json_extract_string(body, '$.searchParameters.q') AS query, 'ok' AS status, body FROM search""")
def q_search_raw(spark, sf):
    from sitegraph.operators import search as SR
    return SR.raw(T.search_responses(spark, sf))


@register("search_fields", with_ctes(FX.SEARCH) + """
, f AS (SELECT s.query_id, regexp_replace(t.fullkey, '\\[[0-9]+\\]', '[]', 'g') AS path, t.type
        FROM search s, json_tree(s.body) t)
SELECT path, CASE WHEN type IN ('UBIGINT', 'BIGINT') THEN 'BIGINT' WHEN type = 'VARCHAR' THEN 'STRING'
                  WHEN type = 'DOUBLE' THEN 'DECIMAL' ELSE type END AS type,
       count(*)::BIGINT AS n_values, count(DISTINCT query_id)::BIGINT AS n_rows
FROM f GROUP BY 1, 2""")
def q_search_fields(spark, sf):
    """Every field that the stored responses hold, known or not."""
    from sitegraph.operators import attributes as AT
    r = T.search_responses(spark, sf).select(AT.parsed(F.col("body")).alias("v"))
    return AT.fields(r, "v").withColumn("type", F.regexp_replace("type", r"\(.*\)$", ""))


@register("result_attributes", _crawl_sql(robots=True) + f""",
ptext AS (SELECT page_id, url, {D.clean_html('html')} AS c FROM pplus),
sums AS (SELECT root_url, count(*) AS n FROM mn GROUP BY root_url)
SELECT 'page' AS operation, url, {_json_sql(title=D.title_of('c'), url='url')} AS attributes FROM ptext
UNION ALL
SELECT 'sitemap', r.root_url, concat('{{"count":', coalesce(n, 0), ',"depth":{CRAWL_DEPTH},"url":', CAST(to_json(r.root_url) AS VARCHAR), '}}')
FROM (SELECT DISTINCT root_url FROM roots) r LEFT JOIN sums ON sums.root_url = r.root_url""")
def q_result_attributes(spark, sf):
    """What page operations and sitemaps return beside their result, as open maps."""
    from sitegraph.operators import attributes as AT
    from sitegraph.operators import content as C
    from sitegraph.plans import sitemap as SM
    pages = C.page_content(T.pages_plus(spark, sf), "text").select(
        F.lit("page").alias("operation"), "url", AT.attributes(url=F.col("url"), title=F.nullif(F.col("title"), F.lit(""))).alias("a"))
    m, opts = _map(spark, sf)
    s = SM.sitemap_summary(m, opts.max_depth, _crawl_inputs(spark, sf)[2])
    s = s.select(F.lit("sitemap").alias("operation"), F.col("root_url").alias("url"),
                 AT.attributes(url=F.col("root_url"), count=F.col("url_count"), depth=F.col("max_depth")).alias("a"))
    return pages.unionByName(s).select("operation", "url", F.to_json("a").alias("attributes"))


@register("response_attributes", with_ctes(FX.SEARCH) + """
SELECT query_id, json_extract_string(body, '$.searchParameters.q') AS query, CAST(json_extract(body, '$.extra.kept[1]') AS BIGINT) AS kept,
       CAST(json_extract(body, '$.extra') AS VARCHAR) AS extra, json_extract_string(body, '$.knowledgeGraph.type') AS kg_type FROM search""")
def q_response_attributes(spark, sf):
    """The open attributes of search results, read by path."""
    from sitegraph.operators import search as SR
    a = SR.with_attributes(T.search_responses(spark, sf))
    get = lambda path, kind: F.try_variant_get("attributes", path, kind)
    return a.select("query_id", get("$.query", "string").alias("query"), get("$.extra.kept[1]", "bigint").alias("kept"),
                    F.to_json(get("$.extra", "variant")).alias("extra"), get("$.knowledgeGraph.type", "string").alias("kg_type"))


@register("search_summary", with_ctes(FX.SEARCH) + """
SELECT query_id, json_extract_string(body, '$.searchParameters.q') AS query, 'ok' AS status,
       CAST(json_extract(body, '$.credits') AS INTEGER) AS credits,
       json_extract_string(body, '$.knowledgeGraph.title') AS kg_title,
       json_extract_string(body, '$.knowledgeGraph.type') AS kg_type,
       coalesce(json_array_length(body, '$.organic'), 0)::BIGINT AS n_organic,
       coalesce(json_array_length(body, '$.peopleAlsoAsk'), 0)::BIGINT AS n_paa
FROM search""")
def q_search_summary(spark, sf):
    from sitegraph.operators import search as SR
    return SR.search_summary(T.search_responses(spark, sf))


# ------------------------------------------------------- records, graph
def _folder(spark, name: str) -> str:
    import os
    import uuid
    from sitegraph.session import checkpoint_dir
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


@register("page_json", with_ctes(FX.PAGES_PLUS, _sql_text_cte("pplus")) + f"""
SELECT page_id, url, {D.title_of('c')} AS title,
       concat({D.sanitize_file_name(D.title_of('c'))}, '_', {D.q(RUN_TS)}, '.json') AS file_name,
       {D.text_of('c')} AS content, {_json_sql(url='url', title=D.title_of('c'), content=D.text_of('c'))} AS json
FROM ptext""")
def q_page_json(spark, sf):
    from sitegraph.operators import content as C
    from sitegraph.sources import sinks as SK
    rec = C.page_content(T.pages_plus(spark, sf), "text")
    return SK.page_records(rec, F.lit(RUN_TS)).select("page_id", "url", "title", "file_name", "content", "json")


@register("saved_pages", with_ctes(FX.PAGES_PLUS, _sql_text_cte("pplus")) + f"""
SELECT url AS key, {_json_sql(url='url', title=D.title_of('c'), content=D.text_of('c'))} AS json FROM ptext""")
def q_saved_pages(spark, sf):
    """Page records saved as one JSON file each, read back."""
    from sitegraph.operators import content as C
    from sitegraph.sources import files
    from sitegraph.sources import sinks as SK
    rec = SK.page_records(C.page_content(T.pages_plus(spark, sf), "text"), F.lit(RUN_TS))
    return files.read_back(SK.write_page_json(rec, _folder(spark, "saved-pages"))).select("key", F.col("content").cast("string").alias("json"))


def _files_sql(max_images: int, max_documents: int) -> str:
    """CTEs ``imf``, ``dcf``, ``mtf``: per page the fetched images, fetched documents and meta tags as one text each."""
    r = _img_sql("link")
    return f"""
, im AS (SELECT page_id, pos, link, {r['file_name']} AS fn, {r['mime_type']} AS mt,
                CASE WHEN starts_with(link, 'data:image/') THEN {r['ok']} ELSE length(link) % 5 NOT IN (1, 2) END AS good
         FROM ({_sql_links('pplus', ['images'])}) z),
imf AS (SELECT page_id, string_agg(concat(link, '|images/|', fn, '|', mt), ' ' ORDER BY pos) AS t
        FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS n FROM im WHERE good) g
        WHERE n <= {max_images or 1 << 30} GROUP BY page_id),
dc AS (SELECT l.page_id, l.pos, l.link, {_doc_name_sql('l.link', 'a.disposition')} AS fn
       FROM ({_sql_links('pplus', ['documents'])}) l JOIN assets a ON a.url = l.link WHERE a.status = 200),
dcf AS (SELECT page_id, string_agg(concat(link, '|docs/|', fn, '|', {D.mime_type('fn')}), ' ' ORDER BY pos) AS t
        FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS n FROM dc WHERE fn IS NOT NULL) g
        WHERE n <= {max_documents or 1 << 30} GROUP BY page_id),
mtg AS (SELECT page_id, o, coalesce({D.attr('t', 'name')}, '') AS nm, coalesce({D.attr('t', 'property')}, '') AS pr,
               coalesce({D.attr('t', 'content')}, '') AS ct
        FROM (SELECT page_id, unnest(tags) AS t, unnest(range(1, len(tags) + 1)) AS o
              FROM (SELECT page_id, {D.start_tags('c', 'meta')} AS tags FROM ptext) z0) z),
mtf AS (SELECT page_id, string_agg(concat(CASE WHEN pr = '' THEN concat('n=', nm) ELSE concat('p=', pr) END, '|', ct), ' ' ORDER BY o) AS t
        FROM mtg WHERE (nm <> '' OR pr <> '') AND ct <> '' GROUP BY page_id)"""


def _files_text():
    """The same texts from the arrays of a record."""
    file = lambda x: F.concat_ws("|", x["url"], x["relativePath"], x["fileName"], x["mimeType"])
    meta = lambda x: F.concat(F.when(x["property"].isNull(), F.concat(F.lit("n="), x["name"]))
                              .otherwise(F.concat(F.lit("p="), x["property"])), F.lit("|"), x["content"])
    text = lambda c, f: F.nullif(F.array_join(F.transform(c, f), " "), F.lit("")).alias(c)
    return [text("imageFiles", file), text("documentFiles", file), text("metaTags", meta)]


@register("full_scan_record", with_ctes(FX.PAGES_PLUS, FX.ASSETS, _sql_text_cte("pplus")) + _files_sql(1, 0) + f"""
SELECT p.page_id, p.url, {D.title_of('p.c')} AS title, imf.t AS "imageFiles", dcf.t AS "documentFiles", mtf.t AS "metaTags",
       {D.text_of('p.c')} AS content
FROM ptext p LEFT JOIN imf ON imf.page_id = p.page_id LEFT JOIN dcf ON dcf.page_id = p.page_id
LEFT JOIN mtf ON mtf.page_id = p.page_id""")
def q_full_scan_record(spark, sf):
    """One image a page at most: the first that was fetched."""
    from sitegraph.plans import fullscan as FS
    pp = T.pages_plus(spark, sf)
    r = FS.full_scan_records(pp, T.stored_assets(pp).unionByName(T.stored_images(pp)), with_images=True, with_documents=True,
                             with_meta=True, max_images=1, run_ts=RUN_TS)
    return r.select("page_id", "url", "title", *_files_text(), "content")


@register("url_dedup", with_ctes(FX.PAGES_PLUS) + f"""
, raw AS (SELECT url AS raw FROM pplus UNION ALL SELECT link FROM ({_sql_links('pplus')}) z)
SELECT canonical, count(*)::BIGINT AS n_refs, count(DISTINCT raw)::BIGINT AS n_variants
FROM (SELECT raw, {D.clean_url('raw')} AS canonical FROM raw) x WHERE canonical IS NOT NULL GROUP BY canonical""")
def q_url_dedup(spark, sf):
    from sitegraph.functions import urls as U
    pp = T.pages_plus(spark, sf)
    raw = pp.select(F.col("url").alias("raw")).unionByName(
        L.page_links(pp).select(F.col("link").alias("raw")))
    return (raw.select("raw", U.clean_url(F.col("raw")).alias("canonical")).where("canonical IS NOT NULL")
            .groupBy("canonical").agg(F.count("*").alias("n_refs"), F.countDistinct("raw").alias("n_variants")))


@register("link_graph", with_ctes(FX.PAGES_PLUS) + f"""
, keys AS (SELECT {D.clean_url('url')} AS k, min(page_id) AS page_id FROM pplus GROUP BY 1),
e AS (SELECT DISTINCT page_id AS src_page_id, kind, {D.clean_url('link')} AS dst FROM ({_sql_links('pplus')}) z)
SELECT e.src_page_id, e.kind, e.dst, coalesce(keys.page_id, -1) AS dst_page_id
FROM e LEFT JOIN keys ON keys.k = e.dst WHERE e.dst IS NOT NULL""")
def q_link_graph(spark, sf):
    from sitegraph.plans import graph as G
    return G.link_graph(T.pages_plus(spark, sf))


def _frontier_sql() -> str:
    return with_ctes(FX.PAGES_PLUS, FX.PAGE_STATUS.replace("FROM pages", "FROM pplus")) + f"""
, fu AS (SELECT DISTINCT {D.clean_url('link')} AS url FROM ({_sql_links('pplus', ['internal', 'external', 'iframe'])}) z
         WHERE {D.clean_url('link')} IS NOT NULL),
okp AS (SELECT {D.clean_url('url')} AS k, min(page_id) AS page_id FROM pstatus WHERE status = 200 GROUP BY 1)
"""


def _frontier(spark, sf):
    from sitegraph.functions import urls as U
    pp = T.pages_plus(spark, sf)
    store = T.page_status(pp.select("page_id", "url", "html"))
    urls = (L.page_links(pp, ["internal", "external", "iframe"])
            .select(U.clean_url(F.col("link")).alias("url")).where("url IS NOT NULL").distinct())
    return urls, store


@register("valid_urls", _frontier_sql() + "SELECT url FROM fu WHERE url IN (SELECT k FROM okp)")
def q_valid_urls(spark, sf):
    from sitegraph.plans import crawl as C
    urls, store = _frontier(spark, sf)
    return C.valid_urls(urls, store)


@register("page_scan", _frontier_sql() + f"""
SELECT fu.url, okp.page_id, {D.title_of(D.clean_html('p.html'))} AS title
FROM fu JOIN okp ON okp.k = fu.url JOIN pstatus p ON p.page_id = okp.page_id""")
def q_page_scan(spark, sf):
    from sitegraph.plans import crawl as C
    urls, store = _frontier(spark, sf)
    s = C.page_scan(urls, store)
    return s.select("url", "page_id", H.title_of(H.clean_html(F.col("html"))).alias("title"))


# -------------------------------------------------------------- streaming
def _landing(spark, df, name):
    import os
    import uuid
    from sitegraph.session import checkpoint_dir
    from sitegraph.streaming import stream as ST
    return ST.land_pages(df, os.path.join(checkpoint_dir(spark), f"landing-{name}-{uuid.uuid4().hex[:12]}"))


@register("stream_content", with_ctes(_sql_text_cte("pages")) +
          f"SELECT page_id, url, {D.title_of('c')} AS title, {D.text_of('c')} AS content, 'ok' AS status FROM ptext")
def q_stream_content(spark, sf):
    from sitegraph.streaming import stream as ST
    return ST.page_content_stream(spark, _landing(spark, T.pages(spark, sf), "content"))


@register("stream_markdown", "WITH " + _markdown_sql(_tokens_sql("pages").strip()) + """
SELECT p.page_id, p.url, coalesce(m.markdown, '') AS content FROM pages p LEFT JOIN mdout m ON m.page_id = p.page_id""")
def q_stream_markdown(spark, sf):
    from sitegraph.streaming import stream as ST
    return ST.page_content_stream(spark, _landing(spark, T.pages(spark, sf), "markdown"), fmt="markdown").select("page_id", "url", "content")


@register("stream_quarantine", with_ctes(_UNREADABLE, _sql_text_cte("unreadable")) + f"""
SELECT u.page_id, u.url, coalesce({_REASON}, 'ok') AS outcome, CASE WHEN {_REASON} IS NULL THEN {D.text_of('t.c')} END AS content
FROM unreadable u JOIN ptext t ON t.page_id = u.page_id""")
def q_stream_quarantine(spark, sf):
    """Records of the pages that can be read, and the others with their reasons, from one stream."""
    from sitegraph.streaming import stream as ST
    good, bad = ST.quarantined_stream(spark, _landing(spark, T.unreadable_pages(T.pages(spark, sf)), "quarantine"))
    return good.select("page_id", "url", F.lit("ok").alias("outcome"), "content").unionByName(
        bad.select("page_id", "url", F.col("reason").alias("outcome"), F.lit(None).cast("string").alias("content")))


@register("stream_dedup", f"SELECT DISTINCT {D.clean_url('url')} AS key FROM pages WHERE {D.clean_url('url')} IS NOT NULL")
def q_stream_dedup(spark, sf):
    """Every page lands three times within the hour, once under another spelling of its URL."""
    from sitegraph.streaming import stream as ST
    p = T.pages(spark, sf).select("page_id", "url")
    again = F.explode(F.array(*[F.struct(F.lit(m).alias("minutes"), F.lit(tail).alias("tail")) for m, tail in ((0, ""), (20, "#top"), (45, ""))]))
    landed = p.select("page_id", "url", again.alias("a")).select(
        "page_id", F.concat("url", "a.tail").alias("url"), F.timestamp_seconds(F.col("page_id") * 60 + F.col("a.minutes") * 60).alias("landed_at"))
    return ST.dedup_stream(spark, ST.land_in_order(landed, _folder(spark, "landing-dedup"), "landed_at"))


@register("crawl_stream", _crawl_sql() +
          "SELECT root_url, url, depth, parent_url, coalesce(page_id, -1) AS page_id, status FROM cn")
def q_crawl_stream(spark, sf):
    from sitegraph.plans import crawl as C
    from sitegraph.streaming import stream as ST
    pp = T.pages_plus(spark, sf)
    landing = _landing(spark, pp.select("page_id", "url", "html"), "crawl")
    roots = pp.where("rn = 0").select(F.col("url").alias("root_url"))
    opts = C.CrawlOptions(max_depth=CRAWL_DEPTH, referrer=REFERRER, delay_ms=250)
    nodes = ST.crawl_stream(spark, landing, roots, opts, status_fn=T.page_status)
    return nodes.select("root_url", "url", "depth", "parent_url",
                        F.coalesce("page_id", F.lit(-1).cast("bigint")).alias("page_id"), "status")


@register("crawl_full_records", _crawl_sql() + f""",
{FX.ASSETS.strip()},
ptext AS (SELECT page_id, url, {D.clean_html('html')} AS c FROM pplus)""" + _files_sql(0, 1) + f"""
SELECT cn.root_url, cn.url, cn.page_id, {D.title_of('p.c')} AS title,
       concat({D.sanitize_file_name(D.title_of('p.c'))}, '_', {D.q(RUN_TS)}, '.json') AS file_name,
       imf.t AS "imageFiles", dcf.t AS "documentFiles", mtf.t AS "metaTags", {D.text_of('p.c')} AS content
FROM cn JOIN ptext p ON p.page_id = cn.page_id LEFT JOIN imf ON imf.page_id = cn.page_id
LEFT JOIN dcf ON dcf.page_id = cn.page_id LEFT JOIN mtf ON mtf.page_id = cn.page_id WHERE cn.status = 'ok'""")
def q_crawl_full_records(spark, sf):
    """Images, documents (one a page at most) and meta tags on."""
    from sitegraph.plans import crawl as C
    pp, store, roots = _crawl_inputs(spark, sf)
    opts = C.CrawlOptions(max_depth=CRAWL_DEPTH, referrer=REFERRER)
    out = C.crawl_full(store, roots, opts, assets=T.stored_assets(pp).unionByName(T.stored_images(pp)), with_images=True,
                       with_documents=True, with_meta=True, max_documents=1, run_ts=RUN_TS)
    return out["records"].select("root_url", "url", "page_id", "title", "file_name", *_files_text(), "content")


NESTED_SELECTORS = ["article p", "nav li a, footer a", "body article h1"]


def _col_name(selector: str) -> str:
    import re
    return "n_" + re.sub(r"\W+", "_", selector).strip("_")


@register("content_text_nested", "WITH " + _tokens_sql("pages").strip()
          + _selected_text_sql("pages", NESTED_SELECTORS) + "\nSELECT page_id, content FROM seltext")
def q_content_text_nested(spark, sf):
    from sitegraph.operators import content as C
    return C.selected_text(T.pages(spark, sf), NESTED_SELECTORS)


@register("nested_counts", "WITH " + _tokens_sql("pages").strip() + ",\n" + _cands_sql(NESTED_SELECTORS) + """
SELECT p.page_id, """ + ", ".join(
    f"coalesce(sum(CASE WHEN c.si = {i} THEN 1 ELSE 0 END), 0)::BIGINT AS {_col_name(sel)}"
    for i, sel in enumerate(NESTED_SELECTORS)) + """
FROM pages p LEFT JOIN cand c ON c.page_id = p.page_id GROUP BY p.page_id""")
def q_nested_counts(spark, sf):
    from sitegraph.operators import content as C
    df = C.selector_counts(T.pages(spark, sf), NESTED_SELECTORS)
    return df.select("page_id", *[F.col(f"`{s}`").alias(_col_name(s)) for s in NESTED_SELECTORS])


@register("crawl_stream_records", _crawl_sql() + f""",
ptext AS (SELECT page_id, {D.clean_html('html')} AS c FROM pplus)
SELECT cn.root_url, cn.url, cn.depth, {D.title_of('p.c')} AS title, {D.text_of('p.c')} AS content
FROM cn JOIN ptext p ON p.page_id = cn.page_id WHERE cn.status = 'ok'""")
def q_crawl_stream_records(spark, sf):
    from sitegraph.plans import crawl as C
    from sitegraph.streaming import stream as ST
    pp = T.pages_plus(spark, sf)
    landing = _landing(spark, pp.select("page_id", "url", "html"), "records")
    roots = pp.where("rn = 0").select(F.col("url").alias("root_url"))
    opts = C.CrawlOptions(max_depth=CRAWL_DEPTH, referrer=REFERRER)
    return ST.crawl_stream_records(spark, landing, roots, opts, status_fn=T.page_status)
