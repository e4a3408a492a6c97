"""DuckDB forms of the derived inputs (see ``sources.tables``)."""

PAGES_PLUS = """
p0 AS (
  SELECT page_id, url, html, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host FROM pages),
p1 AS (
  SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) - 1 AS rn FROM p0),
edges AS (
  SELECT a.page_id, b.url AS dst FROM p1 a JOIN p1 b ON a.host = b.host
   WHERE b.rn = a.rn * 2 + 1 OR b.rn = a.rn * 2 + 2 OR b.rn = a.rn + 5 OR (a.rn > 0 AND b.rn = 0)),
nav AS (
  SELECT page_id, string_agg(concat('<a href="', dst, '">go</a>'), '' ORDER BY dst) AS links
  FROM edges GROUP BY page_id),
pplus AS (
SELECT p1.page_id, p1.url, p1.host, p1.rn::BIGINT AS rn,
 replace(replace(p1.html, '</head>', concat(
   CASE WHEN p1.page_id % 2 = 0 THEN concat('<meta name="description" content="d', CAST(p1.page_id AS VARCHAR), '">') ELSE '' END,
   CASE WHEN p1.page_id % 3 = 0 THEN '<meta property="og:type" name="both" content="article">' ELSE '' END,
   CASE WHEN p1.page_id % 5 = 0 THEN '<meta name="robots" content="">' ELSE '' END, '</head>')),
  '<article>', concat('<article>', coalesce(nav.links, ''),
   '<a href="#sec">s</a><a href="javascript:void(0)">j</a>',
   concat('<a href="/files/r', CAST(p1.page_id % 7 AS VARCHAR), '.pdf?v=1">d</a>'),
   CASE WHEN p1.page_id % 4 = 0 THEN '<a href="https://other.example.edu/x">x</a>' ELSE '' END,
   CASE WHEN p1.page_id % 2 = 1 THEN concat('<img src="/img/', CAST(p1.page_id AS VARCHAR), '.png">') ELSE '' END,
   CASE WHEN p1.page_id % 6 = 0 THEN '<img src="https://cdn.example.org/image?url=%2Fa%2Fb.jpg&w=10">' ELSE '' END,
   CASE WHEN p1.page_id % 8 = 0 THEN '<img src="data:image/png;base64,iVBORw0KGgo=">' ELSE '' END,
   CASE WHEN p1.page_id % 9 = 0 THEN concat('<iframe src="https://player.example.net/v/', CAST(p1.page_id AS VARCHAR), '"></iframe>') ELSE '' END)) AS html
FROM p1 LEFT JOIN nav ON p1.page_id = nav.page_id)
"""

PAGE_STATUS = """
pstatus AS (
  SELECT page_id, url, html,
         CASE WHEN page_id % 13 = 5 THEN 404 WHEN page_id % 17 = 3 THEN 500 ELSE 200 END AS status
  FROM pages)
"""

ROBOTS = """
robots AS (
  SELECT origin, CASE length(origin) % 4
    WHEN 0 THEN concat('User-agent: *', chr(10), 'Allow: /en/1', chr(10), 'Disallow: /en', chr(10))
    WHEN 1 THEN concat('# none', chr(10), 'User-agent: otherbot', chr(10), 'Disallow: /', chr(10),
                       'User-agent: testbot', chr(10), 'Disallow: /de', chr(10))
    ELSE concat('User-agent: *', chr(10), 'Disallow:', chr(10)) END AS body
  FROM (SELECT DISTINCT regexp_extract(url, '^([a-z]+://[^/:?#]+)', 1) AS origin FROM pages) o
  WHERE length(origin) % 4 <> 3)
"""

ASSETS = """
assets AS (
  SELECT concat(o.origin, '/files/r', CAST(k.n AS VARCHAR), '.pdf?v=1') AS url,
    CASE WHEN k.n % 3 = 0 THEN 404 ELSE 200 END AS status,
    CASE WHEN k.n % 2 = 0 THEN concat('attachment; filename="report%20', CAST(k.n AS VARCHAR), '.pdf"') END AS disposition,
    concat('body ', CAST(k.n AS VARCHAR)) AS body
  FROM (SELECT DISTINCT regexp_extract(url, '^([a-z]+://[^/:?#]+)', 1) AS origin FROM pages) o,
       (SELECT unnest(range(0, 7)) AS n) k)
"""

SEARCH = """
search AS (
  SELECT doc_id AS query_id, concat('{"searchParameters":{"q":"', lang, ' ', CAST(doc_id AS VARCHAR), '","engine":"google","type":"search"},"credits":1,',
   '"knowledgeGraph":{"title":"t', CAST(doc_id AS VARCHAR), '","type":"', source, '"},',
   '"organic":[{"position":1,"title":"a","link":"https://a.example.org/', CAST(doc_id AS VARCHAR), '","snippet":"s","sitelinks":[{"title":"x","link":"https://a.example.org/x"}]},',
   '{"position":2,"title":"b","link":"https://b.example.org/', CAST(doc_id % 9 AS VARCHAR), '","snippet":"s","rating":4.5,"ratingCount":3}],',
   '"peopleAlsoAsk":[{"question":"q","snippet":"s","link":"https://c.example.org/","title":"c"}],"images":[{"imageUrl":"https://img.example.org/',
   CAST(doc_id AS VARCHAR), '.png","link":"https://a.example.org/","title":"i"}],"extra":{"kept":[1,', CAST(n_chars AS VARCHAR), ']}}') AS body
  FROM documents)
"""


def _esc(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _conv(piece: str, head: str, tail: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT conv_id AS page_id, concat('<html><head><title>Conversation ', CAST(conv_id AS VARCHAR),
    '</title></head><body><h2>Conversation ', CAST(conv_id AS VARCHAR), '</h2>{head}',
    string_agg({piece}, '' ORDER BY turn), '{tail}</body></html>') AS html
  FROM conversations GROUP BY conv_id)
"""


CONV_LISTS = _conv("concat('<li><b>', role, '</b>: ', " + _esc("text") +
                   ", '<ul><li>', role, '</li><li>turn ', CAST(turn AS VARCHAR), '</li></ul></li>')",
                   "<ol>", "</ol>", "mdsrc")
CONV_TABLES = _conv("concat('<tr><td>', CAST(turn AS VARCHAR), '</td><td><i>', role, '</i></td><td>', " +
                    _esc("text") + ", '</td></tr>')",
                    "<table><tr><th>turn</th><th>role</th><th>text</th></tr>", "</table>", "mdsrc")
DOC_BLOCKS = f"""
mdsrc AS (
  SELECT doc_id AS page_id, concat('<html><body><h3>', source, '</h3><blockquote>',
    array_to_string(list_transform(string_split({_esc('text')}, chr(10)), lambda l: concat('<p>', l, '</p>')), ''),
    '</blockquote><pre><code data-language="', lang, '">', {_esc('text')}, '</code></pre></body></html>') AS html
  FROM documents)
"""
