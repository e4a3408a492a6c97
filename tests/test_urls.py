"""Golden values for the URL expressions."""
import pytest
from pyspark.sql import functions as F

from conftest import one
from sitegraph.functions import urls as U

BASE = "https://www.example.com/a/b/page.html?x=1#top"


@pytest.mark.parametrize("href,expected", [
    ("/x", "https://www.example.com/x"),
    ("x/y", "https://www.example.com/a/b/x/y"),
    ("../c", "https://www.example.com/a/c"),
    ("./d?q=1", "https://www.example.com/a/b/d?q=1"),
    ("?p=2", "https://www.example.com/a/b/page.html?p=2"),
    ("#sec", "https://www.example.com/a/b/page.html?x=1#sec"),
    ("//cdn.example.org/i.png", "https://cdn.example.org/i.png"),
    ("https://other.example.edu/x", "https://other.example.edu/x"),
    ("javascript:void(0)", "javascript:void(0)"),
    ("mailto:a@b.c", "mailto:a@b.c"),
    ("  /t  ", "https://www.example.com/t"),
    ("/für", "https://www.example.com/für"),
])
def test_resolve_url(spark, href, expected):
    assert one(spark, U.resolve_url, BASE, href) == expected


@pytest.mark.parametrize("url,expected", [
    ("https://h.example.com/a#top", "https://h.example.com/a"),
    ("https://h.example.com/a##x", "https://h.example.com/a"),
    ("https://h.example.com/für?q=ü", "https://h.example.com/f%C3%BCr?q=%C3%BC"),
    ("https://h.example.com/a b", "https://h.example.com/a%20b"),
    ("https://h.example.com/%2F/x", "https://h.example.com/%2F/x"),
    ("https://H.example.com:8080/A/?b=1&a=2", "https://H.example.com:8080/A/?b=1&a=2"),
    ("javascript:void(0)", None),
    ("mailto:x@y.z", None),
])
def test_clean_url(spark, url, expected):
    assert one(spark, U.clean_url, url) == expected


@pytest.mark.parametrize("url,expected", [
    ("https://h.example.com/r.pdf?v=1", True), ("https://h.example.com/R.DOCX#x", True),
    ("https://a.zip", True), ("https://h.example.com/a.html", False), ("https://h.example.com/a.", False),
    ("https://h.example.com/file.pdfx", False), ("https://h.example.com/x?f=a.pdf", False), ("", False),
])
def test_is_document(spark, url, expected):
    assert one(spark, U.is_document, url) is expected


@pytest.mark.parametrize("page,link,expected", [
    ("https://h.example.com/p", "https://h.example.com/p#s", "reference"),
    ("https://h.example.com/p?a=1", "https://h.example.com/p?b=2#s", "reference"),
    ("https://h.example.com/p", "https://h.example.com/q#s", "internal"),
    ("https://h.example.com/p", "http://h.example.com/p#s", "internal"),
    ("https://h.example.com/p", "https://other.org/?ref=h.example.com", "internal"),
    ("https://h.example.com/p", "https://sub.h.example.com/x", "internal"),
    ("https://sub.h.example.com/p", "https://h.example.com/x", "external"),
    ("https://h.example.com/p", "javascript:void(0)", "external"),
    ("https://h.example.com/p", "https://h.example.com/d.pdf", "documents"),
])
def test_link_kind(spark, page, link, expected):
    assert one(spark, U.link_kind, page, link) == expected


@pytest.mark.parametrize("depth,expected", [(0, "1.0"), (3, "0.7"), (7, "0.3"), (10, "0.0"), (12, "0.0")])
def test_priority(spark, depth, expected):
    assert one(spark, U.priority, depth) == expected


@pytest.mark.parametrize("url,expected", [
    ("https://cdn.example.org/image?url=%2Fa%2Fb.jpg&w=10", "/a/b.jpg"),
    ("https://cdn.example.org/image?w=10", "https://cdn.example.org/image?w=10"),
    ("https://cdn.example.org/image?url=", "https://cdn.example.org/image?url="),
    ("https://cdn.example.org/i.png", "https://cdn.example.org/i.png"),
])
def test_embedded_url(spark, url, expected):
    assert one(spark, U.embedded_url, url) == expected


def test_file_helpers(spark):
    assert one(spark, U.image_file_name, "/a/b.jpg") == "b.jpg"
    assert one(spark, U.image_file_name, "https://x.org/img/pic?w=1") == "pic.jpg"
    assert one(spark, U.mime_type, "a.PNG") == "image/png"
    assert one(spark, U.mime_type, "a.doc") == "application/octet-stream"
    assert one(spark, U.sanitize_file_name, 'a b/c:d*e?"f"<g>|h') == "ab_c_d_e__f__g__h"
    assert one(spark, U.escape_xml, "a&b<c>\"d'") == "a&amp;b&lt;c&gt;&quot;d&apos;"
    assert one(spark, U.origin, "https://h.example.com:8443/x") == "https://h.example.com"


def test_url_filter(spark):
    f = lambda c: U.url_filter(c, [r"https://www\.googletagmanager\.com/.*"], "exclude")
    assert one(spark, f, "https://www.googletagmanager.com/gtm.js") is False
    assert one(spark, f, "https://example.com/") is True
    inc = lambda c: U.url_filter(c, [r"https://x\.org/a"], "include")
    assert one(spark, inc, "https://x.org/a") is True
    assert one(spark, inc, "https://x.org/a/b") is False  # whole-string match
    assert one(spark, lambda c: U.url_filter(c, [], "include"), "z") is True
    with pytest.raises(ValueError):
        U.url_filter(F.lit("x"), ["a"], "maybe")


def test_keys_of_urls_that_need_encoding(spark):
    for url, key in [("http://h/a[1]", "http://h/a%5B1%5D"), ("http://h/100%", "http://h/100%25"), ("http://h/%41%%", "http://h/%41%25%25"),
                     ("http://[::1]:8/x", "http://[::1]:8/x")]:
        assert one(spark, U.clean_url, url) == key
    assert one(spark, U.encode_component, "a b/c:d~é+") == "a%20b/c:d~%C3%A9%2B"


def test_base_href(spark):
    from sitegraph.operators import links as L
    html = '<head><base href="https://cdn.org/z/"></head><a href="x">x</a><a href="#f">f</a><a href="https://h.org/q">q</a><img src="i.png">'
    df = spark.createDataFrame([(1, "https://h.org/a/b", html), (2, "https://h.org/a/b", '<a href="x">')], "page_id long, url string, html string")
    assert sorted((r.page_id, r.kind, r.link) for r in L.page_links(df).collect()) == [
        (1, "external", "https://h.org/q"), (1, "images", "https://cdn.org/z/i.png"), (1, "internal", "https://cdn.org/z/x"),
        (1, "reference", "https://cdn.org/z/#f"), (2, "internal", "https://h.org/a/x")]


def test_valid_page_of_a_key_comes_first(spark):
    from sitegraph.plans import crawl as CR
    store = spark.createDataFrame([(1, "http://h/a", "", 404), (2, "http://h/a#x", "", 200)], "page_id long, url string, html string, status int")
    g = CR.page_graph(store, CR.CrawlOptions(max_depth=1)).first()
    assert (g.page_id, g.valid) == (2, True)
