"""Golden values for the row-local HTML expressions."""
import pytest

from conftest import one
from sitegraph.functions import html as H
from sitegraph.functions import selectors as S


def text(html):
    return lambda c: H.text_of(H.clean_html(c))


@pytest.mark.parametrize("html,expected", [
    ("<p>a</p><p>b</p>", "a b"),
    ("<b>x</b>y", "xy"),
    ("<div>One</div>Two", "One Two"),
    ("a<br>b", "a b"),
    ("<p>A &amp; B &lt;c&gt; &copy; &#233; &#x41; &amp</p>", "A & B <c> © é A &"),
    ("<p>a<!-- hidden --></p><script>var t='</p>';</script><style>p{}</style>", "a"),
    ("<p>  many   \n spaces&nbsp;here </p>", "many spaces here"),
    ("<title>T</title><body><li>x</li><li>y</li></body>", "T x y"),
    ('<a title="a > b" href="/x">link</a>', "link"),
])
def test_text(spark, html, expected):
    assert one(spark, lambda c: H.text_of(H.clean_html(c)), html) == expected


def test_title_and_words(spark):
    assert one(spark, lambda c: H.title_of(H.clean_html(c)), "<title> A  &amp; B </title>") == "A & B"
    assert one(spark, lambda c: H.title_of(H.clean_html(c)), "<p>none</p>") == ""
    assert one(spark, H.word_count, "  one two\tthree ") == 3
    assert one(spark, H.word_count, "   ") == 0


def test_attr(spark):
    tag = """<a HREF='/x?a=1&amp;b=2' data-x=y class="c1  c2" disabled>"""
    assert one(spark, lambda c: H.attr(c, "href"), tag) == "/x?a=1&b=2"
    assert one(spark, lambda c: H.attr(c, "data-x"), tag) == "y"
    assert one(spark, lambda c: H.attr(c, "disabled"), tag) == ""
    assert one(spark, lambda c: H.attr(c, "title"), tag) is None


@pytest.mark.parametrize("selector,expected", [
    ("div", 2), ("p", 3), ("h6", 0), (".c", 2), ("p.c", 1), ("#main", 1), ("a[href]", 1),
    ("a[href=/x]", 1), ("div, p", 5), ("*", 7),
])
def test_element_count(spark, selector, expected):
    html = ('<div id="main"><p class="c">a</p><p>b</p></div><div class="c x"><p>c</p>'
            '<a href="/x">l</a><a>m</a></div>')
    assert one(spark, lambda c: S.element_count(H.clean_html(c), selector), html) == expected


def test_bad_selector():
    with pytest.raises(ValueError):
        S.parse("div > p")


def test_descendant_selectors(spark):
    from sitegraph.operators import content as C
    from sitegraph.operators import insights as I
    html = ('<html><body><nav><a href="/1">one</a></nav><article><h1>T</h1><p>a <a href="/2">two</a></p>'
            '<div><p>b</p></div></article><p>out</p><footer><a>three</a></footer></body></html>')
    df = spark.createDataFrame([(1, "http://h.org/", html)], "page_id long, url string, html string")
    assert C.selected_text(df, ["article p"]).first()["content"] == "a two b"
    assert C.selected_text(df, ["nav a, footer a"]).first()["content"] == "one three"
    assert C.first_match_html(df, ["article div p"]).first()["content"] == "<p>b</p>"
    row = I.page_insights(df, selectors=["p", "article p", "body article a"]).first()
    assert (row["p"], row["article p"], row["body article a"]) == (3, 2, 1)
    with pytest.raises(ValueError):
        S.parse_chains("article > p")


def test_named_entities_from_standard_table(spark):
    f = lambda c: H.text_of(H.clean_html(c))
    assert one(spark, f, "<p>caf&eacute; &rarr; &Omega; &euro; &copy &notanentity; &amp;lt;</p>") == \
        "café → Ω € © &notanentity; &lt;"


def test_unclosed_element_ends_with_its_parent(spark):
    from sitegraph.operators import content as C
    html = "<html><body><div><p><b>bold<p>more</p></div><p>after</p></body></html>"
    df = spark.createDataFrame([(1, "http://h.org/", html)], "page_id long, url string, html string")
    assert C.selected_text(df, ["b"]).first()["content"] == "bold more"
    assert C.first_match_html(df, ["b"]).first()["content"] == "<b>bold<p>more</p>"
    # the first p closes at the next p start
    assert C.selected_text(df, ["div p"]).first()["content"] == "bold more"
    # a non-formatting element is not re-opened: it ends with its implicit p
    df2 = spark.createDataFrame([(1, "http://h.org/", "<body><div><p><span>x<p>y</p></div></body>")],
                                "page_id long, url string, html string")
    assert C.selected_text(df2, ["span"]).first()["content"] == "x"


@pytest.mark.parametrize("tag,name,expected", [
    ('<a title="see href=bad here" href="/good">', "href", "/good"), ('<img alt="a src=no">', "src", None),
    ("<a HREF=x/y z>", "href", "x/y"), ("<a href>", "href", ""), ('<a data-href="q">', "href", None),
    ("<a class='a' href = 'b c' href=d>", "href", "b c"),
])
def test_attributes_are_read_in_order(spark, tag, name, expected):
    assert one(spark, lambda c: H.attr(c, name), tag) == expected


def test_references_of_every_plane(spark):
    assert one(spark, H.decode_entities, "&#128512; &#x1F600; &check; &lbrace; &NotEqualTilde; &#xD800; &amp;lt;") == \
        "😀 😀 ✓ { ≂̸ &#xD800; &lt;"


def test_unclosed_items_are_elements(spark):
    from sitegraph.operators import content as C
    df = spark.createDataFrame([(1, "u", "<ul><li>a<li>b</ul>")], "page_id long, url string, html string")
    assert C.selected_text(df, ["li"]).first()["content"] == "a b"
    assert C.selector_counts(df, ["li"]).first()["li"] == 2
