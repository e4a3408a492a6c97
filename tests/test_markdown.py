"""Markdown rule goldens."""
import pytest

from sitegraph.operators import markdown as MD


def md(spark, html):
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    return MD.markdown(df).first()["markdown"]


@pytest.mark.parametrize("body,expected", [
    ("<h1>T</h1>", "# T\n\n"), ("<h3>T</h3>", "### T\n\n"), ("<p>a <b>b</b> <i>c</i></p>", "a **b** *c*\n\n"),
    ("<p>a<br>b</p>", "a\nb\n\n"), ("<div>x</div><hr>", "x\n\n---\n"),
    ('<p><a href="/x">X</a> <a href="">Y</a></p>', "[X](/x) Y\n\n"),
    ('<p><img src="/i.png" alt="I"><img alt="none"></p>', "![I](/i.png)\n\n"),
    ("<ul><li>a</li><li>b</li></ul>", "* a\n* b\n\n"),
    ("<ol><li>a</li><li>b</li></ol>", "1. a\n2. b\n\n"),
    ("<p><code>x<b>y</b></code></p>", "`xy`\n\n"),
    ('<pre><code data-language="py">x = 1</code></pre>', "```py\nx = 1\n```\n\n"),
    ("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>", "a | b\n--- | ---\n1 | 2\n\n"),
    ("<blockquote><p>q</p>r</blockquote>", "> q\n> r\n\n"),
    ("bare<span>s</span>", "s"),
    ("<p>a</p><p></p><p></p><p>b</p>", "a\n\nb\n\n"),
])
def test_rules(spark, body, expected):
    assert md(spark, f"<html><head><title>x</title></head><body>{body}</body></html>") == expected


def test_unknown_tag_passes_content(spark):
    assert md(spark, "<body><section><custom>hi</custom></section></body>") == "hi"


# Worked out from the converters' rules by hand.
@pytest.mark.parametrize("body,expected", [
    ("</b><p>hello</p><p>world</p>", "hello\n\nworld\n\n"),
    ("<p>" * 104 + "<h2>T</h2><ul><li><b>z</b></li></ul>", "\n\n## T\n\n* **z**\n\n"),
    ("<div>" * 101 + "deep" + "</div>" * 101, "\n\n"),
    ("<span>" * 99 + "x" + "</span>" * 99, "x"),
    ("<ul>\n <li>a</li>\n <li>b</li>\n</ul>", "* a\n* b\n\n"),
    ("<ul>x<li>a<li>b<ol><li>c<li>d</ol></ul>", "* a\n* b1. c\n2. d\n\n\n"[:-1]),
    ("<table><tr><th>a<th>b<tr><td>1<td>2<tr><th>h<td>3</table>", "a | b\n--- | ---\n1 | 2\n3\n\n"),
    ("<table><tr><td>a<table><tr><td>i</td></tr></table></td></tr></table>", "ai | i\n--- | ---\ni\n\n"),
    ("<div><table><tr><td>1</td><td>2</td></tr></table></div>", "1 2\n\n"),
    ("<blockquote>x <b>y</b> z</blockquote>", "> x\n> **y**\n> z\n\n"),
    ("<blockquote><blockquote><blockquote><p>q</p></blockquote></blockquote></blockquote>", "> > > q\n\n"),
    ("<blockquote><p>a</p>\n<span></span></blockquote>", "> a\n> \n> \n\n"[:-2] + "\n\n"),
    ("<p><code> x </code></p>", "`x`\n\n"),
    ('<p><a href="/1">x<a href="/2">y</a></p>', "[x](/1)[y](/2)\n\n"),
    ('<pre><code data-language="py"> x = 1\n y </code></pre>', "```py\nx = 1\n y\n```\n\n"),
    ('<pre class="language-py">a\n b</pre>', "```\na b\n```\n\n"),
    ("<p>&#128512; &check; &lbrace;</p>", "😀 ✓ {\n\n"),
])
def test_trees(spark, body, expected):
    assert md(spark, f"<html><body>{body}</body></html>") == expected


def test_rules_replace_any_converter(spark):
    df = spark.createDataFrame([(1, '<body><p><a href="/x">t</a><code>c</code></p><ul><li>i</ul></body>')], "page_id long, html string")
    got = MD.markdown(df, {"a": ("<", ">"), "code": ("'", "'"), "ul": ("[", "]")}).first()["markdown"]
    assert got == "<t>'c'\n\n[i]"
