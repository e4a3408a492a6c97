"""The row expressions of nesting against a tree builder with a stack, on markup put together at random."""
import random

import plain_dom as PD
import plain_markdown as PM
from pyspark.sql import functions as F

from sitegraph.functions import selectors as S
from sitegraph.operators import dom

_WORDS = ["a", "b c", " x ", "\n", "&amp;", "&#128512;", "1 < 2", "é ü", "  two  spaces ", "\t", "&nbsp;"]
_TAGS = "div p span b i em a ul ol li table tr td th tbody pre code blockquote h1 h2 section article nav dl dt dd select option".split()


def _markup(rng, size):
    """Well nested for the most part: end tags are left out, doubled or of other elements now and then."""
    out, open_ = [], []
    for _ in range(size):
        r = rng.random()
        if r < 0.4:
            tag = rng.choice(_TAGS)
            attrs = {"a": ' href="/%d?x=1&amp;y"' % rng.randrange(9), "code": " data-language=py" if rng.random() < 0.5 else ""}.get(tag, "")
            attrs += rng.choice(["", "", ' class="k one"', " id=m", " class='k'"])
            out.append(f"<{tag}{attrs}>")
            open_.append(tag)
        elif r < 0.65 and open_:
            tag = open_.pop()
            if rng.random() < 0.85:
                out.append(f"</{tag}>")
            elif rng.random() < 0.2:
                out.append("</b>")
        elif r < 0.72:
            out.append(rng.choice(["<br>", '<img src="/i.png" alt="&lt;">', "<hr/>", "<!-- c <p> -->", "<script>var x='</p>';</script>", "<img alt=n>"]))
        else:
            out.append(rng.choice(_WORDS))
    return "".join(out)


def _pages(n, seed):
    rng = random.Random(seed)
    heads = ["", "<html><head><title>t</title></head><body class=k>", "<body>", "<html><head><meta name=x><p>early", "<!DOCTYPE html><html>"]
    return [rng.choice(heads) + _markup(rng, rng.randrange(1, 60)) + rng.choice(["", "</body></html>", "<", "<p"]) for _ in range(n)] + ["", None, "plain text", "</p>"]


def _frame(spark, pages):
    return spark.createDataFrame(list(enumerate(pages)), "page_id int, html string").repartition(4)


def test_markdown_equals_the_tree(spark):
    pages = _pages(1500, 1)
    from sitegraph.operators import markdown as MD
    got = {r.page_id: r.markdown for r in MD.markdown(_frame(spark, pages)).collect()}
    for i, page in enumerate(pages):
        assert got[i] == PM.convert(PD.parse(page or "")), repr(page)


def test_replaced_converters_equal_the_tree(spark):
    pages, rules = _pages(300, 2), {"ul": ("[", "]"), "table": ("{", "}"), "a": ("<", ">"), "blockquote": ("", "'")}
    from sitegraph.operators import markdown as MD
    got = {r.page_id: r.markdown for r in MD.markdown(_frame(spark, pages), rules).collect()}
    for i, page in enumerate(pages):
        assert got[i] == PM.convert(PD.parse(page or ""), rules), repr(page)


SELECTORS = ["p", ".k", "div .k, section p", "b, i", "ul li a", "#m", "td[class=k]", "article div span.k"]


def test_spans_equal_the_tree(spark):
    pages = _pages(1500, 3)
    chains = [S.parse_chains(s) for s in SELECTORS]
    rows = dom.with_dom(_frame(spark, pages), counts=SELECTORS, first=SELECTORS[2:]).collect()
    for r in rows:
        source = r.html or ""
        page = PD.parse(source)
        assert r._counts == [len(PD.select(page, c)) for c in chains], repr(source)
        assert r._first == PD.first_markup(source, page, chains[2:]), repr(source)


def test_text_of_selected_equals_the_tree(spark):
    rng = random.Random(4)
    pages = [p for p in _pages(2500, 5) if p] + ["<pre> a\n <b> b </b>\n</pre><p> c <pre>  d</p>"]
    selectors = rng.sample(SELECTORS, 5)
    chains = [S.parse_chains(s) for s in selectors]
    rows = dom.with_dom(_frame(spark, pages), text=selectors).collect()
    assert len(rows) > 2000
    for r in rows:
        page = PD.parse(r.html)
        if "<pre" in r.html and any(n.run_end != n.end for c in chains for n in PD.select(page, c)):
            continue  # what runs on is read anew there, with other ends for a pre that has none of its own
        assert r._text == PD._text_of_selected(r.html, PD.parse(r.html), chains), repr(r.html)


def test_long_and_deep_pages(spark):
    """A flat page of many elements and one nested to any depth."""
    from sitegraph.operators import markdown as MD
    flat = "<body>" + "".join(f"<p>paragraph {i} <b>bold</b></p>" for i in range(8000))
    deep = "<div>" * 1500 + "deep" + "</div>" * 1500 + "<p>end"
    got = {r.page_id: r.markdown for r in MD.markdown(_frame(spark, [flat, deep])).collect()}
    assert got[0] == "".join(f"paragraph {i} **bold**\n\n" for i in range(8000)) and got[1].strip() == "end"
    one = dom.with_dom(_frame(spark, [flat, deep]), counts=["p b", "div div div"]).orderBy("page_id").select(F.col("_counts")).collect()
    assert [list(r[0]) for r in one] == [[8000, 0], [0, 1498]]
