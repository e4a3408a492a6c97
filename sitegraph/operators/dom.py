"""Nesting of a page's elements, for operators that need it, as row expressions.

Counts, links, titles and page text read a page's tags one by one.  Text of
selected elements, element markup and Markdown depend on which element holds
which, to any depth.  The page is cut into its marks (tags, comments, script and
style blocks) and the texts behind them, one array in the row; ``aggregate`` folds
that array with the stack of open elements in its accumulator.  Nothing leaves the
row or the JVM, nothing is shuffled, and the same expressions run on a stream.

Tree rules (the part of HTML5 tree building that page stores need):

* void elements have no content; script and style have no text;
* an end tag closes the nearest open element of its name, and what is open
  inside it; without one it is ignored, as are the end tags of html and body;
* li, dt, dd, tr, td, th, option and optgroup end at the next one of their
  kind in the same container, p at the next block, a at the next a;
* other open elements end with the element around them.  Inside a p that ends
  without an end tag, formatting elements end with it in the tree; HTML5
  opens them anew in what follows, so as selected elements they run on to the
  end of the element around the p;
* an unfinished tag is text.

Every tag becomes one to three operations of the fold: end an open p, end an open
element of a kind, and open or close an element.  Each of them names the tags it
``want``s to close and those that ``stop`` the search, so one expression serves all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegraph.functions import html as H
from sitegraph.functions import patterns as P
from sitegraph.functions import selectors as S
from sitegraph.operators.tokens import FORMATTING_TAGS, VOID_TAGS

MARK_RE = (r"(?is)<!--.*?-->|<(script|style)(?:[ \t\n\r\f/][^>]*+)?>.*?</\1[ \t\n\r\f]*+>|" + P.TAG_RE_JAVA)
_HEAD = "base link meta noscript script style template title".split()
_ENDS_P = """address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul""".split()
#: Opening one of these ends an open one of the first list, looked for up to the second.
_ENDS = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"),
         "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tbody": ("thead tbody tfoot tr", "table"),
         "tfoot": ("thead tbody tr", "table"), "option": ("option", "select datalist"), "optgroup": ("option optgroup", "select"),
         "a": ("a", "table td th button object")}
_P_SCOPE = "table td th caption button object".split()
# Characters that stand for white space and invisible ones of a pre while the rest is collapsed: no text holds them.
_SPACES, _KEPT = " \t\n\r\f\u00a0\u00ad\u200b", "\ufdd0\ufdd1\ufdd2\ufdd3\ufdd4\ufdd5\ufdd6\ufdd7"
_SPACE = "[ \t\n\r\f\u00a0]"


def words(names) -> Column:
    names = names.split() if isinstance(names, str) else names
    return F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")


def sql_list(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def one_space(text: Column) -> Column:
    """White space runs as one space; soft hyphens and zero-width spaces gone; not trimmed."""
    return F.regexp_replace(F.regexp_replace(text, "[\u00ad\u200b]", ""), f"{_SPACE}+", " ")


def normal(raw: str) -> str:
    """SQL: text from its raw form, where what stands in a pre is kept as written."""
    spaces = "[ \\\\t\\\\n\\\\r\\\\f\\u00a0]"
    flat = f"regexp_replace(regexp_replace({raw}, '[\\u00ad\\u200b]', ''), '{spaces}+', ' ')"
    flat = f"regexp_replace({flat}, '([\\ufdd0-\\ufdd5]) ', '$1')"
    return f"regexp_replace(translate({flat}, '{_KEPT}', ' \\t\\n\\r\\f\\u00a0\\u00ad\\u200b'), '^{spaces}+|{spaces}+$', '')"


def one_space_sql(text: str) -> str:
    """SQL form of ``one_space``."""
    return f"regexp_replace(regexp_replace({text}, '[\\u00ad\\u200b]', ''), '[ \\\\t\\\\n\\\\r\\\\f\\u00a0]+', ' ')"


def kept_sql(text: str) -> str:
    """SQL form of ``kept``."""
    return f"translate({text}, ' \\t\\n\\r\\f\\u00a0\\u00ad\\u200b', '{_KEPT}')"


def kept(text: Column) -> Column:
    return F.translate(text, _SPACES, _KEPT)


def steps(html: Column) -> Column:
    """``array<struct<mark, text, tag, kind>>``: a page's marks in order, each with the text behind it; before the first
    mark stands the text that the page begins with.  kind: o(pen), c(lose), v(oid) or n(one)."""
    page = F.coalesce(html, F.lit(""))
    page = F.when(page.contains("\u0001") | page.contains("\u0002"), F.translate(page, "\u0001\u0002", "")).otherwise(page)
    marked = F.regexp_replace(page, MARK_RE, "\u0001$0\u0002")

    def step(piece, i):
        mark = F.when(i == 0, F.lit("")).otherwise(F.substring_index(piece, "\u0002", 1))
        text = F.when(i == 0, piece).otherwise(F.substr(piece, F.length(mark) + 2))
        return F.struct(mark.alias("mark"), text.alias("text"), H.tag_name(mark).alias("tag"))

    def kind(s):
        raw = s["mark"].rlike(r"(?is)^<(script|style)[ \t\n\r\f/>].*</(script|style)[ \t\n\r\f]*>$")
        k = (F.when((s["tag"] == "") | s["mark"].startswith("<!"), "n").when(s["mark"].startswith("</"), "c")
             .when(raw | s["tag"].isin(VOID_TAGS), "v").otherwise("o"))
        return F.struct(s["mark"], s["text"], s["tag"], k.alias("kind"))

    return F.transform(F.transform(F.split(marked, "\u0001"), step), kind)


def _cases(tag: Column, which: int) -> Column:
    out = None
    for name, sets in _ENDS.items():
        out = F.when(tag == name, words(sets[which])) if out is None else out.when(tag == name, words(sets[which]))
    return out


def operations(every: Column, **extra) -> Column:
    """The fold's operations of ``steps``: ``i, tag, kind, want, stop, p, main`` and the fields that the ``extra`` functions
    give, once for each step.  An operation closes the nearest open element of ``want`` with all inside it, unless one of
    ``stop`` comes first; ``t`` closes what is on top (a void element after its opening), ``z`` all."""
    none = F.array().cast("array<string>")

    def of(s, i):
        more = [s[name].alias(name) for name in extra]

        def op(kind, want, stop, p, main):
            return F.struct(i.cast("int").alias("i"), s["tag"].alias("tag"), kind.alias("kind"), want.alias("want"), stop.alias("stop"),
                            F.lit(p).alias("p"), main.alias("main"), *more)
        starts = s["kind"].isin("o", "v")
        own = F.when((s["kind"] == "c") & ~s["tag"].isin("html", "body"), F.array(s["tag"])).otherwise(none)
        kind = F.when(s["kind"] == "v", "o").otherwise(s["kind"])
        return F.filter(F.array(
            F.when(starts & s["tag"].isin(_ENDS_P), op(F.lit("e"), words(["p"]), words(_P_SCOPE), True, F.lit(False))),
            F.when(starts & s["tag"].isin(list(_ENDS)), op(F.lit("e"), _cases(s["tag"], 0), _cases(s["tag"], 1), False, F.lit(False))),
            op(kind, own, none, False, s["kind"] != "v"),
            F.when(s["kind"] == "v", op(F.lit("t"), none, none, False, F.lit(True)))), lambda x: x.isNotNull())

    ready = F.transform(every, lambda s: F.struct(s["tag"].alias("tag"), s["kind"].alias("kind"), *[f(s).alias(n) for n, f in extra.items()]))
    ops = F.flatten(F.transform(ready, of))
    # what ends the page: the first step again, as an operation that closes all and adds nothing
    def ended(o):
        return F.concat(o, F.transform(F.slice(o, 1, 1), lambda x: x.withField("kind", F.lit("z")).withField("i", F.size(every))
                                       .withField("want", none).withField("main", F.lit(False))))
    return H.let(ops, ended)


#: SQL: place in the stack ``s`` (from 1) of the element that operation ``x`` closes, 0 for none.
CLOSES = f"""
CASE WHEN x.kind = 't' THEN size(s) WHEN x.kind = 'z' THEN if(size(s) > 1, 2, 0)
     WHEN x.kind IN ('o', 'e') AND element_at(s, -1).tag = 'head' AND x.tag NOT IN ({sql_list(_HEAD)}) THEN size(s)
     WHEN size(x.want) = 0 THEN 0
     ELSE aggregate(s, named_struct('j', 0, 'f', 0), (q, f) -> named_struct('j', q.j + 1, 'f',
            CASE WHEN array_contains(x.stop, f.tag) THEN 0 WHEN array_contains(x.want, f.tag) THEN q.j + 1 ELSE q.f END), q -> q.f) END"""


def bind(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` worked out once.

    It is the finish of a fold over nothing that starts from the value: ``transform``, which would do as well,
    copies what its lambda gives, here all that the page's open elements hold."""
    return f"aggregate(cast(array() AS array<int>), {value}, ({name}, none) -> {name}, {name} -> {body})"


# ------------------------------------------------------------- selectors
def _masks(selectors: list[str]):
    """Chains of all selectors as (selector, steps), and the function that gives a step's masks: per chain, a bit for
    each of its steps that the tag alone fulfils."""
    chains = [(i, c) for i, sel in enumerate(selectors) for c in S.parse_chains(sel)]

    def masks(s):
        def mask(chain):
            return sum((F.when(S.predicate(x, s["mark"], s["tag"]), F.lit(1 << j)).otherwise(0) for j, x in enumerate(chain)), F.lit(0))
        m = F.array(*[mask(c) for _, c in chains])
        return F.when(s["kind"].isin("o", "v"), m).otherwise(F.array().cast("array<int>"))
    return chains, masks


def found(selectors: list[str], ops: str, n: str) -> Column:
    """``struct<hits, stray, gaps>``. hits, ``array<struct<at, sel, pre, until, runs>>``: elements that match any of the
    selectors, in document order; stray: the steps whose end tags end nothing; gaps: the blocks that end
    without an end tag, with the step before which they do.

    ``ops`` and ``n`` name the columns of the operations (with the masks of ``_masks``) and of the number of steps.
    Places count marks and texts: mark i stands at 2i, its text at 2i + 1.  ``at`` is an element's start, ``until`` its
    end, ``runs`` the end of what runs on; ``sel`` are the numbers of the selectors, ``pre`` says that it is in a pre."""
    chains, _ = _masks(selectors)
    last = "array(" + ", ".join(str(len(c) - 1) for _, c in chains) + ")"
    owner = "array(" + ", ".join(str(i) for i, _ in chains) + ")"
    hit = f"""array_distinct(transform(filter(sequence(0, {len(chains) - 1}),
        c -> p.prog[c] >= {last}[c] AND (shiftright(x.m[c], {last}[c]) & 1) = 1), c -> {owner}[c]))"""
    prog = f"""transform(sequence(0, {len(chains) - 1}), c -> p.prog[c]
        + if(p.prog[c] < {last}[c] AND (shiftright(x.m[c], p.prog[c]) & 1) = 1, 1, 0))"""
    new = bind("p", "element_at(b.s, -1)", bind("h", hit, f"""named_struct(
        's', concat(b.s, array(named_struct('tag', x.tag, 'at', if(size(h) > 0, 2 * x.i, -1), 'prog', {prog}, 'run', cast(array() AS array<int>),
                                            'pre', p.pre OR x.tag = 'pre'))),
        'o', if(size(h) > 0, concat(b.o, array(named_struct('at', 2 * x.i, 'sel', h, 'pre', p.pre OR x.tag = 'pre'))), b.o), 'e', b.e, 'r', b.r, 'y', b.y, 'g', b.g)"""))
    run = f"""if(x.p, concat(transform(filter(reverse(slice(gone, 2, size(gone))), f -> f.at >= 0 AND f.tag IN ({sql_list(FORMATTING_TAGS)})),
                                   f -> f.at), gone[0].run), cast(array() AS array<int>))"""
    end = "if(x.kind = 't', 2 * x.i + 1, 2 * x.i)"
    shut = bind("gone", "slice(acc.s, k, size(acc.s) - k + 1)", bind("under", "acc.s[k - 2]", f"""named_struct(
        's', concat(slice(acc.s, 1, k - 2), array(named_struct('tag', under.tag, 'at', under.at, 'prog', under.prog,
                                                              'run', concat(under.run, {run}), 'pre', under.pre))),
        'o', acc.o,
        'e', if(exists(gone, f -> f.at >= 0), concat(acc.e, filter(
            transform(gone, (f, j) -> named_struct('at', f.at, 'until', if(j = 0 AND x.kind = 'c', 2 * x.i + 1, {end}))), f -> f.at >= 0)), acc.e),
        'r', if(NOT exists(gone, f -> size(f.run) > 0), acc.r, concat(acc.r, flatten(transform(gone, (f, j) -> if(x.p AND j = 0, cast(array() AS array<struct<at:int,until:int>>),
                                                                transform(f.run, q -> named_struct('at', q, 'until', {end}))))))), 'y', acc.y,
        'g', if(size(gone) = 1 AND x.kind = 'c', acc.g, concat(acc.g, transform(filter(transform(reverse(slice(gone, if(x.kind = 'c', 2, 1), size(gone))), f -> f.tag),
                                            t -> t IN ({sql_list(P.BLOCK_TAGS)})), t -> named_struct('i', x.i, 'tag', t)))))"""))
    stray = "if(x.kind = 'c', named_struct('s', acc.s, 'o', acc.o, 'e', acc.e, 'r', acc.r, 'y', concat(acc.y, array(x.i)), 'g', acc.g), acc)"
    closed = bind("k", bind("s", "acc.s", CLOSES), f"if(k = 0, {stray}, {shut})")
    step = bind("b", closed, f"if(x.kind = 'o', {new}, b)")
    zero = f"""named_struct('s', array(named_struct('tag', '#page', 'at', -1, 'prog', array_repeat(0, {len(chains)}),
                                                   'run', cast(array() AS array<int>), 'pre', false)),
        'o', cast(array() AS array<struct<at:int,sel:array<int>,pre:boolean>>), 'e', cast(array() AS array<struct<at:int,until:int>>),
        'r', cast(array() AS array<struct<at:int,until:int>>), 'y', cast(array() AS array<int>), 'g', cast(array() AS array<struct<i:int,tag:string>>))"""
    done = bind("r", f"concat(acc.r, transform(acc.s[0].run, q -> named_struct('at', q, 'until', 2 * {n})))", """transform(
        arrays_zip(array_sort(acc.o) AS o, array_sort(acc.e) AS e), z -> named_struct('at', z.o.at, 'sel', z.o.sel, 'pre', z.o.pre,
            'until', z.e.until, 'runs', coalesce(get(filter(r, q -> q.at = z.o.at), 0).until, z.e.until)))""")
    done = done.replace("arrays_zip(array_sort(acc.o) AS o, array_sort(acc.e) AS e)",
                        "zip_with(array_sort(acc.o), array_sort(acc.e), (o, e) -> named_struct('o', o, 'e', e))")
    return F.expr(f"aggregate({ops}, {zero}, (acc, x) -> {step}, acc -> named_struct('hits', {done}, 'stray', acc.y, 'gaps', acc.g))")


def text_of_markup(markup: Column, inside_pre: Column) -> Column:
    """Text of a piece of markup: blocks and br apart by a space, runs of white space one space (kept as written in
    pre), trimmed."""
    def as_written(v):
        def add(acc, s):
            text = H.decode_entities(s["text"])
            space = F.when((s["kind"] != "n") & s["tag"].isin(P.BLOCK_TAGS), " ").otherwise("")
            pre = s["tag"] == "pre"
            deep = (F.when((s["kind"] == "o") & pre, acc["deep"] + 1)
                    .when((s["kind"] == "c") & pre, F.greatest(acc["deep"] - 1, v["pre"])).otherwise(acc["deep"]))
            return F.struct(deep.alias("deep"), F.concat(acc["raw"], space, F.when(deep > 0, kept(text)).otherwise(text)).alias("raw"))
        return F.aggregate(steps(v["markup"]), F.struct(v["pre"].alias("deep"), F.lit("").alias("raw")), add, lambda acc: acc["raw"])

    def text(v):
        plain = H.text_of(F.regexp_replace(F.regexp_replace(v["markup"], P.COMMENT_RE, ""), P.SCRIPT_STYLE_RE, ""))
        return F.when((v["pre"] > 0) | F.lower(v["markup"]).contains("<pre"), as_written_text(v)).otherwise(plain)

    def as_written_text(v):
        # as ``normal`` does it; the raw form is a lambda variable here
        raw = F.regexp_replace(one_space(as_written(v)), "([\ufdd0-\ufdd5]) ", "$1")
        return F.regexp_replace(F.translate(raw, _KEPT, _SPACES), f"^{_SPACE}+|{_SPACE}+$", "")

    return H.let(F.struct(markup.alias("markup"), F.when(inside_pre, 1).otherwise(0).alias("pre")), text)


def _markup(flat: Column, e: Column, end: str) -> Column:
    return F.array_join(F.slice(flat, e["at"] + 1, e[end] - e["at"]), "")


def _hit_by(hits: Column, selector: int) -> Column:
    return F.filter(hits, lambda e: F.array_contains(e["sel"], selector))


def _selected_text(flat: Column, hits: Column, selectors: range) -> Column:
    """For each selector in order, each element that it matches adds its text and a space, unless it lies inside an
    element taken before it."""
    def of(acc, e):
        inside = F.exists(acc["taken"], lambda t: (t["at"] <= e["at"]) & (e["runs"] <= t["runs"]) & (t["at"] != e["at"]))
        one = F.struct(e["at"].alias("at"), e["runs"].alias("runs"))
        # what runs on is read on its own: then no pre around it counts
        text = text_of_markup(_markup(flat, e, "runs"), e["pre"] & (e["runs"] == e["until"]))
        return F.when(inside, acc).otherwise(F.struct(F.concat(acc["taken"], F.array(one)).alias("taken"), F.concat(acc["out"], F.array(text)).alias("out")))

    order = F.flatten(F.array(*[_hit_by(hits, i) for i in selectors]))
    zero = F.struct(F.array().cast("array<struct<at:int,runs:int>>").alias("taken"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(order, zero, of, lambda acc: F.trim(F.array_join(acc["out"], " ")))


def _selected_texts(told: Column, hits: Column, selectors: range) -> Column:
    """``_selected_text`` with the told page worked out once, not for each element."""
    return H.let(told, lambda flat: _selected_text(flat, hits, selectors))


def with_dom(pages: DataFrame, *, text: list[str] | None = None, counts: list[str] | None = None, first: list[str] | None = None,
             markdown: bool = False, rules: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``pages`` with the asked columns: ``_text`` (of selected elements), ``_counts`` (elements of each selector),
    ``_first`` (markup of the first match) and ``_markdown`` (of that markup, or of the page)."""
    from sitegraph.operators.markdown import with_markdown
    asked = [*(text or []), *(counts or []), *(first or [])]
    df, source = pages, "html"
    if asked:
        _, masks = _masks(asked)
        df = df.withColumn("_steps", steps(F.col("html")))
        df = df.withColumn("_ops", operations(F.col("_steps"), m=masks))
        df = df.withColumn("_n", F.size("_steps")).withColumn("_found", found(asked, "_ops", "_n"))
        df = df.withColumn("_hits", F.col("_found.hits"))
        df = df.withColumn("_flat", F.flatten(F.transform("_steps", lambda s: F.array(s["mark"], s["text"]))))
        # as text: an end tag that ends nothing puts no space between texts, a block that ends without one does
        df = df.withColumn("_told", F.flatten(F.transform("_steps", lambda s, i: F.array(
            F.concat(F.array_join(F.transform(F.filter("_found.gaps", lambda g: g["i"] == i), lambda g: F.concat(F.lit("</"), g["tag"], F.lit(">"))), ""),
                     F.when(F.array_contains("_found.stray", i), "").otherwise(s["mark"])), s["text"])))).drop("_steps", "_ops", "_n", "_found")
        flat, hits = F.col("_flat"), F.col("_hits")
        at = [0, len(text or []), len(text or []) + len(counts or []), len(asked)]
        if text is not None:
            df = df.withColumn("_text", _selected_texts(F.col("_told"), hits, range(at[0], at[1])))
        if counts is not None:
            df = df.withColumn("_counts", F.array(*[F.size(_hit_by(hits, i)).cast("bigint") for i in range(at[1], at[2])]))
        if first is not None:
            picks = [F.get(_hit_by(hits, i), F.lit(0)) for i in range(at[2], at[3])]
            df = df.withColumn("_pick", F.coalesce(*picks) if picks else F.lit(None)).withColumn(
                "_first", F.when(F.col("_pick").isNotNull(), _markup(flat, F.col("_pick"), "runs")).otherwise(F.coalesce("html", F.lit("")))).drop("_pick")
            source = "_first"
        df = df.drop("_flat", "_told", "_hits")
    else:
        none = {"_text": text is not None and F.lit(""), "_counts": counts is not None and F.array().cast("array<bigint>"),
                "_first": first is not None and F.coalesce("html", F.lit(""))}
        df = df.withColumns({n: c for n, c in none.items() if c is not False})
    return with_markdown(df, source, "_markdown", rules) if markdown else df
