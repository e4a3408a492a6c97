"""HTML -> Markdown, page by page, as one row expression.

The fold of ``dom`` with a frame per open element: what its content gives is written
into the frame as it comes, and when an element ends, its frame becomes Markdown and is
written into the one below.  The rules are a table from tag to what goes before and after the
content; lists, tables, quotes, links, images and code have a form of their own.  ``rules``
replaces the converter of any tag by a prefix and a suffix.  Only elements inside ``<body>``
count (bare text directly in body is dropped), nothing below depth 100 is written, tags
without a converter pass their content through, and runs of three or more line breaks
become two.

A frame keeps its text in pieces of some thousand characters, so a long element costs its
length, not its length times the number of its parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegraph.functions import html as H
from sitegraph.functions import patterns as P
from sitegraph.operators import dom
from sitegraph.operators.dom import bind, sql_list

# Markdown produced before and after the content of elements.
RULES: dict[str, tuple[str, str]] = {
    "h1": ("# ", "\n\n"), "h2": ("## ", "\n\n"), "h3": ("### ", "\n\n"),
    "h4": ("#### ", "\n\n"), "h5": ("##### ", "\n\n"), "h6": ("###### ", "\n\n"),
    "p": ("", "\n\n"), "strong": ("**", "**"), "b": ("**", "**"),
    "em": ("*", "*"), "i": ("*", "*"), "div": ("", "\n\n"),
    "span": ("", ""), "li": ("", ""),
}
VOID_RULES: dict[str, str] = {"br": "\n", "hr": "---\n"}
MAX_DEPTH = 100
#: Runs of white space with three or more line breaks end as two.
NEWLINES_RE = r"(?:[ \t\n\x0B\f\r]*\n){3,}"
_BREAKS = r"(?:[ \t\x0B\f\r]*+\n){3,}+"
_OUTSIDE = 1000
#: Frames whose content is written in a way of their own.
_MODES = {"ul": "list", "ol": "ol", "blockquote": "quote", "pre": "pre", "table": "table", "code": "code"}
_NOT_IN_BODY = ["head", "title", "meta", "link", "base"]
#: Characters of a frame's last piece.
_PIECE = 4096


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def _written(f: str, piece: str, more: dict[str, str]) -> str:
    """Frame ``f`` with a piece of Markdown behind its own, and other fields changed."""
    long = f"length({f}.md) + length(w) > {_PIECE}"
    fields = {n: f"{f}.{n}" for n in _FRAME} | more
    fields |= {"md": f"if({long}, '', concat({f}.md, w))", "mdb": f"if({long}, concat({f}.mdb, array(concat({f}.md, w))), {f}.mdb)"}
    return bind("w", piece, "named_struct(" + ", ".join(f"'{n}', {fields[n]}" for n in _FRAME) + ")")


_CELLS = "array<struct<at:int,th:boolean,s:string>>"
_ROWS = f"array<struct<at:int,cells:{_CELLS}>>"
_FRAME = ["tag", "mode", "depth", "pre", "raws", "tab", "at", "n", "md", "mdb", "raw", "lang", "body", "cells", "rows", "a", "b"]


def _attached(f: str, c: str) -> str:
    """Frame ``f`` with what its child ``c`` has become."""
    li = f"{c}.tag = 'li'"
    out = f"coalesce({c}.out, concat('`', {dom.normal(c + '.raw')}, '`'))"  # only code without a rule has none: a pre wants its text alone
    quoted = bind("out", out, bind("ends", "trim(TRAILING '\\n' FROM out)", """CASE WHEN out = '' THEN '> \\n' WHEN ends = '' THEN ''
        ELSE concat('> ', replace(ends, '\\n', '\\n> '), '\\n') END"""))
    piece = f"""CASE {f}.mode WHEN 'plain' THEN {out} WHEN 'list' THEN if({li}, concat('* ', {c}.inside, '\\n'), '')
        WHEN 'ol' THEN if({li}, concat({f}.n + 1, '. ', {c}.inside, '\\n'), '') WHEN 'quote' THEN {quoted}
        WHEN 'pre' THEN {dom.normal(c + '.raw')} WHEN 'body' THEN if({c}.tag IN ({sql_list(_NOT_IN_BODY)}), '', {out}) ELSE '' END"""
    cell = f"""if({c}.tag IN ('td', 'th'), array(named_struct('at', {c}.at, 'th', {c}.tag = 'th', 's', {c}.inside)), cast(array() AS {_CELLS}))"""
    row = f"if({c}.tag = 'tr', array(named_struct('at', {c}.at, 'cells', {c}.cells)), cast(array() AS {_ROWS}))"
    return _written(f, piece, {
        "n": f"{f}.n + if({f}.mode = 'ol' AND {li}, 1, 0)", "raw": f"if({f}.raws, concat({f}.raw, {c}.raw), {f}.raw)",
        "lang": f"coalesce({f}.lang, if({c}.tag = 'code', {c}.b, NULL), {c}.lang)", "body": f"coalesce({f}.body, {c}.body)",
        "cells": f"if({f}.tab, concat({f}.cells, {c}.cells, {cell}), {f}.cells)",
        "rows": f"if({f}.tab, concat({f}.rows, {c}.rows, {row}), {f}.rows)"})


def _finished(f: str, rules: dict[str, tuple[str, str]]) -> str:
    """What a frame becomes when its element ends."""
    def around(tag, before, after):
        return f"WHEN {f}.tag = '{tag}' THEN concat({_text(before)}, inside, {_text(after)})"

    def line(cells: str) -> str:
        return f"concat(array_join(transform({cells}, c -> c.s), ' | '), '\\n')"
    sorted_cells = "array_sort(r.cells)"
    table = bind("rows", f"transform(array_sort({f}.rows), r -> {sorted_cells})", f"""CASE WHEN size(rows) = 0 THEN '' ELSE concat(
        if(size(rows[0]) > 0, concat({line('rows[0]')}, array_join(transform(rows[0], c -> '---'), ' | '), '\\n'), ''),
        array_join(transform(slice(rows, if(size(rows[0]) > 0, 2, 1), size(rows)), r -> {line('filter(r, c -> NOT c.th)')}), ''), '\\n') END""")
    blocks = sql_list(P.BLOCK_TAGS)
    out = f"""CASE WHEN {f}.depth > {MAX_DEPTH} OR {f}.tag IN ('script', 'style') THEN ''
        {" ".join(around(t, *r) for t, r in rules.items())}
        WHEN {f}.tag IN ('ul', 'ol', 'blockquote') THEN concat(inside, '\\n')
        WHEN {f}.tag = 'table' THEN if({f}.depth > 1, {dom.normal(f + '.raw')}, {table})
        WHEN {f}.tag = 'a' THEN if({f}.a <> '', concat('[', inside, '](', {f}.a, ')'), inside)
        WHEN {f}.tag = 'img' THEN if({f}.a <> '', concat('![', coalesce({f}.b, ''), '](', {f}.a, ')'), '')
        WHEN {f}.tag = 'pre' THEN concat('```', coalesce({f}.b, {f}.lang, ''), '\\n', inside, '\\n```\\n\\n')
        WHEN {f}.tag = 'code' THEN cast(NULL AS string)
        {" ".join(f"WHEN {f}.tag = '{t}' THEN {_text(o)}" for t, o in VOID_RULES.items())}
        {" ".join(around(t, *r) for t, r in RULES.items())} ELSE inside END"""
    raw = f"CASE WHEN {f}.tag IN ('script', 'style') THEN '' WHEN {f}.tag IN ({blocks}) THEN concat(' ', {f}.raw, ' ') ELSE {f}.raw END"
    return bind("inside", f"concat(array_join({f}.mdb, ''), {f}.md)", f"""named_struct('tag', {f}.tag, 'at', {f}.at, 'inside', inside,
        'out', {out}, 'raw', {raw}, 'lang', {f}.lang, 'body', if({f}.depth = 0, inside, {f}.body), 'cells', {f}.cells, 'rows', {f}.rows, 'b', {f}.b)""")


_CHILD = (f"struct<tag:string,at:int,inside:string,out:string,raw:string,lang:string,body:string,cells:{_CELLS},rows:{_ROWS},b:string>")


def _fold(ops: str, n_body: str, rules: dict[str, tuple[str, str]]) -> str:
    """SQL of the Markdown of operations ``ops``; ``n_body``: the step that opens the body, -1 without one."""
    plain = f"x.tag IN ({sql_list(rules)})" if rules else "false"
    mode = " ".join(f"WHEN x.tag = '{t}' THEN '{m}'" for t, m in _MODES.items())
    frame = {
        "tag": "x.tag", "mode": f"CASE WHEN o THEN 'body' WHEN {plain} THEN 'plain' {mode} ELSE 'plain' END", "depth": "d", "pre": "p.pre OR x.tag = 'pre'",
        "raws": "p.raws OR x.tag IN ('pre', 'code', 'table')", "tab": f"p.tab OR (x.tag = 'table' AND d = 1 AND NOT ({plain}))", "at": "x.i", "n": "0",
        "md": "''", "mdb": "cast(array() AS array<string>)", "raw": "''", "lang": "cast(NULL AS string)", "body": "cast(NULL AS string)",
        "cells": f"cast(array() AS {_CELLS})", "rows": f"cast(array() AS {_ROWS})", "a": "x.a", "b": "x.b"}
    opens = bind("p", "element_at(t, -1)", bind("o", f"if({n_body} >= 0, x.i = {n_body}, x.tag = 'html' AND size(t) = 1)", bind(
        "d", f"""CASE WHEN o THEN 0 WHEN p.depth >= {_OUTSIDE} THEN p.depth WHEN p.mode IN ('list', 'ol') AND x.tag = 'li' THEN p.depth
                 WHEN p.tab AND x.tag IN ('td', 'th') THEN 1 ELSE p.depth + 1 END""",
        "concat(t, array(named_struct(" + ", ".join(f"'{n}', {frame[n]}" for n in _FRAME) + ")))")))
    # frames that end, from the top one down: each takes in the one above it
    ended = bind("g", f"if(c IS NULL, f, {_attached('f', 'c')})", _finished("g", rules))
    child = f"aggregate(reverse(slice(s, k, size(s) - k + 1)), cast(NULL AS {_CHILD}), (c, f) -> {ended})"
    closes = bind("k", dom.CLOSES, "if(k = 0, s, " + bind("c", child, f"concat(slice(s, 1, k - 2), array({_attached('s[k - 2]', 'c')}))") + ")")
    one = dom.one_space_sql("x.text")
    piece = f"""CASE e.mode WHEN 'plain' THEN {one} WHEN 'pre' THEN {one} WHEN 'quote' THEN concat('> ', trim({one}), '\\n') ELSE '' END"""
    text = bind("e", "element_at(u, -1)", f"""concat(slice(u, 1, size(u) - 1), array({_written('e', piece, {
        "raw": f"if(e.raws, concat(e.raw, if(e.pre, {dom.kept_sql('x.text')}, x.text)), e.raw)"})}))""")
    step = bind("t", closes, bind("u", f"if(x.kind = 'o', {opens}, t)", f"if(x.main AND x.text <> '', {text}, u)"))
    page = dict(frame, tag="'#page'", mode=f"if({n_body} >= 0, 'plain', 'body')", depth=f"if({n_body} >= 0, {_OUTSIDE}, 0)", pre="false", raws="false",
                tab="false", at="-1", a="cast(NULL AS string)", b="cast(NULL AS string)")
    zero = "array(named_struct(" + ", ".join(f"'{n}', {page[n]}" for n in _FRAME) + "))"
    done = "coalesce(s[0].body, if(s[0].depth = 0, concat(array_join(s[0].mdb, ''), s[0].md), ''))"
    return f"aggregate({ops}, {zero}, (s, x) -> {step}, s -> {done})"


def _fields(s: Column) -> list[Column]:
    """Of a step: its text, decoded; that with white space collapsed, and kept; what its tag's attributes give."""
    text = F.when(s["text"] == "", "").otherwise(H.decode_entities(s["text"]))
    classes = F.coalesce(H.attr(s["mark"], "class"), F.lit(""))
    # only this very class turns to the class text
    named = F.array_contains(F.split(F.lower(classes), r"[ \t\n\x0B\f\r]+"), "language-")
    behind = F.regexp_extract(F.substr(classes, F.instr(classes, "language-") + 9), r"^[^ \t\n\x0B\f\r]*", 0)
    starts = s["kind"].isin("o", "v")
    a = F.when(starts & (s["tag"] == "a"), H.attr(s["mark"], "href")).when(starts & (s["tag"] == "img"), H.attr(s["mark"], "src"))
    b = (F.when(starts & (s["tag"] == "img"), H.attr(s["mark"], "alt")).when(starts & (s["tag"] == "code"), H.attr(s["mark"], "data-language"))
         .when(starts & (s["tag"] == "pre"), F.when(named, behind)))
    return [F.struct(s["mark"], s["tag"], s["kind"], text.alias("text"), a.alias("a"), b.alias("b"))]


def with_markdown(df: DataFrame, source: str, out: str, rules: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``df`` with the Markdown of the markup in column ``source`` as column ``out``."""
    d = df.withColumn("_md_steps", F.transform(dom.steps(F.col(source)), lambda s: _fields(s)[0]))
    opened = F.transform(F.col("_md_steps"), lambda s, i: F.when((s["kind"] == "o") & (s["tag"] == "body"), i))
    d = d.withColumn("_md_body", F.coalesce(F.array_min(opened), F.lit(-1)))
    d = d.withColumn("_md_ops", dom.operations(F.col("_md_steps"), text=lambda s: s["text"], a=lambda s: s["a"], b=lambda s: s["b"]))
    d = d.withColumn(out, F.expr(_fold("_md_ops", "_md_body", rules or {})))
    return d.withColumn(out, F.regexp_replace(out, _BREAKS, "\n\n")).drop("_md_steps", "_md_ops", "_md_body")


def markdown(pages_df: DataFrame, rules: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``page_id, markdown`` from ``page_id, html``; ``rules`` replaces converters by (prefix, suffix)."""
    return with_markdown(pages_df.select("page_id", "html"), "html", "markdown", rules).select("page_id", "markdown")
