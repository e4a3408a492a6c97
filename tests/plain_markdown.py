"""HTML -> Markdown, page by page.

The converters below are a table from tag to function; a converter gets the
element and its depth and renders children through ``_render``, which yields
nothing below depth 100.  ``rules`` replaces the converter of any tag by a
prefix and a suffix around its content.  Only elements inside ``<body>`` count
(bare text directly in body is dropped), tags without a converter pass their
content through, and runs of three or more line breaks become two.
"""

from __future__ import annotations

import re

import plain_dom as dom
from plain_dom import Node

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
NEWLINES_RE = r"(?:[ \t\n\x0B\f\r]*\n){3,}"
_BREAKS = re.compile("[ \t\n\x0b\f\r]+")


def _inside(e: Node, depth: int, rules) -> str:
    return "".join(dom.one_space(c) if isinstance(c, str) else _render(c, depth + 1, rules) for c in e.children)


def _lines(text: str) -> list[str]:
    """Lines without empty ones at the end; the empty text is one line."""
    return text.rstrip("\n").split("\n") if text.strip("\n") or not text else []


def _list(e: Node, depth: int, rules) -> str:
    items = [c for c in e.children if isinstance(c, Node) and c.tag == "li"]
    marks = (f"{i}. " for i in range(1, len(items) + 1)) if e.tag == "ol" else ("* " for _ in items)
    return "".join(f"{m}{_inside(li, depth, rules)}\n" for m, li in zip(marks, items)) + "\n"


def _table(e: Node, depth: int, rules) -> str:
    if depth > 1:
        return dom.text_of(e)
    rows = [n for n in e.elements() if n.tag == "tr"]
    if not rows:
        return ""

    def cells(row: Node, tags: tuple[str, ...]) -> list[str]:
        return [_inside(n, depth, rules) for n in row.elements() if n.tag in tags]

    head = cells(rows[0], ("th", "td"))
    lines = [" | ".join(head), " | ".join(["---"] * len(head))] if head else []
    lines += [" | ".join(cells(r, ("td",))) for r in rows[bool(head):]]
    return "".join(f"{x}\n" for x in lines) + "\n"


def _quote(e: Node, depth: int, rules) -> str:
    out = []
    for c in e.children:
        if isinstance(c, str):
            out += [x.strip() for x in _lines(dom.one_space(c))]
        else:
            out += _lines(_render(c, depth + 1, rules))
    return "".join(f"> {x}\n" for x in out) + "\n"


def _link(e: Node, depth: int, rules) -> str:
    href, content = e.attributes().get("href", ""), _inside(e, depth, rules)
    return f"[{content}]({href})" if href else content


def _image(e: Node, depth: int, rules) -> str:
    a = e.attributes()
    return f"![{a.get('alt', '')}]({a['src']})" if a.get("src") else ""


def _fence(e: Node, depth: int, rules) -> str:
    classes = e.attributes().get("class", "")
    if "language-" in classes.lower().split():  # only this very class turns to the class text
        language = re.split(r"[ \t\n\x0b\f\r]+", classes[classes.find("language-") + 9:])[0]
    else:
        language = next((n.attributes()["data-language"] for n in e.elements()
                         if n.tag == "code" and "data-language" in n.attributes()), "")
    body = "".join(dom.one_space(c) if isinstance(c, str) else dom.text_of(c) for c in e.children)
    return f"```{language}\n{body}\n```\n\n"


CONVERTERS = {"ul": _list, "ol": _list, "table": _table, "blockquote": _quote, "a": _link, "img": _image, "pre": _fence,
              "code": lambda e, depth, rules: f"`{dom.text_of(e)}`",
              **{tag: (lambda e, depth, rules, out=out: out) for tag, out in VOID_RULES.items()}}


def _render(e: Node, depth: int, rules: dict[str, tuple[str, str]]) -> str:
    if depth > MAX_DEPTH or e.tag in ("script", "style"):
        return ""
    if e.tag in rules:
        before, after = rules[e.tag]
        return before + _inside(e, depth, rules) + after
    if e.tag in CONVERTERS:
        return CONVERTERS[e.tag](e, depth, rules)
    before, after = RULES.get(e.tag, ("", ""))
    return before + _inside(e, depth, rules) + after


def _body(page: Node) -> list[Node]:
    """Elements directly in body, or what a page without a body tag has in its place."""
    body = next((n for n in page.elements() if n.tag == "body"), None)
    if body is None:
        body = next((c for c in page.children if isinstance(c, Node) and c.tag == "html"), page)
    return [c for c in body.children if isinstance(c, Node) and c.tag not in ("head", "title", "meta", "link", "base")]


def _two_breaks(text: str) -> str:
    """Runs of white space with three or more line breaks end as two."""
    return _BREAKS.sub(lambda m: "\n\n" + m[0][m[0].rindex("\n") + 1:] if m[0].count("\n") > 2 else m[0], text)


def convert(page: Node, rules: dict[str, tuple[str, str]] | None = None) -> str:
    """Markdown of one parsed page."""
    return _two_breaks("".join(_render(e, 1, rules or {}) for e in _body(page)))
