"""Element trees of single pages, for operators that need nesting.

Counts, links, titles and page text are row-local SQL expressions.  Text of
selected elements, element markup and Markdown depend on which element holds
which, to any depth; that is one pass over the page with a stack of open
elements.  ``with_dom`` runs it on Arrow batches inside the scan's stage: one
page in, the asked columns out, nothing shuffled, and it runs on a stream too.

Tree rules (the part of HTML5 tree building that page stores need):

* void elements have no content; script and style have no text;
* an end tag closes the nearest open element of its name, and what is open
  inside it; without one it is ignored, as are the end tags of html and body;
* li, dt, dd, tr, td, th, option and optgroup end at the next one of their
  kind in the same container, p at the next block, a at the next a;
* other open elements end with the element around them.  Inside a p that ends
  without an end tag, formatting elements end with it in the tree; HTML5
  opens them anew in what follows, so as selected elements they run on to the
  end of the element around the p (``run_end``);
* an unfinished tag is text.
"""

from __future__ import annotations

import html as _html
import re

from sitegraph.functions import patterns as P
from sitegraph.functions import selectors as S
from sitegraph.operators.tokens import FORMATTING_TAGS, VOID_TAGS

_MARK = re.compile(r"<!--.*?-->|<(script|style)(?:[ \t\n\r\f/][^>]*)?>.*?</\1[ \t\n\r\f]*>|" + P.TAG_RE_JAVA, re.S | re.I)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_SPACE = re.compile("[ \t\n\r\f\xa0]+")
_VOID, _FORMATTING, _BLOCK = set(VOID_TAGS), set(FORMATTING_TAGS), set(P.BLOCK_TAGS)
_HEAD = set("base link meta noscript script style template title".split())
_ENDS_P = set("""address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul""".split())
#: Opening one of these ends an open one of the first set, looked for up to the second.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "tbody": ({"thead", "tbody", "tfoot", "tr"}, {"table"}), "tfoot": ({"thead", "tbody", "tr"}, {"table"}),
         "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
         "a": ({"a"}, {"table", "td", "th", "button", "object"})}
_P_SCOPE = {"table", "td", "th", "caption", "button", "object", "#page"}


class Node:
    """An element: ``children`` are texts (references decoded) and elements; [start, end) is its markup."""

    __slots__ = ("tag", "mark", "parent", "children", "start", "end", "run_end", "_running")

    def __init__(self, tag: str, mark: str, parent: Node | None, start: int):
        self.tag, self.mark, self.parent, self.start = tag, mark, parent, start
        self.children: list[str | Node] = []
        self.end = self.run_end = start
        self._running: list[Node] = []

    def attributes(self) -> dict[str, str]:
        """First value of every attribute, references decoded; '' without a value."""
        out: dict[str, str] = {}
        body = self.mark[1 + len(self.tag):-1]
        for m in P.ATTRIBUTE_RE.finditer(body):
            out.setdefault(m[1].lower(), _html.unescape(m[2] or m[3] or m[4] or ""))
        return out

    def elements(self):
        """Elements below this one, in document order."""
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if isinstance(c, Node):
                    yield c
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def inside(self, tag: str) -> bool:
        node = self
        while node is not None and node.tag != tag:
            node = node.parent
        return node is not None


def parse(source: str) -> Node:
    page = node = Node("#page", "", None, 0)

    def pop(n: Node, end: int, after: int) -> Node:
        """Ends the open elements up to ``n``; returns what is open then."""
        nonlocal node
        while True:
            last, node = node, node.parent
            last.end = last.run_end = after if last is n else end
            for r in last._running:
                r.run_end = end
            if last is n:
                return node

    def open_of(tags: set[str], stop: set[str]) -> Node | None:
        n, found = node, None
        while n is not None and n.tag not in stop:
            if n.tag in tags:
                found = n
                break
            n = n.parent
        return found

    def end_p(at: int) -> None:
        p = open_of({"p"}, _P_SCOPE)
        if p is not None:
            running, n = [], node
            while n is not p:
                if n.tag in _FORMATTING:
                    running.append(n)
                n = n.parent
            running += p._running
            p._running = []
            pop(p, at, at)
            node._running += running

    at = 0
    for m in _MARK.finditer(source):
        if m.start() > at:
            node.children.append(_html.unescape(source[at:m.start()]))
        at, mark = m.end(), m[0]
        name = _NAME.match(mark)
        if not name or mark.startswith("<!"):
            continue
        tag = name[1].lower()
        if mark[1] == "/":
            n = open_of({tag}, set()) if tag not in ("html", "body") else None
            if n is not None:
                pop(n, m.start(), m.end())
            continue
        if node.tag == "head" and tag not in _HEAD:
            pop(node, m.start(), m.start())
        if tag in _ENDS_P:
            end_p(m.start())
        if tag in _ENDS:
            n = open_of(*_ENDS[tag])
            if n is not None:
                pop(n, m.start(), m.start())
        new = Node(tag, mark, node, m.start())
        node.children.append(new)
        if tag in _VOID or m[1]:
            new.end = new.run_end = m.end()
        else:
            node = new
    if at < len(source):
        node.children.append(_html.unescape(source[at:]))
    while node is not page:
        pop(node, len(source), len(source))
    page.end = page.run_end = len(source)
    for r in page._running:
        r.run_end = len(source)
    return page


def one_space(text: str) -> str:
    """White space runs as one space; soft hyphens and zero-width spaces gone; not trimmed."""
    return _SPACE.sub(" ", text.replace("\xad", "").replace("\u200b", ""))


def text_of(node: Node) -> str:
    """Text of an element: blocks and br apart by a space, runs of white space one space (kept as written in pre), trimmed."""
    out: list[str] = []
    blank = True

    def add(t: str, as_is: bool) -> None:
        nonlocal blank
        if not as_is:
            t = one_space(t)
            if blank and t.startswith(" "):
                t = t[1:]
        if t:
            out.append(t)
            blank = t[-1].isspace()

    stack = [(node, iter(node.children), node.inside("pre"))]
    while stack:
        n, children, as_is = stack[-1]
        for c in children:
            if isinstance(c, str):
                add(c, as_is)
            elif c.tag not in ("script", "style"):
                if c.tag in _BLOCK:
                    add(" ", False)
                stack.append((c, iter(c.children), as_is or c.tag == "pre"))
                break
        else:
            stack.pop()
            if n.tag in _BLOCK and stack:
                add(" ", False)
    return "".join(out).strip(" \t\n\r\f\xa0")


def matches(node: Node, s: S.Simple) -> bool:
    if s.tag and s.tag != "*" and node.tag != s.tag:
        return False
    if not (s.cls or s.id or s.attr):
        return True
    a = node.attributes()
    return ((not s.cls or s.cls in a.get("class", "").split()) and (not s.id or a.get("id", "") == s.id)
            and (not s.attr or (s.attr in a if s.val is None else a.get(s.attr) == s.val)))


def _chain(node: Node, steps: list[S.Simple]) -> bool:
    if not matches(node, steps[-1]):
        return False
    n = node.parent
    for s in reversed(steps[:-1]):
        while n is not None and not (n.tag != "#page" and matches(n, s)):
            n = n.parent
        if n is None:
            return False
        n = n.parent
    return True


def select(page: Node, chains: list[list[S.Simple]]) -> list[Node]:
    """Elements that match a selector (as ``selectors.parse_chains`` gives it), in document order."""
    return [n for n in page.elements() if any(_chain(n, c) for c in chains)]


def _text_of_selected(source: str, page: Node, chains) -> str:
    taken: list[Node] = []
    out: list[str] = []
    for c in chains:
        for n in select(page, c):
            if not any(t.start <= n.start and n.run_end <= t.run_end and t is not n for t in taken):
                taken.append(n)
                out.append(text_of(n) if n.run_end == n.end else text_of(parse(source[n.start:n.run_end])))
    return " ".join(out).strip(" ")


def first_markup(source: str, page: Node, chains) -> str:
    """Markup of the first element of the first selector that matches, else the whole source."""
    for c in chains:
        for n in select(page, c):
            return source[n.start:n.run_end]
    return source
