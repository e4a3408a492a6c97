"""The CSS selector subset accepted by page operations.

Supported: ``tag``, ``.class``, ``#id``, ``tag.class``, ``tag#id``,
``tag[attr]``, ``tag[attr=value]`` and comma separated lists of these.
A selector becomes a predicate over one start tag string, so matching stays
a row-local array filter.  Anything else raises ``ValueError``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegraph.functions import html as H

_SIMPLE = re.compile(
    r"^(?P<tag>[a-zA-Z][a-zA-Z0-9-]*|\*)?"
    r"(?:\.(?P<cls>[A-Za-z0-9_-]+))?"
    r"(?:#(?P<id>[A-Za-z0-9_-]+))?"
    r"(?:\[(?P<attr>[A-Za-z_:][A-Za-z0-9_:.-]*)(?:=(?P<q>[\"']?)(?P<val>[^\"'\]]*)(?P=q))?\])?$")


@dataclass(frozen=True)
class Simple:
    tag: str | None
    cls: str | None
    id: str | None
    attr: str | None
    val: str | None

    @property
    def tag_names(self) -> str:
        """Regex alternation of element names this selector can match."""
        return self.tag if self.tag and self.tag != "*" else "[a-zA-Z][a-zA-Z0-9:-]*"

    @property
    def tag_only(self) -> bool:
        return bool(self.tag) and self.tag != "*" and not (self.cls or self.id or self.attr)


def _simple(part: str, selector: str) -> Simple:
    m = _SIMPLE.match(part)
    if not part or not m or not any(m.group(g) for g in ("tag", "cls", "id", "attr")):
        raise ValueError(f"unsupported selector: {selector!r}")
    return Simple((m.group("tag") or "").lower() or None, m.group("cls"), m.group("id"),
                  (m.group("attr") or "").lower() or None, m.group("val"))


def parse_chains(selector: str) -> list[list[Simple]]:
    """Selector list -> descendant chains (``article p`` -> [article, p])."""
    if ">" in selector or "+" in selector or "~" in selector:
        raise ValueError(f"unsupported selector (only descendant combinators): {selector!r}")
    chains = []
    for part in selector.split(","):
        steps = part.split()
        if not steps:
            raise ValueError(f"unsupported selector: {selector!r}")
        chains.append([_simple(x, selector) for x in steps])
    return chains


def has_descendant(selector: str) -> bool:
    return any(len(c) > 1 for c in parse_chains(selector))


def parse(selector: str) -> list[Simple]:
    """Split a selector list of compound selectors (no descendant steps)."""
    chains = parse_chains(selector)
    if any(len(c) > 1 for c in chains):
        raise ValueError(f"descendant selector needs element spans: {selector!r}")
    return [c[0] for c in chains]


def predicate(s: Simple, tag: Column, name: Column | None = None) -> Column:
    """Does start tag string ``tag`` match simple selector ``s``?  ``name``: the tag's name, if it is known."""
    cond = F.lit(True)
    if s.tag and s.tag != "*":
        cond = cond & ((H.tag_name(tag) if name is None else name) == s.tag)
    if s.cls:
        cls = F.coalesce(H.attr(tag, "class"), F.lit(""))
        cond = cond & F.array_contains(F.split(F.trim(cls), r"[ \t\n\r\f]+"), s.cls)
    if s.id:
        cond = cond & (F.coalesce(H.attr(tag, "id"), F.lit("")) == s.id)
    if s.attr:
        v = H.attr(tag, s.attr)
        cond = cond & (v.isNotNull() if s.val is None else (v == s.val))
    return cond


def element_count(clean: Column, selector: str) -> Column:
    """Number of elements matching ``selector`` (each element once)."""
    simple = parse(selector)
    if all(s.tag_only for s in simple):
        names = "|".join(sorted({s.tag for s in simple}))
        return F.size(H.start_tags(clean, names)).cast("bigint")
    names = "|".join(sorted({s.tag_names for s in simple}))
    tags = H.start_tags(clean, names)

    def any_match(t):
        c = F.lit(False)
        for s in simple:
            c = c | predicate(s, t)
        return c

    return F.size(F.filter(tags, any_match)).cast("bigint")
