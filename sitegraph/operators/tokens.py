"""Tag lists and the token pattern of the tree and its SQL counterpart."""

from __future__ import annotations

from sitegraph.functions import patterns as P

VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
             "param", "source", "track", "wbr"]
# HTML5 formatting elements: closed with an implicitly closed p, then re-opened
# in the following blocks, so their selected text runs on to their parent's end.
FORMATTING_TAGS = ["a", "b", "big", "code", "em", "font", "i", "nobr", "s", "small", "strike", "strong",
                   "tt", "u"]

_RAW = (r"<script(?:[ \t\n\r\f/][^>]*)?>.*?</script[ \t\n\r\f]*>"
        r"|<style(?:[ \t\n\r\f/][^>]*)?>.*?</style[ \t\n\r\f]*>")
TOKEN_RE_RE2 = r"(?is)<!--.*?-->|" + _RAW + "|" + P.TAG_RE_RE2 + r"|[^<]+|<"
