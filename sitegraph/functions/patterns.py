"""Regular expressions and fixed value tables shared by the Spark plans and
the DuckDB oracle.

Spark evaluates patterns with java.util.regex, DuckDB with RE2.  Patterns are
written in the common subset (classes, alternation, lazy quantifiers, the
``(?i)``/``(?s)`` flags; no look-around, no back-references).  Where Java
could backtrack badly on a pattern, the Java form uses possessive
quantifiers; the alternatives are mutually exclusive on their first
character, so the possessive and the plain (RE2) forms match the same text.
"""

from __future__ import annotations

import re

WS = r"[ \t\n\r\f]"

# Comments, script and style blocks.  Comments vanish; script and style are
# block elements and leave a separator.
COMMENT_RE = r"(?s)<!--.*?-->"
SCRIPT_STYLE_RE = (r"(?is)<script(?:[ \t\n\r\f/][^>]*)?>.*?</script[ \t\n\r\f]*>"
                   r"|<style(?:[ \t\n\r\f/][^>]*)?>.*?</style[ \t\n\r\f]*>")

# Body of a tag after its name: attributes, quote aware.
_ATTRS_JAVA = r"""(?:[ \t\n\r\f/](?:[^>"']++|"[^"]*+"|'[^']*+')*+)?"""
_ATTRS_RE2 = r"""(?:[ \t\n\r\f/](?:[^>"']+|"[^"]*"|'[^']*')*)?"""

# Any markup token: element tags, end tags, doctype, processing instructions.
TAG_RE_JAVA = r"""<[a-zA-Z/!?](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
TAG_RE_RE2 = r"""<[a-zA-Z/!?](?:[^>"']+|"[^"]*"|'[^']*')*>"""


def open_tag_re(names: str, java: bool = True) -> str:
    """Start tag of one of ``names`` (a regex alternation of tag names)."""
    return r"(?i)<(?:" + names + ")" + (_ATTRS_JAVA if java else _ATTRS_RE2) + ">"


def any_tag_re(names: str, java: bool = True) -> str:
    """Start or end tag of one of ``names``."""
    return r"(?i)</?(?:" + names + ")" + (_ATTRS_JAVA if java else _ATTRS_RE2) + ">"


_WS = r"[ \t\n\r\f]"
_ONE_ATTR = _WS[:-1] + r"/]+[^ \t\n\r\f/>\"'=]+(?:" + _WS + "*=" + _WS + r"""*(?:"[^"]*"|'[^']*'|[^ \t\n\r\f>"'][^ \t\n\r\f>]*))?"""


def attr_re(name: str) -> str:
    """Attribute ``name`` of one tag, read from the tag's start attribute by
    attribute (text inside another value never counts; the first of several
    wins).  Groups 1-3 hold the double quoted, single quoted or bare value; a
    valueless attribute matches with all three groups empty."""
    return (r"(?i)^<[a-zA-Z][^ \t\n\r\f/>]*(?:" + _ONE_ATTR + ")*?" + _WS[:-1] + "/]+" + name + "(?:" + _WS + "*=" + _WS
            + r"""*(?:"([^"]*)"|'([^']*)'|([^ \t\n\r\f>"'][^ \t\n\r\f>]*))|""" + _WS + r"*[ \t\n\r\f/>])")


# One attribute of a tag, from left to right: name, then the double quoted,
# single quoted or bare value, if any.
ATTRIBUTE_RE = re.compile(r"""([^ \t\n\r\f/>"'=]+)(?:[ \t\n\r\f]*=[ \t\n\r\f]*(?:"([^"]*)"|'([^']*)'|([^ \t\n\r\f>"']+)))?""")


# Character references: named (with or without ';'), decimal, hexadecimal.
ENTITY_CHUNK_RE = r"&(?:#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[a-zA-Z][a-zA-Z0-9]*;?)|[^&]+|&"

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference's behaviour for equal results.
# ---------------------------------------------------------------------------

# HTML block-level tags (text extraction puts a separator at their edges;
# <br> does too).  Inline and unknown tags add nothing.
BLOCK_TAGS = (
    "address article aside audio blockquote body br canvas caption center col colgroup dd "
    "del details dialog dir div dl dt fieldset figcaption figure footer form frame frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe ins legend li link listing main "
    "menu meta nav noframes noscript ol optgroup option p plaintext pre section summary "
    "table tbody td template tfoot th thead title tr ul video"
).split()

# Named character references, from the standard library's tables: the HTML 4
# set with &apos; and the names accepted without ';' ...
def entity_table() -> dict[str, str]:
    """Reference text -> decoded text, for every accepted spelling of an HTML 4 name."""
    from html.entities import html5, name2codepoint
    t = {f"&{name};": chr(cp) for name, cp in name2codepoint.items()}
    t["&apos;"] = "'"
    for k, v in html5.items():
        if not k.endswith(";") and k in name2codepoint:
            t["&" + k] = v
    return t


# ... and the whole HTML 5 table.
def all_entities() -> dict[str, str]:
    from html.entities import html5
    return {"&" + k: v for k, v in html5.items()}


# Elements counted by default in page statistics (no h6).
DEFAULT_COUNT_TAGS = ["div", "p", "h1", "h2", "h3", "h4", "h5"]

# File extensions that make a link a document link.
DOCUMENT_EXTENSIONS = ["pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "zip", "rar"]

# File extension -> MIME type; anything else is application/octet-stream.
MIME_TYPES = {
    "jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif",
    "bmp": "image/bmp", "webp": "image/webp", "svg": "image/svg+xml",
    "pdf": "application/pdf", "txt": "text/plain", "html": "text/html",
    "xml": "application/xml", "json": "application/json", "mp4": "video/mp4",
    "mp3": "audio/mpeg", "wav": "audio/wav", "zip": "application/zip",
    "rar": "application/vnd.rar", "7z": "application/x-7z-compressed",
}
DEFAULT_MIME = "application/octet-stream"

# Characters a URL component encoder leaves (or restores) unescaped.
URL_PRESERVED = "/:@$,;()~!'*-._"

# Default URL pattern list of the crawl options (a tag-manager script).
DEFAULT_URL_PATTERNS = [r"https://www\.googletagmanager\.com/.*"]

SITEMAP_HEADER = ('<?xml version="1.0" encoding="UTF-8"?>\n'
                  '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n')
SITEMAP_FOOTER = "</urlset>"
