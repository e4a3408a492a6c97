"""Row-local HTML expressions.

Each function maps Columns to a Column and runs inside the scan's
whole-stage stage: no page is ever parsed into a tree, nothing is shuffled.
A page's markup is read with regular expressions over the ``html`` string:

* ``clean_html`` removes comments and replaces script/style blocks by a
  separator (their text is never page text);
* tags are matched quote-aware, so ``>`` inside an attribute value is safe;
* text is what remains after tags are removed (block tags leave a space,
  inline tags nothing), with character references decoded and white space
  collapsed.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegraph.functions import patterns as P

_NBSP_WS = "[ \t\n\r\f\u00a0]+"
_INVISIBLE = "[\u00ad\u200b]"


def _lit(x) -> Column:
    return F.lit(x)


def let(value: Column, f) -> Column:
    """``f(value)`` with the value worked out once: a lambda variable, which the optimizer does not copy into its uses."""
    return F.transform(F.array(value), f)[0]


def clean_html(html: Column) -> Column:
    """Markup without comments; script and style blocks become one space."""
    no_comments = F.regexp_replace(html, P.COMMENT_RE, "")
    return F.regexp_replace(no_comments, P.SCRIPT_STYLE_RE, " ")


def _numeric_ref(c: Column) -> Column:
    """Character of a numeric reference, in any plane; NULL for none (0, surrogates, beyond U+10FFFF)."""
    dec = F.regexp_extract(c, r"^&#([0-9]{1,7})", 1)
    hexd = F.regexp_extract(c, r"^&#[xX]([0-9a-fA-F]{1,6})", 1)
    cp = (F.when(dec != "", dec.try_cast("bigint"))
          .when(hexd != "", F.conv(hexd, 16, 10).try_cast("bigint")))
    ok = (cp > 0) & (cp <= 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
    return F.when(ok, F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32"))


def _sql_lit(s: str) -> str:
    return "'" + "".join(f"\\u{ord(ch):04x}" if ord(ch) < 0x10000 else f"\\U{ord(ch):08x}" for ch in s) + "'"


@functools.lru_cache(maxsize=None)
def _entity_text_sql() -> str:
    """The whole entity table as one string literal, U+0001 name U+0002 text, common names first.

    A string stays cheap for the planner however often it is used; a map
    literal of this size is hashed entry by entry at every use."""
    table = P.all_entities()
    common = ["&amp;", "&lt;", "&gt;", "&quot;", "&nbsp;", "&apos;", *sorted(P.entity_table())]
    names = dict.fromkeys([*common, *sorted(table)])
    return _sql_lit("".join(f"\u0001{n}\u0002{table[n]}" for n in names) + "\u0001")


def _named_ref(c: Column) -> Column:
    def look_up(table):
        at = F.position(F.concat(F.lit("\u0001"), c, F.lit("\u0002")), table)
        return F.when(at > 0, F.substring_index(F.substr(table, at + F.length(c) + 2), "\u0001", 1))

    return let(F.expr(_entity_text_sql()), look_up)


def decode_entities(s: Column) -> Column:
    """Decode character references in one pass (no double decoding)."""
    def decode(text):
        chunks = F.regexp_extract_all(text, _lit(P.ENTITY_CHUNK_RE), 0)
        decoded = F.transform(
            chunks, lambda c: F.when(c.startswith("&") & (F.length(c) > 1),
                                     F.coalesce(_numeric_ref(c), _named_ref(c), c)).otherwise(c))
        return F.when(text.contains("&"), F.array_join(decoded, "")).otherwise(text)

    return let(s, decode)


def normalize_ws(s: Column) -> Column:
    """Collapse white space runs (including no-break space) to one space; trim."""
    s = F.regexp_replace(s, _INVISIBLE, "")
    return F.trim(F.regexp_replace(s, _NBSP_WS, " "))


def strip_tags(fragment: Column) -> Column:
    """Raw text of a markup fragment: block tags -> ' ', other tags -> ''."""
    blocks = "|".join(P.BLOCK_TAGS)
    spaced = F.regexp_replace(fragment, P.any_tag_re(blocks), " ")
    return F.regexp_replace(spaced, P.TAG_RE_JAVA, "")


def text_of(fragment: Column) -> Column:
    """Normalised text of a cleaned markup fragment."""
    return normalize_ws(decode_entities(strip_tags(fragment)))


def title_of(clean: Column) -> Column:
    """Text of the first <title> element, or '' when there is none."""
    raw = F.regexp_extract(clean, r"(?is)<title(?:[ \t\n\r\f/][^>]*)?>(.*?)</title", 1)
    return normalize_ws(decode_entities(raw))


def word_count(text: Column) -> Column:
    """Number of white-space separated words; 0 for blank text."""
    t = F.trim(text)
    return F.when(t == "", F.lit(0).cast("bigint")).otherwise(
        F.size(F.split(t, r"[ \t\n\r\f]+")).cast("bigint"))


def start_tags(clean: Column, names: str) -> Column:
    """Array of the start tags named ``names`` (regex alternation), in order."""
    return F.regexp_extract_all(clean, _lit(P.open_tag_re(names)), 0)


def attr(tag: Column, name: str) -> Column:
    """Entity-decoded value of attribute ``name`` of one tag; NULL if absent."""
    pat = P.attr_re(name)
    other = F.concat(F.regexp_extract(tag, pat, 2), F.regexp_extract(tag, pat, 3))
    # most values are double quoted: then the tag is read once
    val = let(F.regexp_extract(tag, pat, 1), lambda q: F.when(q != "", q).otherwise(F.when(tag.rlike(pat), other)))
    return decode_entities(val)


def tag_name(tag: Column) -> Column:
    """Lower-case element name of a start or end tag."""
    return F.lower(F.regexp_extract(tag, r"^</?([a-zA-Z][a-zA-Z0-9:-]*)", 1))
