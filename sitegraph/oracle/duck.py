"""DuckDB SQL twins of the Column expressions, used only to write the
oracle queries (``oracle_sql`` in ``__spark_entry__.py``).  They share the value
tables and RE2 patterns of ``patterns``, so they check the plans, not those
rules; the goldens in ``tests/`` check the rules.

Every function takes SQL expression text and returns SQL expression text.
Regular expressions are the RE2 forms from ``patterns``.
"""

from __future__ import annotations

from sitegraph.functions import patterns as P


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx_replace(s: str, pat: str, rep: str) -> str:
    return f"regexp_replace({s}, {q(pat)}, {q(rep)}, 'g')"


def rx_extract(s: str, pat: str, g: int = 0) -> str:
    return f"regexp_extract({s}, {q(pat)}, {g})"


def rx_match(s: str, pat: str) -> str:
    return f"regexp_matches({s}, {q(pat)})"


# --------------------------------------------------------------------- html

def clean_html(h: str) -> str:
    return rx_replace(rx_replace(h, P.COMMENT_RE, ""), P.SCRIPT_STYLE_RE, " ")


def _numeric_ref(c: str) -> str:
    dec = rx_extract(c, r"^&#([0-9]{1,7})", 1)
    hexd = rx_extract(c, r"^&#[xX]([0-9a-fA-F]{1,6})", 1)
    cp = (f"(CASE WHEN {dec} <> '' THEN try_cast({dec} AS BIGINT) "
          f"WHEN {hexd} <> '' THEN try_cast('0x' || {hexd} AS BIGINT) END)")
    return (f"(CASE WHEN {cp} > 0 AND {cp} < 55296 THEN chr({cp}::INTEGER) "
            f"WHEN {cp} >= 57344 AND {cp} <= 1114111 THEN chr({cp}::INTEGER) END)")


def decode_entities(s: str) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in sorted(P.entity_table().items()))
    lam = (f"lambda c: CASE WHEN starts_with(c, '&') AND length(c) > 1 THEN "
           f"coalesce(CASE c {cases} END, {_numeric_ref('c')}, c) ELSE c END")
    return (f"(CASE WHEN contains({s}, '&') THEN array_to_string(list_transform("
            f"regexp_extract_all({s}, {q(P.ENTITY_CHUNK_RE)}, 0), {lam}), '') ELSE {s} END)")


def normalize_ws(s: str) -> str:
    return f"trim({rx_replace(rx_replace(s, '[\u00ad\u200b]', ''), '[ \t\n\r\f\u00a0]+', ' ')})"


def strip_tags(s: str) -> str:
    blocks = "|".join(P.BLOCK_TAGS)
    return rx_replace(rx_replace(s, P.any_tag_re(blocks, java=False), " "), P.TAG_RE_RE2, "")


def text_of(s: str) -> str:
    return normalize_ws(decode_entities(strip_tags(s)))


def title_of(clean: str) -> str:
    raw = rx_extract(clean, r"(?is)<title(?:[ \t\n\r\f/][^>]*)?>(.*?)</title", 1)
    return normalize_ws(decode_entities(raw))


def word_count(t: str) -> str:
    return (f"(CASE WHEN trim({t}) = '' THEN 0::BIGINT "
            f"ELSE len(string_split_regex(trim({t}), '[ \t\n\r\f]+'))::BIGINT END)")


def start_tags(clean: str, names: str) -> str:
    return f"regexp_extract_all({clean}, {q(P.open_tag_re(names, java=False))}, 0)"


def attr(t: str, name: str) -> str:
    pat = P.attr_re(name)
    val = f"concat({rx_extract(t, pat, 1)}, {rx_extract(t, pat, 2)}, {rx_extract(t, pat, 3)})"
    return f"(CASE WHEN {rx_match(t, pat)} THEN {decode_entities(val)} END)"


def tag_name(t: str) -> str:
    return f"lower({rx_extract(t, r'^</?([a-zA-Z][a-zA-Z0-9:-]*)', 1)})"


def ordered_distinct(lst: str) -> str:
    """Order preserving distinct of a list expression (first occurrence)."""
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


# --------------------------------------------------------------------- urls

SCHEME_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"
HIER = r"^[a-zA-Z][a-zA-Z0-9+.-]*://"
HOST_RE = HIER + r"(?:[^@/?#]*@)?(\[[^\]]*\]|[^:/?#]*)"
AUTHORITY_RE = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"
PATH_RE = HIER + r"[^/?#]*([^?#]*)"
BAD_URI_RE = r"""[ "<>\\^`{|}\[\]]|#.*#|%(?:[^0-9a-fA-F]|[0-9a-fA-F][^0-9a-fA-F]|[0-9a-fA-F]?$)"""


def scheme(u: str) -> str:
    return rx_extract(u, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)


def host(u: str) -> str:
    return rx_extract(u, HOST_RE, 1)


def origin(u: str) -> str:
    return f"(CASE WHEN {rx_match(u, HIER)} THEN concat(lower({scheme(u)}), '://', {host(u)}) END)"


def path(u: str) -> str:
    return rx_extract(u, PATH_RE, 1)


def _dots(p: str) -> str:
    p2 = f"regexp_replace({p}, '/\\.\\.?$', '\\0/')"
    red = (f"array_to_string(list_reduce(string_split({p2}, '/'), lambda acc, x: "
           f"CASE WHEN x = '.' THEN acc WHEN x = '..' THEN (CASE WHEN len(acc) > 1 "
           f"THEN acc[1:len(acc)-1] ELSE acc END) ELSE list_append(acc, x) END, []::VARCHAR[]), '/')")
    return f"(CASE WHEN {rx_match(p, r'(^|/)\.\.?(/|$)')} THEN {red} ELSE {p} END)"


def resolve_url(base: str, href: str) -> str:
    h = f"trim({href})"
    b_auth = rx_extract(base, AUTHORITY_RE, 1)
    b_nofrag = rx_extract(base, r"^([^#]*)", 1)
    b_noquery = rx_extract(base, r"^([^?#]*)", 1)
    b_dir = rx_extract(path(base), r"^(.*/)", 1)
    h_path = rx_extract(h, r"^([^?#]*)", 1)
    h_rest = rx_extract(h, r"^[^?#]*(.*)$", 1)
    merged = f"concat(CASE WHEN {b_dir} = '' THEN '/' ELSE {b_dir} END, {h_path})"
    return (f"(CASE WHEN {rx_match(h, SCHEME_RE)} THEN {h} "
            f"WHEN starts_with({h}, '//') THEN concat({scheme(base)}, ':', {h}) "
            f"WHEN starts_with({h}, '/') THEN concat({b_auth}, {_dots(h_path)}, {h_rest}) "
            f"WHEN starts_with({h}, '?') THEN concat({b_noquery}, {h}) "
            f"WHEN starts_with({h}, '#') THEN concat({b_nofrag}, {h}) "
            f"WHEN {h} = '' THEN {b_nofrag} "
            f"ELSE concat({b_auth}, {_dots(merged)}, {h_rest}) END)")


def is_document(link: str) -> str:
    cut = f"lower({rx_extract(link, r'^([^?#]*)', 1)})"
    ext = rx_extract(cut, r"\.([a-z0-9]{1,5})$", 1)
    return f"coalesce({ext} IN ({', '.join(q(e) for e in P.DOCUMENT_EXTENSIONS)}), false)"


def is_external(page_url: str, link: str) -> str:
    return f"(NOT contains({link}, {host(page_url)}))"


def is_reference(page_url: str, link: str) -> str:
    ok = (f"{rx_match(link, HIER)} AND NOT {rx_match(link, BAD_URI_RE)} "
          f"AND NOT {rx_match(page_url, BAD_URI_RE)}")
    return (f"coalesce({ok} AND {scheme(page_url)} = {scheme(link)} AND {host(page_url)} = {host(link)} "
            f"AND {path(page_url)} = {path(link)} AND contains({link}, '#'), false)")


def link_kind(page_url: str, link: str) -> str:
    return (f"(CASE WHEN {is_document(link)} THEN 'documents' "
            f"WHEN {is_external(page_url, link)} THEN 'external' "
            f"WHEN {is_reference(page_url, link)} THEN 'reference' ELSE 'internal' END)")


def url_filter(link: str, patterns, logic) -> str:
    if not logic or not patterns:
        return "true"
    whole = "^(?:" + "|".join("(?:" + p + ")" for p in patterns) + r")\z"
    hit = rx_match(link, whole)
    return hit if logic.lower() == "include" else f"(NOT {hit})"


def clean_url(u: str) -> str:
    u1 = rx_extract(rx_replace(f"trim({u})", "##+", "#"), r"^([^#]*)", 1)
    illegal = [(" ", "%20"), ('"', "%22"), ("<", "%3C"), (">", "%3E"), ("\\", "%5C"),
               ("^", "%5E"), ("`", "%60"), ("{", "%7B"), ("|", "%7C"), ("}", "%7D")]
    asc = "c"
    for k, v in illegal:
        asc = f"replace({asc}, {q(k)}, {q(v)})"
    enc = (f"array_to_string(list_transform(regexp_extract_all({u1}, '[^\\x00-\\x7F]+|[\\x00-\\x7F]+', 0), "
           f"lambda c: CASE WHEN regexp_matches(c, '^[\\x00-\\x7F]') THEN {asc} ELSE url_encode(c) END), '')")
    enc = f"(CASE WHEN {rx_match(u1, '[^\\x21-\\x7E]|[\"<>\\\\^`{|}]')} THEN {enc} ELSE {u1} END)"
    after = f"list_transform(string_split({enc}, '%')[2:], lambda p: CASE WHEN regexp_matches(p, '^[0-9a-fA-F]{{2}}') THEN '%' || p ELSE '%25' || p END)"
    pct = f"(string_split({enc}, '%')[1] || array_to_string({after}, ''))"
    pct = f"(CASE WHEN contains({enc}, '%') THEN {pct} ELSE {enc} END)"
    head = rx_extract(pct, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?", 0)
    rest = f"replace(replace(substring({pct}, length({head}) + 1), '[', '%5B'), ']', '%5D')"
    out = f"(CASE WHEN {rx_match(u1, '[%]|\\[|\\]')} THEN {head} || {rest} ELSE {enc} END)"
    return f"(CASE WHEN {rx_match(u1, HIER)} OR NOT {rx_match(u1, SCHEME_RE)} THEN {out} END)"


def file_extension(name: str) -> str:
    return rx_extract(name, r"\.([^.]+)$", 1)


def mime_type(name: str) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in sorted(P.MIME_TYPES.items()))
    return f"coalesce(CASE lower({file_extension(name)}) {cases} END, {q(P.DEFAULT_MIME)})"


def embedded_url(u: str) -> str:
    qs = rx_extract(u, r"^[^?#]*\?([^#]*)", 1)
    vals = (f"list_transform(string_split({qs}, '&'), lambda p: CASE WHEN starts_with(p, 'url=') "
            f"THEN regexp_replace(p[5:], '=+$', '') END)")
    hits = f"list_filter({vals}, lambda v: v <> '' AND NOT contains(v, '='))"
    v = f"try(url_decode(replace({hits}[1], '+', ' ')))"
    return f"(CASE WHEN {qs} <> '' AND len({hits}) > 0 AND {v} IS NOT NULL THEN {v} ELSE {u} END)"


def image_file_name(u: str) -> str:
    name = rx_extract(rx_extract(u, r"^([^?]*)", 1), r"([^/]*)$", 1)
    return f"(CASE WHEN contains({name}, '.') THEN {name} ELSE concat({name}, '.jpg') END)"


def sanitize_file_name(t: str) -> str:
    return f"replace(translate({t}, '\\/:*?\"<>|', '_________'), ' ', '')"


def escape_xml(s: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        s = f"replace({s}, {q(a)}, {q(b)})"
    return s


def priority(depth: str) -> str:
    t = f"greatest(0, least(10, 10 - CAST({depth} AS INTEGER)))"
    return f"(CASE WHEN {t} = 10 THEN '1.0' ELSE concat('0.', CAST({t} AS VARCHAR)) END)"
