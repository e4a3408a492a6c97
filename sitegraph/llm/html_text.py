"""Main text of HTML pages, with site template removal.

Every element's subtree is hashed (tag, text with numbers taken alike, and the
hashes of its children).  Spark counts on how many pages of a host each block
subtree stands.  It *recurs* if those are ``least_pages`` of the host's or more:
``LEAST`` pages, fewer on a host of less than four times as many, one in ``PART``
on a very large one; so a section's notice counts, however small its share.  A
second look decides what recurring subtrees are: the site's template stands beside
text of the page's own, so only pages vote of which ``OWN`` of the text does not
recur; pages copied whole, or nearly, do not make their article a template.
Recurring subtrees with enough votes are deleted.  Inside an article only containers
are (a box, a form, a list of links among the paragraphs); paragraphs, headings and
lists there are running text, which may be quoted on many pages.

A host's template has at most ``PART`` times a page's subtrees, so its list is short
however many pages it has; the lists are joined to the pages by host (broadcast by
Spark only while the staged table is under its threshold).

What HTML itself calls no article goes by its tag or role, and by a class or id that
names such a part as a whole (``sidebar``, ``sidebarLeft``, ``cookie-bar``; not
``share-price``).  A form, or a part so named, stays if it holds the article.  If a
page has article or main elements, only what is inside them stays.

The parser keeps a stack of open elements, not a tree, so depth costs nothing.
Elements with optional end tags are closed by the next one of their kind, a p
by any block; an end tag without an open element is ignored, and an unfinished
tag at the end is dropped.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegraph.llm.common import free_names, stage

#: Pages that make a subtree recur; the part of a host's pages that must; the part of a voting page's text that is its own.
LEAST, PART, OWN = 10, 100, 0.2
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>=]++|=)*+)>|<!--|<[!?/]|<(?=[a-zA-Z])")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section
    summary table tbody td tfoot th thead title tr ul""".split())
#: Elements that an opening tag closes, and those that stop the search for them.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"})}
_SCOPE = {"article", "main", "body", "html", "table", "td", "th", "div", "section", "li", "blockquote", "button", "form"}
#: No article text, wherever they stand.
_DROP = set("""head script style noscript template svg math canvas iframe object embed audio video nav footer aside
    button select textarea input dialog menu label fieldset""".split())
_DROP_ROLE = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Parts of a page that a class or id may name, and words that say only where or in what form they stand.
_PART = set("""ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments
    cookie cookies consent disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices popup
    promo promos promoted related share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget widgets""".split())
_PLACE = set("""left right top bottom upper lower inner outer main site page global primary secondary sticky fixed mobile box bar
    block section container wrapper wrap area list panel inline holder slot group buttons links icons thread form message text""".split())
_COMMENT = {"comment", "comments", "disqus"}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Never template: they hold the page or its article.
_FRAME = {"html", "body", "main", "article"}
#: Blocks that inside an article are its parts or boxes beside it, not running text.
_BOX = set("div section aside form header footer nav details dialog fieldset figure menu table".split())
_NUMBER = re.compile(r"\d+")


def attributes(source: str) -> dict[str, str]:
    """A tag's attributes, read one after the other; of several of one name the first."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), "".join(values))
    return out


def part_named(value: str) -> set[str]:
    """The page parts that the names of a class or id stand for: names made up of a part and words of place only."""
    found: set[str] = set()
    for name in value.split():
        words, parts = [w.lower() for w in _WORD.findall(name)], set()
        for w in words:
            if w in _PART:
                parts.add(w)
            elif w not in _PLACE:
                glued = [p for p in _PART if w.startswith(p) and w[len(p):] in _PLACE]
                if not glued:
                    break
                parts.update(glued)
        else:
            found |= parts
    return found


#: What becomes of an element: it stays, it goes, or it goes unless it holds the article.
STAYS, GOES, UNLESS = range(3)


def fate(tag: str, source: str, inside: int) -> int:
    """STAYS, GOES or UNLESS, by an element's tag and attributes; ``inside``: articles around it."""
    if tag in _DROP or (tag == "header" and not inside):
        return GOES
    if tag == "form":
        return UNLESS
    if "=" not in source or tag in ("html", "body", "main"):
        return STAYS
    a = attributes(source)
    if a.get("role", "").strip().lower() in _DROP_ROLE:
        return UNLESS if tag in _BLOCK else GOES
    parts = part_named(a.get("class", "")) | part_named(a.get("id", ""))
    if inside:
        parts.discard("header")  # an article has a header of its own
    if parts & _COMMENT:
        return GOES
    if not parts or tag == "article":
        return STAYS
    return UNLESS if tag in _BLOCK else GOES


class Page:
    """Parses one page: ``blocks`` is its main text, ``hashes`` those of its subtrees that may be template, ``own`` the
    part of its text that is in none of ``template``."""

    def __init__(self, source: str | None, template: frozenset[int] = frozenset()):
        self.template, self.hashes = template, set()
        #: tag, fate, kept blocks and text pieces at its start, parts of its hash, articles and texts before, in an article
        self.stack: list[list] = []
        self.size = self.lost = 0
        self.kept: list[tuple[int, str]] = []  # (inside an article, text)
        self.pieces: list[str] = []
        self.dropped = self.inside = self.articles = 0
        self._parse(source or "")
        while self.stack:
            self._pop()
        self._flush()
        self.blocks = [t for i, t in self.kept if i or not self.articles]
        self.own = 1 - self.lost / self.size if self.size else 0.0

    def _parse(self, s: str) -> None:
        at, end = 0, len(s)
        while at < end:
            m = _TAG.search(s, at)
            self._text(s[at:m.start() if m else end])
            if not m:
                return
            at = m.end()
            if m[2]:
                tag = m[2].lower()
                if m[1]:
                    self._close(tag)
                    continue
                self._open(tag, m[3])
                if tag in _VOID:
                    self._pop()
                elif tag in _RAW:
                    close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(s, at)
                    if tag == "title":
                        self._text(s[at:close.start() if close else end])
                    self._pop()
                    at = close.end() if close else end
            elif m[0] == "<!--":
                close = s.find("-->", at)
                at = close + 3 if close >= 0 else end
            else:  # a declaration, or a tag that never ends
                close = s.find(">", at)
                at = close + 1 if close >= 0 else end

    def _text(self, raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            if self.stack:
                self.stack[-1][4].append(_NUMBER.sub("0", " ".join(text.split())))
            if not self.dropped:
                self.pieces.append(text)

    def _flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces = []
        if text:
            self.kept.append((self.inside, text))
            self.size += len(text)

    def _open(self, tag: str, attributes: str) -> None:
        if tag in _BLOCK:
            self._end_open({"p"}, _SCOPE)
        if tag in _CLOSES:
            self._end_open(*_CLOSES[tag])
        if tag in _BLOCK:
            self._flush()
        elif tag == "br" and not self.dropped:
            self.pieces.append(" ")
        to = fate(tag, attributes, self.inside)
        self.dropped += to == GOES
        inside = self.inside
        if tag in ("article", "main") and not self.dropped:
            self.inside += 1
            self.articles += 1
        self.stack.append([tag, to, len(self.kept), len(self.pieces), [], self.articles, inside])

    def _end_open(self, tags: set[str], stop: set[str]) -> None:
        """Ends the outermost open element of ``tags`` above the nearest of ``stop``."""
        found = None
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                found = i
            elif self.stack[i][0] in stop:
                break
        if found is not None:
            while len(self.stack) > found:
                self._pop()

    def _close(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self._pop()
                return

    def _pop(self) -> None:
        tag, to, kept, pieces, parts, articles, inside = self.stack.pop()
        block = tag in _BLOCK
        if block:
            self._flush()
        h = xxhash.xxh64_intdigest("\x00".join([tag, *parts]).encode("utf-8", "surrogatepass")) >> 1
        if self.stack:
            self.stack[-1][4].append(f"\x01{h:x}")
        if tag in ("article", "main") and not self.dropped:
            self.inside -= 1
        self.dropped -= to == GOES
        if to == UNLESS and self.articles == articles and not self._runs(tag, kept):
            self._delete(kept)
        elif block and tag not in _FRAME and any(parts) and not self.dropped and (not inside or tag in _BOX):
            self.hashes.add(h)
            if h in self.template:
                self.lost += sum(len(t) for _, t in self.kept[kept:])
                self._delete(kept, False)

    def _runs(self, tag: str, kept: int) -> bool:
        """Whether a form that holds no article element still holds running text: a page-wide form around plain blocks."""
        return tag == "form" and not self.inside and sum(len(t) for _, t in self.kept[kept:]) > 400

    def _delete(self, kept: int, counted: bool = True) -> None:
        if counted:  # no text of the page at all
            self.size -= sum(len(t) for _, t in self.kept[kept:])
        del self.kept[kept:]


def _host(pages: DataFrame):
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def least_pages(n, least: int = LEAST):
    """Pages of a host with ``n`` (a column) on which a subtree recurs."""
    return F.greatest(F.least(F.lit(least), F.greatest(F.lit(2), F.ceil(n / 4))), F.ceil(n / PART))


def site_templates(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(host, template): per host with any, the hashes of the subtrees of its template.

    Pages without a host (null or other url) count as one host.
    """
    def hashes(batches):
        for b in batches:
            each = [sorted(Page(h).hashes) for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(each, pa.list_(pa.int64()))], ["host", "hashes"])

    def votes(batches):
        for b in batches:
            each = []
            for h, recurs in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                page = Page(h, frozenset(recurs))
                each.append(sorted(page.hashes & page.template) if page.own >= OWN else [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(each, pa.list_(pa.int64()))], ["host", "hashes"])

    p = pages.select(_host(pages).alias("host"), "html")
    needed = stage(p.groupBy("host").agg(F.count("*").alias("n")).where("n > 1").select("host", least_pages(F.col("n"), least).alias("least")), "hosts")

    def often(found: DataFrame, name: str) -> DataFrame:
        counted = found.select("host", F.explode("hashes").alias("h")).groupBy("host", "h").agg(F.count("*").alias("n"))
        counted = counted.where("n > 1").join(needed, "host").where("n >= least")
        return stage(counted.groupBy("host").agg(F.collect_list("h").alias(name)), name)

    kind = "host string, hashes array<bigint>"
    recurs = often(p.mapInArrow(hashes, kind), "recurs")
    return often(p.join(recurs, "host").select("host", "html", "recurs").mapInArrow(votes, kind), "template")


def main_text(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``pages`` (url, html and more) with the column text: blocks joined by an empty line, '' if there are none.

    A null or empty html gives ''.  Repeated rows are pages of their own.
    Columns named text are replaced.
    """
    d = pages.drop("text")
    host, template = free_names(d, "_host", "_template")
    d = d.withColumn(host, _host(d)).join(site_templates(pages, least).toDF(host, template), host, "left").drop(host)
    source = d.columns.index("html")
    schema = T.StructType([*d.drop(template).schema.fields, T.StructField("text", T.StringType())])

    def extract(batches):
        for b in batches:
            out = ["\n\n".join(Page(h, frozenset(t or ())).blocks)
                   for h, t in zip(b.column(source).to_pylist(), b.column(template).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.string())], schema.fieldNames())

    return d.mapInArrow(extract, schema)
