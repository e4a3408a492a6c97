"""Benchmark decontamination by a distributed positional inverted index.

1. Windows: every run of ``n`` words of a benchmark item (a shorter item is one window).
2. Corpus frequency of every benchmark term, over all documents.  A window with
   a term that no document has cannot match and is dropped.
3. Index: postings (term, document, position) of the two rarest terms of every
   window, each with the words around it as payload.
4. Phrases: the posting list of the rarest term and that of the next rarest,
   both shifted by the term's offset in the window, are intersected by an equi
   join on (document, start, window); the payload then confirms every word.
   Proximity: all terms of a window within its length plus ``slop`` words of
   its rarest term.

Only DataFrame functions are used.  Work follows the text (one pass to count,
one to index) and the matches; the benchmark side is broadcast only while its
staged table is under the session's broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegraph.llm.common import ascii_lower, free_names, row_key, stage

#: A word is a maximal run of characters outside these ASCII ranges.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), NOT_WORD, -1), ""),
                      F.array().cast("array<string>"))


def item_windows(items: DataFrame, n: int) -> DataFrame:
    """(item, gram, terms) of every window; a null id is the item ''."""
    w = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                     words(F.col("text")).alias("w")).where("size(w) > 0")
    starts = F.expr(f"sequence(1, greatest(1, size(w) - {n - 1}))")
    w = w.select("item", "w", F.explode(starts).alias("s"))
    return w.select("item", F.slice("w", F.col("s"), n).alias("terms")).select(
        "item", "terms", F.concat_ws(" ", "terms").alias("gram")).distinct()


def _exploded(docs: DataFrame, extra: list[str]) -> DataFrame:
    return docs.select(*extra, F.posexplode("w").alias("pos", "term"))


class PositionalIndex:
    """Index of the corpus for the windows of ``items``.

    ``docs`` needs ``doc_id`` and ``text``; ``items`` needs ``item_id`` and
    ``text``.  Null and empty texts have no words.  Rows that repeat doc_id and
    text are indexed alike.  Other columns are ignored.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, n: int = 10, slop: int = 0):
        self.n, self.slop = n, slop
        self.docs = docs.select(*row_key(F.col("doc_id"), F.col("text")), words(F.col("text")).alias("w"))
        self.items = stage(item_windows(items, n), "windows")
        self.grams = self._ranked()
        self.postings = self._postings()

    def _ranked(self) -> DataFrame:
        """(gram, terms, t1, o1, t2, o2): the windows that can match, with their two rarest terms."""
        terms = stage(self.items.select(F.explode("terms").alias("term")).distinct(), "terms")
        freq = stage(_exploded(self.docs, []).join(terms, "term").groupBy("term").agg(F.count("*").alias("f")), "freq")
        g = self.items.select("gram", "terms").distinct()
        each = g.select("gram", F.size("terms").alias("len"), F.posexplode("terms").alias("off", "term"))
        per = each.join(freq, "term").groupBy("gram", "len").agg(
            F.array_sort(F.collect_list(F.struct("f", "term", "off"))).alias("r"))
        per = per.where("size(r) = len")
        second = F.when(F.size("r") > 1, F.col("r")[1]).otherwise(F.col("r")[0])
        return stage(per.select("gram", F.split("gram", " ").alias("terms"), F.col("r")[0].term.alias("t1"),
                                F.col("r")[0].off.alias("o1"), second.term.alias("t2"), second.off.alias("o2")), "grams")

    def _postings(self) -> DataFrame:
        """(term, k1, k2, pos, lo, ctx): ctx holds the words from position lo on."""
        keep = stage(self.grams.select(F.col("t1").alias("term")).union(self.grams.select("t2")).distinct(), "index-terms")
        reach = self.n - 1 + self.slop
        p = _exploded(self.docs, ["k1", "k2", "w"]).join(keep, "term")
        lo = F.greatest(F.lit(0), F.col("pos") - reach)
        p = p.select("term", "k1", "k2", "pos", lo.alias("lo"),
                     F.slice("w", lo + 1, F.col("pos") - lo + 1 + reach).alias("ctx"))
        return stage(p, "postings")

    def phrases(self) -> DataFrame:
        """(k1, k2, start, len, gram) of every occurrence of a window."""
        p = self.postings
        first = p.join(self.grams.select("gram", "terms", "t1", "o1"), F.col("term") == F.col("t1")).select(
            "k1", "k2", (F.col("pos") - F.col("o1")).alias("start"), "gram", "terms", "lo", "ctx")  # repeated rows meet in the last distinct
        after = p.select("term", "k1", "k2", "pos").join(
            self.grams.select("gram", "t2", "o2"), F.col("term") == F.col("t2")).select(
            "k1", "k2", (F.col("pos") - F.col("o2")).alias("start"), "gram").distinct()
        both = first.join(after, ["k1", "k2", "start", "gram"])
        at = F.col("start") - F.col("lo") + 1
        return both.where("start >= lo").where(F.slice("ctx", at, F.size("terms")) == F.col("terms")).select(
            "k1", "k2", "start", F.size("terms").alias("len"), "gram").distinct()

    def proximity(self) -> DataFrame:
        """(k1, k2, pos, gram): all terms of a window stand within its length plus ``slop`` words of its rarest term."""
        j = self.postings.join(self.grams.select("gram", "terms", "t1"), F.col("term") == F.col("t1"))
        near = F.size("terms") - 1 + self.slop
        lo = F.greatest(F.col("lo"), F.col("pos") - near)
        part = F.slice("ctx", lo - F.col("lo") + 1, F.col("pos") - lo + 1 + near)
        return j.where(F.size(F.array_except("terms", part)) == 0).select("k1", "k2", "pos", "gram").distinct()


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Adds n_words, hits (matched words), items (matched item ids, sorted) and contaminated to ``docs``.

    Columns of ``docs`` with these names are replaced.  Null text: no words,
    not contaminated.  Repeated rows each get the result.  An empty benchmark
    or corpus gives no hits.
    """
    index = PositionalIndex(docs, items, n)
    occ = stage(index.phrases(), "phrases")
    # sets, not lists, per document: bounded by its words and by the items
    hit = occ.select("k1", "k2", F.explode(F.expr("sequence(start, start + len - 1)")).alias("at")).distinct() \
        .groupBy("k1", "k2").agg(F.count("*").alias("hits"))
    found = occ.select("k1", "k2", "gram").distinct().join(index.items.select("gram", "item"), "gram") \
        .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item")).alias("items"))
    per = hit.join(found, ["k1", "k2"])
    k1, k2 = row_key(F.col("doc_id"), F.col("text"))
    names = free_names(docs, "__k1", "__k2")
    out = docs.drop("n_words", "hits", "items", "contaminated").withColumns(dict(zip(names, (k1, k2))))
    out = out.join(per.toDF(*names, "hits", "items"), names, "left")
    return out.drop(*names).withColumns({
        "n_words": F.size(words(F.col("text"))).cast("bigint"),
        "hits": F.coalesce("hits", F.lit(0)).cast("bigint"),
        "items": F.coalesce("items", F.array().cast("array<string>"))}).withColumn("contaminated", F.col("hits") > 0)
