"""Line dedup: winnowing over line hashes.

The lines of a document that are not blank form its line sequence.  A *run* is
``window`` consecutive lines of it, or, where ``long_words`` is given, a single
line of at least so many words (a shorter document has no others).  Of all
places of a run, the first one by (doc_id, row key, line) stays; every line
covered by a later place of a run is deleted.  Longer repeats are chains of
overlapping runs, so a match of any length is deleted whole, and no match of
``window`` lines or more is missed.

1. Line hashes per document; the smallest hash of each run (rightmost on ties)
   is selected, at most once per position: the guaranteed fingerprints.
2. Positions of equal fingerprints are joined; fingerprints seen once go.
3. Each remaining position is extended both ways to the runs it was selected
   for, and runs are joined on their 128-bit hash with the first place of each.

Groups are only counted or reduced to their first place (partial aggregation
on the map side), so a line that a third of all documents share costs no task
more than others.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegraph.functions.html import let
from sitegraph.llm.common import free_names, row_key, stage


def _is_long(line: Column, long_words: int | None) -> Column:
    if long_words is None:
        return F.lit(False)
    # so many words and the gaps between them take 2n - 1 characters: most lines are told by their length
    return (F.length(line) >= 2 * long_words - 1) & (F.regexp_count(line, F.lit(r"\S+")) >= long_words)


def _lines(text: Column, long_words: int | None) -> Column:
    """Array of (at, h1, h2, long) of the lines that are not blank; at counts all lines from 0."""
    each = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x, i: F.struct(
        i.alias("at"), F.xxhash64(F.trim(x)).alias("h1"), F.xxhash64(F.lit("2"), F.trim(x)).alias("h2"),
        _is_long(x, long_words).alias("long"), (F.length(F.trim(x)) == 0).alias("blank")))
    return F.filter(each, lambda x: ~x.blank)


def later_lines(docs: DataFrame, window: int = 2, long_words: int | None = None) -> DataFrame:
    """(k1, k2, drop): per document with any, the line numbers to delete."""
    d = docs.select("doc_id", *row_key(F.col("doc_id"), F.col("text")), _lines(F.col("text"), long_words).alias("ls"))
    d = d.where((F.size("ls") >= window) | F.exists("ls", lambda x: x.long))
    # per run: its place, the position selected in it, and its hash
    runs = f"""
        transform(if(size(ls) < {window}, array(), sequence(0, size(ls) - {window})), s -> named_struct(
            's', s,
            'f', array_min(transform(slice(ls, s + 1, {window}), (x, i) -> named_struct('h', x.h1, 'i', -(s + i)))),
            'r1', xxhash64(transform(slice(ls, s + 1, {window}), x -> x.h1)),
            'r2', xxhash64(transform(slice(ls, s + 1, {window}), x -> x.h2)),
            'at', transform(slice(ls, s + 1, {window}), x -> x.at)))"""
    if long_words is not None:  # a long line is a run of its own
        runs = f"""concat({runs}, transform(filter(transform(ls, (x, s) -> named_struct('x', x, 's', s)), y -> y.x.long),
            y -> named_struct('s', y.s, 'f', named_struct('h', y.x.h1, 'i', -y.s), 'r1', xxhash64(array(y.x.h1)),
                              'r2', xxhash64(array(y.x.h2)), 'at', array(y.x.at))))"""
    runs = F.expr(runs)
    r = stage(d.select("doc_id", "k1", "k2", F.explode(runs).alias("r")).select(
        "doc_id", "k1", "k2", "r.s", F.col("r.f.h").alias("fp"), (-F.col("r.f.i")).alias("pos"),
        "r.r1", "r.r2", "r.at").distinct(), "line-runs")
    # fingerprints: one row for each selected position
    places = r.select("k1", "k2", "fp", "pos").distinct()
    often = places.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp")
    often = stage(often, "line-fingerprints")  # a table on either side of the join: Spark can split a hot line
    ext = stage(r.join(often, "fp"), "extended-runs")  # a position's runs extend it both ways
    place = F.struct("doc_id", "k1", "k2", "s")
    first = ext.groupBy("r1", "r2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = stage(first.select("r1", "r2", "first"), "first-runs")
    later = ext.join(first, ["r1", "r2"]).where(~place.eqNullSafe(F.col("first")))
    return later.select("k1", "k2", F.explode("at").alias("at")).groupBy("k1", "k2").agg(
        F.collect_set("at").alias("drop"))


def line_dedup(docs: DataFrame, window: int = 2, long_words: int | None = None) -> DataFrame:
    """``docs`` with text less its repeated lines, n_lines and n_dropped added.

    With ``long_words`` a later place of a line of so many words (parts between
    white space) goes even if the lines around it are its own.
    Every row stays, also one whose lines all go (its text is then empty).
    Null text stays null with 0 lines.  Blank lines are never deleted.  Rows
    that repeat doc_id and text are one place: they are treated alike.  A null
    doc_id comes first in the order.  n_chars, where there, follows the text.
    """
    k1, k2 = row_key(F.col("doc_id"), F.col("text"))
    own = free_names(docs, "__k1", "__k2", "__drop")
    out = docs.withColumns({own[0]: k1, own[1]: k2}).join(later_lines(docs, window, long_words).toDF(*own), own[:2], "left")
    all_lines, drop = F.split(F.col("text"), "\n", -1), F.col(own[2])
    # one pass over the lines: the numbers that stay, by a hash set, then their lines
    kept = let(F.struct(all_lines.alias("lines"), drop.alias("drop")), lambda x: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["drop"]), lambda i: x["lines"][i]))
    text = F.when(drop.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = out.withColumns({"n_lines": F.coalesce(F.size(all_lines), F.lit(0)).cast("bigint"),
                           "n_dropped": F.coalesce(F.when(drop.isNotNull(), F.size(drop)), F.lit(0)).cast("bigint"),
                           "text": text}).drop(*own)
    out = out.withColumn("n_lines", F.when(F.col("text").isNull(), F.lit(0).cast("bigint")).otherwise(F.col("n_lines")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out
