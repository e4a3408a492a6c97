"""Removal of repeated substrings by suffix arrays.

A byte goes if a string of ``length`` bytes that covers it starts at another
place too, in any document, its own included; matches never cross documents.

1. Every window of ``length`` bytes is filed under the smallest hash (rightmost
   on ties) of the ``GRAM``-byte runs in it: its anchor.  Equal windows have
   equal anchors at equal offsets.  The windows of one anchor place stand side
   by side; with their bytes they are its context.
2. Anchors seen once drop out.  Contexts that are equal are counted, not kept:
   all windows of a context seen twice are repeated.
3. Anchors with several different contexts go to shards.  A shard's contexts
   get a suffix array (Larsson-Sadakane refinement) and common prefixes
   (Kasai); windows whose neighbours in it share ``length`` bytes are repeated.
4. An anchor with more contexts than a shard holds is spread over several.
   Each gives the hashes of its distinct windows; these are dealt by hash,
   sorted, and looked up by binary search, so a window of several shards is
   found whatever shards they are.
5. The repeated windows of a context hold for all its places; per document the
   covered bytes go.

Bloom tables of fixed size thin the anchor places and texts before they are
shuffled; the joins after them are exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegraph.llm.bloom import Bloom
from sitegraph.llm.common import free_names, parallelism, row_key, stage
from sitegraph.llm.suffix_array import common_prefixes, lay_out, packed, suffix_array
from sitegraph.llm.winnowing import gram_hashes

GRAM = 48
#: Contexts of one anchor in a shard; a context has fewer than 2 * length bytes.
SHARD = 28_000
#: Bytes of contexts that are sorted at once, if no single anchor has more.
RUN = 2_000_000


def anchors(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) of every anchor place of a text."""
    n, size = len(text), length - gram + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 3
    with np.errstate(over="ignore"):
        h = gram_hashes(np.frombuffer(text, np.uint8), gram)
    key = (h << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(len(h), dtype=np.uint64))
    rows = np.concatenate([key, np.full(-len(h) % size, ~np.uint64(0))]).reshape(-1, size)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(after[:len(h) - size + 1], before[size - 1:len(h)])
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    last = np.concatenate([first[1:], [len(low)]]) - 1
    return (np.uint64(0xFFFFFFFF) - (low[first] & np.uint64(0xFFFFFFFF))).astype(np.int64), first, last


def _signed(x: list[int]) -> np.ndarray:
    return np.array(x, np.uint64).view(np.int64)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _anchor_ids(text: bytes, at: np.ndarray, gram: int) -> np.ndarray:
    return _signed([xxhash.xxh64_intdigest(text[p:p + gram]) for p in at.tolist()])


def repeated_in(contexts: list[bytes], spans: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, window, times) of every window: how often it stands among the contexts.

    ``spans``: last window of each context, counted from its start.
    """
    s, start = lay_out(contexts)
    words = packed(s)
    sa = suffix_array(s, words)
    same = common_prefixes(s, start, sa, length, words) >= length
    run = np.cumsum(~same) - 1
    context = np.repeat(np.arange(len(contexts)), np.diff(np.concatenate([start, [len(s)]])))[sa]
    window = sa - start[context]
    valid = window <= spans[context]
    times = np.bincount(run[valid], minlength=run[-1] + 1 if len(run) else 0)[run]
    return context[valid], window[valid], times[valid]


def _ranges(context: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first, last) of the runs of windows that follow each other."""
    order = np.lexsort((window, context))
    c, w = context[order], window[order]
    new = np.concatenate([[True], (c[1:] != c[:-1]) | (w[1:] != w[:-1] + 1)])[:len(c)]
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:], [len(c)]]) - 1
    return c[begin], w[begin], w[end] if len(c) else w


def _groups(batches, keys: int, size):
    """Tables of whole groups (rows equal in the first ``keys`` columns, which stand together) of about ``size`` bytes."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.nbytes
        if n >= size:
            t = pa.Table.from_batches(held).combine_chunks()
            differ = np.zeros(len(t), bool)
            for i in range(keys):
                v = t.column(i).to_numpy()
                differ |= v != v[-1]
            cut = int(np.flatnonzero(differ)[-1]) + 1 if differ.any() else 0
            if cut:
                yield t.slice(0, cut)
            held = t.slice(cut).to_batches()
            n = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def repeated_windows(docs: DataFrame, length: int, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """(k1, k2, first, last): ranges of repeated windows by document; ``docs`` has k1, k2 and text."""
    spark = docs.sparkSession
    n = parallelism(spark)
    d = docs.select("k1", "k2", "text")

    def ids(batches):
        for b in batches:
            out = [_anchor_ids(t, anchors(t, length, gram)[0], gram) for t in map(_bytes, b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*out, np.zeros(0, np.int64)]))], ["anchor"])

    often = d.select("text").mapInArrow(ids, "anchor bigint").groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    table = spark.sparkContext.broadcast(Bloom(often, "anchor"))

    def places(batches):
        schema = pa.schema([("anchor", pa.int64()), ("ctx", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                            ("first", pa.int64()), ("span", pa.int64())])
        for b in batches:
            parts = []
            k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            for row, t in enumerate(map(_bytes, b.column(2).to_pylist())):
                at, first, last = anchors(t, length, gram)
                if not len(at):
                    continue
                anchor = _anchor_ids(t, at, gram)
                may = table.value.may_hold(anchor)
                at, first, last, anchor = at[may], first[may], last[may], anchor[may]
                ctx = _signed([xxhash.xxh64_intdigest(t[i:j + length], p - i) for p, i, j in zip(at.tolist(), first.tolist(), last.tolist())])
                parts.append((anchor, ctx, np.full(len(at), k1[row]), np.full(len(at), k2[row]), first, last - first))
            columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    place = stage(d.mapInArrow(places, "anchor bigint, ctx bigint, k1 bigint, k2 bigint, first bigint, span bigint"), "anchor-places")
    groups = stage(place.groupBy("anchor", "ctx").agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "first", "span")).alias("at")), "contexts")
    several = stage(groups.groupBy("anchor").agg(F.count("*").alias("d")).where("d > 1"), "several")
    shards = F.ceil(F.col("d") / F.lit(shard)).cast("bigint")
    chosen = groups.join(several, "anchor").select(
        "anchor", F.pmod("ctx", shards).alias("salt"), (shards > 1).alias("spread"), "ctx", "n", "at.*")
    wanted = chosen.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "salt", "spread", "ctx", "n", "first", "span")).alias("cut"))
    wanted = stage(wanted, "wanted")
    cuts = d.where(_may(d, Bloom(wanted, "k1"))("k1")).join(wanted, ["k1", "k2"]).select("text", "cut")

    def cut(batches):
        for b in batches:
            rows = []
            for t, cs in zip(map(_bytes, b.column(0).to_pylist()), b.column(1).to_pylist()):
                for c in cs:
                    rows.append(c | {"bytes": t[c.pop("first"):][:c["span"] + length]})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("anchor", pa.int64()), ("salt", pa.int64()), ("spread", pa.bool_()), ("ctx", pa.int64()), ("n", pa.int64()),
                ("span", pa.int64()), ("bytes", pa.binary())]))

    dealt = cuts.mapInArrow(cut, "anchor bigint, salt bigint, spread boolean, ctx bigint, n bigint, span bigint, bytes binary")
    dealt = dealt.repartition(n, "anchor", "salt").sortWithinPartitions("anchor", "salt")

    def sort(batches):
        schema = pa.schema([("anchor", pa.int64()), ("ctx", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
                            ("salt", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64())])
        for t in _groups(batches, 2, RUN):
            contexts, span = t["bytes"].to_pylist(), t["span"].to_numpy()
            anchor, ctx, salt = (t[c].to_numpy() for c in ("anchor", "ctx", "salt"))
            c, w, times = repeated_in(contexts, span, length)
            hit, first, last = _ranges(c[times > 1], w[times > 1])
            none = np.zeros(len(hit), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor[hit], ctx[hit], first, last, none, none)] +
                                             [pa.nulls(len(hit), pa.int64())], schema=schema)
            wide = t["spread"].to_numpy(zero_copy_only=False)[c]
            for i in range(0, int(wide.sum()), 100_000):  # windows of anchors with several shards
                cs, ws = c[wide][i:i + 100_000], w[wide][i:i + 100_000]
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(contexts[k][j:j + length])
                                                for k, j in zip(cs.tolist(), ws.tolist())), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor[cs], ctx[cs], ws, ws, salt[cs], digest[:, 0].copy(),
                                                                        digest[:, 1].copy())], schema=schema)

    found = stage(dealt.mapInArrow(sort, "anchor bigint, ctx bigint, first bigint, last bigint, salt bigint, w1 bigint, w2 bigint"), "sorted")
    loose = found.where("w2 is not null")
    one = loose.groupBy("w1", "w2", "anchor", "salt").agg(F.min(F.struct("ctx", "first")).alias("at"))  # a shard's window once
    one = one.select("w1", "w2", "anchor", "salt", "at.*").repartition(n, "w1").sortWithinPartitions("w1")

    def merge(batches):
        schema = pa.schema([(c, pa.int64()) for c in ("anchor", "ctx", "first", "last")])
        for t in _groups(batches, 1, RUN):
            key = np.rec.fromarrays([t[c].to_numpy() for c in ("w1", "w2", "anchor")], names="a,b,c")
            ordered = np.sort(key)
            hit = np.searchsorted(ordered, key, "right") - np.searchsorted(ordered, key, "left") > 1
            first = t["first"].to_numpy()[hit]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (t["anchor"].to_numpy()[hit], t["ctx"].to_numpy()[hit], first, first)],
                                             schema=schema)

    marks = groups.where("n > 1").select("anchor", "ctx", F.lit(0).cast("bigint").alias("x"), F.col("at.span").alias("y"))
    marks = marks.union(found.where("w2 is null").select("anchor", "ctx", "first", "last"))
    marks = marks.union(one.mapInArrow(merge, "anchor bigint, ctx bigint, first bigint, last bigint"))
    marks = stage(marks, "marks")
    return place.join(marks, ["anchor", "ctx"]).select(
        "k1", "k2", (F.col("first") + F.col("x")).alias("first"), (F.col("first") + F.col("y")).alias("last"))


def _may(df: DataFrame, bloom: Bloom):
    held = df.sparkSession.sparkContext.broadcast(bloom)

    @F.pandas_udf("boolean")
    def may(k: pd.Series) -> pd.Series:
        return pd.Series(held.value.may_hold(k.to_numpy()))

    return may


def substring_dedup(docs: DataFrame, length: int = 200, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept (the bytes that stay) added.

    Texts are UTF-8 bytes; null counts as empty.  Repeated rows are documents
    of their own, so they repeat each other.  Columns of the added names are
    replaced.  A document under ``length`` bytes loses nothing.
    """
    d = docs.drop("n_bytes", "n_removed", "n_spans", "kept")
    k1, k2 = row_key(F.col("doc_id"), F.col("text"))
    n1, n2, may, cuts_of = free_names(d, "__k1", "__k2", "__may", "__cuts")
    d = d.withColumns({n1: k1, n2: k2})
    keyed = d.select(F.col(n1).alias("k1"), F.col(n2).alias("k2"), "text")
    per = stage(repeated_windows(keyed, length, gram, shard).distinct().groupBy("k1", "k2").agg(
        F.collect_list(F.struct("first", "last")).alias("cuts")), "repeats")
    asked = d.withColumn(may, _may(d, Bloom(per, "k1"))(n1))
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    zero = F.lit(0).cast("bigint")
    same = asked.where(~F.col(may)).drop(may).withColumns({
        "n_bytes": F.octet_length(whole).cast("bigint"), "n_removed": zero, "n_spans": zero, "kept": whole})
    joined = asked.where(F.col(may)).drop(may).join(per.toDF(n1, n2, cuts_of), [n1, n2], "left")
    joined = joined.select(*d.columns, cuts_of)
    text = d.columns.index("text")
    schema = T.StructType([*d.schema.fields, *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
                           T.StructField("kept", T.BinaryType())])

    def remove(batches):
        for b in batches:
            out = [[], [], [], []]
            for t, cuts in zip(map(_bytes, b.column(text).to_pylist()), b.column(len(d_columns)).to_pylist()):
                edge = np.zeros(len(t) + 1, np.int64)
                if cuts:
                    np.add.at(edge, [c["first"] for c in cuts], 1)
                    np.add.at(edge, [c["last"] + length for c in cuts], -1)
                gone = np.cumsum(edge[:-1]) > 0
                starts = gone.copy()
                starts[1:] &= ~gone[:-1]
                for column, v in zip(out, (len(t), int(gone.sum()), int(starts.sum()), np.frombuffer(t, np.uint8)[~gone].tobytes())):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(v, pa.int64()) for v in out[:3]), pa.array(out[3], pa.binary())],
                                             schema.fieldNames())

    d_columns = d.columns
    return same.select(*schema.fieldNames()).union(joined.mapInArrow(remove, schema)).drop(n1, n2)
