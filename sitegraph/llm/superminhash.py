"""SuperMinHash near-dedup on sets of word shingles.

1. Each text's set of shingle hashes gives a SuperMinHash signature: an element
   visits the places in an order of its own (a Fisher-Yates shuffle drawn step by
   step), the value it leaves at its j-th place is j plus a fraction, and a place
   keeps the least value.  One element's ranks are all different, which lowers the
   variance below MinHash; a text stops at the first step that cannot lower any
   place any more.  Equal sets are one node from here on.
2. Bands of five values file the nodes into buckets.  The nodes of a bucket are
   compared by two bits of 128 values each; pairs that may be similar enough give a
   spanning forest (union-find).  A bucket of more than ``LIMIT`` nodes links them all to
   its smallest, which only makes more candidates.
3. The candidates' components are verified on full sets: each text goes to one
   task with its component, an inverted index gives the exact intersections of one
   set with all others, and sets are taken as such a centre until those not yet
   taken are in one group.
   A component too large for a task is cut into slices: a few centres against all
   slices first, then what is outside the largest group found so, in blocks, against
   all slices.
4. Verified links make the final components.

Of pairs at the threshold the bands lose less than one in ten million
(``MISSED``), the two-bit comparison fewer still.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegraph.llm.common import parallelism, row_key, stage
from sitegraph.llm.components import components

SEED = 42
#: Values in a band, and the share of pairs at the threshold that all bands may miss.
BAND, MISSED = 5, 1e-7
#: Nodes of a bucket that one task compares with each other.
LIMIT = 4096
#: Nodes and shingles of a candidate component that one task verifies at once.
BLOCK, WEIGHT = 1024, 4_000_000
#: Rows of a partition compared at once, cut between buckets; elements that draw their places at once.
ROWS, ELEMENTS = 100_000, 1 << 15
#: Values of which two bits are compared, and their words.
SKETCH, WORDS = 128, 4
_EVEN = np.uint64(0x5555555555555555)


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``k``-word shingles (fewer words: of all of them; none: empty)."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    hashed = xxhash.xxh64_intdigest
    return np.unique(np.array([hashed(joined[i:j], SEED) for i, j in zip(starts.tolist(), ends[min(k, len(words)) - 1:].tolist())], np.uint64))


def bands_of(percent: int) -> int:
    """Bands that leave at most MISSED of the pairs at the threshold without a common bucket."""
    return math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** BAND))


def _mix(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number (SplitMix64's finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash values, one row of ``m`` for each set: the step in the upper 32 bits, a fraction in the lower."""
    out = np.full(len(sets) * m, m << 32, np.uint64)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    low = np.uint64(0xFFFFFFFF)
    for at in range(0, len(every), ELEMENTS):
        h, d = every[at:at + ELEMENTS], doc[at:at + ELEMENTS]
        first, last = int(d[0]), int(d[-1]) + 1
        order = np.empty((len(h), m), np.uint8)  # each element's places, in the order drawn so far
        order[:] = np.arange(m, dtype=np.uint8)
        row = np.arange(len(h))
        for j in range(m):
            x = _mix(h + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            k = (j + ((x & low) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64))
            place = order[row, k]
            order[row, k] = order[row, j]
            np.minimum.at(out, d * m + place, np.uint64(j << 32) | x >> np.uint64(32))
            worst = (out[first * m:last * m].reshape(-1, m).max(axis=1) >> np.uint64(32)).astype(np.int64)
            stay = worst[d - first] > j  # a later step leaves j + 1 or more
            if not stay.all():
                h, d, row = h[stay], d[stay], row[stay]
                if not len(h):
                    break
    return out.reshape(-1, m)


def _buckets(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    bands = signature.shape[1] // BAND
    parts = signature[:, :bands * BAND].reshape(-1, bands, BAND)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(BAND):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key


def _sketches(signature: np.ndarray) -> np.ndarray:
    """Two bits of SKETCH values, packed into WORDS words."""
    two = (signature[:, :SKETCH] & np.uint64(3)).reshape(-1, WORDS, SKETCH // WORDS)
    return np.bitwise_or.reduce(two << (np.uint64(2) * np.arange(SKETCH // WORDS, dtype=np.uint64)), axis=2)


def most_differing(percent: int) -> int:
    """Sketch values in which sets at the threshold differ at most: seven deviations above the mean."""
    p = 0.75 * (1 - percent / 100)
    return math.ceil(SKETCH * p + 7 * math.sqrt(SKETCH * p * (1 - p)))


def _find(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union-find over positions: joins the trees of a and b; ``root`` points at roots before and after."""
    while True:
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(root, np.maximum(ra, rb)[differ], np.minimum(ra, rb)[differ])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def forest(keys: np.ndarray, sketch: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of a spanning forest of the pairs of one key that differ in at most ``most`` values.

    Equal keys stand together.
    """
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.concatenate([start, [len(keys)]]))
    left = np.repeat(start + size, size) - np.arange(len(keys))  # rows from here to the end of the key
    root = np.arange(len(keys))
    at = np.flatnonzero(left > 1)
    d = 1
    while len(at):
        x = sketch[at] ^ sketch[at + d]
        near = np.bitwise_count((x | x >> np.uint64(1)) & _EVEN).sum(axis=1) <= most
        _find(root, at[near], at[near] + d)
        d += 1
        at = at[left[at] > d]
    tied = np.flatnonzero(root != np.arange(len(keys)))
    return tied, root[tied]


def _candidates(nodes: DataFrame, percent: int, limit: int) -> DataFrame:
    """(a, b): links that join all nodes whose sets may be similar enough."""
    most = most_differing(percent)
    keyed = nodes.select("sid", "sketch", F.explode("buckets").alias("key"))
    crowded = stage(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("sid").alias("low")).where(F.col("n") > limit).drop("n"), "crowded")
    star = keyed.select("sid", "key").join(crowded, "key").select(F.col("sid").alias("a"), F.col("low").alias("b"))
    few = keyed.join(crowded.select("key"), "key", "left_anti")
    few = few.repartition(parallelism(nodes.sparkSession), "key").sortWithinPartitions("key").select("key", "sid", "sketch")

    def done(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        sketch = t["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, WORDS)
        a, b = forest(t["key"].to_numpy(), sketch, most)
        sid = t["sid"].combine_chunks()
        return pa.RecordBatch.from_arrays([sid.take(pa.array(a)), sid.take(pa.array(b))], ["a", "b"])

    def compare(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= ROWS:
                t = pa.Table.from_batches(held)
                key = t["key"].to_numpy()
                cut = len(key) - int(np.argmin((key == key[-1])[::-1])) if key[0] != key[-1] else 0
                if cut:
                    yield done(t.slice(0, cut))
                held, rows = t.slice(cut).to_batches(), len(key) - cut
        if rows:
            yield done(pa.Table.from_batches(held))

    return few.mapInArrow(compare, "a binary, b binary").union(star).where("a != b")


def exact_links(sets: list[np.ndarray], centre: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join what all pairs with a centre and at least ``percent`` of similarity join."""
    n = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), n)
    _, term = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(term, kind="stable")
    postings = owner[order]
    first = np.searchsorted(term[order], np.arange(int(term.max(initial=-1)) + 2))
    begin = np.cumsum(n) - n
    label, open_ = np.arange(len(sets)), centre.copy()
    pending = np.ones(len(sets), bool)  # not yet taken as a centre
    links = []
    while open_.any():
        names, counts = np.unique(label[pending], return_counts=True)
        if len(names) == 1:
            break
        at = np.flatnonzero(open_)
        c = int(at[np.argmin(counts[np.searchsorted(names, label[at])])]) if links or not open_.all() else int(at[np.argsort(n[at])[len(at) // 2]])
        t = term[begin[c]:begin[c] + n[c]]
        length = first[t + 1] - first[t]
        where = np.repeat(first[t] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        both = np.bincount(postings[where], minlength=len(sets))
        near = np.flatnonzero(100 * both >= percent * (n + n[c] - both))
        near = near[label[near] != label[c]]
        if len(near):
            other, one = np.unique(label[near], return_index=True)
            links += [(int(near[i]), c) for i in one]
            label[np.isin(label, other)] = label[c]
        open_[c] = pending[c] = False
    return links


def _verified(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b): verified links within the groups (root, cs, ms) of ``rows`` (.., centre, sid, text)."""
    def links(group):
        sets = [shingles(t, shingle) for t in group["text"].to_pylist()]
        found = exact_links(sets, group["centre"].to_numpy(zero_copy_only=False), percent)
        sid = group["sid"].to_pylist()
        return [(sid[a], sid[b]) for a, b in found]

    def batch_of(pairs):
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["a", "b"])

    def each(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            root, cs, ms = (t[c].to_pylist() for c in ("root", "cs", "ms"))
            cut = [0, *[i for i in range(1, len(t)) if (ms[i], cs[i], root[i]) != (ms[i - 1], cs[i - 1], root[i - 1])]]
            yield batch_of([p for i, j in zip(cut, cut[1:]) for p in links(t.slice(i, j - i))])
            held = t.slice(cut[-1])
        if held is not None and len(held):
            yield batch_of(links(held))

    keys = ["root", "cs", "ms"]
    rows = rows.repartition(parallelism(rows.sparkSession), *keys).sortWithinPartitions(*keys, F.desc("centre"), "sid")
    return rows.select(*keys, "centre", "sid", "text").mapInArrow(each, "a binary, b binary")


def _in_blocks(members: DataFrame, centres: DataFrame, block: int, weight: int) -> DataFrame:
    """Rows for ``_verified``: every centre (root, sid) with every member (root, sid, n, text) of its component, in slices."""
    def slices(df, name):
        n = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / weight)).cast("int")
        return df.groupBy("root").agg(n.alias(name))
    c = members.join(centres.select("root", "sid"), ["root", "sid"], "left_semi")
    cuts = slices(c.drop("text"), "n_cs").join(slices(members.drop("text"), "n_ms"), "root")
    cs, ms = (F.pmod(F.xxhash64(F.lit(s), "sid"), F.col(f"n_{s}")).cast("int").alias(s) for s in ("cs", "ms"))
    every = lambda s: F.explode(F.sequence(F.lit(0), F.col(f"n_{s}") - 1)).alias(s)
    a = c.join(cuts, "root").select("root", cs, every("ms"), F.lit(True).alias("centre"), "sid", "text")
    b = members.join(cuts, "root").select("root", every("cs"), ms, F.lit(False).alias("centre"), "sid", "text")
    return a.unionByName(b)


def _sets(docs: DataFrame, shingle: int, bands: int) -> DataFrame:
    """(doc_id, k1, k2, n, sid, buckets, sketch) of every row; sid names the set, null if it is empty."""
    d = docs.select("doc_id", *row_key(F.col("doc_id"), F.col("text")), "text")
    schema = T.StructType([*d.schema.fields[:3], T.StructField("n", T.LongType()), T.StructField("sid", T.BinaryType()),
                           T.StructField("buckets", T.ArrayType(T.LongType())), T.StructField("sketch", T.ArrayType(T.LongType()))])
    m = max(SKETCH, bands * BAND)

    def lists(x: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(np.ascontiguousarray(x).view(np.int64).ravel()))

    def each(batches):
        for batch in batches:
            sets = [shingles(t, shingle) for t in batch.column(3).to_pylist()]
            values = signatures(sets, m)
            sid = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array([len(s) for s in sets], pa.int64()), pa.array(sid, pa.binary()),
                lists(_buckets(values[:, :bands * BAND])), lists(_sketches(values))], schema.fieldNames())

    return d.mapInArrow(each, schema)


def superminhash(docs: DataFrame, shingle: int = 5, percent: int = 80, limit: int = LIMIT, block: int = BLOCK, weight: int = WEIGHT) -> DataFrame:
    """(doc_id, k1, k2, n_shingles, root, component_id, kept) of every row; k1, k2 name the row by doc_id and text.

    Rows are linked whose shingle sets have ``percent`` hundredths of their union
    in common, or more.  root names the component, component_id is its smallest
    doc_id (null if it has none) and kept says whether that is the row's own (null
    ids equal each other).  Null, empty and blank texts have no shingles: root is
    null, component_id the row's own id, and they are kept.  Repeated rows give
    repeated rows; an empty table gives an empty one; other columns are ignored.
    """
    bands = bands_of(percent)
    sets = stage(_sets(docs, shingle, bands), "sets")
    nodes = stage(sets.where("n > 0").groupBy("sid").agg(
        F.min("doc_id").alias("low"), F.min(F.struct("k1", "k2")).alias("of"), F.first("n").alias("n"),
        F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch")), "nodes")
    tree = components(_candidates(nodes, percent, limit))
    tree = stage(tree.union(tree.select("b", "b").distinct()).toDF("sid", "root"), "candidates")
    own = tree.join(nodes.select("sid", "n", "of.k1", "of.k2"), "sid")
    text = docs.select(*row_key(F.col("doc_id"), F.col("text")), "text").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    members = stage(own.join(text, ["k1", "k2"]).select("root", "sid", "n", "text"), "members")
    size = stage(members.groupBy("root").agg(F.count("*").alias("size"), F.sum("n").alias("weight")), "sizes")
    fits = (F.col("size") <= block) & (F.col("weight") <= weight)
    small = members.join(size.where(fits).select("root"), "root", "left_semi")
    links = stage(_verified(small.select("root", F.lit(0).alias("cs"), F.lit(0).alias("ms"), F.lit(True).alias("centre"), "sid", "text"),
                            shingle, percent), "links")
    over = size.where(~fits)
    if not over.isEmpty():
        large = stage(members.join(over.select("root", "size"), "root"), "large")
        some = large.where((F.col("sid") == F.col("root")) | (F.pmod(F.xxhash64("sid"), F.ceil(F.col("size") / 8)) == 0))
        seen = stage(_verified(_in_blocks(large, some, block, weight), shingle, percent), "links")
        group = components(seen).toDF("sid", "label")
        named = stage(large.select("root", "sid").join(group, "sid", "left").select("root", "sid", F.coalesce("label", "sid").alias("label")), "labels")
        most = named.groupBy("root", "label").count().groupBy("root").agg(F.max(F.struct("count", "label")).alias("m"))
        rest = stage(named.join(most.select("root", "m.label"), ["root", "label"], "left_anti"), "rest")
        links = links.union(seen).union(stage(_verified(_in_blocks(large, rest, block, weight), shingle, percent), "links"))
    final = components(links).toDF("sid", "root")
    rooted = stage(nodes.select("sid", "low").join(final, "sid", "left").select("sid", "low", F.coalesce("root", "sid").alias("root")), "rooted")
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    label = stage(rooted.join(low, "root").select("sid", "root", "component_id"), "labels")
    out = sets.select("doc_id", "k1", "k2", F.col("n").alias("n_shingles"), "sid").join(label, "sid", "left")
    own_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "k1", "k2", "n_shingles", "root", own_id.alias("component_id"),
                      F.col("doc_id").eqNullSafe(own_id).alias("kept"))
