"""SimHash near-dedup with bit-sliced comparison.

1. A fingerprint per document; distinct fingerprints go on.
2. The 64 bits are cut into blocks.  Two fingerprints at most ``radius`` bits
   apart agree in all but ``radius`` blocks, so each is filed under every choice
   of the others (more blocks, hence longer keys, the more fingerprints).
3. The fingerprints of a key are compared bit-sliced: one bit plane for each of
   the 64 bits, packed 64 fingerprints to a word.  A plane and itself moved by d
   give, by xor, one bit of the distances of all pairs (i, i + d); carry-save
   counters add the planes up for 64 pairs an operation, and words in which all
   pairs exceed the radius are dropped on the way.
4. Each key gives only a spanning forest of its links; components are joined
   over all keys.

A key of more than ``LIMIT`` distinct fingerprints is compared exactly by another way, whose
groups are bounded by the width of a fingerprint: fingerprints at most two bits
apart have a common neighbour at most one bit from either.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegraph.llm.common import free_names, parallelism, row_key, stage
from sitegraph.llm.components import components

SEED = 42
#: Distinct fingerprints of a key that one task compares with each other.
LIMIT = 4096
#: Rows of a partition that are compared at once, cut between keys.
ROWS = 200_000
#: Bit planes between two looks for words that can be dropped.
LOOK = 8


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the text's word shingles, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    h = [xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in zip(starts.tolist(), ends[k - 1:].tolist())]
    bits = np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, k1, k2, fp): fp as a signed long."""
    from pyspark.sql import types as T
    d = docs.select("doc_id", *row_key(F.col("doc_id"), F.col("text")), "text")
    schema = T.StructType([*d.schema.fields[:3], T.StructField("fp", T.LongType())])

    def each(batches):
        for batch in batches:
            fp = np.array([fingerprint(t, shingle) for t in batch.column(3).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fp)], schema.fieldNames())

    return d.mapInArrow(each, schema)


def block_masks(n: int, radius: int) -> list[int]:
    """Masks of the bits that make each key: long enough that chance alone puts few of ``n`` under one key."""
    for blocks in range(radius + 1, 17):
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        each = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
        masks = [sum(c) for c in itertools.combinations(each, blocks - radius)]
        if n < 64 << min(m.bit_count() for m in masks):
            break
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class _Planes:
    """Bit planes of fingerprints; compares those that stand d apart."""

    def __init__(self, fps: np.ndarray):
        self.words = -(-len(fps) // 64)
        at = np.zeros(self.words * 64, np.uint64)
        at[:len(fps)] = fps
        bits = np.unpackbits(at.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
        self.planes = np.concatenate([planes, np.zeros((64, self.words + 2), np.uint64)], axis=1)

    def within(self, d: int, valid: np.ndarray, radius: int) -> np.ndarray:
        """Positions i where valid[i] and i is at most ``radius`` bits from i + d."""
        ok = np.zeros(self.words * 64, bool)
        ok[:len(valid)] = valid
        over = ~np.packbits(ok, bitorder="little").view("<u8")
        live = np.flatnonzero(~over)
        over = over[live]
        q, r = divmod(d, 64)
        width = (radius + 1).bit_length()
        counter = [np.zeros(len(live), np.uint64) for _ in range(width)]
        for first in range(0, 64, LOOK):
            for plane in self.planes[first:first + LOOK]:
                moved = plane[live + q] >> np.uint64(r)
                if r:
                    moved = moved | (plane[live + q + 1] << np.uint64(64 - r))
                carry = plane[live] ^ moved
                for i in range(width):  # carry-save: add one bit to 64 counters
                    counter[i], carry = counter[i] ^ carry, counter[i] & carry
                at_limit = ~np.zeros(len(live), np.uint64)
                for i in range(width):
                    at_limit &= counter[i] if (radius + 1) >> i & 1 else ~counter[i]
                over = over | at_limit
            stay = np.flatnonzero(~over)
            if len(stay) < len(live):
                live, over, counter = live[stay], over[stay], [c[stay] for c in counter]
            if not len(live):
                return live
        bits = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        i, j = np.nonzero(bits)
        return live[i] * 64 + j


def _union(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of a and b; ``root`` points at roots before and after."""
    while True:
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            return
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def linked(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (a, b) between fingerprints of equal keys; equal keys stand together."""
    if not len(fps):
        return fps, fps
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.concatenate([first, [len(keys)]]))
    order = np.argsort(-size, kind="stable")
    size, first = size[order], first[order]
    keep = size > 1
    size, first = size[keep], first[keep]
    if not len(size):
        return fps[:0], fps[:0]
    begin = np.cumsum(size) - size
    left = np.repeat(begin + size, size) - np.arange(size.sum())  # rows from here to the end of the key
    fps = fps[np.repeat(first - begin, size) + np.arange(size.sum())]
    planes, root = _Planes(fps), np.arange(len(fps))
    for d in range(1, int(size[0])):
        n = int(size[size > d].sum())  # the larger keys come first
        hit = planes.within(d, left[:n] > d, radius)
        if len(hit):
            _union(root, hit, hit + d)
    tied = np.flatnonzero(root != np.arange(len(root)))
    return fps[tied], fps[root[tied]]


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """(a, b): links whose components are those of all links of at most ``radius`` bits. ``nodes``: distinct fp."""
    n = nodes.count()
    masks = block_masks(n, radius)
    keyed = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("v")) for i, mask in enumerate(masks)])).alias("k"))
    keyed = keyed.select("k.m", "k.v", "fp")
    crowded = stage(keyed.groupBy("m", "v").agg(F.count("*").alias("n")).where(F.col("n") > LIMIT).select("m", "v"), "crowded")
    few = keyed.join(crowded, ["m", "v"], "left_anti").repartition(parallelism(nodes.sparkSession), "m", "v").sortWithinPartitions("m", "v")

    def compare(batches):
        held = []
        def done(table):
            keys = np.rec.fromarrays([table["m"].to_numpy(), table["v"].to_numpy()], names="m,v")
            a, b = linked(keys, table["fp"].to_numpy().view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= ROWS:
                table = pa.Table.from_batches(held)
                m, v = table["m"].to_numpy(), table["v"].to_numpy()
                cut = len(m) - int(np.argmin(((m == m[-1]) & (v == v[-1]))[::-1])) if (m[0], v[0]) != (m[-1], v[-1]) else 0
                if cut:
                    yield done(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                rows = len(m) - cut
        if rows:
            yield done(pa.Table.from_batches(held))

    out = few.select("m", "v", "fp").mapInArrow(compare, "a bigint, b bigint")
    # crowded keys: each fingerprint under every value at most half the radius away
    half = -(-radius // 2)
    flips = [_signed(sum(1 << i for i in c)) for k in range(half + 1) for c in itertools.combinations(range(64), k)]
    many = keyed.join(crowded, ["m", "v"], "left_semi").select("fp").distinct()
    near = many.select("fp", F.explode(F.transform(F.lit(flips), lambda x: x.bitwiseXOR(F.col("fp")))).alias("x"))
    groups = near.groupBy("x").agg(F.collect_set("fp").alias("g")).where("size(g) > 1")  # at most len(flips) each
    pairs = groups.select(F.explode("g").alias("a"), "g").select(
        "a", F.explode(F.array(F.array_min("g")) if radius % 2 == 0 else F.col("g")).alias("b")).where("a > b")
    return out.union(pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))


def simhash(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, k1, k2, fp, root, component_id) of every row; k1, k2 name the row by doc_id and text.

    Null and empty texts have the fingerprint zero and link like any other.
    root, the smallest fingerprint of the component, names it; component_id is
    its smallest doc_id, a label only (null if it has none, and not its own if
    unlike texts repeat one doc_id).
    Repeated rows give repeated rows.  Other columns are ignored.
    """
    fps = stage(fingerprints(docs, shingle), "fingerprints")
    nodes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    tree = components(links(nodes.select("fp"), radius))
    rooted = nodes.join(tree.toDF("fp", "root"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    rooted = stage(rooted, "rooted")
    low = stage(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "component-ids")
    label = stage(rooted.join(low, "root").select("fp", "root", "component_id"), "labels")
    return fps.join(label, "fp").select("doc_id", "k1", "k2", "fp", "root", "component_id")


def near_dedup(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id, then the smallest row key; repeated rows once."""
    s = simhash(docs, shingle, radius)
    first = s.groupBy("root").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("r"))
    keep = stage(first.select("r.k1", "r.k2").distinct(), "kept")
    k1, k2 = row_key(F.col("doc_id"), F.col("text"))
    own, names = docs.columns, free_names(docs, "__k1", "__k2")
    out = docs.withColumns(dict(zip(names, (k1, k2)))).join(keep.toDF(*names), names)
    return out.dropDuplicates(names).select(*own)
