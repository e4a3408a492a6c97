"""Best-fit packing of documents into sequences, after Martello-Toth reduction.

Only a longer document is cut, into pieces of ``capacity`` tokens.  Bin packing
depends on lengths alone, and there are at most ``capacity`` of them, so the
plan is made on the counts per length: its size is bounded by the capacity, not
by the documents.

1. One task pass encodes the texts, cuts pieces and numbers those of a length
   inside the task.
2. ``plan`` reads the histogram: for the longest piece in turn, a set of at most
   three pieces that provably dominates all other sets with it is fixed as a
   sequence of its own, for as many copies at once as the proof holds for; what
   is left is packed best-fit, longest first, again whole runs of equal pieces.
   It returns runs: a pattern of lengths, repeated in so many sequences.
3. A piece's rank among those of its length (number in its task plus the counts
   of earlier tasks) picks its run, sequence and place by binary search.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegraph.llm.common import stage
from sitegraph.llm import tokens
from sitegraph.llm.tokens import default_path, read_definition

#: A run: ((length, copies), ...) of one sequence, and how many sequences look so.
Run = tuple[tuple[tuple[int, int], ...], int]


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


class _Counts:
    """Pieces left of each length, with the few order queries that the reduction asks."""

    def __init__(self, histogram: dict[int, int]):
        self.n = {w: c for w, c in histogram.items() if c > 0}
        self.lengths = sorted(self.n)

    def take(self, need: dict[int, int], times: int) -> None:
        for w, c in need.items():
            self.n[w] -= c * times
            if not self.n[w]:
                del self.n[w]
                self.lengths.pop(bisect.bisect_left(self.lengths, w))

    def largest(self, most: int) -> int | None:
        i = bisect.bisect_right(self.lengths, most)
        return self.lengths[i - 1] if i else None

    def smallest(self, k: int, over: int = 0) -> list[int]:
        """The k smallest pieces longer than ``over`` (fewer if there are not so many)."""
        out: list[int] = []
        for w in self.lengths[bisect.bisect_right(self.lengths, over):]:
            out += [w] * min(k - len(out), self.n[w])
            if len(out) == k:
                break
        return out

    def best_pair(self, most: int) -> tuple[int, int] | None:
        """Two pieces a >= b of the largest sum that is at most ``most``."""
        best, lo, hi = None, 0, bisect.bisect_right(self.lengths, most) - 1
        while lo <= hi:
            a, b = self.lengths[hi], self.lengths[lo]
            if a + b > most or (lo == hi and self.n[a] < 2):
                hi -= 1
                continue
            if best is None or a + b > sum(best):
                best = (a, b)
            lo += 1
        return best


def _dominating(left: _Counts, j: int, capacity: int) -> list[int] | None:
    """Pieces that, with one of length j, dominate every other set with j; None if none of at most two does.

    ``left`` is without that piece.
    """
    free = capacity - j
    few = left.smallest(3)
    if not few or few[0] > free:
        return []
    top = left.largest(free)
    if top == free or len(few) < 2 or few[0] + few[1] > free:
        return [top]
    if len(few) == 3 and sum(few) <= free:
        return None
    a, b = left.best_pair(free)
    if top >= a + b:
        return [top]
    nearer = left.smallest(2, over=b)
    if top == a and (len(nearer) < 2 or sum(nearer) > free):
        return [a, b]
    return None


def plan(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Runs that together hold each piece of ``histogram`` (length to count) once."""
    left, runs = _Counts(histogram), []
    for j in sorted(left.n, reverse=True):  # dominance reduction
        while j in left.n:
            left.take({j: 1}, 1)
            others = _dominating(left, j, capacity)
            if j not in left.n:
                bisect.insort(left.lengths, j)
                left.n[j] = 0
            left.n[j] += 1
            if others is None:
                break
            need: dict[int, int] = {}
            for w in (j, *others):
                need[w] = need.get(w, 0) + 1
            times = min(left.n[w] // c for w, c in need.items())
            left.take(need, times)
            runs.append((tuple(need.items()), times))
    space: dict[int, list[Run]] = {}  # best-fit: open runs by what is free in each sequence
    frees: list[int] = []

    def put(free: int, run: Run) -> None:
        if free not in space:
            bisect.insort(frees, free)
            space[free] = []
        space[free].append(run)

    for w in reversed(left.lengths):
        n = left.n[w]
        while n:
            i = bisect.bisect_left(frees, w)
            if i < len(frees):
                free = frees[i]
                pattern, m = space[free].pop()
                if not space[free]:
                    del space[free]
                    frees.pop(i)
            else:
                free, pattern = capacity, ()
                m = -(-n // (capacity // w))
            k = free // w
            full = min(m, n // k)
            rest = min(n - full * k, k - 1) if full < m else 0
            if full:
                put(free - k * w, (pattern + ((w, k),), full))
            if rest:
                put(free - rest * w, (pattern + ((w, rest),), 1))
            if m - full - (rest > 0):
                put(free, (pattern, m - full - (rest > 0)))
            n -= full * k + rest
    return runs + [r for rs in space.values() for r in rs]


def slots(runs: list[Run]) -> tuple[np.ndarray, ...]:
    """Arrays sorted by (length, first rank): length, lo, copies, first sequence, offset."""
    rows, rank, first = [], {}, 0
    for pattern, m in runs:
        offset = 0
        for w, k in pattern:
            lo = rank.get(w, 0)
            rows.append((w, lo, k, first, offset))
            rank[w] = lo + k * m
            offset += w * k
        first += m
    a = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return tuple(a.T.copy())


def pieces(docs: DataFrame, definition: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth) and ids if asked: the pieces of every document.

    task and nth number the pieces of one length; they hold for the staged
    table that one run of the tasks has written.
    """
    from pyspark.sql import types as T
    packet = docs.sparkSession.sparkContext.broadcast(definition)
    doc_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", doc_type), T.StructField("piece", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")],
                           T.StructField("task", T.IntegerType()), T.StructField("nth", T.LongType()),
                           *([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else [])])

    def cut(batches):
        encoder, task, seen = tokens.encoder(packet.value), TaskContext.get().partitionId(), {}
        end = np.array([end_id], np.int64)
        for batch in batches:
            out = {f.name: [] for f in schema.fields}
            for key, ids in zip(batch.column(0).to_pylist(), encoder.ids(batch.column(1).to_pylist())):
                ids = np.concatenate([ids.astype(np.int64), end])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    n = len(part)
                    nth = seen[n] = seen.get(n, -1) + 1
                    for name, v in zip(out, (key, piece, start, n, crc32(part), task, nth, part)):
                        out[name].append(v)
            types = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(),
                     pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, capacity: int = 4096,
         with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) and ids if asked, for every piece.

    ``docs`` needs doc_id and text; other columns are ignored.  A null or empty
    text is a document of its end id alone.  Repeated rows are documents of
    their own.  A null doc_id stays null.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    definition = read_definition(tokenizer or default_path("word_bpe_49k.json"))
    p = stage(pieces(docs, definition, end_id, capacity, with_ids), "pieces")
    counts = stage(p.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    table = spark.sparkContext.broadcast(slots(plan(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = stage(counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "piece-bases")
    ranked = p.join(base, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth")).drop("base", "nth", "task")

    def place(batches):
        length, lo, copies, first, offset = table.value
        step = np.int64(1) << np.int64(48)
        keys = length * step + lo
        for batch in batches:
            n = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            i = np.searchsorted(keys, n * step + rank, "right") - 1
            q, r = np.divmod(rank - lo[i], copies[i])
            keep = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(first[i] + q), pa.array(offset[i] + r * n)],
                                             [*keep, "sequence_id", "offset"])

    schema = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")
    out = ranked.mapInArrow(place, schema)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))
