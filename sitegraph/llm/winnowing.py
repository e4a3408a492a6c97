"""Document fingerprints by winnowing.

Every run of ``k`` code points has a rolling hash; of each ``window`` runs that
follow each other the smallest hash is kept, the rightmost one on ties, once
per position.  Two texts that share ``k + window - 1`` code points share a kept
hash.  A text of fewer than ``k`` code points has one hash, that of all of it;
one with fewer runs than a window is one window; the empty text has none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegraph.llm.common import parallelism

K, WINDOW = 12, 32
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hash of every run of k values: a polynomial modulo 2**64, doubled up, then mixed."""
    power = points.astype(np.uint64) * _A
    power ^= power >> np.uint64(29)
    total, length, size, base = None, 0, 1, _B
    while k:
        if k & 1:
            if total is None:
                total, length = power, size
            else:
                n = len(points) - length - size + 1
                total = total[:n] * base + power[length:length + n]
                length += size
        k >>= 1
        if k:
            n = len(power) - size
            power = power[:n] * base + power[size:size + n]
            base, size = base * base, size * 2
    total = (total ^ (total >> np.uint64(31))) * _B
    return total >> np.uint64(32)


def window_minima(h: np.ndarray, window: int) -> np.ndarray:
    """Positions of the rightmost minimum of every window, each once."""
    n = len(h)
    key = (h << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    if n <= window:
        low = key.min(keepdims=True)
    else:
        rows = np.concatenate([key, np.full(-n % window, ~np.uint64(0))]).reshape(-1, window)
        before = np.minimum.accumulate(rows, axis=1).ravel()
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        low = np.minimum(after[:n - window + 1], before[window - 1:n])
        low = low[np.concatenate([[True], low[1:] != low[:-1]])]
    return (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64)


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of a text, in order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        h = gram_hashes(points, min(k, len(points)))
    at = window_minima(h, window)
    return h[at], at


def unmoved(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> int:
    """Fingerprints of two texts with one hash at one position."""
    _, i, j = np.intersect1d(a_at, b_at, assume_unique=True, return_indices=True)
    return int((a[i] == b[j]).sum())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sets of hashes; two empty ones are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = len(a) + len(b) - len(np.union1d(a, b))
    return common / (len(a) + len(b) - common)


def as_string(h: np.ndarray) -> str:
    return h.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """``docs`` with hashes and positions (arrays) added; null text counts as empty; columns of these names are replaced."""
    d = docs.drop("hashes", "positions")
    text = d.columns.index("text")
    schema = T.StructType([*d.schema.fields, T.StructField("hashes", T.ArrayType(T.LongType())),
                           T.StructField("positions", T.ArrayType(T.LongType()))])

    def each(batches):
        for b in batches:
            got = [winnow(t or "", k, window) for t in b.column(text).to_pylist()]
            more = [pa.array([np.asarray(g[i], np.int64) for g in got], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], schema.fieldNames())

    return d.mapInArrow(each, schema)


def _slot(table: Column, size: int, key: Column) -> Column:
    """Index of the last of the ``size`` ascending limits in ``table`` that is at most ``key`` (0 below all), by halving steps."""
    at = F.lit(0)
    step = 1 << (size - 1).bit_length() >> 1
    steps = []
    while step:
        steps.append(step)
        step >>= 1
    if not steps:
        return at
    return F.aggregate(F.lit(steps), at, lambda lo, s: F.when(
        (lo + s < size) & (F.get(table, lo + s) <= key), lo + s).otherwise(lo))


def _neighbours(docs: DataFrame) -> DataFrame:
    """(bucket, guest, doc_id, text): ranges of doc_id, descending, each with the first row of the next range as guest."""
    spark = docs.sparkSession
    n = parallelism(spark)
    # ascending it is the order backwards: nulls are least, and of one id the text of the greatest hash comes first
    place = F.struct(F.col("doc_id").alias("id"), F.bitwise_not(F.xxhash64("text")).alias("h"))
    ids = docs.select(place.alias("sid")).repartitionByRange(8 * n, "sid")
    ranges = ids.groupBy(F.spark_partition_id().alias("p")).agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).orderBy("lo")
    ranges = [(tuple(r["lo"]), tuple(r["hi"])) for r in ranges.select("lo", "hi").collect()]  # two places a range
    if not ranges:
        return docs.select(F.lit(0).alias("bucket"), F.lit(False).alias("guest"), "doc_id", "text")
    m = len(ranges)
    kind = docs.schema["doc_id"].dataType
    def places(of: list) -> Column:
        return F.array(*[F.struct(F.lit(i).cast(kind).alias("id"), F.lit(h).cast("bigint").alias("h")) for i, h in of])
    d = docs.select("doc_id", "text", place.alias("sid"))
    d = d.withColumn("b", _slot(places([lo for lo, _ in ranges]), m, F.col("sid")))
    own = F.struct(F.col("b").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(((F.col("b") + 1) % m).alias("bucket"), F.lit(True).alias("guest"))
    last = F.get(places([hi for _, hi in ranges]), F.col("b")) == F.col("sid")
    d = d.select("doc_id", "text", "sid", F.explode(F.when(last, F.array(own, guest)).otherwise(F.array(own))).alias("to"))
    d = d.select("to.bucket", "to.guest", "doc_id", "text", "sid")
    return d.repartition(n, "bucket").sortWithinPartitions("bucket", "guest", F.desc("sid")).select("bucket", "guest", "doc_id", "text")


def edited_likeness(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, unmoved) of every row.

    unmoved counts the fingerprints that the edited text has at the same positions: where it agrees with the text.

    The edited text is the text with its last floor(n/2) code points replaced
    by the first as many (or all) of the next document's.  Documents follow
    each other by descending doc_id, null last, rows of one doc_id by the hash
    of their text; after the last comes the first, a single row after itself.
    Null text counts as empty; other columns are ignored.  Empty tables give
    empty results.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_chars", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                           *[T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")], T.StructField("unmoved", T.LongType())])

    def each(batches):
        held = None  # (bucket, guest, doc_id, text, hashes, positions): waits for the row after it
        for batch in batches:
            out = [[] for _ in schema.fields]
            for bucket, guest, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if guest and (held is None or held[1] or held[0] != bucket):
                    continue
                text = text or ""
                row = (bucket, guest, key, text, *winnow(text, k, window))
                if held and not held[1]:
                    cut = len(held[3]) // 2
                    edited = held[3][:len(held[3]) - cut] + text[:cut]
                    other, at = winnow(edited, k, window)
                    values = (held[2], len(held[3]), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_string(held[4]),
                              as_string(other), likeness(held[4], other), likeness(held[4], row[4]),
                              unmoved(held[4], held[5], other, at))
                    for column, v in zip(out, values):
                        column.append(v)
                held = row
            types = [batch.schema.field(2).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], schema.fieldNames())

    return _neighbours(docs).mapInArrow(each, schema)
