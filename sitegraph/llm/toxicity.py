"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words (letters only, lower case) and the first
four and five letters of longer words, hashed to ``2 ** BITS`` numbers.  The
machine's score is

    w0 + sum_i w_i a_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

so that terms that are harmless alone can add up by pairs.  x_i falls with the
term's share of the sample, so words that all texts have say less.  a_i, which scales
the weight alone, is near one for a term whose share of label 1 is far from chance and
near zero for others: of tens of thousands of terms most would only fit noise.

Every term that stands in more than ``RARE`` sampled texts has weights of its own,
also one that says nothing alone, as it may be half of a pair.

Fitting takes at most ``SAMPLE`` labelled ids, those of the smallest id hash,
so the sample is bounded, the same on every run and spread over the table; it
is joined to the texts by a broadcast that this bound covers.  An id that stands on
many rows gives one text.  Hashed terms, never texts, come to the driver, and numpy
fits there.  Scoring is one pass
over all texts with the model (bounded by its number of terms) broadcast.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 20
#: Most labelled rows that a model is fitted on.
SAMPLE = 12_000
#: Sampled texts that a term must exceed to be in the model.
RARE = 4
#: Mini-batches that a fit goes through (ten epochs at least).
STEPS = 700
#: Weight of a term that all texts have; one that no other text has weighs 1.
FLOOR = 0.3
#: Terms of texts that are scored together, which bounds what a worker holds.
TOGETHER = 200_000
#: Words whose term numbers a worker keeps.
CACHE = 300_000
_WORD = re.compile(r"[^\W\d_]+")


class Hasher:
    """Term numbers of texts."""

    def __init__(self):
        self._kept: dict[str, tuple[int, ...]] = {}

    def _of(self, word: str) -> tuple[int, ...]:
        terms = [word, *("^" + word[:k] for k in (4, 5) if len(word) > k)]
        return tuple(zlib.crc32(t.encode()) & ((1 << BITS) - 1) for t in terms)

    def terms(self, text: str | None) -> np.ndarray:
        kept = self._kept
        if len(kept) > CACHE:
            kept.clear()
        out: set[int] = set()
        for w in set(_WORD.findall((text or "").lower())):
            t = kept.get(w)
            if t is None:
                t = kept[w] = self._of(w)
            out.update(t)
        return np.array(sorted(out), np.int32)


@dataclass
class Model:
    """slot: place of a term number in w, v and x (-1: not in the model); own: scale of its weight alone."""

    slot: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray
    x: np.ndarray
    own: np.ndarray

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Probability of label 1 for each text's term numbers; texts of about ``TOGETHER`` terms at a time."""
        ends = np.cumsum([len(t) for t in texts])
        cuts = np.searchsorted(ends, np.arange(TOGETHER, ends[-1] + 1, TOGETHER) if len(texts) else []) + 1
        out = []
        for i, j in zip([0, *cuts], [*cuts, len(texts)]):
            some = texts[i:j]
            at = self.slot[np.concatenate([*some, np.zeros(0, np.int32)])]
            row = np.repeat(np.arange(len(some)), [len(t) for t in some])[at >= 0]
            out.append(self._raw(row, at[at >= 0], len(some)))
        return 1 / (1 + np.exp(-np.clip(np.concatenate(out), -40, 40)))

    def _raw(self, row: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        x = self.x[at]
        out = self.w0 + np.bincount(row, self.w[at] * self.own[at] * x, n)
        for f in range(self.v.shape[1]):
            vx = self.v[at, f] * x
            out += 0.5 * (np.bincount(row, vx, n) ** 2 - np.bincount(row, vx * vx, n))
        return out


def fit(texts: list[np.ndarray], labels: np.ndarray, factors: int = 4, epochs: int | None = None, batch: int = 256,
        rate: float = 0.1, l2: float = 1e-5, kv: float = 5.0, seed: int = 7) -> Model:
    """Logistic loss, mini-batches with AdaGrad, ``STEPS`` of them unless ``epochs`` says otherwise.  With labels of one
    kind only, or none, the prior decides."""
    n = len(texts)
    zeros = np.zeros(0, np.int32)
    df = np.bincount(np.concatenate([*texts, zeros]), minlength=1 << BITS).astype(float)
    chosen = np.flatnonzero(df > RARE)
    slot = np.full(1 << BITS, -1, np.int32)
    slot[chosen] = np.arange(len(chosen))
    rng = np.random.default_rng(seed)
    positive = float(labels.sum())
    w0 = math.log((positive + 0.5) / (n - positive + 0.5)) if n else 0.0
    share = positive / n if n else 0.0
    df = df[chosen]
    with_label = np.bincount(np.concatenate([*(t for t, y in zip(texts, labels) if y), zeros]), minlength=1 << BITS)[chosen]
    # how far the label's count among a term's texts is from chance, in standard deviations (5 texts more at chance)
    apart = np.abs(with_label - share * df) / np.sqrt(share * (1 - share) * (df + 5) + 1e-9)
    chance = math.sqrt(2 * math.log(len(chosen) + 2))  # as far as the farthest of so many terms is by chance
    m = Model(slot, w0, np.zeros(len(chosen)), rng.normal(0, 0.02, (len(chosen), factors)),
              FLOOR + (1 - FLOOR) * np.log((n + 1) / (df + 0.5)) / math.log(n + 2), 1 / (1 + np.exp(-2 * (apart - chance))))
    if not n or positive in (0, n) or not len(chosen):
        return m
    shrink = np.minimum(0.2, kv / df)  # what few texts say of pairs counts little
    gw, gv, g0 = np.full(m.w.shape, 1e-2), np.full(m.v.shape, 1e-2), 1e-2
    batches, order = [], rng.permutation(n)
    for lo in range(0, n, batch):  # the same batches in every epoch, in another order; small numbers, as all are kept
        pick = order[lo:lo + batch]
        held = [s[s >= 0] for s in (slot[texts[i]] for i in pick)]
        at = np.concatenate(held)
        used, place = np.unique(at, return_inverse=True)
        batches.append((pick, at, np.repeat(np.arange(len(pick), dtype=np.int16), [len(h) for h in held]), used, place.astype(np.int32)))
    for _ in range(epochs or max(10, -(-STEPS // len(batches)))):
        for b in rng.permutation(len(batches)):
            pick, at, row, used, place = batches[b]
            x = m.x[at]
            p = 1 / (1 + np.exp(-np.clip(m._raw(row, at, len(pick)), -40, 40)))
            err = p - labels[pick]
            g = m.own[used] * np.bincount(place, err[row] * x) / len(pick) + l2 * m.w[used]
            gw[used] += g * g
            m.w[used] -= rate * 5 * g / np.sqrt(gw[used])
            for f in range(factors):
                vx = m.v[at, f] * x
                total = np.bincount(row, vx, len(pick))
                g = np.bincount(place, err[row] * x * (total[row] - vx)) / len(pick) + shrink[used] * m.v[used, f]
                gv[used, f] += g * g
                m.v[used, f] -= rate * g / np.sqrt(gv[used, f])
            g = err.mean()
            g0 += g * g
            m.w0 -= rate * g / math.sqrt(g0)
    return m


def is_held_out(doc_id: Column) -> Column:
    """Rows that no model learns from."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled ids that are not held out, one text each.

    Of repeated labels of a document the largest counts, of several texts of one id the
    least; null ids or labels are left out.
    """
    lab = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).dropna()
    lab = lab.where(~is_held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    lab = lab.withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(sample)
    d = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(lab), "id")
    d = d.groupBy("h", "id", "y").agg(F.min("text").alias("text"))

    def hashed(batches):
        hasher = Hasher()
        for b in batches:
            terms = pa.array([hasher.terms(t) for t in b.column(3).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.string()), b.column(2), terms], ["h", "id", "y", "terms"])

    got = d.mapInArrow(hashed, "h bigint, id string, y int, terms array<int>").toArrow()
    got = got.sort_by([("h", "ascending"), ("id", "ascending")]).combine_chunks()
    terms = got["terms"].chunk(0) if len(got) else pa.array([], pa.list_(pa.int32()))
    ends, values = terms.offsets.to_numpy(), terms.values.to_numpy()  # views: the texts' terms are held once
    return fit([values[i:j] for i, j in zip(ends[:-1], ends[1:])], got["y"].to_numpy().astype(float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the column score added (one of that name is replaced); a text without known terms gets the prior."""
    packet = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.drop("score")
    text = d.columns.index("text")
    schema = T.StructType([*d.schema.fields, T.StructField("score", T.DoubleType())])

    def each(batches):
        hasher = Hasher()
        for b in batches:
            texts = [hasher.terms(t) for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(packet.value.score(texts), pa.float64())], schema.fieldNames())

    return d.mapInArrow(each, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` with held_out, score and predicted added (columns of these names are replaced).

    Null and empty texts are scored as texts without terms.  Repeated rows each
    get the score.  Without labels every score is the prior of one half.
    """
    d = docs.drop("held_out", "predicted")
    out = score(d, train(docs, labels))
    return out.withColumns({"held_out": is_held_out(F.col("doc_id")), "predicted": (F.col("score") >= threshold).cast("int")})
