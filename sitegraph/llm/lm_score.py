"""Masked pseudo-likelihood of documents by a bidirectional window network.

Words (lower-cased A-Z, split at ASCII white space) are counted over all documents;
the counts of the full words, by 64-bit hash, are a Spark table that grows with the
corpus.  A word's probability given the ``SIDE`` words on each side of it is

    P(class | neighbours) * P(ending | class, neighbours) * count / count of (class, ending)

- the class is a word's place by frequency: ``CLASSES`` runs of the frequency order of about
  equal weight, so the most frequent words stand alone; the last class has all words
  beyond the ``KNOWN`` most frequent ones;
- the ending is one of ``ENDINGS`` groups of a word's last two bytes;
- both softmaxes see the neighbours: one hidden layer, tanh of the sum of a vector for each
  neighbour's place and class and one for its place and ending; the second adds a bias
  of the class.

So every word has a context of its own kind and, in the last factor, its own count.  The
known words' counts are bounded by a parameter and broadcast; those of the others are
joined from the table.

Every word is numbered once, into a table that both training and scoring read.  The
network sees every document once.  Documents are dealt by a hash of the row to
groups of about ``GROUP`` words, and to ``ROUNDS`` rounds.  In a round every group
learns from the same weights on, through its documents in the order of their hashes;
Spark averages the groups' weights by words.  What a group is depends on the corpus
alone, so neither files nor partitions nor executors change the scores.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Collection, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegraph.llm.common import free_names, parallelism, row_key, stage

#: Most frequent words whose counts and classes every task has.
KNOWN = 1 << 17
CLASSES, ENDINGS = 32, 64
SIDE, WIDTH = 2, 16
ROUNDS, GROUP = 2, 4_000_000
#: Words of a training step, and of a scoring step, whose arrays are small enough for a core's cache.
STEP, SCORED = 4096, 1024
#: A word's class and ending in one number.
CODE = np.dtype("<u2")
#: Distinct words a worker keeps the numbers of.
CACHE = 500_000


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hash(word: bytes) -> int:
    """Signed 64-bit hash."""
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def word_hashes(some: Collection[bytes]) -> np.ndarray:
    """``word_hash`` of each."""
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, some)), ">i8").astype(np.int64)


def ending(word: bytes) -> int:
    tail = word[-2:]
    return (tail[0] * 31 + tail[-1] * 7) % ENDINGS


def endings_of(some: Collection[bytes]) -> np.ndarray:
    """``ending`` of each."""
    size = np.fromiter(map(len, some), np.int64, len(some))
    letters, end = np.frombuffer(b"".join(some), np.uint8).astype(np.int64), np.cumsum(size)
    return (letters[end - np.minimum(size, 2)] * 31 + letters[end - 1] * 7) % ENDINGS


@dataclass
class Vocabulary:
    """The known words by ascending hash, their counts and classes; ``cells``: counts of (class, ending)."""

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    cells: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, counts: np.ndarray, total: int) -> Vocabulary:
        """From the known words, most frequent first, and the number of all words' occurrences."""
        before = np.cumsum(counts) - counts
        klass = np.minimum(before * CLASSES // max(1, total), CLASSES - 2)
        order = np.argsort(hashes, kind="stable")
        return cls(hashes[order], counts[order], klass[order], np.zeros((CLASSES, ENDINGS)))


class Encoder:
    """Numbers of words: place among the known ones (-1: none), class, ending and hash."""

    def __init__(self, v: Vocabulary):
        self.known = len(v.hashes)
        self.hashes, self.classes = np.append(v.hashes, 0), np.append(v.classes, CLASSES - 1)
        self._forget()

    def _forget(self) -> None:
        self.kept = defaultdict(itertools.count().__next__)  # numbers words as they come
        self.table = np.zeros((4, 0), np.int64)

    def _numbers(self, some: list[bytes]) -> np.ndarray:
        h = word_hashes(some)
        at = np.searchsorted(self.hashes[:self.known], h)
        known = (at < self.known) & (self.hashes[at] == h)
        return np.stack([np.where(known, at, -1), np.where(known, self.classes[at], CLASSES - 1), endings_of(some), h])

    def encode(self, texts: list[list[bytes]]) -> np.ndarray:
        """(4, words): the numbers of all words of the texts."""
        if len(self.kept) > CACHE:
            self._forget()
        before = len(self.kept)
        at = np.fromiter(map(self.kept.__getitem__, itertools.chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
        if new := [*itertools.islice(self.kept, before, None)]:
            self.table = np.concatenate([self.table, self._numbers(new)], axis=1)
        return self.table.take(at, axis=1)


class Room:
    """A step's arrays, made once: fresh ones of this size cost as much as what is reckoned in them."""

    def __init__(self, n: int):
        self.n, self.at = n, np.arange(n)
        self.h, self.spare, self.back = (np.empty((n, WIDTH), np.float32) for _ in range(3))
        self.a, self.b, self.bias = (np.empty((n, m), np.float32) for m in (CLASSES, ENDINGS, ENDINGS))
        self.hot = np.empty((CLASSES + ENDINGS + 2, n), np.float32)

    def cut(self, n: int) -> tuple[np.ndarray, ...]:
        """at, h, spare, back, a, b and bias for a step of n words."""
        return tuple(x[:n] for x in (self.at, self.h, self.spare, self.back, self.a, self.b, self.bias))

    def ones(self, *of: tuple[int, np.ndarray]) -> np.ndarray:
        """One-hot matrices, words across, one below the other, of (rows, each word's row)."""
        done = 0
        for rows, at in of:
            np.equal(at.astype(np.uint8), np.arange(rows, dtype=np.uint8)[:, None], out=self.hot[done:done + rows, :len(at)])
            done += rows
        return self.hot[:done, :len(at)]


@dataclass
class Network:
    """c, e: vectors by place and class, and by place and ending; w1, b1: classes; w2, b2: endings, b2 by class."""

    c: np.ndarray
    e: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    @staticmethod
    def shapes() -> list[tuple[int, ...]]:
        return [(2 * SIDE, CLASSES + 1, WIDTH), (2 * SIDE, ENDINGS + 1, WIDTH), (WIDTH, CLASSES), (CLASSES,), (WIDTH, ENDINGS), (CLASSES, ENDINGS)]

    @classmethod
    def start(cls, cells: np.ndarray, seed: int = 3) -> Network:
        """Small random weights; the outputs start at the counts' shares."""
        rng = np.random.default_rng(seed)
        s = cells + 0.1
        parts = [rng.normal(0, 0.1, shape) for shape in cls.shapes()]
        parts[3], parts[5] = np.log(s.sum(axis=1) / s.sum()), np.log(s / s.sum(axis=1, keepdims=True))
        return cls(*(p.astype(np.float32) for p in parts))

    def parts(self) -> list[np.ndarray]:
        return [self.c, self.e, self.w1, self.b1, self.w2, self.b2]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()]).astype(np.float64)

    @classmethod
    def unflat(cls, x: np.ndarray) -> Network:
        x, out = np.asarray(x, np.float32), []
        for shape in cls.shapes():
            n = int(np.prod(shape))
            out.append(x[:n].reshape(shape).copy())
            x = x[n:]
        return cls(*out)

    def outputs(self, room: Room, classes: np.ndarray, around: np.ndarray) -> None:
        """Into the room: the hidden layer (h) and both softmaxes' logits (a, b).

        around: class and ending of each neighbour, (2, places, words).
        """
        _, h, spare, _, a, b, bias = room.cut(len(classes))
        h[:] = 0
        for s in range(2 * SIDE):
            for table, at in ((self.c[s], around[0, s]), (self.e[s], around[1, s])):
                h += np.take(table, at, axis=0, out=spare, mode="clip")
        np.tanh(h, out=h)
        np.matmul(h, self.w1, out=a)
        a += self.b1
        np.matmul(h, self.w2, out=b)
        b += np.take(self.b2, classes, axis=0, out=bias, mode="clip")

    def log_probability(self, classes: np.ndarray, endings: np.ndarray, around: np.ndarray) -> np.ndarray:
        """log P(class | neighbours) + log P(ending | class, neighbours) of each word."""
        out, room = np.empty(len(classes)), Room(SCORED)
        for i in range(0, len(classes), SCORED):
            k, e = classes[i:i + SCORED], endings[i:i + SCORED]
            self.outputs(room, k, around[:, :, i:i + SCORED])
            at, _, _, _, a, b, _ = room.cut(len(k))
            out[i:i + SCORED] = a[at, k] + b[at, e]
            out[i:i + SCORED] -= np.log(np.exp(a, out=a).sum(axis=1)) + np.log(np.exp(b, out=b).sum(axis=1))
        return out


class Learner:
    """AdaGrad over steps of ``STEP`` words."""

    def __init__(self, net: Network, rate: float = 0.1):
        self.net, self.rate, self.seen = net, rate, 0
        self.g = [np.full(p.shape, 1e-4, np.float32) for p in net.parts()]
        self.room = Room(STEP)

    def learn(self, classes: np.ndarray, endings: np.ndarray, around: np.ndarray) -> None:
        for i in range(0, len(classes), STEP):
            self._step(classes[i:i + STEP], endings[i:i + STEP], around[:, :, i:i + STEP])
        self.seen += len(classes)

    def _step(self, k: np.ndarray, e: np.ndarray, around: np.ndarray) -> None:
        net, n, room = self.net, len(k), self.room
        net.outputs(room, k, around)
        at, h, spare, back, p, q, _ = room.cut(n)
        for x, right in ((p, k), (q, e)):
            np.exp(x, out=x)
            x /= x.sum(axis=1, keepdims=True) * np.float32(n)
            x[at, right] -= 1 / n
        np.matmul(p, net.w1.T, out=back)
        back += np.matmul(q, net.w2.T, out=spare)
        np.multiply(h, h, out=spare)
        back *= np.subtract(1, spare, out=spare)
        gb2 = room.ones((CLASSES, k)) @ q
        # classes and, behind them, endings, in one product
        both = np.stack([room.ones((CLASSES + 1, around[0, s]), (ENDINGS + 1, around[1, s])) @ back for s in range(2 * SIDE)])
        gc, ge = both[:, :CLASSES + 1], both[:, CLASSES + 1:]
        for x, g, sum_g in zip(net.parts(), (gc, ge, h.T @ p, p.sum(axis=0), h.T @ q, gb2), self.g):
            sum_g += g * g
            x -= self.rate * g / np.sqrt(sum_g)


def windows(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes, endings, around) of every word of documents given as (2, words) arrays; none reach across documents."""
    gap = np.repeat([[CLASSES], [ENDINGS]], SIDE, axis=1)  # the class and the ending of a place outside the document
    run = np.concatenate([gap, *(x for d in docs for x in (d, gap))], axis=1)
    at = np.flatnonzero(run[0] != CLASSES)
    around = np.empty((2, 2 * SIDE, len(at)), run.dtype)
    for s, o in enumerate(o for o in range(-SIDE, SIDE + 1) if o):
        for row in (0, 1):
            np.take(run[row], at + o, out=around[row, s], mode="clip")
    return run[0].take(at), run[1].take(at), around


def _runs(docs: Iterable[list[bytes] | bytes], width: int = 1):
    """Runs of documents, ``width`` long for each word, of about 64 steps."""
    held, size = [], 0
    for d in docs:
        held.append(d)
        size += len(d)
        if size >= 64 * STEP * width:
            yield held
            held, size = [], 0
    if held:
        yield held


def _split(numbers: np.ndarray, texts: list[list[bytes]]) -> list[np.ndarray]:
    return np.split(numbers[1:3], np.cumsum([len(t) for t in texts])[:-1], axis=1)


# ------------------------------------------------------------------ tables
def count_words(docs: DataFrame) -> DataFrame:
    """(h, ending, n): hash, ending and occurrences of every word of all documents."""
    def count(batches):
        for b in batches:
            for run in _runs(map(words, b.column(0).to_pylist())):
                n = Counter(itertools.chain.from_iterable(run))
                if n:
                    yield pa.RecordBatch.from_arrays([pa.array(word_hashes(n)), pa.array(endings_of(n), pa.int32()),
                                                      pa.array(n.values(), pa.int64())], ["h", "ending", "n"])

    each = docs.select("text").mapInArrow(count, "h bigint, ending int, n bigint")
    return stage(each.groupBy("h").agg(F.min("ending").alias("ending"), F.sum("n").alias("n")), "words")


def vocabulary(counted: DataFrame, known: int = KNOWN) -> Vocabulary:
    """The ``known`` most frequent words (of equal counts those of least hash) and the counts of all cells."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    top = counted.orderBy(F.desc("n"), "h").limit(known).toArrow()
    top = top.sort_by([("n", "descending"), ("h", "ascending")])
    v = Vocabulary.of(top["h"].to_numpy(), top["n"].to_numpy(), total)
    for row in counted.groupBy("ending").agg(F.sum("n").alias("n")).collect():
        v.cells[CLASSES - 1, row["ending"]] = row["n"]
    own = top["ending"].to_numpy()[np.argsort(top["h"].to_numpy(), kind="stable")]
    np.add.at(v.cells, (v.classes, own), v.counts)
    v.cells[CLASSES - 1] -= np.bincount(own, v.counts, ENDINGS)
    return v


def number(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """Every row's words as numbers, a table that training and scoring read instead of the texts.

    k1, k2 name the row by doc_id and text; ``codes`` are its words' classes and endings, 2 bytes each;
    ``own`` sums log(count / count of the cell) over them, but for the counts of the words beyond
    the known ones, which ``rare`` has, each with its number of places.
    """
    packet = docs.sparkSession.sparkContext.broadcast(v)
    d = docs.select(*row_key(F.col("doc_id"), F.col("text")), "text")
    schema = "k1 bigint, k2 bigint, n_tokens bigint, own double, codes binary, rare array<struct<h:bigint,m:bigint>>"

    def each(batches):
        v = packet.value
        encoder, log_cell = Encoder(v), np.log(np.maximum(v.cells, 1))
        log_count = np.log(np.concatenate([v.counts, [1]]))  # -1: a word beyond the known ones, whose count is joined
        for b in batches:
            sizes, sums, codes, rare, ends = [], [], [], [], [0]
            for run in _runs(map(words, b.column(2).to_pylist())):
                numbers = encoder.encode(run)
                n = [len(t) for t in run]
                of = np.repeat(np.arange(len(n)), n)
                sums += np.bincount(of, log_count[numbers[0]] - log_cell[numbers[1], numbers[2]], len(n)).tolist()
                sizes += n
                codes.append(_codes(numbers[1], numbers[2]))
                beyond = numbers[0] < 0  # each word once a document, with its number of places
                doc, h, m = _pairs(of[beyond], numbers[3, beyond])
                rare.append((h, m))
                ends += (ends[-1] + np.cumsum(np.bincount(doc, minlength=len(n)))).tolist()
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(sizes, pa.int64()), pa.array(sums, pa.float64()), _binary(codes, sizes),
                                              _structs(rare, ends)], ["k1", "k2", "n_tokens", "own", "codes", "rare"])

    return stage(d.mapInArrow(each, schema), "numbers")


def train(docs: DataFrame, v: Vocabulary, group: int = GROUP) -> Network:
    """The network after every document was seen once."""
    return _learn(number(docs, v), v, group)


def _learn(numbered: DataFrame, v: Vocabulary, group: int) -> Network:
    spark, net = numbered.sparkSession, Network.start(v.cells)
    groups = max(1, round(v.cells.sum() / ROUNDS / group))
    d = numbered.select((F.pmod(F.col("k1"), F.lit(groups))).alias("g"), F.pmod(F.shiftright("k2", 8), F.lit(ROUNDS)).alias("r"), "k1", "k2", "codes")
    for r in range(ROUNDS):
        start = net.flat()

        def learn(batches):
            now, learner, held, size = None, None, [], 0

            def step():
                learner.learn(*windows(_documents(held)))

            def result():
                return pa.RecordBatch.from_arrays([pa.array([learner.seen], pa.int64()), pa.array([learner.net.flat()], pa.list_(pa.float64()))], ["n", "x"])
            for b in batches:
                for g, codes in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if g != now:
                        if held:
                            step()
                        if learner is not None and learner.seen:
                            yield result()
                        now, learner, held, size = g, Learner(Network.unflat(start)), [], 0
                    held.append(codes)
                    size += len(codes) // CODE.itemsize
                    if size >= 64 * STEP:  # a run of whole documents, wherever batches end
                        step()
                        held, size = [], 0
            if held:
                step()
            if learner is not None and learner.seen:
                yield result()

        part = d.where(F.col("r") == r).repartition(parallelism(spark), "g").sortWithinPartitions("g", "k1", "k2")
        each = stage(part.select("g", "codes").mapInArrow(learn, "n bigint, x array<double>"), "weights")
        mean = each.select("n", F.posexplode("x").alias("i", "v")).groupBy("i").agg(
            (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("v")).orderBy("i").toArrow()
        if len(mean):
            net = Network.unflat(mean["v"].to_numpy())
    return net


def score(docs: DataFrame, counted: DataFrame, v: Vocabulary, net: Network) -> DataFrame:
    """(k1, k2, n_tokens, log_prob) per distinct row; k1, k2 name it by doc_id and text."""
    return _score(number(docs, v), counted, net)


def _score(numbered: DataFrame, counted: DataFrame, net: Network) -> DataFrame:
    model = numbered.sparkSession.sparkContext.broadcast(net)

    def each(batches):
        net = model.value
        for b in batches:
            sums = []
            for run in _runs(b.column(4).to_pylist(), CODE.itemsize):
                n = [len(c) // CODE.itemsize for c in run]
                sums += np.bincount(np.repeat(np.arange(len(n)), n), net.log_probability(*windows(_documents(run))), len(n)).tolist()
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sums, pa.float64()), b.column(3)], ["k1", "k2", "n_tokens", "given", "own"])

    each = numbered.select("k1", "k2", "n_tokens", "own", "codes").mapInArrow(each, "k1 bigint, k2 bigint, n_tokens bigint, given double, own double")
    scored = stage(each.withColumn("log_prob", F.col("given") + F.col("own")), "scores")
    one = scored.groupBy("k1", "k2").agg(F.min("n_tokens").alias("n_tokens"), F.min("log_prob").alias("log_prob"))
    # rows that repeat have the same words as often
    beyond = numbered.select("k1", "k2", F.inline("rare")).groupBy("k1", "k2", "h").agg(F.max("m").alias("m"))
    more = beyond.join(counted.select("h", F.col("n").alias("c")), "h").groupBy("k1", "k2").agg(F.sum(F.col("m") * F.log("c")).alias("more"))
    return one.join(more, ["k1", "k2"], "left").select("k1", "k2", "n_tokens", (F.col("log_prob") + F.coalesce("more", F.lit(0.0))).alias("log_prob"))


def _pairs(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, in order, and how often each stands there."""
    order = np.lexsort((hashes, docs))
    d, h = docs[order], hashes[order]
    first = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (h[1:] != h[:-1]))[:len(d)])
    return d[first], h[first], np.diff(np.append(first, len(d)))


def _codes(classes: np.ndarray, endings: np.ndarray) -> np.ndarray:
    return (classes * ENDINGS + endings).astype(CODE)


def _documents(codes: list[bytes]) -> list[np.ndarray]:
    """Classes and endings, (2, words), of each document given as codes."""
    numbers = np.stack(np.divmod(np.frombuffer(b"".join(codes), CODE).astype(np.int64), ENDINGS))
    return np.split(numbers, np.cumsum([len(c) // CODE.itemsize for c in codes])[:-1], axis=1)


def _binary(codes: list[np.ndarray], sizes: list[int]) -> pa.Array:
    ends = np.cumsum([0, *sizes]) * CODE.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(b"".join(codes))])


def _structs(rare: list[tuple[np.ndarray, np.ndarray]], ends: list[int]) -> pa.Array:
    h, m = (np.concatenate([np.zeros(0, np.int64), *(r[i] for r in rare)]) for i in (0, 1))
    values = pa.StructArray.from_arrays([pa.array(h), pa.array(m)], ["h", "m"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def lm_score(docs: DataFrame, known: int = KNOWN, group: int = GROUP) -> DataFrame:
    """``docs`` with n_tokens, log_prob and mean_log_prob added (columns of these names are replaced).

    Counts, trains and scores on ``docs``.  Null and empty texts have no words:
    log_prob 0, mean null.  Repeated rows count each and are scored alike.  An empty
    table gives an empty one.
    """
    counted = count_words(docs)
    v = vocabulary(counted, known)
    numbered = number(docs, v)
    scores = _score(numbered, counted, _learn(numbered, v, group))
    d = docs.drop("n_tokens", "log_prob", "mean_log_prob")
    names = free_names(d, "__k1", "__k2")
    out = d.withColumns(dict(zip(names, row_key(F.col("doc_id"), F.col("text"))))).join(scores.toDF(*names, "n_tokens", "log_prob"), names).drop(*names)
    return out.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
