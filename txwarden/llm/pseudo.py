"""Masked pseudo-likelihood: how well each word of a text is foretold by the words on both sides of it.

Method. A window network sees the two words before and the two after a place, each through embeddings of its own for that
offset, adds them, applies tanh, and gives a distribution over the vocabulary as a product of two softmaxes: a class of
words, then a word of the class. The vocabulary has the most frequent words of the corpus; all other words share hashed
places, and a word's probability is that of its place times the word's share of all occurrences at that place. So the
probabilities of all distinct words sum to that of all places, whatever the number of words. A document's score is the sum
over all its words of their log-probability given both sides.

Training is in numpy and covers the whole corpus: in each round every partition starts from the common parameters, masks a
share of the places of all its texts, and foretells those by stochastic gradient descent; then the parameters are averaged,
weighted by the number of places. Word counts, the words of shared places in every document, and every partition's
parameters go through the shuffle, so what is gathered grows with the corpus, while the driver only sees one set of
parameters and the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.llm.arrow import column, pieces
from txwarden.llm.shingles import words
from txwarden.llm.store import written

# Parameters travel in rows of so many values.
ROW = 4096
# Places that are scored at once.
PLACES = 16384


@dataclass(frozen=True)
class Settings:
    """`classes` x `classes` places in the vocabulary, of which `hashed` are shared by words that are not among the most
    frequent. `masked`: share of all places that a round trains on; `batch`: places of one step."""

    classes: int = 64
    hashed: int = 512
    window: int = 2
    width: int = 16
    rounds: int = 2
    masked: float = 0.15
    batch: int = 1024
    rate: float = 0.1
    seed: int = 3

    @property
    def size(self) -> int:
        return self.classes * self.classes

    @property
    def frequent(self) -> int:
        return self.size - self.hashed


class Vocabulary:
    """Ids of words: the rank of a frequent word, else a place by the word's hash."""

    def __init__(self, ranked: np.ndarray, settings: Settings):
        self.order = np.argsort(ranked).astype(np.int32)
        self.sorted = ranked[self.order]
        self.settings = settings

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        shared = (hashes % np.uint64(self.settings.hashed)).astype(np.int32) + np.int32(self.settings.frequent)
        if not len(self.sorted):
            return shared
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], shared)


def word_counts(docs: DataFrame) -> DataFrame:
    """The hash of every distinct word of all texts and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.record_batch({"word": pa.array(held.view(np.int64)), "n": pa.array(counts)})

        for _, data, starts in pieces(batches):
            found, n = np.unique(words(data, starts)[0], return_counts=True)
            held, at = np.unique(np.concatenate([held, found]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(held)).astype(np.int64)
            if len(held) > 1 << 20:
                yield out()
                held, counts = held[:0], counts[:0]
        yield out()

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counted: DataFrame, settings: Settings) -> np.ndarray:
    """Hashes of the most frequent words, the most frequent first; ties go by hash."""
    rows = counted.orderBy(F.desc("n"), "word").limit(settings.frequent).select("word").toArrow()
    return rows.column("word").to_numpy().view(np.uint64)


def vocabulary(docs: DataFrame, settings: Settings) -> np.ndarray:
    """Hashes of the most frequent words of all texts, the most frequent first; ties go by hash."""
    return most_frequent(word_counts(docs), settings)


def word_shares(counted: DataFrame, ranked: np.ndarray, settings: Settings) -> DataFrame:
    """Of each word at a shared place the logarithm of its share of the occurrences there."""
    known = counted.sparkSession.createDataFrame(pa.table({"word": pa.array(ranked.view(np.int64))}))
    rare = counted.join(F.broadcast(known), "word", "left_anti")
    # Hashes are unsigned where places are taken; a negative long stands for itself and 2^64.
    over = F.when(F.col("word") < 0, F.lit((1 << 64) % settings.hashed)).otherwise(F.lit(0))
    placed = rare.withColumn("place", F.pmod(F.pmod("word", F.lit(settings.hashed)) + over, F.lit(settings.hashed)))
    totals = placed.groupBy("place").agg(F.sum("n").alias("total"))
    return placed.join(F.broadcast(totals), "place").select("word", F.log(F.col("n") / F.col("total")).alias("share"))


class Network:
    """Parameters as views of one vector: embeddings by offset (the last row stands for an edge), classes, words of a class."""

    def __init__(self, settings: Settings, values: np.ndarray | None = None):
        s = self.settings = settings
        shapes = [(2 * s.window, s.size + 1, s.width), (s.classes, s.width), (s.classes,), (s.classes, s.classes, s.width), (s.classes, s.classes)]
        sizes = [int(np.prod(x)) for x in shapes]
        if values is None:
            values = np.random.default_rng(s.seed).normal(0, 0.1, sum(sizes)).astype(np.float32)
        self.values = values
        parts = np.split(values, np.cumsum(sizes)[:-1])
        self.near, self.classes, self.class_bias, self.words, self.word_bias = (p.reshape(x) for p, x in zip(parts, shapes, strict=True))

    def hidden(self, near: np.ndarray) -> np.ndarray:
        return np.tanh(sum(self.near[o][near[:, o]] for o in range(near.shape[1])))

    def log_probabilities(self, near: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of each target between its neighbours."""
        h = self.hidden(near)
        kind, word = np.divmod(target, self.settings.classes)
        every = np.arange(len(target))
        out = log_softmax_at(h @ self.classes.T + self.class_bias, every, kind).astype(np.float64)
        order = np.argsort(kind.astype(np.uint16), kind="stable")
        ends = np.searchsorted(kind[order], np.arange(self.settings.classes + 1))
        for c in np.flatnonzero(np.diff(ends)).tolist():
            rows = order[ends[c] : ends[c + 1]]
            z = h[rows] @ self.words[c].T + self.word_bias[c]
            out[rows] += log_softmax_at(z, np.arange(len(rows)), word[rows])
        return out

    def gradient(self, near: np.ndarray, target: np.ndarray, heads: Heads | None = None) -> tuple[Heads, np.ndarray]:
        """Gradient of the summed negative log-probabilities: of classes and words in `heads`, which is cleared first, and of the
        embeddings as one row for each place."""
        s = self.settings
        g = heads or Heads(s)
        g.values[:] = 0
        h = self.hidden(near)
        kind, word = np.divmod(target, s.classes)
        z = softmax(h @ self.classes.T + self.class_bias)
        z[np.arange(len(z)), kind] -= 1
        np.matmul(z.T, h, out=g.classes)
        g.class_bias[:] = z.sum(axis=0)
        back = z @ self.classes
        order = np.argsort(kind.astype(np.uint16), kind="stable")
        kind, word, h_sorted = kind[order], word[order], h[order]
        ends = np.searchsorted(kind, np.arange(s.classes + 1))
        own = np.empty_like(back)
        for c in np.flatnonzero(np.diff(ends)).tolist():
            a, b = ends[c], ends[c + 1]
            z = softmax(h_sorted[a:b] @ self.words[c].T + self.word_bias[c])
            z[np.arange(b - a), word[a:b]] -= 1
            np.matmul(z.T, h_sorted[a:b], out=g.words[c])
            g.word_bias[c] = z.sum(axis=0)
            np.matmul(z, self.words[c], out=own[a:b])
        back[order] += own
        return g, back * (1 - h * h)

    def step(self, near: np.ndarray, target: np.ndarray, squares: Network, heads: Heads | None = None) -> None:
        """One step, each parameter at its own rate by the squares of its past gradients."""
        g, back = self.gradient(near, target, heads)
        slope, past, first = g.values, squares.values[-len(g.values) :], len(self.values) - len(g.values)
        past += slope * slope
        self.values[first:] -= self.settings.rate * slope / np.sqrt(past + 1)
        for o in range(near.shape[1]):
            order = np.argsort(near[:, o].astype(np.uint16) if self.settings.size < 1 << 16 else near[:, o], kind="stable")
            sorted_ = near[order, o]
            new = np.ones(len(sorted_), bool)
            new[1:] = sorted_[1:] != sorted_[:-1]
            firsts = np.flatnonzero(new)
            rows = sorted_[firsts]
            slope = np.add.reduceat(back[order], firsts, axis=0)
            past = squares.near[o][rows] + slope * slope
            squares.near[o][rows] = past
            self.near[o][rows] -= self.settings.rate * slope / np.sqrt(past + 1)


class Heads:
    """Classes and words of a network alone, as views of one vector: room for a gradient, kept between steps."""

    def __init__(self, settings: Settings):
        n, w = settings.classes, settings.width
        shapes = [(n, w), (n,), (n, n, w), (n, n)]
        sizes = [int(np.prod(x)) for x in shapes]
        self.values = np.zeros(sum(sizes), np.float32)
        parts = np.split(self.values, np.cumsum(sizes)[:-1])
        self.classes, self.class_bias, self.words, self.word_bias = (p.reshape(x) for p, x in zip(parts, shapes, strict=True))


# Logits between these bounds need no shift before their exponentials are added up in single precision.
PLAIN = 40.0


def exponentials(z: np.ndarray) -> np.ndarray:
    """exp of logits, each row up to a factor; in place."""
    if len(z) and not (-PLAIN < z.min() and z.max() < PLAIN):
        z -= z.max(axis=1, keepdims=True)
    return np.exp(z, out=z)


def softmax(z: np.ndarray) -> np.ndarray:
    e = exponentials(z)
    e /= e.sum(axis=1, keepdims=True)
    return e


def log_softmax_at(z: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    if len(z) and not (-PLAIN < z.min() and z.max() < PLAIN):
        z -= z.max(axis=1, keepdims=True)
    picked = z[rows, columns]
    np.exp(z, out=z)
    return picked - np.log(z @ np.ones(z.shape[1], z.dtype))


def neighbours(ids: np.ndarray, starts: np.ndarray, settings: Settings, chosen: np.ndarray | None = None) -> np.ndarray:
    """The ids around each place of each text (or around the chosen places), before it and after it; `size` beyond an edge of
    the text."""
    w, n = settings.window, len(starts) - 1
    place = np.arange(len(ids)) + w * (np.repeat(np.arange(n), np.diff(starts)) + 1)
    flat = np.full(len(ids) + w * (n + 1), settings.size, np.int32)
    flat[place] = ids
    if chosen is not None:
        place = place[chosen]
    return np.stack([flat[place + o] for o in (*range(-w, 0), *range(1, w + 1))], axis=1)


def trained(docs: DataFrame, ranked: np.ndarray, settings: Settings) -> Network:
    """The network after all rounds over all texts."""
    net, context = Network(settings), docs.sparkSession.sparkContext
    for turn in range(settings.rounds):
        sent = context.broadcast((net.values, ranked))

        def run(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:
            values, ranked = sent.value
            own, squares = Network(settings, values.copy()), Network(settings, np.zeros(len(values), np.float32))
            known, places, heads = Vocabulary(ranked, settings), 0, Heads(settings)
            draw = np.random.default_rng((settings.seed, turn, TaskContext.get().partitionId()))
            for _, data, starts in pieces(batches):
                hashes, firsts = words(data, starts)
                ids = known.ids(hashes)
                masked = draw.permutation(np.flatnonzero(draw.random(len(ids)) < settings.masked))
                near = neighbours(ids, firsts, settings, masked)
                for i in range(0, len(masked), settings.batch):
                    own.step(near[i : i + settings.batch], ids[masked[i : i + settings.batch]], squares, heads)
                places += len(masked)
            if places:
                rows = [own.values[i : i + ROW].astype(np.float64) for i in range(0, len(own.values), ROW)]
                yield pa.record_batch({
                    "place": pa.array(range(len(rows)), pa.int32()), "weight": pa.array([float(places)] * len(rows)),
                    "part": pa.array(rows, pa.list_(pa.float64())),
                })

        rows = docs.select("text").mapInArrow(run, "place int, weight double, part array<double>")
        mean = Summarizer.mean(array_to_vector("part"), F.col("weight"))
        got = rows.groupBy("place").agg(vector_to_array(mean).alias("part")).orderBy("place").toArrow()
        if got.num_rows:
            net = Network(settings, np.concatenate([np.array(p, np.float32) for p in got.column("part").to_pylist()]))
    return net


def scores(docs: DataFrame, net: Network, ranked: np.ndarray, settings: Settings) -> DataFrame:
    """key, doc_id, n_tokens, pll of every document, as far as the places of its words go."""
    sent = docs.sparkSession.sparkContext.broadcast((net.values, ranked))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, ranked = sent.value
        net, known = Network(settings, values), Vocabulary(ranked, settings)
        for batch, data, starts in pieces(batches):
            hashes, firsts = words(data, starts)
            ids = known.ids(hashes)
            near = neighbours(ids, firsts, settings)
            steps = [net.log_probabilities(near[i : i + PLACES], ids[i : i + PLACES]) for i in range(0, len(ids), PLACES)]
            counts = np.diff(firsts)
            total = np.bincount(np.repeat(np.arange(len(counts)), counts), np.concatenate(steps) if steps else None, len(counts))
            yield pa.record_batch({
                "key": column(batch, "key"), "doc_id": column(batch, "doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                "pll": pa.array(total.astype(np.float64)),
            })

    return docs.select("key", "doc_id", "text").mapInArrow(run, f"key long, doc_id {kind}, n_tokens long, pll double")


def shared_words(docs: DataFrame, ranked: np.ndarray, settings: Settings) -> DataFrame:
    """key, word, times: the distinct words of every document that are at shared places."""
    sent = docs.sparkSession.sparkContext.broadcast(ranked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(sent.value, settings)
        for batch, data, starts in pieces(batches):
            hashes, firsts = words(data, starts)
            of = np.repeat(np.arange(batch.num_rows), np.diff(firsts))
            rare = known.ids(hashes) >= settings.frequent
            hashes, of = hashes[rare], of[rare]
            order = np.lexsort((hashes, of))
            hashes, of = hashes[order], of[order]
            new = np.ones(len(of), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
            at = np.flatnonzero(new)
            yield pa.record_batch({
                "key": column(batch, "key").take(pa.array(of[at])), "word": pa.array(hashes[at].view(np.int64)),
                "times": pa.array(np.diff(np.append(at, len(of))), pa.int64()),
            })

    return docs.select("key", "text").mapInArrow(run, "key long, word long, times long")


def pseudo_likelihood(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, n_tokens, pll (summed log-probability, 0 for no words), mean_pll (null for no words).

    `docs` has doc_id and text; other columns are ignored. Words are runs without ASCII white space, A-Z lower-cased. A
    null or empty text has no words. Every word of a text of any length counts. Repeated rows train and score each; an empty
    table gives an empty result. A corpus of fewer words than the vocabulary leaves places unused.
    """
    counted = written(word_counts(docs), "word-counts")
    ranked = most_frequent(counted, settings)
    # Rows of one doc_id and text have one key and one score.
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    out = written(scores(keyed, trained(docs, ranked, settings), ranked, settings), "place-scores")
    rare = shared_words(keyed, ranked, settings).join(word_shares(counted, ranked, settings), "word")
    within = rare.groupBy("key").agg(F.sum(F.col("times") * F.col("share")).alias("within"))
    within = within.join(out.groupBy("key").agg(F.count("*").alias("rows")), "key").select("key", (F.col("within") / F.col("rows")).alias("within"))
    out = out.join(within, "key", "left").select("doc_id", "n_tokens", (F.col("pll") + F.coalesce("within", F.lit(0.0))).alias("pll"))
    return out.withColumn("mean_pll", F.when(F.col("n_tokens") > 0, F.col("pll") / F.col("n_tokens")))
