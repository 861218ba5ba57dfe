"""Language of a text by averaged hashed subword embeddings and a linear softmax, with calibrated rejection.

Method. Byte runs of two to four letters, with word edges, are hashed into buckets; each bucket has an embedding, a text is
the mean of its embeddings, and a linear softmax gives the languages. Embeddings and softmax are trained together by
stochastic gradient descent in numpy on a bounded sample. A part of the sample that is not trained on sets the temperature
of the scores and the score below which a prediction is rejected.

The sampled texts stay on the executors: what comes to the driver of each is the buckets of its runs and how often each
occurs, at most six bytes a bucket whatever the length of the text.

As the mean is linear, buckets are multiplied with the softmax weights once, and a text costs one lookup for each run.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.llm.arrow import column, pieces

UNKNOWN = "und"
EDGE = 0x20
LETTERS = np.full(256, EDGE, np.uint32)
LETTERS[65:91] = np.arange(97, 123)
LETTERS[97:123] = np.arange(97, 123)
LETTERS[128:] = np.arange(128, 256)
# Odd factors of the multiplicative hash, one for each run length.
FACTORS = {2: 0x9E3779B1, 3: 0x85EBCA6B, 4: 0xC2B2AE35}


@dataclass(frozen=True)
class Settings:
    """`sample`: most labelled documents of one language that the model is fitted on (whole texts);
    `most`: languages it is fitted on, the most frequent ones. `spans`: lengths in
    bytes of the cuttings that are trained on beside each whole text, so that short texts are known too. `rejected`:
    share of well-predicted calibration documents whose scores lie below the rejection cutoff."""

    sample: int = 800
    most: int = 1000
    buckets: int = 1 << 15
    width: int = 16
    epochs: int = 8
    rate: float = 8.0
    spans: tuple[int, ...] = (16, 40, 120)
    rejected: float = 0.001
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """Languages in order, each bucket's share in their logits (the last row, for no run, is zero), offsets, cutoff."""

    languages: tuple[str, ...]
    weights: np.ndarray
    offsets: np.ndarray
    cutoff: float


def bucket_runs(data: np.ndarray, buckets: int) -> Iterator[np.ndarray]:
    """For each run length the bucket of the run that starts at each byte; `buckets` where there is none.

    A run's inner bytes are letters. Every text begins with an edge, and an edge follows the last.
    """
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    b = LETTERS[data]
    letter = b != EDGE
    run, inner = b, np.ones(len(b), bool)
    for k in (2, 3, 4):
        run = (run[:-1] << np.uint32(8)) | b[k - 1 :]
        if k == 2:
            valid = letter[:-1] | letter[1:]
        else:
            inner = inner[: len(run)] & letter[k - 2 : k - 2 + len(run)]
            valid = inner
        found = (run * np.uint32(FACTORS[k])) >> shift
        yield np.where(valid, found, np.uint32(buckets)).astype(np.int32)


def edged(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with an edge before each text and one at the end, and where each text's edge is."""
    n = len(starts) - 1
    out = np.full(len(data) + n + 1, EDGE, np.uint8)
    begins = starts[:-1] + np.arange(n)
    mask = np.ones(len(out), bool)
    mask[begins] = False
    mask[-1] = False
    out[mask] = data
    return out, begins


def logits(model: Model, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Mean over the runs of each text of their shares, plus the offsets."""
    flat, begins = edged(data, starts)
    buckets = len(model.weights) - 1
    total, runs = np.zeros((len(begins), len(model.languages))), np.zeros(len(begins))
    for found in bucket_runs(flat, buckets):
        at = np.minimum(begins, len(found) - 1)
        ends = np.append(at[1:], len(found))
        total += np.where((ends > at)[:, None], np.add.reduceat(model.weights[found], at, axis=0), 0)
        runs += np.where(ends > at, np.add.reduceat((found < buckets).astype(np.int64), at), 0)
    return total / np.maximum(runs, 1)[:, None] + model.offsets


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class Sample:
    """Buckets of the sampled texts and of their cuttings end to end, how often each occurs, and where each one's begin; for
    each its language as a number, and whether it is kept for calibration."""

    names: tuple[str, ...]
    ids: np.ndarray
    counts: np.ndarray
    starts: np.ndarray
    label: np.ndarray
    held: np.ndarray


def counted_runs(text: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of one text and how many of its runs each has."""
    flat, _ = edged(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    found = np.concatenate([f for f in bucket_runs(flat, buckets) if len(f)] or [np.zeros(0, np.int32)])
    ids, counts = np.unique(found[found < buckets], return_counts=True)
    return ids.astype("<u2" if buckets <= 1 << 16 else "<u4"), counts.astype("<u4")


def text_parts(raw: bytes, held: bool, settings: Settings) -> list[bytes]:
    """A text, and unless it is held for calibration a cutting of each span, from a place that depends on the text alone."""
    parts, draw = [raw], np.random.default_rng((settings.seed, zlib.crc32(raw)))
    for span in settings.spans:
        if not held and len(raw) > span:
            start = int(draw.integers(0, len(raw) - span))
            parts.append(raw[start : start + span])
    return parts


FEATURES = "lang string, rank long, part int, held boolean, ids binary, counts binary"


def features(rows: DataFrame, settings: Settings) -> DataFrame:
    """lang, rank and text to the buckets of each text and its cuttings. Every fifth text of a language is for calibration."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, rank, text in zip(*(column(batch, c) for c in ("lang", "rank", "text")), strict=True):
                held = rank.as_py() % 5 == 0
                parts = [counted_runs(x, settings.buckets) for x in text_parts(text.as_buffer().to_pybytes(), held, settings)]
                n = len(parts)
                yield pa.record_batch({
                    "lang": pa.array([lang.as_py()] * n), "rank": pa.array([rank.as_py()] * n, pa.int64()), "part": pa.array(range(n), pa.int32()),
                    "held": pa.array([held] * n), "ids": pa.array([i.tobytes() for i, _ in parts], pa.binary()),
                    "counts": pa.array([c.tobytes() for _, c in parts], pa.binary()),
                })

    return rows.select("lang", "rank", "text").mapInArrow(run, FEATURES)


def gathered(table: pa.Table, settings: Settings) -> Sample:
    """The feature rows as flat arrays, in an order that does not depend on partitions. Each value is copied once, to its place."""
    order = pc.sort_indices(table.select(["lang", "rank", "part"]), [("lang", "ascending"), ("rank", "ascending"), ("part", "ascending")]).to_numpy()
    names = tuple(sorted(table.column("lang").unique().to_pylist()))
    label = pc.index_in(table.column("lang"), pa.array(names, pa.string())).to_numpy().astype(np.int64)
    sizes = pc.binary_length(table.column("counts")).to_numpy().astype(np.int64) // 4
    starts = np.concatenate([[0], np.cumsum(sizes[order])]).astype(np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = starts[:-1]

    def flat(name: str, kind: str) -> np.ndarray:
        out, row = np.empty(starts[-1], kind), 0
        for chunk in table.column(name).chunks:
            for value in chunk:
                out[place[row] : place[row] + sizes[row]] = np.frombuffer(value.as_buffer(), kind)
                row += 1
        return out

    ids, counts = flat("ids", "<u2" if settings.buckets <= 1 << 16 else "<u4"), flat("counts", "<u4")
    return Sample(names, ids, counts, starts, label[order], table.column("held").to_numpy().astype(bool)[order])


def fit(sample: Sample, settings: Settings = Settings()) -> Model:
    """Train on the texts and cuttings that are not held, calibrate on those that are."""
    size, draw = len(sample.names), np.random.default_rng(settings.seed)
    rows = np.flatnonzero(~sample.held & (np.diff(sample.starts) > 0))
    embeddings = draw.normal(0, 1 / settings.width, (settings.buckets, settings.width)).astype(np.float32)
    outward = draw.normal(0, 1 / settings.width, (settings.width, size)).astype(np.float32)
    offsets = np.zeros(size, np.float32)
    steps = settings.epochs * max(1, len(rows))
    for step in range(settings.epochs * len(rows)):
        if step % len(rows) == 0:
            order = draw.permutation(rows)
        k = order[step % len(rows)]
        ids, counts = (x[sample.starts[k] : sample.starts[k + 1]] for x in (sample.ids, sample.counts))
        share = (counts / counts.sum()).astype(np.float32)
        rate = settings.rate * (1 - step / steps)
        mean = share @ embeddings[ids]
        slope = softmax(mean @ outward + offsets)
        slope[sample.label[k]] -= 1
        back = outward @ slope
        outward -= 0.05 * rate * np.outer(mean, slope)
        offsets -= 0.001 * rate * slope
        embeddings[ids] -= rate * share[:, None] * back
    weights = np.vstack([embeddings @ outward, np.zeros((1, size))])
    return calibrated(Model(sample.names, weights, offsets, 0.0), sample, settings)


def calibrated(model: Model, sample: Sample, settings: Settings) -> Model:
    """Divide the logits by the temperature under which the held-out labels are likeliest, and set the cutoff."""
    held = np.flatnonzero(sample.held)
    if not len(held):
        return model
    raw = np.zeros((len(held), len(model.languages)))
    for i, k in enumerate(held.tolist()):
        ids, counts = (x[sample.starts[k] : sample.starts[k + 1]] for x in (sample.ids, sample.counts))
        raw[i] = counts.astype(np.float64) @ model.weights[ids] / max(1, int(counts.sum())) + model.offsets
    label, every = sample.label[held], np.arange(len(held))
    grid = np.geomspace(0.1, 10, 81)
    loss = [-np.log(softmax(raw / t)[every, label] + 1e-12).mean() for t in grid]
    heat = grid[int(np.argmin(loss))]
    scores = softmax(raw / heat)
    right = np.sort(scores.max(axis=1)[scores.argmax(axis=1) == label])
    cutoff = float(right[int(settings.rejected * len(right))]) if len(right) else 0.0
    return Model(model.languages, (model.weights / heat).astype(np.float64), model.offsets / heat, cutoff)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def learned(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """The model fitted on labelled documents that are not held out: for each language a bounded sample by hashed id."""
    known = docs.filter("lang is not null and text is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    place = F.xxhash64(F.lit(settings.seed), "doc_id")
    # A first cut by the counts keeps little more than the sample, before anything is ranked.
    sizes = known.groupBy("lang").agg(F.count("*").alias("size"))
    sizes = sizes.orderBy(F.desc("size"), "lang").limit(settings.most)
    share = F.pmod(place, F.lit(1 << 20)) * F.col("size") < F.lit(2 * settings.sample) * F.lit(1 << 20)
    cut = known.select("doc_id", "lang", "text").join(F.broadcast(sizes), "lang").filter(share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(place, "doc_id", "text"))
    rows = cut.select("lang", "text", rank.cast("long").alias("rank")).filter(F.col("rank") <= settings.sample)
    return fit(gathered(features(rows, settings).toArrow(), settings), settings)


def languages(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, accepted, and the columns of `keep` as they are.

    Only the text decides. A text that is null or has no letter gets `und`, score 0, not accepted; so does every text if
    no language was learned. Ties go to the first language in order. `accepted`: the score is not below the model's cutoff. Repeated
    rows give a row each; an empty table gives an empty result; columns other than doc_id and text are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch, data, starts in pieces(batches):
            lettered = column(batch, "lettered").to_numpy(zero_copy_only=False)
            if model.languages:
                odds = softmax(logits(model, data, starts))
                best = odds.argmax(axis=1)
                score = np.where(lettered, odds[np.arange(len(best)), best], 0.0)
                names = pa.array(model.languages).take(pa.array(best))
            else:
                score, names = np.zeros(batch.num_rows), pa.array([UNKNOWN] * batch.num_rows)
            told = lettered & bool(model.languages)
            yield pa.record_batch({
                **{f"kept_{name}": column(batch, name) for name in keep},
                "doc_id": column(batch, "doc_id"), "held_out": column(batch, "held_out"),
                "lang_pred": pc.if_else(pa.array(told), names, UNKNOWN), "score": pa.array(score, pa.float64()),
                "accepted": pa.array(told & (score >= model.cutoff)),
            })

    own = T.StructType([
        *[T.StructField(f"kept_{name}", docs.schema[name].dataType) for name in keep], docs.schema["doc_id"],
        T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType()),
    ])
    lettered = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    asked = dict.fromkeys(["doc_id", "text", *keep])
    rows = docs.select(*asked).withColumns({"held_out": held_out(F.col("doc_id")), "lettered": lettered})
    return rows.mapInArrow(run, own)
