"""Passages that repeat across documents: windows of words behind a count-min prefilter, then grouped exactly.

Method. A window is `window` consecutive words of one document. Two windows of the same words hold the same least run of
`anchor` words, its anchor, which neighbouring windows mostly share. Every partition counts the anchors of its documents, once
a document, in a count-min sketch of cells that stop at two; the sketches of all partitions are merged. An anchor's estimate is
the least of its cells, so it is never below the number of documents that hold a window of it, and a window whose anchor is
estimated at one occurs nowhere else. A second pass takes only the windows estimated repeated and groups them exactly, by 96 bits
of hash over their words, with partial sums before the shuffle; a third finds them in the documents that come later, behind a
sketch of the windows that were found repeated.

A partition's sketch travels as the cells it has set, region by region, and becomes a bitmap where that is smaller. Sketches
are merged in two levels, so that no task holds more than `fan` of a region's first level. What is sent to the executors is one bit a
cell, `rows` x 2^`cell_bits` bits whatever the size of the corpus; a fuller sketch lets more windows through to the exact pass
and loses none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.llm.arrow import column, pieces
from txwarden.llm.shingles import SEEDS, mix, run_hashes, word_spans
from txwarden.llm.store import written

REGION_BITS = 20  # cells of a region
_draw = np.random.default_rng(0xC311)


@dataclass(frozen=True)
class Settings:
    """`rows` hash functions of 2^`cell_bits` cells each; `fan`: partition sketches that one task merges at the first level."""

    window: int = 50
    anchor: int = 10
    rows: int = 2
    cell_bits: int = 27
    fan: int = 64

    @property
    def regions(self) -> int:
        return 1 << max(0, self.cell_bits - REGION_BITS)


def run_values(values: np.ndarray, k: int, which: int) -> np.ndarray:
    """A 64-bit value for each k consecutive values."""
    places = np.random.default_rng((0x50B5, which)).integers(1, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = values[:n] * places[0]
    for i in range(1, k):
        out += values[i : i + n] * places[i]
    return mix(out)


def sliding_least(values: np.ndarray, k: int) -> np.ndarray:
    """The least of each k consecutive values."""
    span, out = 1, values
    while 2 * span <= k:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    rest = k - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


@dataclass(frozen=True)
class Windows:
    """All windows of a piece of texts: each one's text, its first word within the text, and its anchor."""

    words: np.ndarray
    second: np.ndarray | None
    firsts: np.ndarray
    at: np.ndarray
    of: np.ndarray
    anchors: np.ndarray


def windows(data: np.ndarray, starts: np.ndarray, settings: Settings, twice: bool = False) -> Windows:
    """The windows; with `twice` each word has a second value, from a hash of its own."""
    at, lengths, firsts = word_spans(data, starts)
    words = run_hashes(data, at, lengths, SEEDS[0])
    second = run_hashes(data, at, lengths, SEEDS[1]) if twice else None
    w = settings.window
    counts = np.maximum(np.diff(firsts) - w + 1, 0)
    of = np.repeat(np.arange(len(counts)), counts)
    where = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + firsts[of]
    if not len(of):
        return Windows(words, second, firsts, where, of, np.zeros(0, np.uint64))
    anchors = sliding_least(run_values(words, settings.anchor, 0), w - settings.anchor + 1)
    return Windows(words, second, firsts, where, of, anchors[where])


def window_hashes(found: Windows, chosen: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits for each chosen window, from words hashed twice."""
    where = found.at[chosen]
    if not len(where):
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    two = run_values(found.second, settings.window, 2)[where] >> np.uint64(32)
    return run_values(found.words, settings.window, 1)[where], two.astype(np.uint32).view(np.int32)


def document_anchors(found: Windows) -> np.ndarray:
    """The distinct anchors of each document, one after another."""
    new = np.ones(len(found.of), bool)
    new[1:] = (found.of[1:] != found.of[:-1]) | (found.anchors[1:] != found.anchors[:-1])
    of, anchors = found.of[new], found.anchors[new]
    order = np.lexsort((anchors, of))
    of, anchors = of[order], anchors[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (anchors[1:] != anchors[:-1])
    return anchors[new]


def cells(anchors: np.ndarray, row: int, settings: Settings) -> np.ndarray:
    """The cell of each anchor in a row of the sketch."""
    seed = np.random.default_rng((0xCE11, row)).integers(1, 1 << 63, dtype=np.uint64)
    return (mix(anchors ^ seed) >> np.uint64(64 - settings.cell_bits)).astype(np.int64)


def packed_cells(offsets: np.ndarray, size: int) -> bytes:
    """Sorted offsets as they are, or as a bitmap where that takes less room; the first byte tells which."""
    if 32 * len(offsets) <= size:
        return b"L" + offsets.astype("<u4").tobytes()
    bits = np.zeros(size, bool)
    bits[offsets] = True
    return b"B" + np.packbits(bits, bitorder="little").tobytes()


def unpacked_cells(raw: bytes) -> np.ndarray:
    body = np.frombuffer(raw, np.uint8, offset=1)
    return body.view("<u4").astype(np.int64) if raw[:1] == b"L" else np.flatnonzero(np.unpackbits(body, bitorder="little"))


SKETCH = "row int, region int, part int, once binary, more binary"


def sketch_rows(part: int, row: int, once: np.ndarray, more: np.ndarray, settings: Settings) -> Iterator[pa.RecordBatch]:
    """Sorted cells of one row of a partition's sketch, region by region."""
    shift = min(REGION_BITS, settings.cell_bits)
    edges = np.arange(settings.regions + 1) << shift
    a, b = np.searchsorted(once, edges), np.searchsorted(more, edges)
    for r in np.flatnonzero(np.diff(a) + np.diff(b)).tolist():
        cells_of = [packed_cells(x[e[r] : e[r + 1]] - (r << shift), 1 << shift) for x, e in ((once, a), (more, b))]
        yield pa.record_batch([pa.array([x]) for x in (row, r, part, *cells_of)], ARROW_SKETCH.names).cast(ARROW_SKETCH)


def partition_sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """The cells that each partition's anchors reach once, and those they reach more often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [document_anchors(windows(data, starts, settings)) for _, data, starts in pieces(batches)]
        anchors = np.concatenate(held) if held else np.zeros(0, np.uint64)
        for row in range(settings.rows):
            found, n = np.unique(cells(anchors, row, settings), return_counts=True)
            yield from sketch_rows(TaskContext.get().partitionId(), row, found[n == 1], found[n > 1], settings)

    return docs.select("text").mapInArrow(run, SKETCH)


def found_sketches(repeated: DataFrame, settings: Settings) -> DataFrame:
    """The cells of windows that are known to be repeated, as cells reached often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.unique(cells(column(batch, "one").to_numpy().view(np.uint64), 0, settings)) for batch in batches]
        if held:
            yield from sketch_rows(TaskContext.get().partitionId(), 0, np.zeros(0, np.int64), np.unique(np.concatenate(held)), settings)

    return repeated.select("one").mapInArrow(run, SKETCH)


ARROW_SKETCH = pa.schema([("row", pa.int32()), ("region", pa.int32()), ("part", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])


def merge(rows: pa.Table, settings: Settings, part: int) -> pa.Table:
    """Sketches of one region as one: a cell that two of them reach, or one reaches often, is reached often."""
    size = 1 << min(REGION_BITS, settings.cell_bits)
    seen = np.zeros(size, np.uint8)
    for once, more in zip(rows.column("once").to_pylist(), rows.column("more").to_pylist(), strict=True):
        at = unpacked_cells(once)
        seen[at] = np.minimum(seen[at] + 1, 2)
        seen[unpacked_cells(more)] = 2
    return pa.table([
        rows.column("row").slice(0, 1), rows.column("region").slice(0, 1), pa.array([part]),
        pa.array([packed_cells(np.flatnonzero(seen == 1), size)]), pa.array([packed_cells(np.flatnonzero(seen == 2), size)]),
    ], names=ARROW_SKETCH.names).cast(ARROW_SKETCH)


def merged_sketch(sketches: DataFrame, settings: Settings, height: int) -> np.ndarray:
    """The sketches of all partitions, of `height` rows, as one: a bit for each cell, set where it is reached often."""
    fan = settings.fan
    first = sketches.withColumn("some", F.floor(F.col("part") / fan).cast("int"))

    def some(rows: pa.Table) -> pa.Table:
        return merge(rows.select(ARROW_SKETCH.names), settings, rows.column("some")[0].as_py())

    def every(rows: pa.Table) -> pa.Table:
        return merge(rows, settings, 0)

    level = first.groupBy("row", "region", "some").applyInArrow(some, SKETCH)
    rows = level.groupBy("row", "region").applyInArrow(every, SKETCH).select("row", "region", "more").toArrow()
    out = np.zeros((height, 1 << max(0, settings.cell_bits - 3)), np.uint8)
    width = (1 << min(REGION_BITS, settings.cell_bits)) // 8
    for row, region, more in zip(*(rows.column(c).to_pylist() for c in ("row", "region", "more")), strict=True):
        bits = np.zeros(8 * width, bool)
        bits[unpacked_cells(more)] = True
        out[row, region * width : (region + 1) * width] = np.packbits(bits, bitorder="little")
    return out


def estimated_repeated(anchors: np.ndarray, sketch: np.ndarray, settings: Settings) -> np.ndarray:
    """Whether all rows of the sketch have the cell of each value."""
    out = np.ones(len(anchors), bool)
    for row in range(len(sketch)):
        at = cells(anchors, row, settings)
        out &= (sketch[row][at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
    return out


def candidates(rows: DataFrame, sketch: Broadcast, settings: Settings, known: Broadcast | None = None) -> DataFrame:
    """Windows estimated repeated: two hashes and the doc_id; with the sketch of those known to be repeated only windows in that,
    with the mark of their row and their first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, starts in pieces(batches):
            found = windows(data, starts, settings, twice=True)
            chosen = np.flatnonzero(estimated_repeated(found.anchors, sketch.value, settings))
            one, two = window_hashes(found, chosen, settings)
            if known is not None:
                some = estimated_repeated(one, known.value, settings)
                chosen, one, two = chosen[some], one[some], two[some]
            of = found.of[chosen]
            out = {"one": pa.array(one.view(np.int64)), "two": pa.array(two), "doc_id": column(batch, "doc_id").take(pa.array(of))}
            if known is not None:
                out |= {"mark": column(batch, "mark").take(pa.array(of)), "place": pa.array((found.at[chosen] - found.firsts[of]).astype(np.int32))}
            yield pa.record_batch(out)

    return rows.mapInArrow(run, "one long, two int, doc_id long" + ("" if known is None else ", mark long, place int"))


def repeated_windows(rows: DataFrame, sent: Broadcast, settings: Settings) -> DataFrame:
    """one, two, least: windows that start in documents of different doc_ids, and the smallest of these."""
    found = candidates(rows.select("doc_id", "text"), sent, settings)
    grouped = found.groupBy("one", "two").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    return grouped.filter("least < most").select("one", "two", "least")


def cut(docs: DataFrame, settings: Settings, text: bool) -> DataFrame:
    """The rows without the windows that start at `places`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, starts in pieces(batches):
            at, lengths, firsts = word_spans(data, starts)
            places, raw = column(batch, "places"), data.tobytes()
            gone, kept = [], []
            for k in range(batch.num_rows):
                a, b = int(firsts[k]), int(firsts[k + 1])
                covered = np.zeros(b - a + 1, np.int64)
                if places[k].is_valid:
                    first = places[k].values.to_numpy()
                    np.add.at(covered, first, 1)
                    np.add.at(covered, first + settings.window, -1)
                stay = np.flatnonzero(np.cumsum(covered[:-1]) == 0) + a
                gone.append(b - a - len(stay))
                kept.append(b" ".join([raw[i : i + n] for i, n in zip(at[stay].tolist(), lengths[stay].tolist(), strict=True)]))
            out = {
                "doc_id": column(batch, "doc_id"), "n_words": pa.array(np.diff(firsts), pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
            }
            if text:
                out["kept_text"] = pa.array([x.decode() for x in kept], pa.string())
            yield pa.record_batch(out)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if text else "")
    return docs.select("doc_id", "text", "places").mapInArrow(run, schema)


def without_repeats(docs: DataFrame, settings: Settings = Settings(), text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and with `text` the kept words joined by one space.

    A word goes if a window that covers it has the same words as one that starts in a document with a smaller doc_id; all
    windows are those of the input. `docs` has doc_id (integer) and text; other columns are ignored. Words are runs without
    ASCII white space, unchanged. A null or empty text has no words; one shorter than a window loses none. A null doc_id is
    neither smaller nor larger than another: its row stays whole and takes nothing from others. Rows of one doc_id take
    nothing from each other, and each follows its own text. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("mark"))
    known = rows.filter("doc_id is not null")
    context = spark.sparkContext
    sent = context.broadcast(merged_sketch(partition_sketches(known, settings), settings, settings.rows))
    repeated = written(repeated_windows(known, sent, settings), "repeated-windows")
    again = context.broadcast(merged_sketch(found_sketches(repeated, settings), settings, 1))
    hits = candidates(known, sent, settings, again).join(repeated, ["one", "two"]).filter("least < doc_id")
    places = hits.groupBy("doc_id", "mark").agg(F.collect_set("place").alias("places"))
    places = written(places, "places")
    for held in (sent, again):
        held.destroy()
    told = rows.alias("r").join(places.alias("p"), (F.col("r.mark") == F.col("p.mark")) & (F.col("r.doc_id") == F.col("p.doc_id")), "left")
    return cut(told.select("r.doc_id", "r.text", "p.places"), settings, text)
