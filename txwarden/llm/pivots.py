"""Exact inner-product search by a pivot-distance index.

Method. Vectors are mapped so that a higher inner product is a smaller distance: with M the largest squared norm, x gets one
more component sqrt(M - |x|^2) and a query q gets 0; then |q' - x'|^2 = |q|^2 + M - 2 q.x. Each vector is keyed by its nearest
pivot and its distance to it; vectors of a pivot in order of distance are annuli, stored as blocks of bounded size. For a
block with distances lo..hi from its pivot no vector is nearer to q' than max(d - hi, lo - d), d being the distance of q'
and the pivot. So a query expands from the annuli nearest to it, and is done with one whose bound exceeds its k-th best distance.

Queries are met in blocks. Every query first gets a k-th best score among the sample that the pivots were chosen from; the
join of query blocks and annuli leaves out what that score excludes, which is where most of the search stops. The task that
walks a query block's annuli takes them in order of the least bound that any query of the block can have, and stops at the first
one beyond the k-th best distance of all of them: those after it are farther still. Annuli of equal bound come in order of the
block's median. Scores are integers and exact; bounds are widened by more than their rounding error.

Components travel in as few bytes as the largest one needs, one for unit vectors times 64. Products are taken in double
precision while the largest squared norm, which no score exceeds, is exact there, and in 64-bit integers beyond.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwarden.llm.arrow import column
from txwarden.llm.store import tasks, written

# Products of larger numbers than this would no longer be exact in double precision, or fit no 64-bit integer.
EXACT = 1 << 52
LARGEST = 1 << 62
# The k-th best score of a query that has none yet.
NONE = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Settings:
    """`sample`: most vectors that pivots are chosen from; every vector is indexed. `pivots`, and `rows` of an annulus block
    at most, `queries` of a query block at most. `lane`: annuli of a query block that one task walks on average."""

    scale: int = 64
    k: int = 20
    sample: int = 2000
    pivots: int = 48
    rows: int = 512
    queries: int = 256
    lane: int = 256
    seed: int = 5


def whole_vectors(rows: DataFrame, settings: Settings) -> DataFrame:
    """vec_id and floor(scale * x) of the rows that take part: no null in the row's vector, only finite components, an id."""
    x = lambda v: F.floor(F.lit(float(settings.scale)) * v.cast("double"))
    usable = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(
        F.coalesce(usable, F.lit(False))).select("vec_id", F.transform("embedding", x).alias("v"))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors of the sample that lie far apart: each next one is the farthest from those before it."""
    if not len(sample):
        return sample
    chosen, away = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


@dataclass(frozen=True)
class Index:
    """What a task must know: length of the vectors, the largest squared norm, the type that components travel in, pivots with
    their added component, the sample."""

    width: int
    most: float
    kind: str
    pivots: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(float)
        return np.column_stack([x, np.sqrt(np.maximum(self.most - (x * x).sum(axis=1), 0))])

    def read(self, raw: pa.BinaryScalar, rows: int) -> np.ndarray:
        return np.frombuffer(raw.as_buffer(), self.kind).reshape(rows, self.width).astype(np.int64)

    def scores(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Inner products of the rows of two tables of integers, exact."""
        return (x.astype(float) @ y.astype(float).T).astype(np.int64) if self.most <= EXACT else x @ y.T

    def radius(self, squares: np.ndarray, floors: np.ndarray) -> np.ndarray:
        """How far a vector may be that reaches a score, for queries of given squared norms."""
        least = np.where(floors == NONE, -np.inf, floors)
        return np.sqrt(np.maximum(squares + self.most - 2 * least, 0)) + self.slack()

    def to_pivots(self, lifted: np.ndarray) -> np.ndarray:
        squares = (lifted * lifted).sum(axis=1)[:, None] + (self.pivots * self.pivots).sum(axis=1)[None, :] - 2 * lifted @ self.pivots.T
        return np.sqrt(np.maximum(squares, 0))

    def slack(self) -> float:
        """More than the rounding error of a distance: its square is off by far less than 1e-12 of the largest square."""
        return 1e-5 * max(1.0, float(np.sqrt(self.most)))


def dense(lists: pa.Array, width: int) -> np.ndarray:
    """A row of integers for each list, shorter ones filled up with zeros."""
    out = np.zeros((len(lists), width), np.int64)
    values, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    lengths = np.diff(offsets)
    out[np.repeat(np.arange(len(lists)), lengths), np.arange(len(values)) - np.repeat(offsets[:-1], lengths)] = values
    return out


def fitted(vectors: DataFrame, settings: Settings) -> Index:
    """Sizes from one pass over all vectors; pivots from a bounded sample by hashed id."""
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    size = F.max(F.aggregate("v", F.lit(0).cast("long"), lambda s, x: F.greatest(s, F.when(x < 0, -(x + 1)).otherwise(x))))
    width, most, largest = vectors.agg(F.max(F.size("v")), F.max(square), size).first()
    if most is not None and most > LARGEST:
        raise ValueError(f"with a squared norm of {most:g} scores may not fit a long")
    kind = next(k for k in ("i1", "<i2", "<i4", "<i8") if (largest or 0) <= np.iinfo(k).max)
    picked = vectors.orderBy(F.xxhash64(F.lit(settings.seed), "vec_id"), "vec_id").limit(settings.sample).toArrow()
    width = width or 0
    sample = dense(picked.column("v").combine_chunks(), width) if picked.num_rows else np.zeros((0, width), np.int64)
    index = Index(width, float(most or 0), kind, np.zeros((0, width + 1)), picked.column("vec_id").to_numpy(), sample)
    return Index(width, index.most, kind, choose_pivots(index.lifted(sample), settings.pivots), index.sample_ids, sample)


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th highest score of each row, NONE where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), NONE)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def keyed(vectors: DataFrame, sent, queries: bool, settings: Settings) -> DataFrame:
    """Nearest pivot and distance of each vector; of queries also the k-th best score in the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            x = dense(column(batch, "v"), index.width)
            ids = column(batch, "vec_id").to_numpy()
            lifted = np.column_stack([x, np.zeros(len(x))]) if queries else index.lifted(x)
            away = index.to_pivots(lifted)
            near = away.argmin(axis=1) if len(x) else np.zeros(0, np.int64)
            floor = np.full(len(x), NONE)
            if queries and len(x):
                scores = np.where(ids[:, None] == index.sample_ids[None, :], NONE, index.scores(x, index.sample))
                floor = kth_best(scores, settings.k)
            raw = x.astype(index.kind)
            yield pa.record_batch({
                "vec_id": column(batch, "vec_id"), "pivot": pa.array(near, pa.int32()), "away": pa.array(away[np.arange(len(x)), near]),
                "floor": pa.array(floor), "raw": pa.array([r.tobytes() for r in raw], pa.binary()),
            })

    return vectors.mapInArrow(run, "vec_id long, pivot int, away double, floor long, raw binary")


def in_blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows in order of pivot and distance, cut into blocks of one pivot and at most `size` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held, pivot = TaskContext.get().partitionId(), 0, [], None

        def out() -> pa.RecordBatch:
            nonlocal number, held
            number += 1
            return pa.record_batch({
                "block": pa.array([(part << 32) + number], pa.int64()), "pivot": pa.array([pivot], pa.int32()),
                "lo": pa.array([held[0][1]]), "hi": pa.array([held[-1][1]]), "floors": pa.array([[r[2] for r in held]], pa.list_(pa.int64())),
                "ids": pa.array([[r[0] for r in held]], pa.list_(pa.int64())), "vectors": pa.array([b"".join(r[3] for r in held)], pa.binary()),
            })

        for batch in batches:
            names = ("vec_id", "away", "floor", "raw")
            for p, *row in zip(column(batch, "pivot").to_pylist(), *[column(batch, n).to_pylist() for n in names], strict=True):
                if held and (p != pivot or len(held) == size):
                    yield out()
                    held = []
                pivot = p
                held.append(row)
        if held:
            yield out()

    order = ["pivot", "away", "vec_id"]
    dealt = rows.repartitionByRange(tasks(rows.sparkSession), *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "block long, pivot int, lo double, hi double, floors array<long>, ids array<long>, vectors binary")


def reach(blocks: DataFrame, sent) -> DataFrame:
    """For each query block and pivot: nearest, farthest and median distance of its queries, and the range still asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            for block, ids, floors, raw in zip(*[column(batch, n) for n in ("block", "ids", "floors", "vectors")], strict=True):
                x = index.read(raw, len(ids)).astype(float)
                away = index.to_pivots(np.column_stack([x, np.zeros(len(x))]))
                radius = index.radius((x * x).sum(axis=1), np.array(floors.as_py()))
                n = len(index.pivots)
                yield pa.record_batch({
                    "asker": pa.array([block.as_py()] * n, pa.int64()), "pivot": pa.array(range(n), pa.int32()),
                    "near": pa.array((away - radius[:, None]).min(axis=0)), "far": pa.array((away + radius[:, None]).max(axis=0)),
                    "least": pa.array(away.min(axis=0)), "most": pa.array(away.max(axis=0)), "mid": pa.array(np.median(away, axis=0)),
                })

    return blocks.mapInArrow(run, "asker long, pivot int, near double, far double, least double, most double, mid double")


class Walk:
    """The search of one query block over annuli that come in order of their bound."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floors: np.ndarray, index: Index, k: int):
        self.ids, self.x, self.k, self.index = ids, vectors, k, index
        self.floor, self.over = floors.copy(), False
        x = vectors.astype(float)
        self.away = index.to_pivots(np.column_stack([x, np.zeros(len(x))]))
        self.square = (x * x).sum(axis=1)
        none = np.zeros(0, np.int64)
        self.row, self.found, self.score = none, none, none

    def ends(self, bound: float) -> bool:
        """Whether an annulus of this bound, and so every later one, is beyond all queries."""
        self.over = self.over or bound > self.index.radius(self.square, self.floor).max()
        return self.over

    def meet(self, pivot: int, lo: float, hi: float, ids: np.ndarray, vectors: np.ndarray) -> None:
        radius = self.index.radius(self.square, self.floor)
        bound = np.maximum(self.away[:, pivot] - hi, lo - self.away[:, pivot])
        open_ = np.flatnonzero(bound <= radius)
        if not len(open_):
            return
        scores = self.index.scores(self.x[open_], vectors)
        good = (scores >= self.floor[open_][:, None]) & (self.ids[open_][:, None] != ids[None, :])
        at, j = np.nonzero(good)
        self.row = np.concatenate([self.row, open_[at]])
        self.found, self.score = np.concatenate([self.found, ids[j]]), np.concatenate([self.score, scores[at, j]])
        order = np.lexsort((self.found, -self.score, self.row))
        row = self.row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        order = order[place < self.k]
        self.row, self.found, self.score = self.row[order], self.found[order], self.score[order]
        last = np.flatnonzero(place[place < self.k] == self.k - 1)
        self.floor[self.row[last]] = np.maximum(self.floor[self.row[last]], self.score[last])

    def result(self) -> pa.RecordBatch:
        return pa.record_batch({
            "query_id": pa.array(self.ids[self.row], pa.int64()), "vec_id": pa.array(self.found, pa.int64()),
            "score": pa.array(self.score, pa.int64()),
        })


def top_scores(rows: DataFrame, is_query: Column, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest integer inner products for each query row.

    `rows` has vec_id and embedding; `is_query` is a condition on vec_id. Vectors that are null or hold a null or non-finite
    component, and rows without an id, take no part; shorter vectors count as filled up with zeros. A query is not its own
    candidate, and rows that share an id are not each other's; a repeated row is a candidate as often as it occurs, and a
    repeated query is asked once. Ties go to the smaller vec_id; with fewer candidates all are returned. An empty table
    gives an empty result. Scores are exact up to the largest squared norm that a long holds, 2^62; beyond, where a score might not fit
    its column, the input is refused with an error.
    """
    spark = rows.sparkSession
    vectors = written(whole_vectors(rows, settings), "vectors")
    sent = spark.sparkContext.broadcast(fitted(vectors, settings))
    annuli = written(in_blocks(keyed(vectors, sent, False, settings), settings.rows).drop("floors"), "annuli")
    asked = vectors.filter(is_query).dropDuplicates(["vec_id"])
    asking = written(in_blocks(keyed(asked, sent, True, settings), settings.queries), "asking")
    inside = annuli.select("block", "pivot", "lo", "hi").join(reach(asking, sent), "pivot").filter("hi >= near and lo <= far")
    beyond = lambda first, last: F.greatest(F.col(first) - F.col("hi"), F.col("lo") - F.col(last), F.lit(0.0))
    visits = written(inside.select("asker", "block", beyond("least", "most").alias("bound"), beyond("mid", "mid").alias("next")), "visits")
    lanes = visits.groupBy("asker").agg(F.ceil(F.count("*") / settings.lane).alias("lanes"))
    visits = visits.join(lanes, "asker").withColumn("lane", F.pmod(F.xxhash64("block"), F.col("lanes"))).drop("lanes")
    # Each lane begins with its query block, which sorts before all annuli.
    seats = visits.select("asker", "lane").distinct().join(asking.withColumnRenamed("block", "asker"), "asker")
    head = seats.select("asker", "lane", F.lit(-1.0).alias("bound"), F.lit(0.0).alias("next"), F.lit(-1).alias("pivot"), F.lit(0.0).alias("lo"), F.lit(0.0).alias("hi"), "floors", "ids", "vectors")
    tail = visits.join(annuli, "block").select(
        "asker", "lane", "bound", "next", "pivot", "lo", "hi", F.array().cast("array<long>").alias("floors"), "ids", "vectors")
    stream = head.union(tail).repartition(tasks(spark), "asker", "lane").sortWithinPartitions("asker", "lane", "bound", "next", "pivot", "lo")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, walk = sent.value, None
        for batch in batches:
            cells = [column(batch, n) for n in ("bound", "pivot", "lo", "hi", "floors", "ids", "vectors")]
            for bound, pivot, lo, hi, floors, ids, raw in zip(*cells, strict=True):
                if pivot.as_py() < 0:
                    if walk is not None:
                        yield walk.result()
                    walk = Walk(ids.values.to_numpy(), index.read(raw, len(ids)), floors.values.to_numpy(), index, settings.k)
                elif not walk.ends(bound.as_py()):
                    walk.meet(pivot.as_py(), lo.as_py(), hi.as_py(), ids.values.to_numpy(), index.read(raw, len(ids)))
        if walk is not None:
            yield walk.result()

    found = stream.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= settings.k).select("query_id", "rank", "vec_id", "score")
