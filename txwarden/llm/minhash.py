"""Near-duplicate documents: MinHash signatures, banding, signature checks, exact checks, components.

Method. Each text becomes the set of its distinct k-word shingles (64-bit values). Many universal hash functions
h(x) = a x + b give one minimum each: the signature. Texts with one and the same set form a class, which goes on as its
smallest document. Signatures are cut into bands; classes that share a band's values are candidates. A candidate pair
must agree in enough minima, and is then confirmed by the intersection of the full sets. Links become components by
alternating large-star and small-star.

No group is expanded into rows of pairs. First each class is compared with the smallest class of its buckets; links merge
classes into components, and pairs inside one need no further look. Buckets that still hold several components are open.
Their members are cut into blocks of bounded size, and each two blocks that share an open bucket meet in one task, which
compares signatures as matrices, confirms on the full sets and gives only the links that join components. So no link is
lost, whatever the size of a bucket, and no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txwarden.llm.arrow import column, pieces
from txwarden.llm.components import components
from txwarden.llm.shingles import mix, runs, words
from txwarden.llm.store import tasks, written


@dataclass(frozen=True)
class Settings:
    """`percent`: least similarity. bands x rows minima; a pair at 0.85 is missed with probability (1 - 0.85^5)^26 = 2.4e-7.
    `agree`: least share of equal minima for an exact check (0.85 falls below 0.68 in 130 minima with probability 1e-6).
    `block`: weight of a block of members of open buckets, each member counting its shingles and 512."""

    words: int = 3
    percent: int = 85
    bands: int = 26
    rows: int = 5
    agree: float = 0.68
    block: int = 1 << 18
    seed: int = 7


def hash_family(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the universal hash functions modulo 2^32."""
    draw = np.random.default_rng(settings.seed)
    n = settings.bands * settings.rows
    return draw.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), draw.integers(0, 1 << 32, n, dtype=np.uint32)


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray], chunk: int = 2048) -> np.ndarray:
    """The minimum of each hash function over a set."""
    factors, offsets = family
    low = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(x), chunk):
        part = x[i : i + chunk]
        hashed = factors[:, None] * part[None, :]
        hashed += offsets[:, None]
        np.minimum(low, hashed.min(axis=1), out=low)
    return low


def sums(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """Two sums over a set that stand for the whole set."""
    one = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
    two = np.array([mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) for s in sets], np.uint64)
    return pa.array(one.view(np.int64)), pa.array(two.view(np.int64))


def profiles(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per document the size of its set, two sums that name the set, and the signature (empty sets have none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(settings)
        for batch, data, starts in pieces(batches):
            sets = runs(*words(data, starts), settings.words)
            f1, f2 = sums(sets)
            yield pa.record_batch({
                "doc_id": column(batch, "doc_id"), "nameless": column(batch, "nameless"),
                "n": pa.array([len(s) for s in sets], pa.int64()), "f1": f1, "f2": f2,
                "sig": pa.array([signature(s, family).tobytes() if len(s) else None for s in sets], pa.binary()),
            })

    return docs.select("doc_id", "nameless", "text").mapInArrow(run, "doc_id long, nameless boolean, n long, f1 long, f2 long, sig binary")


def full_sets(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per document its set as sorted 64-bit values, little-endian, and the sums that name it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, starts in pieces(batches):
            sets = runs(*words(data, starts), settings.words)
            f1, f2 = sums(sets)
            yield pa.record_batch({
                "rep": column(batch, "doc_id"), "f1": f1, "f2": f2, "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
            })

    return docs.select("doc_id", "text").mapInArrow(run, "rep long, f1 long, f2 long, shingles binary")


def common(pairs: DataFrame, dtype: str) -> DataFrame:
    """Pairs (x, y, of_x, of_y) to (x, y, n_x, n_y, same): equal places for minima, size of the intersection for sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, n_x, n_y = [], [], []
            for x, y in zip(column(batch, "of_x"), column(batch, "of_y"), strict=True):
                u, v = np.frombuffer(x.as_buffer(), dtype), np.frombuffer(y.as_buffer(), dtype)
                n_x.append(len(u))
                n_y.append(len(v))
                same.append(int((u == v).sum()) if dtype == "<u4" else len(np.intersect1d(u, v, assume_unique=True)))
            yield pa.record_batch({
                "x": column(batch, "x"), "y": column(batch, "y"), "n_x": pa.array(n_x, pa.int64()),
                "n_y": pa.array(n_y, pa.int64()), "same": pa.array(same, pa.int64()),
            })

    return pairs.select("x", "y", "of_x", "of_y").mapInArrow(run, "x long, y long, n_x long, n_y long, same long")


def beside(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """The values of both ends of each pair."""
    one = values.select(F.col("rep").alias("x"), F.col(name).alias("of_x"))
    two = values.select(F.col("rep").alias("y"), F.col(name).alias("of_y"))
    return pairs.join(two, "y").join(one, "x")


def linked(pairs: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """The pairs whose signatures agree and whose full sets are similar enough."""
    least = int(settings.agree * settings.bands * settings.rows)
    near = common(beside(pairs, known, "sig"), "<u4").filter(F.col("same") >= least).select("x", "y")
    checked = common(beside(near, known, "shingles"), "<u8")
    return checked.filter(F.expr(f"100 * same >= {settings.percent} * (n_x + n_y - same)")).select("x", "y")


def buckets(reps: DataFrame, settings: Settings) -> DataFrame:
    """Members (bucket, rep, n) of every band value that two classes or more share."""
    width = settings.rows * 4
    keys = F.expr(f"transform(sequence(0, {settings.bands - 1}), b -> xxhash64(b, substring(sig, b * {width} + 1, {width})))")
    rows = reps.select("rep", "n", F.explode(keys).alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high")
    return rows.join(shared, "bucket").select("bucket", "rep", "n", "low")


def with_components(rows: DataFrame, stars: DataFrame) -> DataFrame:
    return rows.join(stars.select(F.col("a").alias("rep"), F.col("b").alias("of")), "rep", "left").withColumn(
        "comp", F.coalesce("of", "rep")).drop("of")


def first_links(members: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """Links of each class with the smallest class of its buckets, as far as their sizes allow one."""
    sizes = known.select(F.col("rep").alias("hub"), F.col("n").alias("hub_n"))
    met = members.filter("low < rep").groupBy("rep", "n").agg(F.min("low").alias("hub")).join(sizes, "hub")
    near = met.filter(f"100 * least(n, hub_n) >= {settings.percent} * greatest(n, hub_n)")
    return linked(near.select(F.col("hub").alias("x"), F.col("rep").alias("y")), known, settings)


def blocks(open_rows: DataFrame, settings: Settings) -> DataFrame:
    """Each member of an open bucket once, with the block it is in: members that buckets tie together stand together."""
    low = open_rows.groupBy("bucket").agg(F.min("rep").alias("low"))
    ties = components(open_rows.join(low, "bucket").filter("low < rep").select("low", "rep").distinct())
    rows = open_rows.groupBy("rep", "n", "comp").count().drop("count")
    rows = rows.join(ties.select(F.col("a").alias("rep"), F.col("b").alias("tie")), "rep", "left").withColumn("tie", F.coalesce("tie", "rep"))
    rows = rows.withColumn("weight", F.col("n") + 512)
    dealt = written(rows.repartitionByRange(tasks(rows.sparkSession), "tie", "rep").withColumn("part", F.spark_partition_id()), "dealt")
    # Weights are summed within a part, and from part to part by one row each; so blocks are full however many parts there are.
    inside = F.sum("weight").over(Window.partitionBy("part").orderBy("tie", "rep"))
    before = dealt.groupBy("part").agg(F.sum("weight").alias("size")).selectExpr("part", "sum(size) over (order by part) - size as before")
    placed = dealt.withColumn("inside", inside).join(F.broadcast(before), "part")
    number = F.floor((F.col("before") + F.col("inside") - 1) / settings.block)
    return written(placed.select("rep", "n", "comp", "tie", number.alias("block")), "blocks")


def meet(left: pa.Table, right: pa.Table, settings: Settings) -> Iterator[tuple[int, int]]:
    """Links between members of two blocks that join components not yet joined here."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def columns(rows: pa.Table) -> tuple:
        n = [np.frombuffer(v.as_buffer(), "<u8") for v in rows.column("shingles")]
        sig = np.stack([np.frombuffer(v.as_buffer(), "<u4") for v in rows.column("sig")])
        return rows.column("rep").to_pylist(), rows.column("comp").to_pylist(), rows.column("tie").to_numpy(), n, sig

    rep, comp, tie, sets, sig = columns(left)
    rep2, comp2, tie2, sets2, sig2 = columns(right)
    least = int(settings.agree * settings.bands * settings.rows)
    for i, own in enumerate(sets):
        rivals = np.flatnonzero(tie2 == tie[i])
        agree = (sig2[rivals] == sig[i]).sum(axis=1)
        rivals = rivals[np.argsort(-agree, kind="stable")][: int((agree >= least).sum())]
        while True:
            mine = top(comp[i])
            rivals = np.array([j for j in rivals.tolist() if top(comp2[j]) != mine], np.int64)[:]
            if not len(rivals):
                break
            # The nearest first, then ever larger shares of the rest: one link spares the other members of its component.
            some, rivals = rivals[:16], rivals[16:]
            every = np.concatenate([sets2[j] for j in some])
            at = np.minimum(np.searchsorted(own, every), len(own) - 1)
            sizes = np.array([len(sets2[j]) for j in some])
            same = np.add.reduceat((own[at] == every).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            for j in some[100 * same >= settings.percent * (len(own) + sizes - same)].tolist():
                a, b = top(comp[i]), top(comp2[j])
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    yield rep[i], rep2[j]


def block_links(open_rows: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """Links between different components among the members of open buckets."""
    members = blocks(open_rows, settings)
    seats = open_rows.select("bucket", "rep").join(members.select("rep", "block"), "rep").select("bucket", "block").distinct()
    other = seats.select("bucket", F.col("block").alias("q"))
    pairs = seats.withColumnRenamed("block", "p").join(other, "bucket").filter("p <= q").select("p", "q").distinct()
    guests = pairs.select("p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("block"))
    data = members.join(known.select("rep", "sig", "shingles"), "rep")
    schema = "x long, y long"

    def run(rows: pa.Table) -> pa.Table:
        p, q = rows.column("p")[0].as_py(), rows.column("q")[0].as_py()
        rows = rows.sort_by("rep")
        left, right = rows.filter(pc.equal(rows.column("block"), p)), rows.filter(pc.equal(rows.column("block"), q))
        found = list(meet(left, right, settings)) if left.num_rows and right.num_rows else []
        return pa.table({"x": pa.array([a for a, _ in found], pa.int64()), "y": pa.array([b for _, b in found], pa.int64())})

    return guests.join(data, "block").groupBy("p", "q").applyInArrow(run, schema)


def class_links(members: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """Stars (a, b) of the components of all linked classes."""
    links = written(first_links(members, known, settings), "links")
    rows = with_components(members, components(links))
    split = rows.groupBy("bucket").agg(F.min("comp").alias("p"), F.max("comp").alias("q")).filter("p < q").select("bucket")
    open_rows = written(rows.join(split, "bucket").select("bucket", "rep", "n", "comp"), "open")
    return components(links.union(block_links(open_rows, known, settings)))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    `docs` has doc_id (integer) and text; other columns are ignored. A text is null, empty or without words: n_shingles 0,
    its own component, kept. Fewer words than a shingle: the whole sequence is one shingle. Equal sets are linked, ties go
    to the smallest doc_id. A doc_id that repeats gives a row for each of its rows, and each follows its own text; where such
    rows have different texts their components meet in the doc_id, so callers that need them apart give ids of their own. A
    document with a null doc_id links like any other, after all that have one: kept if it is alone, or the first (by a hash of
    the text) of a component without any doc_id, which has a null component_id. An empty table gives an empty result. A
    document of any length counts with all its words.
    """
    # Documents without an id stand behind the others, by their texts.
    surrogate = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    nameless = F.col("doc_id").isNull()
    docs = docs.select(F.when(nameless, surrogate).otherwise(F.col("doc_id").cast("long")).alias("doc_id"), nameless.alias("nameless"), "text")
    known = written(profiles(docs, settings), "profiles")
    least = F.min(F.struct("doc_id", "nameless", "sig")).alias("least")
    classes = written(
        known.filter("n > 0").groupBy("f1", "f2", "n").agg(least)
        .select("f1", "f2", "n", F.col("least.doc_id").alias("rep"), F.col("least.nameless").alias("nameless"), F.col("least.sig").alias("sig")), "classes")
    members = written(buckets(classes, settings), "members")
    asked = members.select("rep").distinct()
    wanted = docs.join(asked, docs["doc_id"] == asked["rep"], "left_semi")
    # A doc_id may repeat, also with other texts; a class has its own set once.
    own = classes.select("rep", "f1", "f2", "n", "sig")
    sets = full_sets(wanted, settings).join(own, ["rep", "f1", "f2"]).dropDuplicates(["rep", "f1", "f2"])
    stars = class_links(members, written(sets.select("rep", "n", "sig", "shingles"), "sets"), settings)
    named = with_components(classes.select("f1", "f2", "n", "rep"), stars).select("f1", "f2", "n", "comp")
    joined = known.filter("n > 0").select("doc_id", "nameless", "n", "f1", "f2").join(named, ["f1", "f2", "n"]).select("doc_id", "nameless", "n", "comp")
    rest = known.filter("n = 0").select("doc_id", "nameless", "n", F.col("doc_id").alias("comp"))
    # Components of documents without an id are few or none: their own smallest member tells them.
    unnamed = known.filter("nameless").select(F.col("doc_id").alias("comp")).distinct().withColumn("unnamed", F.lit(True))
    told = joined.union(rest).join(unnamed, "comp", "left")
    return told.select(
        F.when(~F.col("nameless"), F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("unnamed").isNull(), F.col("comp")).alias("component_id"), (F.col("doc_id") == F.col("comp")).alias("kept"))
