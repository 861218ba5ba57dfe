"""Best-fit packing of documents into bins of fixed capacity, where no bin holds two documents that conflict.

Method. Documents conflict if they have the same source or are in the same duplicate cluster: near copies by the rule of
near_duplicates, where the caller gives their clusters. A document longer than a bin
is cut into pieces: full ones fill a bin each, the rest is packed. Pieces come longest first. Bins are held in order of
their residual room, each with a bitmap of its sources and one of its clusters; a search starts at the smallest residual
that is large enough and goes on to the next ones until a bin has neither bit set, so the tightest compatible bin is found.

Rows are dealt into shards by a hash, as many as the rows need at a fixed mean size, and each shard is packed by one task.
Copies of a cluster, rows of a hot source, and rows that repeat or have no doc_id spread over all shards, as every row's place
in the table is part of its hash. Only ids and lengths are shuffled, never texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwarden.llm.minhash import near_duplicates
from txwarden.llm.store import written


@dataclass(frozen=True)
class Settings:
    """`capacity`: words in a bin. `shard`: mean number of pieces packed together."""

    capacity: int = 2048
    shard: int = 1500


def bitmaps(keys: list) -> list[int]:
    """A bit for each key; 0 for null and for keys that occur once, which cannot conflict."""
    seen, often = set(), {}
    for key in keys:
        if key is not None and key in seen:
            often.setdefault(key, 1 << len(often))
        seen.add(key)
    return [often.get(key, 0) if key is not None else 0 for key in keys]


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int) -> tuple[list[int], list[int]]:
    """Bin and place in the bin for each piece, in the order given."""
    source_bits, cluster_bits = bitmaps(sources), bitmaps(clusters)
    order: list[tuple[int, int]] = []  # (residual, bin), ascending
    held: list[list[int]] = []  # bitmaps of a bin: sources, clusters
    bins, places = [], []
    for length, source, cluster in zip(lengths, source_bits, cluster_bits, strict=True):
        at = bisect_left(order, (length, -1))
        while at < len(order):
            has = held[order[at][1]]
            if not has[0] & source and not has[1] & cluster:
                break
            at += 1
        if at < len(order):
            room, number = order.pop(at)
            held[number][0] |= source
            held[number][1] |= cluster
        else:
            room, number = capacity, len(held)
            held.append([source, cluster])
        insort(order, (room - length, number))
        bins.append(number)
        places.append(capacity - room)
    return bins, places


def text_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def text_mark() -> Column:
    """Names rows of one doc_id and text."""
    return F.xxhash64("doc_id", "text")


def near_clusters(docs: DataFrame) -> DataFrame:
    """mark and cluster of every doc_id and text that has words: near copies, in lower case, share a cluster.

    Marks stand for the doc_ids, so that rows without a doc_id count too, and texts that share one are told apart.
    """
    found = near_duplicates(docs.select(text_mark().alias("doc_id"), F.lower("text").alias("text")))
    named = found.filter("n_shingles > 0").groupBy(F.col("doc_id").alias("mark"))
    return named.agg(F.min("component_id").alias("cluster"))


def packed(docs: DataFrame, settings: Settings = Settings(), cluster: Column | None = None, clusters: DataFrame | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, n_pieces, start, n_words, bin_id, bin_start.

    `docs` has doc_id, text and source; `cluster` names a document's duplicate cluster, by default equal texts up to the
    case of letters. `clusters` (mark, cluster), as near_clusters gives them, go before that where they name one. A null source or cluster conflicts with nothing. A null or empty text is one piece of no words. Ties
    in length go by source, doc_id and place in the document; which rows share a shard depends on how the table is cut into files. An
    empty table gives an empty result; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = F.when(F.col("text").isNotNull(), F.xxhash64(F.lower("text"))) if cluster is None else cluster
    rows = docs.select("doc_id", text_words(F.col("text")).alias("total"), F.col("source").cast("string").alias("source"), named.alias("cluster"), text_mark().alias("mark"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "lengths")
    if clusters is not None:
        near = clusters.select("mark", F.col("cluster").alias("near"))
        rows = written(rows.join(near, "mark", "left").withColumn("cluster", F.coalesce("near", "cluster")).drop("near"), "clustered")
    capacity = F.lit(settings.capacity).cast("long")
    n_pieces = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("total") / capacity))
    pieces = rows.withColumn("n_pieces", n_pieces).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_pieces") - 1)).alias("piece"))
    pieces = pieces.withColumn("start", F.col("piece") * capacity).withColumn("n_words", F.least(capacity, F.col("total") - F.col("start")))
    shards = max(1, -(-(rows.agg(F.sum(n_pieces)).first()[0] or 0) // settings.shard))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "source", "row"), F.lit(shards)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_words", "descending"), ("source", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        take = {name: table.column(name) for name in ("doc_id", "piece", "n_pieces", "start", "n_words")}
        lists = [table.column(name).to_pylist() for name in ("n_words", "source", "cluster")]
        bins, places = best_fit(*lists, settings.capacity)
        first = table.column("shard")[0].as_py() << 32
        return pa.table({**take, "bin_id": pa.array(np.array(bins, np.int64) + first), "bin_start": pa.array(places, pa.int64())})

    schema = f"doc_id {kind}, piece long, n_pieces long, start long, n_words long, bin_id long, bin_start long"
    return pieces.drop("total", "mark", "row").groupBy("shard").applyInArrow(run, schema)
