"""Prefix trie of conversations: union-find over the LCP edges of sorted neighbours, merged across partitions.

Method. A conversation is its sequence of turns, each turn 128 bits of hash of role and text. Sequences are range-partitioned in
order, ties by conv_id, so copies of one conversation spread over partitions like any other rows. In a partition every two
neighbours share an edge, weighted by the length of their longest common prefix. Edges are taken in descending depth and their
ends united: whatever is united at one depth has a branching node there, and the nodes between two branching nodes form a
chain of single children, which is expanded at the end. What a node needs is a sum, a minimum or a count over its rows.

A node is open if its rows reach over a border of partitions, which the common prefix of the two rows at the border tells: one
number a border. So a partition's forest is contracted to its closed nodes, which are final, and to its open nodes, which carry
the partition's share. The parts of an open node are named by the first partition that it reaches and its depth, and are
summed up by these. The ids of conversations that end at an open node go on in their order, as pieces of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txwarden.llm.arrow import column
from txwarden.llm.store import written

HASH = 16  # bytes of a turn
TURNS = 100_000  # turns of a partition, about
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
# What a partition says: a closed node, or its share of the open node (owner, depth). parent_owner names an open parent.
SHARE = "owner int, part int, ends string, parent_owner int, open boolean, " + NODE


def turns(rows: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each a hash (hexadecimal) and the bytes of its text. Ties of turn go by the hash."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct("turn", F.substring(F.sha2(whole, 256), 1, 2 * HASH).alias("hash"), F.octet_length(text).alias("size"))
    known = rows.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    ordered = known.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda x: F.struct(x["hash"].alias("hash"), x["size"].alias("size"))).alias("t"))


def rebuilt(own: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Each conversation with its first h turns from the first conversation of its group, h = crc32(decimal conv_id) % most."""
    first = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    base = own.filter(F.pmod("conv_id", F.lit(group)) == 0).select(F.col("conv_id").alias("base"), F.slice("t", 1, most).alias("begin"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    joined = own.withColumn("base", first).withColumn("h", h).join(base, "base", "left")
    begin = F.when(F.col("begin").isNull(), F.slice("t", 1, 0)).otherwise(F.slice("begin", F.lit(1), F.col("h")))
    rest = F.slice("t", F.col("h") + 1, F.greatest(F.lit(0), F.size("t") - F.col("h")))
    return joined.select("conv_id", F.concat(begin, rest).alias("t"))


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, the hashes of its turns end to end, and the bytes of their texts."""
    hashes = F.unhex(F.array_join(F.transform("t", lambda x: x["hash"]), ""))
    return conversations.select("conv_id", hashes.alias("seq"), F.transform("t", lambda x: x["size"]).alias("sizes"))


def flat_turns(seqs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All turns as pairs of numbers, and where each sequence begins (n + 1 values)."""
    seqs = seqs.cast(pa.large_binary())
    _, offsets, data = seqs.buffers()
    where = np.frombuffer(offsets, np.int64)[seqs.offset : seqs.offset + len(seqs) + 1]
    raw = np.frombuffer(data, np.uint8)[where[0] : where[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.reshape(-1, HASH).view("<u8"), (where - where[0]) // HASH


def neighbour_prefixes(seqs: pa.Array) -> np.ndarray:
    """The length of the common prefix of each sequence and the one before it; -1 for the first."""
    flat, starts = flat_turns(seqs)
    out = np.full(len(seqs), -1, np.int64)
    if len(seqs) < 2:
        return out
    lengths = np.diff(starts)
    both = np.minimum(lengths[1:], lengths[:-1])
    of = np.repeat(np.arange(len(both)), both)
    place = np.arange(len(of)) - np.repeat(np.cumsum(both) - both, both)
    differ = (flat[starts[of + 1] + place] != flat[starts[of] + place]).any(axis=1)
    out[1:] = both
    at = np.flatnonzero(differ)[::-1]
    out[of[at] + 1] = place[at]  # the first difference of each is written last
    return out


def common_prefix(one: bytes, two: bytes) -> int:
    a, b = (np.frombuffer(x, np.uint8).reshape(-1, HASH) for x in (one, two))
    n = min(len(a), len(b))
    differ = np.flatnonzero((a[:n] != b[:n]).any(axis=1))
    return int(differ[0]) if len(differ) else n


class Forest:
    """Components of neighbouring rows, united edge by edge; a component is known by its root, and has a top node.

    `nodes` are the tops that are done, as (top depth, lowest depth of its chain, first row, rows, children of the top, rows
    that end at the top, what the subtree below the top saves).
    """

    def __init__(self, lengths: np.ndarray, conv: np.ndarray, leaf: np.ndarray, sums: list[np.ndarray]):
        n = len(lengths)
        self.parent, self.first, self.rows = list(range(n)), list(range(n)), [1] * n
        self.top, self.children, self.ends, self.below = lengths.tolist(), [0] * n, [1] * n, [0] * n
        self.least, self.leaves, self.sums = conv.tolist(), leaf.tolist(), sums
        self.nodes: list[tuple] = []

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def lift(self, x: int, depth: int) -> None:
        """Close the chain from a component's top up to below `depth`, and make `depth` its top."""
        top = self.top[x]
        if top == depth:
            return
        self.close(x, depth + 1)
        sums = self.sums[self.first[x]]
        self.below[x] += (self.rows[x] - 1) * int(sums[top] - sums[depth])
        self.top[x], self.children[x], self.ends[x] = depth, 1, 0

    def close(self, x: int, lowest: int) -> None:
        self.nodes.append((
            self.top[x], lowest, self.first[x], self.rows[x], self.children[x], self.ends[x], self.below[x], self.least[x], self.leaves[x],
        ))

    def unite(self, left: int, right: int, depth: int) -> None:
        """Two neighbouring components under one node at `depth`."""
        a, b = self.find(left), self.find(right)
        self.lift(a, depth)
        self.lift(b, depth)
        if self.rows[a] < self.rows[b]:
            a, b = b, a
        self.parent[b] = a
        self.first[a] = min(self.first[a], self.first[b])
        for values in (self.rows, self.children, self.ends, self.below, self.leaves):
            values[a] += values[b]
        self.least[a] = min(self.least[a], self.least[b])

    def done(self) -> list[np.ndarray]:
        """All nodes, down to the root, as columns."""
        if self.parent:
            last = self.find(0)
            self.lift(last, 0)
            self.close(last, 0)
        return [np.array(x, np.int64) for x in zip(*self.nodes, strict=True)]


def forest(rows: pa.Table, borders: np.ndarray, inner: np.ndarray) -> pa.Table:
    """Nodes and shares of one partition. `borders[p]`: the common prefix of the last row before partition p and its first, -1
    before the first partition and after the last; `inner[p]`: that of the first row of p and its last."""
    part = rows.column("part")[0].as_py()
    rows = rows.sort_by([("seq", "ascending"), ("conv_id", "ascending")]).combine_chunks()
    conv = rows.column("conv_id").to_numpy()
    seqs = rows.column("seq").chunk(0)
    lengths = np.diff(flat_turns(seqs)[1])
    prefix = neighbour_prefixes(seqs)
    before, after = int(borders[part]), int(borders[part + 1])
    leaf = (np.append(prefix[1:], after) < lengths).astype(np.int64)
    sums = [np.concatenate([[0], np.cumsum(x.values.to_numpy(), dtype=np.int64)]) for x in rows.column("sizes").chunk(0)]
    made = Forest(lengths, conv, leaf, sums)
    for i in (np.argsort(-prefix[1:], kind="stable") + 1).tolist():
        made.unite(i - 1, i, int(prefix[i]))
    top, low, first, n, children, ends, below, least, leaves = made.done()

    # Chains: node j of chain c has depth top - j.
    size = top - low + 1
    c = np.repeat(np.arange(len(top)), size)
    depth = top[c] - (np.arange(len(c)) - np.repeat(np.cumsum(size) - size, size))
    at_top = depth == top[c]
    # Text bytes of the turns up to each depth, of the first row of each chain.
    begins = np.cumsum([0, *map(len, sums)])
    flat = np.concatenate(sums) if sums else np.zeros(0, np.int64)
    upto = lambda rows, depths: flat[begins[rows] + np.maximum(depths, 0)]
    saved = below[c] + (n[c] - 1) * (upto(first[c], top[c]) - upto(first[c], depth - 1))
    left, right = first[c] == 0, first[c] + n[c] == len(conv)
    # Nodes that began before this partition count all rows here: their first one is elsewhere.
    earlier = left & (depth <= before)
    saved += np.where(earlier, flat[np.where(left, before, 0)] - upto(0, depth - 1), 0) if before >= 0 else 0
    kids = np.where(at_top, children[c], 1) - (left & (depth + 1 <= before) & (np.where(at_top, lengths[0], top[c]) > depth))
    is_open = earlier | (right & (depth <= after))
    owner = owners(borders, inner, part, int(max(before, after)))
    owned = np.where(earlier, owner[np.minimum(depth, len(owner) - 1)], part)

    # The parent of a node is one less deep, on the same chain or the top of the chain above.
    order = np.lexsort((first[c], depth))
    key_depth, key_first = depth[order], first[c][order]
    parent_at = np.full(len(c), -1, np.int64)
    above = np.flatnonzero(depth > 0)
    keys = key_depth * (len(conv) + 1) + key_first
    parent_at[above] = order[np.searchsorted(keys, (depth[above] - 1) * (len(conv) + 1) + first[c][above], "right") - 1]
    parent_conv = np.where(parent_at >= 0, least[c][parent_at], 0)
    parent_open = (parent_at >= 0) & is_open[parent_at]
    some_ends = np.where(at_top, ends[c], 0)
    texts = [",".join(map(str, conv[f : f + e].tolist())) if e else "" for f, e in zip(first[c].tolist(), some_ends.tolist(), strict=True)]
    closed = ~is_open
    return pa.table({
        "owner": pa.array(owned, pa.int32()), "part": pa.array([part] * len(c), pa.int32()),
        "ends": pa.array([t if o else None for t, o in zip(texts, is_open.tolist(), strict=True)], pa.string()),
        "parent_owner": pa.array(owned[parent_at], pa.int32(), mask=~parent_open), "open": pa.array(is_open),
        "conv_id": pa.array(least[c]), "depth": pa.array(depth),
        "parent_conv_id": pa.array(parent_conv, pa.int64(), mask=(depth == 0) | parent_open),
        "n_convs": pa.array(n[c]), "n_children": pa.array(kids), "n_leaves": pa.array(leaves[c]), "saved_tokens": pa.array(saved),
        "ends_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() if k else None for t, k in zip(texts, closed.tolist(), strict=True)], pa.string()),
    })


def owners(borders: np.ndarray, inner: np.ndarray, part: int, deepest: int) -> np.ndarray:
    """For each depth the first partition that the node reaches which is open at this partition's left border: the borders
    and the whole partitions between have common prefixes of that depth at least."""
    out, q = np.full(max(deepest, 0) + 2, part, np.int64), part
    reach = int(borders[part])
    while reach >= 0:
        q -= 1
        out[: reach + 1] = q
        reach = min(reach, int(inner[q]), int(borders[q]))
    return out


def hashed_ends(pieces: DataFrame) -> DataFrame:
    """owner, depth, ends_sha256 of open nodes. A node's pieces are hashed one after another; only a node whose ends reach
    over a border has several, and a hash of a sequence has to read it in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, more = None, None, False
        for batch in batches:
            out = []
            for owner, depth, text in zip(*(column(batch, x).to_pylist() for x in ("owner", "depth", "ends")), strict=True):
                if key != (owner, depth):
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state, more = (owner, depth), hashlib.sha256(), False
                if text:
                    state.update((("," if more else "") + text).encode())
                    more = True
            if out:
                yield batch_of(out)
        if key is not None:
            yield batch_of([(*key, state.hexdigest())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        a, b, c = zip(*rows, strict=True)
        return pa.record_batch({"owner": pa.array(a, pa.int32()), "depth": pa.array(b, pa.int64()), "ends_sha256": pa.array(c, pa.string())})

    dealt = pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "part")
    return dealt.select("owner", "depth", "ends").mapInArrow(run, "owner int, depth long, ends_sha256 string")


def border_prefixes(dealt: DataFrame) -> list[tuple[int, int, int]]:
    """For each partition with rows, in order: its number, the common prefix of its first row and the last row of the one before
    (-1 for the first), and that of its first row and its last.

    The rows at borders, one or two a partition, are compared by Spark; the driver sees two numbers each.
    """
    row = F.struct("seq", "conv_id")
    ends = dealt.groupBy("part").agg(F.min(row).alias("a"), F.max(row).alias("z"))
    beside = ends.select("part", F.col("a.seq").alias("one"), F.lag("z.seq").over(Window.orderBy("part")).alias("two"), F.col("z.seq").alias("last"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two, last = (column(batch, x).to_pylist() for x in ("one", "two", "last"))
            found = [-1 if y is None else common_prefix(x, y) for x, y in zip(one, two, strict=True)]
            whole = [common_prefix(x, y) for x, y in zip(one, last, strict=True)]
            yield pa.record_batch({"part": column(batch, "part"), "prefix": pa.array(found, pa.int32()), "inner": pa.array(whole, pa.int32())})

    rows = beside.mapInArrow(run, "part int, prefix int, inner int").collect()
    return sorted(tuple(r) for r in rows)


def prefix_trie(conversations: DataFrame, turns_a_part: int = TURNS) -> DataFrame:
    """One row per node of the trie of sequences: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    `conversations` has conv_id, seq (16 bytes a turn, end to end) and sizes (bytes of each turn's text), one row for each
    conversation; `sequences` gives them. A conversation without turns is a member of the root only. An empty table has no
    node. `turns_a_part`: turns that a task holds, about; a conversation is never split.
    """
    spark = conversations.sparkSession
    kept = written(conversations, "sequences")
    total = kept.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    parts = max(1, -(-total // turns_a_part))
    dealt = kept.repartitionByRange(parts, "seq", "conv_id").withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "dealt")
    found = border_prefixes(dealt)
    # Partitions are numbered anew, so that those without rows leave no gap.
    number = {p: i for i, (p, _, _) in enumerate(found)}
    borders, inner = np.array([*(b for _, b, _ in found), -1], np.int64), np.array([w for _, _, w in found], np.int64)
    sent = spark.sparkContext.broadcast((number, borders, inner))

    def run(rows: pa.Table) -> pa.Table:
        number, borders, inner = sent.value
        part = number[rows.column("part")[0].as_py()]
        return forest(rows.set_column(rows.schema.get_field_index("part"), "part", pa.array([part] * rows.num_rows, pa.int32())), borders, inner)

    shares = written(dealt.groupBy("part").applyInArrow(run, SHARE), "shares")
    opened = shares.filter("open")
    merged = opened.groupBy("owner", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.min(F.struct("part", "parent_owner")).alias("first"))
    ends = hashed_ends(opened.select("owner", "depth", "part", "ends"))
    merged = written(merged.join(ends, ["owner", "depth"]), "open-nodes")
    sent.destroy()
    names = [f.split()[0] for f in NODE.split(", ")]
    parents = merged.select(F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("up"))
    tops = merged.select("*", F.col("first.parent_owner").alias("parent_owner"), F.lit(None).cast("long").alias("parent_conv_id")).select(*names, "parent_owner")
    hanging = shares.filter("not open and parent_owner is not null").select(*names, "parent_owner").union(tops)
    told = hanging.join(parents, ["parent_owner", "depth"], "left").withColumn("parent_conv_id", F.col("up")).select(*names)
    return told.union(shares.filter("not open and parent_owner is null").select(*names))


def conversation_trie(rows: DataFrame, turns_a_part: int = TURNS) -> DataFrame:
    """The trie of rebuilt conversations, one row per node, as `prefix_trie` describes.

    `rows` has conv_id (integer), turn, role and text; other columns are ignored. Turns are in order of `turn`, null first, ties by
    the hash of role and text; a null role or text is empty. Rows without a conv_id belong to no conversation and are left
    out. Repeated rows are turns of their own. A conversation is one row of hashes, 20 bytes a turn. conv_id - conv_id % 5 is
    taken with a remainder of 0 to 4 for negative ids, too.
    """
    return prefix_trie(sequences(rebuilt(turns(rows))), turns_a_part)
