"""Alignment of two tokenizers over a corpus: which tokens of one stand for which of the other, counted by external spilling.

Method. Both tokenizers encode a text, and byte offsets where tokens of both end cut it into groups; each token of one side in a
group is linked with each of the other side there. A document's distinct linked pairs are records (pair, document, times).
Records of a chunk of documents are cut by a radix of the first side's id and sorted, first side major, into runs, which are
compressed and written: the pairs of a run with the number of its documents that hold each, and beside them the records.

The pairs of all runs of a radix part are merged by a heap over the ends of the runs' blocks: the run whose block ends first is
taken up to there, with all that others have up to there, so blocks are merged whole and in order. Runs are merged a bounded
number at a time, level by level, until one is left; there all pairs of a first-side id stand side by side, which gives each
id's highest count. The counts then go back to the runs they came from, again a bounded number of runs in a task, and each run
streams out what its records contribute to their documents.

A pair that every document holds is one record in the pairs of a run, so no id or pair makes a task large; the documents of a
hot pair stay in the runs of their own chunks.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.llm.arrow import column, pieces
from txwarden.llm.chunks import ChunkCoder
from txwarden.llm.presplit import Cutter, Layout, byte_letters, layout
from txwarden.llm.store import written


@dataclass(frozen=True)
class Settings:
    """`radix`: bits of the first side's ids that part the records. A chunk of documents ends at `chunk_docs` documents or
    `chunk_links` distinct links; `fan`: runs that one task merges or counts back; `block`: pairs that the heap takes at once."""

    radix: int = 4
    chunk_docs: int = 1 << 14
    chunk_links: int = 1 << 21
    fan: int = 64
    block: int = 4096


def packed(values: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, kind).tobytes())


def unpacked(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def packed_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers as their differences."""
    return packed(np.diff(values, prepend=values.dtype.type(0)), "<u8")


def unpacked_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw, "<u8"), dtype=np.uint64)


class Pieces:
    """Byte strings by number, laid end to end so that many can be put together at once."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, which: np.ndarray) -> np.ndarray:
        sizes = self.sizes[which]
        shift = self.starts[which] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]


def byte_level_tokens(spec: str) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer file; added tokens stand as their text."""
    from tokenizers import Tokenizer

    library, letters = Tokenizer.from_str(spec), byte_letters()
    out = [b""] * library.get_vocab_size()
    for word, i in library.get_vocab(with_added_tokens=True).items():
        out[i] = bytes(letters[x] for x in word) if all(x in letters for x in word) else word.encode()
    return out


def piece_tokens(model: bytes) -> list[bytes]:
    """The bytes of each id of a piece model: U+2581 is a space, <0xHH> a byte."""
    import sentencepiece

    library, out = sentencepiece.SentencePieceProcessor(model_proto=model), []
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace("▁", " ").encode())
    return out


class Encoders:
    """Both tokenizers. Special tokens in a text are plain text."""

    def __init__(self, spec: str, plan: Layout, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(spec)
        self.first.no_padding()
        self.first.no_truncation()
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.coder = ChunkCoder(Cutter(Layout(plan.words, plan.chunks, {})), self.chunk_ids, 20)
        self.bytes_a, self.bytes_b = Pieces(byte_level_tokens(spec)), Pieces(piece_tokens(model))
        names = [str(i).encode() for i in range(max(len(self.bytes_a.sizes), len(self.bytes_b.sizes)))]
        # Ids as they are written, before each mark that can follow one.
        self.names = Pieces([x + mark for mark in (b",", b"|", b";") for x in names])
        self.named = len(names)
        self.bits_b = max(1, (len(self.bytes_b.sizes) - 1).bit_length())

    def chunk_ids(self, chunks: list[str]) -> list[list[int]]:
        return [found.ids for found in self.first.encode_batch_fast(chunks, add_special_tokens=False)]

    def encode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides of all texts end to end, and where each text's ids begin. `data`: each text after a space."""
        a, first_a = self.coder.encode(data, starts)
        raw = data.tobytes()
        texts = [raw[s + 1 : e].decode() for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        lists = self.second.encode(texts, num_threads=1) if texts else []
        first_b = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
        b = np.concatenate([np.array(x, np.int64) for x in lists]) if lists else np.zeros(0, np.int64)
        return a.astype(np.int64), first_a.astype(np.int64), b, first_b


def spaced(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A space before each text that has bytes; the other texts stay empty."""
    sizes = np.diff(starts)
    heads = starts[:-1][sizes > 0]
    added = np.cumsum(sizes > 0)
    return np.insert(data, heads, 0x20), starts + np.concatenate([[0], added])


def same_text(tokens: Pieces, ids: np.ndarray, firsts: np.ndarray, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether the bytes of each text's tokens are the text."""
    ends = np.concatenate([[0], np.cumsum(tokens.sizes[ids])])[firsts]
    sizes, own = np.diff(ends), np.diff(starts)
    out = sizes == own
    joined = tokens.joined(ids)
    some = np.flatnonzero(out & (own > 0))
    if len(some):
        shift, n = np.cumsum(own[some]) - own[some], own[some]
        place = np.arange(int(n.sum()))
        differ = joined[np.repeat(ends[some] - shift, n) + place] != data[np.repeat(starts[some] - shift, n) + place]
        out[some] = ~np.logical_or.reduceat(differ, shift)
    return out


def chosen_spans(firsts: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """The places of all tokens of the texts to keep."""
    n = np.diff(firsts)
    return np.flatnonzero(np.repeat(keep, n))


@dataclass(frozen=True)
class Groups:
    """Tokens of both sides, and for each group of the piece where its tokens begin on either side (n + 1 values)."""

    a: np.ndarray
    b: np.ndarray
    of: np.ndarray
    begin_a: np.ndarray
    begin_b: np.ndarray


def grouped(tokens: Encoders, a: np.ndarray, b: np.ndarray, of_a: np.ndarray) -> Groups:
    """Cut both sides where tokens of both end. The texts of both are the same, end to end; `of_a` names the text of each token."""
    end_a, end_b = np.cumsum(tokens.bytes_a.sizes[a]), np.cumsum(tokens.bytes_b.sizes[b])
    cuts = np.intersect1d(end_a, end_b, assume_unique=True)
    last_a, last_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
    return Groups(a, b, of_a[last_a], np.concatenate([[0], last_a + 1]), np.concatenate([[0], last_b + 1]))


def outer(groups: Groups, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, first id and second id of every pair of tokens of the groups."""
    n_a, n_b = np.diff(groups.begin_a)[which], np.diff(groups.begin_b)[which]
    of = np.repeat(np.arange(len(which)), n_a * n_b)
    place = np.arange(len(of)) - np.repeat(np.cumsum(n_a * n_b) - n_a * n_b, n_a * n_b)
    return which[of], groups.a[groups.begin_a[which][of] + place // n_b[of]], groups.b[groups.begin_b[which][of] + place % n_b[of]]


def counted(keys: list[np.ndarray], times: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the keys, in order, and the sum of their times."""
    if not len(times):
        return keys, times
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.add.reduceat(times[order], at)


def document_links(groups: Groups, bits_b: int, large: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, pair and times of the distinct links of each text. A large group is reduced to its distinct ids before they meet."""
    n = np.diff(groups.begin_a) * np.diff(groups.begin_b)
    which, a, b = outer(groups, np.flatnonzero(n <= large))
    of, pair, times = [groups.of[which]], [a << bits_b | b], [np.ones(len(a), np.int64)]
    for g in np.flatnonzero(n > large).tolist():
        one, n_one = np.unique(groups.a[groups.begin_a[g] : groups.begin_a[g + 1]], return_counts=True)
        two, n_two = np.unique(groups.b[groups.begin_b[g] : groups.begin_b[g + 1]], return_counts=True)
        of.append(np.full(len(one) * len(two), groups.of[g]))
        pair.append((one[:, None] << bits_b | two[None, :]).ravel())
        times.append((n_one[:, None] * n_two[None, :]).ravel())
    (of, pair), times = counted([np.concatenate(of), np.concatenate(pair)], np.concatenate(times))
    return of, pair, times


def written_groups(tokens: Encoders, groups: Groups, texts: int) -> list[bytes]:
    """Each text's groups as `a1,a2|b1;a3|b2,b3`."""
    n_groups = len(groups.of)
    of_a, of_b = (np.repeat(np.arange(n_groups), np.diff(x)) for x in (groups.begin_a, groups.begin_b))
    place_a, place_b = np.arange(len(of_a)) + groups.begin_b[of_a], np.arange(len(of_b)) + groups.begin_a[of_b + 1]
    which = np.zeros(len(of_a) + len(of_b), np.int64)
    last_a, last_b = np.zeros(len(of_a), np.int64), np.zeros(len(of_b), np.int64)
    last_a[groups.begin_a[1:] - 1], last_b[groups.begin_b[1:] - 1] = 1, 2
    which[place_a], which[place_b] = groups.a + last_a * tokens.named, groups.b + last_b * tokens.named
    size = np.concatenate([[0], np.cumsum(tokens.names.sizes[which])])
    first_group = np.searchsorted(groups.of, np.arange(texts + 1))
    ends = size[(groups.begin_a + groups.begin_b)[first_group]].tolist()
    raw = tokens.names.joined(which).tobytes()
    return [raw[s : e - 1] if e > s else b"" for s, e in zip(ends[:-1], ends[1:], strict=True)]


# One row a run (radix not null) or a chunk of documents.
SPILL = (
    "chunk long, radix int, pairs binary, holders binary, places binary, times binary, "
    "doc_ids array<long>, numbers array<array<long>>, hashes array<string>"
)
ARROW_SPILL = pa.schema([
    ("chunk", pa.int64()), ("radix", pa.int32()), ("pairs", pa.binary()), ("holders", pa.binary()), ("places", pa.binary()), ("times", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("numbers", pa.list_(pa.list_(pa.int64()))), ("hashes", pa.list_(pa.string())),
])


class Chunk:
    """Documents of a task that are spilled together."""

    def __init__(self, number: int, bits_b: int, settings: Settings):
        self.number, self.bits_b, self.settings = number, bits_b, settings
        self.doc_ids: list = []
        self.numbers: list[list[int]] = []
        self.hashes: list[str] = []
        self.links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def full(self) -> bool:
        return len(self.doc_ids) >= self.settings.chunk_docs or self.held >= self.settings.chunk_links

    def add(self, doc_ids: list, numbers: list[list[int]], hashes: list[str], of: np.ndarray, pair: np.ndarray, times: np.ndarray) -> None:
        self.links.append((of + len(self.doc_ids), pair, times))
        self.held += len(of)
        self.doc_ids += doc_ids
        self.numbers += numbers
        self.hashes += hashes

    def rows(self) -> Iterator[dict]:
        place, pair, times = (np.concatenate(x) for x in zip(*self.links, strict=True))
        radix = (pair >> self.bits_b) & ((1 << self.settings.radix) - 1)
        order = np.lexsort((place, pair, radix))
        place, pair, times, radix = place[order], pair[order], times[order], radix[order]
        ends = np.searchsorted(radix, np.arange((1 << self.settings.radix) + 1))
        for r in np.flatnonzero(np.diff(ends)).tolist():
            a, b = int(ends[r]), int(ends[r + 1])
            found, at = np.unique(pair[a:b].astype(np.uint64), return_index=True)
            yield {
                "chunk": self.number, "radix": r, "pairs": packed_sorted(found), "holders": packed(np.diff(np.append(at, b - a)), "<u4"),
                "places": packed(place[a:b], "<u4"), "times": packed(times[a:b], "<u4" if times[a:b].max() < 1 << 32 else "<u8"),
            }
        yield {"chunk": self.number, "doc_ids": self.doc_ids, "numbers": self.numbers, "hashes": self.hashes}


_encoders: dict[str, Encoders] = {}


def encoders_of(name: str, sent: Broadcast) -> Encoders:
    """A worker's tokenizers, kept for its next tasks. A function of the module, as what a task function holds comes anew."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoders(*sent.value)
    return _encoders[name]


def aligned_piece(tokens: Encoders, data: np.ndarray, starts: np.ndarray) -> tuple[list[list[int]], list[str], tuple]:
    """For each text n_a, n_b, n_groups, n_links, and the hash of its groups; and the links of all."""
    data, starts = spaced(data, starts)
    a, first_a, b, first_b = tokens.encode(data, starts)
    good = same_text(tokens.bytes_a, a, first_a, data, starts) & same_text(tokens.bytes_b, b, first_b, data, starts) & (np.diff(starts) > 0)
    n = len(starts) - 1
    place_a, place_b = chosen_spans(first_a, good), chosen_spans(first_b, good)
    of_a = np.repeat(np.arange(n), np.diff(first_a))[place_a]
    groups = grouped(tokens, a[place_a], b[place_b], of_a)
    n_a, n_b = np.where(good, np.diff(first_a), 0), np.where(good, np.diff(first_b), 0)
    n_groups = np.bincount(groups.of, minlength=n)
    ends = np.searchsorted(groups.of, np.arange(n + 1))
    links = np.concatenate([[0], np.cumsum(np.diff(groups.begin_a) * np.diff(groups.begin_b))])
    numbers = np.stack([n_a, n_b, n_groups, np.diff(links[ends])], axis=1).tolist()
    hashes = [hashlib.sha256(x).hexdigest() if x else "" for x in written_groups(tokens, groups, n)]
    return numbers, hashes, document_links(groups, tokens.bits_b)


def spilled(docs: DataFrame, byte_file: str, piece_file: str, settings: Settings) -> DataFrame:
    """The runs of all chunks, and the chunks' documents."""
    with open(byte_file, encoding="utf-8") as f, open(piece_file, "rb") as g:
        parts = f.read(), layout(byte_file), g.read()
    sent = docs.sparkSession.sparkContext.broadcast(parts)
    name = hashlib.sha256(parts[0].encode() + parts[2]).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, number = encoders_of(name, sent), TaskContext.get().partitionId() << 32
        chunk = Chunk(number, tokens.bits_b, settings)
        for batch, data, starts in pieces(batches):
            numbers, hashes, links = aligned_piece(tokens, data, starts)
            chunk.add(column(batch, "doc_id").to_pylist(), numbers, hashes, *links)
            if chunk.full():
                yield pa.RecordBatch.from_pylist(list(chunk.rows()), ARROW_SPILL)
                number += 1
                chunk = Chunk(number, tokens.bits_b, settings)
        if chunk.doc_ids:
            yield pa.RecordBatch.from_pylist(list(chunk.rows()), ARROW_SPILL)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SPILL)


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]], block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted runs of (pair, documents) as one, in sorted slices that share no pair; documents of equal pairs are added up.

    The heap holds for each run where its next block ends. Once the least of these is known, nothing up to it is still to come
    from any other run but what stands before their own ends.
    """
    at = [0] * len(runs)
    heap = [(int(keys[min(block, len(keys)) - 1]), i) for i, (keys, _) in enumerate(runs) if len(keys)]
    heapq.heapify(heap)
    while heap:
        end = heap[0][0]
        keys, counts = [], []
        for i, (own, n) in enumerate(runs):
            if at[i] < len(own) and own[at[i]] <= end:
                stop = at[i] + int(np.searchsorted(own[at[i] :], np.uint64(end), "right"))
                keys.append(own[at[i] : stop])
                counts.append(n[at[i] : stop])
                at[i] = stop
        while heap and heap[0][0] <= end:
            _, i = heapq.heappop(heap)
            own = runs[i][0]
            if at[i] < len(own):
                heapq.heappush(heap, (int(own[min(at[i] + block, len(own)) - 1]), i))
        (found,), total = counted([np.concatenate(keys)], np.concatenate(counts))
        yield found, total


def merged_counts(runs: DataFrame, settings: Settings) -> DataFrame:
    """radix, pairs, holders: for each radix part all pairs and the number of documents that hold each, in one row."""
    schema = "radix int, some long, pairs binary, holders binary"

    def run(rows: pa.Table) -> pa.Table:
        both = zip(rows.column("pairs").to_pylist(), rows.column("holders").to_pylist(), strict=True)
        kind = rows.column("kind")[0].as_py()
        found = list(merge_runs([(unpacked_sorted(p), unpacked(h, kind).astype(np.int64)) for p, h in both], settings.block))
        pairs, counts = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({
            "radix": pa.array([rows.column("radix")[0].as_py()], pa.int32()), "some": pa.array([rows.column("some")[0].as_py()], pa.int64()),
            "pairs": pa.array([packed_sorted(pairs)], pa.binary()), "holders": pa.array([packed(counts, "<i8")], pa.binary()),
        })

    left = max(1, runs.select("chunk").distinct().count())
    level = runs.select("radix", F.pmod(F.xxhash64("chunk"), F.lit(-(-left // settings.fan))).alias("some"), "pairs", "holders", F.lit("<u4").alias("kind"))
    while True:
        left = -(-left // settings.fan)
        level = written(level.groupBy("radix", "some").applyInArrow(run, schema), "merged-runs")
        if left == 1:
            return level.select("radix", "pairs", "holders")
        up = -(-left // settings.fan)
        level = level.withColumn("some", F.pmod("some", F.lit(up))).withColumn("kind", F.lit("<i8"))


def highest(pairs: np.ndarray, counts: np.ndarray, bits_b: int) -> np.ndarray:
    """Whether each pair's count is the highest of its first id; the pairs of an id stand side by side."""
    first = pairs >> np.uint64(bits_b)
    new = np.ones(len(first), bool)
    new[1:] = first[1:] != first[:-1]
    at = np.flatnonzero(new)
    top = np.maximum.reduceat(counts, at)
    return counts == np.repeat(top, np.diff(np.append(at, len(first))))


def contributions(runs: DataFrame, counts: DataFrame, bits_b: int, settings: Settings) -> DataFrame:
    """chunk, n_best, count_sum of every run: arrays with a number for each document of the chunk up to its last in the run."""
    salts = max(1, -(-runs.select("chunk").distinct().count() // settings.fan))
    salted = runs.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int"))
    spread = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select("radix", "salt", "pairs", "holders")

    def run(some: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        if some.num_rows:
            pairs, n = unpacked_sorted(known.column("pairs")[0].as_py()), unpacked(known.column("holders")[0].as_py(), "<i8")
            best = highest(pairs, n, bits_b)
        for row in some.select(["chunk", "pairs", "holders", "places", "times"]).to_batches(1):
            one = {c: row.column(c)[0].as_py() for c in row.schema.names}
            at = np.searchsorted(pairs, unpacked_sorted(one["pairs"]))
            at = np.repeat(at, unpacked(one["holders"], "<u4"))
            places = unpacked(one["places"], "<u4").astype(np.int64)
            raw = zstandard.ZstdDecompressor().decompress(one["times"])
            times = np.frombuffer(raw, "<u4" if len(raw) == 4 * len(places) else "<u8").astype(np.int64)
            sums = np.zeros((2, int(places.max()) + 1), np.int64)
            np.add.at(sums[0], places, times * best[at])
            np.add.at(sums[1], places, times * n[at])
            out.append((one["chunk"], packed(sums[0], "<i8"), packed(sums[1], "<i8")))
        chunk, one, two = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"chunk": pa.array(chunk, pa.int64()), "n_best": pa.array(one, pa.binary()), "count_sum": pa.array(two, pa.binary())})

    both = salted.groupBy("radix", "salt").cogroup(spread.groupBy("radix", "salt"))
    return both.applyInArrow(run, "chunk long, n_best binary, count_sum binary")


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def summed(chunks: DataFrame, back: DataFrame) -> DataFrame:
    """The documents of every chunk with what all its runs gave back."""

    def run(docs: pa.Table, given: pa.Table) -> pa.Table:
        numbers = np.array(docs.column("numbers")[0].as_py(), np.int64).reshape(-1, 4)
        sums = np.zeros((2, len(numbers)), np.int64)
        for k, name in enumerate(("n_best", "count_sum")):
            for raw in given.column(name).to_pylist():
                part = unpacked(raw, "<i8")
                sums[k][: len(part)] += part
        names = [f.split()[0] for f in RESULT.split(", ")]
        values = [docs.column("doc_ids")[0].values, *map(pa.array, numbers.T), *map(pa.array, sums), docs.column("hashes")[0].values]
        return pa.table(dict(zip(names, values, strict=True)))

    return chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(run, RESULT)


def aligned(docs: DataFrame, byte_file: str, piece_file: str, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `byte_file` is a byte-level BPE file (side A, of a space and the text), `piece_file` a piece model that adds the space
    itself (side B); both are read on the driver and sent once. `docs` has doc_id (integer) and text; other columns are ignored.
    A text that is null or empty, or that either side's tokens do not give back byte by byte, has no tokens: zeros and
    an empty hash. n_best counts links whose pair is held by as many documents as any pair of its A id. Every row is a document
    of its own, with a null or repeated doc_id, too. A text of any length is encoded whole. An empty table gives an empty result.
    """
    import sentencepiece

    size = sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size()
    bits_b = max(1, (size - 1).bit_length())
    spill = written(spilled(docs, byte_file, piece_file, settings), "spilled-runs")
    runs = spill.filter("radix is not null")
    counts = merged_counts(runs.select("chunk", "radix", "pairs", "holders"), settings)
    back = contributions(runs.select("chunk", "radix", "pairs", "holders", "places", "times"), counts, bits_b, settings)
    return summed(spill.filter("radix is null").select("chunk", "doc_ids", "numbers", "hashes"), back)
