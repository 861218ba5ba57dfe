"""Files of token ids in fixed width: every id takes the bits that the largest id of the vocabulary needs.

A file is a row of blocks and an index. A block holds whole documents, in order:

    magic "TXB1", width u8, 3 zero bytes, part u32, documents u32, ids u64        (24 bytes)
    has_id u8 for each document, padded to 8 bytes; doc_id i64 for each; end u64 for each (ids up to its end, in the block)
    the ids, `width` bits each, low bits first, padded to 8 bytes

    index: offset u64 of each block, first place u64 of each block's ids in the file, blocks u32, magic "TXBI"

All numbers are little-endian. Each block and the index are followed by one line feed, which the text writer adds; the
index ends a file, so a reader starts from the end, finds a block by its offset and unpacks only that block.

Spark's text writer writes the bytes as they are, so files can be on any file system that Spark writes to; the binary file
reader reads them back.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwarden.llm.arrow import column, pieces
from txwarden.llm.chunks import ChunkCoder
from txwarden.llm.presplit import Cutter, Layout, layout
from txwarden.llm.store import tasks, written
from txwarden.session import scratch_path

MAGIC, INDEX = b"TXB1", b"TXBI"
HEAD = struct.Struct("<4sB3xIIQ")


def bits_for(size: int) -> int:
    """Bits of the largest of `size` ids."""
    return max(1, (size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Unsigned 32-bit ids in `width` bits each, low bits first."""
    ids = np.ascontiguousarray(ids, "<u4")
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id does not fit into {width} bits")
    if width % 8 == 0:
        return ids.view(np.uint8).reshape(-1, 4)[:, : width // 8].tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack(data: np.ndarray, width: int, first: int, count: int) -> np.ndarray:
    """`count` ids from place `first` on; only their bytes are read."""
    if width % 8 == 0:
        size = width // 8
        out = np.zeros((count, 4), np.uint8)
        out[:, :size] = data[first * size : (first + count) * size].reshape(count, size)
        return out.view("<u4").reshape(-1)
    begin = first * width
    raw = np.unpackbits(data[begin // 8 : -(-(begin + count * width) // 8)], bitorder="little")
    bits = np.zeros((count, 32), np.uint8)
    bits[:, :width] = raw[begin % 8 : begin % 8 + count * width].reshape(count, width)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(-1)


def padded(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % 8)


def block(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, width: int, part: int) -> bytes:
    head = HEAD.pack(MAGIC, width, part, len(doc_ids), len(ids))
    known = bytes(x is not None for x in doc_ids)
    names = np.array([x or 0 for x in doc_ids], "<i8").tobytes()
    ends = np.cumsum(lengths, dtype="<u8").tobytes() if lengths else b""
    return head + padded(known) + names + ends + padded(pack(ids, width))


@dataclass(frozen=True)
class Block:
    """A block as it lies in the file: nothing is unpacked until ids are asked for."""

    part: int
    width: int
    doc_ids: list[int | None]
    ends: np.ndarray
    data: np.ndarray

    def ids(self, k: int) -> np.ndarray:
        """The ids of the k-th document."""
        first = int(self.ends[k - 1]) if k else 0
        return unpack(self.data, self.width, first, int(self.ends[k]) - first)


class TokenFile:
    """Random access to the bytes of one file."""

    def __init__(self, raw: bytes):
        self.raw = np.frombuffer(raw, np.uint8)
        if not raw.endswith(INDEX + b"\n"):
            raise ValueError("the file has no index at its end")
        (count,) = struct.unpack("<I", raw[-9:-5])
        table = np.frombuffer(raw[-9 - 16 * count : -9], "<u8")
        self.offsets, self.firsts = table[:count], table[count:]

    def __len__(self) -> int:
        return len(self.offsets)

    def block(self, k: int) -> Block:
        at = int(self.offsets[k])
        magic, width, part, documents, count = HEAD.unpack(self.raw[at : at + HEAD.size].tobytes())
        if magic != MAGIC:
            raise ValueError("no block begins here")
        at += HEAD.size
        known = self.raw[at : at + documents].astype(bool)
        at += documents + -documents % 8
        names = self.raw[at : at + 8 * documents].view("<i8")
        at += 8 * documents
        ends = self.raw[at : at + 8 * documents].view("<u8")
        at += 8 * documents
        data = self.raw[at : at + -(-count * width // 8)]
        return Block(part, width, [n if k else None for n, k in zip(names.tolist(), known.tolist(), strict=True)], ends, data)


@dataclass(frozen=True)
class Settings:
    """`end`: id after each document. `block_ids`: a block ends with the document that reaches so many ids. `bits`: a
    worker remembers up to half of 2^bits chunks."""

    end: int = 2
    block_ids: int = 1 << 18
    bits: int = 22


class Tokens:
    """Ids of texts by the tokenizers library. A chunk's ids do not depend on what stands beside it, so each is asked for once."""

    def __init__(self, spec: str, plan: Layout, settings: Settings):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_padding()
        self.library.no_truncation()
        self.cutter = Cutter(plan)
        self.coder = ChunkCoder(self.cutter, self.chunk_ids, settings.bits)
        self.end = np.array([settings.end], "<u4").tobytes()
        words = self.library.get_vocab(with_added_tokens=False)
        self.width = np.zeros(self.library.get_vocab_size(), np.int64)
        self.width[list(words.values())] = [len(x) for x in words]  # each letter of a byte-level word is a byte

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def chunk_ids(self, chunks: list[str]) -> list[list[int]]:
        """The ids of each chunk. Chunks from white space to a last other character are encoded as one text: the library
        cuts it where they meet, and the bytes that each token covers tell whose it is."""
        joint, alone = [], []
        for x in chunks:
            (joint if x[0].isspace() and not x[-1].isspace() and x not in self.cutter.whole else alone).append(x)
        out = dict(zip(alone, self.ids(alone), strict=True))
        for i in range(0, len(joint), 8192):
            some = joint[i : i + 8192]
            (found,) = self.ids(["".join(some)])
            ends = np.searchsorted(np.cumsum(self.width[found]), np.cumsum([len(x.encode()) for x in some])) + 1
            first = 0
            for chunk, end in zip(some, ends.tolist(), strict=True):
                out[chunk] = found[first:end]
                first = end
        return [out[x] for x in chunks]

    def encode(self, data: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """The ids of each text and the end id, as little-endian 32-bit integers."""
        found, ends = self.coder.encode(data, starts)
        found = found.astype("<u4")
        return [found[a:b].tobytes() + self.end for a, b in zip(ends[:-1], ends[1:], strict=True)]


_tokens: dict[str, Tokens] = {}


def tokens_of(name: str, sent: Broadcast, settings: Settings) -> Tokens:
    """A worker's encoder, kept with what it knows for the worker's next tasks. A function of the module: what a task
    function holds itself would come anew with every task."""
    if name not in _tokens:
        _tokens.clear()
        _tokens[name] = Tokens(*sent.value, settings)
    return _tokens[name]


def write_files(docs: DataFrame, file: str, path: str, settings: Settings = Settings()) -> None:
    """Encode the texts and write their ids under `path`, in ascending doc_id order over the files and in each.

    A null text is empty and still gets the end id. A null doc_id stands before all others; rows with equal ids are in the
    order of their texts' hashes. Columns other than doc_id and text are ignored.
    """
    with open(file, encoding="utf-8") as f:
        spec = f.read()
    from tokenizers import Tokenizer

    size = Tokenizer.from_str(spec).get_vocab_size()
    width, name = bits_for(max(size, settings.end + 1)), f"{file} {os.path.getmtime(file)} {settings}"
    sent = docs.sparkSession.sparkContext.broadcast((spec, layout(file)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, offset, place = TaskContext.get().partitionId(), 0, 0
        tokens = tokens_of(name, sent, settings)
        doc_ids, held, waiting = [], [], 0
        offsets, firsts = [], []

        def out() -> pa.RecordBatch:
            nonlocal doc_ids, held, waiting, offset, place
            ids = np.frombuffer(b"".join(held), "<u4")
            raw = block(doc_ids, [len(x) // 4 for x in held], ids, width, part)
            offsets.append(offset)
            firsts.append(place)
            offset, place = offset + len(raw) + 1, place + len(ids)
            doc_ids, held, waiting = [], [], 0
            return pa.record_batch({"raw": pa.array([raw], pa.binary())})

        for batch, data, starts in pieces(batches):
            coded = tokens.encode(data, starts)
            for doc_id, ids in zip(column(batch, "doc_id").to_pylist(), coded, strict=True):
                doc_ids.append(doc_id)
                held.append(ids)
                waiting += len(ids) // 4
                if waiting >= settings.block_ids:
                    yield out()
        if doc_ids:
            yield out()
        if offsets:
            index = np.array([*offsets, *firsts], "<u8").tobytes() + struct.pack("<I", len(offsets)) + INDEX
            yield pa.record_batch({"raw": pa.array([index], pa.binary())})

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    files = max(tasks(docs.sparkSession), 4 * rows.rdd.getNumPartitions())
    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    rows.mapInArrow(run, "raw binary").select(F.col("raw").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def read_files(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and with
    `ids` the ids. The number of ids in each file, one number a file, is summed up in the order of the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in column(batch, "content"):
                if not raw.as_buffer().size:
                    continue
                found = TokenFile(raw.as_py())
                for k in range(len(found)):
                    part = found.block(k)
                    coded = [part.ids(i) for i in range(len(part.doc_ids))]
                    lengths = np.array([len(x) for x in coded], np.int64)
                    rows = {
                        "part": pa.array([part.part] * len(coded), pa.int64()), "doc_id": pa.array(part.doc_ids, pa.int64()),
                        "inside": pa.array(int(found.firsts[k]) + np.cumsum(lengths) - lengths), "n_tokens": pa.array(lengths),
                        "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in coded], pa.int64()),
                    }
                    if ids:
                        rows["ids"] = pa.array([x.astype(np.int32) for x in coded], pa.list_(pa.int32()))
                    yield pa.record_batch(rows)

    schema = "part long, doc_id long, inside long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    rows = written(files.mapInArrow(run, schema), "token-rows")
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = sizes.selectExpr("part", "sum(size) over (order by part) - size as before")
    more = ["ids"] if ids else []
    return rows.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *more)


def token_files(docs: DataFrame, file: str, settings: Settings = Settings()) -> DataFrame:
    """Write the files to the shared folder and return what they hold. An empty table has no files and no rows."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_files(docs, file, path, settings)
    return read_files(docs.sparkSession, path)
