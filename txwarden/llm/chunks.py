"""Ids of texts by way of their chunks: each chunk that a task meets again is looked up, not encoded again.

Chunks are found and hashed over the bytes of many texts at once, and looked up in an open-addressing table of numpy arrays,
which holds a chunk in a tenth of the room that a dict needs. A chunk of up to 15 bytes is its own key; a longer one is found
by 128 bits of hash, and its bytes are compared with those in the table, so no hash decides about ids.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa

from txwarden.llm.arrow import text_bytes
from txwarden.llm.presplit import Cutter
from txwarden.llm.shingles import SEEDS, SPACE, lanes_at, mix, run_hashes

# Chunks of up to so many bytes lie in the two halves of their key, the last byte of which is the length.
SHORT = 15
LONG = np.uint64(0xFF) << np.uint64(56)


def chunk_keys(data: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit values for each chunk: its bytes and its length if it is short, else two hashes under a mark."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    one = lanes_at(padded, at, lengths, 0)
    two = np.where(lengths > 8, lanes_at(padded, at, np.maximum(lengths, 8), 1), np.uint64(0))
    two = (two & ~LONG) | (lengths.astype(np.uint64) << np.uint64(56))
    long = np.flatnonzero(lengths > SHORT)
    if len(long):
        one[long] = run_hashes(data, at[long], lengths[long], SEEDS[0])
        two[long] = run_hashes(data, at[long], lengths[long], SEEDS[1]) | LONG
    return one, two


def same_runs(data: np.ndarray, at: np.ndarray, held: np.ndarray, where: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the runs of `data` at `at` and those of `held` at `where`, of equal lengths, have the same bytes. Both arrays
    end with eight bytes more than the runs need."""
    same, rest, k = np.ones(len(at), bool), np.arange(len(at)), 0
    while len(rest):
        equal = lanes_at(data, at[rest], lengths[rest], k) == lanes_at(held, where[rest], lengths[rest], k)
        same[rest[~equal]] = False
        k += 1
        rest = rest[equal & (lengths[rest] > 8 * k)]
    return same


def chunk_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where chunks begin: at white space after something else, and at the start of a text."""
    space = SPACE[data]
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[starts[:-1][starts[:-1] < len(data)]] = True
    return np.flatnonzero(first)


def odd_places(data: np.ndarray) -> np.ndarray:
    """Where white space beyond ASCII begins: U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000."""
    if not len(data) or data.max() < 0xC2:
        return np.zeros(0, np.int64)
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    tail = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = data[lead], tail[lead + 1], tail[lead + 2]
    found = (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
    found |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    return lead[found]


class Table:
    """From the two halves of a key to a place in a flat array of ids; at most half of the slots are taken."""

    def __init__(self, bits: int):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        size = 1 << self.bits
        self.mask, self.room, self.count = np.uint64(size - 1), size // 2, 0
        self.one, self.two = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.entry = np.zeros(size, np.uint32)  # 0: free
        self.first, self.length = np.zeros(self.room + 1, np.uint32), np.zeros(self.room + 1, np.uint32)
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        # The bytes of long chunks end to end, and where those of an entry are.
        self.bytes, self.filled = np.zeros(1 << 20, np.uint8), 0
        self.place, self.size = np.zeros(self.room + 1, np.int64), np.zeros(self.room + 1, np.int64)

    def slots(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return mix(one ^ mix(two)) & self.mask

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The entry of each key, 0 if it is not there."""
        out = np.zeros(len(one), np.uint32)
        rest, slot = np.arange(len(one)), self.slots(one, two)
        while len(rest):
            entry = self.entry[slot]
            same = (self.one[slot] == one[rest]) & (self.two[slot] == two[rest]) & (entry > 0)
            out[rest[same]] = entry[same]
            on = ~same & (entry > 0)
            rest, slot = rest[on], (slot[on] + np.uint64(1)) & self.mask
        return out

    def hold(self, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Entries for ids that come end to end; no key leads to them yet."""
        total = len(values)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + total] = values
        entries = np.arange(self.count + 1, self.count + 1 + len(lengths), dtype=np.uint32)
        self.first[entries] = self.used + np.cumsum(lengths) - lengths
        self.length[entries] = lengths
        self.used, self.count = self.used + total, self.count + len(lengths)
        return entries

    def add(self, one: np.ndarray, two: np.ndarray, entries: np.ndarray) -> None:
        """Lead keys that are new and differ from each other to their entries."""
        rest, slot = np.arange(len(one)), self.slots(one, two)
        while len(rest):
            free = np.flatnonzero(self.entry[slot] == 0)
            taken, who = np.unique(slot[free], return_index=True)
            mine = rest[free[who]]
            self.entry[taken], self.one[taken], self.two[taken] = entries[mine], one[mine], two[mine]
            left = np.ones(len(rest), bool)
            left[free[who]] = False
            rest, slot = rest[left], (slot[left] + np.uint64(1)) & self.mask

    def keep(self, entry: int, raw: bytes) -> None:
        """Remember the bytes of a long chunk."""
        while self.filled + len(raw) + 8 > len(self.bytes):
            self.bytes = np.concatenate([self.bytes, np.zeros_like(self.bytes)])
        self.bytes[self.filled : self.filled + len(raw)] = np.frombuffer(raw, np.uint8)
        self.place[entry], self.size[entry] = self.filled, len(raw)
        self.filled += len(raw)

    def verified(self, padded: np.ndarray, at: np.ndarray, lengths: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Whether the bytes of long chunks are those of their entries."""
        out = self.size[entries] == lengths
        some = np.flatnonzero(out)
        out[some] = same_runs(padded, at[some], self.bytes, self.place[entries[some]], lengths[some])
        return out


class ChunkCoder:
    """`make` gives the ids of chunks, or of tokens that stand whole. `bits`: the table has 2^bits slots, 20 bytes each."""

    def __init__(self, cutter: Cutter, make: Callable[[list[str]], list[list[int]]], bits: int = 22):
        self.cutter, self.make, self.table = cutter, make, Table(bits)

    def encode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's ids begin (n + 1 values)."""
        texts = len(starts) - 1
        odd = np.zeros(texts, bool)
        odd[np.searchsorted(starts, odd_places(data), "right") - 1] = True
        raw = data.tobytes()
        for mark in self.cutter.whole:
            at = raw.find(mark.encode())
            while at >= 0:
                odd[np.searchsorted(starts, at, "right") - 1] = True
                at = raw.find(mark.encode(), at + 1)
        at = chunk_starts(data, starts) if len(data) else np.zeros(0, np.int64)
        ids, lengths = self._chunks(data, raw, at)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        first = ends[np.searchsorted(at, starts)]
        if not odd.any():
            return ids, first
        parts = []
        for k in range(texts):
            if odd[k]:
                whole = raw[starts[k] : starts[k + 1]].decode()
                parts.append(np.array([i for found in self.make(self.cutter.parts(whole)) for i in found], np.uint32))
            else:
                parts.append(ids[first[k] : first[k + 1]])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _chunks(self, data: np.ndarray, raw: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks end to end, and how many each has."""
        if not len(at):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        sizes = np.diff(np.append(at, len(data)))
        one, two = chunk_keys(data, at, sizes)
        entry = self.table.find(one, two)
        lost = np.flatnonzero(entry == 0)
        order = lost[np.lexsort((two[lost], one[lost]))]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
        new = order[fresh]
        if len(new) > self.table.room // 2:  # more than the table can hold well: a larger one
            self.table = Table(int(4 * len(new)).bit_length() + 1)
            return self._chunks(data, raw, at)
        if self.table.count + len(new) > self.table.room:  # full: start anew, with the chunks at hand
            self.table.clear()
            return self._chunks(data, raw, at)
        if len(new):
            added = self._made(raw, at[new], sizes[new])
            self.table.add(one[new], two[new], added)
            for k in np.flatnonzero(sizes[new] > SHORT).tolist():
                self.table.keep(int(added[k]), raw[at[new[k]] : at[new[k]] + sizes[new[k]]])
            entry[order] = added[np.cumsum(fresh) - 1]
        long = np.flatnonzero(sizes > SHORT)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        other = long[~self.table.verified(padded, at[long], sizes[long], entry[long])]
        if len(other):  # a hash that two chunks share: the second is encoded wherever it occurs
            if self.table.count + len(other) > self.table.room:
                self.table = Table(int(4 * (self.table.count + len(other))).bit_length() + 1)
                return self._chunks(data, raw, at)
            entry[other] = self._made(raw, at[other], sizes[other])
        lengths = self.table.length[entry].astype(np.int64)
        total = int(lengths.sum())
        shift = self.table.first[entry].astype(np.int64) - (np.cumsum(lengths) - lengths)
        return self.table.ids[np.repeat(shift, lengths) + np.arange(total)], lengths

    def _made(self, raw: bytes, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Entries for chunks that are encoded now."""
        values = self.make([raw[a : a + n].decode() for a, n in zip(at.tolist(), sizes.tolist(), strict=True)])
        lengths = np.fromiter(map(len, values), np.int64, len(values))
        return self.table.hold(np.fromiter(chain.from_iterable(values), np.uint32, int(lengths.sum())), lengths)

    def encode_text(self, text: str) -> np.ndarray:
        return self.encode(*text_bytes(pa.array([text], pa.large_string())))[0]
