"""Byte-pair encoding by a deterministic automaton over tokens, and decoding by its arc labels.

Method. The automaton accepts exactly the token sequences that byte-pair encoding produces. It starts as one state with a
loop for each byte, which accepts every sequence of bytes. Each merge (u, v) -> w is built in by a gadget, in the order of
the merges: wherever a u arc leads to a state with a v arc, that state is copied without its v arc, u arcs now lead to the
copy, and a w arc leads from where u began to where v ended. All u arcs lead to one state, so a merge adds one state at
most, and an arc's target depends on its token alone.

When all merges are in, the arcs are laid out as tables. A gadget takes from its state the arc of v and those of the tokens
that come to begin with v later. Tokens are ranked as a tree, each below the token it begins with, those made last first; then
what a gadget takes is one interval of ranks, and a state lacks the union of a few intervals. Their borders, of all states in
one sorted array, are the transition table: a state has the arc of a token if an even number of borders stands before it.

Words are encoded many at a time. A second table, the tree of the labels' bytes, gives the tokens that stand at each place.
Then the places are gone through from the left: each has one state, as exactly one accepted sequence ends there, and its arcs
set the states of the places where the tokens end. Nothing is tried twice or taken back. The sequence that ends at a word's
last place is its encoding.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from txwarden.llm.arrow import column, pieces
from txwarden.llm.chunks import ChunkCoder
from txwarden.llm.presplit import Cutter, Layout, byte_letters, layout


# Bytes of words that are encoded at a time, and places of one word whose tokens are listed at a time.
GROUP_BYTES = 1 << 18
PLACES = 1 << 16


@dataclass(frozen=True)
class Automaton:
    """Tables of the automaton; state 0 is the start and has all arcs. By token: `target` (the state its arcs lead to, -1: it
    has none), `rank`, `label` (its bytes). `borders`: state * tokens + rank where a run of missing arcs begins or ends, sorted.
    The tree of the labels: node 0 is the root, `edges[k]` is parent * 256 + byte of node k + 1, sorted; `ending[node]` is the
    token whose label ends there, or -1."""

    target: np.ndarray
    rank: np.ndarray
    label: tuple[bytes, ...]
    borders: np.ndarray
    edges: np.ndarray
    ending: np.ndarray

    def has_arcs(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.borders, states * len(self.target) + self.rank[tokens], "right") % 2 == 0

    def children(self, nodes: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The nodes that bytes lead to, 0 where none does."""
        asked = nodes * 256 + data
        found = np.minimum(np.searchsorted(self.edges, asked), len(self.edges) - 1)
        return np.where(self.edges[found] == asked, found + 1, 0)


def has_arc(state: int, token: int, begin: list, made: list, parent: list, taken: list, step: list) -> bool:
    """Whether a state of an automaton that is being built has an arc: a token made at or after the state's step has one if the
    token it begins with has one; an earlier token if it is not the one taken away and the state it was copied from has it."""
    while state:
        while made[token] >= step[state]:
            token = begin[token]
        if token == taken[state]:
            return False
        state = parent[state]
    return True


def compiled(alphabet: dict[int, bytes], merges: list[tuple[int, int, int]], size: int) -> Automaton:
    """The automaton of an alphabet (token: its bytes) and merges (left, right, made) in order, for token ids below `size`."""
    target, begin, made, label = [-1] * size, [-1] * size, [0] * size, [b""] * size
    for token, raw in alphabet.items():
        target[token], label[token] = 0, raw
    parent, taken, step = [0], [-1], [0]
    for number, (left, right, new) in enumerate(merges, 1):
        if target[new] >= 0:
            raise ValueError(f"token {new} is made twice")
        if target[left] < 0 or target[right] < 0:
            continue
        state = target[left]
        if not has_arc(state, right, begin, made, parent, taken, step):
            continue  # no sequence has the two side by side when their turn comes
        end = target[right]
        parent.append(state)
        taken.append(right)
        step.append(number)
        target[left] = len(parent) - 1
        target[new], begin[new], made[new], label[new] = end, left, number, label[left] + label[right]
    rank, borders = laid_out(target, begin, made, parent, taken, step)
    edges, ending = label_tree(label, target)
    return Automaton(np.array(target, np.int64), rank, tuple(label), borders, edges, ending)


def laid_out(target: list, begin: list, made: list, parent: list, taken: list, step: list) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each token, and the borders of the runs of ranks whose arcs the states lack."""
    size = len(target)
    below: list[list[int]] = [[] for _ in range(size)]
    tops = []
    for token in sorted((t for t in range(size) if target[t] >= 0), key=lambda t: -made[t]):
        (below[begin[token]] if begin[token] >= 0 else tops).append(token)
    rank, end, count = [0] * size, [0] * size, 0
    path = [(t, False) for t in tops]
    while path:
        token, left = path.pop()
        if left:
            end[token] = count
            continue
        rank[token], count = count, count + 1
        path.append((token, True))
        path.extend((t, False) for t in reversed(below[token]))
    # A gadget takes a token and what was made of it since: the tree below it, up to the first branch that is older.
    upto = [0] * len(parent)
    for state in range(1, len(parent)):
        upto[state] = next((rank[t] for t in below[taken[state]] if made[t] < step[state]), end[taken[state]])
    borders = []
    for state in sorted({t for t in target if t > 0}):
        runs, at = [], state
        while at:
            runs.append((rank[taken[at]], upto[at]))
            at = parent[at]
        runs.sort()
        low, high = runs[0]
        for a, b in runs[1:]:
            if a > high:
                borders += [state * size + low, state * size + high]
                low = a
            high = max(high, b)
        borders += [state * size + low, state * size + high]
    return np.array(rank, np.int64), np.array(borders, np.int64)


def label_tree(label: list[bytes], target: list) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the tree of all labels that have arcs, and the token that ends at each node."""
    tokens = {raw: token for token, raw in enumerate(label) if target[token] >= 0}
    # By length, then bytes: so the children of a node that comes first come first too.
    nodes = sorted({raw[:k] for raw in tokens for k in range(1, len(raw) + 1)}, key=lambda raw: (len(raw), raw))
    number = {b"": 0} | {raw: k for k, raw in enumerate(nodes, 1)}
    return np.array([number[raw[:-1]] * 256 + raw[-1] for raw in nodes], np.int64), np.array([-1, *(tokens.get(raw, -1) for raw in nodes)], np.int64)


def read_vocabulary(file: str) -> tuple[Automaton, Layout]:
    """The automaton of a byte-level tokenizer file, and how it cuts texts."""
    plan = layout(file)
    with open(file, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, letters = model["vocab"], byte_letters()
    alphabet = {vocab[letter]: bytes([b]) for letter, b in letters.items()}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    size = max([*vocab.values(), *plan.whole.values()]) + 1
    return compiled(alphabet, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], size), plan


class Encoder:
    """Walks the automaton, over many words at a time."""

    def __init__(self, automaton: Automaton, places: int = PLACES):
        self.automaton, self.places = automaton, places
        self.width = np.array([len(raw) for raw in automaton.label], np.int64)

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one pre-split word."""
        return self.encode_words([word])[0].tolist()

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of pre-split words end to end, and how many each has. Memory is bounded by the longest word."""
        ids, counts, first, total = [], [], 0, 0
        for k, word in enumerate(words):
            total += len(word)
            if total >= GROUP_BYTES or k == len(words) - 1:
                found, each = self._group(words[first : k + 1])
                ids.append(found)
                counts.append(each)
                first, total = k + 1, 0
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *ids]), np.concatenate([none, *counts])

    def _group(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        target, width = self.automaton.target, self.width
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        # One place before each byte and one behind each word.
        starts = np.cumsum(sizes + 1) - sizes - 1
        data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        state, last = np.zeros(len(data), np.int64), np.full(len(data), -1, np.int64)
        for first in range(0, int(sizes.max(initial=0)), self.places):
            at, token, cuts = self._standing(data, starts, sizes, first)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                t = token[a:b]
                some = self.automaton.has_arcs(state[at[a:b]], t)
                t = t[some]
                end = at[a:b][some] + width[t]
                state[end], last[end] = target[t], t
        # Back from the last places, a token of each word at a time.
        who, place, turns = np.flatnonzero(sizes), (starts + sizes)[sizes > 0], []
        while len(who):
            token = last[place]
            if token.min() < 0:
                raise ValueError("a word has a byte that the alphabet lacks")
            turns.append((who, token))
            place = place - width[token]
            on = place > starts[who]
            who, place = who[on], place[on]
        if not turns:
            return np.zeros(0, np.int64), sizes
        owner, found = (np.concatenate([x[k] for x in reversed(turns)]) for k in (0, 1))
        return found[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def _standing(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places and tokens that stand at them, of the places `first` and following of every word: sorted by their distance
        from the word's start, and where each distance begins."""
        here = np.clip(sizes - first, 0, self.places)
        total = int(here.sum())
        inside = np.arange(total) - np.repeat(np.cumsum(here) - here, here) + first
        at = np.repeat(starts, here) + inside
        left = np.repeat(sizes, here) - inside
        node, which, depth, found = np.zeros(total, np.int64), np.arange(total), 0, []
        while len(which):
            node = self.automaton.children(node, data[at[which] + depth])
            depth += 1
            token = self.automaton.ending[node]
            fits = np.flatnonzero(token >= 0)
            found.append((which[fits], token[fits]))
            on = (node > 0) & (left[which] > depth)
            node, which = node[on], which[on]
        which, token = (np.concatenate([x[k] for x in found]) for k in (0, 1))
        distance = inside[which] - first
        order = np.argsort(distance, kind="stable")
        cuts = np.concatenate([[0], np.cumsum(np.bincount(distance, minlength=1))])
        return at[which[order]], token[order], cuts


class Codec:
    """Texts to ids and back."""

    def __init__(self, automaton: Automaton, plan: Layout):
        self.cutter, self.encoder = Cutter(plan), Encoder(automaton)
        self.labels = list(automaton.label)
        for text, token in plan.whole.items():
            self.labels[token] = text.encode()
        self.coder = ChunkCoder(self.cutter, self.chunk_ids)

    def chunk_ids(self, chunks: list[str]) -> list[list[int]]:
        """The ids of chunks, or of tokens that stand whole."""
        whole, cut = self.cutter.whole, self.cutter.words
        parts = [[] if c in whole else [word.encode() for word in cut(c)] for c in chunks]
        ids, counts = self.encoder.encode_words([word for words in parts for word in words])
        ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum([len(words) for words in parts], dtype=np.int64)])]
        ids = ids.tolist()
        return [[whole[c]] if c in whole else ids[a:b] for c, a, b in zip(chunks, ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def encode(self, text: str) -> bytes:
        """The ids of one text, as little-endian 32-bit integers."""
        return self.coder.encode_text(text).astype("<u4").tobytes()

    def decode(self, ids: bytes) -> str:
        """The labels of the ids end to end; bytes that are no text become replacement characters."""
        raw = b"".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec_of(name: str, sent: Broadcast) -> Codec:
    """A worker's codec, kept with what it knows for the worker's next tasks. A function of the module: what a task
    function holds itself would come anew with every task."""
    if name not in _codecs:
        _codecs.clear()
        _codecs[name] = Codec(*sent.value)
    return _codecs[name]


def encoded(docs: DataFrame, file: str, ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and with `ids` the ids and the decoded text.

    `file` is a byte-level BPE file, read on the driver; its automaton is sent to the executors once. A null text is empty,
    an empty one has no tokens. Texts of any length are encoded whole; repeated rows give a row each; an empty table gives an
    empty result; columns other than doc_id and text are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(file))
    kind, name = docs.schema["doc_id"].dataType.simpleString(), f"{file} {os.path.getmtime(file)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(name, sent)
        for batch, data, starts in pieces(batches):
            found, ends = codec.coder.encode(data, starts)
            found = found.astype("<u4")
            coded = [found[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            back = [codec.decode(x) for x in coded]
            rows = {
                "doc_id": column(batch, "doc_id"), "n_tokens": pa.array([len(x) // 4 for x in coded], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string()),
            }
            if ids:
                rows |= {"ids": pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in coded], pa.list_(pa.int32())), "decoded": pa.array(back, pa.string())}
            yield pa.record_batch(rows)

    more = ", ids array<int>, decoded string" if ids else ""
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
