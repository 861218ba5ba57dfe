import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from txwarden.llm.arrow import text_bytes
from txwarden.llm.automaton import Codec, Encoder, compiled, encoded, read_vocabulary
from txwarden.llm.catalog import vocabulary
from txwarden.llm.chunks import ChunkCoder
from txwarden.llm.presplit import Cutter, byte_letters, layout

ODD = [
    "", " ", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "    x", "\n\n a\tb  ", "it's 'S 've we'll''s", "日本語😀 x²½", "a" * 500,
    "\x1c!\x1c a\x85b", "é ٣٤٥", "ab" * 3000, "   foo　", "<|endoftext", "don't  stop\r\n\r\n", "word " * 20_000,
]


@pytest.fixture(scope="module")
def codec():
    return Codec(*read_vocabulary(vocabulary()))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def test_byte_letters():
    letters = byte_letters()
    assert len(letters) == 256 and sorted(letters.values()) == list(range(256)) and letters["Ġ"] == 32


def test_same_ids_as_the_library(codec, library):
    draw = random.Random(5)
    texts = ODD + ["".join(draw.choice("abcdefgthein  \n'éßñ日01#$_-ABCstd") for _ in range(draw.randint(1, 40))) for _ in range(2000)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        got = codec.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == ids
        assert codec.decode(got) == library.decode(ids, skip_special_tokens=False) == text


def merge_by_hand(word, ranks):
    """Apply the first merge of the list that fits, leftmost first, until none fits."""
    parts = list(word)
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]
        if not pairs:
            return parts
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_random_vocabularies_against_merging_by_hand():
    for seed in range(30):
        draw = random.Random(seed)
        names, merges, ids = ["a", "b", "c"], [], {}
        while len(merges) < 25:
            pair = draw.choice(names), draw.choice(names)
            if "".join(pair) not in names and len("".join(pair)) < 9:
                # As in learned lists: a pair is merged only where earlier merges leave it side by side.
                if merge_by_hand("".join(pair), {p: i for i, p in enumerate(merges)}) == list(pair):
                    merges.append(pair)
                    names.append("".join(pair))
        ids = {x: i for i, x in enumerate(names)}
        machine = compiled({ids[x]: x.encode() for x in "abc"}, [(ids[a], ids[b], ids[a + b]) for a, b in merges], len(names))
        walk, ranks = Encoder(machine), {p: i for i, p in enumerate(merges)}
        for _ in range(300):
            word = "".join(draw.choice("abc") for _ in range(draw.randint(1, 14)))
            assert [names[t] for t in walk.encode(word.encode())] == merge_by_hand(word, ranks)


def test_arcs_of_the_tables(codec):
    """The arcs are the pairs of tokens that merging leaves side by side."""
    machine, draw = codec.encoder.automaton, np.random.default_rng(3)
    letter = {b: t for t, raw in enumerate(machine.label) if len(raw) == 1 and machine.target[t] >= 0 for b in raw}
    with open(vocabulary(), encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ranks = {(model["vocab"][a], model["vocab"][b]): (i, model["vocab"][a + b]) for i, (a, b) in enumerate(pairs)}

    def by_hand(raw):
        parts = [letter[b] for b in raw]
        while fits := [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]:
            (_, made), i = min(fits)
            parts[i : i + 2] = [made]
        return parts

    left, right = (draw.choice(np.flatnonzero(machine.target >= 0), 3000) for _ in range(2))
    left[:1000] = draw.choice([letter[b] for b in b"abcdefghijklmnopqrstuvwxyz "], 1000)  # states that lack the most
    has = machine.has_arcs(machine.target[left], right)
    want = [by_hand(machine.label[a] + machine.label[b]) == [a, b] for a, b in zip(left.tolist(), right.tolist(), strict=True)]
    assert has.tolist() == want and 0.2 < has.mean() < 0.999
    assert (np.diff(machine.borders) > 0).all() and len(machine.borders) % 2 == 0
    assert machine.has_arcs(np.zeros_like(right), right).all()


@pytest.mark.parametrize("places", [1, 7, 1 << 16])
def test_words_in_groups_and_blocks(codec, library, places, monkeypatch):
    """Words of very different lengths, cut into blocks of places and groups of words anywhere."""
    monkeypatch.setattr("txwarden.llm.automaton.GROUP_BYTES", 100 * places)
    draw = random.Random(places)
    words = ["".join(draw.choice("abcdeinorstß日") for _ in range(draw.choice([0, 1, 2, 5, 20, 400]))) for _ in range(60)]
    ids, counts = Encoder(codec.encoder.automaton, places).encode_words([w.encode() for w in words])
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [t for x in want for t in x]
    assert [len(x) for x in Encoder(codec.encoder.automaton).encode_words([])] == [0, 0]


def test_a_byte_that_the_alphabet_lacks():
    machine = compiled({0: b"a", 1: b"b"}, [(0, 1, 2)], 3)
    assert Encoder(machine).encode(b"aab") == [0, 2]
    with pytest.raises(ValueError, match="alphabet"):
        Encoder(machine).encode(b"aac")


def test_made_twice_is_refused():
    with pytest.raises(ValueError, match="twice"):
        compiled({0: b"a", 1: b"b"}, [(0, 0, 2), (0, 1, 3), (2, 1, 4), (0, 3, 4)], 5)


def test_query_rows(spark, library):
    rows = [(i, t, "x") for i, t in enumerate([*ODD, None, ODD[2]])] + [(0, "", None), (None, "null id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoded(docs, vocabulary()).collect())
    want = []
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        want.append((i if i is not None else -1, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert encoded(docs.limit(0), vocabulary()).collect() == []
    full = encoded(docs.filter("doc_id = 2"), vocabulary(), ids=True).first()
    assert full.decoded == ODD[2] and 50256 in full.ids


@pytest.mark.parametrize("bits", [4, 8, 16])
def test_chunk_table_changes_no_value(bits):
    cutter = Cutter(layout(vocabulary()))
    made = []
    coder = ChunkCoder(cutter, lambda cs: made.extend(cs) or [list(c.encode()) for c in cs], bits)
    draw = random.Random(bits)
    for _ in range(30):
        texts = [" ".join(f"w{int(draw.expovariate(0.03))}" + draw.choice(["", "", ".\n\n", "\u2003 x", "<|endoftext|>", "\u201c"]) for _ in range(draw.randint(0, 20))) for _ in range(5)]
        texts += [None, "", "  ", "x"]
        ids, starts = coder.encode(*text_bytes(pa.array(texts, pa.string())))
        assert [bytes(ids[a:b].tolist()).decode() for a, b in zip(starts[:-1], starts[1:], strict=True)] == [t or "" for t in texts]
    if bits == 16:
        assert len([c for c in made if c.isascii()]) < 2000
