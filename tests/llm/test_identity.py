"""Texts that a polynomial hash modulo 2^64 cannot tell apart, and hashes that are made to collide."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from txwarden.llm import chunks
from txwarden.llm.arrow import text_bytes
from txwarden.llm.automaton import encoded
from txwarden.llm.bitpack import Settings, Tokens, token_files
from txwarden.llm.minhash import near_duplicates
from txwarden.llm.presplit import layout
from txwarden.llm.shingles import words

FILE = public_tokenizers.path("byte_bpe_50k.json")


def twins():
    """A word over two letters and its complement, 1,024 letters long."""
    signs = [0]
    for _ in range(10):
        signs += [1 - x for x in signs]
    return "".join("ab"[x] for x in signs), "".join("ba"[x] for x in signs)


TEXTS = [*twins(), "x " + " ".join(twins()), "", None, "a" * 5000, "b" * 5000, "short words and Short words", *["wörter " * 7] * 2]


@pytest.fixture(scope="module")
def wanted():
    library = Tokenizer.from_file(FILE)
    return [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in TEXTS]


def test_words_of_the_twins_differ():
    found, firsts = words(*text_bytes(pa.array([*twins(), "ab AB", "ab"])))
    assert found[0] != found[1] and found[2] == found[3] == found[4] and firsts.tolist() == [0, 1, 2, 4, 5]
    long, _ = words(*text_bytes(pa.array(["y" * 3_000_000 + " z", "y" * 3_000_001 + " z"])))
    assert len(long) == 4 and long[0] != long[2] and long[1] == long[3]


@pytest.mark.parametrize("bits", [6, 12, 22])
def test_chunks_of_colliding_hashes_keep_their_ids(monkeypatch, wanted, bits):
    monkeypatch.setattr(chunks, "run_hashes", lambda data, at, lengths, seed: np.full(len(at), 7, np.uint64))
    tokens = Tokens(open(FILE, encoding="utf-8").read(), layout(FILE), Settings(bits=bits))
    for _ in range(2):
        got = tokens.encode(*text_bytes(pa.array(TEXTS)))
        assert [x[:-4] for x in got] == wanted


@pytest.mark.parametrize("parts", [1, 4])
def test_twins_in_the_operators(spark, wanted, parts):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(parts)
    for r in encoded(docs, FILE).collect():
        text = (TEXTS[r.doc_id] or "").encode()
        assert (r.ids_sha256, r.decoded_sha256) == (hashlib.sha256(wanted[r.doc_id]).hexdigest(), hashlib.sha256(text).hexdigest())
    for r in token_files(docs, FILE).collect():
        assert r.n_tokens == len(wanted[r.doc_id]) // 4 + 1
    of = {r.doc_id: (r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert of[0] == (0, True) and of[1] == (1, True) and of[9] == (8, False)
