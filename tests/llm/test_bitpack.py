import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from txwarden.llm.bitpack import Settings, TokenFile, bits_for, block, pack, read_files, token_files, unpack, write_files
from txwarden.llm.catalog import vocabulary


def test_bits():
    assert [bits_for(n) for n in (1, 2, 3, 4, 5, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 2, 3, 8, 9, 16, 16, 17]


@pytest.mark.parametrize("width", [*range(1, 33)])
def test_round_trip_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1001, dtype=np.uint64).astype("<u4")
    data = np.frombuffer(pack(ids, width), np.uint8)
    assert len(data) == -(-1001 * width // 8)
    for first, count in ((0, 1001), (0, 0), (1, 1), (17, 300), (1000, 1), (333, 668)):
        assert (unpack(data, width, first, count) == ids[first : first + count]).all()
    assert len(unpack(np.zeros(0, np.uint8), width, 0, 0)) == 0


def test_too_large_is_refused():
    with pytest.raises(ValueError, match="fit"):
        pack(np.array([8]), 3)


def test_damaged_files_are_refused():
    with pytest.raises(ValueError, match="index"):
        TokenFile(block([1], [1], np.array([1], "<u4"), 16, 0))


TEXTS = ["", None, "one two", "\n\n x\r\n", "<|endoftext|> a", "Ünïcode 日本 😀", "word " * 30_000, "same", "same"]


def test_files_hold_what_the_library_gives(spark, tmp_path):
    library = Tokenizer.from_file(vocabulary())
    rows = [((i * 37) % 101, TEXTS[i % len(TEXTS)], 1) for i in range(90)] + [(None, "no id", 1), (5, "again", 1), (-3, "below", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    path = str(tmp_path / "out")
    write_files(docs, vocabulary(), path, Settings(block_ids=500))
    got = sorted(read_files(spark, path, ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    start, by_id = 0, {}
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_id.setdefault(r.doc_id, []).append(r.ids)
        start += r.n_tokens
    for doc_id, _, _ in rows:
        want = [library.encode(t or "", add_special_tokens=False).ids + [2] for d, t, _ in rows if d == doc_id]
        assert sorted(by_id[doc_id]) == sorted(want)


def test_given_documents(spark, folder):
    library = Tokenizer.from_file(vocabulary())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    start = 0
    got = {r.doc_id: r for r in token_files(docs, vocabulary()).collect()}
    assert len(got) == len(texts)
    for doc_id in sorted(texts):
        ids = library.encode(texts[doc_id] or "", add_special_tokens=False).ids + [2]
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_empty_table(spark):
    assert token_files(spark.createDataFrame([], "doc_id long, text string"), vocabulary()).collect() == []
