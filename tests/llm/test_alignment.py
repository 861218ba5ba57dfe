import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from txwarden.llm.alignment import Settings, aligned, counted, merge_runs, packed_sorted, unpacked_sorted

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def letters():
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def expected(texts):
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    of = letters()
    docs = []
    for text in texts:
        if not text:
            docs.append(None)
            continue
        a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
        raw_a = [bytes(of[x] for x in one.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in a]
        raw_b = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            docs.append(None)
            continue
        groups, i, j, x, y, begin = [], 0, 0, 0, 0, (0, 0)
        while i < len(a) or j < len(b):
            if x <= y:
                x, i = x + len(raw_a[i]), i + 1
            else:
                y, j = y + len(raw_b[j]), j + 1
            if x == y:
                groups.append((a[begin[0] : i], b[begin[1] : j]))
                begin = (i, j)
        docs.append((a, b, groups, Counter((p, q) for g in groups for p in g[0] for q in g[1])))
    holders = Counter(pair for d in docs if d for pair in d[3])
    best = {}
    for (p, _), n in holders.items():
        best[p] = max(best.get(p, 0), n)
    out = []
    for i, d in enumerate(docs):
        if d is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = d
        said = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((i, len(a), len(b), len(groups), sum(links.values()), sum(n for (p, q), n in links.items() if holders[p, q] == best[p]),
                    sum(n * holders[x] for x, n in links.items()), hashlib.sha256(said.encode()).hexdigest()))
    return out


def compare(spark, texts, settings=Settings(), parts=3):
    rows = [(i, t, 1, "r") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk int, radix string").repartition(parts)
    got = sorted(tuple(r) for r in aligned(docs, A, B, settings).collect())
    assert got == expected(texts)


def test_given_documents(spark, folder):
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").select("text").collect()]
    compare(spark, texts)


ODD = [None, "", " ", "\n", "  two  spaces ", "end <|endoftext|> of", "<s>x</s> <unk> <0x41>", "a▁b", "▁", "ﬁne é ü ́", "日本語テキスト", "🙂🙃 🙂",
       " 　x", "x" * 3000, "é" * 4000 + " end", "\x00\x01", "of of of the", "".join(chr(0x4E00 + i) for i in range(900)), "a " * 20000, "क्ष" * 300]


@pytest.mark.parametrize("settings", [Settings(), Settings(radix=1, chunk_docs=1, fan=2, block=2), Settings(radix=6, chunk_links=50, fan=3, block=7)])
def test_odd_texts(spark, settings):
    compare(spark, ODD + ODD[4:9], settings, parts=4)


def test_rows_of_all_kinds(spark):
    assert aligned(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
    only = aligned(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B).collect()
    assert sorted(tuple(r) for r in only) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    same = aligned(spark.createDataFrame([(None, "one two"), (5, "one two"), (5, "one two")], "doc_id int, text string"), A, B).collect()
    assert sorted((r.doc_id or 0, r.count_sum) for r in same) == [(0, 3 * same[0].n_links), (5, 3 * same[0].n_links), (5, 3 * same[0].n_links)]


def test_merging_by_the_heap():
    draw = random.Random(4)
    for block in (1, 2, 5, 100):
        runs, total = [], Counter()
        for _ in range(9):
            keys = sorted(draw.sample(range(60), draw.randrange(40)))
            counts = [draw.randrange(1, 5) for _ in keys]
            total.update(dict(zip(keys, counts, strict=True)))
            runs.append((np.array(keys, np.uint64), np.array(counts, np.int64)))
        got = [(int(k), int(n)) for keys, counts in merge_runs(runs, block) for k, n in zip(keys, counts, strict=True)]
        assert got == sorted(total.items())
    x = np.array([0, 5, 5 << 40, (1 << 63) + 1], np.uint64)
    assert unpacked_sorted(packed_sorted(x)).tolist() == x.tolist()
    (a, b), n = counted([np.array([2, 1, 2]), np.array([1, 1, 1])], np.array([1, 2, 3]))
    assert (a.tolist(), b.tolist(), n.tolist()) == ([1, 2], [1, 1], [2, 4])
