import hashlib
import random
import re
from collections import defaultdict

import numpy as np

from txwarden.llm.substrings import Settings, merged_sketch, packed_cells, partition_sketches, sliding_least, unpacked_cells, without_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = Settings(cell_bits=12, fan=2)


def expected(docs, window=50):
    """doc_id and text of every row to the sorted result rows."""
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    least = defaultdict(lambda: None)
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None and (least[key] is None or i < least[key]):
                least[key] = i
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            first = least[tuple(w[k : k + window])]
            if i is not None and first is not None and first < i:
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def compare(spark, docs, settings=Settings(), parts=5):
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, mark string, place int").repartition(parts)
    got = sorted((tuple(r) for r in without_repeats(rows, settings).collect()), key=repr)
    assert got == expected(docs, settings.window)
    return got


def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = sorted((tuple(r) for r in without_repeats(docs).collect()), key=repr)
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[2] for r in got) > 0


def made(seed):
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(30)}"
    passages = [[word() for _ in range(draw.choice([49, 50, 51, 80]))] for _ in range(4)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(draw.randrange(4)):
            parts += [word() for _ in range(draw.randrange(40))] + draw.choice(passages)
        docs.append((draw.randrange(40), " ".join(parts)))
    return docs


def test_passages_at_every_place(spark):
    for seed in (1, 2):
        assert sum(r[2] for r in compare(spark, made(seed))) > 0


def test_a_full_sketch_loses_nothing(spark):
    compare(spark, made(3), Settings(cell_bits=4, rows=1, fan=2))
    compare(spark, made(4), SMALL, parts=9)


def test_odd_texts(spark):
    one, two = " ".join(f"a{i}" for i in range(60)), " ".join(["same"] * 200)
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, one), (4, one), (5, one.replace(" ", "\n\n")), (6, one.upper()), (None, one), (None, two),
            (7, two), (8, two + " end"), (8, one), (9, "é" * 10), (10, "x" * 100_000 + " " + one), (0, "tail " + one), (-3, "head " + one), (11, " ".join(f"a{i}" for i in range(49)))]
    got = compare(spark, docs)
    assert {r[0]: r[2] for r in got if r[0] in (-3, 0, 5, 11)} == {-3: 0, 0: 60, 5: 60, 11: 0}
    long = " ".join(f"w{i}" for i in range(300_000))
    compare(spark, [(1, long), (2, "before " + long)])
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    texts = {r.doc_id: r.kept_text for r in without_repeats(spark.createDataFrame([(1, one), (2, "b  " + one + " c")], "doc_id int, text string"), text=True).collect()}
    assert texts == {1: one, 2: "b c"}


def test_sketch_never_underestimates(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([x[1] for x in made(5)])], "doc_id long, text string")
    few, many = (merged_sketch(partition_sketches(x, SMALL), SMALL, SMALL.rows) for x in (docs.coalesce(1), docs.repartition(13)))
    assert (few == many).all() and few.any()


def test_helpers():
    draw = np.random.default_rng(1)
    x = draw.integers(0, 99, 200).astype(np.uint64)
    for k in (1, 2, 3, 41, 64):
        assert sliding_least(x, k).tolist() == [int(x[i : i + k].min()) for i in range(len(x) - k + 1)]
    for n in (0, 5, 900):
        at = np.sort(draw.choice(1024, n, replace=False))
        assert unpacked_cells(packed_cells(at, 1024)).tolist() == at.tolist()
