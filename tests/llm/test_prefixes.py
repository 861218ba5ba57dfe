import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from txwarden.llm.prefixes import common_prefix, conversation_trie, neighbour_prefixes

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = sum(saved[x] for x in below) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted((
        min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
        hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
    ) for node, m in members.items())


def compare(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA + ", part string, depth int")
    got = sorted(tuple(r) for r in conversation_trie(df, **options).collect())
    want = expected(rows)
    assert got == want
    return got


def made(seed, convs=80, words=3, most=6):
    draw = random.Random(seed)
    return [(c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "bb", "é", "dddd"][:words])) for c in draw.sample(range(500), convs) for t in range(draw.randrange(1, most))]


@pytest.mark.parametrize("size", [1, 7, 40, 100_000])
def test_every_cut_gives_the_same_trie(spark, size):
    for seed in (1, 2):
        compare(spark, made(seed), turns_a_part=size)


def test_copies_over_many_borders(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(12)] + [(c, 0, "user", "turn 0") for c in range(300, 340)] + made(3, 60)
    rows = [(c + 1000 if i >= 3640 else c, t, r, x) for i, (c, t, r, x) in enumerate(rows)]
    compare(spark, rows, turns_a_part=100)
    compare(spark, [(c, t, "user", "same") for c in range(90) for t in range(c % 30 + 1)], turns_a_part=25)


def test_given_conversations(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    compare(spark, rows, turns_a_part=200)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, "user", ""), (1, 0, "", None), (2, 0, "a", "bc"), (3, 0, "ab", "c"), (2, 0, "a", "bc"), (None, 0, "user", "x"),
            (7, 5, "u", "x" * 100_000), (8, 1, "u", "y"), (8, 1, "u", "a"), (-4, 0, "u", "z"), (-5, 0, "u", "first"), (-5, 1, "u", "second")]
    for size in (1, 100):
        compare(spark, rows, turns_a_part=size)
    compare(spark, [(c, 0, "user", "short") for c in (6, 7, 8, 9)], turns_a_part=1)
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    deep = [(c, t, "u", f"{t % 3}") for c in (11, 12, 14) for t in range(3000 + c)]
    compare(spark, deep, turns_a_part=10)


def test_common_prefixes():
    draw = np.random.default_rng(2)
    seqs = sorted(b"".join(bytes([x]) * 16 for x in draw.integers(0, 2, draw.integers(0, 9)).tolist()) for _ in range(200))
    found = neighbour_prefixes(pa.array(seqs, pa.binary()))
    assert found[0] == -1 and found[1:].tolist() == [common_prefix(a, b) for a, b in zip(seqs, seqs[1:], strict=False)]
    assert found[1:].tolist() == [next((i // 16 for i in range(0, min(len(a), len(b)), 16) if a[i : i + 16] != b[i : i + 16]), min(len(a), len(b)) // 16) for a, b in zip(seqs, seqs[1:], strict=False)]
