import re
from collections import Counter, defaultdict

import numpy as np

from txwarden.llm.components import components
from txwarden.llm.minhash import Settings, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} if words else set()


def roots(nodes, links):
    parent = {i: i for i in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in nodes}


def expected(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    holders, links = defaultdict(list), []
    for i in sorted(sets):
        met = Counter(o for s in sets[i] for o in holders[s])
        links += [(o, i) for o, k in met.items() if 100 * k >= 85 * (len(sets[i]) + len(sets[o]) - k)]
        for s in sets[i]:
            holders[s].append(i)
    return {i: len(s) for i, s in sets.items()}, roots(sets, links)


def compare(docs, texts, settings=Settings()):
    sizes, of = expected(texts)
    got = near_duplicates(docs, settings).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], of[r.doc_id], of[r.doc_id] == r.doc_id)


def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    compare(docs, {r.doc_id: r.text for r in docs.collect()})


def test_chains_and_graded_copies(spark):
    draw = np.random.default_rng(3)
    base = [f"w{x}" for x in draw.integers(0, 400, 150)]
    texts, words = {}, list(base)
    for i in range(120):  # a chain: each has a few more edits than the one before
        if i % 2:
            words[int(draw.integers(0, 150))] = f"e{i}"
        texts[1000 - i] = " ".join(words)
    for i in range(150):  # copies of one text with few to many edits
        copy = list(base)
        for _ in range(int(draw.integers(0, 12))):
            copy[int(draw.integers(0, 150))] = f"f{i}"
        texts[2000 + i] = " ".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    compare(docs, texts, Settings(block=1 << 14))


def test_odd_texts(spark):
    texts = {1: None, 2: "", 3: " \n", 4: "one", 5: "One", 6: "one two", 7: "two one", 8: "a b c", 9: "A\tb\nC", 10: "a b c a b c", 11: "É b c", 12: "é b c", 13: "w " * 60_000, 14: "w " * 70_000}
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts.items()], "doc_id long, text string, rep string, n int")
    compare(docs, texts)
    nameless = [(None, t, "x", 1) for t in ("a b c", "p q r s", "p q r s t u v w x y z " * 3, "p q r s t u v w x y z " * 3 + "a", None, "")]
    again = docs.union(docs.filter("doc_id in (8, 1)")).union(spark.createDataFrame(nameless, docs.schema))
    got = near_duplicates(again).collect()
    assert len(got) == len(texts) + 2 + len(nameless) and sum(r.doc_id == 8 for r in got) == 2
    alone = [(r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None]
    # A copy of document 8, one alone, two near copies of each other, two without words.
    assert alone.count((1, 8, False)) == 1 and alone.count((2, None, True)) == 1 and alone.count((0, None, True)) == 2
    assert sorted(x[2] for x in alone if x[0] > 2) == [False, True] and all(x[1] is None for x in alone if x[0] > 2)
    assert near_duplicates(docs.limit(0)).collect() == []


def test_components_against_union_find(spark):
    draw = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in draw.integers(0, 300, (260, 2))] + [(i, i + 1) for i in range(500, 560)] + [(700, 700 + i) for i in range(40)]
    df = spark.createDataFrame([*links, (5, 5), (None, 3)], "x long, y long")
    got = {r.a: r.b for r in components(df).collect()}
    of = roots({x for pair in links for x in pair}, links)
    assert got == {i: t for i, t in of.items() if i != t}
