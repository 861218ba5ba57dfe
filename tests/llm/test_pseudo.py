import math
from collections import Counter

import numpy as np
import pytest

from txwarden.llm.pseudo import Network, Settings, Vocabulary, neighbours, pseudo_likelihood, trained, vocabulary, word_counts, word_shares
from txwarden.llm.shingles import words

SMALL = Settings(classes=4, hashed=6, width=3, batch=16, rounds=1)


def word_hash(word):
    raw = np.frombuffer(word.lower().encode(), np.uint8)
    return int(words(raw, np.array([0, len(raw)]))[0][0])


def test_probabilities_sum_to_one():
    net = Network(SMALL)
    near = np.array([[1, 2, 16, 3]])
    total = sum(math.exp(net.log_probabilities(near, np.array([t]))[0]) for t in range(SMALL.size))
    assert total == pytest.approx(1, abs=1e-5)


def by_hand(net, near, target):
    s = net.settings
    h = np.tanh(sum(net.near[o][n].astype(float) for o, n in enumerate(near)))
    z = net.classes.astype(float) @ h + net.class_bias
    c, w = divmod(target, s.classes)
    y = net.words[c].astype(float) @ h + net.word_bias[c]
    return z[c] - math.log(np.exp(z).sum()) + y[w] - math.log(np.exp(y).sum())


def test_scores_one_by_one():
    net, draw = Network(SMALL), np.random.default_rng(0)
    near, target = draw.integers(0, SMALL.size + 1, (200, 4)), draw.integers(0, SMALL.size, 200)
    got = net.log_probabilities(near, target)
    assert got == pytest.approx([by_hand(net, n, t) for n, t in zip(near, target.tolist(), strict=True)], abs=1e-5)


def test_gradient_by_differences():
    net, draw = Network(SMALL), np.random.default_rng(1)
    near, target = draw.integers(0, SMALL.size + 1, (30, 4)), draw.integers(0, SMALL.size, 30)
    g, back = net.gradient(near, target)
    slopes = np.zeros((4, SMALL.size + 1, SMALL.width))
    for o in range(4):
        np.add.at(slopes[o], near[:, o], back)
    slopes = np.concatenate([slopes.ravel(), g.values])
    loss = lambda v: -Network(SMALL, v).log_probabilities(near, target).sum()
    for i in draw.integers(0, len(net.values), 60).tolist():
        up, down = net.values.astype(np.float64), net.values.astype(np.float64)
        up[i] += 1e-5
        down[i] -= 1e-5
        assert slopes[i] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=2e-3)


def test_neighbours_stop_at_edges():
    got = neighbours(np.array([5, 6, 7, 8], np.int32), np.array([0, 3, 3, 4]), SMALL)
    assert got.tolist() == [[16, 16, 6, 7], [16, 5, 7, 16], [5, 6, 16, 16], [16, 16, 16, 16]]


def test_vocabulary_has_the_most_frequent(spark):
    texts = ["The the a", "a b c the", None, "d d d d"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    counts = Counter(w for t in texts if t for w in t.lower().split())
    got = vocabulary(docs, Settings(classes=2, hashed=1)).tolist()
    assert [counts[w] for h in got for w in counts if word_hash(w) == h] == [4, 3, 2]
    ids = Vocabulary(np.array(got, np.uint64), Settings(classes=2, hashed=1)).ids(np.array([word_hash(w) for w in ("d", "the", "a", "b", "zz")], np.uint64))
    assert ids.tolist() == [0, 1, 2, 3, 3]


def test_learns_both_sides_and_handles_odd_texts(spark):
    draw = np.random.default_rng(2)
    pairs = [("red", "blood"), ("blue", "sky"), ("green", "grass"), ("white", "snow")]
    rows = []
    for i in range(400):
        parts = [f"{a} is {b} ." for a, b in (pairs[k] for k in draw.integers(0, 4, 20))]
        rows.append((i, " ".join(parts), "x", 0.5))
    odd = [(1000, None), (1001, ""), (1002, "  \n"), (1003, "red"), (1003, "red"), (1004, "blood is red . " * 5), (1005, "sky is red . " * 5), (1006, "red is blood . " * 20_000), (None, "red is sky .")]
    docs = spark.createDataFrame(rows + [(*r, "clash", 1.0) for r in odd], "doc_id long, text string, n_tokens string, pll double").repartition(2)
    settings = Settings(classes=8, hashed=8, width=8, rounds=3, masked=0.5, batch=64)
    got = pseudo_likelihood(docs, settings).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    for i in (1000, 1001, 1002):
        assert (by[i].n_tokens, by[i].pll, by[i].mean_pll) == (0, 0.0, None)
    assert by[1006].n_tokens == 80_000 and by[1006].mean_pll > -0.5
    assert np.mean([by[i].mean_pll for i in range(400)]) > -1.2 and by[1004].mean_pll < by[1006].mean_pll
    assert pseudo_likelihood(docs.limit(0), settings).collect() == []


def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = pseudo_likelihood(docs).toPandas()
    assert {r.doc_id: r.n_tokens for r in got.itertuples()} == {i: len((t or "").split()) for i, t in texts.items()}
    assert got[got["n_tokens"] > 0]["mean_pll"].mean() > -math.log(4096)
    again = pseudo_likelihood(docs).toPandas()
    assert again.sort_values("doc_id")["pll"].tolist() == pytest.approx(got.sort_values("doc_id")["pll"].tolist())


def test_every_word_has_its_own_probability(spark):
    draw = np.random.default_rng(5)
    texts = [" ".join(f"w{int(x)}" for x in draw.zipf(1.3, 60) % 300) for _ in range(80)] + [None, ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (0, texts[1]), (None, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    counts = Counter(w for _, t in rows for w in (t or "").split())
    ranked = vocabulary(docs, SMALL)
    known, place = Vocabulary(ranked, SMALL), {}
    for w in counts:
        place[w] = int(known.ids(np.array([word_hash(w)], np.uint64))[0])
    held = Counter()
    for w, n in counts.items():
        held[place[w]] += n
    assert len(held) == SMALL.size
    log_share = {w: math.log(n / held[place[w]]) for w, n in counts.items()}
    got = {r.word % (1 << 64): r.share for r in word_shares(word_counts(docs), ranked, SMALL).collect()}
    assert got == pytest.approx({word_hash(w): s for w, s in log_share.items() if place[w] >= SMALL.frequent})
    net = trained(docs, ranked, SMALL)
    near = np.array([[1, 2, 16, 3]])
    assert sum(math.exp(net.log_probabilities(near, np.array([place[w]]))[0] + log_share[w]) for w in counts) == pytest.approx(1, abs=1e-4)

    def score(text):
        ids = np.array([place[w] for w in (text or "").split()], np.int32)
        if not len(ids):
            return 0.0
        return net.log_probabilities(neighbours(ids, np.array([0, len(ids)]), SMALL), ids).sum() + sum(log_share[w] for w in text.split())

    want = sorted((i is not None, i or 0, score(t)) for i, t in rows)
    found = sorted((r.doc_id is not None, r.doc_id or 0, r.pll) for r in pseudo_likelihood(docs, SMALL).collect())
    assert [x[:2] for x in found] == [x[:2] for x in want]
    assert [x[2] for x in found] == pytest.approx([x[2] for x in want], abs=1e-2)
