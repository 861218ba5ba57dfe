import numpy as np

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def runs(text, k):
    words = text.lower().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def similarity(a, b, k):
    a, b = runs(a, k), runs(b, k)
    return len(a & b) / len(a | b)


def kept_by_hand(texts):
    """The smallest doc_id of each group that pairs of five-word similarity of 0.8 or more tie together."""
    of = {i: i for i in texts}
    for i in texts:
        for j in texts:
            if i < j and similarity(texts[i], texts[j], 5) >= 0.8:
                a, b = of[i], of[j]
                of = {x: min(a, b) if y in (a, b) else y for x, y in of.items()}
    return set(of.values())


def rows(texts):
    return [(i, t, "en", "s", len(t)) for i, t in texts]


def test_five_words_and_four_fifths(spark):
    draw = np.random.default_rng(8)
    texts = {}
    for group in range(30):
        words = [f"w{x}" for x in draw.integers(0, 100_000, 100)]
        texts[group * 10] = " ".join(words)
        longer = words + [f"x{x}" for x in draw.integers(0, 100_000, int(draw.integers(14, 30)))]
        texts[group * 10 + 1] = " ".join(longer)
        edited = list(words)
        for at in draw.choice(100, int(draw.integers(1, 5)), replace=False).tolist():
            edited[at] = f"y{group}"
        texts[group * 10 + 2] = " ".join(edited)
    pairs = [(texts[g * 10], texts[g * 10 + k]) for g in range(30) for k in (1, 2)]
    assert any(similarity(*p, 5) >= 0.8 and similarity(*p, 3) < 0.85 for p in pairs)
    assert any(similarity(*p, 5) < 0.8 and similarity(*p, 3) >= 0.85 for p in pairs)
    got = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows(texts.items()), SCHEMA), "")
    assert {r.doc_id for r in got.collect()} == kept_by_hand(texts)


def test_no_clean_document_is_lost(spark):
    """Texts that share a doc_id or have none stay if they are no copies; copies go, with whatever id they have."""
    words = lambda k: " ".join(f"t{k}x{i}" for i in range(60))
    docs = [(1, words(1)), (1, words(2)), (2, words(2) + " more"), (None, words(3)), (None, words(3)), (None, words(4)), (3, words(4)), (5, words(5)), (5, words(5)), (None, words(6) + " end"), (None, words(6))]
    table = [(i, t, "en", "ab"[k % 2], len(t)) for k, (i, t) in enumerate(docs)]
    got = corpus_pipeline.near_copies(spark, spark.createDataFrame(table, SCHEMA), "").collect()
    kept = sorted(((r.doc_id, r.text.split("x")[0]) for r in got), key=repr)
    assert kept == sorted([(1, "t1"), (1, "t2"), (None, "t3"), (3, "t4"), (5, "t5"), (None, "t6")], key=repr)
    assert all((r.doc_id, r.text, r.lang, r.source, r.n_chars) in table for r in got)
    assert corpus_pipeline.near_copies(spark, spark.createDataFrame([], SCHEMA), "").collect() == []
