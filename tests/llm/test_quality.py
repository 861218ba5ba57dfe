import math
import re

import pytest
from pyspark.sql import functions as F

from txwarden.llm.quality import GRIDS, LEVELS, Risk, binomial_tail, judged

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, words string, kept int"


def counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else set()
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def tail(k, n, p):
    return math.fsum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_counts_match_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = judged(docs, labels).collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == counts(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)


def test_odd_texts(spark):
    same = "a b c d e f g h i j k l m n o"
    texts = [None, "", " \t\n", same, same, "x " * 30, "a b c d e " * 2 + "é ü f g h", "q\n\nq\n q \nq #$", "a b c d e f a b c d e f", "w" * 200_000]
    rows = [(i % 9, t, None if i % 2 else "en", "clash", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(None, 1), (1, None), (1, 1), (1, 1)], "doc_id long, quality int")
    got = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in judged(docs, labels).collect())
    assert got == sorted(counts(t) for t in texts)
    assert judged(docs.limit(0), labels).collect() == []
    assert judged(docs, labels.limit(0)).filter("kept <> (not base_failed)").count() == 0


@pytest.mark.parametrize("p", [0.005, 0.05])
def test_binomial_tail(spark, p):
    pairs = [(k, n) for n in (1, 50, 1000, 3000) for k in (0, 1, 2, 5, 20, 100) if k < n * p]
    df = spark.createDataFrame(pairs, "k long, n long").withColumn("t", binomial_tail(F.col("k"), F.col("n"), p))
    for r in df.collect():
        assert r.t == pytest.approx(tail(r.k, r.n, p), rel=1e-8)
    # Cut short, it bounds the sum from above.
    for r in df.withColumn("u", binomial_tail(F.col("k"), F.col("n"), p, 3)).collect():
        assert r.u >= tail(r.k, r.n, p) * (1 - 1e-9)


def test_cutoffs_hold_the_limit_and_reject(spark):
    good = "one two three four five six seven eight nine ten eleven twelve"
    bad = "one# two$ three% four& five* six| seven# eight$ nine% ten& eleven* twelve|"
    rows = [(i, bad if i % 5 == 0 else good + (" #" if i % 997 == 1 else ""), "en") for i in range(6000)]
    rows += [(10_000 + i, bad, "xx") for i in range(50)]  # too few to prove anything
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (~F.col("text").contains("$")).cast("int").alias("quality")).filter("doc_id < 10000")
    risk = Risk()
    got = judged(docs, labels, risk)
    lost = got.join(labels.filter("quality = 1"), "doc_id").filter("not kept").count()
    assert lost <= risk.limit * 4800
    assert got.filter("doc_id < 10000 and doc_id % 5 = 0 and kept").count() == 0
    assert got.filter("doc_id >= 10000 and not kept").count() == 0
    # The level is the strictest one up to which the exact tail certifies all, by the joint rejections.
    good_counts = [counts(t) for i, t, _ in rows if i < 10_000 and i % 5]
    sums = [sum(any(above_by_hand(c, rule, GRIDS[rule][j]) for rule in GRIDS) for c in good_counts) for j in range(LEVELS)]
    passed = [tail(k, len(good_counts), risk.limit) <= risk.error for k in sums]
    level = passed.index(False) - 1 if False in passed else LEVELS - 1
    for r in got.filter("doc_id < 10000").collect():
        c = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert set(r.rejected_by) == {rule for rule in GRIDS if above_by_hand(c, rule, GRIDS[rule][level])}


def above_by_hand(c, rule, cutoff):
    """All lines of these texts are one."""
    words, chars, symbols, dup, repeats = c
    top, bottom = {"symbols": (symbols, words), "dup_lines": (dup, 1), "repeats": (repeats, words), "long_words": (chars, words)}[rule]
    return 1000 * top > cutoff * bottom


def test_few_labels_certify_and_a_failure_ends_the_sequence(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i, text + (" #a #b #c" if i < losses else ""), lang) for lang, start, n, losses in (("few", 0, 216, 0), ("enough", 1000, 217, 0), ("lossy", 2000, 217, 2003)) for i in range(start, start + n)]
    rows += [(5000 + k, text + "".join(f" #{i}" for i in range(60)), lang) for k, lang in enumerate(("few", "enough", "lossy", None))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in rows if i < 5000] + [(5003, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in judged(docs, labels).collect()}
    assert [got[5000 + k].kept for k in range(4)] == [True, False, False, True]
    assert not any(r.rejected_by for i, r in got.items() if i < 2000)


def test_kept_columns_may_have_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k", "en", 7, "x")], "doc_id long, text string, lang string, kept_at int, stratum string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    row = judged(docs, labels, keep=("lang", "text", "stratum", "kept_at")).first()
    assert (row.lang, row.text, row.stratum, row.kept_at, row.kept) == ("en", "a b c d e f g h i j k", "x", 7, True)
