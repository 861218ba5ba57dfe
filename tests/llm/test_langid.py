import zlib

import numpy as np
import pytest

from txwarden.llm.arrow import text_bytes
from txwarden.llm.langid import EDGE, FACTORS, LETTERS, Settings, counted_runs, features, fit, gathered, languages, learned, logits, text_parts

WORDS = {"aa": "the of and that with for was his they are", "bb": "der die und ist nicht das von mit für über", "cc": "ñandú el los que para por una señal ción"}


def made(count, seed=0):
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(count):
        lang = ("aa", "bb", "cc")[i % 3]
        words = WORDS[lang].split()
        rows.append((i, " ".join(words[k] for k in draw.integers(0, len(words), int(draw.integers(3, 40)))), lang))
    return rows


def by_hand(model, text):
    raw = bytes([EDGE]) + text.encode() + bytes([EDGE])
    b = [int(LETTERS[x]) for x in raw]
    rows, shift = [], 32 - int(len(model.weights) - 1).bit_length() + 1
    for k in (2, 3, 4):
        for i in range(len(b) - k + 1):
            part = b[i : i + k]
            if (any(x != EDGE for x in part) if k == 2 else all(x != EDGE for x in part[1:-1])):
                value = 0
                for x in part:
                    value = (value << 8 | x) & 0xFFFFFFFF
                rows.append(model.weights[(value * FACTORS[k] & 0xFFFFFFFF) >> shift])
    return np.mean(rows, axis=0) + model.offsets if rows else model.offsets


def sampled(spark, rows, settings):
    """Feature rows of (rank, text, language)."""
    df = spark.createDataFrame([(r[2], r[1], int(r[0])) for r in rows], "lang string, text string, rank long")
    return gathered(features(df, settings).toArrow(), settings)


def test_features_stay_small_and_in_order(spark):
    rows = [*made(30), (31, "the of " * 100_000, "aa"), (32, "", "bb")]
    sample = sampled(spark, rows, Settings())
    assert sample.names == ("aa", "bb", "cc") and len(sample.ids) == len(sample.counts) == sample.starts[-1]
    assert (np.diff(sample.starts) < 300).all() and sample.held.sum() == sum(r[0] % 5 == 0 for r in rows)
    again = gathered(features(spark.createDataFrame([(r[2], r[1], int(r[0])) for r in rows], "lang string, text string, rank long").repartition(7), Settings()).toArrow(), Settings())
    assert (again.ids == sample.ids).all() and (again.label == sample.label).all()
    ids, counts = counted_runs(b"ab ab", 1 << 15)  # twice: edge a, ab, b edge; edge ab edge's threes and its four
    assert counts.sum() == 2 * 6 and (counts == 2).all()
    assert text_parts(b"x" * 100, True, Settings()) == [b"x" * 100] and [len(x) for x in text_parts(b"x" * 100, False, Settings())] == [100, 16, 40]


def test_logits_are_the_mean_of_the_runs(spark):
    model = fit(sampled(spark, made(60), Settings(epochs=1)), Settings(epochs=1))
    texts = ["", "a", "the of", "  ", "Über Das 12 nicht!", "x" * 5000, "é"]
    import pyarrow as pa

    got = logits(model, *text_bytes(pa.array(texts)))
    for text, row in zip(texts, got, strict=True):
        assert row == pytest.approx(by_hand(model, text), abs=1e-6)


def test_learns_and_rejects(spark):
    rows = [(*r[:2], r[2], "src", 1) for r in made(900)]
    odd = [(5000, None, "aa", None, None), (5001, "", "aa", None, 0), (5002, "123 !?", None, None, 0), (5003, "the of and", None, None, 0), (5003, "the of and", None, None, 0), (5004, "der die " * 30_000, None, None, 0)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string, lettered int")
    model = learned(docs)
    assert model.languages == ("aa", "bb", "cc")
    got = languages(docs, model, keep=("score",)).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {r[0]: r[2] for r in rows}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.doc_id in truth:
            assert r.lang_pred == truth[r.doc_id] and r.accepted and r.kept_score == "src"
        elif r.doc_id < 5003:
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        else:
            assert r.lang_pred == ("bb" if r.doc_id == 5004 else "aa")


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "the of", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in languages(docs, learned(docs)).collect()} == {"und"}
    assert languages(docs.limit(0), learned(docs.limit(0))).collect() == []


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder.replace('0.001', '0.01')}/documents.parquet")
    got = languages(docs, learned(docs)).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").filter("held_out").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.95
    long_ = got[got["n_chars"] > 100]
    assert (long_["lang_pred"] == long_["lang"]).mean() > 0.98
    assert got["accepted"].mean() > 0.97


def test_a_language_left_out_is_mostly_rejected(spark, folder):
    docs = spark.read.parquet(f"{folder.replace('0.001', '0.01')}/documents.parquet").filter("n_chars > 100")
    model = learned(docs.filter("lang <> 'de'"))
    got = languages(docs, model, keep=("lang",)).toPandas()
    own = got[got["kept_lang"] != "de"]
    assert 0 < model.cutoff <= 1 and own["accepted"].mean() > 0.97
    assert got[got["kept_lang"] == "de"]["accepted"].mean() < 0.5 * own["accepted"].mean()
