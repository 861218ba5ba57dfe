"""Quality rules whose cutoffs are chosen on labelled documents so that false rejection stays limited, with proof.

Method. Every rule compares one ratio of a text with a cutoff. A level sets the cutoffs of all rules at once, from a loose level
to ever stricter ones, and a stricter level rejects all that a looser one does. For each stratum and level the good documents
among the labelled ones are counted: n of them, k rejected by any rule. The exact binomial tail P(Bin(n, limit) <= k) is the
p-value of "this level rejects more than `limit` of the good documents". The levels of a stratum are tested in their fixed
order, from the loosest on, and the first that is not certified ends the sequence, so each is tested at the whole error of its
stratum; the strata share the error evenly (Bonferroni). So with probability 1 - error no stratum loses more than `limit` of its
good documents. A stratum needs log(error / strata) / log(1 - limit) good labels to certify anything, 217 for four strata.

All of it is DataFrame expressions: no Python runs on the executors.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwarden.llm.store import written

SPACES = "[\\x20\\x09-\\x0D]+"
# Rules: parts per thousand of these counts; a document is rejected above the cutoff.
RATIOS = {
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "long_words": ("word_chars", "n_words"),
}
# Cutoffs of the rules, one for each level, loose to strict.
GRIDS = {
    "symbols": (800, 500, 300, 200, 150, 100, 50, 20, 10),
    "dup_lines": (900, 700, 500, 400, 300, 200, 150, 100, 50),
    "repeats": (180, 150, 120, 100, 80, 60, 40, 20, 10),
    "long_words": (50000, 30000, 20000, 15000, 12000, 10000, 9000, 8000, 7000),
}
LEVELS = len(GRIDS["symbols"])


@dataclass(frozen=True)
class Risk:
    """`limit`: largest share of a stratum's good documents the rules may reject; `error`: probability that this fails."""

    limit: float = 0.02
    error: float = 0.05
    stratum: str = "lang"


def features(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The counts of each text: words, code points in words, symbols, lines, repeated lines, words in repeated 5-word windows.

    Windows are compared by their 64-bit hash. Only texts with a repeated window sort theirs.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", *keep, text.alias("text"), F.array_remove(F.split(text, SPACES), "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    at = lambda i, k: F.get("words", i + k)
    hashes = F.transform(F.sequence(F.lit(0), F.size("words") - 5), lambda i: F.xxhash64(*[at(i, k) for k in range(5)]))
    rows = rows.select(
        "doc_id", *keep, F.size("words").cast("long").alias("n_words"), F.length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"), lines.alias("lines"),
        F.when(F.size("words") >= 6, hashes).alias("hashes"),
    )
    rows = rows.select("*", (F.size(F.array_distinct("hashes")) < F.size("hashes")).alias("again"))
    # Windows in order of hash, then place: repeated ones are neighbours.
    placed = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.select("*", F.when(F.col("again"), placed).alias("placed")).drop("hashes")
    same = lambda x, i: (x["h"] == F.get("placed", i - 1)["h"]) | (x["h"] == F.get("placed", i + 1)["h"])
    repeated = F.filter("placed", lambda x, i: F.coalesce(same(x, i), (x["h"] == F.get("placed", i + 1)["h"]), (x["h"] == F.get("placed", i - 1)["h"]), F.lit(False)))
    rows = rows.select("*", F.sort_array(F.transform(repeated, lambda x: x["i"])).alias("starts")).drop("placed")
    reach = F.transform("starts", lambda s, i: F.least(F.lit(5), F.coalesce(F.get("starts", i + 1) - s, F.lit(5))))
    covered = F.coalesce(F.aggregate(reach, F.lit(0), lambda a, b: a + b), F.lit(0))
    return rows.select(
        "doc_id", *keep, "n_words", "word_chars", "n_symbols", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), covered.cast("long").alias("n_repeat_words"),
    ).withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))


def above(rule: str, cutoff: Column | int) -> Column:
    top, bottom = RATIOS[rule]
    return F.col(top) * 1000 > F.lit(cutoff) * F.col(bottom) if isinstance(cutoff, int) else F.col(top) * 1000 > cutoff * F.col(bottom)


def log_gamma(x: Column) -> Column:
    """Stirling's series, eight steps up, for x >= 1."""
    z = x + 8
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    steps = F.log(x)
    for i in range(1, 8):
        steps = steps + F.log(x + i)
    return series - steps


def binomial_tail(k: Column, n: Column, p: float, terms: int = 1000) -> Column:
    """P(Bin(n, p) <= k) for k < n p: the last `terms` terms, and for the others the geometric bound from above.

    1 where k >= n p, as no cutoff is certified there.
    """
    first = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    down = lambda i: i * (1 - p) / ((n - i + 1) * p)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    step = lambda s, i: F.struct(
        (s["term"] * down(i)).alias("term"), (s["total"] + s["term"] * down(i)).alias("total"))
    last = F.greatest(k - (terms - 1), F.lit(1).cast("long"))
    places = F.when(k >= 1, F.sequence(k, last, F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    rest = lambda s: s["total"] + F.when(last > 1, s["term"] * down(last - 1) / (1 - down(last - 1))).otherwise(0.0)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(first) * F.aggregate(places, start, step, rest)))


def certified(counts: DataFrame, good: DataFrame, risk: Risk) -> DataFrame:
    """stratum, level and the cutoffs cut_<rule> of each stratum where a level is certified: the strictest one that is.

    `counts` are features with a stratum, `good` has the doc_id of good documents. Documents that fail the base rules do not count.
    """
    held = counts.filter("not base_failed").join(good.select("doc_id").distinct(), "doc_id", "left_semi")
    rejected = [functools.reduce(lambda a, b: a | b, [above(rule, GRIDS[rule][j]) for rule in RATIOS]) for j in range(LEVELS)]
    table = held.groupBy("stratum").agg(F.count("*").alias("n"), *[F.sum(r.cast("long")).alias(f"k{j}") for j, r in enumerate(rejected)])
    table = written(table, "holdout")
    error = risk.error / table.agg(F.count("*")).scalar()
    rows = table.select("stratum", "n", F.posexplode(F.array(*[F.col(f"k{j}") for j in range(LEVELS)])).alias("level", "k"))
    tested = rows.withColumn("passed", binomial_tail(F.col("k"), F.col("n"), risk.limit) <= error)
    # The sequence ends at the first level that does not pass.
    ends = tested.groupBy("stratum").agg(F.coalesce(F.min(F.when(~F.col("passed"), F.col("level"))), F.lit(LEVELS)).alias("end")).filter("end > 0")
    level = F.col("end") - 1
    grids = [F.get(F.array(*[F.lit(c).cast("long") for c in GRIDS[rule]]), level).alias(f"cut_{rule}") for rule in RATIOS]
    return ends.select("stratum", level.alias("level"), *grids)


def judged(docs: DataFrame, labels: DataFrame, risk: Risk = Risk(), keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, the columns of `keep` under their names, its counts, base_failed, the rules that reject it, kept.

    `docs` has doc_id, text and the stratum column; `labels` has doc_id and quality (1: good). Other columns are ignored.
    A null or empty text has no words and fails the base rules. A null stratum is a stratum of its own. Labels: a document
    with several counts as good if all that are not null are 1; null ids match nothing. Repeated rows count each. Without
    labels no cutoff is certified and only the base rules reject; an empty table gives an empty result.
    """
    kept = {name: f"_kept_{i}" for i, name in enumerate(keep)}
    rows = docs.select(
        "doc_id", "text", F.coalesce(F.col(risk.stratum).cast("string"), F.lit("")).alias("stratum"), *[F.col(c).alias(k) for c, k in kept.items()])
    counts = written(features(rows, ("stratum", *kept.values())), "features")
    good = labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1")
    cuts = written(certified(counts, good, risk), "cutoffs")
    rows = counts.join(cuts, "stratum", "left")
    hits = F.concat(*[F.when(above(rule, F.col(f"cut_{rule}")), F.array(F.lit(rule))).otherwise(F.array().cast("array<string>")) for rule in RATIOS])
    return rows.select(
        "doc_id", *[F.col(k).alias(c) for c, k in kept.items()], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        hits.alias("rejected_by"), (~F.col("base_failed") & (F.size(hits) == 0)).alias("kept"))
