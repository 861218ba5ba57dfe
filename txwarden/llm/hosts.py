"""URL filter: explicit rules first, and for the rest a naive Bayes score over segmented host names and path tokens.

Method. A host, without user and port, is cut into runs of letters and of digits; digits become a mark for numbers, and each
run of letters is split into words by Viterbi over a unigram model: the split with the highest product of word probabilities.
Word counts come from the text of all pages; a few stated words count as if they had been seen often, as names are made of
them. A run of l letters that is no known word has the probability 10 / (N * 10^l). Path tokens are the letter runs of the
path, with a mark for numbers.

The multinomial naive Bayes model is fitted on all pages. Its labels come from what a page says, not from its url: a url is an
example of `block` if enough of the words of its page's text are stated words, and of `allow` otherwise. Its features are the
words of host and path alone. So a stated word in a name weighs as much as such names lead to such pages, other words weigh by
the same measure, and urls are judged that have no page text at all. The score decides where no rule fits.

Words are only looked up for the labels that occur: every label's substrings are joined with the counts, so neither
vocabulary nor hosts are collected. Urls with the same tokens are scored once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwarden.llm.arrow import column, pieces
from txwarden.llm.store import written

# Words that names of unwanted hosts are made of; a parameter, in alphabetical order.
UNWANTED = ("adult", "bets", "bonus", "casino", "cheap", "farm", "free", "loans", "lottery", "pills", "poker", "porn", "spam", "viagra", "win", "xxx")
NUMBER = "#"
# The most letters that the domain name system allows in a label, so in a word of one; fixed value.
LONGEST = 63


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains, and the start of the path."""

    verdict: str
    host: str
    path: str


def rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


# The rules of the registered query.
RULES = (
    rule("allow", "com/"), rule("block", "example.com/en/"), rule("allow", "www.example.com/en/"), rule("block", "net/es/"), rule("block", "net/fr/"),
)


@dataclass(frozen=True)
class Settings:
    """`stated`: how often each unwanted word counts as seen, as a share of all words. `share`: the least share of unwanted
    words in the text of a page that makes its url an example of `block`. `smoothing`: added to every count."""

    rules: tuple[Rule, ...] = RULES
    unwanted: tuple[str, ...] = UNWANTED
    stated: float = 1e-4
    share: float = 1e-3
    smoothing: float = 1.0


def host_of(url: Column) -> Column:
    """What stands between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    raw = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Text and verdict of the longest rule that fits, null without one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


TAGS = re.compile(r"<[^>]*>")
LETTERS = re.compile(r"[a-z]+")


def word_counts(pages: DataFrame) -> DataFrame:
    """How often each run of letters a-z, lower-cased, of at most LONGEST letters occurs in the text of all pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in pieces(batches, "html"):
            seen = Counter()
            for html in column(batch, "html").to_pylist():
                seen.update(LETTERS.findall(TAGS.sub(" ", (html or "").lower())))
            words = [w for w in seen if len(w) <= LONGEST]
            yield pa.record_batch({"word": pa.array(words, pa.string()), "n": pa.array([seen[w] for w in words], pa.int64())})

    return pages.select("html").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def says_unwanted(html: Column, settings: Settings) -> Column:
    """Whether at least `share` of the runs of letters a-z in a page's text are unwanted words; false without any."""
    text = F.lower(F.regexp_replace(html, "<[^>]*>", " "))
    words = F.regexp_count(text, F.lit("[a-z]+"))
    found = F.regexp_count(text, F.lit(f"(?<![a-z])(?:{'|'.join(settings.unwanted)})(?![a-z])")) if settings.unwanted else F.lit(0)
    return F.coalesce((found > 0) & (found >= words * settings.share), F.lit(False))


def viterbi(label: str, logs: dict[str, float], total: float) -> list[str]:
    """The split of a label with the highest product of word probabilities; ties go to the longer last word.

    Known words have up to LONGEST letters, unknown runs any number: as their log probability falls by the same amount for
    each letter, the best place for one to begin is kept from step to step.
    """
    letter, unknown = math.log(10), math.log(10 / total)
    best, cut, begin = [0.0], [0], 0
    for end in range(1, len(label) + 1):
        if best[end - 1] + (end - 1) * letter > best[begin] + begin * letter:
            begin = end - 1
        found = (best[begin] + unknown - (end - begin) * letter, -begin)
        for start in range(max(0, end - LONGEST), end):
            log = logs.get(label[start:end])
            if log is not None:
                found = max(found, (best[start] + log, -start))
        best.append(found[0])
        cut.append(-found[1])
    out, end = [], len(label)
    while end:
        out.append(label[cut[end] : end])
        end = cut[end]
    return out[::-1]


def segmented(labels: DataFrame, counts: DataFrame, settings: Settings) -> DataFrame:
    """label and words of each distinct label, a run of letters."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = max(1, round(total * settings.stated))
    stated = labels.sparkSession.createDataFrame([(w, often) for w in settings.unwanted], "word string, n long")
    known = counts.union(stated).groupBy("word").agg(F.sum("n").alias("n"))
    size = float(total + often * len(settings.unwanted) + 1)
    labels = labels.distinct()
    # Substrings of a label: at most LONGEST for each of its places.
    spots = F.sequence(F.lit(1), F.length("label"))
    sizes = F.sequence(F.lit(1), F.lit(LONGEST))
    parts = F.array_distinct(F.flatten(F.transform(spots, lambda i: F.transform(sizes, lambda k: F.substring("label", i, k)))))
    asked = labels.filter("label <> ''").select("label", F.explode(parts).alias("word"))
    hits = asked.join(known, "word").groupBy("label").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("hits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for label, hits in zip(column(batch, "label").to_pylist(), column(batch, "hits").to_pylist(), strict=True):
                logs = {w: math.log(n / size) for w, n in hits or []}
                words.append(viterbi(label, logs, size))
            yield pa.record_batch({"label": column(batch, "label"), "words": pa.array(words, pa.list_(pa.string()))})

    return labels.filter("label <> ''").join(hits, "label", "left").mapInArrow(run, "label string, words array<string>")


def host_labels(host: Column) -> Column:
    """The runs of letters and of digits of a host in order, without user and port; NUMBER for digits."""
    name = F.regexp_replace(F.regexp_replace(host, "(?s)^.*@", ""), ":[0-9]*\\z", "")
    runs = F.regexp_extract_all(F.lower(name), F.lit("\\p{Nd}+|[\\p{L}\\p{M}]+"), F.lit(0))
    return F.transform(runs, lambda x: F.when(x.rlike("^\\p{Nd}"), F.lit(NUMBER)).otherwise(x))


def host_words(hosts: DataFrame, counts: DataFrame, settings: Settings) -> DataFrame:
    """host and its words in order, for each distinct host."""
    hosts = hosts.select("host").distinct()
    labels = hosts.select("host", F.posexplode(host_labels(F.col("host"))).alias("place", "label"))
    words = segmented(labels.filter(F.col("label") != NUMBER).select("label"), counts, settings)
    told = F.struct("place", F.coalesce("words", F.array("label")).alias("words"))
    joined = labels.join(words, "label", "left").groupBy("host").agg(F.sort_array(F.collect_list(told)).alias("all"))
    return joined.select("host", F.flatten(F.col("all.words")).alias("host_words"))


def path_tokens(path: Column) -> Column:
    lower = F.lower(path)
    runs = F.regexp_extract_all(lower, F.lit("[0-9]+|[\\p{L}]+"), 0)
    return F.transform(runs, lambda x: F.when(x.rlike("^[0-9]+$"), F.lit(NUMBER)).otherwise(x))


def judged_urls(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (log odds of `block`; above 0 the method blocks).

    `pages` has page_id, url and html; other columns are ignored. A null url, or one without `://`, has an empty host and
    path, fits no rule and has no tokens: the shares of the classes alone decide. Null html has no words, so its url is an
    example of `allow`. Ties of a score at 0 are allowed. Repeated rows give a row each and count as often. An empty table gives an empty result. A host's labels
    and urls of any length are taken whole; words of more than LONGEST letters are not looked up.
    """
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), says_unwanted(F.col("html"), settings).alias("bad"))
    counts = written(word_counts(pages), "words")
    hosts = written(host_words(rows, counts, settings), "hosts")
    rows = rows.join(hosts, "host", "left")
    names = F.coalesce("host_words", F.array().cast("array<string>")).alias("names")
    rows = written(rows.select("page_id", "host", "path", "bad", names, path_tokens(F.col("path")).alias("steps")), "urls")
    kinds = rows.groupBy("names", "steps").agg(F.count_if("bad").alias("b"), F.count_if(~F.col("bad")).alias("a"))
    kinds = written(kinds.withColumn("key", F.monotonically_increasing_id()), "kinds")
    kinds_of = kinds.select("key", "b", "a", F.explode(F.concat("names", "steps")).alias("token"))
    tokens = written(kinds_of.groupBy("token").agg(F.sum("b").alias("b"), F.sum("a").alias("a")), "tokens")
    sums = tokens.agg(F.sum("b"), F.sum("a"), F.count("*")).first()
    shares = kinds.agg(F.sum("b"), F.sum("a")).first()
    b, a, size = (float(x or 0) for x in sums)
    s = settings.smoothing
    weight = F.log((F.col("b") + s) / (b + s * size)) - F.log((F.col("a") + s) / (a + s * size)) if size else F.lit(0.0)
    prior = math.log((float(shares[0] or 0) + s) / (float(shares[1] or 0) + s))
    scores = kinds_of.join(tokens.select("token", weight.alias("w")), "token").groupBy("key").agg(F.sum("w").alias("w"))
    kinds = kinds.join(scores, "key", "left").select("names", "steps", (F.coalesce("w", F.lit(0.0)) + prior).alias("score"))
    found = longest_rule(F.col("host"), F.col("path"), settings.rules)
    told = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(kinds, ["names", "steps"]).withColumn("found", found).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", told).alias("verdict"), "score")
