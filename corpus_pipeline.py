"""Corpus pipeline: quality rules, language, near duplicates, packing. Each stage reads what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwarden.llm.catalog import prepare
from txwarden.llm.langid import languages, learned
from txwarden.llm.minhash import Settings as Near
from txwarden.llm.minhash import near_duplicates
from txwarden.llm.packing import packed
from txwarden.llm.quality import judged
from txwarden.llm.store import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Near copies of a stage: five-word shingles, 0.8 or more. A pair at 0.8 is missed by 39 bands of 5 minima with probability
# (1 - 0.8^5)^39 = 1.9e-7, and fewer than 0.65 of its 195 minima agree with probability 1.8e-7.
NEAR = Near(words=5, percent=80, bands=39, rows=5, agree=0.65)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep. A row is known by its doc_id and the hash of its text; nulls are equal."""
    prepare(spark)
    docs = docs.select(COLUMNS)
    mark = F.xxhash64("text").alias("mark")
    verdicts = judged(docs.select("*", mark), table(spark, sf_dir, "labels"), keep=("mark",))
    kept = verdicts.filter("kept").select(F.col("doc_id").alias("id"), F.col("mark").alias("m"))
    rows = docs.select("*", mark)
    return rows.join(kept, rows["doc_id"].eqNullSafe(kept["id"]) & (rows["mark"] == kept["m"]), "left_semi").select(COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is told with a score above the calibrated cutoff. The model is fitted on this stage's input."""
    prepare(spark)
    docs = docs.select(COLUMNS)
    told = languages(docs, learned(docs), keep=tuple(COLUMNS))
    return told.filter("accepted").select(*[F.col(f"kept_{c}").alias(c) for c in COLUMNS])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id, those without one last, ties by the hash
    of doc_id and text. A document is a doc_id with its text: other texts of one doc_id are documents of their own, and so are
    texts without a doc_id. Of rows with the same doc_id and text the one with the smallest hash of all columns stays, once."""
    prepare(spark)
    docs = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("mark"))
    found = written(near_duplicates(docs.select(F.col("mark").alias("doc_id"), "text"), NEAR).select("doc_id", "component_id").distinct(), "groups")
    ids = docs.groupBy("mark", "doc_id").agg(F.min(F.xxhash64(*COLUMNS)).alias("row"))
    placed = ids.join(found.withColumnRenamed("doc_id", "mark"), "mark")
    first = placed.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark", "row")).alias("first"))
    stay = first.select("first.mark", "first.row")
    rows = docs.withColumn("row", F.xxhash64(*COLUMNS)).join(stay, ["mark", "row"], "left_semi")
    return rows.select(COLUMNS).dropDuplicates()


def bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their bins."""
    prepare(spark)
    return packed(docs)


STAGES = [("quality rules", quality), ("language", language), ("near copies", near_copies), ("packing", bins)]
# Neither a fitted language model nor packing in order can be said in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces and bins of what the stages keep of `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
