"""Registered queries of the training-data operators, and the same in SQL where SQL can say it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import txwarden
from txwarden.llm.alignment import aligned
from txwarden.llm.archive import captures
from txwarden.llm.automaton import encoded
from txwarden.llm.bitpack import token_files
from txwarden.llm.hosts import judged_urls
from txwarden.llm.langid import languages, learned
from txwarden.llm.minhash import near_duplicates
from txwarden.llm.packing import near_clusters, packed
from txwarden.llm.pivots import top_scores
from txwarden.llm.prefixes import conversation_trie
from txwarden.llm.pseudo import pseudo_likelihood
from txwarden.llm.quality import judged
from txwarden.llm.revisits import head_text, resolved
from txwarden.llm.store import table
from txwarden.llm.substrings import without_repeats
from txwarden.session import name_local_scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_sent: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, and name a shared folder where a local session has none."""
    name_local_scratch(spark)
    name = spark.sparkContext.applicationId
    if name in _sent:
        return
    _sent.add(name)
    top = os.path.dirname(os.path.abspath(txwarden.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="txwarden-"), "txwarden.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(top):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.join("txwarden", os.path.relpath(path, top)))
    spark.sparkContext.addPyFile(archive)


def query(sql: str | None = None):
    """Register a function under its own name."""

    def add(run: Query) -> Query:
        @wraps(run)
        def ready(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return run(spark, folder)

        QUERIES[run.__name__] = ready
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return add


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A tokenizer file of the box; elsewhere the operators take any such file as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query(r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, to_timestamp(1704067200 + page_id) AT TIME ZONE 'UTC' AS t0,
         to_timestamp(1704067200 + page_id + 100000) AT TIME ZONE 'UTC' AS later FROM pages),
q AS (
  SELECT *, strftime(to_timestamp(1704067200 + page_id - length(html)) AT TIME ZONE 'UTC', '%a, %d %b %Y %H:%M:%S GMT') AS changed,
         '"' || md5(html) || '"' AS tag, regexp_replace(regexp_replace(url, '^.*?://', '', 's'), '#.*$', '', 's') AS rest FROM p),
parts AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www\.', '') AS host,
         regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1, 's'), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1, 's'), '&'), lambda x: x <> '' AND
           split_part(x, '=', 1) NOT IN ('fbclid', 'gclid', 'ref', 'utm_campaign', 'utm_content', 'utm_medium', 'utm_source', 'utm_term'))), '&') AS query FROM q),
c AS (
  SELECT *, CASE WHEN contains(url, '://') THEN host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END ELSE url END AS canon,
         CASE WHEN contains(url, '?') THEN 0 WHEN starts_with(url, 'https://') THEN 1 ELSE 2 END AS kind FROM parts),
r AS (
  SELECT 2 * page_id AS record_id, canon AS url, t0 AS moment, true AS whole, kind, tag, changed, html, strlen(html) AS size, later FROM c
  UNION ALL SELECT 2 * page_id + 1, canon, later, false, kind, tag, changed, html, strlen(html), later FROM c),
w AS (
  SELECT *, last_value(CASE WHEN whole THEN {'record_id': record_id, 'tag': tag, 'changed': changed, 'digest': sha1(html), 'size': size} END IGNORE NULLS)
    OVER (PARTITION BY url ORDER BY moment, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM r),
s AS (
  SELECT *, strftime(later, '%a, %d %b %Y %H:%M:%S GMT') AS date, chr(10) AS nl, CASE WHEN whole THEN 'full' WHEN url IS NULL OR e IS NULL THEN 'no response' WHEN kind = 0 THEN 'no validator'
    WHEN (kind = 1 AND tag = e.tag) OR (kind = 2 AND changed = e.changed) THEN 'resolved' ELSE 'changed' END AS state FROM w)
SELECT record_id, url, state, CASE state WHEN 'full' THEN record_id WHEN 'resolved' THEN e.record_id END AS response_id,
  CASE state WHEN 'full' THEN sha1(html) WHEN 'resolved' THEN e.digest END AS digest,
  CASE WHEN state = 'full' THEN concat('cache-control: max-age=60', nl, 'content-length: ', size, nl, 'content-type: text/html', nl, 'etag: ', tag, nl, 'last-modified: ', changed)
    WHEN state = 'resolved' THEN concat('cache-control: max-age=120', nl, 'content-length: ', e.size, nl, 'content-type: text/html', nl, 'date: ', date, nl,
      'etag: ', CASE WHEN kind = 1 THEN 'W/' || tag ELSE e.tag END, nl, 'last-modified: ', e.changed)
    ELSE concat('cache-control: max-age=120', nl, 'connection: close', nl, 'content-type: text/plain', nl, 'date: ', date,
      CASE kind WHEN 1 THEN nl || 'etag: W/' || tag WHEN 2 THEN nl || 'last-modified: ' || changed ELSE '' END) END AS head
FROM s
""")
def op1_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = resolved(captures(table(spark, folder, "pages")))
    return found.withColumn("head", head_text(F.col("fields"))).drop("fields")


@query()
def op2_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood(table(spark, folder, "documents"))


@query()
def op3_tokenization_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(table(spark, folder, "documents"), vocabulary())


@query()
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return languages(docs, learned(docs))


@query()
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files(table(spark, folder, "documents"), vocabulary())


@query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""")
def op6_top_scores(spark: SparkSession, folder: str) -> DataFrame:
    return top_scores(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op7_host_words(spark: SparkSession, folder: str) -> DataFrame:
    return judged_urls(table(spark, folder, "pages"))


@query()
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packed(docs, clusters=near_clusters(docs))


@query()
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query()
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(table(spark, folder, "conversations"))


@query(r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(words) - 48)) AS i, words FROM d WHERE len(words) >= 50),
h AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(words[i:i + 49], ' ')) AS least FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM h WHERE least < doc_id),
e AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM e ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)
""")
def op12_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents"))


@query()
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return aligned(table(spark, folder, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))
