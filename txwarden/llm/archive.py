"""Pages as records of a web archive: each is captured once, and later asked for again with a "not modified" answer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = 1_704_067_200  # 2024-01-01 00:00:00 UTC
LATER = 100_000  # seconds between a capture and the question for the same page
HTTP_DATE = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"


def captures(pages: DataFrame) -> DataFrame:
    """Two records for each page: 2 page_id, its response, and 2 page_id + 1, a not-modified revisit of the same page.

    The revisit comes by https and with a fragment. It has an entity tag if the page came by https, only a date of last
    modification if it came by http, and neither if its url has a query.
    """
    url, html = F.col("url"), F.coalesce("html", F.lit(""))
    first = F.lit(START) + F.col("page_id")
    changed = F.date_format(F.timestamp_seconds(first - F.length(html)), HTTP_DATE)
    line = lambda *x: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in x], F.lit("\r\n"))
    tag = F.concat(F.lit('"'), F.md5(html), F.lit('"'))
    response = F.concat(
        F.lit("HTTP/1.1 200 OK\r\n"), line("Content-Type: text/html"), line("Content-Length: ", F.octet_length(html).cast("string")),
        line("ETag: ", tag), line("Last-Modified: ", changed), line("Cache-Control: max-age=60"),
    )
    validator = F.when(url.contains("?"), F.lit("")).when(url.startswith("https://"), line("ETag: W/", tag)).otherwise(line("Last-Modified: ", changed))
    answer = F.concat(
        F.lit("HTTP/1.1 304 Not Modified\r\n"), line("Date: ", F.date_format(F.timestamp_seconds(first + LATER), HTTP_DATE)), validator,
        line("Cache-Control: max-age=120"), line("Content-Type: text/plain"), line("Connection: close"),
    )
    none = F.lit(None).cast("string")
    record = lambda record_id, type_, profile, uri, at, status, head, digest, body: F.struct(
        record_id.alias("record_id"), F.lit(type_).alias("type"), profile.alias("profile"), uri.alias("target_uri"),
        F.timestamp_seconds(at).alias("at"), F.lit(status).alias("status"), head.alias("head"), digest.alias("digest"), body.alias("body"))
    two = F.col("page_id") * 2
    again = F.concat(F.regexp_replace(url, "^http:", "https:"), F.when(url.contains("#"), F.lit("")).otherwise(F.lit("#again")))
    both = F.array(
        record(two, "response", none, url, first, 200, response, F.sha1(html.cast("binary")), F.col("html")),
        record(two + 1, "revisit", F.lit("http://netpreserve.org/warc/1.1/revisit/server-not-modified"), again, first + LATER, 304, F.coalesce(answer, F.lit("")), none, none),
    )
    return pages.select(F.explode(both).alias("r")).select("r.*")
