"""Not-modified revisit records of web archives: each is resolved to the latest earlier full response of its url.

Method. Records are joined as of their time by canonical url. A revisit is resolved if a validator of its own agrees with
the response: entity tags by weak comparison if both have one, else the dates of last modification. Its header fields then
replace those of the response, except those that describe a message or its body.

A url may have any number of records. Records are cut into slices in order of url, time and id, so a slice is bounded
whatever the urls are; the last response is carried forward inside each slice, and from slice to slice by one row for each
url and slice. Bodies are not moved: a response is found by its id, and `with_body` joins bodies where they are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwarden.llm.store import tasks, written

# Fields of a not-modified answer that do not update the stored response (hop-by-hop fields, and fields of the body).
KEPT_FROM_RESPONSE = (
    "connection", "content-encoding", "content-length", "content-location", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)
# Query parameters that do not choose a page; a parameter of `canonical_url`.
TRACKING = ("fbclid", "gclid", "ref", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term")
# The profile of a revisit record whose server answered "not modified", in its versions.
NOT_MODIFIED = "/revisit/server-not-modified"
FULL, RESOLVED, NO_RESPONSE, NO_VALIDATOR, CHANGED, OTHER = "full", "resolved", "no response", "no validator", "changed", "other"


def canonical_url(url: Column, tracking: tuple[str, ...] = TRACKING) -> Column:
    """Without scheme, user, `www.`, default port, fragment, trailing slashes and tracking parameters; host in lower case,
    parameters in order. A text without `://` stays as it is; null stays null."""
    rest = F.regexp_replace(F.regexp_replace(url, "(?s)^.*?://", ""), "(?s)#.*$", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", ""), "^www\\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, "(?s)^[^/?]*([^?]*)", 1), "/+$", "")
    asked = F.filter(F.split(F.regexp_extract(rest, "(?s)\\?(.*)$", 1), "&"), lambda x: (x != "") & ~F.substring_index(x, "=", 1).isin(*tracking))
    query = F.concat_ws("&", F.array_sort(asked))
    return F.when(url.contains("://"), F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))).otherwise(url)


def header_fields(head: Column) -> Column:
    """The fields of a message head as a map from lower-case name to value; values of a repeated name are joined with commas.

    The first line is the status line. Lines without a colon are left out; a null head has no fields.
    """
    lines = F.filter(F.slice(F.split(head, "\r?\n"), 2, 1 << 30), lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("value")))
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
    values = F.transform(names, lambda n: F.concat_ws(", ", F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["value"])))
    return F.coalesce(F.map_from_arrays(names, values), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def merged(stored: Column, fresh: Column) -> Column:
    """The fields of a response after a not-modified answer."""
    permitted = F.map_filter(fresh, lambda name, _: ~name.isin(*KEPT_FROM_RESPONSE))
    rest = F.map_filter(stored, lambda name, _: ~F.map_contains_key(permitted, name))
    return F.map_concat(rest, permitted)


def head_text(fields: Column) -> Column:
    """Fields in order of their names, one a line."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(fields)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def latest_response(rows: DataFrame) -> DataFrame:
    """Each row with `earlier`, the response struct of the latest full response of its url before it, or null.

    Needs url, at, record_id and response (a struct, null for rows that are none). Rows without a url or time have none.
    """
    order = ["url", "at", "record_id"]
    placed = rows.filter("url is not null and at is not null")
    placed = placed.repartitionByRange(tasks(rows.sparkSession), *order).withColumn("slice", F.spark_partition_id())
    placed = written(placed, "slices")
    inside = Window.partitionBy("slice", "url").orderBy("at", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.filter("response is not null").groupBy("slice", "url").agg(F.max_by("response", F.struct("at", "record_id")).alias("last"))
    spans = placed.select("slice", "url").distinct().join(ends, ["slice", "url"], "left")
    before = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("slice", "url", F.last("last", ignorenulls=True).over(before).alias("carried"))
    found = placed.withColumn("near", F.last("response", ignorenulls=True).over(inside)).join(carried, ["slice", "url"])
    found = found.withColumn("earlier", F.coalesce("near", "carried")).drop("near", "carried", "slice")
    lost = rows.filter("url is null or at is null")
    return found.unionByName(lost.withColumn("earlier", F.lit(None).cast(found.schema["earlier"].dataType)))


def weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolved(records: DataFrame) -> DataFrame:
    """One row per record: record_id, url (canonical), state, response_id, digest, fields.

    `records` has record_id, type (`response` or `revisit`), profile, target_uri, at (time), status (of the answer), head
    and digest (of the body); other columns are ignored. States: `full` for responses with status 200, which are their own
    response; `resolved`; `no response` (none earlier, or no url or time); `no validator` (no kind of validator that both
    have); `changed` (they differ); `other` for all else. Only resolved revisits get the merged fields and the digest of the
    response; a record that is not resolved keeps its own. Earlier is by time, then by record_id, so a response at the same
    time with a smaller id counts. Repeated rows give a row each. An empty table gives an empty result.
    """
    full = F.coalesce((F.col("type") == "response") & (F.col("status") == 200), F.lit(False))
    asks = F.coalesce((F.col("type") == "revisit") & F.col("profile").endswith(NOT_MODIFIED), F.lit(False))
    rows = records.select(
        "record_id", canonical_url(F.col("target_uri")).alias("url"), "at", full.alias("full"), asks.alias("asks"), "digest",
        header_fields(F.col("head")).alias("fields"),
    )
    rows = rows.withColumn("response", F.when(F.col("full"), F.struct("record_id", "digest", "fields")))
    rows = latest_response(rows)
    tag, stored_tag = weak(F.get(F.map_values(F.map_filter("fields", lambda k, _: k == "etag")), 0)), weak(F.col("earlier.fields")["etag"])
    date, stored_date = F.col("fields")["last-modified"], F.col("earlier.fields")["last-modified"]
    agrees = F.when(tag.isNotNull() & stored_tag.isNotNull(), tag == stored_tag).when(date.isNotNull() & stored_date.isNotNull(), date == stored_date)
    state = F.when(F.col("full"), FULL).when(~F.col("asks"), OTHER).when(F.col("earlier").isNull(), NO_RESPONSE)
    state = state.when(agrees.isNull(), NO_VALIDATOR).when(agrees, RESOLVED).otherwise(CHANGED)
    rows = rows.withColumn("state", state)
    done = F.col("state") == RESOLVED
    return rows.select(
        "record_id", "url", "state", F.when(done, F.col("earlier.record_id")).when(F.col("full"), F.col("record_id")).alias("response_id"),
        F.when(done, F.col("earlier.digest")).otherwise(F.col("digest")).alias("digest"),
        F.when(done, merged(F.col("earlier.fields"), F.col("fields"))).otherwise(F.col("fields")).alias("fields"),
    )


def with_body(found: DataFrame, records: DataFrame) -> DataFrame:
    """Resolved rows with the body of their response. Many revisits may share one: each body is sent once for each."""
    bodies = records.select(F.col("record_id").alias("response_id"), "body")
    return found.join(bodies, "response_id", "left")
