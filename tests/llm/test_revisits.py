import datetime
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from txwarden.llm.archive import captures
from txwarden.llm.revisits import KEPT_FROM_RESPONSE, TRACKING, canonical_url, header_fields, resolved, with_body

PROFILE = "http://netpreserve.org/warc/1.1/revisit/server-not-modified"
SCHEMA = "record_id long, type string, profile string, target_uri string, at timestamp, status int, head string, digest string, body string, url string, slice int"


@pytest.mark.parametrize(("url", "want"), [
    ("http://A.com", "a.com"), ("https://www.A.com:443/x/", "a.com/x"), ("http://u:p@a.com:8080/X?b=2&a=1&utm_source=f#t", "a.com:8080/X?a=1&b=2"),
    ("http://a.com/?ref=x", "a.com"), ("http://a.com?&", "a.com"), ("a.com/x", "a.com/x"), ("", ""), (None, None), ("http://a.com/x//?q", "a.com/x?q"),
])
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(canonical_url(F.col("u"))).first()[0] == want


def fields(head):
    out = {}
    for line in re.split("\r?\n", head or "")[1:]:
        if ":" in line:
            name, value = line.split(":", 1)
            name, value = name.strip(" ").lower(), value.strip(" ")
            out[name] = f"{out[name]}, {value}" if name in out else value
    return out


def test_header_fields(spark):
    heads = ["HTTP/1.1 200 OK\r\nA: 1\r\nb:2\r\na: x:y\r\nnothing\r\n\r\n", None, "", "HTTP/1.1 304\nETag: W/\"q\""]
    df = spark.createDataFrame([(h,) for h in heads], "h string")
    assert [r[0] for r in df.select(header_fields(F.col("h"))).collect()] == [fields(h) for h in heads]


def by_hand(rows, canonical):
    out = []
    for r in rows:
        record_id, type_, profile, uri, at, status, head, digest = r[:8]
        own, url = fields(head), canonical[uri]
        if type_ == "response" and status == 200:
            out.append((record_id, "full", record_id, digest, own))
            continue
        if type_ != "revisit" or not (profile or "").endswith("/revisit/server-not-modified"):
            out.append((record_id, "other", None, digest, own))
            continue
        earlier = [x for x in rows if x[1] == "response" and x[5] == 200 and url is not None and at is not None and x[4] is not None and canonical[x[3]] == url and (x[4], x[0]) < (at, record_id)]
        if not earlier:
            out.append((record_id, "no response", None, digest, own))
            continue
        last = max(earlier, key=lambda x: (x[4], x[0]))
        stored = fields(last[6])
        if "etag" in own and "etag" in stored:
            agrees = own["etag"].removeprefix("W/") == stored["etag"].removeprefix("W/")
        elif "last-modified" in own and "last-modified" in stored:
            agrees = own["last-modified"] == stored["last-modified"]
        else:
            out.append((record_id, "no validator", None, digest, own))
            continue
        if agrees:
            out.append((record_id, "resolved", last[0], last[7], stored | {k: v for k, v in own.items() if k not in KEPT_FROM_RESPONSE}))
        else:
            out.append((record_id, "changed", None, digest, own))
    return sorted(out, key=lambda x: x[0])


def test_against_plain_python(spark):
    draw = np.random.default_rng(0)
    rows = []
    start = datetime.datetime(2024, 1, 1)
    for i in range(500):
        hot = draw.random() < 0.5
        uri = "http://hot.com/" if hot else f"http{'s' if draw.random() < 0.5 else ''}://www.s{int(draw.integers(0, 40))}.com/p?{TRACKING[0]}=1"
        at = None if i % 61 == 0 else start + datetime.timedelta(seconds=int(draw.integers(0, 200)))
        kind = draw.choice(["response", "revisit", "revisit", "request"])
        tag, date = f'"{int(draw.integers(0, 3))}"', f"d{int(draw.integers(0, 2))}"
        lines = [x for x in (f"ETag: {'W/' if kind == 'revisit' else ''}{tag}", f"Last-Modified: {date}", "Cache-Control: a", "Cache-Control: b", f"X-Id: {i}", "Content-Length: 3") if draw.random() < 0.7]
        head = None if i % 83 == 0 else "\r\n".join(["HTTP/1.1 200 OK", *lines])
        rows.append((i, str(kind), PROFILE if kind == "revisit" and i % 17 else None, None if i % 71 == 0 else uri, at, 200 if i % 13 else 404, head, f"g{i}", "b" * (i % 5), "clash", 1))
    df = spark.createDataFrame(rows, SCHEMA)
    canonical = {r.target_uri: r.c for r in df.select("target_uri", canonical_url(F.col("target_uri")).alias("c")).collect()}
    got = resolved(df)
    found = sorted(((r.record_id, r.state, r.response_id, r.digest, r.fields) for r in got.collect()), key=lambda x: x[0])
    assert found == by_hand(rows, canonical)
    assert {x[1] for x in found} == {"full", "other", "resolved", "changed", "no response", "no validator"}
    bodies = {r[0]: r[8] for r in rows}
    for r in with_body(got, df).filter("state = 'resolved'").collect():
        assert r.body == bodies[r.response_id]
    assert resolved(df.limit(0)).collect() == []
    assert resolved(df.union(df)).count() == 2 * len(rows)


def test_pages_as_records(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "<p>", 1), (2, "https://b.com", "é", 1), (3, None, None, 1), (4, "https://a.com/x?q=1", None, 1)], "page_id long, url string, html string, at int")
    got = {r.record_id: r for r in resolved(captures(pages)).collect()}
    assert {k: r.state for k, r in got.items()} == {2: "full", 3: "resolved", 4: "full", 5: "resolved", 6: "full", 7: "no response", 8: "full", 9: "no validator"}
    assert got[3].fields["cache-control"] == "max-age=120" and got[3].fields["content-type"] == "text/html" and got[3].response_id == 2
    assert got[5].fields["etag"].startswith("W/") and got[4].fields["content-length"] == "2"
