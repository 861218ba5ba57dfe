from collections import defaultdict

import numpy as np

from pyspark.sql import functions as F

from txwarden.llm.packing import Settings, best_fit, near_clusters, packed

SCHEMA = "doc_id long, text string, source string, shard int, piece string"


def plain(lengths, sources, clusters, capacity):
    """Look at every bin; take the compatible one with the least room, the oldest among equals."""
    bins, out = [], []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        fits = [
            (b["room"], k) for k, b in enumerate(bins)
            if b["room"] >= length and (source is None or source not in b["sources"]) and (cluster is None or cluster not in b["clusters"])
        ]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        out.append((k, capacity - bins[k]["room"]))
        bins[k]["room"] -= length
        bins[k]["sources"].add(source)
        bins[k]["clusters"].add(cluster)
    return out


def test_best_fit_against_a_plain_search():
    draw = np.random.default_rng(1)
    for _ in range(40):
        n = int(draw.integers(0, 120))
        lengths = sorted(draw.integers(0, 100, n).tolist(), reverse=True)
        sources = [None if x == 0 else f"s{x}" for x in draw.choice(6, n, p=[0.1, 0.4, 0.2, 0.1, 0.1, 0.1]).tolist()]
        clusters = [None if x == 0 else x for x in draw.integers(0, 40, n).tolist()]
        assert list(zip(*best_fit(lengths, sources, clusters, 100), strict=True)) == plain(lengths, sources, clusters, 100)


def test_nothing_is_lost_and_no_bin_conflicts(spark):
    draw = np.random.default_rng(2)
    rows = [(i, "w " * int(draw.integers(1, 90)) + f"x{i % 150}", "hot" if i % 3 else f"s{i % 7}", 0, "") for i in range(600)]
    rows += [(1000, None, "a", 0, ""), (1001, "", None, 0, ""), (1002, "long " * 1234, None, 0, ""), (1003, "w x", None, 0, ""), (1003, "w x", None, 0, ""), (None, "y z", "b", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = packed(docs, Settings(capacity=100, shard=200)).collect()
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, r.n_words))
        bins[r.bin_id].append(r)
    for doc_id in {r[0] for r in rows}:
        texts = [r[1] for r in rows if r[0] == doc_id]
        assert sum(n for _, n in pieces[doc_id]) == sum(len((t or "").split()) for t in texts)
    assert len(pieces[1002]) == 13 and sorted(pieces[1002])[-1] == (1200, 34)
    source = {r[0]: r[2] for r in rows}
    text = {r[0]: r[1] for r in rows}
    for members in bins.values():
        ends = sorted((r.bin_start, r.bin_start + r.n_words) for r in members)
        assert ends[-1][1] <= 100 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:], strict=False))
        named = [source[r.doc_id] for r in members if source[r.doc_id]]
        assert len(named) == len(set(named))
        same = [text[r.doc_id] for r in members if text[r.doc_id] is not None]
        assert len(same) == len(set(same))
    assert packed(docs.limit(0)).collect() == []


def test_no_bin_holds_two_near_copies(spark):
    draw = np.random.default_rng(6)
    rows = []
    for group in range(12):
        words = [f"w{x}" for x in draw.integers(0, 100_000, 60)]
        for copy in range(8):  # each with another last word, some with other spaces, without a doc_id or with one that repeats
            text = ("  " if copy % 2 else " ").join([*words[:-1], f"z{copy}"])
            doc_id = {5: None, 6: 7777}.get(copy, group * 10 + copy)
            rows.append((doc_id, text, None, group, ""))
    rows += [(900 + i, f"É b{i % 2}", None, 90 + i % 2, "") for i in range(2)] + [(902, "é b0", None, 90, ""), (903, " ", None, 92, ""), (904, " ", None, 92, ""), (905, None, None, 93, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = {r.mark: r.cluster for r in near_clusters(docs).collect()}
    seen = defaultdict(set)
    for r in docs.selectExpr("xxhash64(doc_id, text) as mark", "shard as g", "text").filter("trim(text) <> ''").collect():
        seen[r.g].add(marks[r.mark])
    assert all(len(of) == 1 for of in seen.values()) and len(set.union(*seen.values())) == len(seen)
    # One shard: the number of bins shows how many copies were kept apart, as all texts of a bin are of other groups.
    got = packed(docs, Settings(capacity=10_000), clusters=near_clusters(docs)).collect()
    assert len(got) == len(rows)
    bins = defaultdict(list)
    for r in got:
        bins[r.bin_id].append(r)
    assert len(bins) == 8
    groups = {r[0]: r[3] for r in rows}
    for members in bins.values():
        named = [groups[r.doc_id] for r in members if r.doc_id not in (None, 7777)]
        assert len(named) == len(set(named)) and sum(r.n_words == 60 for r in members) == 12


def test_rows_without_ids_spread_over_shards(spark):
    docs = spark.range(20_000).selectExpr("cast(null as long) as doc_id", "'one two three' as text", "cast(null as string) as source").repartition(5)
    got = packed(docs, cluster=F.lit(None).cast("long"))
    sizes = [r["count"] for r in got.groupBy(F.shiftright("bin_id", 32)).count().collect()]
    assert len(sizes) == 14 and max(sizes) < 2000 and sum(sizes) == 20_000
