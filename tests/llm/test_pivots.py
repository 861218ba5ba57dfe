import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from txwarden.llm.pivots import NONE, Index, Settings, Walk, choose_pivots, top_scores

SCHEMA = "vec_id long, embedding array<float>, pivot string, rank int"


def by_hand(rows, divisor, k=20):
    usable = [(i, [math.floor(64 * float(x)) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in dict((i, v) for i, v in usable if i % divisor == 0).items():
        scores = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i) for i, y in usable if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def compare(spark, rows, divisor, settings=Settings()):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    stored = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted(tuple(r) for r in top_scores(df, F.col("vec_id") % divisor == 0, settings).collect())
    assert got == by_hand(stored, divisor, settings.k)


def test_clusters_ties_and_odd_rows(spark):
    draw = np.random.default_rng(0)
    centres = draw.normal(0, 1, (6, 16))
    rows = [(i, (centres[i % 6] + draw.normal(0, 0.2, 16)).tolist()) for i in range(700)]
    rows += [(1000 + i, [0.5] * 16) for i in range(400)]  # a hot vector
    rows += [(2000, None), (2020, [float("nan")] * 16), (2040, [1.0, None] + [0.0] * 14), (2060, [float("inf")] * 16), (None, [1.0] * 16), (2080, []), (2100, [3.0] * 9)]
    compare(spark, rows, 20, Settings(sample=200, pivots=8, rows=32, queries=16, lane=4))


def test_fewer_rows_than_asked(spark):
    compare(spark, [(0, [1.0, 2.0]), (20, [-1.0, 0.5]), (3, [0.0, 0.0])], 20)
    compare(spark, [(0, [1.0, 2.0])], 20)
    empty = spark.createDataFrame([], SCHEMA)
    assert top_scores(empty, F.col("vec_id") % 20 == 0).collect() == []


def test_large_norms_are_exact(spark):
    draw = np.random.default_rng(1)
    # Squared norms of up to 2^60: neighbouring scores differ by less than double precision tells apart.
    rows = [(i, np.float32(draw.normal(0, 2.0**21, 16)).tolist()) for i in range(300)]
    rows += [(1000 + i, [2.0**23 + 2.0 * i, 1 / 64 * (i % 3)] + [0.0] * 14) for i in range(40)]
    compare(spark, rows, 20, Settings(sample=50, pivots=4, rows=16, queries=8, lane=4))
    for size in (127 / 64, 2.0, -2.0, -129 / 64, 512.0, 2.0**25, 2.0**21):  # each width of components, and its edges
        compare(spark, [(i, [size, (i % 7) / 64]) for i in range(45)], 20, Settings(sample=20, pivots=3, rows=8, queries=2))
    with pytest.raises(ValueError, match="may not fit"):
        top_scores(spark.createDataFrame([(0, [1e12], "", 1)], SCHEMA), F.col("vec_id") % 20 == 0)


def test_a_walk_ends_at_the_first_bound_beyond_all_queries():
    index = Index(1, 100.0, "i1", np.array([[0.0, 10.0]]), np.zeros(0, np.int64), np.zeros((0, 1), np.int64))
    walk = Walk(np.array([1, 2]), np.array([[1], [2]]), np.full(2, NONE), index, 1)
    assert not walk.ends(1e9)  # nothing found yet
    walk.meet(0, 0.0, 1.0, np.array([7]), np.array([[10]]))
    far = math.sqrt(4 + 100 - 2 * 20), math.sqrt(1 + 100 - 2 * 10)
    assert not walk.ends(max(far)) and walk.ends(max(far) + 0.1) and walk.ends(0.0)
    assert walk.result().to_pydict() == {"query_id": [1, 2], "vec_id": [7, 7], "score": [10, 20]}


def test_pivots_lie_apart():
    points = np.array([[0.0, 0], [0.1, 0], [10, 0], [0, 9], [0, 9]])
    assert choose_pivots(points, 3).tolist() == [[0, 0], [10, 0], [0, 9]]
    assert len(choose_pivots(np.zeros((4, 2)), 3)) == 1
