"""Sliced computations equal plain windows, and slices stay small under skew."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from txwarden.plans import ordered
from txwarden.plans.ordered import SLICE, column_quantiles, quantiles, slice_rows, walk


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def naive(df, order, by, descending):
    keys = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    w = Window.partitionBy(*by).orderBy(*keys)
    return df.select(
        "*", F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
        F.sum("x").over(Window.partitionBy(*by)).alias("all"), F.lead("x").over(w).alias("nx"), F.lead("t").over(w).alias("nt"),
    )


def skewed(spark, n=4000, seed=3):
    """A third of the rows in one series, and a third at one time."""
    rng = random.Random(seed)
    data = [
        (i, "hot" if i % 3 == 0 else f"u{rng.randrange(200)}", 50.0 if rng.random() < 0.33 else round(rng.random() * 100, 2),
         rng.randrange(1, 9))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "id bigint, u string, t double, x bigint").repartition(8, "id")


@pytest.mark.parametrize("by", [[], ["u"]])
@pytest.mark.parametrize("descending", [False, True])
def test_walk_equals_window(spark, by, descending):
    df = skewed(spark)
    mine = walk(df, ["t", "id"], by, totals={"run": "x"}, overall={"all": "x"}, ahead={"nx": "x", "nt": "t"},
                descending=descending, rows_per_slice=150)
    columns = ("id", "run", "all", "nx", "nt")
    key = lambda rows: sorted(rows, key=lambda r: r[0])
    want = naive(df, ["t", "id"], by, descending)
    assert key(map(tuple, mine.select(*columns).collect())) == key(map(tuple, want.select(*columns).collect()))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_rows_in_order_of_time(spark, kind):
    """Times without a zone lie two minutes apart over a day on which the session's zone skips an hour; a third are one time, some null."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start, step = F.lit("2024-03-09 22:00:00.000001").cast(kind), F.expr("make_dt_interval(0, 0, 2 * CAST(id AS INT))" if kind != "date" else "CAST(id / 10 AS INT)")
        at = F.when(F.col("id") % 50 != 0, F.when(F.col("id") % 3 == 0, start).otherwise(start + step))
        df = spark.range(1200).select("id", at.alias("t"), (F.col("id") % 7 + 1).alias("x")).repartition(5, "id")
        sliced, several = slice_rows(df, ["t", "id"], rows_per_slice=150)
        sizes = [r["count"] for r in sliced.groupBy(SLICE).count().collect()]
        assert several and len(sizes) >= 4 and max(sizes) < 600
        mine = walk(df, ["t", "id"], totals={"run": "x"}, overall={"all": "x"}, ahead={"nx": "x", "nt": "t"}, rows_per_slice=150)
        columns = ("id", "run", "all", "nx", "nt")
        key = lambda d: sorted(map(tuple, d.select(*columns).collect()), key=lambda r: r[0])
        assert key(mine) == key(naive(df, ["t", "id"], [], False))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("hot", [None, "hot"])
def test_null_series_are_series_of_their_own(spark, hot):
    df = skewed(spark).withColumn("u", F.when(F.col("u") != "hot", F.col("u")).otherwise(F.lit(hot)))
    df = df.withColumn("u", F.when(F.col("id") % 50 != 1, F.col("u"))).withColumn("k", F.col("id") % 2)
    mine = walk(df, ["t", "id"], ["u", "k"], totals={"run": "x"}, overall={"all": "x"}, ahead={"nx": "x", "nt": "t"}, rows_per_slice=150)
    want = naive(df, ["t", "id"], ["u", "k"], False)
    columns = ("id", "u", "k", "run", "all", "nx", "nt")
    key = lambda d: sorted(map(tuple, d.select(*columns).collect()), key=lambda r: r[0])
    assert key(mine) == key(want)


def test_walk_shuffles_large_side_once(spark):
    """The join of the carry uses the window's partitioning: one exchange over the rows."""
    df = skewed(spark)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = walk(df, ["t", "id"], ["u"], ahead={"nt": "t"}, rows_per_slice=150)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    rows_side = plan.split("SortMergeJoin")[1].split("Filter (_slices")[0]
    window = rows_side.split("Window [lead")[0]
    assert "Exchange" not in window


def test_walk_ahead_on_order_column_only(spark):
    df = skewed(spark)
    mine = walk(df, ["t", "id"], ["u"], ahead={"nt": "t"}, rows_per_slice=150)
    want = naive(df, ["t", "id"], ["u"], False)
    key = lambda d: sorted(((r["id"], r["nt"]) for r in d.collect()))
    assert [a for a in key(mine.fillna(-1.0, ["nt"]))] == [a for a in key(want.fillna(-1.0, ["nt"]))]


def test_null_and_extreme_keys_keep_their_place(spark):
    data = [(i, None if i % 7 == 0 else float("inf") if i % 11 == 0 else float("-inf") if i % 13 == 0 else float(i), 1)
            for i in range(1000)]
    df = spark.createDataFrame(data, "id bigint, t double, x bigint")
    mine = walk(df, ["t", "id"], totals={"run": "x"}, rows_per_slice=50)
    want = naive(df.withColumn("u", F.lit(0)), ["t", "id"], [], False)
    assert rows_of(mine, "id", "run") == rows_of(want, "id", "run")


@pytest.mark.parametrize("by", [[], ["u"]])
def test_slices_are_bounded_under_skew(spark, by):
    df = skewed(spark, 20_000)
    parts, several = slice_rows(df, ["t", "id"], by, rows_per_slice=1000)
    assert several
    largest = parts.groupBy(*by, SLICE).count().agg(F.max("count")).first()[0]
    assert largest < 4000  # the hot series and the hot time hold about 6,600 rows each


def test_hot_first_key_without_second_stays_whole(spark):
    df = spark.range(3000).select(F.lit(5.0).alias("t"), F.col("id"))
    parts, several = slice_rows(df, ["t"], rows_per_slice=100)
    assert parts.select(SLICE).distinct().count() == 1


@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60), st.floats(0, 1))
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_quantiles_interpolate(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quantiles(df, "v", [p, 0.5])[0]["q"]
    assert got == pytest.approx([np.quantile(values, p), np.median(values)], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("slicing", [{}, {"rows_per_slice": 100}])
def test_narrowed_quantiles_are_exact(spark, slicing):
    rng = np.random.default_rng(5)
    data = [("a", float(v)) for v in rng.lognormal(3, 2, 5000)] + [("b", float(v)) for v in rng.integers(0, 4, 3000)]
    data += [("c", 1.0), ("c", None), ("d", None)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = {r["g"]: r["q"] for r in quantiles(df, "v", probs, ["g"], accuracy=50, **slicing)}
    assert set(got) == {"a", "b", "c"}
    for g in "abc":
        values = [v for k, v in data if k == g and v is not None]
        assert got[g] == pytest.approx(list(np.quantile(values, probs)))


def test_a_missed_bracket_falls_back_to_the_whole_group(spark, monkeypatch):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "v double")

    def far_off(*_args):
        return F.array(F.max("_v"), F.max("_v"))  # a bracket that cannot hold the median

    monkeypatch.setattr(ordered.F, "percentile_approx", far_off)
    assert quantiles(df, "v", [0.5])[0]["q"] == [49.5]


def test_quantiles_of_nothing(spark):
    assert quantiles(spark.createDataFrame([], "v double"), "v", [0.5]) == []


@pytest.mark.parametrize("n", [1, 1000, 1001, 300_000])
def test_one_method_at_every_size(spark, n):
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("v"), (F.col("id") % 2).alias("g"))
    assert quantiles(df, "v", [0.5, 0.9])[0]["q"] == pytest.approx([(n - 1) * 0.5, (n - 1) * 0.9])
    assert column_quantiles(df, ["v", "g"], [0.5])["v"] == pytest.approx([(n - 1) * 0.5])


def test_columns_side_by_side(spark):
    rng = np.random.default_rng(6)
    data = [(float(a), int(b), None, float("nan") if i % 3 else float(i)) for i, (a, b) in enumerate(zip(rng.lognormal(3, 2, 3000), rng.integers(0, 4, 3000)))]
    df = spark.createDataFrame(data, "a double, b int, c double, d double")
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = column_quantiles(df, ["a", "b", "c", "d"], probs, accuracy=50)
    assert set(got) == {"a", "b", "d"}
    for k, c in ((0, "a"), (1, "b"), (3, "d")):
        values = [r[k] for r in data if r[k] == r[k]]
        assert got[c] == pytest.approx(list(np.quantile(values, probs)))
