import numpy as np
import pytest
from pyspark.sql import functions as F

from txwarden.operators.sketches import RANK_ERROR, latency_of_sketches, step_sketches
from txwarden.operators.sla import limit_checks
from txwarden.streaming.alerts import run_available
from txwarden.streaming.rates import latest_rows, latest_writer


@pytest.fixture(scope="module")
def requests(spark):
    rng = np.random.default_rng(4)
    rows = [(1_700_000_000 + i // 40, float(x), bool(i % 50 == 0), "ab"[i % 2]) for i, x in enumerate(rng.lognormal(3, 1, 40_000))]
    rows += [(1_700_000_000, None, False, "a"), (1_700_000_000, float("nan"), True, "b"), (None, 1.0, True, "a"), (1_700_000_000, None, False, "none")]
    return spark.createDataFrame(rows, "t long, ms double, bad boolean, host string").withColumn("ts", F.col("t").cast("timestamp")).cache()


def check(report, requests):
    for r in report.collect():
        own = np.sort([x.ms for x in requests.where((F.col("host") == r["host"]) & F.col("t").isNotNull() & (F.col("ms") > 0) & ~F.isnan("ms")).collect()])
        if not len(own):
            assert (r["p95_ms"], r["mean_ms"], r["requests"]) == (None, None, 1)
            continue
        for p, got in ((0.95, r["p95_ms"]), (0.99, r["p99_ms"])):
            assert abs(np.searchsorted(own, got, "right") / len(own) - p) <= 3 * RANK_ERROR
        assert r["mean_ms"] == pytest.approx(own.mean()) and r["requests"] == len(own) + 1


def test_steps_merge_to_the_whole(spark, requests):
    steps = step_sketches(requests, "ts", "ms", "bad", ["host"])
    assert steps.where("host = 'a'").count() == 17  # 22:13:20 to 22:29:59
    check(latency_of_sketches(steps, ["host"]), requests)
    largest = steps.agg(F.max(F.length("sketch"))).first()[0]
    day = latency_of_sketches(steps)
    assert largest < 40_000 and day.first()["requests"] == 40_003 and day.first()["error_rate"] == pytest.approx(801 / 40_003)
    assert {r["check"] for r in limit_checks(day).collect()} == {"p95_ms", "p99_ms", "mean_ms", "error_rate", "check_rate"}


def test_a_stream_of_files(spark, requests, tmp_path):
    requests.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    steps = step_sketches(stream, "ts", "ms", "bad", ["host"], late="1 day")
    run_available(latest_writer(steps, str(tmp_path / "o"), str(tmp_path / "c")))
    check(latency_of_sketches(latest_rows(spark.read.parquet(str(tmp_path / "o")), ["slice", "host"]), ["host"]), requests)
