"""Latency percentiles from quantile sketches that are stored and merged, on tables and streams.

Each step of time and group keeps a KLL sketch of its latencies beside sums. Sketches of any steps merge into one of the
same size, so an hour's or a day's percentiles are read off stored steps without the requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.functions.expressions import ratio
from txwarden.streaming.rates import STEP, with_instant

# Size of a sketch, and the error of a rank that it keeps with 99 % certainty, merged or not, by the sketch's published bounds.
SIZE, RANK_ERROR = 1000, 0.0033


def step_sketches(df: DataFrame, time: str, latency: str, failed: str, by: Sequence[str] = (), step: str = STEP, late: str | None = None,
                  size: int = SIZE) -> DataFrame:
    """For each step and group the requests, failed ones, summed latency and sketch. `late` is the watermark of a stream, which is
    written in update mode and read by its newest rows. Rows without a time belong to no step; a missing latency counts as a
    request but not in the sketch or the mean."""
    rows = with_instant(df, time).where(F.col(time).isNotNull())
    if late:
        rows = rows.withWatermark(time, late)
    value = F.nanvl(F.col(latency).cast("double"), F.lit(None))
    sums = rows.withColumn("_v", value).groupBy(F.window(time, step), *by).agg(
        F.count("*").alias("requests"), F.count("_v").alias("timed"), F.count_if(F.col(failed)).alias("failures"),
        F.coalesce(F.sum("_v"), F.lit(0.0)).alias("total_ms"), F.kll_sketch_agg_double("_v", size).alias("sketch"))
    return sums.select(F.col("window.start").alias("slice"), *by, "requests", "timed", "failures", "total_ms", "sketch")


def latency_of_sketches(sketches: DataFrame, by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """p95, p99, mean and error rate of each group over all steps given, in the layout of `latency_report`."""
    merged = sketches.groupBy(*by).agg(
        F.sum("requests").alias("requests"), F.sum("timed").alias("timed"), F.sum("failures").alias("failures"), F.sum("total_ms").alias("total_ms"),
        F.kll_merge_agg_double("sketch", size).alias("sketch"))
    at = lambda p: F.when(F.col("timed") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p)))
    rate = ratio(F.col("failures"), F.col("requests"), None)
    return merged.select(
        *by, "requests", at(0.95).alias("p95_ms"), at(0.99).alias("p99_ms"), ratio(F.col("total_ms"), F.col("timed"), None).alias("mean_ms"),
        rate.alias("error_rate"), (1 - rate).alias("check_rate"))
