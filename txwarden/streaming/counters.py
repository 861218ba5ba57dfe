"""Rate of a counter that may restart: increase over a sliding range, resets added back, carried on to the ends of the range.

Samples are first reduced to one summary for each series and step, from which every range is put together: first and last
sample, how many there are, and what resets took away between them. Two neighbouring summaries add the reset between them. On a
stream the samples of a step are the state, which closes behind the watermark, so neither batches nor files cut a series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwarden.streaming.rates import RANGE, STEP, with_instant

# Fixed: a gap of up to so many mean gaps counts as covered up to the end of the range; beyond it half a mean gap does.
NEAR_END = 1.1


def step_summaries(df: DataFrame, time: str, value: str, by: Sequence[str] = (), step: str = STEP, late: str | None = None) -> DataFrame:
    """For each series and step: n samples, the first and the last (microseconds and value), and what resets took away.

    Samples without a time or a finite value do not count, repeated ones count once. `late` is the watermark of a stream, which
    is to be written in update mode and read by its newest rows.
    """
    number = F.col(value).cast("double")
    rows = with_instant(df, time).where(F.col(time).isNotNull() & number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))))
    if late:
        rows = rows.withWatermark(time, late)
    sample = F.struct(F.unix_micros(time).alias("t"), number.alias("v"))
    slices = rows.groupBy(F.window(time, step), *by).agg(F.sort_array(F.collect_set(sample)).alias("s"))
    lost = F.aggregate(F.sequence(F.lit(1), F.size("s")), F.lit(0.0), lambda sum_, i: sum_ + F.when(
        (i > 1) & (F.element_at("s", i)["v"] < F.element_at("s", F.greatest(F.lit(1), i - 1))["v"]),
        F.element_at("s", F.greatest(F.lit(1), i - 1))["v"]).otherwise(F.lit(0.0)))
    first, last = F.element_at("s", 1), F.element_at("s", -1)
    return slices.select(
        F.col("window.start").alias("slice"), *by, F.size("s").cast("long").alias("n"), first["t"].alias("first_t"), first["v"].alias("first_v"),
        last["t"].alias("last_t"), last["v"].alias("last_v"), lost.alias("lost"))


def _between(parts: Column) -> Column:
    """What resets between neighbouring summaries took away."""
    return F.aggregate(F.sequence(F.lit(1), F.size(parts)), F.lit(0.0), lambda sum_, i: sum_ + F.when(
        (i > 1) & (F.element_at(parts, i)["first_v"] < F.element_at(parts, F.greatest(F.lit(1), i - 1))["last_v"]),
        F.element_at(parts, F.greatest(F.lit(1), i - 1))["last_v"]).otherwise(F.lit(0.0)))


def counter_rates(summaries: DataFrame, by: Sequence[str] = (), span: str = RANGE, step: str = STEP) -> DataFrame:
    """window_start, window_end, the series, n, increase and per_second of every range that ends with a step.

    A range needs two samples at different times. The increase between its first and last sample is carried on to both ends of
    the range, as far as the samples come near them; towards the start never below a counter's zero.
    """
    part = F.struct("slice", "n", "first_t", "first_v", "last_t", "last_v", "lost")
    ranges = summaries.groupBy(F.window("slice", span, step), *by).agg(F.sort_array(F.collect_list(part)).alias("parts"))
    first, last = F.element_at("parts", 1), F.element_at("parts", -1)
    summed = lambda field: F.aggregate(F.transform("parts", lambda p: p[field]), F.lit(0).cast("double"), lambda a, x: a + x)
    rows = ranges.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, summed("n").cast("long").alias("n"),
        first["first_t"].alias("a"), last["last_t"].alias("z"), first["first_v"].alias("v"),
        (last["last_v"] - first["first_v"] + summed("lost") + _between(F.col("parts"))).alias("rise"))
    rows = rows.where((F.col("n") > 1) & (F.col("z") > F.col("a")))
    micros = F.lit(1e6)
    rows = rows.withColumns({
        "covered": (F.col("z") - F.col("a")) / micros, "before": (F.col("a") - F.unix_micros("window_start")) / micros,
        "after": (F.unix_micros("window_end") - F.col("z")) / micros,
        "length": (F.unix_micros("window_end") - F.unix_micros("window_start")) / micros,
    })
    gap = F.col("covered") / (F.col("n") - 1)
    zero = F.when((F.col("rise") > 0) & (F.col("v") >= 0), F.col("covered") * (F.col("v") / F.col("rise")))
    rows = rows.withColumn("before", F.least("before", zero))  # least skips a null
    near = lambda side: F.when(F.col(side) < gap * NEAR_END, F.col(side)).otherwise(gap / 2)
    increase = F.col("rise") * ((F.col("covered") + near("before") + near("after")) / F.col("covered"))
    return rows.withColumn("increase", increase).select(
        "window_start", "window_end", *by, "n", "increase", (F.col("increase") / F.col("length")).alias("per_second"))
