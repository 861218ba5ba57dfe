"""Stored profiles of a table, so that drift is measured against it without reading it again.

A profile holds, for each column, moments and counts: of its values where there are few, else of the bins of a grid that the first
part of the profile fixes and later parts keep. Both add up, so the profile of a table is that of its parts, day by day.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwarden.operators.drift import ALONG, DISTANCE_LIMIT, FEW_VALUES, RESULT, SMALLEST_NORM, _category_facts, _moved
from txwarden.operators.prepare import long_values
from txwarden.plans.ordered import walk

COUNTS = "column string, low double, width double, value double, n bigint"
MOMENTS = "column string, n bigint, mean double, m2 double"
BINS = 4096


@dataclass(frozen=True)
class Profile:
    """`counts` by column and value, or by bin number where `width` is not null; `moments` by column."""

    counts: DataFrame
    moments: DataFrame


def usable_values(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long rows (column, value) without missing and infinite values."""
    return long_values(table, columns).where(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf")))


def new_grid(table: DataFrame, columns: Sequence[str], bins: int = BINS) -> dict[str, tuple[float, float] | None]:
    """For each column the low end and the width of its bins; None where it has few values."""
    facts = usable_values(table, columns).groupBy("column").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.approx_count_distinct("value").alias("values"))
    grid: dict[str, tuple[float, float] | None] = dict.fromkeys(columns)
    for r in facts.collect():  # one row per column
        if r["values"] > 4 * FEW_VALUES:
            grid[r["column"]] = (r["low"], (r["high"] - r["low"]) / bins)
    return grid


def placed(rows: DataFrame, grid: dict[str, tuple[float, float] | None]) -> DataFrame:
    """column, low, width, value: the value itself, or the number of its bin. The grid goes on beyond both ends."""
    frame = rows.sparkSession.createDataFrame(
        [(c, *(g or (None, None))) for c, g in grid.items()], "column string, low double, width double")
    out = rows.join(F.broadcast(frame), "column")  # one row per column
    number = F.floor((F.col("value") - F.col("low")) / F.col("width")).cast("double")
    return out.select("column", "low", "width", F.coalesce(number, "value").alias("value"))


def build_profile(table: DataFrame, columns: Sequence[str], grid: dict[str, tuple[float, float] | None] | None = None, bins: int = BINS) -> Profile:
    """The profile of a table, on a grid of its own or on that of the profile it is to be added to."""
    grid = grid or new_grid(table, columns, bins)
    rows = usable_values(table, columns)
    counts = placed(rows, grid).groupBy("column", "low", "width", "value").agg(F.count("*").alias("n"))
    moments = rows.groupBy("column").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count("*")).alias("m2"))
    return Profile(counts, moments)


def save_profile(profile: Profile, path: str, part: str) -> None:
    """One part of a profile; writing it again replaces it."""
    profile.counts.write.mode("overwrite").parquet(f"{path}/counts/part={part}")
    profile.moments.write.mode("overwrite").parquet(f"{path}/moments/part={part}")


def load_profile(spark: SparkSession, path: str, parts: Sequence[str] | None = None) -> Profile:
    """All parts of a profile, or those named, as one."""
    counts, moments = (spark.read.schema(f"{s}, part string").parquet(f"{path}/{name}") for name, s in (("counts", COUNTS), ("moments", MOMENTS)))
    if parts is not None:
        counts, moments = (df.where(F.col("part").isin(list(parts))) for df in (counts, moments))
    total = F.sum("n")
    mean = F.sum(F.col("n") * F.col("mean")) / total
    # Sums of squares about each part's mean, moved to the common one.
    shifted = moments.join(F.broadcast(moments.groupBy("column").agg(mean.alias("centre"))), "column")
    m2 = F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2))
    return Profile(
        counts.groupBy("column", "low", "width", "value").agg(total.alias("n")),
        shifted.groupBy("column").agg(total.alias("n"), F.max("centre").alias("mean"), m2.alias("m2")))


def grid_of(profile: Profile) -> dict[str, tuple[float, float] | None]:
    """The grid that a stored profile keeps; one row per column."""
    rows = profile.counts.groupBy("column").agg(F.max("low").alias("low"), F.max("width").alias("width")).collect()
    return {r["column"]: None if r["width"] is None else (r["low"], r["width"]) for r in rows}


def profile_drift(profile: Profile, current: DataFrame, columns: Sequence[str], **slicing) -> DataFrame:
    """Method, score, limit and flag of each column, the current table against a stored profile, and `slack`.

    As `column_drift` by distances: Jensen-Shannon up to five values, else the Wasserstein distance in deviations of the
    reference. On a grid the latter is off by at most `slack`, one bin in deviations: the flag is certain where score and
    limit are farther apart. Only `current` and the profile are read.
    """
    grid = grid_of(profile)
    known = [c for c in columns if c in grid]
    new = placed(usable_values(current, known), {c: grid[c] for c in known})
    old = profile.counts.where(F.col("column").isin(known))
    both = old.select("column", "width", "value", F.col("n").alias("reference"), F.lit(0).cast("bigint").alias("current")).unionByName(
        new.select("column", "width", "value", F.lit(0).cast("bigint").alias("reference"), F.lit(1).cast("bigint").alias("current")))
    counts = both.groupBy("column", "width", "value").agg(F.sum("reference").alias("reference"), F.sum("current").alias("current"))
    along = walk(counts, ["value"], ["column"], **{**ALONG, "n_rows": BINS * max(1, len(known)), **slicing})
    facts = along.groupBy("column").agg(
        _moved().alias("wasserstein"), F.max("width").alias("width"), F.sum("reference").alias("n_reference"), F.sum("current").alias("n_current"),
        *_category_facts())
    spread = profile.moments.select("column", F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / F.col("n")).alias("std"))
    found = {r["column"]: r for r in facts.join(F.broadcast(spread), "column").collect()}  # one row per column
    out = []
    for c in columns:
        r = found.get(c)
        if r is None or not r["n_reference"] or not r["n_current"]:
            out.append((c, "no values", None, None, False, None))
            continue
        few = r["width"] is None and r["values"] <= FEW_VALUES
        norm = max(r["std"], SMALLEST_NORM)
        size = 1.0 if r["width"] is None else r["width"]
        score = r["jensen_shannon"] if few else r["wasserstein"] * size / norm
        slack = 0.0 if r["width"] is None else r["width"] / norm
        out.append((c, "jensenshannon" if few else "wasserstein", None if math.isnan(score) else float(score), DISTANCE_LIMIT, bool(score >= DISTANCE_LIMIT), slack))
    return current.sparkSession.createDataFrame(out, f"{RESULT}, slack double")
