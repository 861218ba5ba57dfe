"""Drift of a current table against a reference table, column by column.

Every column is compared through value counts of both sides. Continuous columns need cumulative
counts along the value axis, which run in slices; columns with few values need only the counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwarden.functions.expressions import ratio
from txwarden.functions.significance import chi_square_tail, ks_two_sample_tail, normal_two_sided
from txwarden.operators.prepare import align, drop_repeats, fill_medians, long_values
from txwarden.operators.profile import quality
from txwarden.plans.ordered import walk
from txwarden.schemas import FEATURES

# Fixed values of the public drift defaults. TESTED_ROWS only counts with the method "by_size".
TESTED_ROWS, FEW_VALUES = 1000, 5
P_LIMIT, DISTANCE_LIMIT, SMALLEST_NORM = 0.05, 0.1, 0.001
DRIFT_SHARE = 0.5
MIN_ROWS = 100
DISTANCES, TESTS, BY_SIZE = "distances", "tests", "by_size"
INSUFFICIENT = "insufficient_data"  # fixed: the status a gated run is stored with

RESULT = "column string, method string, score double, threshold double, drifted boolean"


def both_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long rows (column, value, is_current) of both tables; missing and infinite values left out."""
    rows = long_values(reference, columns).withColumn("is_current", F.lit(False)).unionByName(
        long_values(current, columns).withColumn("is_current", F.lit(True))
    )
    infinite = F.abs("value") == float("inf")
    return rows.where(F.col("value").isNotNull() & ~F.isnan("value") & ~infinite)


def column_profile(rows: DataFrame) -> DataFrame:
    """Rows per side, deviation of the reference, range, and about how many values, per column."""
    old = F.when(~F.col("is_current"), F.col("value"))
    return rows.groupBy("column").agg(
        F.count_if(~F.col("is_current")).alias("n_reference"), F.count_if(F.col("is_current")).alias("n_current"),
        F.stddev_pop(old).alias("std_reference"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.approx_count_distinct("value").alias("values"),
    )


def value_counts(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.groupBy("column", *extra, "value").agg(
        F.count_if(~F.col("is_current")).alias("reference"), F.count_if(F.col("is_current")).alias("current")
    )


def _side_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("column").agg(
        F.sum("reference").cast("double").alias("n_reference"), F.sum("current").cast("double").alias("n_current")
    )


# Along the value axis of a column: counts so far of both sides, the next value, and side sizes.
ALONG = {
    "totals": {"upto_reference": "reference", "upto_current": "current"},
    "overall": {"n_reference": "reference", "n_current": "current"},
    "ahead": {"next_value": "value"},
}


def _apart() -> Column:
    """Gap between the two distribution functions at a value."""
    return F.abs(
        ratio(F.col("upto_reference"), F.col("n_reference"), None) - ratio(F.col("upto_current"), F.col("n_current"), None)
    )


def _moved() -> Column:
    return F.coalesce(F.sum(_apart() * (F.col("next_value") - F.col("value"))), F.lit(0.0))


def distances(rows: DataFrame, **slicing) -> DataFrame:
    """Exact Kolmogorov-Smirnov and Wasserstein distance of the two sides, one row per column."""
    return _along(rows, **slicing).groupBy("column").agg(F.max(_apart()).alias("ks"), _moved().alias("wasserstein"))


def _along(rows: DataFrame, **slicing) -> DataFrame:
    return walk(value_counts(rows), ["value"], ["column"], **ALONG, source=rows.select("column", "value"), **slicing)


def column_statistics(rows: DataFrame, **slicing) -> DataFrame:
    """Distances, category statistics and the number of values of each column, from one ordered pass over value counts."""
    return _along(rows, **slicing).groupBy("column").agg(
        F.max(_apart()).alias("ks"), _moved().alias("wasserstein"), *_category_facts()
    )


def binned_distances(rows: DataFrame, spans: dict[str, tuple[float, float]], bins: int) -> DataFrame:
    """Wasserstein distance of values moved to the lower edge of equal bins.

    One pass; only the counts of columns x bins are shuffled. The result differs from the exact
    distance by at most one bin width.
    """
    frame = rows.sparkSession.createDataFrame(
        [(c, low, (high - low) / bins or 1.0) for c, (low, high) in spans.items()], "column string, low double, width double"
    )
    placed = rows.join(F.broadcast(frame), "column")  # one row per column
    number = F.least(F.floor((F.col("value") - F.col("low")) / F.col("width")), F.lit(bins - 1))
    counts = value_counts(placed.select("column", "width", number.cast("double").alias("value"), "is_current"), "width")
    walked = walk(counts, ["value"], ["column"], **ALONG, n_rows=bins * len(spans))
    return walked.groupBy("column").agg(
        (_moved() * F.max("width")).alias("wasserstein"), F.max("width").alias("width")
    )


def _category_facts() -> list[Column]:
    """Aggregates over the values of a column; side sizes are on every row."""
    p = ratio(F.col("reference"), F.col("n_reference"), None)
    q = ratio(F.col("current"), F.col("n_current"), None)
    middle = (p + q) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log(x / middle)).otherwise(F.lit(0.0))

    expected = p * F.col("n_current")
    off = F.when(expected > 0, F.pow(F.col("current") - expected, 2) / expected).when(
        F.col("current") > 0, F.lit(float("inf"))
    ).otherwise(F.lit(0.0))
    pooled = (F.col("reference") + F.col("current")) / (F.col("n_reference") + F.col("n_current"))
    spread = F.sqrt(pooled * (1 - pooled) * (ratio(F.lit(1.0), F.col("n_reference")) + ratio(F.lit(1.0), F.col("n_current"))))
    z = ratio(p - q, spread)
    return [
        F.sqrt(F.greatest(F.sum(part(p) + part(q)) / 2, F.lit(0.0))).alias("jensen_shannon"),
        F.sum(off).alias("chi_square"), F.count("*").alias("values"), F.max_by(z, F.col("value")).alias("z"),
    ]


def category_statistics(counts: DataFrame) -> DataFrame:
    """Jensen-Shannon distance, chi-square of current against reference, and the two-proportion z
    of the largest value, one row per column."""
    sides = F.broadcast(_side_totals(counts))  # one row per column
    return counts.join(sides, "column").groupBy("column").agg(*_category_facts())


def column_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str], method: str = DISTANCES,
                 precise: bool = True, bins: int = 4096, **slicing) -> DataFrame:
    """Method, score, limit and drift flag of each column.

    `method` "distances": Wasserstein distance in reference deviations or, up to five values,
    Jensen-Shannon distance; drift from 0.1 on. "tests": p-values of KS (more than five values),
    chi-square (three to five) or a z-test; drift below 0.05. "by_size" tests references of up to
    1000 values and measures larger ones, column by column, as the public defaults do.

    `precise=False` settles Wasserstein columns by binned counts where the error bound allows a
    certain decision and ranks whole columns only for the rest; flags are the same, scores of the
    settled columns are off by at most one bin width.
    """
    if method not in (DISTANCES, TESTS, BY_SIZE):
        raise ValueError(f"unknown method {method!r}")
    rows = both_sides(reference, current, columns)
    found = {r["column"]: r for r in column_profile(rows).collect()}  # one row per column
    usable = {c: r for c, r in found.items() if r["n_reference"] and r["n_current"]}
    tested = {c for c, r in usable.items() if method == TESTS or method == BY_SIZE and r["n_reference"] <= TESTED_ROWS}
    norm = {c: max(r["std_reference"], SMALLEST_NORM) for c, r in usable.items()}
    scores: dict[str, tuple[str, float]] = {}
    open_columns = list(usable)
    # A sketched count this high rules out that a column has few values.
    binned = [] if precise else [c for c, r in usable.items() if c not in tested and r["values"] > 4 * FEW_VALUES]
    if binned:
        spans = {c: (usable[c]["low"], usable[c]["high"]) for c in binned}
        for r in binned_distances(rows.where(F.col("column").isin(binned)), spans, bins).collect():
            score, slack = r["wasserstein"] / norm[r["column"]], r["width"] / norm[r["column"]]
            if abs(score - DISTANCE_LIMIT) > slack:
                scores[r["column"]] = ("wasserstein", score)
                open_columns.remove(r["column"])
    if open_columns:
        chosen = rows if len(open_columns) == len(columns) else rows.where(F.col("column").isin(open_columns))
        distinct = sum(2 * usable[c]["values"] for c in open_columns)
        for r in column_statistics(chosen, **{"n_rows": distinct, **slicing}).collect():
            scores[r["column"]] = _score(r, usable[r["column"]], norm[r["column"]], r["column"] in tested)

    out = []
    for c in columns:
        if c not in scores:
            out.append((c, "no values", None, None, False))
            continue
        name, score = scores[c]
        far = name in ("wasserstein", "jensenshannon")
        drifted = score >= DISTANCE_LIMIT if far else score < P_LIMIT
        out.append((c, name, None if math.isnan(score) else float(score), DISTANCE_LIMIT if far else P_LIMIT, bool(drifted)))
    return reference.sparkSession.createDataFrame(out, RESULT)


def _score(facts, profile, norm: float, tested: bool) -> tuple[str, float]:
    """Method and score of one column from its statistics."""
    few = facts["values"] <= FEW_VALUES
    if not tested:
        return ("jensenshannon", facts["jensen_shannon"]) if few else ("wasserstein", facts["wasserstein"] / norm)
    if not few:
        return "ks", ks_two_sample_tail(facts["ks"], profile["n_reference"], profile["n_current"])
    if facts["values"] > 2:
        return "chisquare", chi_square_tail(facts["chi_square"], facts["values"] - 1)
    return "z", normal_two_sided(facts["z"])


def drift_flags(columns: DataFrame, share: float = DRIFT_SHARE, target: str = "target") -> DataFrame:
    """Dataset drift (share of drifted columns), target drift, and either."""
    sums = columns.agg(
        F.count("*").alias("n_columns"), F.count_if("drifted").alias("n_drifted"),
        (F.avg(F.col("drifted").cast("int")) >= share).alias("dataset_drift"),
        F.coalesce(F.bool_or(F.when(F.col("column") == target, F.col("drifted"))), F.lit(False)).alias("target_drift"),
    )
    return sums.withColumn("drift_detected", F.col("dataset_drift") | F.col("target_drift"))


def enough_rows(df: DataFrame, minimum: int = MIN_ROWS) -> bool:
    """Whether the table has the rows."""
    return df.count() >= minimum


def drift_job(reference: DataFrame, current: DataFrame, features: Sequence[str] = FEATURES, minimum: int = MIN_ROWS,
              target_cut: float | None = None, method: str = DISTANCES, precise: bool = True, reference_target: str = "Class",
              current_target: str = "prediction") -> dict:
    """Gate, fill, dedupe, align and compare; the summary as a dictionary.

    Quality is read off the raw current table, where repeats and gaps can still be seen.
    `target_cut` turns predictions into 0/1 first, so they compare with labels. Below `minimum`
    rows there is only a status and the number of rows.
    """
    facts = quality(current)
    if facts["total_rows"] < minimum:
        return {"status": INSUFFICIENT, "total_rows": facts["total_rows"], "minimum": minimum}
    old, new, common = align(
        drop_repeats(fill_medians(reference)), drop_repeats(fill_medians(current)), features, reference_target, current_target
    )
    if target_cut is not None:
        new = new.withColumn("target", (F.col("target") > target_cut).cast("int"))
    columns = column_drift(old, new, [*common, "target"], method=method, precise=precise)
    flags = drift_flags(columns).first().asDict()
    return {"status": "compared", "minimum": minimum, **flags, "columns": [r.asDict() for r in columns.collect()], "data_quality": facts}


SUMMARY = (
    "run_id string, status string, total_rows bigint, minimum bigint, dataset_drift boolean, target_drift boolean, drift_detected boolean, "
    "column_drifts map<string,boolean>, missing_values map<string,bigint>, duplicate_rows bigint, data_types map<string,string>, "
    "numeric_columns int, categorical_columns int"
)


def summary_frame(spark, summary: dict, run_id: str) -> DataFrame:
    """The summary as one row; a gated run has only its status and numbers of rows."""
    facts = summary.get("data_quality", {})
    drifted = {r["column"]: r["drifted"] for r in summary["columns"]} if "columns" in summary else None
    row = (run_id, summary["status"], facts.get("total_rows", summary.get("total_rows")), summary["minimum"],
           *[summary.get(k) for k in ("dataset_drift", "target_drift", "drift_detected")], drifted,
           *[facts.get(k) for k in ("missing_values", "duplicate_rows", "data_types", "numeric_columns", "categorical_columns")])
    return spark.createDataFrame([row], SUMMARY).withColumn("analysis_timestamp", F.current_timestamp())


def columns_frame(spark, summary: dict, run_id: str) -> DataFrame:
    """Method, score, limit and flag of every compared column of the run."""
    rows = [(run_id, *[r[k] for k in ("column", "method", "score", "threshold", "drifted")]) for r in summary.get("columns", ())]
    return spark.createDataFrame(rows, f"run_id string, {RESULT}")
