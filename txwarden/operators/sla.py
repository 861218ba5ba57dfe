"""Latency and error limits over a table of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.functions.expressions import ratio
from txwarden.plans.ordered import quantiles

# Fixed limits of the load test: check, limit, whether values must stay below it.
LIMITS = (
    ("p95_ms", 100.0, True),
    ("p99_ms", 250.0, True),
    ("mean_ms", 50.0, True),
    ("error_rate", 0.01, True),
    ("check_rate", 0.99, False),
)


def latency_report(df: DataFrame, latency: str, failed: str, exact: bool = True, accuracy: int = 10_000, **slicing) -> DataFrame:
    """p95, p99, mean and error rate of all requests, one row."""
    bad = F.count_if(F.col(failed))
    rate = ratio(bad, F.count("*"), None)
    plain = [F.count("*").alias("requests"), F.avg(latency).alias("mean_ms"), rate.alias("error_rate"), (1 - rate).alias("check_rate")]
    if not exact:
        ends = F.percentile_approx(latency, F.array(F.lit(0.95), F.lit(0.99)), accuracy)
        return df.agg(*plain, ends.alias("_q")).select(
            "requests", F.col("_q")[0].alias("p95_ms"), F.col("_q")[1].alias("p99_ms"), "mean_ms", "error_rate", "check_rate"
        )
    found = quantiles(df, latency, [0.95, 0.99], **slicing)
    p95, p99 = found[0]["q"] if found else (None, None)
    return df.agg(*plain).select(
        "requests", F.lit(p95).cast("double").alias("p95_ms"), F.lit(p99).cast("double").alias("p99_ms"),
        "mean_ms", "error_rate", "check_rate",
    )


def limit_checks(report: DataFrame) -> DataFrame:
    """One row per limit: value, limit, passed."""
    entries = [
        F.struct(
            F.lit(name).alias("check"), F.col(name).alias("value"), F.lit(limit).alias("limit"),
            F.coalesce(F.col(name) < limit if below else F.col(name) > limit, F.lit(False)).alias("passed"),
        )
        for name, limit, below in LIMITS
    ]
    return report.select(F.explode(F.array(*entries)).alias("_c")).select("_c.*")
