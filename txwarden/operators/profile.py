"""Table profile: counts, class balance, gaps, repeats, distributions by class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.functions.expressions import ratio
from txwarden.operators.prepare import numeric_columns
from txwarden.plans.ordered import quantiles
from txwarden.schemas import TARGET

BINS = 50


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def class_counts(df: DataFrame, label: str = TARGET) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def class_weight(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Weight of the positive class: negatives per positive."""
    counts = df.agg(F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives"))
    return counts.withColumn("scale_pos_weight", ratio(F.col("negatives"), F.col("positives"), None))


def class_balance(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Fraud count, rate in percent, and legitimate rows per fraud."""
    counts = df.agg(F.sum(label).cast("long").alias("fraud_count"), F.count("*").alias("total_count"))
    fraud, total = F.col("fraud_count"), F.col("total_count")
    return counts.select(
        "*", (ratio(fraud, total, None) * 100).alias("fraud_rate"),
        ratio(total - fraud, fraud, None).alias("imbalance_ratio"),
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Missing values of every column in one pass, one row per column."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    gap = {c: F.col(c).isNull() | F.isnan(c) if c in floating else F.col(c).isNull() for c in df.columns}
    wide = df.agg(*[F.count_if(test).alias(c) for c, test in gap.items()])
    return wide.unpivot([], list(df.columns), "column", "missing")


def total_missing(df: DataFrame) -> DataFrame:
    return missing_values(df).agg(F.sum("missing").alias("missing"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row. Copies collapse before the shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return groups.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))


def column_kinds(df: DataFrame) -> dict:
    """Types, and how many columns are numeric or text; needs no job."""
    return {
        "data_types": dict(df.dtypes),
        "numeric_columns": len(numeric_columns(df)),
        "categorical_columns": sum(isinstance(f.dataType, T.StringType) for f in df.schema),
    }


def quality(df: DataFrame) -> dict:
    """Data quality of a table as the drift summary reports it."""
    rows = df.agg(F.count("*").alias("n")).first()["n"]
    gaps = {r["column"]: r["missing"] for r in missing_values(df).collect()}  # one row per column
    return {
        "total_rows": rows,
        "missing_values": gaps,
        "duplicate_rows": duplicate_rows(df).first()["duplicate_rows"],
        **column_kinds(df),
    }


def amount_by_class(df: DataFrame, amount: str = "Amount", label: str = TARGET, **slicing) -> DataFrame:
    """Rows, mean and exact median of the amount in each class that has an amount."""
    facts = {"rows": F.count("*"), "mean": F.avg(amount)}
    found = quantiles(df, amount, [0.5], [label], facts=facts, **slicing)
    return _rows(df, [(r[label], r["rows"], r["mean"], r["q"][0]) for r in found], label, "n bigint, mean_amount double, median_amount double")


def _rows(df: DataFrame, data: list[tuple], label: str, fields: str) -> DataFrame:
    kind = df.schema[label].dataType.simpleString()
    return df.sparkSession.createDataFrame(data, f"`{label}` {kind}, {fields}")


def time_span(df: DataFrame, time: str = "Time") -> DataFrame:
    return df.agg((F.max(time) / 86400).alias("days"))


def _bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Bin number from 0; bins are half open, the last one closed, as drawn on equal edges."""
    step = (high - low) / bins
    guess = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    lower, upper = F.lit(low) + guess * F.lit(step), F.lit(low) + (guess + 1) * F.lit(step)
    return F.when(value < lower, guess - 1).when((value >= upper) & (guess < bins - 1), guess + 1).otherwise(guess)


def histograms(df: DataFrame, columns: Sequence[str], label: str = TARGET, bins: int = BINS) -> DataFrame:
    """Counts per class in equal bins over each column's common range, empty bins included."""
    ends = df.agg(
        *[f(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"{n}_{c}") for c in columns
          for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    spans = {}
    for c in columns:
        low, high = ends[f"lo_{c}"], ends[f"hi_{c}"]
        if low is not None:
            spans[c] = (low, high) if high > low else (low - 0.5, high + 0.5)
    binned = df.select(F.col(label).alias("_y"), *[_bin(F.col(c).cast("double"), *spans[c], bins).alias(c) for c in spans])
    counted = (
        binned.unpivot(["_y"], list(spans), "column", "bin").where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count_if(F.col("_y") == 0).alias("negatives"), F.count_if(F.col("_y") == 1).alias("positives"))
    )
    edges = df.sparkSession.createDataFrame(
        [(c, i, low + i * ((high - low) / bins), high if i == bins - 1 else low + (i + 1) * ((high - low) / bins))
         for c, (low, high) in spans.items() for i in range(bins)],
        "column string, bin int, low double, high double",
    )
    return edges.join(counted, ["column", "bin"], "left").fillna(0, ["negatives", "positives"])


def box_plot(df: DataFrame, value: str = "Amount", label: str = TARGET, **slicing) -> DataFrame:
    """Quartiles per class, whiskers at the last values within 1.5 IQR, and values beyond them."""
    quartiles = _rows(
        df, [(r[label], *r["q"]) for r in quantiles(df, value, [0.25, 0.5, 0.75], [label], **slicing)],
        label, "q1 double, med double, q3 double",
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    v = F.col(value)
    joined = df.select(label, value).join(F.broadcast(quartiles), label)  # one row per class
    inside = (v >= F.col("q1") - reach) & (v <= F.col("q3") + reach)
    return joined.groupBy(label, "q1", "med", "q3").agg(
        F.least(F.min(F.when(inside, v)), F.col("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, v)), F.col("q3")).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
