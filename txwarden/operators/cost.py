"""Business cost of a threshold."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwarden.functions.expressions import ratio
from txwarden.operators.curves import confusion
from txwarden.schemas import TARGET

# Thresholds, and what one row of each cell costs and brings.
THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6)
UNIT_COST = {"fn": 100, "fp": 1}
UNIT_REVENUE = {"tp": 50}


def weighted(units: Mapping[str, float]) -> Column:
    """Sum of cell counts times their unit values."""
    return functools.reduce(operator.add, [F.col(cell) * value for cell, value in units.items()], F.lit(0))


def business_costs(df: DataFrame, score: str, label: str = TARGET, thresholds: Sequence[float] = THRESHOLDS,
                   unit_cost: Mapping[str, float] = UNIT_COST, unit_revenue: Mapping[str, float] = UNIT_REVENUE) -> DataFrame:
    """Cells, precision, recall, cost, revenue and net benefit at each threshold, in one pass.

    The output names are fixed: other jobs read them.
    """
    cells = confusion(df, score, label, thresholds)
    flagged, frauds = F.col("tp") + F.col("fp"), F.col("tp") + F.col("fn")
    priced = cells.withColumns({"total_cost": weighted(unit_cost), "total_revenue": weighted(unit_revenue)})
    return priced.select(
        "threshold", "tp", "fp", "fn", "tn", ratio(F.col("tp"), flagged).alias("precision"), ratio(F.col("tp"), frauds).alias("recall"),
        "total_cost", "total_revenue", (F.col("total_revenue") - F.col("total_cost")).alias("net_benefit"),
    )


def best_by_net_benefit(costs: DataFrame) -> DataFrame:
    """The threshold with the highest net benefit; among equals the lowest."""
    order = F.struct(F.col("net_benefit"), (-F.col("threshold")).alias("low"))
    return costs.agg(F.max_by(F.struct(*costs.columns), order).alias("_b")).select("_b.*")


def return_on_investment(df: DataFrame, best: DataFrame, amount: str = "Amount", label: str = TARGET) -> DataFrame:
    """Fraud value of the data set, the part of it prevented, and the return in percent."""
    fraud = df.agg(
        F.sum(F.when(F.col(label) == 1, F.col(amount))).alias("value"),
        F.count_if(F.col(label) == 1).alias("n"),
    )
    values = best.select(
        "threshold", "tp", "total_cost", fraud.select("value").scalar().alias("total_fraud_value"),
        fraud.select("n").scalar().alias("_n"),
    )
    prevented = ratio(F.col("tp"), F.col("_n"), None) * F.col("total_fraud_value")
    return values.withColumn("prevented_fraud", prevented).select(
        "threshold", "total_fraud_value", "prevented_fraud",
        (ratio(F.col("prevented_fraud") - F.col("total_cost"), F.col("total_cost"), None) * 100).alias("roi_percent"),
    )
