"""Message numbering, metadata and gaps along the Time order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwarden.functions.expressions import PRODUCER_ID, nan_to_null, send_gap, transaction_id
from txwarden.plans.ordered import walk

# Fixed delay of a message without a successor.
LAST_DELAY = 0.1


def number_rows(df: DataFrame, order: Sequence[str], out: str = "number", **slicing) -> DataFrame:
    """Row number from 1 along `order`, in slices rather than one global window."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    return walk(ones, order, totals={out: "_one"}, **slicing).drop("_one")


def with_metadata(df: DataFrame, number: str, sent_at: Column | None = None) -> DataFrame:
    """Message fields: id from the row number, epoch milliseconds, producer."""
    at = F.current_timestamp() if sent_at is None else sent_at
    columns = [c for c in df.columns if c != number]
    return nan_to_null(df).select(
        *columns, transaction_id(F.col(number)).alias("transaction_id"), F.unix_millis(at).alias("timestamp"),
        F.lit(PRODUCER_ID).alias("producer_id"),
    )


def send_gaps(df: DataFrame, time: str, key: str, by: Sequence[str] = (), **slicing) -> DataFrame:
    """Scaled gap between a row and the next one in Time order; a fixed delay on the last row."""
    walked = walk(df, [time, key], by, ahead={"_next": time}, **slicing)
    # least and greatest skip NULL, so the last row needs its own branch
    gap = F.when(F.col("_next").isNotNull(), send_gap(F.col("_next") - F.col(time))).otherwise(F.lit(LAST_DELAY))
    return walked.withColumn("gap_seconds", gap).drop("_next")


def head_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sort_by_time(df: DataFrame, time: str = "Time", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sorted rows; ties spread over the tiebreak, so one frequent time does not fill one task."""
    return df.orderBy(time, *tiebreak)
