"""Rates and running counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from txwarden.functions.expressions import DETECT_ABOVE
from txwarden.streaming.runs import batch_folder, run_id

WRITTEN = "_written"

# Fixed range and step of the dashboard's rate.
RANGE, STEP = "5 minutes", "1 minute"
RANGE_SECONDS = 300


def with_instant(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a timestamp with a zone; plain timestamps are read in session time (UTC)."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def windowed_rate(df: DataFrame, time: str, by: Sequence[str] = (), late: str | None = None) -> DataFrame:
    """Events per second over sliding five-minute windows, every minute.

    `late` is the watermark of a streaming table. Rows are counted per minute, and only those
    counts enter the five windows a minute belongs to; on a stream this needs append mode.
    """
    minutes = _per_minute(df, time, by, late)
    counts = minutes.groupBy(F.window(F.window_time("window"), RANGE, STEP), *by).agg(F.sum("n").alias("n"))
    return _rate(counts, by)


def _per_minute(df: DataFrame, time: str, by: Sequence[str], late: str | None) -> DataFrame:
    rows = with_instant(df, time)
    if late:
        rows = rows.withWatermark(time, late)
    return rows.groupBy(F.window(time, STEP), *by).agg(F.count("*").alias("n"))


def minute_counts(df: DataFrame, time: str, by: Sequence[str] = (), late: str | None = None) -> DataFrame:
    """Events per minute; the running state of a stream in update mode."""
    return _per_minute(df, time, by, late).select(F.col("window.start").alias("minute"), *by, "n")


def rates_of_minutes(minutes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sliding rates of a table of minute counts."""
    counts = minutes.groupBy(F.window("minute", RANGE, STEP), *by).agg(F.sum("n").alias("n"))
    return _rate(counts, by)


def batch_rate(df: DataFrame, time: str, by: Sequence[str] = ()) -> DataFrame:
    """The same rate on a batch table."""
    return rates_of_minutes(minute_counts(df, time, by), by)


def _rate(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "n",
        (F.col("n") / F.lit(float(RANGE_SECONDS))).alias("per_second"),
    )


def detected_total(df: DataFrame, score: str | Column, above: float = DETECT_ABOVE) -> DataFrame:
    """Running count of detected rows; on a stream, use complete or update mode."""
    score = F.col(score) if isinstance(score, str) else score
    return df.agg(F.count_if(score > above).alias("detected"))


def latest_writer(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Update-mode results written per batch and run; `latest_rows` keeps the newest of each key."""

    def write(batch: DataFrame, number: int) -> None:
        folder = batch_folder(path, run_id(batch.sparkSession, checkpoint), number)
        batch.withColumn(WRITTEN, F.current_timestamp()).write.mode("overwrite").parquet(folder)

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update")


def latest_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State of the run that wrote last: of each key the row of its highest batch."""
    values = [c for c in df.columns if c not in (*keys, "run", "batch", WRITTEN)]
    last_run = df.agg(F.max_by("run", WRITTEN)).scalar()
    newest = F.max_by(F.struct(*values), F.col("batch")).alias("_v")
    return df.where(F.col("run") == last_run).groupBy(*keys).agg(newest).select(*keys, "_v.*")


def keep_latest(spark: SparkSession, path: str, keys: Sequence[str], out: str) -> None:
    """The state alone, rewritten under `out`: what batches and older runs hold besides may then be deleted."""
    latest_rows(spark.read.parquet(path), keys).write.mode("overwrite").parquet(out)
