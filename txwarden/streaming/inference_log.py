"""Inference log: scored micro-batches and batch results appended to one table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from txwarden.functions.expressions import is_detected
from txwarden.streaming.compaction import log_table
from txwarden.streaming.runs import batch_folder, lone_run, run_id


def log_rows(scored: DataFrame, prediction_id: str, at: str | None = None, score: str = "fraud_probability") -> DataFrame:
    """Scored rows in the log's layout; one id and one time for the whole batch."""
    when = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if at is None else F.lit(at)
    added = ("fraud_detected", "error", "timestamp", "prediction_id")
    columns = [c for c in scored.columns if c != score and c not in added]
    return scored.select(
        *columns, F.col(score).alias("prediction"), F.lit(prediction_id).alias("prediction_id"), when.alias("timestamp"),
        is_detected(F.col(score)).alias("fraud_detected"),
    )


def write_log(scored: DataFrame, path: str, run: str, number: int, score: str = "fraud_probability") -> None:
    """One batch of a run; writing it again replaces its rows."""
    folder = batch_folder(path, run, number)
    log_rows(scored, str(uuid.uuid5(uuid.NAMESPACE_URL, folder)), score=score).write.mode("overwrite").parquet(folder)


def append_log(scored: DataFrame, path: str, score: str = "fraud_probability") -> None:
    """Batch append, as a run of its own."""
    write_log(scored, path, lone_run(), 0, score)


def log_writer(scored: DataFrame, path: str, checkpoint: str, score: str = "fraud_probability") -> DataStreamWriter:
    """Streaming append."""

    def write(batch: DataFrame, number: int) -> None:
        write_log(batch, path, run_id(batch.sparkSession, checkpoint), number, score)

    return scored.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Each row of all runs once, folded or not, without the columns that only name folders. Batches that are being written
    are not seen. A folder without batches is read as a plain table."""
    rows = log_table(spark, path)
    return (spark.read.parquet(path) if rows is None else rows).drop("run", "batch")
