"""Streams that remember: messages that come again are dropped, and rows are numbered over batches and restarts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from txwarden.operators.sequence import number_rows
from txwarden.streaming.rates import with_instant
from txwarden.streaming.runs import batch_folder, run_id


def drop_repeats(messages: DataFrame, key: str = "transaction_id", time: str = "timestamp", within: str = "1 hour") -> DataFrame:
    """Each message once, by its key, on a stream or a table.

    A sink that delivers at least once sends a batch again after a failure. A message's key is remembered until the watermark,
    `within` behind the latest time seen, has passed its time by as much again, and is then forgotten; a repeat that comes
    later, or a message older than the watermark when state was cleared, is not recognised or is dropped as late. Messages
    without a key or a time can be told from no other, and all pass. `time` is a timestamp column.
    """
    known = F.col(key).isNotNull() & F.col(time).isNotNull()
    rows = with_instant(messages, time)
    if not messages.isStreaming:
        return rows.where(known).dropDuplicates([key]).unionByName(rows.where(~known))
    once = rows.where(known).withWatermark(time, within).dropDuplicatesWithinWatermark([key])
    return once.unionByName(rows.where(~known))


def last_number(spark: SparkSession, state: str, run: str, batch: int) -> int:
    """The number that the batch before ended with."""
    return 0 if batch == 0 else spark.read.schema("last long").json(batch_folder(state, run, batch - 1)).first()["last"]


def numbered_writer(df: DataFrame, order: Sequence[str], path: str, state: str, checkpoint: str, out: str = "number") -> DataStreamWriter:
    """Rows of a stream under `path` with numbers from 1, without gaps over batches and restarts from the checkpoint.

    Rows of a batch are numbered along `order`, which has to tell them apart, and go on from the last number of the batch
    before, which `state` holds by run and batch. A replayed batch finds the same start, gets the same numbers and replaces its
    rows. The checkpoint's run numbers from 1; another run has numbers of its own.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, run = batch.sparkSession, run_id(batch.sparkSession, checkpoint)
        start = last_number(spark, state, run, number)
        rows = batch.persist()
        try:
            numbered = number_rows(rows, order, out).withColumn(out, F.col(out) + F.lit(start))
            numbered.write.mode("overwrite").parquet(batch_folder(path, run, number))
            spark.range(1).select(F.lit(start + rows.count()).alias("last")).write.mode("overwrite").json(batch_folder(state, run, number))
        finally:
            rows.unpersist()

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
