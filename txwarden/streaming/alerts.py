"""Streaming alert job: decode, score, route failures aside, keep alerts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from txwarden.functions.expressions import (
    ALERT_ABOVE, FAILED_SCORE, all_present, is_alert, is_detected, missing_list,
)
from txwarden.plans.training import score_rows
from txwarden.schemas import EVENT, FEATURES
from txwarden.sources.kafka import publish
from txwarden.streaming.inference_log import write_log
from txwarden.streaming.runs import batch_folder, run_id

CORRUPT = "_corrupt_record"


def decode(df: DataFrame, schema: T.StructType = EVENT, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON text to typed columns; other fields are dropped, unreadable text stays in
    `_corrupt_record`.

    `inline` parses each message once: filters on its columns are not pushed below it, where they
    would parse the text again.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = df.select(*keep, F.col(value).alias("_raw"), F.inline(F.array(parsed)))
    # A missing message is as unreadable as a broken one.
    broken = F.when(F.col("_raw").isNull(), F.lit("")).otherwise(F.col(CORRUPT))
    return out.withColumn(CORRUPT, broken).drop("_raw")


def readable(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def enrich(df: DataFrame, score: Callable[[DataFrame], DataFrame], features: Sequence[str] = FEATURES) -> DataFrame:
    """Add fraud_probability, fraud_detected and error.

    `score` adds the column fraud_probability. Rows that lack a feature get -1, no flag, and an
    error text.
    """
    valid = all_present(features)
    scored = score(df)
    p = F.when(valid & F.col("fraud_probability").isNotNull(), F.col("fraud_probability")).otherwise(F.lit(FAILED_SCORE))
    error = F.when(~valid, F.concat(F.lit("Processing error: missing "), missing_list(features))).when(
        F.col("fraud_probability").isNull(), F.lit("Processing error: no score")
    )
    return (
        scored.withColumn("error", error)
        .withColumn("fraud_probability", p)
        .withColumn("fraud_detected", is_detected(F.col("fraud_probability")))
        .select(*df.columns, "fraud_probability", "fraud_detected", "error")
    )


def enrich_with_model(df: DataFrame, model: PipelineModel, features: Sequence[str] = FEATURES) -> DataFrame:
    return enrich(df, lambda rows: score_rows(model, rows), features)


def alerts(enriched: DataFrame, above: float = ALERT_ABOVE) -> DataFrame:
    return enriched.where(is_alert(F.col("fraud_probability"), above))


def alert_messages(df: DataFrame) -> DataFrame:
    """Alerts as JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def alert_job(messages: DataFrame, score: Callable[[DataFrame], DataFrame], above: float = ALERT_ABOVE,
              schema: T.StructType = EVENT, features: Sequence[str] = FEATURES) -> DataFrame:
    """The whole stateless chain from JSON text to alert JSON; batch or streaming."""
    return alert_messages(alerts(enrich(readable(decode(messages, schema)), score, features), above))


@dataclass(frozen=True)
class Outputs:
    """Where a scored stream goes: folders for the log, unreadable messages and alerts, or a topic for the alerts."""

    log: str
    dead: str
    alerts: str
    servers: str | None = None


def scored_writer(messages: DataFrame, score: Callable[[DataFrame], DataFrame], outputs: Outputs, checkpoint: str,
                  above: float = ALERT_ABOVE, schema: T.StructType = EVENT, features: Sequence[str] = FEATURES) -> DataStreamWriter:
    """Each batch is decoded and scored once and then shared out.

    Every message goes to exactly one of log and dead letters; logged rows above the limit are
    alerts as well. Files of a replayed batch replace their own rows; a topic gets alerts at least
    once, and consumers drop repeats by transaction_id. Any failure stops the query.
    """

    def write(batch: DataFrame, number: int) -> None:
        run = run_id(batch.sparkSession, checkpoint)
        decoded = decode(batch, schema)
        scored = enrich(decoded, score, features).persist()  # blocks that are lost are computed again
        try:
            good = readable(scored)
            folder = batch_folder(outputs.dead, run, number)
            dead_letters(scored).write.mode("overwrite").json(folder)
            write_log(good, outputs.log, run, number)
            found = alert_messages(alerts(good, above))
            if outputs.servers:
                publish(found, outputs.servers, outputs.alerts)
            else:
                found.write.mode("overwrite").json(batch_folder(outputs.alerts, run, number))
        finally:
            scored.unpersist()

    return messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")


def file_writer(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> DataStreamWriter:
    return df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_stream_table(spark: SparkSession, folder: str, schema: T.StructType, name: str | None = None,
                      fmt: str = "parquet", **options) -> DataFrame:
    """A folder of files as a stream; `name` picks one table of it."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if name:
        reader = reader.option("pathGlobFilter", name)
    return reader.load(folder)
