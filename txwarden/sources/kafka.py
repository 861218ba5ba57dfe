"""Kafka in and out. Needs the spark-sql-kafka package on the cluster; the options are plain
dictionaries, so every job also takes another streaming format (files in the tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# Fixed names of the topics.
TRANSACTIONS, ALERTS = "transactions", "fraud_alerts"
# Fixed values of the producer: all replicas acknowledge, idempotent, one request in flight.
PRODUCER = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.enable.idempotence": "true",
    "kafka.max.in.flight.requests.per.connection": "1",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
}


def source_options(servers: str, topic: str = TRANSACTIONS, starting: str = "latest",
                   min_partitions: int | None = None) -> dict[str, str]:
    """Reader options. Offsets live in the query's checkpoint, and each query has a group id of its own,
    given by Spark: queries that shared one could each get a part of the messages."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def sink_options(servers: str, topic: str = ALERTS) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **PRODUCER}


def read_stream(spark: SparkSession, servers: str, **options) -> DataFrame:
    """JSON text of a topic as the column `value`, with the broker's `timestamp` as `received`."""
    raw = spark.readStream.format("kafka").options(**source_options(servers, **options)).load()
    return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received"))


def to_records(df: DataFrame, key: str = "transaction_id", keep_nulls: bool = True) -> DataFrame:
    """Key and JSON value of each row; missing values are written as JSON null."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns), options).alias("value")
    )


def publish(records: DataFrame, servers: str, topic: str = TRANSACTIONS) -> None:
    """Batch publish of key/value records."""
    records.write.format("kafka").options(**sink_options(servers, topic)).save()


def alert_writer(alerts: DataFrame, servers: str, checkpoint: str, topic: str = ALERTS) -> DataStreamWriter:
    """Streaming alert sink. At least once: consumers drop repeats by transaction_id."""
    return (
        alerts.writeStream.format("kafka")
        .options(**sink_options(servers, topic))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
