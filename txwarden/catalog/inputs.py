"""The given tables in the transaction layout, and the same mapping as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as transactions: Amount = value, Class = error events, score = k / 100, Time in seconds."""
    events = table(spark, folder, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    start = events.agg(F.min(micros).alias("m"))
    return events.select(
        "event_id", "user_id", ((micros - start.scalar()) / F.lit(1e6)).alias("Time"), F.col("value").alias("Amount"),
        (F.col("event_type") == "error").cast("int").alias("Class"),
        (F.get_json_object("props", "$.k").cast("int") / F.lit(100.0)).alias("score"), "ts", "event_type",
    )


TX = """
WITH tx AS (
  SELECT event_id, user_id, (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) / CAST(1e6 AS DOUBLE) AS "Time",
         value AS "Amount", CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS "Class",
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) / CAST(100 AS DOUBLE) AS score, ts, event_type
  FROM events)
"""


def gapped(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with missing amounts and user ids, as real logs have them."""
    tx = transactions(spark, folder)
    return tx.select(
        "event_id", F.when(F.col("event_type") != "signup", F.col("user_id")).alias("user_id"),
        F.when(F.col("event_type") != "view", F.col("Amount")).alias("Amount"), "Class", "score", "event_type",
    )


GAPPED = TX + """, gapped AS (
  SELECT event_id, CASE WHEN event_type <> 'signup' THEN user_id END AS user_id,
         CASE WHEN event_type <> 'view' THEN "Amount" END AS "Amount", "Class", score, event_type FROM tx)
"""


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as transactions: Amount = price, Class = returned, score from price and discount."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").alias("V1"),
        F.col("l_discount").alias("V2"), F.col("l_tax").alias("V3"), F.col("l_extendedprice").alias("Amount"),
        (F.col("l_returnflag") == "R").cast("int").alias("Class"),
        (F.col("l_extendedprice") / F.lit(200000.0)).alias("score"), "l_shipdate", "l_returnflag", "l_linestatus",
    )


SALES = """
WITH sales AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity AS "V1", l_discount AS "V2", l_tax AS "V3",
         l_extendedprice AS "Amount", CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS "Class",
         l_extendedprice / CAST(200000 AS DOUBLE) AS score, l_shipdate, l_returnflag, l_linestatus
  FROM lineitem)
"""


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as labelled rows: V1..V64, Class = (label = 0)."""
    return table(spark, folder, "embeddings").select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(f"V{i + 1}") for i in range(64)],
        (F.col("label") == 0).cast("int").alias("Class"), "label",
    )
