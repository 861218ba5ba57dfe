"""Scans, sinks, projections and predicates on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.catalog.inputs import GAPPED, TX, gapped, transactions, vectors
from txwarden.catalog.registry import query
from txwarden.functions.expressions import event_time, is_alert, is_detected, label_text
from txwarden.operators.prepare import AmountScaler, align, prepare_training, project_features, target_column
from txwarden.operators.profile import class_balance
from txwarden.operators.sequence import head_rows, number_rows, send_gaps, sort_by_time, with_metadata
from txwarden.schemas import LABELLED
from txwarden.session import scratch_path
from txwarden.sources.kafka import to_records
from txwarden.sources.sinks import log_run, metrics_long
from txwarden.sources.tables import read_csv, read_transactions
from txwarden.streaming.alerts import alert_messages, alerts, dead_letters, decode, enrich, readable

CSV_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), *LABELLED.fields])
COLUMNS = ["event_id", "Time", "Amount", "Class", "score", "event_type"]


def _as_csv(rows: DataFrame) -> str:
    path = scratch_path(rows.sparkSession, "transactions-csv")
    rows.write.option("header", "true").csv(path)
    return path


def _plain(spark, folder) -> DataFrame:
    """Labels written as 0.0 and 1.0, a text column and a number that no schema declares."""
    return transactions(spark, folder).select(*COLUMNS).withColumn("Class", F.col("Class").cast("double"))


@query("S1 S11", TX + 'SELECT event_id, "Time", "Amount", "Class", score, event_type FROM tx')
def csv_scan(spark, folder) -> DataFrame:
    return read_csv(spark, _as_csv(_plain(spark, folder)), CSV_SCHEMA)


@query("S1", TX + 'SELECT event_id, "Time", "Amount", "Class", event_type FROM tx')
def csv_other_orders(spark, folder) -> DataFrame:
    """A folder whose files have their columns in different orders, read by name."""
    rows, path = _plain(spark, folder).drop("score"), scratch_path(spark, "transactions-csv")
    rows.where("event_id % 2 = 0").write.option("header", "true").csv(path)
    rows.where("event_id % 2 = 1").select(*reversed(rows.columns)).write.mode("append").option("header", "true").csv(path)
    return read_csv(spark, path, CSV_SCHEMA, by_name=True)


@query("S1", TX + """
SELECT event_type, count(*) AS n, CAST(count_if(event_type IN ('view', 'error')) AS BIGINT) AS malformed,
       CAST(count_if(event_type <> 'view') AS BIGINT) AS amounts, CAST(count_if(event_type <> 'error') AS BIGINT) AS labels FROM tx GROUP BY event_type""")
def csv_malformed(spark, folder) -> DataFrame:
    """Text where a number should be, and a label that is no whole number: NULL, marked, and counted."""
    rows = _plain(spark, folder)
    rows = rows.withColumn("Amount", F.when(F.col("event_type") == "view", F.lit("abc")).otherwise(F.col("Amount").cast("string")))
    rows = rows.withColumn("Class", F.when(F.col("event_type") == "error", F.lit(0.5)).otherwise(F.col("Class")))
    read = read_csv(spark, _as_csv(rows), CSV_SCHEMA, most_malformed=1.0, keep_malformed=True)
    return read.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count("_corrupt_record").alias("malformed"), F.count("Amount").alias("amounts"), F.count("Class").alias("labels"))


@query("S2 W1", TX + """
SELECT event_id, "Time", "Class", row_number() OVER (ORDER BY "Time", event_id) AS number FROM tx""")
def csv_scan_in_time_order(spark, folder) -> DataFrame:
    df = read_transactions(spark, _as_csv(_plain(spark, folder)), CSV_SCHEMA, by_time=True, tiebreak=["event_id"])
    return number_rows(df, ["Time", "event_id"]).select("event_id", "Time", "Class", "number")


# Event text as a producer would send it: known fields, two unknown ones, and cut-off text for sign-ups.
def _messages(spark, folder) -> DataFrame:
    tx = transactions(spark, folder)
    text = F.to_json(F.struct(
        F.col("Amount"), F.col("event_id").cast("string").alias("transaction_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), F.col("Class"),
        F.lit("kafka_producer_v1").alias("producer_id"),
    ))
    broken = F.expr("substring(value, 1, length(value) - 1)")
    return tx.select("event_id", "event_type", text.alias("value")).withColumn(
        "value", F.when(F.col("event_type") == "signup", broken).otherwise(F.col("value"))
    )


MESSAGE_SCHEMA = T.StructType(
    [T.StructField("Amount", T.DoubleType()), T.StructField("transaction_id", T.StringType()),
     T.StructField("timestamp", T.StringType())]
)


@query("P1", TX + """
SELECT CAST(event_id AS VARCHAR) AS transaction_id, "Amount", CAST(epoch_us(ts) // 1000 AS VARCHAR) AS "timestamp",
       make_timestamp(epoch_us(ts) // 1000 * 1000) AS event_time
FROM tx WHERE event_type <> 'signup'""")
def decoded_events(spark, folder) -> DataFrame:
    good = readable(decode(_messages(spark, folder), MESSAGE_SCHEMA))
    return good.select("transaction_id", "Amount", "timestamp", event_time("timestamp").cast("timestamp_ntz").alias("event_time"))


@query("P1", TX + """
SELECT '{"Amount":' || CAST("Amount" AS VARCHAR) || ',"transaction_id":"' || event_id || '","timestamp":' || CAST(epoch_us(ts) // 1000 AS VARCHAR)
       || ',"Class":' || "Class" || ',"producer_id":"kafka_producer_v1"' AS value
FROM tx WHERE event_type = 'signup'""")
def unreadable_events(spark, folder) -> DataFrame:
    return dead_letters(decode(_messages(spark, folder), MESSAGE_SCHEMA))


@query("P8 P10 P11", GAPPED + """
SELECT event_id, CASE WHEN "Amount" IS NULL OR user_id IS NULL THEN CAST(-1 AS DOUBLE) ELSE score END AS fraud_probability,
       CASE WHEN "Amount" IS NULL OR user_id IS NULL THEN FALSE ELSE score > 0.5 END AS fraud_detected,
       CASE WHEN "Amount" IS NULL AND user_id IS NULL THEN 'Processing error: missing Amount, user_id'
            WHEN "Amount" IS NULL THEN 'Processing error: missing Amount'
            WHEN user_id IS NULL THEN 'Processing error: missing user_id' END AS error
FROM gapped""")
def enriched_events(spark, folder) -> DataFrame:
    rows = gapped(spark, folder).withColumn("user_id", F.col("user_id").cast("double"))
    scored = enrich(rows, lambda d: d.withColumn("fraud_probability", F.col("score")), ["Amount", "user_id"])
    return scored.select("event_id", "fraud_probability", "fraud_detected", "error")


@query("P8 P9 P14", TX + """
SELECT event_id, score AS fraud_probability, score > 0.5 AS fraud_detected,
       CASE WHEN "Class" = 1 THEN 'FRAUD' ELSE 'NORMAL' END AS label
FROM tx WHERE score > 0.8""")
def alert_rows(spark, folder) -> DataFrame:
    tx = transactions(spark, folder)
    return tx.where(is_alert(F.col("score"))).select(
        "event_id", F.col("score").alias("fraud_probability"), is_detected(F.col("score")).alias("fraud_detected"),
        label_text(F.col("Class")).alias("label"),
    )


@query("S4 R1", TX + """
SELECT '{"event_id":' || event_id || ',"Amount":' || CAST("Amount" AS VARCHAR) || ',"fraud_probability":'
       || CAST(score AS VARCHAR) || ',"fraud_detected":true}' AS value
FROM tx WHERE score > 0.8""")
def alert_texts(spark, folder) -> DataFrame:
    rows = transactions(spark, folder).select("event_id", "Amount", "score")
    found = alerts(enrich(rows, lambda d: d.withColumn("fraud_probability", F.col("score")), ["Amount"]))
    return alert_messages(found.select("event_id", "Amount", "fraud_probability", "fraud_detected"))


@query("S5 P12 P13 W1", GAPPED + """
, numbered AS (SELECT *, row_number() OVER (ORDER BY event_id) AS number FROM gapped)
SELECT 'txn_' || lpad(CAST(number AS VARCHAR), 10, '0') AS "key",
       '{"user_id":' || coalesce(CAST(user_id AS VARCHAR), 'null') || ',"Amount":' || coalesce(CAST("Amount" AS VARCHAR), 'null')
       || ',"Class":' || "Class" || ',"transaction_id":"txn_' || lpad(CAST(number AS VARCHAR), 10, '0')
       || '","timestamp":1704067200000,"producer_id":"kafka_producer_v1"}' AS value
FROM numbered""")
def producer_records(spark, folder) -> DataFrame:
    rows = gapped(spark, folder).select("event_id", "user_id", F.coalesce("Amount", F.lit(float("nan"))).alias("Amount"), "Class")
    numbered = number_rows(rows, ["event_id"]).drop("event_id")
    return to_records(with_metadata(numbered, "number", F.lit("2024-01-01T00:00:00Z").cast("timestamp")))


@query("P2 P3 P5 A10 M1", TX + """
, fit AS (SELECT avg("Amount") AS m, stddev_pop("Amount") AS s FROM tx)
SELECT event_id, round(("Amount" - m) / s, 6) AS "Amount", "Class" FROM tx, fit""")
def scaled_training_rows(spark, folder) -> DataFrame:
    rows = transactions(spark, folder).select("event_id", "Time", "Amount", "Class")
    out, _ = prepare_training(rows)
    return out.withColumn("Amount", F.round("Amount", 6))


@query("P4 P5 M1", TX + """
, fit AS (SELECT avg("Amount") AS m, stddev_pop("Amount") AS s FROM tx WHERE "Class" = 0)
SELECT event_id, score, round(("Amount" - m) / s, 6) AS "Amount" FROM tx, fit""")
def scaled_inference_rows(spark, folder) -> DataFrame:
    tx = transactions(spark, folder)
    scaler = AmountScaler.fit(tx.where("Class = 0"))
    return project_features(scaler.transform(tx), ["event_id", "score", "Amount"]).withColumn("Amount", F.round("Amount", 6))


@query("P6 P7 U2", TX + """
SELECT 'reference' AS side, "Amount", CAST("Class" AS DOUBLE) AS target, count(*) AS n FROM tx GROUP BY ALL
UNION ALL
SELECT 'current', "Amount", score, count(*) FROM tx GROUP BY ALL""")
def aligned_tables(spark, folder) -> DataFrame:
    tx = transactions(spark, folder)
    reference = tx.select("Amount", "Class", "user_id")
    current = tx.select("Amount", F.col("score").alias("prediction"), "event_id")
    old, new, common = align(reference, current)
    both = old.withColumn("side", F.lit("reference")).withColumn("target", F.col("target").cast("double")).unionByName(
        new.withColumn("side", F.lit("current"))
    )
    return both.groupBy("side", *common, "target").agg(F.count("*").alias("n"))


@query("P7", 'SELECT count(*) AS n, 0 AS target FROM embeddings')
def dummy_target(spark, folder) -> DataFrame:
    rows = vectors(spark, folder)
    return rows.select(target_column(rows, "prediction")).groupBy("target").agg(F.count("*").alias("n"))


@query("P15 P16", TX + """
SELECT event_id, "Class", "Time" / 3600 AS hours, "Time" / 86400 AS days FROM tx WHERE "Class" = 1""")
def fraud_hours(spark, folder) -> DataFrame:
    return transactions(spark, folder).where("Class = 1").select(
        "event_id", "Class", (F.col("Time") / 3600).alias("hours"), (F.col("Time") / 86400).alias("days")
    )


@query("S9", TX + """
SELECT 'balance' AS run_id, 'metric' AS kind, u.key, round(u.number, 6) AS number FROM (
  SELECT CAST(sum("Class") AS DOUBLE) AS fraud_count, CAST(count(*) AS DOUBLE) AS total_count,
         sum("Class") / count(*) * 100 AS fraud_rate, (count(*) - sum("Class")) / sum("Class") AS imbalance_ratio FROM tx) t,
  LATERAL (VALUES ('fraud_count', fraud_count), ('total_count', total_count), ('fraud_rate', fraud_rate),
                  ('imbalance_ratio', imbalance_ratio)) AS u(key, number)""")
def logged_run(spark, folder) -> DataFrame:
    path = scratch_path(spark, "runs")
    metrics_long(class_balance(transactions(spark, folder)), "balance").write.mode("append").parquet(path)
    log_run(spark, path, "other", {"depth": 6}, {"fraud_rate": 0.5})
    stored = spark.read.parquet(path).where("run_id = 'balance'")
    return stored.select("run_id", "kind", "key", F.round(F.col("value").try_cast("double"), 6).alias("number"))


# The last row has no successor and waits the fixed delay.
CLAMPED = """CASE WHEN gap IS NULL THEN CAST(0.1 AS DOUBLE)
       ELSE least(greatest(gap, CAST(0.001 AS DOUBLE)), CAST(1 AS DOUBLE)) END"""


@query("W2 T1", TX + """
, near AS (SELECT event_id, "Time", (lead("Time") OVER (ORDER BY "Time", event_id) - "Time") * CAST(0.01 AS DOUBLE) AS gap FROM tx)
SELECT event_id, "Time", """ + CLAMPED + " AS gap_seconds FROM near")
def send_gaps_overall(spark, folder) -> DataFrame:
    return send_gaps(transactions(spark, folder).select("event_id", "Time"), "Time", "event_id")


@query("W2", TX + """
, near AS (SELECT event_id, user_id, (lead("Time") OVER (PARTITION BY user_id ORDER BY "Time", event_id) - "Time") * CAST(0.01 AS DOUBLE) AS gap
           FROM tx)
SELECT event_id, user_id, """ + CLAMPED + " AS gap_seconds FROM near")
def send_gaps_by_user(spark, folder) -> DataFrame:
    rows = transactions(spark, folder).select("event_id", "user_id", "Time")
    return send_gaps(rows, "Time", "event_id", ["user_id"]).select("event_id", "user_id", "gap_seconds")


@query("T4", TX + 'SELECT event_id, "Time", "Amount", "Class" FROM tx ORDER BY "Time", event_id LIMIT 5')
def first_rows(spark, folder) -> DataFrame:
    return head_rows(transactions(spark, folder).select("event_id", "Time", "Amount", "Class"), ["Time", "event_id"])


@query("T1", TX + 'SELECT event_id, "Time", "Amount" FROM tx ORDER BY "Time", event_id')
def rows_in_time_order(spark, folder) -> DataFrame:
    return sort_by_time(transactions(spark, folder).select("event_id", "Time", "Amount"), tiebreak=["event_id"])
