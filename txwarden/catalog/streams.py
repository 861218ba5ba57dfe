"""Streaming jobs over the event table, run until all of it is processed."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.catalog.inputs import TX, table, transactions
from txwarden.catalog.registry import query
from txwarden.operators.prepare import AmountScaler
from txwarden.operators.sketches import RANK_ERROR, latency_of_sketches, step_sketches
from txwarden.plans.training import fit_model, score_rows
from txwarden.session import scratch_path
from txwarden.sources.sinks import load_model, save_model
from txwarden.streaming.alerts import Outputs, alerts, enrich, file_writer, read_stream_table, run_available, scored_writer
from txwarden.streaming.compaction import clean_log, fold_log
from txwarden.streaming.counters import counter_rates, step_summaries
from txwarden.streaming.inference_log import append_log, log_writer, read_log
from txwarden.streaming.rates import batch_rate, detected_total, latest_rows, latest_writer, minute_counts, rates_of_minutes
from txwarden.streaming.stateful import drop_repeats, numbered_writer


def _stream(spark, folder) -> DataFrame:
    schema = table(spark, folder, "events").schema
    rows = read_stream_table(spark, folder, schema, "events.parquet")
    return rows.withColumn("score", F.get_json_object("props", "$.k").cast("int") / F.lit(100.0))


def _scored(spark, folder) -> DataFrame:
    rows = _stream(spark, folder).select("event_id", "event_type", F.col("value").alias("Amount"), "score")
    return enrich(rows, lambda d: d.withColumn("fraud_probability", F.col("score")), ["Amount"])


@query("R1", TX + 'SELECT event_id, "Amount", score AS fraud_probability, score > 0.5 AS fraud_detected FROM tx WHERE score > 0.8')
def streamed_alerts(spark, folder) -> DataFrame:
    out = scratch_path(spark, "alerts")
    found = alerts(_scored(spark, folder)).select("event_id", "Amount", "fraud_probability", "fraud_detected")
    run_available(file_writer(found, out, scratch_path(spark, "alerts-checkpoint")))
    return spark.read.schema(found.schema).parquet(out)


LOG = 'SELECT event_id, "Amount", score AS prediction, score > 0.5 AS fraud_detected, TRUE AS stamped FROM tx'


def _logged(spark, path) -> DataFrame:
    stamped = F.col("prediction_id").isNotNull() & F.col("timestamp").isNotNull()
    return read_log(spark, path).select("event_id", "Amount", "prediction", "fraud_detected", stamped.alias("stamped"))


@query("S6 P8", TX + LOG)
def streamed_log(spark, folder) -> DataFrame:
    out = scratch_path(spark, "inference-log")
    run_available(log_writer(_scored(spark, folder).select("event_id", "Amount", "fraud_probability"), out, scratch_path(spark, "log-checkpoint")))
    return _logged(spark, out)


@query("S6", TX + f"{LOG} UNION ALL {LOG} UNION ALL {LOG} WHERE score > 0.8")
def streamed_log_two_runs(spark, folder) -> DataFrame:
    """Two queries with checkpoints of their own and a batch append share one log: it holds the rows of all three."""
    out = scratch_path(spark, "inference-log")
    rows = _scored(spark, folder).select("event_id", "Amount", "fraud_probability")
    for _ in range(2):
        run_available(log_writer(rows, out, scratch_path(spark, "log-checkpoint")))
    batch = transactions(spark, folder).select("event_id", "Amount", F.col("score").alias("fraud_probability"))
    append_log(batch.where("fraud_probability > 0.8"), out)
    return _logged(spark, out)


@query("S6", TX + f"{LOG} UNION ALL {LOG} UNION ALL {LOG} WHERE score > 0.8")
def streamed_log_folded(spark, folder) -> DataFrame:
    """A log of many batches, folded after the first run and again after a second one and an append, then cleaned."""
    out, source = scratch_path(spark, "inference-log"), scratch_path(spark, "log-events")
    events = table(spark, folder, "events")
    events.repartition(6).write.parquet(source)
    score = F.get_json_object("props", "$.k").cast("int") / F.lit(100.0)
    rows = read_stream_table(spark, source, events.schema, maxFilesPerTrigger=2)
    rows = rows.select("event_id", F.col("value").alias("Amount"), score.alias("fraud_probability"))
    for _ in range(2):
        run_available(log_writer(rows, out, scratch_path(spark, "log-checkpoint")))
        fold_log(spark, out)
    batch = transactions(spark, folder).select("event_id", "Amount", F.col("score").alias("fraud_probability"))
    append_log(batch.where("fraud_probability > 0.8"), out)
    fold_log(spark, out)
    clean_log(spark, out, keep_seconds=0)
    return _logged(spark, out)


@query("A28", TX + "SELECT CAST(count_if(score > 0.5) AS BIGINT) AS detected FROM tx")
def streamed_detections(spark, folder) -> DataFrame:
    out = scratch_path(spark, "detections")
    run_available(latest_writer(detected_total(_stream(spark, folder), "score"), out, scratch_path(spark, "detections-checkpoint")))
    return latest_rows(spark.read.parquet(out), [])


@query("A28", TX + "SELECT CAST(count_if(score > 0.5) AS BIGINT) AS detected FROM tx WHERE event_type <> 'error'")
def streamed_detections_two_runs(spark, folder) -> DataFrame:
    """A first run over all events in several batches, then a fresh one over fewer: the state of the fresh one counts."""
    out, source = scratch_path(spark, "detections"), scratch_path(spark, "detection-events")
    table(spark, folder, "events").repartition(3).write.parquet(source)
    schema = table(spark, folder, "events").schema
    score = F.get_json_object("props", "$.k").cast("int") / F.lit(100.0)
    rows = read_stream_table(spark, source, schema, maxFilesPerTrigger=1)
    run_available(latest_writer(detected_total(rows, score), out, scratch_path(spark, "detections-checkpoint")))
    fewer = _stream(spark, folder).where("event_type <> 'error'")
    run_available(latest_writer(detected_total(fewer, "score"), out, scratch_path(spark, "detections-checkpoint")))
    return latest_rows(spark.read.parquet(out), [])


EVENT_FIELDS = T.StructType([T.StructField("Amount", T.DoubleType()), T.StructField("Size", T.DoubleType()), T.StructField("transaction_id", T.StringType())])


@query("R1 P1 P9 P10 M4 S10", TX + """
SELECT count(*) AS messages, CAST(count_if(event_type = 'signup') AS BIGINT) AS dead,
       CAST(count_if(event_type = 'view') AS BIGINT) AS failed, CAST(count_if(event_type NOT IN ('signup', 'view')) AS BIGINT) AS scored,
       CAST(0 AS BIGINT) AS outside, TRUE AS each_once, TRUE AS alerts_are_logged FROM tx""")
def streamed_scoring(spark, folder) -> DataFrame:
    """JSON messages through a saved model: each one ends in exactly one of log and dead letters, and alerts are the
    logged rows above the limit. Sign-ups are cut off, views lack a feature."""
    tx = transactions(spark, folder)
    sized = tx.withColumn("Size", F.length("event_type").cast("double"))
    path = scratch_path(spark, "stream-model")
    save_model(fit_model(LogisticRegression(maxIter=100), sized, ["Amount", "Size"]), path)
    model = load_model(path)
    text = F.to_json(F.struct("Amount", F.when(F.col("event_type") != "view", F.col("Size")).alias("Size"), F.col("event_id").cast("string").alias("transaction_id")))
    cut = F.when(F.col("event_type") == "signup", F.concat(F.lit("{"), F.col("event_id").cast("string"))).otherwise(text)
    source = scratch_path(spark, "messages")
    sized.select(cut.alias("value")).write.text(source)
    outputs = Outputs(*[scratch_path(spark, name) for name in ("scored-log", "scored-dead", "scored-alerts")])
    messages = spark.readStream.text(source)
    run_available(scored_writer(messages, lambda rows: score_rows(model, rows), outputs, scratch_path(spark, "scored-checkpoint"),
                                above=0.5, schema=EVENT_FIELDS, features=["Amount", "Size"]))
    log = read_log(spark, outputs.log).persist()
    dead = spark.read.schema("value string").json(outputs.dead)
    found = spark.read.schema("value string").json(outputs.alerts).select(F.get_json_object("value", "$.transaction_id").alias("id"))
    ids = log.select(F.col("transaction_id").alias("id")).union(dead.select(F.substring("value", 2, 20).alias("id")))
    want = tx.select(F.col("event_id").cast("string").alias("id"))
    once = ids.exceptAll(want).isEmpty() and want.exceptAll(ids).isEmpty()
    above = log.where("prediction > 0.5").select(F.col("transaction_id").alias("id"))
    same = found.exceptAll(above).isEmpty() and above.exceptAll(found).isEmpty()
    p = F.col("prediction")
    facts = log.agg(F.count_if(p == -1).alias("failed"), F.count_if(p >= 0).alias("scored"), F.count_if((p != -1) & ((p < 0) | (p > 1))).alias("outside"))
    return facts.select(
        F.lit(want.count()).alias("messages"), F.lit(dead.count()).alias("dead"), "failed", "scored", "outside",
        F.lit(once).alias("each_once"), F.lit(same).alias("alerts_are_logged"),
    )


RATES = """
SELECT date_trunc('minute', ts) - INTERVAL (k) MINUTE AS window_start, date_trunc('minute', ts) + INTERVAL (5 - k) MINUTE AS window_end,
       event_type, count(*) AS n, count(*) / CAST(300 AS DOUBLE) AS per_second FROM tx, range(5) r(k) GROUP BY ALL"""


def _plain(rates: DataFrame) -> DataFrame:
    return rates.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("R2", TX + RATES)
def event_rates(spark, folder) -> DataFrame:
    return _plain(batch_rate(transactions(spark, folder), "ts", ["event_type"]))


@query("R2", TX + RATES)
def streamed_rates(spark, folder) -> DataFrame:
    """The stream keeps counts per minute; the sliding windows are made of those."""
    out = scratch_path(spark, "rates")
    minutes = minute_counts(_stream(spark, folder), "ts", ["event_type"], late="10 minutes")
    run_available(latest_writer(minutes, out, scratch_path(spark, "rates-checkpoint")))
    newest = latest_rows(spark.read.parquet(out), ["minute", "event_type"])
    return _plain(rates_of_minutes(newest, ["event_type"]))


@query("R1 M1", TX + """
, fit AS (SELECT avg("Amount") AS m, stddev_pop("Amount") AS s FROM tx)
SELECT event_id, round(("Amount" - m) / s, 6) AS scaled FROM tx, fit WHERE score > 0.8""")
def streamed_scaling(spark, folder) -> DataFrame:
    """The saved scaler stage inside a stream."""
    stage = AmountScaler.fit(transactions(spark, folder)).as_stage("scaled")
    out = scratch_path(spark, "scaled")
    found = stage.transform(alerts(_scored(spark, folder))).select("event_id", F.round("scaled", 6).alias("scaled"))
    run_available(file_writer(found, out, scratch_path(spark, "scaled-checkpoint")))
    return spark.read.schema(found.schema).parquet(out)


COUNTED = TX + """
, samples AS (SELECT DISTINCT event_type, epoch_us(ts) AS t, score * 100 AS v FROM tx),
inside AS (SELECT event_type, t, v, (t // 3600000000 - k) * 3600000000 AS start FROM samples, range(24) r(k)),
steps AS (SELECT *, lag(v) OVER (PARTITION BY event_type, start ORDER BY t, v) AS p FROM inside),
sums AS (SELECT event_type, start, count(*) AS n, min(t) AS a, max(t) AS z, arg_min(v, {'t': t, 'v': v}) AS v,
  arg_max(v, {'t': t, 'v': v}) - arg_min(v, {'t': t, 'v': v}) + sum(CASE WHEN v < p THEN p ELSE 0 END) AS rise FROM steps GROUP BY ALL HAVING n > 1 AND z > a),
sides AS (SELECT *, (z - a) / 1e6 AS covered, (z - a) / 1e6 / (n - 1) AS gap, (start + 86400000000 - z) / 1e6 AS after,
  least((a - start) / 1e6, CASE WHEN rise > 0 AND v >= 0 THEN (z - a) / 1e6 * (v / rise) END) AS before FROM sums),
rates AS (SELECT *, rise * ((covered + CASE WHEN before < gap * 1.1 THEN before ELSE gap / 2 END + CASE WHEN after < gap * 1.1 THEN after ELSE gap / 2 END) / covered) AS increase FROM sides)
SELECT make_timestamp(start) AS window_start, make_timestamp(start + 86400000000) AS window_end, event_type, n,
  round(increase, 5) AS increase, round(increase / 86400, 9) AS per_second FROM rates"""


def _rounded(rates: DataFrame) -> DataFrame:
    return _plain(rates).withColumns({"increase": F.round("increase", 5), "per_second": F.round("per_second", 9)})


@query("R2", COUNTED)
def counter_increases(spark, folder) -> DataFrame:
    """The scores of each kind of event as a counter that often restarts: its rate over a day, every hour."""
    samples = transactions(spark, folder).withColumn("v", F.col("score") * 100)
    return _rounded(counter_rates(step_summaries(samples, "ts", "v", ["event_type"], "1 hour"), ["event_type"], "1 day", "1 hour"))


@query("R2", COUNTED)
def streamed_counter_increases(spark, folder) -> DataFrame:
    """The same from a stream whose files each hold samples of all hours, and some samples twice."""
    out, source = scratch_path(spark, "counters"), scratch_path(spark, "samples")
    rows = table(spark, folder, "events")
    rows.union(rows.where("event_id % 3 = 0")).repartition(3).write.parquet(source)
    stream = read_stream_table(spark, source, rows.schema, maxFilesPerTrigger=1)
    samples = stream.withColumn("v", F.get_json_object("props", "$.k").cast("int") / F.lit(100.0) * 100)
    summaries = step_summaries(samples, "ts", "v", ["event_type"], "1 hour", late="1000 days")
    run_available(latest_writer(summaries, out, scratch_path(spark, "counters-checkpoint")))
    newest = latest_rows(spark.read.parquet(out), ["slice", "event_type"])
    return _rounded(counter_rates(newest, ["event_type"], "1 day", "1 hour"))


@query("S4 S5", TX + 'SELECT event_id, "Amount", score AS fraud_probability FROM tx WHERE score > 0.8')
def alerts_once(spark, folder) -> DataFrame:
    """Alerts of a sink that sent its first batch twice and all of them once more at the end: each is read once."""
    source, out = scratch_path(spark, "sent-alerts"), scratch_path(spark, "alerts-once")
    sent = transactions(spark, folder).where("score > 0.8").select("event_id", "Amount", F.col("score").alias("fraud_probability"), "ts")
    for part in (sent.where("event_id % 2 = 0"), sent.where("event_id % 2 = 0"), sent.where("event_id % 2 = 1"), sent):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = read_stream_table(spark, source, sent.schema, maxFilesPerTrigger=1)
    once = drop_repeats(stream, "event_id", "ts", "1000 days").drop("ts")
    run_available(file_writer(once, out, scratch_path(spark, "once-checkpoint")))
    return spark.read.schema(once.schema).parquet(out)


@query("W1", "SELECT count(*) AS n, count(*) AS numbers, CAST(1 AS BIGINT) AS lowest, count(*) AS highest, count(*) AS events FROM events")
def numbered_stream(spark, folder) -> DataFrame:
    """Events numbered over the batches of a stream and a restart: every number from 1 on once, every event once."""
    source, out = scratch_path(spark, "unnumbered"), scratch_path(spark, "numbered")
    state, checkpoint = scratch_path(spark, "numbers"), scratch_path(spark, "numbers-checkpoint")
    rows = table(spark, folder, "events").select("event_id", "ts")
    for half in (0, 1):
        rows.where(F.col("event_id") % 2 == half).repartition(2).write.mode("append").parquet(source)
        stream = read_stream_table(spark, source, rows.schema, maxFilesPerTrigger=1)
        run_available(numbered_writer(stream, ["ts", "event_id"], out, state, checkpoint))
    found = spark.read.parquet(out)
    return found.agg(
        F.count("*").alias("n"), F.count_distinct("number").alias("numbers"), F.min("number").alias("lowest"), F.max("number").alias("highest"),
        F.count_distinct("event_id").alias("events"))


@query("A33 A9", TX + """
SELECT user_id % 7 AS shard, count(*) AS requests, TRUE AS p95_within, TRUE AS p99_within, round(avg("Amount"), 6) AS mean_ms,
       round(sum("Class") / count(*), 9) AS error_rate FROM tx GROUP BY 1""")
def sketched_latency(spark, folder) -> DataFrame:
    """Hourly sketches kept by a stream, merged: the share of exact values below each percentile, against three times the
    sketch's error."""
    out = scratch_path(spark, "latency-sketches")
    stream = _stream(spark, folder).select("ts", (F.col("user_id") % 7).alias("shard"), "value", (F.col("event_type") == "error").alias("failed"))
    hours = step_sketches(stream, "ts", "value", "failed", ["shard"], "1 hour", late="1000 days")
    run_available(latest_writer(hours, out, scratch_path(spark, "sketches-checkpoint")))
    report = latency_of_sketches(latest_rows(spark.read.parquet(out), ["slice", "shard"]), ["shard"])
    exact = transactions(spark, folder).select((F.col("user_id") % 7).alias("shard"), "Amount").join(report, "shard")
    share = lambda c: F.count_if(F.col("Amount") < F.col(c)) / F.count("*")
    upto = lambda c: F.count_if(F.col("Amount") <= F.col(c)) / F.count("*")
    near = lambda c, p: ((share(c) <= p + 3 * RANK_ERROR) & (upto(c) >= p - 3 * RANK_ERROR))
    return exact.groupBy("shard").agg(
        F.max("requests").alias("requests"), near("p95_ms", 0.95).alias("p95_within"), near("p99_ms", 0.99).alias("p99_within"),
        F.round(F.max("mean_ms"), 6).alias("mean_ms"), F.round(F.max("error_rate"), 9).alias("error_rate"))
