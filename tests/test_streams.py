import json

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.functions.expressions import event_time
from txwarden.operators.sequence import number_rows, send_gaps, with_metadata
from txwarden.plans.training import fit_model
from txwarden.schemas import EVENT, FEATURES
from txwarden.sources import kafka
from txwarden.sources.sinks import load_model, log_run, save_model
from txwarden.streaming import alerts as a
from txwarden.streaming.inference_log import append_log, log_rows, log_writer, read_log, write_log
from txwarden.streaming.rates import batch_rate, detected_total, keep_latest, latest_rows, latest_writer, windowed_rate


def event(i, amount=100.0, **extra):
    return {**{f"V{k}": 0.1 * k for k in range(1, 29)}, "Amount": amount, "transaction_id": f"t{i}",
            "timestamp": "2024-01-01T00:00:00", **extra}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(*[float((i * k) % 7) for k in range(28)], float(i), int(i >= 50)) for i in range(100)]
    train = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in FEATURES) + ", Class int")
    return fit_model(LogisticRegression(maxIter=30), train, FEATURES)


def test_decode_keeps_known_fields_and_routes_bad_text(spark):
    texts = [json.dumps(event(1, Time=5, Class=1, producer_id="p")), '{"V1": 0.1', "plain", None, json.dumps({"V1": "x"})]
    decoded = a.decode(spark.createDataFrame([(t,) for t in texts], "value string")).cache()
    good = a.readable(decoded).collect()
    assert len(good) == 1 and good[0]["transaction_id"] == "t1" and "Class" not in good[0].asDict()
    assert a.readable(decoded).columns == EVENT.fieldNames()
    assert sorted(r["value"] for r in a.dead_letters(decoded).collect()) == sorted(["", '{"V1": 0.1', "plain", '{"V1": "x"}'])


def test_two_rows_get_two_scores(spark, model):
    df = spark.createDataFrame([(event(i, amount),) for i, amount in ((1, 10.0), (2, 90.0))], T.StructType([T.StructField("e", EVENT)]))
    out = a.enrich_with_model(df.select("e.*"), model).collect()
    assert len(out) == 2 and all(0.0 <= r["fraud_probability"] <= 1.0 and r["error"] is None for r in out)
    assert all(r["fraud_detected"] == (r["fraud_probability"] > 0.5) for r in out)


def test_missing_features_fail_the_row_only(spark, model):
    texts = [json.dumps({"V1": 0.1, "transaction_id": "short"}), json.dumps(event(2)), json.dumps(event(3, amount=None))]
    rows = a.readable(a.decode(spark.createDataFrame([(t,) for t in texts], "value string")))
    out = {r["transaction_id"]: r for r in a.enrich_with_model(rows, model).collect()}
    assert out["short"]["fraud_probability"] == -1.0 and not out["short"]["fraud_detected"] and "V2" in out["short"]["error"]
    assert out["t3"]["error"] == "Processing error: missing Amount" and out["t2"]["error"] is None


def test_no_score_is_a_failure(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 0.9)], "Amount double, s double")
    out = a.enrich(df, lambda d: d.withColumn("fraud_probability", F.col("s")), ["Amount"]).collect()
    assert [r["fraud_probability"] for r in out] == [-1.0, 0.9] and out[0]["error"] == "Processing error: no score"


def test_alert_limit_is_strict(spark):
    df = spark.createDataFrame([(0.8,), (0.81,), (None,), (-1.0,)], "fraud_probability double")
    assert [r[0] for r in a.alerts(df).collect()] == [0.81]
    assert a.alerts(df, 0.5).count() == 2


def test_alert_stream_with_a_saved_model(spark, model, tmp_path):
    save_model(model, str(tmp_path / "model"))
    loaded = load_model(str(tmp_path / "model"))
    (tmp_path / "in").mkdir()
    lines = [json.dumps(event(i, amount=float(i * 10))) for i in range(20)] + ["broken"]
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines))
    source = spark.readStream.text(str(tmp_path / "in"))
    scorer = lambda rows: a.score_rows(loaded, rows)
    job = a.alert_job(source, scorer, above=0.5)
    a.run_available(a.file_writer(job, str(tmp_path / "out"), str(tmp_path / "cp"), "json"))
    got = [json.loads(r["value"]) for r in spark.read.json(str(tmp_path / "out")).collect()]
    batch = a.alert_job(spark.read.text(str(tmp_path / "in")), scorer, above=0.5)
    assert sorted(g["transaction_id"] for g in got) == sorted(json.loads(r["value"])["transaction_id"] for r in batch.collect())
    assert got and all(g["fraud_detected"] and g["fraud_probability"] > 0.5 for g in got)
    # the same checkpoint goes on where it stopped
    (tmp_path / "in" / "b.txt").write_text(json.dumps(event(99, amount=1000.0)))
    a.run_available(a.file_writer(job, str(tmp_path / "out"), str(tmp_path / "cp"), "json"))
    assert spark.read.json(str(tmp_path / "out")).count() == len(got) + 1


def test_both_time_encodings(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:01",), ("1704067201000",), ("soon",), (None,)], "t string")
    assert [str(r[0]) for r in df.select(event_time("t").cast("string")).collect()] == ["2024-01-01 00:00:01"] * 2 + ["None"] * 2


def test_log_keeps_the_rows_of_all_runs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"Amount": 1.0, "fraud_probability": 0.9}\n{"Amount": 2.0, "fraud_probability": 0.1}')
    source = spark.readStream.schema("Amount double, fraud_probability double").json(str(tmp_path / "in"))
    log = str(tmp_path / "log")
    for checkpoint in ("c1", "c2", "c2"):  # the third start finds nothing new
        a.run_available(log_writer(source, log, str(tmp_path / checkpoint)))
    append_log(spark.createDataFrame([(3.0, 0.7)], "Amount double, fraud_probability double"), log)
    rows = read_log(spark, log)
    assert rows.count() == 5 and rows.select("prediction_id").distinct().count() == 3 and "batch" not in rows.columns
    assert rows.where("fraud_detected").count() == 3


def test_a_replayed_batch_replaces_its_rows(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, 0.9), (2.0, 0.1)], "Amount double, fraud_probability double")
    for _ in range(2):
        write_log(rows, str(tmp_path / "l"), "run", 7)
    assert read_log(spark, str(tmp_path / "l")).count() == 2


def test_batch_log(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 0.7)], "Amount double, fraud_probability double")
    append_log(df, str(tmp_path / "l"))
    append_log(df, str(tmp_path / "l"))
    assert read_log(spark, str(tmp_path / "l")).count() == 2
    assert log_rows(df, "p", "2024-01-01T00:00:00").columns == ["Amount", "prediction", "prediction_id", "timestamp", "fraud_detected"]


def test_a_fresh_run_replaces_the_running_state(spark, tmp_path):
    schema = "score double"
    for k in range(3):
        spark.createDataFrame([(0.9,)] * 10, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "old"))
    spark.createDataFrame([(0.9,)] * 10, schema).coalesce(1).write.parquet(str(tmp_path / "new"))
    out = str(tmp_path / "o")
    for name, options in (("old", {"maxFilesPerTrigger": 1}), ("new", {})):
        source = spark.readStream.schema(schema).options(**options).parquet(str(tmp_path / name))
        a.run_available(latest_writer(detected_total(source, "score"), out, str(tmp_path / f"c-{name}")))
    assert latest_rows(spark.read.parquet(out), []).first()["detected"] == 10
    keep_latest(spark, out, [], str(tmp_path / "kept"))
    assert [r["detected"] for r in spark.read.parquet(str(tmp_path / "kept")).collect()] == [10]


def test_append_rates_equal_batch_once_closed(spark, tmp_path):
    rows = [(f"2024-01-01 00:{m:02d}:{s:02d}", "x") for m in range(0, 20) for s in (5, 35)]
    df = spark.createDataFrame(rows, "ts string, kind string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    closing = spark.createDataFrame([("2024-01-02 00:00:00", "x")], "ts string, kind string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    writer = lambda: a.file_writer(windowed_rate(source, "ts", ["kind"], late="1 minute"), str(tmp_path / "o"), str(tmp_path / "c"))
    a.run_available(writer())
    closing.write.mode("append").parquet(str(tmp_path / "in"))
    a.run_available(writer())
    got = spark.read.parquet(str(tmp_path / "o"))
    want = batch_rate(df, "ts", ["kind"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() == 24
    assert got.agg(F.max("n")).first()[0] == 10 and got.agg(F.max("per_second")).first()[0] == pytest.approx(10 / 300)


def test_running_detections(spark, tmp_path):
    schema = "score double"
    spark.createDataFrame([(0.9,), (0.5,), (0.6,)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    for _ in range(2):
        a.run_available(latest_writer(detected_total(source, "score"), str(tmp_path / "o"), str(tmp_path / "c")))
        spark.createDataFrame([(0.7,)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    assert latest_rows(spark.read.parquet(str(tmp_path / "o")), []).first()["detected"] == 3


def test_messages(spark):
    df = spark.createDataFrame([(1.0, 10.0, 0), (0.0, float("nan"), 1)], "Time double, Amount double, Class int")
    numbered = number_rows(df, ["Time", "Class"])
    at = F.lit("2024-01-01T00:00:00Z").cast("timestamp")
    got = {r["key"]: json.loads(r["value"]) for r in kafka.to_records(with_metadata(numbered, "number", at)).collect()}
    assert set(got) == {"txn_0000000001", "txn_0000000002"}
    first = got["txn_0000000001"]
    assert first["Amount"] is None and first["Class"] == 1 and first["timestamp"] == 1704067200000
    assert first["producer_id"] == "kafka_producer_v1" and isinstance(first["timestamp"], int)


def test_gaps(spark):
    df = spark.createDataFrame([(0.0, 1), (0.01, 2), (50.0, 3), (500.0, 4)], "Time double, id bigint")
    got = [r["gap_seconds"] for r in send_gaps(df, "Time", "id").orderBy("id").collect()]
    assert got == pytest.approx([0.001, 0.4999, 1.0, 0.1])


def test_kafka_options():
    source = kafka.source_options("h:1", min_partitions=6)
    assert source["subscribe"] == "transactions" and source["startingOffsets"] == "latest" and source["minPartitions"] == "6"
    assert "kafka.group.id" not in source
    sink = kafka.sink_options("h:1")
    assert sink["topic"] == "fraud_alerts" and sink["kafka.acks"] == "all" and sink["kafka.enable.idempotence"] == "true"


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    log_run(spark, path, "a", {"depth": 6}, {"auc": 0.5}, {"kind": "x"})
    log_run(spark, path, "b", metrics={"auc": 0.75})
    rows = {(r["run_id"], r["kind"], r["key"]): r["value"] for r in spark.read.parquet(path).collect()}
    assert rows == {("a", "param", "depth"): "6", ("a", "metric", "auc"): "0.5", ("a", "tag", "kind"): "x", ("b", "metric", "auc"): "0.75"}
