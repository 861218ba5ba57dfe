"""Job entry points on files; Kafka itself is not available here."""

import json

import numpy as np
import pytest

from txwarden import jobs
from txwarden.schemas import COMPONENTS, FEATURES


@pytest.fixture(scope="module")
def card_csv(tmp_path_factory):
    rng = np.random.default_rng(42)
    lines = [",".join(["Time", *FEATURES, "Class"])]
    for i in range(1200):
        v = rng.normal(size=28)
        label = int(v[0] + 0.2 * rng.normal() > 1.6)
        lines.append(",".join([str(1200 - i), *[f"{x:.6f}" for x in v], f"{rng.lognormal(3, 1.5):.2f}", str(label)]))
    path = tmp_path_factory.mktemp("data") / "card.csv"
    path.write_text("\n".join(lines))
    return path


@pytest.fixture(scope="module")
def model_path(spark, card_csv, tmp_path_factory):
    out = tmp_path_factory.mktemp("model")
    jobs.main(["train", "--data", str(card_csv), "--model", str(out / "m"), "--runs", str(out / "runs"),
               "--importances", str(out / "i"), "--trees", "4"], spark)
    assert spark.read.parquet(str(out / "runs")).where("key = 'roc_auc'").count() == 1
    assert spark.read.option("header", "true").csv(str(out / "i")).count() == 29
    return str(out / "m")


def test_quick_training_samples_rows(spark, card_csv, tmp_path):
    done = jobs.main(["train", "--data", str(card_csv), "--runs", str(tmp_path / "r"), "--trees", "2", "--quick", "600"], spark)
    sizes = {r["key"]: int(r["value"]) for r in spark.read.parquet(str(tmp_path / "r")).where("key LIKE '%samples'").collect()}
    assert sum(sizes.values()) == 600 and done["metrics"]["roc_auc"] > 0.6


def test_alert_job_writes_alerts_log_and_dead_letters(spark, model_path, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{**{c: 3.0 if fraud else -1.0 for c in COMPONENTS}, "Amount": 10.0, "transaction_id": f"t{fraud}", "timestamp": "1"}
            for fraud in (0, 1)]
    (tmp_path / "in" / "a").write_text("\n".join([*map(json.dumps, rows), "{"]))
    decoded = spark.createDataFrame([tuple(r[c] for c in FEATURES) for r in rows], ", ".join(f"{c} double" for c in FEATURES))
    scored = jobs.score_rows(jobs.load_model(model_path), decoded, "p").collect()
    low, high = (next(r["p"] for r in scored if r["V1"] == v) for v in (-1.0, 3.0))
    assert low < high
    jobs.main(["alerts", "--model", model_path, "--checkpoint", str(tmp_path / "c"), "--source", str(tmp_path / "in"),
               "--out", str(tmp_path / "out"), "--log", str(tmp_path / "log"), "--dead-letters", str(tmp_path / "dead"),
               "--above", str((low + high) / 2), "--once"], spark)
    found = [json.loads(r["value"]) for r in spark.read.json(str(tmp_path / "out")).collect()]
    assert [f["transaction_id"] for f in found] == ["t1"]
    log = jobs.read_log(spark, str(tmp_path / "log"))
    assert log.count() == 2 and log.where("fraud_detected").count() == sum(p > 0.5 for p in (low, high))
    assert spark.read.json(str(tmp_path / "dead")).first()["value"] == "{"


def test_drift_job_reads_both_log_formats(spark, card_csv, tmp_path):
    rng = np.random.default_rng(1)
    log = [",".join([*FEATURES, "prediction", "prediction_id", "timestamp", "fraud_detected"])]
    for _ in range(300):
        log.append(",".join([*[f"{x:.6f}" for x in rng.normal(1, 1, 29)], f"{rng.beta(2, 8):.4f}", "p", "2024-01-01T00:00:00", "False"]))
    (tmp_path / "log.csv").write_text("\n".join(log))
    summary = jobs.main(["drift", "--reference", str(card_csv), "--current", str(tmp_path / "log.csv"),
                         "--summary", str(tmp_path / "s"), "--columns", str(tmp_path / "c")], spark)
    assert summary["drift_detected"] and len(summary["columns"]) == 30
    assert spark.read.json(str(tmp_path / "s")).first()["numeric_columns"] == 30
    assert spark.read.parquet(str(tmp_path / "c")).where("drifted").count() > 0
    short = jobs.main(["drift", "--reference", str(card_csv), "--current", str(tmp_path / "log.csv"),
                       "--summary", str(tmp_path / "s"), "--minimum", "301"], spark)
    assert short["status"] == "insufficient_data"
    stored = spark.read.json(str(tmp_path / "s"))
    assert stored.count() == 2 and stored.where("status = 'insufficient_data'").first()["total_rows"] == 300


@pytest.mark.parametrize("by_time", [False, True])
def test_messages_are_numbered_in_order(spark, card_csv, by_time):
    df = jobs.read_transactions(spark, str(card_csv))
    got = {r["key"]: json.loads(r["value"])["Time"] for r in jobs.message_records(df, by_time).collect()}
    assert len(got) == 1200
    assert got["txn_0000000001"] == (1.0 if by_time else 1200.0) and got["txn_0000001200"] == (1200.0 if by_time else 1.0)


def test_search_job(spark, card_csv, monkeypatch, tmp_path):
    space = {"maxDepth": (2, 3, "int"), "maxIter": (2, 3, "int"), "positiveWeight": (2.0, 9.0, "float")}
    monkeypatch.setattr("txwarden.plans.training.SEARCH_SPACE", space)
    done = jobs.main(["search", "--data", str(card_csv), "--trials", "2", "--model", str(tmp_path / "m"), "--runs", str(tmp_path / "r")], spark)
    logged = {r["key"]: r["value"] for r in spark.read.parquet(str(tmp_path / "r")).collect()}
    assert logged["n_trials"] == "2" and logged["data_path"] == str(card_csv) and "best_maxDepth" in logged and "scaler_mean" in logged
    assert {"train_samples", "val_samples", "report_samples", "f1_score", "f1_optimized_threshold", "precision_optimized_recall"} <= set(logged)
    assert len(done["trials"]) == 2 and set(done["best"]["params"]) == set(space)
