import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from txwarden.operators.prepare import stratified_split
from txwarden.operators.sla import latency_report, limit_checks
from txwarden.plans import training as t
from txwarden.sources.sinks import load_model, write_importances

FEATURES = ["V1", "V2", "V3", "Amount"]
SMALL = {"maxIter": 5, "maxDepth": 3}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1500, 3))
    y = (x[:, 0] + 0.3 * rng.normal(size=1500) > 1.3).astype(int)
    data = [(i, float(i), *map(float, x[i]), float(rng.lognormal(3, 1)), int(y[i])) for i in range(1500)]
    return spark.createDataFrame(data, "id bigint, Time double, V1 double, V2 double, V3 double, Amount double, Class int").cache()


def test_training_job(spark, rows, tmp_path):
    done = t.training_job(rows, ["id"], params=SMALL, model_path=str(tmp_path / "m"), runs_path=str(tmp_path / "r"))
    assert done["features"] == FEATURES
    assert done["metrics"]["roc_auc"] > 0.9 and 0 < done["metrics"]["f1_score"] <= 1
    assert {r["kind"] for r in done["thresholds"]} == {"f1_optimized", "precision_optimized"}
    train, held, reported = t.three_way_split(rows, ["id"])
    both = t.score_rows(load_model(str(tmp_path / "m")), t.score_rows(done["model"], held, "before"), "after")
    assert both.where("before <> after").count() == 0 and both.count() == held.count()
    logged = {r["key"]: r["value"] for r in spark.read.parquet(str(tmp_path / "r")).collect()}
    sizes = {"train_samples": train, "val_samples": held, "report_samples": reported}
    assert {k: int(logged[k]) for k in sizes} == {k: part.count() for k, part in sizes.items()} and "f1_optimized_threshold" in logged
    assert float(logged["scale_pos_weight"]) > 1


def test_scaler_is_fitted_on_training_rows_only(rows):
    train, held = stratified_split(rows, ["id"])
    model = t.fit_model(t.boosted_trees(**SMALL), train, FEATURES, held_out=held.withColumn("Amount", F.lit(1e9)))
    mean = train.agg(F.avg("Amount")).first()[0]
    assert repr(mean) in model.stages[0].getStatement()


def test_missing_values_are_filled_by_training_medians(spark, rows, tmp_path):
    gaps = rows.withColumn("V1", F.when(F.col("id") % 7 != 0, F.col("V1"))).withColumn("V2", F.when(F.col("id") % 5 != 0, F.col("V2")).otherwise(float("nan")))
    gaps = gaps.withColumn("Amount", F.when(F.col("id") % 3 != 0, F.col("Amount"))).withColumn("V3", F.lit(None).cast("double"))
    constants = t.fit_constants(gaps, FEATURES)
    values = np.array([r[0] for r in gaps.select("V1").dropna().collect()])
    assert abs((values < constants.medians["V1"]).mean() - 0.5) < 0.01 and constants.medians["V3"] == 0.0
    for learner in t.three_learners(10, **SMALL).values():
        model = t.fit_model(learner, gaps, FEATURES)
        t.save_model(model, str(tmp_path / "m"))
        scores = t.score_rows(load_model(str(tmp_path / "m")), gaps)
        assert scores.where("fraud_probability BETWEEN 0 AND 1").count() == 1500 and scores.columns == [*gaps.columns, "fraud_probability"]


@pytest.mark.parametrize("make, params", [(t.boosted_trees, SMALL), (t.regularised_trees, {"n_estimators": 1, "max_depth": 2})])
def test_many_rows_are_dealt_to_more_tasks(rows, monkeypatch, make, params):
    """The tasks of a fit grow with its rows; `partitions` is the least."""
    dealt = []
    repartition = type(rows).repartition
    monkeypatch.setattr(type(rows), "repartition", lambda self, *a: dealt.append(a) or repartition(self, *a))
    train, held = stratified_split(rows, ["id"])
    t.fit_model(make(**params), train, FEATURES, held_out=held, partitions=2)
    monkeypatch.setattr(t, "ROWS_PER_TASK", 250)
    t.fit_model(make(**params), train, FEATURES, held_out=held, partitions=2)
    assert dealt == [(2,), (-(-train.count() // 250),)] and dealt[1][0] >= 4


def test_splits_hold_every_class(rows):
    few = rows.withColumn("Class", (F.col("id") < 15).cast("int"))
    parts = t.three_way_split(few, ["id"])
    assert [p.count() for p in parts] == [960, 240, 300]
    assert [p.where("Class = 1").count() for p in parts] == [10, 2, 3]


def test_comparison_with_its_own_search(rows, monkeypatch):
    space = {"maxDepth": (2, 3, "int"), "maxIter": (2, 3, "int"), "positiveWeight": (2.0, 9.0, "float")}
    train, tuned, test = t.three_way_split(rows, ["id"])
    table = t.tuned_comparison(train, tuned, test, FEATURES, trials=2, space=space)
    assert table.count() == 3 and set(t.COMPARISON_SPACE) > set(space)


def test_importances(spark, rows, tmp_path):
    model = t.fit_model(t.boosted_trees(**SMALL), rows, FEATURES)
    table = t.importances(model, FEATURES, spark)
    assert table.first()["feature"] == "V1" and table.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert [r["feature"] for r in t.top_features(table, 2).collect()][0] == "V1"
    write_importances(table, str(tmp_path / "i"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "i")).first()["feature"] == "V1"


def test_early_stopping_ends_boosting(rows):
    train, held = stratified_split(rows, ["id"])
    flat = held.withColumn("Class", (F.rand(1) < 0.5).cast("int"))
    model = t.fit_model(t.boosted_trees(maxIter=30, maxDepth=3), train, FEATURES, held_out=flat)
    assert model.stages[-1].getNumTrees < 30


def test_comparison_and_quick_run(rows):
    train, test = stratified_split(rows, ["id"])
    table = {r["model"]: r for r in t.compare_learners(t.three_learners(**SMALL), train, test, FEATURES).collect()}
    assert set(table) == {"boosted_trees", "random_forest", "logistic_regression"}
    assert sum(r["best"] for r in table.values()) == 1
    assert t.quick_training_job(rows, ["id"], 700, params=SMALL)["metrics"]["roc_auc"] > 0.8


def test_search_is_seeded_and_sorted(rows):
    train, held = stratified_split(rows, ["id"])
    space = {"maxDepth": (2, 4, "int"), "maxIter": (2, 4, "int")}
    found = t.search(train, held, FEATURES, trials=3, space=space)
    assert [f["value"] for f in found] == sorted((f["value"] for f in found), reverse=True)
    assert {f["trial"] for f in found} == {0, 1, 2}
    drawn = [t.draw_params(t.SEARCH_SPACE, random.Random(1)) for _ in range(2)]
    assert drawn[0] == drawn[1] and 0.01 <= drawn[0]["stepSize"] <= 0.3 and 0.6 <= float(drawn[0]["featureSubsetStrategy"]) <= 1


def test_optimized_run_reports_on_unseen_rows(rows):
    space = {"maxDepth": (2, 3, "int"), "maxIter": (2, 3, "int")}
    done = t.optimized_training_job(rows, ["id"], trials=2, space=space, metric="average_precision")
    assert len(done["trials"]) == 2 and done["metrics"]["roc_auc"] > 0.8


def test_no_positives(rows):
    with pytest.raises(ValueError, match="no positive rows"):
        t.positive_weight(rows.where("Class = 0"))


def test_latency_limits(spark):
    df = spark.createDataFrame([(float(i), i == 7) for i in range(1, 101)], "ms double, failed boolean")
    report = latency_report(df, "ms", "failed")
    row = report.first()
    assert row["p95_ms"] == pytest.approx(95.05) and row["p99_ms"] == pytest.approx(99.01) and row["error_rate"] == 0.01
    checks = {r["check"]: r["passed"] for r in limit_checks(report).collect()}
    assert checks == {"p95_ms": True, "p99_ms": True, "mean_ms": False, "error_rate": False, "check_rate": False}
    near = latency_report(df, "ms", "failed", exact=False).first()
    assert near["p95_ms"] == pytest.approx(95, abs=1)
    assert not any(r["passed"] for r in limit_checks(latency_report(df.limit(0), "ms", "failed")).collect())
