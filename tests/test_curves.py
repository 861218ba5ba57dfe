import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from txwarden.operators import cost
from txwarden.operators import curves as c

ROWS = st.lists(st.tuples(st.integers(0, 12), st.integers(0, 1)), min_size=2, max_size=60).filter(
    lambda rows: {y for _, y in rows} == {0, 1}
)
SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    return spark.createDataFrame([(s / 12, y) for s, y in rows], "score double, Class int")


def brute(rows):
    s, y = np.array([r[0] / 12 for r in rows]), np.array([r[1] for r in rows])
    points = {}
    for t in sorted(set(s)):
        hit = s >= t
        points[t] = (int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum()))
    return s, y, points


@given(ROWS)
@SLOW
def test_curve_and_areas(spark, rows):
    s, y, points = brute(rows)
    pos, neg = int(y.sum()), int((1 - y).sum())
    curve = c.score_curve(frame(spark, rows), "score", rows_per_slice=3)
    got = {r["threshold"]: (r["tp"], r["fp"]) for r in curve.collect()}
    assert got == points
    ranked = c.ranking_metrics(curve).first()
    pairs = [(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]]
    assert ranked["roc_auc"] == pytest.approx(np.mean(pairs)) and 0 <= ranked["roc_auc"] <= 1
    last, area = 0.0, 0.0
    for t in sorted(points, reverse=True):
        tp, fp = points[t]
        area += (tp / pos - last) * tp / (tp + fp)
        last = tp / pos
    assert ranked["average_precision"] == pytest.approx(area)
    assert (ranked["pos"], ranked["neg"]) == (pos, neg)


@given(ROWS)
@SLOW
def test_roc_corners_carry_the_same_area(spark, rows):
    df = frame(spark, rows)
    every = sorted((r["fpr"], r["tpr"]) for r in c.roc_points(df, "score", drop_intermediate=False).collect())
    corners = sorted((r["fpr"], r["tpr"]) for r in c.roc_points(df, "score", rows_per_slice=2).collect())
    area = lambda ps: sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(ps, ps[1:]))
    assert area(every) == pytest.approx(area(corners)) and set(corners) <= set(every)
    assert corners[0] == (0.0, 0.0) and corners[-1] == (1.0, 1.0)


@given(ROWS)
@SLOW
def test_thresholds(spark, rows):
    """From the definitions, score by score."""
    positives = sum(y for _, y in rows)
    table = []
    for cut in sorted({a / 12 for a, _ in rows}):
        flagged = [y for a, y in rows if a / 12 >= cut]
        table.append((cut, sum(flagged) / len(flagged), sum(flagged) / positives))
    harmonic = lambda p, r: 0.0 if p + r == 0 else 2 / (1 / p + 1 / r) if p and r else 0.0
    curve = c.precision_recall_points(frame(spark, rows), "score").cache()
    best = c.best_f1_threshold(curve).first()
    top = max(harmonic(p, r) for _, p, r in table)
    here = next((p, r) for cut, p, r in table if cut == best["threshold"])
    assert harmonic(*here) == pytest.approx(top, abs=1e-6) and best["f1"] == pytest.approx(top, abs=1e-6)
    floor = c.precision_threshold(curve).first()["threshold"]
    enough = [cut for cut, p, _ in table if p >= 0.5]
    assert floor == (min(enough) if enough else 0.9)
    for target in (0.4, 0.8, 2.0):
        found = c.search_objective(curve, target).first()
        allowed = [(r, -cut, p) for cut, p, r in table if p >= target]
        assert found["reached"] == bool(allowed)
        if allowed:
            r, cut, p = max(allowed)
            assert found["threshold"] == -cut and found["f1"] == pytest.approx(harmonic(p, r))
        else:
            assert found["f1"] == pytest.approx(top, abs=1e-6)


def test_one_class_gives_null(spark):
    df = spark.createDataFrame([(0.2, 0), (0.7, 0)], "score double, Class int")
    row = c.ranking_metrics(c.score_curve(df, "score")).first()
    assert row["roc_auc"] is None and row["average_precision"] is None
    cells = c.with_scores(c.confusion(df, "score")).first()
    assert (cells["tn"], cells["fp"], cells["fn"], cells["tp"]) == (1, 1, 0, 0)
    assert cells["precision"] == cells["recall"] == cells["f1_score"] == 0.0


def test_flag_is_strict_and_metric_is_not(spark):
    df = spark.createDataFrame([(0.5, 1)], "score double, Class int")
    assert c.confusion(df, "score").first()["tp"] == 1
    assert c.confusion(df, "score", strict=True).first()["fn"] == 1


def test_threshold_report_with_fallback(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 0), (0.3, 0), (0.4, 0)], "score double, Class int")
    rows = {r["kind"]: r for r in c.threshold_report(df, "score").collect()}
    assert rows["precision_optimized"]["threshold"] == 0.9 and rows["precision_optimized"]["f1_score"] == 0.0
    assert rows["f1_optimized"]["threshold"] == 0.1 and rows["f1_optimized"]["recall"] == 1.0


def test_report_lines(spark):
    df = spark.createDataFrame([(0.9, 1), (0.6, 0), (0.4, 1), (0.1, 0), (0.2, 0)], "score double, Class int")
    rows = {r["entry"]: r for r in c.classification_report(df, "score").collect()}
    assert rows["1"]["precision"] == 0.5 and rows["1"]["recall"] == 0.5 and rows["1"]["support"] == 2
    assert rows["0"]["precision"] == pytest.approx(2 / 3) and rows["accuracy"]["f1_score"] == 0.6
    assert rows["macro avg"]["precision"] == pytest.approx((0.5 + 2 / 3) / 2)
    assert rows["weighted avg"]["recall"] == pytest.approx(0.6)


def test_models_are_ranked_with_ties_by_place(spark):
    rows = [(m, s, y) for m in ("b", "a") for s, y in ((0.9, 1), (0.1, 0))] + [("w", 0.1, 1), ("w", 0.9, 0)]
    df = spark.createDataFrame(rows, "model string, score double, Class int")
    got = {r["model"]: r for r in c.compare_models(df, ["b", "a", "w"]).collect()}
    assert got["b"]["best"] and not got["a"]["best"] and got["w"]["performance_gap"] == pytest.approx(0.5)


def test_costs_and_return(spark):
    df = spark.createDataFrame(
        [(0.95, 1, 10.0), (0.35, 1, 20.0), (0.55, 0, 5.0), (0.05, 0, 5.0)], "score double, Class int, Amount double"
    )
    costs = cost.business_costs(df, "score")
    at = {r["threshold"]: r for r in costs.collect()}
    assert at[0.1]["net_benefit"] == 2 * 50 - 1 and at[0.4]["net_benefit"] == 50 - 101 and at[0.6]["total_cost"] == 100
    best = cost.best_by_net_benefit(costs)
    assert best.first()["threshold"] == 0.1
    roi = cost.return_on_investment(df, best).first()
    assert roi["prevented_fraud"] == 30.0 and roi["roi_percent"] == pytest.approx(2900.0)
    # no cost at all: the return is undefined
    free = df.where("score > 0.9")
    assert cost.return_on_investment(free, cost.best_by_net_benefit(cost.business_costs(free, "score"))).first()["roi_percent"] is None
