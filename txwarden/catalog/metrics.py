"""Ranking, threshold and cost metrics on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.catalog.inputs import SALES, TX, sales, table, transactions
from txwarden.catalog.registry import query
from txwarden.operators import cost, curves


def _curve(rows: str) -> str:
    """Counts per score and cumulative counts from the highest score down, as SQL."""
    return f"""
, counts AS (SELECT score AS threshold, CAST(count_if("Class" = 1) AS BIGINT) AS npos, CAST(count_if("Class" = 0) AS BIGINT) AS nneg
             FROM {rows} GROUP BY score),
curve AS (SELECT threshold, npos, nneg, CAST(sum(npos) OVER w AS BIGINT) AS tp, CAST(sum(nneg) OVER w AS BIGINT) AS fp,
                 CAST(sum(npos) OVER () AS BIGINT) AS pos, CAST(sum(nneg) OVER () AS BIGINT) AS neg
          FROM counts WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)),
points AS (SELECT threshold, tp / (tp + fp) AS "precision", tp / pos AS recall FROM curve)"""


EPS = "CAST(1e-8 AS DOUBLE)"
F1_EPS = f'(2 * ("precision" * recall)) / ("precision" + recall + {EPS})'


@query("A14", TX + """
SELECT CAST(0.5 AS DOUBLE) AS threshold, CAST(count_if(score < 0.5 AND "Class" = 0) AS BIGINT) AS tn,
       CAST(count_if(score >= 0.5 AND "Class" = 0) AS BIGINT) AS fp, CAST(count_if(score < 0.5 AND "Class" = 1) AS BIGINT) AS fn,
       CAST(count_if(score >= 0.5 AND "Class" = 1) AS BIGINT) AS tp FROM tx""")
def confusion_cells(spark, folder) -> DataFrame:
    return curves.confusion(transactions(spark, folder), "score")


@query("A14 A15", SALES + """
, t AS (SELECT unnest([0.1, 0.25, 0.4, 0.9])::DOUBLE AS threshold),
c AS (SELECT threshold, count_if(score < threshold AND "Class" = 0) AS tn, count_if(score >= threshold AND "Class" = 0) AS fp,
             count_if(score < threshold AND "Class" = 1) AS fn, count_if(score >= threshold AND "Class" = 1) AS tp
      FROM sales, t GROUP BY threshold)
SELECT threshold, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp,
       CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS "precision",
       CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
       CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1_score FROM c""")
def scores_at_thresholds(spark, folder) -> DataFrame:
    return curves.with_scores(curves.confusion(sales(spark, folder), "score", thresholds=[0.1, 0.25, 0.4, 0.9]))


@query("A14 A15", """
SELECT CAST(0.5 AS DOUBLE) AS threshold, CAST(count_if(quality <> 1 AND toxic = 0) AS BIGINT) AS tn,
       CAST(count_if(quality = 1 AND toxic = 0) AS BIGINT) AS fp, CAST(count_if(quality <> 1 AND toxic = 1) AS BIGINT) AS fn,
       CAST(count_if(quality = 1 AND toxic = 1) AS BIGINT) AS tp FROM labels""")
def label_agreement(spark, folder) -> DataFrame:
    return curves.confusion(table(spark, folder, "labels"), "quality", "toxic", strict=True)


@query("A16", TX + """
, c AS (SELECT count_if(score < 0.5 AND "Class" = 0)::DOUBLE AS tn, count_if(score >= 0.5 AND "Class" = 0)::DOUBLE AS fp,
               count_if(score < 0.5 AND "Class" = 1)::DOUBLE AS fn, count_if(score >= 0.5 AND "Class" = 1)::DOUBLE AS tp FROM tx),
k AS (SELECT tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0, tn + fp AS n0,
             tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1, fn + tp AS n1,
             (tn + tp) / (tn + fp + fn + tp) AS acc FROM c),
r AS (SELECT '0' AS entry, p0 AS p, r0 AS r, f0 AS f, n0 AS n FROM k UNION ALL SELECT '1', p1, r1, f1, n1 FROM k
UNION ALL SELECT 'accuracy', acc, acc, acc, n0 + n1 FROM k
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1 FROM k
UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1), (r0 * n0 + r1 * n1) / (n0 + n1), (f0 * n0 + f1 * n1) / (n0 + n1), n0 + n1 FROM k)
SELECT entry, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1_score, CAST(n AS BIGINT) AS support FROM r""")
def report_by_class(spark, folder) -> DataFrame:
    out = curves.classification_report(transactions(spark, folder), "score")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1_score")})


@query("A17", TX + _curve("tx") + """
, near AS (SELECT *, lead(npos) OVER d AS np, lead(nneg) OVER d AS nn, row_number() OVER d AS rn FROM curve
           WINDOW d AS (ORDER BY threshold DESC))
SELECT threshold, fp / neg AS fpr, tp / pos AS tpr FROM near WHERE rn = 1 OR np IS NULL OR np <> npos OR nn <> nneg
UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0""")
def roc_curve_points(spark, folder) -> DataFrame:
    return curves.roc_points(transactions(spark, folder), "score")


@query("A17", SALES + _curve("sales") + """
SELECT threshold, fp / neg AS fpr, tp / pos AS tpr FROM curve UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0""")
def roc_curve_sales(spark, folder) -> DataFrame:
    return curves.roc_points(sales(spark, folder), "score", drop_intermediate=False)


RANKING = """
SELECT round(sum(nneg * (tp - npos / 2)) / max(pos) / max(neg), 6) AS roc_auc,
       round(sum(npos * tp / (tp + fp)) / max(pos), 6) AS average_precision, max(pos) AS pos, max(neg) AS neg FROM curve"""


def _ranking(df: DataFrame) -> DataFrame:
    out = curves.ranking_metrics(curves.score_curve(df, "score"))
    return out.withColumns({c: F.round(c, 6) for c in ("roc_auc", "average_precision")})


@query("A18 A20", TX + _curve("tx") + RANKING)
def ranking_quality(spark, folder) -> DataFrame:
    return _ranking(transactions(spark, folder))


@query("A18 A20", SALES + _curve("sales") + RANKING)
def ranking_quality_sales(spark, folder) -> DataFrame:
    return _ranking(sales(spark, folder))


@query("A19", TX + _curve("tx") + 'SELECT threshold, "precision", recall FROM points')
def precision_recall_curve(spark, folder) -> DataFrame:
    return curves.precision_recall_points(transactions(spark, folder), "score")


@query("A19", SALES + _curve("sales") + 'SELECT threshold, "precision", recall FROM points')
def precision_recall_sales(spark, folder) -> DataFrame:
    return curves.precision_recall_points(sales(spark, folder), "score")


@query("A21", SALES + _curve("sales") + f"""
SELECT threshold, {F1_EPS} AS f1 FROM points ORDER BY {F1_EPS} DESC, threshold LIMIT 1""")
def f1_threshold(spark, folder) -> DataFrame:
    return curves.best_f1_threshold(curves.precision_recall_points(sales(spark, folder), "score"))


@query("A22", SALES + _curve("sales") + """
SELECT coalesce(min(threshold) FILTER ("precision" >= 0.5), CAST(0.9 AS DOUBLE)) AS threshold FROM points""")
def threshold_for_precision(spark, folder) -> DataFrame:
    return curves.precision_threshold(curves.precision_recall_points(sales(spark, folder), "score"))


def _searched(target: str) -> str:
    return f"""
, valid AS (SELECT TRUE AS reached, threshold, (2 * ("precision" * recall)) / ("precision" + recall) AS f1 FROM points
            WHERE "precision" >= {target} ORDER BY recall DESC, threshold LIMIT 1),
anywhere AS (SELECT FALSE AS reached, threshold, {F1_EPS} AS f1 FROM points ORDER BY {F1_EPS} DESC, threshold LIMIT 1)
SELECT * FROM valid UNION ALL SELECT * FROM anywhere WHERE NOT EXISTS (SELECT * FROM valid)"""


@query("A23", SALES + _curve("sales") + _searched("0.4"))
def search_score(spark, folder) -> DataFrame:
    return curves.search_objective(curves.precision_recall_points(sales(spark, folder), "score"))


@query("A23", SALES + _curve("sales") + _searched("0.33"))
def search_score_low_target(spark, folder) -> DataFrame:
    return curves.search_objective(curves.precision_recall_points(sales(spark, folder), "score"), target=0.33)


@query("A23", TX + _curve("tx") + _searched("0.99"))
def search_score_unreached(spark, folder) -> DataFrame:
    return curves.search_objective(curves.precision_recall_points(transactions(spark, folder), "score"), target=0.99)


@query("A24 A21 A22", SALES + _curve("sales") + f"""
, chosen AS (
  (SELECT 'f1_optimized' AS kind, threshold FROM points ORDER BY {F1_EPS} DESC, threshold LIMIT 1)
  UNION ALL SELECT 'precision_optimized', coalesce(min(threshold) FILTER ("precision" >= 0.5), CAST(0.9 AS DOUBLE)) FROM points),
cells AS (SELECT kind, threshold, count_if(score >= threshold AND "Class" = 1) AS tp, count_if(score >= threshold AND "Class" = 0) AS fp,
                 count_if(score < threshold AND "Class" = 1) AS fn FROM chosen, sales GROUP BY ALL)
SELECT kind, threshold, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS "precision",
       CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
       CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1_score FROM cells""")
def chosen_thresholds(spark, folder) -> DataFrame:
    return curves.threshold_report(sales(spark, folder), "score")


def costs_sql(cost: str, revenue: str) -> str:
    return f"""
, t AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6])::DOUBLE AS threshold),
c AS (SELECT threshold, CAST(count_if(score < threshold AND "Class" = 0) AS BIGINT) AS tn,
             CAST(count_if(score >= threshold AND "Class" = 0) AS BIGINT) AS fp,
             CAST(count_if(score < threshold AND "Class" = 1) AS BIGINT) AS fn,
             CAST(count_if(score >= threshold AND "Class" = 1) AS BIGINT) AS tp FROM tx, t GROUP BY threshold),
costs AS (SELECT threshold, tp, fp, fn, tn, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS "precision",
                 CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall, {cost} AS total_cost,
                 {revenue} AS total_revenue, {revenue} - ({cost}) AS net_benefit FROM c)"""


COSTS = costs_sql("fn * 100 + fp", "tp * 50")


@query("A25", TX + COSTS + "SELECT * FROM costs")
def threshold_costs(spark, folder) -> DataFrame:
    return cost.business_costs(transactions(spark, folder), "score")


OWN_COST, OWN_REVENUE = {"fn": 250, "fp": 3, "tp": 2}, {"tp": 80, "tn": 0.25}


@query("A25 A26", TX + costs_sql("fn * 250 + fp * 3 + tp * 2", "tp * 80 + tn * CAST(0.25 AS DOUBLE)") + "SELECT * FROM costs ORDER BY net_benefit DESC, threshold LIMIT 1")
def best_threshold_own_units(spark, folder) -> DataFrame:
    """The best threshold where a checked alert costs as well, and a transaction let through rightly earns a fee."""
    costs = cost.business_costs(transactions(spark, folder), "score", unit_cost=OWN_COST, unit_revenue=OWN_REVENUE)
    return cost.best_by_net_benefit(costs)


@query("A26", TX + COSTS + "SELECT * FROM costs ORDER BY net_benefit DESC, threshold LIMIT 1")
def best_cost_threshold(spark, folder) -> DataFrame:
    return cost.best_by_net_benefit(cost.business_costs(transactions(spark, folder), "score"))


@query("A27", TX + COSTS + """
, best AS (SELECT * FROM costs ORDER BY net_benefit DESC, threshold LIMIT 1),
v AS (SELECT sum("Amount") FILTER ("Class" = 1) AS value, count_if("Class" = 1) AS n FROM tx)
SELECT threshold, round(value, 2) AS total_fraud_value, round(tp / n * value, 2) AS prevented_fraud,
       round((tp / n * value - total_cost) / total_cost * 100, 4) AS roi_percent FROM best, v""")
def fraud_return(spark, folder) -> DataFrame:
    tx = transactions(spark, folder)
    out = cost.return_on_investment(tx, cost.best_by_net_benefit(cost.business_costs(tx, "score")))
    return out.select("threshold", F.round("total_fraud_value", 2).alias("total_fraud_value"),
                      F.round("prevented_fraud", 2).alias("prevented_fraud"), F.round("roi_percent", 4).alias("roi_percent"))


MODELS = ["price", "quantity", "discount"]


@query("A29 U2", SALES + """
, long AS (SELECT 'price' AS model, score, "Class" FROM sales UNION ALL SELECT 'quantity', "V1" / 50, "Class" FROM sales
           UNION ALL SELECT 'discount', "V2" * 10, "Class" FROM sales),
counts AS (SELECT model, score AS threshold, count_if("Class" = 1) AS npos, count_if("Class" = 0) AS nneg FROM long GROUP BY ALL),
curve AS (SELECT *, sum(npos) OVER w AS tp, sum(nneg) OVER w AS fp FROM counts
          WINDOW w AS (PARTITION BY model ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)),
ranked AS (SELECT model, sum(nneg * (tp - npos / 2)) / max(tp) / max(fp) AS roc_auc, sum(npos * tp / (tp + fp)) / max(tp) AS pr_auc
           FROM curve GROUP BY model),
cells AS (SELECT model, count_if(score > 0.5 AND "Class" = 1) AS tp, count_if(score > 0.5 AND "Class" = 0) AS fp,
                 count_if(score <= 0.5 AND "Class" = 1) AS fn FROM long GROUP BY model)
SELECT model, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc,
       CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS "precision", CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
       CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1_score,
       pr_auc = max(pr_auc) OVER () AS best, round(max(pr_auc) OVER () - min(pr_auc) OVER (), 6) AS performance_gap
FROM ranked JOIN cells USING (model)""")
def model_table(spark, folder) -> DataFrame:
    rows = sales(spark, folder)
    parts = [
        rows.select(F.lit(name).alias("model"), score.alias("score"), "Class")
        for name, score in zip(MODELS, (F.col("score"), F.col("V1") / 50, F.col("V2") * 10))
    ]
    out = curves.compare_models(parts[0].unionByName(parts[1]).unionByName(parts[2]), MODELS)
    return out.withColumns({c: F.round(c, 6) for c in ("roc_auc", "pr_auc", "performance_gap")})
