"""Ranking metrics. Rows collapse to distinct scores first; cumulative counts then run over slices
of the score axis, so no curve is ever built in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txwarden.functions.expressions import ratio
from txwarden.plans.ordered import walk
from txwarden.schemas import TARGET

# Fixed values of threshold selection.
F1_EPSILON = 1e-8
PRECISION_FLOOR, PRECISION_FALLBACK = 0.5, 0.9
SEARCH_PRECISION = 0.4


def score_counts(df: DataFrame, score: str, label: str = TARGET, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Positives and negatives at each distinct score, and the rows they were counted from."""
    rows = df.select(*by, F.col(score).cast("double").alias("threshold"), F.col(label).alias("_y"))
    rows = rows.where(F.col("threshold").isNotNull())
    counts = rows.groupBy(*by, "threshold").agg(
        F.count_if(F.col("_y") == 1).alias("npos"), F.count_if(F.col("_y") == 0).alias("nneg")
    )
    return counts, rows


def score_curve(df: DataFrame, score: str, label: str = TARGET, by: Sequence[str] = (),
                ahead: dict[str, str] | None = None, **slicing) -> DataFrame:
    """One row per distinct score: true and false positives when everything at or above it is
    flagged (`tp`, `fp`), what the score itself holds (`npos`, `nneg`), and class sizes (`pos`,
    `neg`). `ahead` adds values of the next lower score."""
    counts, rows = score_counts(df, score, label, by)
    return walk(
        counts, ["threshold"], by, totals={"tp": "npos", "fp": "nneg"}, overall={"pos": "npos", "neg": "nneg"},
        ahead=ahead, descending=True, source=rows, **slicing,
    )


def ranking_metrics(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC by trapezoids and average precision by steps; NULL without both classes."""
    tp, fp, npos, nneg = (F.col(c).cast("double") for c in ("tp", "fp", "npos", "nneg"))
    sums = curve.groupBy(*by).agg(
        F.max("pos").alias("pos"), F.max("neg").alias("neg"),
        F.sum(nneg * (tp - npos / 2)).alias("_area"),
        F.sum(npos * tp / (tp + fp)).alias("_steps"),
    )
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    return sums.select(
        *by, ratio(F.col("_area"), pos * neg, None).alias("roc_auc"),
        ratio(F.col("_steps"), pos, None).alias("average_precision"), "pos", "neg",
    )


def roc_points(df: DataFrame, score: str, label: str = TARGET, drop_intermediate: bool = True, **slicing) -> DataFrame:
    """False and true positive rate at each threshold, starting from (0, 0).

    Points on a straight line between their neighbours are left out unless asked for.
    """
    ahead = {"_npos": "npos", "_nneg": "nneg"} if drop_intermediate else None
    curve = score_curve(df, score, label, ahead=ahead, **slicing)
    if drop_intermediate:
        first = (F.col("tp") == F.col("npos")) & (F.col("fp") == F.col("nneg"))
        last = F.col("_npos").isNull()
        corner = (F.col("_npos") != F.col("npos")) | (F.col("_nneg") != F.col("nneg"))
        curve = curve.where(first | last | corner)
    points = curve.select(
        "threshold", ratio(F.col("fp"), F.col("neg"), None).alias("fpr"), ratio(F.col("tp"), F.col("pos"), None).alias("tpr")
    )
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], points.schema)
    return points.unionByName(start)


def precision_recall_points(df: DataFrame, score: str, label: str = TARGET, by: Sequence[str] = (), **slicing) -> DataFrame:
    """Precision and recall at each threshold."""
    return score_curve(df, score, label, by, **slicing).select(
        *by, "threshold",
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("pos")).alias("recall"),
    )


def _f1(precision: Column, recall: Column) -> Column:
    return (2 * (precision * recall)) / (precision + recall + F.lit(F1_EPSILON))


def best_f1_threshold(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Threshold with the highest F1; among equals the lowest."""
    best = F.max(F.struct(_f1(F.col("precision"), F.col("recall")).alias("f1"), (-F.col("threshold")).alias("low")))
    return points.groupBy(*by).agg(best.alias("_b")).select(
        *by, (-F.col("_b.low")).alias("threshold"), F.col("_b.f1").alias("f1")
    )


def precision_threshold(points: DataFrame, floor: float = PRECISION_FLOOR, fallback: float = PRECISION_FALLBACK,
                        by: Sequence[str] = ()) -> DataFrame:
    """Lowest threshold that reaches the precision, else the fallback."""
    lowest = F.min(F.when(F.col("precision") >= floor, F.col("threshold")))
    return points.groupBy(*by).agg(F.coalesce(lowest, F.lit(fallback)).alias("threshold"))


def search_objective(points: DataFrame, target: float = SEARCH_PRECISION, by: Sequence[str] = ()) -> DataFrame:
    """F1 at the threshold of highest recall among those reaching the precision; where none does,
    the best F1 anywhere."""
    p, r = F.col("precision"), F.col("recall")
    low = (-F.col("threshold")).alias("low")
    plain = F.when(p + r > 0, (2 * (p * r)) / (p + r)).otherwise(F.lit(0.0))
    reached = F.max(F.when(p >= target, F.struct(r.alias("recall"), low, plain.alias("f1"))))
    anywhere = F.max(F.struct(_f1(p, r).alias("f1"), low))
    both = points.groupBy(*by).agg(reached.alias("_r"), anywhere.alias("_a"))
    return both.select(
        *by, F.col("_r").isNotNull().alias("reached"),
        (-F.coalesce(F.col("_r.low"), F.col("_a.low"))).alias("threshold"),
        F.coalesce(F.col("_r.f1"), F.col("_a.f1")).alias("f1"),
    )


def confusion(df: DataFrame, score: str, label: str = TARGET, thresholds: Sequence[float] = (0.5,),
              by: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """tn, fp, fn, tp at each listed threshold, all in one pass over the rows.

    `strict` flags scores above the threshold (detection flags), else at or above it (metrics).
    """
    p, y = F.col(score), F.col(label)
    cells = []
    for i, t in enumerate(thresholds):
        hit = F.coalesce(p > t if strict else p >= t, F.lit(False))
        for name, test in (("tn", ~hit & (y == 0)), ("fp", hit & (y == 0)), ("fn", ~hit & (y == 1)), ("tp", hit & (y == 1))):
            cells.append(F.count_if(test).alias(f"{name}_{i}"))
    wide = df.groupBy(*by).agg(*cells)
    entries = F.array(
        *[F.struct(F.lit(float(t)).alias("threshold"), *[F.col(f"{n}_{i}").alias(n) for n in ("tn", "fp", "fn", "tp")])
          for i, t in enumerate(thresholds)]
    )
    return wide.select(*by, F.explode(entries).alias("_e")).select(*by, "_e.*")


def with_scores(cells: DataFrame) -> DataFrame:
    """Add precision, recall and F1 to confusion cells; 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cells.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def threshold_report(df: DataFrame, score: str, label: str = TARGET, **slicing) -> DataFrame:
    """Scores at the F1-optimal and at the precision-floor threshold."""
    points = precision_recall_points(df, score, label, **slicing)
    p, low = F.col("precision"), (-F.col("threshold")).alias("low")
    both = points.agg(
        F.max(F.struct(_f1(p, F.col("recall")).alias("f1"), low)).alias("_b"),
        F.coalesce(F.min(F.when(p >= PRECISION_FLOOR, F.col("threshold"))), F.lit(PRECISION_FALLBACK)).alias("floor"),
    ).select((-F.col("_b.low")).alias("best"), "floor").first()
    chosen = [("f1_optimized", both["best"]), ("precision_optimized", both["floor"])]
    chosen = [(kind, t) for kind, t in chosen if t is not None]
    kinds = df.sparkSession.createDataFrame(chosen, "kind string, threshold double")
    cells = with_scores(confusion(df, score, label, sorted({t for _, t in chosen})))
    return kinds.join(cells, "threshold").select("kind", "threshold", "precision", "recall", "f1_score")


def classification_report(df: DataFrame, score: str, label: str = TARGET, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support of both classes, accuracy, plain and weighted averages."""
    cells = confusion(df, score, label, [threshold])
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    f1 = lambda hit, extra, lost: ratio(2 * hit, 2 * hit + extra + lost)
    per_class = cells.select(
        (tn + fp).alias("n0"), (fn + tp).alias("n1"), ratio(tn, tn + fn).alias("p0"), ratio(tn, tn + fp).alias("r0"),
        f1(tn, fn, fp).alias("f0"), ratio(tp, tp + fp).alias("p1"), ratio(tp, tp + fn).alias("r1"),
        f1(tp, fp, fn).alias("f1"), ratio(tn + tp, tn + fp + fn + tp).alias("acc"),
    )
    n = F.col("n0") + F.col("n1")

    def line(name: str, p: Column, r: Column, f: Column, support: Column) -> Column:
        return F.struct(F.lit(name).alias("entry"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"),
                        support.cast("long").alias("support"))

    def average(kind: str) -> list[Column]:
        if kind == "macro":
            return [(F.col(f"{m}0") + F.col(f"{m}1")) / 2 for m in "prf"]
        return [ratio(F.col(f"{m}0") * F.col("n0") + F.col(f"{m}1") * F.col("n1"), n) for m in "prf"]

    lines = F.array(
        line("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("n0")),
        line("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("n1")),
        line("accuracy", F.col("acc"), F.col("acc"), F.col("acc"), n),
        line("macro avg", *average("macro"), n),
        line("weighted avg", *average("weighted"), n),
    )
    return per_class.select(F.explode(lines).alias("_l")).select("_l.*")


def compare_models(scores: DataFrame, models: Sequence[str], score: str = "score", label: str = TARGET, **slicing) -> DataFrame:
    """Score table of the models in long `scores` (column `model`): ranking metrics, metrics of the
    strict 0.5 flag, the best model by average precision (earlier in `models` wins a tie) and its
    lead over the worst."""
    ranked = ranking_metrics(score_curve(scores, score, label, ["model"], **slicing), ["model"])
    flagged = with_scores(confusion(scores, score, label, [0.5], ["model"], strict=True))
    table = ranked.select("model", "roc_auc", F.col("average_precision").alias("pr_auc")).join(
        flagged.select("model", "precision", "recall", "f1_score"), "model"
    )
    place = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    everything = Window.partitionBy(F.lit(0))  # one row per model
    rank = F.struct(F.col("pr_auc"), (-place).alias("place"))
    return table.select(
        "*", (rank == F.max(rank).over(everything)).alias("best"),
        (F.max("pr_auc").over(everything) - F.min("pr_auc").over(everything)).alias("performance_gap"),
    )
