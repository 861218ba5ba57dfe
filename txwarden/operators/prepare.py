"""Preparation: checks, projections, scaling, fills, splits and samples."""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.functions.expressions import HASH_RANGE, digest_below, digest_number, in_share, row_digest
from txwarden.plans.ordered import column_quantiles, quantiles
from txwarden.schemas import FEATURES, TARGET

log = logging.getLogger(__name__)

# An exact split states each class's cut in the plan, so their number must be small.
MOST_CLASSES = 200

# Fixed texts of the checks that callers match on.
EMPTY_INPUT = "Input DataFrame is empty"
NO_TARGET = "Target column '{}' not found in DataFrame"
NO_AMOUNT = "Missing required columns: Amount"
NOT_FITTED = "Scaler must be fitted before use"
AMOUNT_NEEDED = "Amount column is required for preprocessing"
NO_FEATURES = "Missing required features: {}"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


@dataclass(frozen=True)
class AmountScaler:
    """Mean and population deviation of one column, fitted in a single aggregate.

    ML's StandardScaler divides by the sample deviation, hence not used here.
    """

    column: str = "Amount"
    mean: float | None = None
    std: float | None = None

    @classmethod
    def fit(cls, df: DataFrame, column: str = "Amount") -> AmountScaler:
        row = df.agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std")).first()
        if row["mean"] is None:
            return cls(column)
        return cls(column, row["mean"], row["std"] or 1.0)

    @property
    def fitted(self) -> bool:
        return self.mean is not None

    def scaled(self) -> Column:
        return (F.col(self.column) - F.lit(self.mean)) / F.lit(self.std)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.column, self.scaled())

    def as_stage(self, output: str) -> SQLTransformer:
        """The scaling as a saveable model stage."""
        return SQLTransformer(
            statement=f"SELECT *, (`{self.column}` - {self.mean!r}D) / {self.std!r}D AS `{output}` FROM __THIS__"
        )


def drop_time(df: DataFrame) -> DataFrame:
    return df.drop("Time")


def check_training_input(df: DataFrame, target: str = TARGET) -> None:
    if not df.columns or df.isEmpty():
        raise ValueError(EMPTY_INPUT)
    if target not in df.columns:
        raise ValueError(NO_TARGET.format(target))
    if "Amount" not in df.columns:
        raise KeyError(NO_AMOUNT)


def prepare_training(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, AmountScaler]:
    """Checked input without Time, Amount scaled on all its rows; the target stays a column."""
    check_training_input(df, target)
    scaler = AmountScaler.fit(df)
    return scaler.transform(drop_time(df)), scaler


def project_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features in the given order."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(NO_FEATURES.format(missing))
    return df.select(*features)


def prepare_inference(df: DataFrame, scaler: AmountScaler, features: Sequence[str]) -> DataFrame:
    if not df.columns or df.isEmpty():
        raise ValueError(EMPTY_INPUT)
    if not scaler.fitted:
        raise ValueError(NOT_FITTED)
    if "Amount" not in df.columns:
        raise ValueError(AMOUNT_NEEDED)
    return project_features(scaler.transform(drop_time(df)), features)


def target_column(df: DataFrame, name: str) -> Column:
    """The named column as `target`; a table without it counts as all zeros."""
    if name not in df.columns:
        log.warning("there is no column %r to compare as target; zeros stand in for it", name)
    return (F.col(name) if name in df.columns else F.lit(0)).alias("target")


def align(reference: DataFrame, current: DataFrame, features: Sequence[str] = FEATURES,
          reference_target: str = TARGET, current_target: str = "prediction"
          ) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both tables with one schema: the features that both have, in the given order, then `target`."""
    shared = set(reference.columns).intersection(current.columns)
    common = [name for name in features if name in shared]
    if left_out := sorted(set(features) - shared):
        log.warning("features that only one table has, or none: %s", ", ".join(left_out))
    old = reference.select(*common, target_column(reference, reference_target))
    return old, current.select(*common, target_column(current, current_target)), common


def long_values(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """One row per (row, column): `column`, `value` as double."""
    return df.unpivot(
        [F.col(k) for k in keep], [F.col(c).cast("double").alias(c) for c in columns], "column", "value"
    )


def medians(df: DataFrame, columns: Sequence[str], exact: bool = True, accuracy: int = 10_000,
            **slicing) -> dict[str, float]:
    """Median of each column, NULL and NaN ignored; None for a column without values.

    Exact medians rank only a narrow band of each column. `exact=False` is one scan with a
    relative rank error of 1/accuracy.
    """
    out: dict[str, float | None] = dict.fromkeys(columns)
    if not columns:
        return out
    if exact:
        found = column_quantiles(df, columns, [0.5], accuracy=accuracy, **slicing)
        return out | {c: q[0] for c, q in found.items()}
    row = df.agg(
        *[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), 0.5, accuracy).alias(c)
          for c in columns]
    ).first()
    return row.asDict()


def fill_medians(df: DataFrame, exact: bool = True, **slicing) -> DataFrame:
    """Missing numbers replaced by their column's median; the filled columns become doubles."""
    columns = numeric_columns(df)
    gaps = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in columns]).first() if columns else {}
    holed = [c for c in columns if gaps[c]]
    middle = medians(df, holed, exact, **slicing)
    return df.withColumns(
        {c: F.when(_missing(df, c), F.lit(middle[c])).otherwise(F.col(c)) for c in holed}
    )


def _missing(df: DataFrame, column: str) -> Column:
    test = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        test = test | F.isnan(column)
    return test


def drop_repeats(df: DataFrame) -> DataFrame:
    """Rows that repeat another row are dropped; missing values count as equal. Copies collapse before the shuffle."""
    return df.dropDuplicates()


def _with_digest(df: DataFrame, keys: Sequence[str], seed: int, purpose: str) -> DataFrame:
    """Add `_h`, the digest of the key columns, or of all columns if none is named."""
    digest = row_digest(keys or df.columns, seed, purpose)
    if len(keys or df.columns) <= 8:
        return df.withColumn("_h", digest)
    # A filter on a plain column would be pushed below the projections that compute the keys, where
    # constraint inference tries every mix of key and expression, 2^n of them. It stops at explode.
    return df.select("*", F.explode(F.array(digest)).alias("_h"))


def stratified_split(df: DataFrame, keys: Sequence[str] = (), share: float = 0.2, seed: int = 42
                     ) -> tuple[DataFrame, DataFrame]:
    """Train and held-out rows, by a hash of the row's key (of all columns if none is named).

    Every class has the share in expectation; the assignment of a row never changes with
    partitioning, and no shuffle is needed. Rows with equal keys stay on one side.
    """
    hashed = _with_digest(df, keys, seed, "split")
    held_out = in_share(F.col("_h"), share)
    return hashed.where(~held_out).drop("_h"), hashed.where(held_out).drop("_h")


def stratified_split_exact(df: DataFrame, keys: Sequence[str] = (), label: str = TARGET, share: float = 0.2,
                           seed: int = 42, **slicing) -> tuple[DataFrame, DataFrame]:
    """As `stratified_split`, with the exact number of held-out rows in each class.

    ceil(share * rows) rows are held out; training rows are dealt to classes in proportion, by
    largest remainder. Each class is cut at an order statistic of its digests. Digests spread
    evenly, so the cut lies near the class's share and only digests around it are ranked.
    """
    hashed = _with_digest(df, keys, seed, "split")
    numbers = hashed.select(label, digest_number(F.col("_h")).alias("_n")).persist()  # two numbers a row, read by several passes
    try:
        cuts, held = _class_cuts(numbers, label, share, slicing)
    finally:
        numbers.unpersist()
    digest, test = F.col("_h"), F.lit(False)
    for r in cuts:
        if r[label] in held:
            test = test | (F.col(label).eqNullSafe(F.lit(r[label])) & digest_below(digest, int(r["q"][0]) + 1))
    return hashed.where(~test).drop("_h"), hashed.where(test).drop("_h")


def _class_cuts(numbers: DataFrame, label: str, share: float, slicing: dict) -> tuple[list, dict]:
    """Each class's last held-out digest, as `q`, from `_n`, the digests of all rows; and how many rows a class holds out."""
    found = numbers.groupBy(label).count().limit(MOST_CLASSES + 1).collect()
    if len(found) > MOST_CLASSES:
        raise ValueError(f"{label} has more than {MOST_CLASSES} classes")
    counts = {r[label]: r["count"] for r in found}
    total = sum(counts.values())
    train_total = total - math.ceil(share * total)
    quota = {c: train_total * n / total for c, n in counts.items()}
    train = {c: math.floor(q) for c, q in quota.items()}
    by_remainder = sorted(quota, key=lambda c: (train[c] - quota[c], str(c)))
    for c in by_remainder[: train_total - sum(train.values())]:
        train[c] += 1
    held = {c: counts[c] - train[c] for c in counts if counts[c] > train[c]}

    digest = F.col("_n")
    around = {c: _expected_cut(held[c], counts[c]) for c in held}
    below, near = F.lit(False), F.lit(False)
    for c, (low, high) in around.items():
        own = F.col(label).eqNullSafe(F.lit(c))
        below = below | (own & (digest < low))
        near = near | (own & (digest >= low) & (digest < high))
    sizes = {r[label]: r for r in numbers.groupBy(label).agg(F.count_if(below).alias("below"), F.count_if(near).alias("near")).collect()}
    skipped = {c: sizes[c]["below"] for c in held}
    if any(not skipped[c] < held[c] <= skipped[c] + sizes[c]["near"] for c in held):
        near, skipped = F.lit(True), dict.fromkeys(held, 0)  # some cut is elsewhere: rank all rows
    cuts = quantiles(
        numbers.where(near), "_n", [share], [label],
        ranks=lambda group, n: [held.get(group[0], 1) - skipped.get(group[0], 0) - 1], **slicing
    )
    return cuts, held


def _expected_cut(held: int, rows: int) -> tuple[int, int]:
    """Where the held-th smallest of `rows` even digests lies, six deviations to either side."""
    share = held / rows
    slack = 6 * math.sqrt(share * (1 - share) / rows) + 6 / rows
    return int(max(share - slack, 0.0) * HASH_RANGE), int(min(share + slack, 1.0) * HASH_RANGE)


# Probabilities at which a sample brackets its last row, and the accuracy of the sketch behind them.
BRACKETS, SKETCH = 2000, 20_000


def sample_rows(df: DataFrame, n: int, keys: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """min(n, rows) rows: those with the smallest key hashes, ties by the keys.

    One pass counts the rows and sketches their hashes, which brackets the n-th from above; only the rows below that are ordered.
    """
    if n <= 0:
        return df.limit(0)
    numbered = _with_digest(df, keys, seed, "sample").withColumn("_n", digest_number(F.col("_h")))
    shares = [k / BRACKETS for k in range(BRACKETS + 1)]
    facts = numbered.agg(F.count("*").alias("rows"), F.percentile_approx("_n", shares, SKETCH).alias("at")).first()
    if facts["rows"] <= n:
        return df
    # A rank of the sketch is off by rows / SKETCH at most.
    above = math.ceil(BRACKETS * (n / facts["rows"] + 2 / SKETCH))
    near = numbered if above >= BRACKETS else numbered.where(F.col("_n") <= F.lit(facts["at"][above]))
    return near.orderBy("_n", "_h", *(keys or df.columns)).limit(n).drop("_h", "_n")
