"""Column expressions shared by batch and streaming jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the scoring contract.
DETECT_ABOVE = 0.5
ALERT_ABOVE = 0.8
FAILED_SCORE = -1.0
PRODUCER_ID = "kafka_producer_v1"
GAP_SCALE, GAP_MIN, GAP_MAX = 0.01, 0.001, 1.0


def ratio(top: Column, bottom: Column, default: float | None = 0.0) -> Column:
    """Division that gives `default` instead of failing on an empty denominator."""
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(default).cast("double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN of every floating-point column becomes NULL, which aggregates skip."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c) if c in floating else F.col(c)
          for c in df.columns]
    )


def is_detected(score: Column, above: float = DETECT_ABOVE) -> Column:
    """Fraud flag, strictly above the threshold."""
    return F.coalesce(score > above, F.lit(False))


def is_alert(score: Column, above: float = ALERT_ABOVE) -> Column:
    """Alert test, strictly above the threshold; a missing score counts as -1."""
    return F.coalesce(score, F.lit(FAILED_SCORE)) > above


def all_present(features: Sequence[str]) -> Column:
    """Every feature holds a number."""
    test = F.lit(True)
    for name in features:
        test = test & F.col(name).isNotNull() & ~F.isnan(F.col(name))
    return test


def missing_list(features: Sequence[str]) -> Column:
    """Names of the features a row lacks, as text."""
    return F.concat_ws(
        ", ", *[F.when(F.col(c).isNull() | F.isnan(F.col(c)), F.lit(c)) for c in features]
    )


def event_time(column: str) -> Column:
    """Timestamp of a text field that holds either ISO time or epoch milliseconds."""
    text = F.col(column)
    millis = F.timestamp_millis(F.expr(f"try_cast(`{column}` AS BIGINT)"))
    return F.coalesce(F.try_to_timestamp(text), millis)


def transaction_id(number: Column) -> Column:
    return F.format_string("txn_%010d", number.cast("long"))


def label_text(label: Column) -> Column:
    return F.when(label == 1, F.lit("FRAUD")).otherwise(F.lit("NORMAL"))


def send_gap(seconds: Column) -> Column:
    """Scaled gap to the next message, kept within a millisecond and a second."""
    return F.least(F.greatest(seconds * GAP_SCALE, F.lit(GAP_MIN)), F.lit(GAP_MAX))


HASH_DIGITS = 13
HASH_RANGE = 16**HASH_DIGITS


def row_digest(keys: Sequence[str], seed: int, purpose: str) -> Column:
    """Hex text that depends only on the key values, the seed and the purpose, and sorts evenly.

    MD5, so another engine can compute the same split. The purpose keeps a sample and a later
    split with the same seed independent.
    """
    return F.md5(F.concat_ws("|", F.lit(purpose), F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def digest_below(digest: Column, number: int) -> Column:
    """Whether `digest_number` is below the number; compares text, parses nothing."""
    if number >= HASH_RANGE:
        return digest.isNotNull()
    return digest < F.lit(f"{max(number, 0):0{HASH_DIGITS}x}")


def in_share(digest: Column, share: float) -> Column:
    """Whether a digest lies in the first `share` of all digests."""
    return digest_below(digest, int(share * HASH_RANGE))


def digest_number(digest: Column) -> Column:
    """The digest's leading digits as a whole number below 2^52, exact as a double."""
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long")
