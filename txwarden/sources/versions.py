"""Versions of a model: saved side by side, never changed, and promoted one after the other.

    PATH/versions/NAME       a saved model
    PATH/promoted/000000007  the name of the version that the seventh promotion put in charge

Promotions are numbered states (`sources.numbered`): of two writers that saw the same version in charge one wins and the other is
told. What is in charge is the highest number; older ones stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from txwarden.plans.training import score_rows
from txwarden.sources.numbered import Overtaken, add_next, at, numbers, text_of
from txwarden.sources.sinks import load_model, save_model


def save_version(model: PipelineModel, path: str) -> str:
    """Save a model as a new version, which nothing uses yet."""
    name = uuid.uuid4().hex
    save_model(model, f"{path}/versions/{name}")
    return name


def in_charge(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The number of the last promotion and the version it names; 0 and None before the first."""
    last = max(numbers(spark, f"{path}/promoted"), default=0)
    return last, text_of(spark, f"{path}/promoted", last) if last else None


def promote(spark: SparkSession, path: str, version: str, after: int) -> int:
    """Put a version in charge, given the number of the promotion that the caller saw last; the new number.

    `Overtaken` if another promotion has come since, `FileNotFoundError` if there is no such version.
    """
    saved, files = at(spark, f"{path}/versions/{version}/metadata")
    if not files.exists(saved):
        raise FileNotFoundError(f"no version {version}")
    if in_charge(spark, path)[0] != after:
        raise Overtaken(f"promotion {after} is no longer the last one")
    return add_next(spark, f"{path}/promoted", version, after)


def load_in_charge(spark: SparkSession, path: str) -> PipelineModel:
    version = in_charge(spark, path)[1]
    if version is None:
        raise FileNotFoundError(f"no version is in charge at {path}")
    return load_model(f"{path}/versions/{version}")


def current_scorer(spark: SparkSession, path: str, score: Callable[[PipelineModel, DataFrame], DataFrame] = score_rows
                   ) -> Callable[[DataFrame], DataFrame]:
    """Scores by the version in charge at the time of each call; a loaded version is kept until another is in charge.

    As the scorer of `scored_writer`, which calls it once a batch, a stream takes up a new version at the border of two
    batches, and every batch has one.
    """
    held: dict[str, PipelineModel] = {}

    def run(rows: DataFrame) -> DataFrame:
        version = in_charge(spark, path)[1]
        if version is None:
            raise FileNotFoundError(f"no version is in charge at {path}")
        if version not in held:
            held.clear()
            held[version] = load_model(f"{path}/versions/{version}")
        return score(held[version], rows)

    return run
