"""Sinks: run log, importances, drift summary, saved models."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "run_id string, kind string, key string, value string"


def run_entries(spark: SparkSession, run_id: str, params: Mapping = (), metrics: Mapping = (),
                tags: Mapping = ()) -> DataFrame:
    """Parameters, metrics and tags of one run as a long table."""
    rows = [
        (run_id, kind, key, value if isinstance(value, str) else json.dumps(value))
        for kind, entries in (("param", params), ("metric", metrics), ("tag", tags))
        for key, value in dict(entries).items()
    ]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def log_run(spark: SparkSession, path: str, run_id: str, params: Mapping = (), metrics: Mapping = (),
            tags: Mapping = ()) -> None:
    """Append one run to the runs table."""
    run_entries(spark, run_id, params, metrics, tags).coalesce(1).write.mode("append").parquet(path)


def metrics_long(df: DataFrame, run_id: str) -> DataFrame:
    """A one-row metrics table as run entries, without collecting it."""
    entries = [F.struct(F.lit(c).alias("key"), F.col(c).cast("double").cast("string").alias("value")) for c in df.columns]
    return df.select(F.explode(F.array(*entries)).alias("m")).select(
        F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"), "m.key", "m.value"
    )


def write_importances(importances: DataFrame, path: str) -> None:
    importances.coalesce(1).sortWithinPartitions(F.desc("importance"), "feature").write.mode(
        "overwrite"
    ).option("header", "true").csv(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """Append a drift summary as JSON; runs are told apart by run_id."""
    summary.write.mode("append").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Scaler and classifier are stages of one model, so neither can be loaded without the other."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
