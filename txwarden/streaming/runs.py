"""Folders of streaming results: one for each run of a query, and in it one for each batch.

A run is known by the id that Spark keeps in the query's checkpoint. A restart from the checkpoint
goes on in its folder, and a replayed batch replaces its own rows; another checkpoint has another
id and never touches what is there.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def run_id(spark: SparkSession, checkpoint: str) -> str:
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def batch_folder(path: str, run: str, number: int) -> str:
    return f"{path}/run={run}/batch={number}"


def lone_run() -> str:
    """The id of a run that has one batch only."""
    return f"lone-{uuid.uuid4()}"


def ended(run: str) -> bool:
    """Whether no batch of the run is ever written again."""
    return run.startswith("lone-")
