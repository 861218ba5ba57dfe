"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed settings of a session started by this package; a cluster sets its own sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


_folders: list[tempfile.TemporaryDirectory] = []  # deleted when the process ends


def build_session(master: str | None = None, app: str = "txwarden", **extra: str) -> SparkSession:
    """A session with UTC time and adaptive execution; `extra` overrides (dots as `__`)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in `spark.checkpoint.dir`."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return found


def name_local_scratch(spark: SparkSession) -> None:
    """Give a local session without the setting a temporary folder, which goes with the process. For registered queries and tests."""
    unset = not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir()
    if unset and spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        folder = tempfile.TemporaryDirectory(prefix="txwarden-")
        _folders.append(folder)
        spark.sparkContext.setCheckpointDir(folder.name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never used before."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative fits a reliable place to cut their lineage."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote under the shared folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
