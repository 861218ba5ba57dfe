"""Tables between the steps of a job, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txwarden.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet under the shared folder and read again: later steps do not recompute them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    """The number of shuffle partitions the session is set to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
