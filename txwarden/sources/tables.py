"""Table scans: CSV with a declared schema, required columns, typed guards."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.schemas import LABELLED

MALFORMED = "_corrupt_record"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = LABELLED, by_name: bool = False,
    most_malformed: float = 0.0, keep_malformed: bool = False,
) -> DataFrame:
    """A CSV table with a header, on any file system Spark can reach (file, hdfs, s3a).

    The header decides which of the declared columns are there; the types of others are inferred.
    Whole numbers may be written with a decimal point. Blank fields and NaN become NULL.

    A field that is not of its column's type becomes NULL and marks its row as malformed: more than
    a share of `most_malformed` such rows is an error, and `keep_malformed` keeps the raw line in
    `_corrupt_record`. Files whose headers differ in order are an error, or with `by_name` are read
    by name at the cost of one more pass over the text.

    `FileNotFoundError` if the path does not exist, `ValueError` if the files hold nothing.
    """
    try:
        groups = _files_by_header(spark, path) if by_name else [path]
        parts = [_parse(spark, files, schema) for files in groups]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            raise FileNotFoundError("CSV file not found") from None
        raise
    if not parts:
        raise ValueError("CSV file is empty")
    df = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # The hash makes the scan parse every column, not only those a count needs.
    every = F.max(F.xxhash64(*df.columns))
    facts = df.agg(F.count("*").alias("rows"), F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed"), every).first()
    if not facts["rows"]:
        raise ValueError("CSV file is empty")
    if facts["malformed"] > most_malformed * facts["rows"]:
        raise ValueError(f"{facts['malformed']} of {facts['rows']} rows are malformed")
    return df if keep_malformed else df.drop(MALFORMED)


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """Files grouped by their first line; one row per file comes to the driver."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    heads = lines.where("at = 0").groupBy("file").agg(F.first("value").alias("head")).collect()
    groups: dict[str, list[str]] = {}
    for r in sorted(heads, key=lambda r: r["file"]):
        groups.setdefault(r["head"], []).append(r["file"])
    return list(groups.values())


def _parse(spark: SparkSession, files: str | list[str], schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("header", "true").option("nullValue", "NaN")
    names = reader.csv(files).columns
    if not names:
        raise ValueError("CSV file is empty")
    declared = {f.name: f.dataType for f in schema} if schema is not None else {}
    types = dict(declared)
    if any(c not in declared for c in names):
        types = {f.name: f.dataType for f in reader.option("inferSchema", "true").csv(files).schema} | declared
    whole = [c for c in names if isinstance(types[c], T.IntegerType)]
    read_as = [T.StructField(c, T.DoubleType() if c in whole else types[c]) for c in names]
    rows = (
        spark.read.schema(T.StructType([*read_as, T.StructField(MALFORMED, T.StringType())]))
        .option("header", "true").option("nullValue", "NaN").option("enforceSchema", "false")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).csv(files)
    )
    partial = functools.reduce(lambda a, b: a | b, [_fraction(c) for c in whole], F.lit(False))
    marked = F.when(F.col(MALFORMED).isNotNull(), F.col(MALFORMED)).when(partial, F.concat_ws(",", *names))
    return rows.select(*[_as_whole(c) if c in whole else F.col(c) for c in names], marked.alias(MALFORMED))


def _fraction(column: str) -> Column:
    return F.coalesce(F.col(column) != F.floor(column), F.lit(False))


def _as_whole(column: str) -> Column:
    return F.when(~_fraction(column), F.col(column).cast("int")).alias(column)


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def read_transactions(
    spark: SparkSession, path: str, schema: T.StructType | None = LABELLED, by_time: bool = False,
    required: Sequence[str] = ("Class",), tiebreak: Sequence[str] = (), **options,
) -> DataFrame:
    """CSV scan that checks its columns and, on request, sorts by Time."""
    df = require_columns(read_csv(spark, path, schema, **options), required)
    if by_time and "Time" in df.columns:
        return df.orderBy("Time", *tiebreak)
    return df
