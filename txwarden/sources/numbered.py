"""A folder of numbered states, of which the highest counts; a writer adds the next one only if no other came first.

A state is written aside and renamed to the next number, which the file system refuses if that is there; so of two writers that
saw the same state one wins and the other is told, and a writer that dies leaves nothing behind that counts. That needs a file
system whose rename without overwriting is atomic (HDFS is; an object store has to offer it, and on a local disk two renames in
the same instant are not kept apart). Older states stay.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Overtaken(RuntimeError):
    """Another writer came first."""


def at(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, folder: str) -> dict[int, int]:
    """Number and time of writing, in milliseconds since 1970, of each state."""
    where, files = at(spark, folder)
    if not files.exists(where):
        return {}
    return {int(f.getPath().getName()): f.getModificationTime() for f in files.listStatus(where) if f.getPath().getName().isdigit()}


def text_of(spark: SparkSession, folder: str, number: int) -> str:
    return spark.read.text(f"{folder}/{number:09d}").first()["value"]


def add_next(spark: SparkSession, folder: str, text: str, after: int) -> int:
    """Add one line of text as the state that follows `after`; `Overtaken` if there is one already."""
    aside, files = at(spark, f"{folder}/.{uuid.uuid4().hex}")
    where, _ = at(spark, f"{folder}/{after + 1:09d}")
    out = files.create(aside, False)
    try:
        out.write(bytearray(f"{text}\n".encode()))
    finally:
        out.close()
    hadoop, gateway = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    context = hadoop.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(aside, where, gateway.new_array(hadoop.Options.Rename, 0))
    except Py4JJavaError as e:
        files.delete(aside, False)
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        raise Overtaken(f"state {after + 1} was written by another writer") from None
    return after + 1
