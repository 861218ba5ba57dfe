"""Named queries with the inventory items they cover and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from txwarden.session import name_local_scratch

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    covers: tuple[str, ...]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(covers: str, sql: str | None = None):
    """Register a function under its own name."""

    def add(run: Query) -> Query:
        @wraps(run)
        def ready(spark: SparkSession, folder: str) -> DataFrame:
            name_local_scratch(spark)
            return run(spark, folder)

        ENTRIES[run.__name__] = Entry(ready, tuple(covers.split()), sql)
        return run

    return add
