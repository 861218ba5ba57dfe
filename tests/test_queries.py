"""Every registered query next to its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from txwarden.catalog import ENTRIES

# Inventory ids of the blueprint's section 2 that a query must cover.
IDS = (
    [f"S{i}" for i in range(1, 12)] + [f"P{i}" for i in range(1, 17)] + [f"A{i}" for i in range(1, 34)]
    + ["W1", "W2", "T1", "T2", "T3", "T4", "U1", "U2", "U3", "U4", "R1", "R2"] + [f"M{i}" for i in range(1, 8)]
)


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def text(value):
    return ("NaN" if math.isnan(value) else repr(value + 0.0)) if isinstance(value, float) else repr(value)


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(text(r[i]) for i in order) for r in rows)


# No broker is available: the options are tested alone, and the jobs around them run on files.
ONLY_IN_TESTS = {"S3"}


def test_every_id_is_covered():
    assert set(IDS) - ONLY_IN_TESTS <= {i for e in ENTRIES.values() for i in e.covers}


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.sql])
def test_query_equals_sql(spark, folder, duck, name):
    df = ENTRIES[name].run(spark, folder)
    cursor = duck.execute(ENTRIES[name].sql)
    assert table(df.collect(), df.columns) == table(cursor.fetchall(), [c[0] for c in cursor.description])


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if not e.sql])
def test_query_runs(spark, folder, name):
    assert ENTRIES[name].run(spark, folder).count() > 0
