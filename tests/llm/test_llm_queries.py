import glob
import os

import duckdb
import pytest

import corpus_pipeline
from txwarden.llm.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(SQL[name])
    names = sorted(d[0] for d in cursor.description)
    assert sorted(df.columns) == names
    order = [[d[0] for d in cursor.description].index(n) for n in names]
    want = sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=repr)
    got = sorted((tuple(r) for r in df.select(names).collect()), key=repr)
    assert got == want and got


def test_each_operator_has_its_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_pipeline_stages(spark):
    """What each stage must keep, stage by stage, by plain means; the operators' own tests hold them against brute force."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.collect()
    odd = [(90001, None, "en", "s", 0), (90002, "", None, None, 0), (None, rows[0].text, "en", None, 0), (rows[1].doc_id, rows[1].text, "en", "s", 0)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    spark_tables, texts = [docs], []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, spark_tables[-1], FOLDER).cache()
        assert out.columns == corpus_pipeline.COLUMNS
        assert out.exceptAll(spark_tables[-1]).count() == 0
        texts.append({r.doc_id for r in out.select("doc_id").collect()})
        spark_tables.append(out)
    quality, language, copies = texts
    assert 90001 not in quality and 90002 not in quality and None in quality
    assert len(language) >= 0.98 * len(quality) and copies <= language and None not in copies  # the row without an id is a copy
    kept = spark_tables[-1]
    assert kept.groupBy("doc_id", "text").count().filter("count > 1").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER)
    assert packed.filter("piece = 0").count() == kept.count()
    assert packed.groupBy("bin_id").agg({"n_words": "sum"}).filter("`sum(n_words)` > 2048").count() == 0


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
