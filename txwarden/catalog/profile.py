"""Profiles, quality, fills, splits and samples of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.catalog.inputs import GAPPED, SALES, TX, gapped, sales, table, transactions
from txwarden.catalog.registry import query
from txwarden.operators import profile as p
from txwarden.operators.prepare import (
    drop_repeats, fill_medians, medians, sample_rows, stratified_split, stratified_split_exact,
)
from txwarden.operators.sla import latency_report, limit_checks
from txwarden.plans.training import three_way_split


@query("A1", "SELECT count(*) AS total_rows FROM lineitem")
def total_rows(spark, folder) -> DataFrame:
    return p.row_count(sales(spark, folder))


@query("A2", SALES + 'SELECT "Class", count(*) AS n FROM sales GROUP BY "Class"')
def class_sizes(spark, folder) -> DataFrame:
    return p.class_counts(sales(spark, folder))


@query("A3", SALES + """
SELECT CAST(count_if("Class" = 0) AS BIGINT) AS negatives, CAST(count_if("Class" = 1) AS BIGINT) AS positives,
       count_if("Class" = 0) / count_if("Class" = 1) AS scale_pos_weight FROM sales""")
def positive_class_weight(spark, folder) -> DataFrame:
    return p.class_weight(sales(spark, folder))


@query("A4", TX + """
SELECT CAST(sum("Class") AS BIGINT) AS fraud_count, count(*) AS total_count, sum("Class") / count(*) * 100 AS fraud_rate,
       (count(*) - sum("Class")) / sum("Class") AS imbalance_ratio FROM tx""")
def fraud_balance(spark, folder) -> DataFrame:
    return p.class_balance(transactions(spark, folder))


@query("A5", GAPPED + """
SELECT 'event_id' AS "column", count(*) - count(event_id) AS missing FROM gapped
UNION ALL SELECT 'user_id', count(*) - count(user_id) FROM gapped
UNION ALL SELECT 'Amount', count(*) - count("Amount") FROM gapped
UNION ALL SELECT 'Class', count(*) - count("Class") FROM gapped
UNION ALL SELECT 'score', count(*) - count(score) FROM gapped
UNION ALL SELECT 'event_type', count(*) - count(event_type) FROM gapped""")
def missing_by_column(spark, folder) -> DataFrame:
    return p.missing_values(gapped(spark, folder))


@query("A5", GAPPED + 'SELECT CAST(sum((user_id IS NULL)::INT + ("Amount" IS NULL)::INT) AS BIGINT) AS missing FROM gapped')
def missing_in_all(spark, folder) -> DataFrame:
    return p.total_missing(gapped(spark, folder))


@query("A6", """
SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_quantity, l_discount, l_tax, l_returnflag FROM lineitem))
       AS duplicate_rows FROM lineitem""")
def repeated_rows(spark, folder) -> DataFrame:
    return p.duplicate_rows(table(spark, folder, "lineitem").select("l_partkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"))


LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@query("A5 A7", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", CASE WHEN any_value(typeof({c})) IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'number'
       WHEN any_value(typeof({c})) = 'VARCHAR' THEN 'text' ELSE 'other' END AS kind, count(*) - count({c}) AS missing FROM lineitem""" for c in LINE_COLUMNS))
def column_kind_counts(spark, folder) -> DataFrame:
    """Kind and gaps of every column."""
    rows = table(spark, folder, "lineitem")
    kinds = p.column_kinds(rows)["data_types"]
    named = {"bigint": "number", "int": "number", "double": "number", "string": "text"}
    frame = spark.createDataFrame([(c, named.get(k, "other")) for c, k in kinds.items()], "column string, kind string")
    return p.missing_values(rows).join(F.broadcast(frame), "column").select("column", "kind", "missing")  # one row per column


@query("A8", SALES + """
SELECT "Class", count(*) AS n, round(avg("Amount"), 4) AS mean_amount, round(quantile_cont("Amount", 0.5), 4) AS median_amount
FROM sales GROUP BY "Class" """)
def amounts_by_class(spark, folder) -> DataFrame:
    out = p.amount_by_class(sales(spark, folder))
    return out.withColumns({c: F.round(c, 4) for c in ("mean_amount", "median_amount")})


@query("A9", """
SELECT round(quantile_cont(l_quantity, 0.5), 6) AS l_quantity, round(quantile_cont(l_extendedprice, 0.5), 6) AS l_extendedprice,
       round(quantile_cont(l_discount, 0.5), 6) AS l_discount, round(quantile_cont(l_tax, 0.5), 6) AS l_tax FROM lineitem""")
def column_medians(spark, folder) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    found = medians(table(spark, folder, "lineitem"), columns)
    return spark.createDataFrame([tuple(found[c] for c in columns)], ", ".join(f"{c} double" for c in columns)).select(
        *[F.round(c, 6).alias(c) for c in columns]
    )


@query("A9", GAPPED + """
SELECT event_id, coalesce(CAST(user_id AS DOUBLE), (SELECT quantile_cont(user_id, 0.5) FROM gapped)) AS user_id,
       round(coalesce("Amount", (SELECT quantile_cont("Amount", 0.5) FROM gapped)), 6) AS "Amount", "Class" FROM gapped""")
def filled_rows(spark, folder) -> DataFrame:
    filled = fill_medians(gapped(spark, folder).select("event_id", "user_id", "Amount", "Class"))
    return filled.select("event_id", F.col("user_id").cast("double").alias("user_id"), F.round("Amount", 6).alias("Amount"), "Class")


@query("U1", GAPPED + 'SELECT DISTINCT user_id, "Class", score FROM gapped')
def rows_without_repeats(spark, folder) -> DataFrame:
    return drop_repeats(gapped(spark, folder).select("user_id", "Class", "score"))


@query("A11 P16", TX + 'SELECT max("Time") / 86400 AS days FROM tx')
def days_covered(spark, folder) -> DataFrame:
    return p.time_span(transactions(spark, folder))


@query("A12", TX + """
, long AS (SELECT 'Amount' AS c, "Amount" AS v, "Class" AS y FROM tx UNION ALL SELECT 'Time', "Time" / 3600, "Class" FROM tx
         UNION ALL SELECT 'score', score, "Class" FROM tx),
ends AS (SELECT c, min(v) AS lo, max(v) AS hi FROM long GROUP BY c),
edges AS (SELECT c, CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / 50) AS low,
                 CASE WHEN i = 49 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 50) END AS high FROM ends, range(50) r(i))
SELECT e.c AS "column", e.bin, round(e.low, 6) AS low, round(e.high, 6) AS high,
       CAST(coalesce(count_if(y = 0), 0) AS BIGINT) AS negatives, CAST(coalesce(count_if(y = 1), 0) AS BIGINT) AS positives
FROM edges e LEFT JOIN long l ON l.c = e.c AND l.v >= e.low AND (l.v < e.high OR (e.bin = 49 AND l.v <= e.high))
GROUP BY ALL""")
def class_histograms(spark, folder) -> DataFrame:
    tx = transactions(spark, folder).withColumn("Time", F.col("Time") / 3600)
    out = p.histograms(tx, ["Amount", "Time", "score"])
    return out.withColumns({c: F.round(c, 6) for c in ("low", "high")})


@query("A13", SALES + """
, q AS (SELECT "Class", quantile_cont("Amount", 0.25) AS q1, quantile_cont("Amount", 0.5) AS med,
               quantile_cont("Amount", 0.75) AS q3 FROM sales GROUP BY "Class"),
j AS (SELECT s."Class", q1, med, q3, "Amount" AS v, "Amount" BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ins
      FROM sales s JOIN q USING ("Class"))
SELECT "Class", round(q1, 4) AS q1, round(med, 4) AS med, round(q3, 4) AS q3,
       round(least(min(v) FILTER (ins), q1), 4) AS whisker_low, round(greatest(max(v) FILTER (ins), q3), 4) AS whisker_high,
       CAST(count_if(NOT ins) AS BIGINT) AS outliers
FROM j GROUP BY "Class", j.q1, j.med, j.q3""")
def amount_boxes(spark, folder) -> DataFrame:
    out = p.box_plot(sales(spark, folder))
    return out.withColumns({c: F.round(c, 4) for c in ("q1", "med", "q3", "whisker_low", "whisker_high")})


def _hash(purpose: str) -> str:
    return f"CAST(('0x' || substr(md5('{purpose}|42|' || event_id), 1, 13)) AS BIGINT)"


@query("U3", TX + f"""
SELECT event_id, "Class", {_hash("split")} < 900719925474099 AS held_out FROM tx""")
def split_by_hash(spark, folder) -> DataFrame:
    rows = transactions(spark, folder).select("event_id", "Class")
    train, test = stratified_split(rows, ["event_id"])
    return train.withColumn("held_out", F.lit(False)).unionByName(test.withColumn("held_out", F.lit(True)))


@query("U3", TX + f"""
, n AS (SELECT "Class", count(*) AS n, (SELECT count(*) FROM tx) AS total FROM tx GROUP BY "Class"),
quota AS (SELECT "Class", n, total - ceil(0.2 * total) AS train_total, (total - ceil(0.2 * total)) * n / total AS q FROM n),
dealt AS (SELECT *, floor(q) + CASE WHEN row_number() OVER (ORDER BY floor(q) - q, "Class")
                 <= train_total - sum(floor(q)) OVER () THEN 1 ELSE 0 END AS n_train FROM quota)
SELECT event_id, t."Class", row_number() OVER (PARTITION BY t."Class" ORDER BY {_hash("split")}) <= n - n_train AS held_out
FROM tx t JOIN dealt USING ("Class")""")
def split_exact(spark, folder) -> DataFrame:
    rows = transactions(spark, folder).select("event_id", "Class")
    train, test = stratified_split_exact(rows, ["event_id"])
    return train.withColumn("held_out", F.lit(False)).unionByName(test.withColumn("held_out", F.lit(True)))


@query("U3", TX + f"""
, n AS (SELECT "Class", count(*) AS n FROM tx GROUP BY "Class"),
total AS (SELECT CAST(sum(n) AS BIGINT) AS t FROM n),
q1 AS (SELECT "Class", n, t - ceil(0.2 * t) AS keep, (t - ceil(0.2 * t)) * n / t AS q FROM n, total),
d1 AS (SELECT "Class", n, floor(q) + CASE WHEN row_number() OVER (ORDER BY floor(q) - q, "Class") <= keep - sum(floor(q)) OVER () THEN 1 ELSE 0 END AS rest FROM q1),
t2 AS (SELECT CAST(sum(rest) AS BIGINT) AS t FROM d1),
q2 AS (SELECT "Class", n, rest, t - ceil(0.2 * t) AS keep, (t - ceil(0.2 * t)) * rest / t AS q FROM d1, t2),
d2 AS (SELECT "Class", n, rest, floor(q) + CASE WHEN row_number() OVER (ORDER BY floor(q) - q, "Class") <= keep - sum(floor(q)) OVER () THEN 1 ELSE 0 END AS train FROM q2)
SELECT "Class", CAST(train AS BIGINT) AS train, CAST(rest - train AS BIGINT) AS tuned, CAST(n - rest AS BIGINT) AS reported FROM d2""")
def job_splits(spark, folder) -> DataFrame:
    """Rows of each class in the three parts that the training jobs use."""
    names = ["train", "tuned", "reported"]
    parts = three_way_split(transactions(spark, folder).select("event_id", "Class"), ["event_id"])
    every = [part.select("Class", F.lit(name).alias("side")) for name, part in zip(names, parts)]
    both = every[0].unionByName(every[1]).unionByName(every[2])
    return both.groupBy("Class").agg(*[F.count_if(F.col("side") == name).alias(name) for name in names])


@query("U4", TX + f'SELECT event_id, "Amount" FROM tx ORDER BY {_hash("sample")}, event_id LIMIT 500')
def seeded_sample(spark, folder) -> DataFrame:
    return sample_rows(transactions(spark, folder).select("event_id", "Amount"), 500, ["event_id"])


@query("A33", TX + """
SELECT count(*) AS requests, round(quantile_cont("Amount", 0.95), 6) AS p95_ms, round(quantile_cont("Amount", 0.99), 6) AS p99_ms,
       round(avg("Amount"), 6) AS mean_ms, sum("Class") / count(*) AS error_rate, 1 - sum("Class") / count(*) AS check_rate FROM tx""")
def request_latency(spark, folder) -> DataFrame:
    rows = transactions(spark, folder).select("Amount", (F.col("Class") == 1).alias("failed"))
    out = latency_report(rows, "Amount", "failed")
    return out.withColumns({c: F.round(c, 6) for c in ("p95_ms", "p99_ms", "mean_ms")})


@query("A33", TX + """
, r AS (SELECT quantile_cont("Amount", 0.95) AS p95, quantile_cont("Amount", 0.99) AS p99, avg("Amount") AS m,
               sum("Class") / count(*) AS e FROM tx)
SELECT 'p95_ms' AS "check", CAST(100 AS DOUBLE) AS "limit", round(p95, 6) AS value, p95 < 100 AS passed FROM r
UNION ALL SELECT 'p99_ms', 250, round(p99, 6), p99 < 250 FROM r
UNION ALL SELECT 'mean_ms', 50, round(m, 6), m < 50 FROM r
UNION ALL SELECT 'error_rate', CAST(0.01 AS DOUBLE), round(e, 6), e < 0.01 FROM r
UNION ALL SELECT 'check_rate', CAST(0.99 AS DOUBLE), round(1 - e, 6), 1 - e > 0.99 FROM r""")
def latency_limits(spark, folder) -> DataFrame:
    rows = transactions(spark, folder).select("Amount", (F.col("Class") == 1).alias("failed"))
    return limit_checks(latency_report(rows, "Amount", "failed")).withColumn("value", F.round("value", 6))
