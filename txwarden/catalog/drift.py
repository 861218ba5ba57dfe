"""Drift between two parts of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.catalog.inputs import SALES, sales, table, transactions, vectors
from txwarden.catalog.registry import query
from txwarden.operators import drift as d
from txwarden.operators import profiles as p
from txwarden.session import scratch_path
from txwarden.sources.sinks import write_summary

COLUMNS = ["V1", "V2", "V3", "Amount", "Class"]


def _sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Finished line items as reference, open ones with a fifth added to their amounts as current."""
    rows = sales(spark, folder)
    current = rows.where("l_linestatus = 'O'").withColumn("Amount", F.col("Amount") * 1.2)
    return rows.where("l_linestatus = 'F'").select(*COLUMNS), current.select(*COLUMNS)


SIDES = SALES + """
, sided AS (SELECT l_linestatus = 'O' AS cur, "V1", "V2", "V3",
                   CASE WHEN l_linestatus = 'O' THEN "Amount" * CAST(1.2 AS DOUBLE) ELSE "Amount" END AS "Amount", "Class" FROM sales),
long AS (SELECT 'V1' AS c, "V1" AS v, cur FROM sided UNION ALL SELECT 'V2', "V2", cur FROM sided
         UNION ALL SELECT 'V3', "V3", cur FROM sided UNION ALL SELECT 'Amount', "Amount", cur FROM sided
         UNION ALL SELECT 'Class', CAST("Class" AS DOUBLE), cur FROM sided)"""

DISTANCES = """
, counts AS (SELECT c, v, count_if(NOT cur) AS r, count_if(cur) AS q FROM long GROUP BY c, v),
walk AS (SELECT c, v, lead(v) OVER w AS nv, sum(r) OVER w / sum(r) OVER (PARTITION BY c) AS fr,
                sum(q) OVER w / sum(q) OVER (PARTITION BY c) AS fq
         FROM counts WINDOW w AS (PARTITION BY c ORDER BY v)),
dist AS (SELECT c, max(abs(fr - fq)) AS ks, coalesce(sum(abs(fr - fq) * (nv - v)), 0) AS w FROM walk GROUP BY c)"""

CATEGORIES = """
, shares AS (SELECT c, v, r / sum(r) OVER (PARTITION BY c) AS p, q / sum(q) OVER (PARTITION BY c) AS s, r, q,
                    sum(r) OVER (PARTITION BY c) AS nr, sum(q) OVER (PARTITION BY c) AS nq FROM counts),
cats AS (SELECT c, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + s) / 2)) ELSE 0 END
                         + CASE WHEN s > 0 THEN s * ln(s / ((p + s) / 2)) ELSE 0 END) / 2, 0)) AS js,
                sum((q - p * nq) * (q - p * nq) / (p * nq)) AS chi, count(*) AS n,
                arg_max((p - s) / sqrt((r + q) / (nr + nq) * (1 - (r + q) / (nr + nq)) * (1 / nr + 1 / nq)), v) AS z
         FROM shares GROUP BY c)"""

SCORES = """
, dev AS (SELECT c, greatest(stddev_pop(v) FILTER (NOT cur), CAST(0.001 AS DOUBLE)) AS s FROM long GROUP BY c),
scored AS (SELECT c, CASE WHEN n <= 5 THEN 'jensenshannon' ELSE 'wasserstein' END AS method,
                  CASE WHEN n <= 5 THEN js ELSE w / s END AS score
           FROM dist JOIN cats USING (c) JOIN dev USING (c))"""


@query("A31", SIDES + DISTANCES + 'SELECT c AS "column", round(ks, 6) AS ks, round(w, 4) AS wasserstein FROM dist')
def drift_distances(spark, folder) -> DataFrame:
    out = d.distances(d.both_sides(*_sides(spark, folder), COLUMNS))
    return out.select("column", F.round("ks", 6).alias("ks"), F.round("wasserstein", 4).alias("wasserstein"))


@query("A31", SIDES.replace("long AS", "every AS") + """
, long AS (SELECT * FROM every WHERE c IN ('V2', 'Class'))
, counts AS (SELECT c, v, count_if(NOT cur) AS r, count_if(cur) AS q FROM long GROUP BY c, v)""" + CATEGORIES + """
SELECT c AS "column", round(js, 6) AS jensen_shannon, round(chi, 4) AS chi_square, n AS "values", round(z, 4) AS z FROM cats""")
def category_distances(spark, folder) -> DataFrame:
    rows = d.both_sides(*_sides(spark, folder), ["V2", "Class"])
    out = d.category_statistics(d.value_counts(rows))
    return out.select("column", F.round("jensen_shannon", 6).alias("jensen_shannon"), F.round("chi_square", 4).alias("chi_square"),
                      "values", F.round("z", 4).alias("z"))


DRIFTED = SIDES + DISTANCES + CATEGORIES + SCORES


@query("A31", DRIFTED + """
SELECT c AS "column", method, round(score, 6) AS score, CAST(0.1 AS DOUBLE) AS threshold, score >= 0.1 AS drifted FROM scored""")
def drift_scores(spark, folder) -> DataFrame:
    return d.column_drift(*_sides(spark, folder), COLUMNS).withColumn("score", F.round("score", 6))


@query("A31", DRIFTED + """SELECT c AS "column", method, score >= 0.1 AS drifted FROM scored""")
def drift_flags_from_bins(spark, folder) -> DataFrame:
    return d.column_drift(*_sides(spark, folder), COLUMNS, precise=False).select("column", "method", "drifted")


@query("A31 S7", DRIFTED + """SELECT c AS "column", method, score >= 0.1 AS drifted FROM scored""")
def drift_from_profile(spark, folder) -> DataFrame:
    """The flags against a stored profile of the reference, written in two parts and merged as it is read."""
    reference, current = _sides(spark, folder)
    path, grid = scratch_path(spark, "profile"), None
    for part in (0, 1):
        own = reference.where(F.pmod(F.xxhash64(*COLUMNS), F.lit(2)) == part)
        grid = grid or p.new_grid(own, COLUMNS)
        p.save_profile(p.build_profile(own, COLUMNS, grid), path, str(part))
    return p.profile_drift(p.load_profile(spark, path), current, COLUMNS).select("column", "method", "drifted")


@query("A32", DRIFTED + """
SELECT count(*) AS n_columns, CAST(count_if(score >= 0.1) AS BIGINT) AS n_drifted, count_if(score >= 0.1) / count(*) >= 0.5 AS dataset_drift,
       bool_or(c = 'Amount' AND score >= 0.1) AS target_drift,
       count_if(score >= 0.1) / count(*) >= 0.5 OR bool_or(c = 'Amount' AND score >= 0.1) AS drift_detected FROM scored""")
def drift_decision(spark, folder) -> DataFrame:
    return d.drift_flags(d.column_drift(*_sides(spark, folder), COLUMNS), target="Amount")


VECTOR_COLUMNS = [f"V{i}" for i in range(1, 65)]


def _vector_sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    rows = vectors(spark, folder)
    return rows.where("label < 5"), rows.where("label >= 5")


@query("A31", """
WITH long AS (SELECT 'V' || i AS c, CAST(embedding[i] AS DOUBLE) AS v, label >= 5 AS cur
              FROM embeddings, (SELECT CAST(range AS INTEGER) AS i FROM range(1, 65)))""" + DISTANCES + """
SELECT c AS "column", round(ks, 6) AS ks FROM dist""")
def drift_distances_vectors(spark, folder) -> DataFrame:
    out = d.distances(d.both_sides(*_vector_sides(spark, folder), VECTOR_COLUMNS))
    return out.select("column", F.round("ks", 6).alias("ks"))


@query("A31", """
WITH long AS (SELECT 'V' || i AS c, CAST(embedding[i] AS DOUBLE) AS v, label >= 5 AS cur
              FROM embeddings, (SELECT CAST(range AS INTEGER) AS i FROM range(1, 65)))""" + DISTANCES + """
, sizes AS (SELECT c, count_if(NOT cur) AS n, count_if(cur) AS m FROM long GROUP BY c),
eff AS (SELECT c, ks, sqrt(n * m / (n + m)) AS s FROM dist JOIN sizes USING (c)),
lam AS (SELECT c, (s + 0.12 + 0.11 / s) * ks AS l FROM eff),
tail AS (SELECT c, CASE WHEN l < 0.2 THEN 1 ELSE least(greatest(2 * list_sum(list_transform(range(1, 101),
           lambda k: CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0 * k * k * l * l))), 0), 1) END AS p FROM lam)
SELECT c AS "column", 'ks' AS method, round(CAST(p AS DOUBLE), 6) AS score, CAST(0.05 AS DOUBLE) AS threshold, p < 0.05 AS drifted FROM tail""")
def drift_tests_vectors(spark, folder) -> DataFrame:
    return d.column_drift(*_vector_sides(spark, folder), VECTOR_COLUMNS, method=d.TESTS).withColumn("score", F.round("score", 6))


@query("A31", """
WITH s AS (SELECT quality, count(*) AS n, avg(toxic) AS p, sum(toxic) AS k FROM labels GROUP BY quality),
z AS (SELECT (a.p - b.p) / sqrt((a.k + b.k) / (a.n + b.n) * (1 - (a.k + b.k) / (a.n + b.n)) * (1 / a.n + 1 / b.n)) AS z
      FROM s a, s b WHERE a.quality = 1 AND b.quality = 0)
SELECT 'toxic' AS "column", 'z' AS method, CAST(0.05 AS DOUBLE) AS threshold, abs(z) > 1.959963985 AS drifted FROM z""")
def drift_tests_labels(spark, folder) -> DataFrame:
    """The flag of the two-proportion test, against its critical value."""
    rows = table(spark, folder, "labels")
    return d.column_drift(rows.where("quality = 1"), rows.where("quality = 0"), ["toxic"], method=d.TESTS).drop("score")


@query("A30", "SELECT count(*) >= 100 AS enough, count(*) >= 1000000000 AS enough_for_more FROM events")
def row_gate(spark, folder) -> DataFrame:
    rows = transactions(spark, folder)
    return spark.createDataFrame([(d.enough_rows(rows), d.enough_rows(rows, 1_000_000_000))], "enough boolean, enough_for_more boolean")


EVENT_SIDES = """
WITH sided AS (
  SELECT event_type IN ('click', 'view', 'error') AS cur, value AS "Amount", user_id,
         CASE WHEN event_type IN ('click', 'view', 'error') THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) / CAST(100 AS DOUBLE)
              ELSE CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END END AS target,
         CASE WHEN event_type IN ('click', 'error') THEN 'x' END AS note FROM events)"""


def _event_sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    tx = transactions(spark, folder)
    old = tx.where("event_type IN ('purchase', 'signup')").select(
        "Amount", "user_id", (F.col("event_type") == "signup").cast("int").alias("Class")
    )
    note = F.when(F.col("event_type") != "view", F.lit("x")).alias("note")
    new = tx.where("event_type IN ('click', 'view', 'error')").select("Amount", "user_id", F.col("score").alias("prediction"), note)
    return old, new


@query("S7 A5 A6 A7 A31 A32 U1 P6 P7", EVENT_SIDES + """
, kept AS (SELECT DISTINCT cur, "Amount", user_id, target, note FROM sided),
long AS (SELECT 'Amount' AS c, "Amount" AS v, cur FROM kept UNION ALL SELECT 'target', target, cur FROM kept)""" + DISTANCES + CATEGORIES + SCORES + """
, decided AS (SELECT *, score >= 0.1 AS f, count_if(score >= 0.1) OVER () / count(*) OVER () >= 0.5 AS dataset_drift,
              bool_or(c = 'target' AND score >= 0.1) OVER () AS target_drift FROM scored)
SELECT 'events' AS run_id, 'compared' AS status, dataset_drift, target_drift,
       (SELECT count(*) FROM sided WHERE cur) AS total_rows,
       (SELECT count(*) FROM sided WHERE cur) - (SELECT count(*) FROM kept WHERE cur) AS duplicate_rows,
       CAST(3 AS BIGINT) AS numeric_columns, CAST(1 AS BIGINT) AS categorical_columns, (SELECT count_if(note IS NULL) FROM sided WHERE cur) AS missing_notes,
       'string' AS note_type, c AS "column", method, round(score, 6) AS score, CAST(0.1 AS DOUBLE) AS threshold, f AS drifted, f AS flag FROM decided""")
def drift_summary(spark, folder) -> DataFrame:
    """The stored summary beside the stored table of columns."""
    path, columns = scratch_path(spark, "drift-summary"), scratch_path(spark, "drift-columns")
    summary = d.drift_job(*_event_sides(spark, folder))
    write_summary(d.summary_frame(spark, summary, "events"), path)
    d.columns_frame(spark, summary, "events").write.mode("append").parquet(columns)
    stored = spark.read.schema(d.SUMMARY).json(path)
    joined = spark.read.parquet(columns).join(stored, "run_id")
    return joined.select(
        "run_id", "status", "dataset_drift", "target_drift", "total_rows", "duplicate_rows", F.col("numeric_columns").cast("long").alias("numeric_columns"),
        F.col("categorical_columns").cast("long").alias("categorical_columns"), F.col("missing_values")["note"].alias("missing_notes"),
        F.col("data_types")["note"].alias("note_type"), "column", "method", F.round("score", 6).alias("score"), "threshold", "drifted",
        F.col("column_drifts")[F.col("column")].alias("flag"),
    )


@query("A30 S7", EVENT_SIDES + """
SELECT r AS run_id, 'insufficient_data' AS status, count_if(cur) AS total_rows, CAST(1000000000000 AS BIGINT) AS minimum FROM sided, (VALUES ('one'), ('two')) t(r) GROUP BY r""")
def drift_gate(spark, folder) -> DataFrame:
    """Runs stopped by the gate are stored as well, one after the other."""
    path = scratch_path(spark, "drift-summary")
    for run in ("one", "two"):
        write_summary(d.summary_frame(spark, d.drift_job(*_event_sides(spark, folder), minimum=10**12), run), path)
    return spark.read.schema(d.SUMMARY).json(path).select("run_id", "status", "total_rows", "minimum")
