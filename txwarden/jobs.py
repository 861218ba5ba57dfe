"""Jobs for spark-submit.

    spark-submit --py-files txwarden.zip -m txwarden.jobs train --data s3a://.../transactions.csv --model ... --runs ...

    publish   CSV table to the transactions topic
    alerts    transactions topic, score with a saved model: alert topic, inference log, unreadable messages
    train     split, scale, fit, evaluate, save, log
    search    search that learns from its trials, then fit, evaluate, save and log
    drift     training table against inference log, summary as JSON, columns as a table
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txwarden.functions.expressions import ALERT_ABOVE
from txwarden.operators.drift import BY_SIZE, DISTANCES, MIN_ROWS, TESTS, columns_frame, drift_job, summary_frame
from txwarden.operators.prepare import sample_rows
from txwarden.operators.sequence import number_rows, with_metadata
from txwarden.plans.training import (
    PARZEN, RANDOM, boosted_trees, importances, optimized_training_job, quick_training_job, regularised_trees, score_rows, training_job,
)
from txwarden.schemas import INFERENCE_LOG
from txwarden.session import build_session
from txwarden.sources import kafka
from txwarden.sources.sinks import load_model, write_importances, write_summary
from txwarden.sources.tables import read_csv, read_transactions
from txwarden.sources.versions import current_scorer
from txwarden.streaming.alerts import Outputs, scored_writer
from txwarden.streaming.compaction import FILE_BYTES, clean_log, fold_log
from txwarden.streaming.inference_log import read_log


def message_records(df: DataFrame, by_time: bool = False) -> DataFrame:
    """Messages numbered in file order or by Time.

    A row's place in its file stands in for the key the table lacks; reading it again gives the
    same place.
    """
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    order = ["Time", "_place"] if by_time and "Time" in df.columns else ["_place"]
    return kafka.to_records(with_metadata(number_rows(placed, order).drop("_place"), "number"))


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    df = read_transactions(spark, args.data)
    kafka.publish(message_records(df, args.by_time), args.servers, args.topic)


def start_alerts(messages: DataFrame, args: argparse.Namespace) -> StreamingQuery:
    """One query scores each message once and writes alerts, log and unreadable messages; with `versions` each batch by the
    version in charge."""
    if bool(args.model) == bool(args.versions):
        raise ValueError("name a model or a folder of versions")
    if args.versions:
        score = current_scorer(messages.sparkSession, args.versions)
    else:
        model = load_model(args.model)
        score = lambda rows: score_rows(model, rows)
    outputs = Outputs(args.log, args.dead_letters, args.out, args.servers)
    writer = scored_writer(messages, score, outputs, args.checkpoint, args.above)
    return (writer.trigger(availableNow=True) if args.once else writer).start()


def run_alerts(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.servers:
        messages = kafka.read_stream(spark, args.servers, topic=args.source, starting=args.starting)
    else:
        messages = spark.readStream.text(args.source)
    start_alerts(messages, args).awaitTermination()


LEARNERS = {"boosted": (boosted_trees, "maxIter"), "regularised": (regularised_trees, "n_estimators")}


def train(spark: SparkSession, args: argparse.Namespace) -> dict:
    df = read_csv(spark, args.data)
    make, trees = LEARNERS[args.learner]
    options = {"params": {trees: args.trees}, "model_path": args.model, "runs_path": args.runs, "data_path": args.data, "make": make}
    if args.quick:
        done = quick_training_job(df, rows=args.quick, **options)
    else:
        done = training_job(df, **options)
    if args.importances:
        write_importances(importances(done["model"], done["features"], spark), args.importances)
    print(done["run_id"], done["metrics"])
    return done


def search(spark: SparkSession, args: argparse.Namespace) -> dict:
    df = read_csv(spark, args.data)
    if args.quick:
        df = sample_rows(df, args.quick)
    done = optimized_training_job(
        df, trials=args.trials, parallelism=args.parallelism, model_path=args.model, runs_path=args.runs, data_path=args.data,
        make=LEARNERS[args.learner][0], method=args.method, budgets=args.budgets,
    )
    print(done["best"], done["metrics"])
    return done


def drift(spark: SparkSession, args: argparse.Namespace) -> dict:
    reference = read_csv(spark, args.reference)
    current = read_csv(spark, args.current, INFERENCE_LOG) if args.current.endswith(".csv") else read_log(spark, args.current)
    summary = drift_job(reference, current, minimum=args.minimum, method=args.method)
    run = uuid.uuid4().hex
    write_summary(summary_frame(spark, summary, run), args.summary)
    if args.columns and "columns" in summary:
        columns_frame(spark, summary, run).write.mode("append").parquet(args.columns)
    print({k: v for k, v in summary.items() if k != "data_quality"})
    return summary


def fold(spark: SparkSession, args: argparse.Namespace) -> int:
    number = fold_log(spark, args.log, args.file_bytes)
    gone = clean_log(spark, args.log, args.keep_hours * 3600)
    print(f"state {number}, {gone} folders removed")
    return number


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="txwarden")
    jobs = top.add_subparsers(required=True)

    def job(name: str, run, **flags) -> None:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for flag, options in flags.items():
            sub.add_argument(f"--{flag.replace('_', '-')}", **options)

    needed, optional = {"required": True}, {"default": None}
    learner = {"choices": list(LEARNERS), "default": "boosted"}
    job("publish", publish, data=needed, servers=needed, topic={"default": kafka.TRANSACTIONS}, by_time={"action": "store_true"})
    job("alerts", run_alerts, model=optional, versions=optional, checkpoint=needed, servers=optional, source={"default": kafka.TRANSACTIONS},
        out={"default": kafka.ALERTS}, above={"type": float, "default": ALERT_ABOVE}, starting={"default": "latest"},
        log=needed, dead_letters=needed, once={"action": "store_true"})
    job("train", train, data=needed, model=optional, runs=optional, importances=optional,
        trees={"type": int, "default": 200}, quick={"type": int, "default": 0}, learner=learner)
    job("search", search, data=needed, model=optional, runs=optional, trials={"type": int, "default": 50},
        parallelism={"type": int, "default": 2}, quick={"type": int, "default": 0}, learner=learner,
        method={"choices": [PARZEN, RANDOM], "default": PARZEN}, budgets={"type": float, "nargs": "+", "default": [1.0]})
    job("drift", drift, reference=needed, current=needed, summary=needed, columns=optional, minimum={"type": int, "default": MIN_ROWS},
        method={"choices": [DISTANCES, TESTS, BY_SIZE], "default": DISTANCES})
    job("fold", fold, log=needed, file_bytes={"type": int, "default": FILE_BYTES}, keep_hours={"type": float, "default": 24.0})
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    return args.run(spark or build_session(), args)


if __name__ == "__main__":
    main()
