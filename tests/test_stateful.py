import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txwarden.streaming import alerts as a
from txwarden.streaming.counters import counter_rates, step_summaries
from txwarden.streaming.rates import latest_rows, latest_writer
from txwarden.streaming.runs import batch_folder, run_id
from txwarden.streaming.stateful import drop_repeats, last_number, numbered_writer

START = datetime(2024, 1, 1)
MESSAGE = "transaction_id string, timestamp timestamp, p double"


def sent(spark, path, rows):
    spark.createDataFrame([(k, START + timedelta(minutes=m) if m is not None else None, p) for k, m, p in rows], MESSAGE).coalesce(1).write.mode("append").parquet(path)


def test_repeats_are_dropped_and_forgotten(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / x) for x in "soc")
    stream = lambda: a.file_writer(drop_repeats(spark.readStream.schema(MESSAGE).parquet(source), within="10 minutes"), out, checkpoint)
    first = [(f"t{i}", i, 0.9) for i in range(5)] + [(None, 1, 0.9), (None, 1, 0.9), ("no time", None, 0.9), ("no time", None, 0.9)]
    sent(spark, source, first)
    query = a.run_available(stream())
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) == 5
    sent(spark, source, first[:5] + [("t2", 3, 0.9)])  # a replayed batch, and one more repeat
    a.run_available(stream())
    assert spark.read.parquet(out).groupBy().agg(F.count("*"), F.count_distinct("transaction_id")).first()[:] == (9, 6)
    sent(spark, source, [("later", 200, 0.9)])  # moves the watermark on
    a.run_available(stream())
    sent(spark, source, [("latest", 201, 0.9)])
    query = a.run_available(stream())
    last = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1]
    assert last == 2  # what the first batches left is gone
    sent(spark, source, [("t1", 1, 0.9)])  # behind the watermark: dropped as late
    a.run_available(stream())
    assert spark.read.parquet(out).where("transaction_id = 't1'").count() == 1


def test_repeats_of_a_table(spark, tmp_path):
    sent(spark, str(tmp_path / "t"), [("x", 1, 0.9), ("x", 2, 0.9), (None, 1, 0.9), (None, 1, 0.9)])
    assert drop_repeats(spark.read.parquet(str(tmp_path / "t"))).count() == 3


def test_numbers_go_on_over_batches_restarts_and_replays(spark, tmp_path):
    source, out, state, checkpoint = (str(tmp_path / x) for x in ("s", "o", "n", "c"))
    stream = lambda: numbered_writer(spark.readStream.schema("id long").parquet(source), ["id"], out, state, checkpoint)
    for low, high in ((0, 10), (10, 10), (10, 25)):
        spark.range(low, high).repartition(3).coalesce(1).write.mode("append").parquet(source)
        a.run_available(stream())
    rows = spark.read.parquet(out)
    assert sorted((r.number, r.id) for r in rows.collect()) == [(i + 1, i) for i in range(25)]
    # the last batch again, as after a failure between its write and its commit
    run, last = run_id(spark, checkpoint), rows.agg(F.max("batch")).first()[0]
    before = sorted(tuple(r) for r in spark.read.parquet(batch_folder(out, run, last)).collect())
    commits = sorted((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for file in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        file.unlink(missing_ok=True)
    a.run_available(stream())
    assert sorted(tuple(r) for r in spark.read.parquet(batch_folder(out, run, last)).collect()) == before
    assert spark.read.parquet(out).count() == 25 and last_number(spark, state, run, last + 1) == 25


def plain_rates(samples, span, step):
    """The same by one loop over sorted samples (seconds, value) of a series."""
    samples, out = sorted(set(samples)), {}
    for end in range(step, int(samples[-1][0]) + span + step, step):
        inside = [s for s in samples if end - span <= s[0] < end]
        if len(inside) < 2 or inside[-1][0] == inside[0][0]:
            continue
        rise = sum(b[1] - x[1] if b[1] >= x[1] else b[1] for x, b in zip(inside, inside[1:], strict=False))
        covered = inside[-1][0] - inside[0][0]
        gap = covered / (len(inside) - 1)
        before, after = inside[0][0] - (end - span), end - inside[-1][0]
        if rise > 0 and inside[0][1] >= 0:
            before = min(before, covered * inside[0][1] / rise)
        covers = sum(x if x < 1.1 * gap else gap / 2 for x in (before, after))
        out[end] = (len(inside), rise * (covered + covers) / covered)
    return out


def series(seed):
    draw, now, value, out = random.Random(seed), 0.0, 3.0, []
    for _ in range(120):
        now += draw.choice([15, 15, 15, 16, 70])
        value = draw.uniform(0, 4) if draw.random() < 0.08 else value + draw.choice([0, 1, 5.5])
        out.append((now, value))
    return out


@pytest.mark.parametrize("stream", [False, True])
def test_rates_of_counters_that_reset(spark, tmp_path, stream):
    data = {"a": series(1), "b": series(2), "one": [(30.0, 4.0)]}
    rows = [(k, START + timedelta(seconds=t), v) for k, some in data.items() for t, v in some]
    rows += [("a", None, 1.0), ("a", START, None), ("b", START, float("nan")), rows[3]]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "kind string, ts timestamp, v double")
    summaries = step_summaries(df, "ts", "v", ["kind"])
    if stream:
        for part in df.randomSplit([1.0, 1.0, 1.0], 5):
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        a.run_available(latest_writer(step_summaries(source, "ts", "v", ["kind"], late="1 day"), str(tmp_path / "o"), str(tmp_path / "c")))
        summaries = latest_rows(spark.read.parquet(str(tmp_path / "o")), ["slice", "kind"])
    got = {}
    for r in counter_rates(summaries, ["kind"]).collect():
        got.setdefault(r.kind, {})[int((r.window_end - START).total_seconds())] = (r.n, r.increase, r.per_second)
    assert set(got) == {"a", "b"}
    for kind in got:
        want = plain_rates(data[kind], 300, 60)
        assert set(got[kind]) == set(want)
        for end, (n, increase) in want.items():
            assert got[kind][end] == (n, pytest.approx(increase), pytest.approx(increase / 300))
