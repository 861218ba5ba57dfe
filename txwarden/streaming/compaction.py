"""Folding of a log's many small batch folders into sized files, while streams append and readers read.

    PATH/run=R/batch=N          a batch as its writer left it, done when it holds _SUCCESS
    PATH/_folded/NAME           rows of many batches, in files of about a stated size
    PATH/_folded/states/000003  what the third fold made current: the folded folders, and for each run the last batch in them

A fold writes a new folder, which nobody reads, and then adds the next state (`sources.numbered`), which replaces the batches in
one step. A reader takes the newest state first and then every done batch beyond it, so it sees each row once, whichever state
it took: batch folders stay until `clean_log` removes them. A fold that dies before its state leaves a folder that no reader
looks at and `clean_log` removes. Of two folds from the same state one is told that it was `Overtaken`.

The last batch of a run can be replayed by its stream and is left alone; runs of `append_log` end with their one batch. Only
batches before the first that is not done are folded, so that one number for each run says what is covered.
"""

from __future__ import annotations

import json
import math
import re
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwarden.sources.numbered import add_next, at, numbers, text_of
from txwarden.streaming.runs import batch_folder, ended

FILE_BYTES = 256 << 20


@dataclass(frozen=True)
class State:
    """`folders`: name and bytes of each folded folder; `through`: the last folded batch of each run."""

    folders: tuple[tuple[str, int], ...] = ()
    through: dict[str, int] = field(default_factory=dict)

    def covers(self, run: str, number: int) -> bool:
        return number <= self.through.get(run, -1)


def _states(path: str) -> str:
    return f"{path}/_folded/states"


def _state(spark: SparkSession, path: str, number: int) -> State:
    if not number:
        return State()
    told = json.loads(text_of(spark, _states(path), number))
    return State(tuple((n, b) for n, b in told["folders"]), told["through"])


def _found(spark: SparkSession, path: str, inside: str = "") -> list:
    """Statuses of the files that each batch folder holds by a pattern, or of the folders themselves."""
    where, files = at(spark, re.sub(r"([\[\]{}*?\\])", r"\\\1", path) + "/run=*/batch=*" + inside)
    return list(files.globStatus(where) or [])


def _batch(folder) -> tuple[str, int]:
    return folder.getParent().getName().partition("=")[2], int(folder.getName().partition("=")[2])


def done_batches(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Run and number of every batch that was written to its end."""
    return sorted(_batch(f.getPath().getParent()) for f in _found(spark, path, "/_SUCCESS"))


def _rows(spark: SparkSession, path: str, batches: list[tuple[str, int]], folders: list[str]) -> DataFrame | None:
    """Rows of batches and folded folders with their run and batch; a column that some lack is null there."""
    read = spark.read.option("mergeSchema", True)
    parts = []
    if batches:
        parts.append(read.option("basePath", path).parquet(*[batch_folder(path, *b) for b in batches]))
    if folders:
        parts.append(read.parquet(*[f"{path}/_folded/{name}" for name in folders]))
    parts = [p.withColumns({"run": F.col("run").cast("string"), "batch": F.col("batch").cast("long")}) for p in parts]
    return parts[0].unionByName(parts[1], allowMissingColumns=True) if len(parts) == 2 else parts[0] if parts else None


def log_table(spark: SparkSession, path: str) -> DataFrame | None:
    """Each row of the log once, with run and batch; None if there is no batch yet."""
    state = _state(spark, path, max(numbers(spark, _states(path)), default=0))
    live = [b for b in done_batches(spark, path) if not state.covers(*b)]
    return _rows(spark, path, live, [name for name, _ in state.folders])


def _foldable(spark: SparkSession, path: str, state: State) -> list[tuple[str, int]]:
    done, runs = set(done_batches(spark, path)), {}
    for f in _found(spark, path):
        run, number = _batch(f.getPath())
        runs.setdefault(run, []).append(number)
    out = []
    for run, held in runs.items():
        last = max(held)
        for number in sorted(n for n in held if not state.covers(run, n)):
            if (run, number) not in done or (number == last and not ended(run)):
                break
            out.append((run, number))
    return sorted(out)


def fold_log(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> int:
    """Fold what can be folded into files of about `file_bytes`; the number of the state that is current then.

    Earlier folded folders below that size are folded again if they hold no more bytes than what is being folded, the latest
    first; so the folded bytes at least double each time that a row is written again. Rows are not shuffled. With less than
    two folders to fold nothing is done. A log without batches has state 0.
    """
    number = max(numbers(spark, _states(path)), default=0)
    state = _state(spark, path, number)
    batches = _foldable(spark, path, state)
    wanted = set(batches)
    size = sum(f.getLen() for f in _found(spark, path, "/part-*") if _batch(f.getPath().getParent()) in wanted)
    kept, again = list(state.folders), []
    while batches and kept and kept[-1][1] < file_bytes and kept[-1][1] <= size:
        name, held = kept.pop()
        again.append(name)
        size += held
    if len(batches) + len(again) < 2:
        return number
    name = uuid.uuid4().hex
    rows = _rows(spark, path, batches, again)
    rows.coalesce(max(1, math.ceil(size / file_bytes))).write.parquet(f"{path}/_folded/{name}")
    where, files = at(spark, f"{path}/_folded/{name}")
    written = files.getContentSummary(where).getLength()
    # Runs whose covered batches are all removed need no number any more.
    there = {run for run, n in (_batch(f.getPath()) for f in _found(spark, path)) if state.covers(run, n)}
    through = {run: n for run, n in state.through.items() if run in there}
    for run, n in batches:
        through[run] = max(n, through.get(run, n))
    told = {"folders": [*kept, (name, written)], "through": through}
    return add_next(spark, _states(path), json.dumps(told), number)


def clean_log(spark: SparkSession, path: str, keep_seconds: float) -> int:
    """Remove folders that no reader needs any more, and how many those were.

    These are the batches that a state older than `keep_seconds` covers, and the folded folders that are as old and named neither
    by that state nor by a later one. `keep_seconds` must be longer than any read or fold takes.
    """
    limit = (time.time() - keep_seconds) * 1000
    times = numbers(spark, _states(path))
    aged = max((n for n, at_ms in times.items() if at_ms <= limit), default=0)
    later = {n: _state(spark, path, n) for n in times if n >= aged}
    old = later.get(aged, State())
    gone = [f.getPath() for f in _found(spark, path) if old.covers(*_batch(f.getPath()))]
    where, files = at(spark, f"{path}/_folded")
    if files.exists(where):
        named = {name for state in later.values() for name, _ in state.folders} | {"states"}
        gone += [f.getPath() for f in files.listStatus(where) if f.getPath().getName() not in named and f.getModificationTime() <= limit]
    for folder in gone:
        files.delete(folder, True)
    for n in times:
        if n < aged:
            files.delete(at(spark, f"{_states(path)}/{n:09d}")[0], False)
    return len(gone)
