import pytest

from txwarden import jobs
from txwarden.sources.numbered import Overtaken
from txwarden.streaming import compaction
from txwarden.streaming.compaction import clean_log, done_batches, fold_log, log_table
from txwarden.streaming.inference_log import append_log, read_log, write_log
from txwarden.streaming.runs import batch_folder

SCHEMA = "n int, fraud_probability double"


def rows(spark, *numbers):
    return spark.createDataFrame([(n, 0.5) for n in numbers], SCHEMA)


def held(spark, path):
    return sorted(r.n for r in read_log(spark, path).collect())


def folded(tmp_path):
    return sorted(x.name for x in (tmp_path / "_folded").iterdir() if x.name != "states")


@pytest.fixture
def log(spark, tmp_path):
    path = str(tmp_path)
    for run in ("a", "b"):
        for number in range(3):
            write_log(rows(spark, number, 10 + number), path, run, number)
    append_log(rows(spark, 99), path)
    return path


ALL = sorted([0, 1, 2, 10, 11, 12] * 2 + [99])


def test_each_row_once_before_during_and_after(spark, log, tmp_path, monkeypatch):
    ids = {r.prediction_id for r in read_log(spark, log).collect()}
    before = read_log(spark, log)  # planned before the fold, read after it
    added = compaction.add_next

    def meanwhile(*args):
        assert held(spark, log) == ALL  # the new folder is there and nobody reads it
        write_log(rows(spark, 3), log, "a", 3)  # a stream goes on
        return added(*args)

    monkeypatch.setattr(compaction, "add_next", meanwhile)
    assert fold_log(spark, log) == 1
    assert sorted(r.n for r in before.collect()) == ALL
    assert held(spark, log) == sorted([*ALL, 3])
    assert {r.prediction_id for r in read_log(spark, log).collect()} >= ids
    monkeypatch.undo()
    # The last batch of each stream's run was left, as its stream may write it again
    assert log_table(spark, log).where("batch = 2").count() == 4
    write_log(rows(spark, 2, 12), log, "b", 2)
    write_log(rows(spark, 0, 10), log, "b", 0)  # and an older one, which is folded, adds nothing
    assert held(spark, log) == sorted([*ALL, 3])
    assert clean_log(spark, log, 3600) == 0 and (tmp_path / "run=a" / "batch=0").exists()
    assert clean_log(spark, log, 0) == 5
    assert done_batches(spark, log) == [("a", 2), ("a", 3), ("b", 2)] and held(spark, log) == sorted([*ALL, 3])
    assert sorted(r.n for r in log_table(spark, log).where("run = 'a' AND batch < 2").collect()) == [0, 1, 10, 11]


def test_a_fold_that_dies_leaves_no_trace(spark, log, tmp_path, monkeypatch):
    def die(*_):
        raise OSError("killed")

    monkeypatch.setattr(compaction, "add_next", die)
    with pytest.raises(OSError, match="killed"):
        fold_log(spark, log)
    monkeypatch.undo()
    assert len(folded(tmp_path)) == 1 and held(spark, log) == ALL
    assert fold_log(spark, log) == 1
    assert len(folded(tmp_path)) == 2 and held(spark, log) == ALL
    clean_log(spark, log, 0)
    assert len(folded(tmp_path)) == 1 and held(spark, log) == ALL


def test_of_two_folds_one_counts(spark, log, monkeypatch):
    added = compaction.add_next

    def second(*args):
        monkeypatch.undo()
        assert fold_log(spark, log) == 1
        return added(*args)

    monkeypatch.setattr(compaction, "add_next", second)
    with pytest.raises(Overtaken):
        fold_log(spark, log)
    assert held(spark, log) == ALL


def test_small_folders_are_folded_again(spark, tmp_path):
    path, want = str(tmp_path), []
    for number in range(9):
        append_log(rows(spark, number), path)
        append_log(rows(spark, -number), path)
        want += [number, -number]
        fold_log(spark, path)
        clean_log(spark, path, 0)
        assert held(spark, path) == sorted(want)
    state = compaction._state(spark, path, 9)
    assert len(folded(tmp_path)) == len(state.folders) < 9 and done_batches(spark, path) == []
    assert [x.name for x in (tmp_path / "_folded" / "states").iterdir() if x.name.isdigit()] == ["000000009"]
    assert len(state.through) <= 2  # runs whose folders are gone are forgotten
    # Folders of the stated size stay as they are
    for number in (100, 101):
        append_log(rows(spark, number), path)
    assert fold_log(spark, path, file_bytes=1) == 10
    assert compaction._state(spark, path, 10).folders[:-1] == state.folders


def test_sized_files_and_columns_that_some_batches_lack(spark, tmp_path):
    path = str(tmp_path)
    for number in range(4):
        append_log(spark.range(5000).selectExpr("id AS n", "rand(1) AS x", "0.1D AS fraud_probability"), path)
    append_log(spark.createDataFrame([(7, "late", 0.9)], "n long, extra string, fraud_probability double"), path)
    append_log(rows(spark).selectExpr("CAST(n AS long) AS n", "fraud_probability"), path)  # empty
    size = sum(f.stat().st_size for f in tmp_path.glob("run=*/*/part-*"))
    assert read_log(spark, path).count() == 20001
    fold_log(spark, path, file_bytes=size // 3)
    files = [f.stat().st_size for f in tmp_path.glob("_folded/*/part-*")]
    assert 2 <= len(files) <= 4 and read_log(spark, path).count() == 20001
    assert [r.n for r in read_log(spark, path).where("extra = 'late'").collect()] == [7]


def test_unfinished_batches_wait(spark, log, tmp_path):
    (tmp_path / "run=a" / "batch=1" / "_SUCCESS").unlink()
    fold_log(spark, log)
    assert held(spark, log) == sorted([0, 2, 10, 12, 0, 1, 2, 10, 11, 12, 99])
    write_log(rows(spark, 1, 11), log, "a", 1)
    write_log(rows(spark, 3), log, "a", 3)
    assert fold_log(spark, log) == 2 and held(spark, log) == sorted([*ALL, 3])


def test_nothing_to_fold(spark, tmp_path):
    path = str(tmp_path)
    assert fold_log(spark, path) == 0 and clean_log(spark, path, 0) == 0
    write_log(rows(spark, 1), path, "a", 0)
    assert fold_log(spark, path) == 0 and held(spark, path) == [1]
    spark.range(3).write.parquet(f"{path}/plain")
    assert read_log(spark, f"{path}/plain").count() == 3


def test_job(spark, log, tmp_path):
    assert jobs.main(["fold", "--log", log, "--keep-hours", "0"], spark) == 1
    assert held(spark, log) == ALL and not (tmp_path / batch_folder("x", "a", 0)[2:]).exists()
