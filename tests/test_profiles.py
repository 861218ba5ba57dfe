import shutil

import numpy as np
import pytest

from txwarden.operators import drift as d
from txwarden.operators import profiles as p

COLUMNS = ["a", "b", "few", "shifted", "gone"]
SCHEMA = "a double, b double, few int, shifted double, gone double, day int"


def rows(spark, seed, n, move=0.0):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n), rng.exponential(100, n)
    some = [(float(x), None if i % 11 == 0 else float(y), int(f), float(x * 2 + move), None, i % 3) for i, (x, y, f) in enumerate(zip(a, b, rng.integers(0, 3, n), strict=True))]
    some += [(float("nan"), float("inf"), None, 0.0, None, 0)]
    return spark.createDataFrame(some, SCHEMA)


def test_flags_without_the_reference(spark, tmp_path):
    rows(spark, 1, 6000).write.parquet(str(tmp_path / "reference"))
    reference, current = spark.read.parquet(str(tmp_path / "reference")), rows(spark, 2, 2500, 0.9).cache()
    want = {r["column"]: r for r in d.column_drift(reference, current, COLUMNS).collect()}
    grid = None
    for day in (0, 1, 2):
        own = reference.where(f"day = {day}")
        grid = grid or p.new_grid(own, COLUMNS)
        for _ in range(2):  # a part that is written again replaces itself
            p.save_profile(p.build_profile(own, COLUMNS, grid), str(tmp_path / "profile"), f"d{day}")
    shutil.rmtree(tmp_path / "reference")
    profile = p.load_profile(spark, str(tmp_path / "profile"))
    got = {r["column"]: r for r in p.profile_drift(profile, current, COLUMNS).collect()}
    assert set(got) == set(COLUMNS) and got["gone"]["method"] == "no values" and not got["gone"]["drifted"]
    for c in COLUMNS[:-1]:
        assert (got[c]["method"], got[c]["drifted"]) == (want[c]["method"], want[c]["drifted"])
        assert abs(got[c]["score"] - want[c]["score"]) <= got[c]["slack"] + 1e-9
    assert got["shifted"]["drifted"] and not got["a"]["drifted"] and got["few"]["slack"] == 0.0
    one = p.load_profile(spark, str(tmp_path / "profile"), ["d1"])
    assert one.moments.where("column = 'a'").first()["n"] == 2000


def test_parts_add_up(spark, tmp_path):
    table = rows(spark, 3, 3000)
    grid = p.new_grid(table, COLUMNS, 64)
    whole = p.build_profile(table, COLUMNS, grid)
    for day in (0, 1, 2):
        p.save_profile(p.build_profile(table.where(f"day = {day}"), COLUMNS, grid), str(tmp_path / "p"), str(day))
    merged = p.load_profile(spark, str(tmp_path / "p"))
    assert merged.counts.exceptAll(whole.counts).isEmpty() and whole.counts.exceptAll(merged.counts).isEmpty()
    a, b = ({r["column"]: r for r in x.moments.collect()} for x in (merged, whole))
    assert set(a) == set(b) == {"a", "b", "few", "shifted"}
    for c in a:
        assert a[c]["n"] == b[c]["n"] and a[c]["mean"] == pytest.approx(b[c]["mean"]) and a[c]["m2"] == pytest.approx(b[c]["m2"])
    assert p.grid_of(merged) == {c: g for c, g in grid.items() if c != "gone"} and p.grid_of(merged)["few"] is None
