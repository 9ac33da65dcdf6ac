"""Runs carried over builds against encoding everything at once."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from dryspell import versions
from dryspell.operators.runs import merge_runs, run_length_encode
from dryspell.plans import run_state
from dryspell.plans.run_state import RUN_COLUMNS, advance, compact, read_runs

from evaluator import tuesday

SCHEMA = "fips string, source string, usdm_date date, drought_class int"


def runs(df):
    return sorted(tuple(r) for r in df.select(*RUN_COLUMNS).collect())


def frame(spark, cells):
    return spark.createDataFrame([(f, s, d, v) for (f, s, d), v in cells.items()], SCHEMA)


class Carried:
    """An archive of cells in a dict, and its runs on disk."""

    def __init__(self, spark, root):
        self.spark, self.root, self.cells = spark, root, {}

    def build(self, new):
        self.cells.update(new)
        advance(self.spark, self.root, frame(self.spark, new), frame(self.spark, self.cells))
        return self.check()

    def check(self):
        whole = runs(run_length_encode(frame(self.spark, self.cells)))
        assert runs(read_runs(self.spark, self.root)) == whole
        return whole


@pytest.fixture
def carried(spark, tmp_path):
    return Carried(spark, str(tmp_path / "runs"))


def week(i, value, unit="01001", source="a"):
    return {(unit, source, tuesday(i)): value}


def test_extends_closes_and_adds_series(spark, carried):
    carried.build(week(0, 3) | week(1, 3) | week(0, 4, "01003"))
    before = versions.newest(spark, carried.root)
    carried.build(week(2, 3) | week(3, 5))
    carried.build(week(4, 5) | week(1, 4, "01003") | week(4, 0, "01005"))
    # An earlier version stays readable; nothing of it was rewritten.
    assert [r[5] for r in runs(read_runs(spark, carried.root, before))] == [2, 1]
    assert run_state.open_runs(spark, carried.root, versions.newest(spark, carried.root)).count() == 3


@pytest.mark.parametrize("change", [
    week(0, 3), week(3, 3), week(3, None), week(4, 3), week(5, 5) | week(9, 0), week(-3, 4), week(-3, 3),
    {k: v for i in range(9) for k, v in week(i, None).items()}, week(8, 3), week(8, None), week(8, None) | week(9, 5),
])
def test_late_and_corrected_weeks(carried, change):
    """Series 3 3 3 5 5 _ 3 0 0: a correction may split, join, shorten or remove runs; late weeks may fill gaps."""
    values = [3, 3, 3, 5, 5, None, 3, 0, 0]
    start = {k: v for i, value in enumerate(values) if value is not None for k, v in week(i, value).items()}
    carried.build(start | week(0, 4, "01003") | week(1, 5, "01003"))
    carried.build(change)
    carried.build(week(10, 3) | week(11, 3, "01003"))


def test_random_builds(spark, carried):
    r = random.Random(4)
    cells = {(u, s, tuesday(i)): r.choice([0, 0, 3, 3, 4, None]) for u in "ABCDEF" for s in "ab" for i in range(30)}
    keys = sorted(cells, key=lambda k: k[2])
    told = {}
    for step in range(4):
        upto = [k for k in keys[:len(keys) * (step + 1) // 4] if step == 3 or r.random() < 0.9]
        new = {k: cells[k] if step == 3 or r.random() < 0.9 else 5 for k in upto}
        carried.build({k: v for k, v in new.items() if k not in told or told[k] != v})
        told |= new
    assert carried.cells == cells
    first = versions.newest(spark, carried.root)
    whole = carried.check()
    compact(spark, carried.root)
    assert carried.check() == whole and versions.newest(spark, carried.root).number == first.number + 1
    carried.build({("A", "a", tuesday(31)): 4, ("B", "b", tuesday(2)): 5})


def test_build_that_dies(spark, carried, monkeypatch):
    whole = carried.build(week(0, 3) | week(1, 4))

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(run_state, "commit", die)
        with pytest.raises(RuntimeError, match="lost"):
            advance(spark, carried.root, frame(spark, week(0, 5)), frame(spark, week(0, 5) | week(1, 4)))
    assert carried.check() == whole
    carried.build(week(0, 5))


def test_merge_runs(spark):
    rows = [("u", "s", v, tuesday(i), tuesday(i), n) for i, (v, n) in enumerate([(1, 2), (1, 3), (2, 1), (2, 1), (1, 4)])]
    df = spark.createDataFrame(rows, run_state.RUN_SCHEMA).orderBy(F.rand(1))
    assert [(r[2], r[3], r[4], r[5]) for r in sorted(runs(merge_runs(df)), key=lambda r: r[3])] == [
        (1, tuesday(0), tuesday(1), 5), (2, tuesday(2), tuesday(3), 2), (1, tuesday(4), tuesday(4), 4),
    ]
