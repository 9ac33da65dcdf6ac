"""The determination on hand-made cases, against the plain loop, and its variants."""

from __future__ import annotations

import contextlib
import io
import random
from datetime import date, timedelta

import pytest

from dryspell.operators.aggregate import pivot_sources
from dryspell.plans.determine import clipped_runs, determine, drought_runs, weekly_series

from evaluator import determine as expected_events
from evaluator import tuesday

LEVEL = {"0": 0, "1": 2, "2": 3, "3": 4, "4": 5, ".": None}
OBS = "fips string, source string, usdm_date date, drought_class int"
WIN = (
    "fips string, fsa_county string, program_year int, pasture_type string, "
    "window_start date, window_end date"
)

CASES = {
    "c01": (2024, "22222222", [("D2", "2024-02-26", 1)]),
    "c02": (2024, "222222212222222", []),
    "c03": (2026, "222222212222222", [("D2a_2026", "2024-01-29", 1), ("D2b_2026", "2024-02-19", 2)]),
    "c04": (2026, "222221222", [("D2a_2026", "2024-01-29", 1), ("D2b_2026", "2024-02-26", 2)]),
    "c05": (2024, "33133", [("D3a", "2024-01-02", 3), ("D3b", "2024-02-05", 4)]),
    "c06": (2010, "34", [("D3a", "2024-01-02", 2), ("D4a", "2024-01-09", 3)]),
    "c07": (2024, "2222..2222", [("D2", "2024-02-26", 1)]),
    "c08": (2024, "222232222", [("D3a", "2024-01-30", 3)]),
    "c09": (2024, "222222222222", [("D2", "2024-03-11", 1)]),
    "c10": (2024, "4444", [("D4a", "2024-01-02", 4), ("D4b", "2024-01-29", 5)]),
    "c11": (2024, "0101010101", []),
    "c12": (2026, "2222211222", [("D2a_2026", "2024-01-29", 1)]),
    "c13": (2024, "413333", [("D4a", "2024-01-02", 4)]),
    "c14": (2010, "4444", [("D4a", "2024-01-02", 3)]),
    "c15": (2026, "22202221222222", [("D2b_2026", "2024-03-25", 2)]),
    "c16": (2007, "4444", []),
    "c17": (2026, "2222322", [("D2a_2026", "2024-01-29", 1), ("D3a", "2024-01-30", 3)]),
}


def case_tables(spark):
    observations, windows = [], []
    for name, (year, weeks, _) in CASES.items():
        for i, digit in enumerate(weeks):
            if LEVEL[digit] is not None:
                observations.append((name, "s", tuesday(i), LEVEL[digit]))
        start = date(2024, 1, 16) if name == "c09" else date(2024, 1, 2)
        windows.append((name, "o", year, "p", start, date(2024, 12, 30)))
    return spark.createDataFrame(observations, OBS), spark.createDataFrame(windows, WIN)


@pytest.fixture(scope="module")
def case_results(spark):
    found = {name: [] for name in CASES}
    rows = determine(*case_tables(spark)).orderBy("fips", "qualifying_date").collect()
    for row in rows:
        found[row.fips].append((row.event, str(row.qualifying_date), row.drought_factor))
    return found


@pytest.mark.parametrize("name", CASES)
def test_case(case_results, name):
    assert case_results[name] == CASES[name][2]


def test_case_expectations_agree_with_the_loop():
    for name, (year, weeks, events) in CASES.items():
        series = [(tuesday(i), LEVEL[x]) for i, x in enumerate(weeks)]
        start = date(2024, 1, 16) if name == "c09" else date(2024, 1, 2)
        window = [(name, "o", year, "p", start, date(2024, 12, 30))]
        rows = expected_events({(name, "s"): series}, window)
        assert sorted((r[5], str(r[6]), r[7]) for r in rows) == sorted(events)


def random_tables(seed):
    """Random series with gaps and unknown classes, and windows of all eras over them."""
    rng = random.Random(seed)
    weeks, windows = {}, []
    for u in range(12):
        for source in ("a", "b"):
            level, series = 0, []
            for i in range(150):
                if rng.random() < 0.25:
                    level = rng.choice([0, 1, 2, 3, 3, 3, 4, 5])
                if rng.random() < 0.1:
                    continue
                dip = rng.random() < 0.08
                series.append((tuesday(i), None if rng.random() < 0.03 else 2 if dip else level))
            weeks[(f"u{u}", source)] = series
        for office in ("x", "y")[: rng.randint(1, 2)]:
            for kind in ("p", "q", "r"):
                start = date(2023, 11, 1) + timedelta(days=rng.randint(0, 500))
                end = start + timedelta(days=rng.randint(0, 400))
                if rng.random() < 0.1:
                    end = None
                year = rng.choice([2007, 2009, 2015, 2026, 2026])
                windows.append((f"u{u}", office, year, kind, start, end))
    return weeks, windows


def as_frames(spark, weeks, windows):
    rows = [(f, s, d, c) for (f, s), series in weeks.items() for d, c in series]
    return spark.createDataFrame(rows, OBS), spark.createDataFrame(windows, WIN)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_the_loop(spark, seed):
    weeks, windows = random_tables(seed)
    rows = determine(*as_frames(spark, weeks, windows)).collect()
    assert len(rows) == len(set(rows)) > 50
    assert {tuple(r) for r in rows} == expected_events(weeks, windows)


def test_variants_agree(spark):
    observations, windows = as_frames(spark, *random_tables(7))
    plain = sorted(determine(observations, windows, bin_days=None).collect())
    for options in (
        {}, {"block_days": 30}, {"block_days": 366, "salts": 5}, {"bin_days": 31}, {"salts": 3},
        {"sources": ["a", "b"]}, {"sources": ["b", "a"], "salts": 2, "bin_days": None},
        {"strategy": "merge"}, {"strategy": "broadcast", "salts": 2},
    ):
        assert sorted(determine(observations, windows, **options).collect()) == plain


def test_join_by_source_needs_one_shuffle_of_the_observations(spark):
    observations, windows = as_frames(spark, *random_tables(7))
    keys = {
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    plain = sorted(determine(observations, windows).collect())
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        df = determine(observations, windows, sources=["a", "b"])
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            df.explain()
        shuffles = plan.getvalue().count("Exchange hashpartitioning")
        assert sorted(df.collect()) == plain
    finally:
        for key in keys:
            spark.conf.unset(key)
    # Observations, units with windows, windows, and the pairs by window.
    assert shuffles == 4


def test_wide_weeks_are_shuffled_once(spark, tmp_path):
    observations, windows = as_frames(spark, *random_tables(7))
    plain = sorted(determine(observations, windows).collect())
    pivot_sources(observations, ["a", "b"]).write.parquet(str(tmp_path / "wide"))
    windows.write.parquet(str(tmp_path / "windows"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    windows = spark.read.parquet(str(tmp_path / "windows"))
    df = determine(weekly_series(wide, ["a", "b"]), windows, strategy="broadcast")
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        df.explain()
    assert sorted(df.collect()) == plain
    # Wide weeks by unit and the pairs by window, beside the broadcast of the small window table.
    assert plan.getvalue().count("Exchange hashpartitioning") == 2


def test_hot_unit(spark):
    """One unit with most windows and observations gives the same rows under every strategy."""
    weeks, windows = random_tables(11)
    windows = [(f, o, y, f"{k}{i}", s, e) for f, o, y, k, s, e in windows
               for i in range(40 if f == "u0" else 1)]
    observations, table = as_frames(spark, weeks, windows)
    rows = determine(observations, table, block_days=60, bin_days=60, salts=8).collect()
    assert {tuple(r) for r in rows} == expected_events(weeks, windows)


def test_clipped_runs_lie_inside_both_spans(spark):
    observations, windows = as_frames(spark, *random_tables(5))
    runs = drought_runs(observations)
    clipped = clipped_runs(windows, runs)
    key = ["fips", "fsa_county", "program_year", "pasture_type"]
    inside = clipped.join(windows, key).where(
        "clip_start >= window_start and clip_end <= window_end and clip_start <= clip_end "
        "and clip_days = datediff(clip_end, clip_start) + 1"
    )
    assert inside.count() == clipped.count() > 0
    in_run = clipped.alias("c").join(runs.alias("r"), ["fips", "source", "drought_class"]).where(
        "clip_start >= run_start and clip_end <= run_end"
    )
    assert in_run.count() == clipped.count()
