"""Plans and results of queries whose tables outgrow one task or the driver, on rows made here."""

from __future__ import annotations

import contextlib
import io
from datetime import date, datetime, timedelta

import pytest

from dryspell import lineage
from dryspell.operators.runs import run_length_encode
from dryspell.plans.catalog import QUERIES

SUPPLIERS = 40


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Line items of 40 suppliers over three years, some without an order, an order without line items."""
    folder = tmp_path_factory.mktemp("made")
    lines = [
        (k % 500, k % SUPPLIERS, "ANR"[k % 3], float(1 + k * 7 % 50), datetime(1995, 1, 2) + timedelta(days=k * 13 % 1000))
        for k in range(4000)
    ]
    orders = [(k, datetime(1995, 1, 1) + timedelta(days=k * 5 % 900)) for k in range(20, 520)]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_suppkey long, l_returnflag string, l_quantity double, l_shipdate timestamp"),
        "orders": (orders, "o_orderkey long, o_orderdate timestamp"),
        "supplier": ([(k, k % 25) for k in range(SUPPLIERS)], "s_suppkey long, s_nationkey int"),
        "nation": ([(k,) for k in range(25)], "n_nationkey int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.mark.parametrize("name", [
    "clipped_runs_joined_by_source", "eligibility_joined_by_source", "payable_capped", "tier_consecutive",
    "date_outside_window", "pattern_match",
])
def test_windows_of_suppliers_are_never_broadcast(spark, made, name):
    """They grow with the data, and are a hundredth as large in their file as in memory."""
    df = QUERIES[f"{name}_by_supplier"](spark, made)
    plan = plan_of(df)
    assert "SortMergeJoin" in plan
    assert "Broadcast" not in plan


def test_observations_of_every_supplier_with_a_window(spark, made):
    """Of all suppliers, not only of those whose code is a nation's."""
    found = QUERIES["observed_units_only_by_supplier"](spark, made)
    assert {r.fips for r in found.select("fips").distinct().collect()} == {f"{k:05d}" for k in range(SUPPLIERS)}


def test_listings_are_dealt_by_the_number_of_line_items(spark, made, monkeypatch):
    """No task and no broadcast holds more as the tables grow, and the problems found stay the same."""
    plain = sorted(QUERIES["listing_reconcile"](spark, made).collect())
    monkeypatch.setattr(lineage, "ROWS_A_TASK", 100)
    df = QUERIES["listing_reconcile"](spark, made)
    plan = plan_of(df)
    assert "Broadcast" not in plan
    assert plan.count("41), REPARTITION_BY_NUM") >= 4  # line items by order and keys, expected and listed
    assert sorted(df.collect()) == plain
    assert {r.problem for r in plain} == {"missing", "unexpected", "size mismatch"}


@pytest.mark.parametrize("name", [
    "tier_consecutive", "tier_cumulative", "tier_immediate", "tier_sandwich", "pattern_match",
])
def test_windows_passes_are_dealt_by_the_number_of_line_items(spark, made, monkeypatch, name):
    """Cells, runs, both sides of the overlap join and its pairs: no task holds more as the tables grow."""
    plain = sorted(QUERIES[f"{name}_by_supplier"](spark, made).collect())
    monkeypatch.setattr(lineage, "ROWS_A_TASK", 100)
    df = QUERIES[f"{name}_by_supplier"](spark, made)
    plan = plan_of(df)
    assert plan.count("41), REPARTITION_BY_NUM") == 5
    assert "ENSURE_REQUIREMENTS" not in plan and "Broadcast" not in plan
    assert sorted(df.collect()) == plain
    assert plain or name != "tier_immediate"


def test_blocked_runs_hold_no_table_of_runs(spark):
    """Sorted passes spill; the aggregations they replace held every run of a task in a hash table."""
    days = [date(2020, 1, 1) + timedelta(days=7 * k) for k in range(300) if k % 11]
    rows = [(f"u{u}", "s", d, (k * (u + 1) // 9) % 3) for u in range(6) for k, d in enumerate(days)]
    df = spark.createDataFrame(rows, "fips string, source string, usdm_date date, drought_class int")
    blocked = run_length_encode(df, block_days=91)
    assert "Aggregate" not in plan_of(blocked)
    assert sorted(blocked.collect()) == sorted(run_length_encode(df).collect())
    undated = df.where("fips = 'u1'").unionByName(
        spark.createDataFrame([("u1", "s", None, 0), ("u2", "s", None, 1)], df.schema)
    )
    found = sorted(run_length_encode(undated, block_days=91).collect(), key=str)
    whole = [r for r in sorted(run_length_encode(df.where("fips = 'u1'")).collect())]
    alone = [r for r in found if r.fips == "u2"]
    assert [(r.run_start, r.run_end, r.run_weeks) for r in alone] == [(None, None, 1)]
    first = min((r for r in found if r.fips == "u1"), key=lambda r: r.run_start)
    assert (first.run_start, first.run_end) == (whole[0].run_start, whole[0].run_end)
    assert first.run_weeks == whole[0].run_weeks + 1
