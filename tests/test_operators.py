"""Single operators on small tables."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dryspell.functions.dates import date_code, date_decode
from dryspell.functions.levels import collapse_levels, level_code, level_label
from dryspell.functions.text import base_name, csv_line, encode_key, strip_prefix
from dryspell.operators import (
    aggregate, dictionary, listings, runs, scoring, sketches, tiers, units,
)
from dryspell.operators.intervals import interval_join

from evaluator import runs_of, tuesday


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_worst_class_is_unknown_when_any_class_is(spark):
    df = spark.createDataFrame(
        [("u", 1), ("u", 4), ("v", 2), ("v", None), ("w", None)], "fips string, drought_class int"
    )
    assert rows(aggregate.worst_class(df, ["fips"])) == [("u", 4), ("v", None), ("w", None)]


def test_wide_in_one_step_equals_pivot_after_aggregation(spark):
    rng = random.Random(3)
    data = [
        (f"u{rng.randint(0, 5)}", tuesday(rng.randint(0, 4)), rng.choice("abc"),
         rng.choice([None, 0, 1, 2, 3, 4, 5, 5]))
        for _ in range(300)
    ]
    raw = spark.createDataFrame(data, "fips string, usdm_date date, source string, drought_class int")
    cells = aggregate.worst_class(raw, ["fips", "usdm_date", "source"])
    pivoted = aggregate.pivot_sources(cells, ["a", "b", "c"])
    direct = aggregate.weekly_wide(raw, ["a", "b", "c"])
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, direct.collect()), key=key) == sorted(
        map(tuple, pivoted.collect()), key=key
    )
    long = aggregate.long_from_wide(direct, ["a", "b", "c"])
    back = cells.where("drought_class is not null").withColumn(
        "drought_class", collapse_levels("drought_class")
    )
    assert rows(long.select("fips", "usdm_date", "source", "drought_class")) == rows(
        back.select("fips", "usdm_date", "source", "drought_class")
    )


@pytest.mark.parametrize("block_days", [None, 7, 20, 366])
def test_runs(spark, block_days):
    rng = random.Random(5)
    series = {
        u: [(tuesday(i), rng.choice([0, 0, 3, 4])) for i in range(120) if rng.random() < 0.8]
        for u in ("u", "v", "w")
    }
    df = spark.createDataFrame(
        [(u, "s", d, c) for u, s in series.items() for d, c in s],
        "fips string, source string, usdm_date date, drought_class int",
    )
    found = runs.run_length_encode(df, block_days=block_days)
    expected = sorted((u, *r) for u, s in series.items() for r in runs_of(s))
    assert rows(found.select("fips", "drought_class", "run_start", "run_end")) == expected
    assert found.agg(F.sum("run_weeks")).first()[0] == df.count()


def test_runs_of_a_constant_series_cross_blocks(spark):
    df = spark.createDataFrame(
        [("u", "s", tuesday(i), 3) for i in range(200)],
        "fips string, source string, usdm_date date, drought_class int",
    )
    found = runs.run_length_encode(df, block_days=50)
    assert rows(found.select("run_start", "run_end", "run_weeks")) == [
        (tuesday(0), tuesday(199) + timedelta(days=6), 200)
    ]


def test_runs_expand_to_the_series(spark):
    rng = random.Random(9)
    df = spark.createDataFrame(
        [("u", "s", tuesday(i), rng.choice([0, 3, 4])) for i in range(80)],
        "fips string, source string, usdm_date date, drought_class int",
    )
    back = runs.expand_runs(runs.run_length_encode(df))
    assert rows(back.select(*df.columns)) == rows(df)


@pytest.mark.parametrize("bin_days,salts", [(None, 1), (5, 1), (30, 1), (366, 3), (7, 4)])
def test_interval_join(spark, bin_days, salts):
    rng = random.Random(13)

    def spans(n):
        out = []
        for i in range(n):
            a = date(2020, 1, 1) + timedelta(days=rng.randint(0, 90))
            b = a + timedelta(days=rng.randint(-3, 40))
            out.append((rng.choice("kl"), i, a, None if rng.random() < 0.05 else b))
        return out

    left, right = spans(60), spans(50)
    expected = sorted(
        (x[1], y[1]) for x in left for y in right
        if x[0] == y[0] and x[3] and y[3] and x[2] <= x[3] and y[2] <= y[3]
        and x[2] <= y[3] and y[2] <= x[3]
    )
    a = spark.createDataFrame(left, "k string, i int, window_start date, window_end date")
    b = spark.createDataFrame(right, "k string, j int, run_start date, run_end date")
    assert rows(interval_join(a, b, ["k"], bin_days=bin_days, salts=salts).select("i", "j")) == expected


def test_pattern_edges(spark):
    df = spark.createDataFrame(
        [("g", 1, 3), ("g", 2, 0), ("g", 3, 3), ("g", 4, None), ("g", 5, 0), ("h", 1, 3)],
        "k string, i int, v int",
    )

    def starts(pattern):
        found = tiers.match_pattern(df, ["k"], "i", "v", pattern).where("matched")
        return rows(found.select("k", "i"))

    assert starts([3, 0, 3]) == [("g", 1)]
    assert starts([3]) == [("g", 1), ("g", 3), ("h", 1)]
    assert starts([3, 0]) == [("g", 1)]
    assert starts([]) == []
    assert starts([3, 0, 3, 0, 3, 0, 3]) == []


def test_escalation_keeps_the_strictly_rising_rows(spark):
    rng = random.Random(17)
    data = [(g, i, rng.randint(1, 5)) for g in range(20) for i in range(15)]
    df = spark.createDataFrame(data, "g int, i int, v int")
    kept = scoring.escalating(df, ["g"], ["i"], "v")
    expected, best = [], {}
    for g, i, v in data:
        if v > best.get(g, 0):
            best[g] = v
            expected.append((g, i, v))
    assert rows(kept) == sorted(expected)


def test_ladder_as_expression_and_as_table(spark):
    from dryspell.model import LADDER, Rung

    events = ["D2", "D2a_2026", "D2b_2026", "D3a", "D3b", "D4a", "D4b", "other"]
    df = spark.createDataFrame(
        [(e, y) for e in events for y in (2007, 2008, 2011, 2012, 2025, 2026, 2040)],
        "event string, program_year int",
    )
    table = spark.createDataFrame(
        [tuple(r) for r in LADDER], "event string, first_year int, last_year int, factor int"
    )
    direct = rows(scoring.score_events(df))
    assert rows(scoring.score_events(df, table)) == direct
    assert ("D4b", 2011, 3) in direct and ("D4b", 2012, 5) in direct
    assert ("D2", 2025, 1) in direct and ("D2b_2026", 2026, 2) in direct
    assert not [r for r in direct if r[1] == 2007 or r[0] == "other"]
    assert not [r for r in direct if r[0] == "D2" and r[1] == 2026]
    odd = [Rung("it's \\ odd", 2000, None, 7)]
    named = df.withColumn("event", F.lit("it's \\ odd"))
    assert {r.drought_factor for r in scoring.score_events(named, odd).collect()} == {7}
    assert scoring.score_events(df, []).isEmpty()


def test_ladder_of_many_rungs(spark):
    """100,000 rungs with gaps, an open one, and spans of one to hundreds of years, against plain search."""
    import bisect

    from dryspell.model import ValidationError

    r, rungs = random.Random(2), []
    for event in ("a", "b", "it's"):
        year = -50
        for k in range(33_400):
            start = year + r.randint(1, 3)
            year = start + (r.choice([0, 1, 2]) if k % 5000 else 700)
            rungs.append((event, start, year, r.randint(0, 9)))
        rungs.append((event, year + 5, None, 4))
    ladder = spark.createDataFrame(rungs, "event string, first_year int, last_year int, factor int")
    asked = [(r.choice(["a", "b", "it's", "none", None]), r.randint(-100, 200_000), k) for k in range(5000)]
    asked += [("a", None, -1)]
    events = spark.createDataFrame(asked, "event string, program_year int, id int")
    by_event = {}
    for rung in rungs:
        by_event.setdefault(rung[0], []).append(rung)
    expected = []
    for event, year, k in asked:
        own = by_event.get(event, [])
        at = bisect.bisect_right([x[1] for x in own], year) - 1 if year is not None else -1
        if at >= 0 and (own[at][2] is None or year <= own[at][2]) and own[at][3] > 0:
            expected.append((event, year, k, own[at][3]))
    assert rows(scoring.score_events(events, ladder)) == sorted(expected)
    clash = ladder.unionByName(spark.createDataFrame([("a", 60, 61, 1)], ladder.schema))
    assert scoring.overlapping_rungs(ladder).isEmpty()
    with pytest.raises(ValidationError, match="rungs that overlap"):
        scoring.score_events(events, clash)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.dates(date(1999, 1, 1), date(2031, 12, 31)), min_size=30, max_size=60))
def test_date_codes_round_trip(spark, dates):
    dates = [*dates, date(2024, 2, 29), date(2024, 12, 31), date(2023, 12, 31), date(2024, 1, 1)]
    data = [(d, d.year + k) for d in dates for k in (0, 1)]
    df = spark.createDataFrame(data, "d date, program_year int")
    qy, qo = date_code("d", "program_year")
    coded = df.withColumns({"qy": qy, "qo": qo})
    back = coded.withColumn("back", date_decode("qy", "qo", "program_year"))
    assert back.where("not (back <=> d)").isEmpty()
    assert {r.qo for r in coded.collect()} == {0, -1}
    assert coded.where("d = date'2024-02-29'").first().qy == 60


def test_levels(spark):
    labels = ["None", "D0", "D1", "D2", "D3", "D4", "X", None]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    out = df.withColumn("code", level_code("label")).withColumn("back", level_label("code"))
    codes = {r.label: (r.code, r.back) for r in out.collect()}
    assert [codes[x][0] for x in labels] == [0, 1, 2, 3, 4, 5, None, None]
    assert all(codes[x][1] == x for x in labels[:6])


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dictionary_ranks_in_byte_order(spark, parts):
    values = ["b", "a", "B", "é", "z", "aa", "10", "9", "_", " ", "b"]
    df = spark.createDataFrame([(v, v[::-1]) for v in values], "x string, y string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        found = dictionary.sorted_dictionary(df, {"one": "x", "two": "y"})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = []
    for dim, items in (("one", values), ("two", [v[::-1] for v in values])):
        ordered = sorted(set(items), key=lambda v: v.encode())
        expected += [(dim, v, i) for i, v in enumerate(ordered)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    coded = dictionary.encode(df, found, {"one": "x"})
    by_value = {v: i for d, v, i in expected if d == "one"}
    assert all(r.one == by_value[r.x] for r in coded.collect())
    assert coded.count() == len(values)


def test_text(spark):
    df = spark.createDataFrame([("a/b c/100%#x?y+z=1",)], "key string")
    row = df.select(
        encode_key("key").alias("url"), base_name("key").alias("base"),
        strip_prefix("key", "a/").alias("inner"),
    ).first()
    assert row.url == "a/b%20c/100%25%23x%3Fy%2Bz=1"
    assert row.base == "100%#x?y+z=1"
    assert row.inner == "b c/100%#x?y+z=1"
    line = spark.sql("select 'a,b' as x, 1 as y, cast(null as string) as z, date'2024-02-29' as d")
    assert line.select(csv_line(["x", "y", "z", "d"]).alias("t")).first().t == '  "a,b",1,NA,2024-02-29'


def test_reconcile(spark):
    a = spark.createDataFrame([("same", 1), ("size", 1), ("gone", 2), ("two", 1), ("two", 2)],
                              "key string, size bigint")
    b = spark.createDataFrame([("same", 1), ("size", 3), ("new", 4), ("ok/_m", 5), ("two", 1)],
                              "key string, size bigint")
    found = listings.reconcile(a, b, allow_extra=["ok/_m"]).select("key", "problem")
    assert rows(found) == [
        ("gone", "missing"), ("new", "unexpected"), ("size", "size mismatch"),
        ("two", "size mismatch"),
    ]
    subset = listings.reconcile(a, b, exact=False).select("key", "problem")
    assert rows(subset) == [
        ("gone", "missing"), ("size", "size mismatch"), ("two", "size mismatch")
    ]


def test_gate_and_nesting(spark):
    data = [(s, f"x/{s}/{f}", f) for s, f in
            [("a", "1"), ("b", "1"), ("a", "2"), ("b", "3"), ("a", "3"), ("a", "4"), ("b", "4")]]
    manifest = spark.createDataFrame(data, "source string, url string, file string")
    strict = listings.completeness_gate(manifest, required_sources=["a", "b"])
    assert rows(strict) == [("1", True), ("2", False), ("3", True), ("4", True)]
    posted = manifest.where("url != 'x/b/3'").select("url")
    listed = listings.completeness_gate(manifest, posted=posted)
    assert rows(listed) == [("1", True), ("2", True), ("3", False), ("4", True)]
    both = listings.completeness_gate(manifest, ["a", "b"], posted)
    assert rows(both) == [("1", True), ("2", False), ("3", False), ("4", True)]
    built = spark.createDataFrame([("1",), ("9",)], "file string")
    assert {r[0] for r in rows(listings.pending(manifest, built).select("file"))} == {"2", "3", "4"}
    nested = listings.nest_by_source(manifest)
    assert [len(r.entries) for r in nested.orderBy("file").collect()] == [2, 1, 2, 2]
    assert rows(listings.unnest(nested).select("source", "url", "file")) == rows(manifest)


ELIG = (
    "fips string, fsa_county string, source string, program_year int, pasture_type string, "
    "event string, qualifying_date date, drought_factor int"
)


def small_result(spark):
    day = date(2024, 5, 1)
    return spark.createDataFrame([
        ("1", "1", "a", 2024, "p", "D3a", day, 3), ("1", "1", "a", 2024, "p", "D3b", day, 4),
        ("2", "1", "a", 2024, "p", "D2", day, 1), ("2", "2", "a", 2024, "p", "D3a", day, 3),
        ("1", "1", "b", 2024, "p", "D3a", day, 3), ("3", "3", "b", 2024, "p", "D2", day, 1),
    ], ELIG)


def test_grain_rules(spark):
    df = small_result(spark)
    assert units.reduce_grain(df).count() == 6
    top = units.reduce_grain(df, "max").select("source", "fsa_county", "drought_factor")
    assert rows(top) == [("a", "1", 4), ("a", "2", 3), ("b", "1", 3), ("b", "3", 1)]
    assert rows(units.reduce_grain(df, "principal").select("fips")) == [
        ("1",), ("1",), ("1",), ("2",), ("3",)
    ]
    with pytest.raises(ValueError):
        units.reduce_grain(df, "any")


def test_fanout(spark):
    found = units.fanout_report(units.cell_factors(small_result(spark)))
    assert rows(found["offices_spanning"]) == [("1", 2)]
    assert rows(found["units_spanning"]) == [("2", 2)]
    assert rows(found["offices_disagree"]) == [("a", 2024, "p", "1", 1, 4)]
    assert rows(found["units_disagree"]) == [("a", 2024, "p", "2", 1, 3)]
    assert found["offices_touched"].count() == 2
    assert found["units_touched"].count() == 1


def test_sensitivity_and_payable(spark):
    df = small_result(spark)
    cells = units.source_sensitivity(df, ["a", "b"])
    found = {(r.fips, r.fsa_county): (r.factor_a, r.factor_b) for r in cells.collect()}
    assert found == {("1", "1"): (4, 3), ("2", "1"): (1, None), ("2", "2"): (3, None),
                     ("3", "3"): (None, 1)}
    caps = df.select("fips", "fsa_county", "program_year", "pasture_type").distinct().withColumn(
        "max_months", F.when(F.col("fips") == "1", F.lit(2)).otherwise(F.lit(9))
    )
    paid = units.payable(df, caps)
    assert {(r.fips, r.drought_factor): r.payable_months for r in paid.collect()} == {
        ("1", 3): 2, ("1", 4): 2, ("2", 1): 1, ("2", 3): 3, ("3", 1): 1
    }


def test_sketches_merge_within_their_error(spark):
    """Counts of any union of parts, values in several parts counted once, nulls and empty tables."""
    df = spark.range(60_000).select(
        (F.col("id") % 7).alias("part"), (F.col("id") % 20_011).alias("a"), (F.col("id") % 3).alias("b"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("half"),
    )
    counts = {"n_a": ("a",), "n_ab": ("a", "b"), "n_half": ("half",), "n_half_b": ("half", "b")}
    parts = sketches.sketches(df, ["part"], counts)
    guess, exact = sketches.estimates(parts, list(counts)).first(), sketches.exact_counts(df, counts).first()
    assert exact.asDict() == {"n_a": 20_011, "n_ab": 60_000, "n_half": 30_000, "n_half_b": 30_000}
    for name in counts:
        assert abs(guess[name] - exact[name]) <= 4 * sketches.relative_error() * exact[name]
    by = {r.part: r.n_a for r in sketches.estimates(parts, ["n_a"], ["part"]).collect()}
    assert len(by) == 7
    some = sketches.estimates(parts.where("part < 3"), ["n_a"]).first().n_a
    truth = df.where("part < 3").select("a").distinct().count()
    assert abs(some - truth) <= 4 * sketches.relative_error() * truth
    assert parts.where("false").groupBy().agg(F.hll_union_agg("n_a").alias("n_a")).count() == 1
    assert sketches.sketches(df.where("false"), ["part"], counts).isEmpty()
