"""The validation report: totals and every record the unit fan-out touches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.functions.text import csv_line
from dryspell.lineage import materialize
from dryspell.operators.units import CELL_KEY, cell_factors, fanout_report

# Order and headings of the summary.
SUMMARY = (
    ("n_records", "Records"),
    ("n_pairs", "Unit and office pairs"),
    ("n_units", "Units"),
    ("n_offices", "Offices"),
    ("first_year", "First program year"),
    ("last_year", "Last program year"),
    ("n_types", "Pasture types"),
    ("n_sources", "Sources"),
    ("n_offices_spanning", "Offices covering several units"),
    ("n_units_split", "Units split over several offices"),
    ("n_offices_disagree", "Determinations where the units of an office disagree"),
    ("n_offices_touched", "Determinations of offices covering several units"),
    ("n_units_disagree", "Determinations where the offices of a unit disagree"),
    ("n_units_touched", "Determinations of units split over several offices"),
)

# Heading lines of each section.
FIXED_LINES = {
    1: ["Eligibility report", ""],
    2: [
        "",
        "Enforced: one window per key; every office resolved; no missing values; every factor",
        "within its ladder; every date inside its window. Unit fan-out is reported, not reduced.",
    ],
    3: ["", "Offices covering several units", "  fsa_county,n_fips"],
    4: ["", "Units split over several offices", "  fips,n_offices"],
    5: [
        "",
        "Determinations where the units of an office disagree",
        "  source,program_year,pasture_type,fsa_county,lowest,highest",
    ],
    6: [
        "",
        "Determinations where the offices of a unit disagree",
        "  source,program_year,pasture_type,fips,lowest,highest",
    ],
}

# Heading lines of the sections that only some reports have.
OPTIONAL_LINES = {
    7: ["", "Windows without an event for want of input", "  reason,n_windows"],
    8: ["", "Weekly files skipped", "  file,missing_sources,unposted"],
}


def _metrics(row: DataFrame) -> DataFrame:
    longs = row.select(*[F.col(c).cast("bigint").alias(c) for c in row.columns])
    return longs.unpivot([], longs.columns, "metric", "value")


def _size(df: DataFrame, name: str) -> DataFrame:
    return _metrics(df.agg(F.count(F.lit(1)).alias(name)))


def qa_summary(eligibility: DataFrame, report: dict[str, DataFrame]) -> DataFrame:
    """``metric, value`` totals of a result and its fan-out report."""
    kinds = eligibility.select("pasture_type", "source").distinct()
    parts = [
        _metrics(eligibility.agg(
            F.count(F.lit(1)).alias("n_records"), F.min("program_year").alias("first_year"),
            F.max("program_year").alias("last_year"),
        )),
        _metrics(report["pairs"].agg(
            F.count(F.lit(1)).alias("n_pairs"), F.count_distinct("fips").alias("n_units"),
            F.count_distinct("fsa_county").alias("n_offices"),
        )),
        _metrics(kinds.agg(
            F.count_distinct("pasture_type").alias("n_types"),
            F.count_distinct("source").alias("n_sources"),
        )),
        _size(report["offices_spanning"], "n_offices_spanning"),
        _size(report["units_spanning"], "n_units_split"),
        _size(report["offices_disagree"], "n_offices_disagree"),
        _size(report["offices_touched"], "n_offices_touched"),
        _size(report["units_disagree"], "n_units_disagree"),
        _size(report["units_touched"], "n_units_touched"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _headings(spark, left_out) -> DataFrame:
    rows = [
        (section, i - len(lines), 0, "", "", "", "", text)
        for section, lines in (FIXED_LINES | OPTIONAL_LINES).items() if section not in left_out
        for i, text in enumerate(lines)
    ]
    return spark.createDataFrame(
        rows, "section int, rank int, weight bigint, k1 string, k2 string, k3 string, k4 string, "
        "text string"
    )


def _detail(df: DataFrame, section: int, weight, keys: list[str], columns: list[str]) -> DataFrame:
    keys = [F.col(k).cast("string") for k in keys]
    keys += [F.lit("")] * (4 - len(keys))
    return df.select(
        F.lit(section).alias("section"), F.lit(0).alias("rank"),
        weight.cast("bigint").alias("weight"),
        *[k.alias(f"k{i + 1}") for i, k in enumerate(keys)], csv_line(columns).alias("text"),
    )


def report_lines(
    eligibility: DataFrame,
    report: dict[str, DataFrame],
    coverage: DataFrame | None = None,
    skipped: DataFrame | None = None,
) -> DataFrame:
    """The report as a table of lines; sorted by all columns but ``text`` it reads top to bottom.

    ``coverage`` (:func:`dryspell.operators.quality.coverage`) and ``skipped`` (weekly files and what they
    wait for) add a section each.
    """
    spark = eligibility.sparkSession
    labels = spark.createDataFrame(
        [(metric, i, label) for i, (metric, label) in enumerate(SUMMARY)],
        "metric string, place int, label string",
    )
    totals = qa_summary(eligibility, report).join(F.broadcast(labels), "metric").select(
        F.lit(1).alias("section"), F.lit(0).alias("rank"),
        F.col("place").cast("bigint").alias("weight"),
        *[F.lit("").alias(f"k{i}") for i in range(1, 5)],
        F.concat("label", F.lit(": "), F.col("value").cast("string")).alias("text"),
    )
    left_out = [k for k, table in ((7, coverage), (8, skipped)) if table is None]
    parts = [_headings(spark, left_out), totals]
    for section, name, unit, count in (
        (3, "offices", "fsa_county", "n_fips"), (4, "units", "fips", "n_offices"),
    ):
        found = report[f"{name}_spanning"]
        parts.append(_detail(found, section, -F.col(count), [unit], [unit, count]))
    for section, name, unit in ((5, "offices", "fsa_county"), (6, "units", "fips")):
        keys = [*CELL_KEY, unit]
        found = report[f"{name}_disagree"]
        parts.append(_detail(found, section, F.lit(0), keys, [*keys, "lowest", "highest"]))
    if coverage is not None:
        unused = coverage.where(F.col("reason") != "used")
        parts.append(_detail(unused, 7, F.lit(0), ["reason"], ["reason", "n_windows"]))
    if skipped is not None:
        joined = [F.array_join(c, " ").alias(c) for c in ("missing_sources", "unposted")]
        rows = skipped.select("file", *joined)
        parts.append(_detail(rows, 8, F.lit(0), ["file"], rows.columns))
    return reduce(DataFrame.unionByName, parts)


def write_report(
    eligibility: DataFrame,
    path: str,
    coverage: DataFrame | None = None,
    skipped: DataFrame | None = None,
) -> None:
    """Write the report of a materialized result."""
    report = fanout_report(materialize(cell_factors(eligibility)))
    lines = materialize(report_lines(eligibility, report, coverage, skipped))
    order = [c for c in lines.columns if c != "text"]
    lines.orderBy(*order).select("text").write.mode("overwrite").text(path)
