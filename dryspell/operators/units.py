"""Many-to-many unit mapping, grain reduction and fan-out reporting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.model import WINDOW_KEY
from dryspell.operators.quality import checked_join

CELL_KEY = ("source", "program_year", "pasture_type")


def map_units(windows: DataFrame, crosswalk: DataFrame, on: str = "fsa_county") -> DataFrame:
    """Every window once per unit its office covers (many-to-many). Crosswalk pairs are distinct."""
    return windows.join(crosswalk, on)


def unresolved_units(windows: DataFrame, crosswalk: DataFrame, on: str = "fsa_county") -> DataFrame:
    """Offices that no crosswalk row resolves."""
    return windows.select(on).distinct().join(crosswalk, on, "left_anti")


def observed_only(observations: DataFrame, windows: DataFrame, on: str = "fips") -> DataFrame:
    """Observations of units that have a window."""
    return observations.join(windows.select(on), on, "left_semi")


def reduce_grain(
    eligibility: DataFrame,
    rule: str = "both",
    unit: str = "fsa_county",
    cell: Sequence[str] = CELL_KEY,
) -> DataFrame:
    """Factors at a coarser grain. The rule is the caller's decision and there is no default beyond
    keeping both keys: ``both`` returns the input, ``max`` the highest factor per ``unit``,
    ``principal`` the rows whose two unit codes are equal."""
    if rule == "both":
        return eligibility
    if rule == "max":
        return eligibility.groupBy(*cell, unit).agg(F.max("drought_factor").alias("drought_factor"))
    if rule == "principal":
        return eligibility.where(F.col("fips") == F.col("fsa_county"))
    raise ValueError(f"unknown rule: {rule}")


def cell_factors(eligibility: DataFrame, cell: Sequence[str] = CELL_KEY) -> DataFrame:
    """Highest factor of every determination cell, both unit keys kept."""
    return eligibility.groupBy(*cell, "fips", "fsa_county").agg(
        F.max("drought_factor").alias("drought_factor")
    )


def spanning(pairs: DataFrame, unit: str, counterpart: str, name: str) -> DataFrame:
    """Units with more than one counterpart, with how many."""
    counted = pairs.select(unit, counterpart).distinct().groupBy(unit)
    return counted.agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def disagreements(cells: DataFrame, by: str, cell: Sequence[str] = CELL_KEY) -> DataFrame:
    """Cells whose factor depends on the counterpart unit, with the lowest and highest factor."""
    return (
        cells.groupBy(*cell, by)
        .agg(F.min("drought_factor").alias("lowest"), F.max("drought_factor").alias("highest"))
        .where(F.col("highest") > F.col("lowest"))
    )


def fanout_report(cells: DataFrame) -> dict[str, DataFrame]:
    """Where units and offices do not nest, in both directions, and where that changes a factor.

    ``cells`` comes from :func:`cell_factors`; every table of the report reads it again.
    """
    pairs = cells.select("fips", "fsa_county").distinct()
    report = {"pairs": pairs, "cells": cells}
    for unit, other, name, label in (
        ("fsa_county", "fips", "n_fips", "offices"),
        ("fips", "fsa_county", "n_offices", "units"),
    ):
        wide = spanning(pairs, unit, other, name)
        touched = cells.join(wide.select(unit), unit, "left_semi")
        report[f"{label}_spanning"] = wide
        report[f"{label}_touched"] = touched.select(*CELL_KEY, unit).distinct()
        report[f"{label}_disagree"] = disagreements(touched, unit)
    return report


def source_sensitivity(
    eligibility: DataFrame, sources: Sequence[str], keys: Sequence[str] = WINDOW_KEY
) -> DataFrame:
    """Cells whose factor differs between sources, or that some source does not reach at all."""
    top = [
        F.max(F.when(F.col("source") == s, F.col("drought_factor"))).alias(f"factor_{s}")
        for s in sources
    ]
    columns = [F.col(f"factor_{s}") for s in sources]
    found = F.array_compact(F.array(*columns))
    differs = (F.size(found) < len(columns)) | (F.array_max(found) != F.array_min(found))
    return (
        eligibility.where(F.col("source").isin(*sources)).groupBy(*keys).agg(*top).where(differs)
    )


def payable(eligibility: DataFrame, caps: DataFrame, on: Sequence[str] = WINDOW_KEY) -> DataFrame:
    """Cap each factor by the ``max_months`` its window allows (caps come from the caller).

    A window without a cap has no known payment: its ``payable_months`` is null. Caps that repeat a
    window raise, which takes a job when the plan is built.
    """
    capped = checked_join(eligibility, caps.select(*on, "max_months"), on, "many-to-one", "left")
    known = F.when(F.col("max_months").isNotNull(), F.least("drought_factor", "max_months"))
    return capped.withColumn("payable_months", known).drop("max_months")


def factor_map(
    eligibility: DataFrame,
    units: DataFrame,
    program_year: int,
    pasture_type: str,
    source: str,
) -> DataFrame:
    """One slice of the result at unit grain, highest factor first decided, with unit attributes."""
    sliced = eligibility.where(
        (F.col("pasture_type") == pasture_type)
        & (F.col("program_year") == program_year)
        & (F.col("source") == source)
    )
    top = sliced.groupBy("fips").agg(F.max("drought_factor").alias("drought_factor"))
    return top.join(units, "fips", "left")
