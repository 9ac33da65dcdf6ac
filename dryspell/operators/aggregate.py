"""Weekly worst class, and the wide and long forms of the weekly table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dryspell.functions.levels import collapse_levels


def _listed(source: Column, sources: Sequence[str]) -> Column:
    """``source``; a row of a source that has no column raises when it is read."""
    name = F.coalesce(source, F.lit("null"))
    return F.when(source.isin(*sources), source).otherwise(
        F.raise_error(F.concat(F.lit("no column for source "), name))
    )


def _null_aware_max(value: Column, rows: Column) -> Column:
    """Maximum of ``value``, or null as soon as one of the counted rows has no value."""
    return F.when(F.count(value) == rows, F.max(value))


def worst_class(df: DataFrame, keys: Sequence[str], value: str = "drought_class") -> DataFrame:
    """Worst class per key. One unknown class makes the whole cell unknown.

    Counts and maxima combine map-side, so a cell that holds a large share of the rows still reaches
    the shuffle as one row per map task.
    """
    worst = _null_aware_max(F.col(value), F.count(F.lit(1)))
    return df.groupBy(*keys).agg(worst.alias(value))


def weekly_wide(
    raw: DataFrame,
    sources: Sequence[str],
    ids: Sequence[str] = ("fips", "usdm_date"),
    source: str = "source",
    value: str = "drought_class",
    present: str | None = None,
) -> DataFrame:
    """Worst class per cell with one column per source, straight from raw rows in one shuffle.

    Same rows as :func:`worst_class` followed by :func:`pivot_sources`; the conditional aggregates
    save the second shuffle that a pivot after the aggregation would need. A source that is not listed
    raises. ``present`` names a column for the sources that have a row: a null class of these is
    unknown, of others missing.
    """
    raw = raw.withColumn(source, _listed(F.col(source), sources))
    cells, there = [], []
    for name in sources:
        here = F.col(source) == name
        rows = F.count(F.when(here, F.lit(1)))
        cells.append(_null_aware_max(F.when(here, F.col(value)), rows).alias(name))
        there.append(F.when(rows > 0, F.lit(name)))
    if present:
        cells.append(F.array_compact(F.array(*there)).alias(present))
    return raw.groupBy(*ids).agg(*cells)


def merged_wide(
    wide: DataFrame,
    sources: Sequence[str],
    ids: Sequence[str] = ("fips", "usdm_date"),
    present: str = "present",
) -> DataFrame:
    """One row per cell from several wide ones (:func:`weekly_wide` with ``present``): the worst class,
    unknown where one of the rows that have the source does not know it."""
    cells, there = [], []
    for name in sources:
        rows = F.count(F.when(F.array_contains(present, name), F.lit(1)))
        cells.append(_null_aware_max(F.col(f"`{name}`"), rows).alias(name))
        there.append(F.when(rows > 0, F.lit(name)))
    return wide.groupBy(*ids).agg(*cells, F.array_compact(F.array(*there)).alias(present))


def pivot_sources(
    cells: DataFrame,
    sources: Sequence[str],
    ids: Sequence[str] = ("fips", "usdm_date"),
    source: str = "source",
    value: str = "drought_class",
) -> DataFrame:
    """Long to wide: one column per source, null where a source has no row. A source that is not listed
    raises."""
    cells = cells.withColumn(source, _listed(F.col(source), sources))
    columns = [F.max(F.when(F.col(source) == s, F.col(value))).alias(s) for s in sources]
    return cells.groupBy(*ids).agg(*columns)


def long_from_wide(
    wide: DataFrame,
    sources: Sequence[str] | None = None,
    ids: Sequence[str] = ("fips", "usdm_date"),
    value: str = "drought_class",
) -> DataFrame:
    """Wide to long without the empty cells, classes below D2 merged into one.

    Made with a generator, which keeps the partitioning of ``wide``: partitioned by unit before, the
    series need no further shuffle to be encoded into runs.
    """
    sources = list(sources) if sources else [c for c in wide.columns if c not in ids]
    cells = F.array(*[
        F.struct(F.lit(s).alias("source"), F.col(f"`{s}`").alias(value)) for s in sources
    ])
    return (
        wide.select(*ids, F.inline(cells))
        .where(F.col(value).isNotNull())
        .withColumn(value, collapse_levels(value))
    )
