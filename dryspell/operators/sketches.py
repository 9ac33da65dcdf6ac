"""Distinct counts that merge: sketches of parts, kept beside them, give the count of any union of parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of a sketch's cells.
CELLS = 12

#: What the summary of a result counts.
RESULT_COUNTS = {
    "n_pairs": ("fips", "fsa_county"),
    "n_units": ("fips",),
    "n_offices": ("fsa_county",),
    "n_types": ("pasture_type",),
    "n_sources": ("source",),
}


def relative_error(cells: int = CELLS) -> float:
    """Standard error of a sketch of ``2 ** cells`` cells, as a share of the count, counted from the sketch alone."""
    return 1.04 / 2 ** (cells / 2)


def _item(columns: Sequence[str]) -> Column:
    """One value for a combination of columns; null, and so not counted, where one of them is."""
    return F.col(columns[0]).cast("string") if len(columns) == 1 else F.when(
        ~F.exists(F.array(*[F.col(c).cast("string") for c in columns]), lambda v: v.isNull()),
        F.to_json(F.struct(*columns)),
    )


def sketches(
    df: DataFrame, by: Sequence[str], counts: Mapping[str, Sequence[str]], cells: int = CELLS
) -> DataFrame:
    """One row per part (``by``) with a sketch of each count's distinct combinations.

    A sketch has a fixed size and is combined before the shuffle, so a part of any size reaches it as one row
    per task.
    """
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(_item(c), cells).alias(name) for name, c in counts.items()])


def estimates(parts: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct counts over all parts, or of the parts that share ``by``, from their sketches alone."""
    return parts.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names])


def exact_counts(df: DataFrame, counts: Mapping[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """The counts that :func:`estimates` estimates."""
    return df.groupBy(*by).agg(*[F.count_distinct(_item(c)).alias(name) for name, c in counts.items()])
