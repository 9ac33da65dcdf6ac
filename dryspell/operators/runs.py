"""Run-length encoding of keyed, dated series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell.functions.dates import day_bin
from dryspell.model import SERIES_KEY, WEEK_DAYS


def run_length_encode(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEY,
    order: str = "usdm_date",
    value: str = "drought_class",
    step_days: int = WEEK_DAYS,
    block_days: int | None = None,
) -> DataFrame:
    """Maximal runs of a constant value: ``run_start``, ``run_end`` (inclusive) and ``run_weeks``.

    A run ends where the value differs from the previous *present* row, so missing dates inside a
    constant stretch are absorbed and count in the length. ``order`` is a date and unique per key,
    which bounds a key's rows by the calendar (52 a year for a weekly series).

    With ``block_days`` a series is also cut along time, for dense series under very hot keys: runs
    are found per (key, block), and only the first and last run of each block are brought together
    again by key. A key's largest task then holds one block, or two runs per block.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(order).alias("_date"), value).where(F.col(value).isNotNull())
    if block_days is None:
        return _plain_runs(rows, keys, value, step_days)
    return _stitched_runs(rows, keys, value, step_days, block_days)


def _plain_runs(rows, keys, value, step_days) -> DataFrame:
    """Each row learns of the row before it, then only the first rows of runs go on: a run ends where
    the next one's first row says the row before it was. One sort serves both passes."""
    w = Window.partitionBy(*keys).orderBy("_date")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = rows.select(
        "*",
        F.lag(value).over(w).alias("_before"),
        F.lag("_date").over(w).alias("_date_before"),
        F.row_number().over(w).cast("bigint").alias("_place"),
        F.max("_date").over(whole).alias("_last_date"),
        F.count(F.lit(1)).over(whole).alias("_rows"),
    ).where(F.col("_before").isNull() | (F.col("_before") != F.col(value)))
    end = F.coalesce(F.lead("_date_before").over(w), F.col("_last_date"))
    next_place = F.coalesce(F.lead("_place").over(w), F.col("_rows") + 1)
    return firsts.select(
        *keys, value, F.col("_date").alias("run_start"),
        F.date_add(end, step_days - 1).alias("run_end"),
        (next_place - F.col("_place")).alias("run_weeks"),
    )


def _stitched_runs(rows, keys, value, step_days, block_days) -> DataFrame:
    """Both passes work on sorted rows alone, which spill: no table of all runs of a task is held in memory."""
    in_block = Window.partitionBy(*keys, "_block").orderBy("run_start")
    blocks = rows.withColumn("_block", day_bin("_date", block_days))
    # Runs strictly inside a block are final and stay spread over (key, block). Edge runs share one
    # group per key, two rows per block at most, where neighbours of equal value are merged.
    edge = F.lag(F.lit(1)).over(in_block).isNull() | F.lead(F.lit(1)).over(in_block).isNull()
    pieces = _plain_runs(blocks, [*keys, "_block"], value, step_days).withColumn("_edge", edge)
    pieces = pieces.withColumn("_group", F.when(~F.col("_edge"), F.col("_block")))
    # Two edge runs of one block with other runs between them must stay apart, whatever their value.
    w = Window.partitionBy(*keys, "_group").orderBy("run_start")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same_block = F.col("_block") == F.lag("_block").over(w)
    before = F.lag(value).over(w)
    told = pieces.select(
        *keys, value, "_group", "run_start",
        (before.isNull() | (before != F.col(value)) | F.coalesce(same_block, F.lit(False))).alias("_first"),
        F.lag("run_end").over(w).alias("_end_before"),
        (F.sum("run_weeks").over(w) - F.col("run_weeks")).alias("_weeks_before"),
        F.max("run_end").over(whole).alias("_last_end"),
        F.sum("run_weeks").over(whole).alias("_weeks"),
    )
    # A piece without a date comes first; merged with the next, the run starts where that one does.
    joined = F.when(~F.lead("_first").over(w), F.lead("run_start").over(w))
    firsts = told.withColumn("run_start", F.coalesce("run_start", joined)).where("_first")
    goes_on = F.lead(F.lit(1)).over(w).isNotNull()
    end = F.when(goes_on, F.lead("_end_before").over(w)).otherwise(F.col("_last_end"))
    weeks_to = F.when(goes_on, F.lead("_weeks_before").over(w)).otherwise(F.col("_weeks"))
    return firsts.select(
        *keys, value, "run_start", end.alias("run_end"), (weeks_to - F.col("_weeks_before")).alias("run_weeks")
    )


def merge_runs(
    pieces: DataFrame, keys: Sequence[str] = SERIES_KEY, value: str = "drought_class"
) -> DataFrame:
    """Runs from pieces of runs, in one sort: neighbours of equal value become one. Pieces of a key must not
    overlap."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("run_start")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = pieces.select(
        *keys, value, "run_start",
        F.lag(value).over(w).alias("_before"),
        F.lag("run_end").over(w).alias("_end_before"),
        (F.sum("run_weeks").over(w) - F.col("run_weeks")).alias("_weeks_before"),
        F.max("run_end").over(whole).alias("_last_end"),
        F.sum("run_weeks").over(whole).alias("_weeks"),
    ).where(F.col("_before").isNull() | (F.col("_before") != F.col(value)))
    end = F.coalesce(F.lead("_end_before").over(w), F.col("_last_end"))
    weeks_to = F.coalesce(F.lead("_weeks_before").over(w), F.col("_weeks"))
    return firsts.select(
        *keys, value, "run_start", end.alias("run_end"), (weeks_to - F.col("_weeks_before")).alias("run_weeks")
    )


def expand_runs(
    runs: DataFrame, order: str = "usdm_date", step_days: int = WEEK_DAYS
) -> DataFrame:
    """The inverse of :func:`run_length_encode` for a series without gaps: one row per step."""
    steps = F.sequence("run_start", "run_end", F.expr(f"interval {int(step_days)} days"))
    return runs.withColumn(order, F.explode(steps)).drop("run_start", "run_end", "run_weeks")
