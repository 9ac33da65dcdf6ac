"""Closed-interval overlap join and clipping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.functions.dates import day_bin, length_days, overlaps
from dryspell.lineage import spread

WINDOW_SPAN = ("window_start", "window_end")
RUN_SPAN = ("run_start", "run_end")

HOT_ROWS = 10_000


def binned(df: DataFrame, span: Sequence[str], bin_days: int) -> DataFrame:
    """Rows with a usable span, once for each time bin (``_bin``) that it touches."""
    start, end = span
    bins = F.sequence(day_bin(start, bin_days), day_bin(end, bin_days))
    return df.where(F.col(start) <= F.col(end)).withColumn("_bin", F.explode(bins))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_span: Sequence[str] = WINDOW_SPAN,
    right_span: Sequence[str] = RUN_SPAN,
    bin_days: int | None = 366,
    salts: int = 1,
    strategy: str | None = None,
    hot_rows: int = HOT_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Pairs with equal ``on`` whose closed spans share a day. Null or reversed spans match nothing.

    With ``bin_days`` both sides are keyed by the time bins they touch and each pair is kept only in
    the bin where the later of the two starts, so every pair appears once. A key then compares the
    rows of one bin instead of all its rows, and spreads over as many tasks as it has bins.

    ``salts`` spreads a (key, bin) further that more than ``hot_rows`` left rows share: each of them
    takes one of ``salts`` slots, and the right rows of these keys alone are repeated per slot. A
    sort-merge join also splits skewed partitions at run time.

    ``strategy`` is ``broadcast`` (the left side, which needs no salts), ``merge``, or None to let Spark
    choose by size. A left side that holds ``_bin`` already, from :func:`binned`, is taken as it is: it
    can be written before, so that Spark knows the size of what it may broadcast.

    ``rows``, about as many as a side holds, deals both sides of a join without broadcast to a task for every
    ``ROWS_A_TASK`` of them where these are more than the session's own number of partitions.
    """
    if strategy not in (None, "broadcast", "merge"):
        raise ValueError(f"unknown strategy: {strategy}")
    (ls, le), (rs, re_) = left_span, right_span
    keys = list(on)
    if bin_days is None:
        left = left.where(F.col(ls) <= F.col(le))
        right = right.where(F.col(rs) <= F.col(re_))
    else:
        if "_bin" not in left.columns:
            left = binned(left, left_span, bin_days)
        right = binned(right, right_span, bin_days)
        keys.append("_bin")
    if salts > 1 and strategy != "broadcast":
        hot = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
        hot = hot.select(*keys, F.lit(True).alias("_hot"))
        slot = F.pmod(F.xxhash64(*[c for c in left.columns if c != "_bin"]), F.lit(salts)).cast("int")
        left = left.join(hot, keys, "left").withColumn(
            "_slot", F.when(F.col("_hot"), slot).otherwise(F.lit(0))
        ).drop("_hot")
        last = F.when(F.col("_hot"), F.lit(salts - 1)).otherwise(F.lit(0))
        right = right.join(hot, keys, "left").withColumn(
            "_slot", F.explode(F.sequence(F.lit(0), last))
        ).drop("_hot")
        keys.append("_slot")
    if rows is not None and strategy != "broadcast":
        left = spread(left, rows, *keys, for_join=True)
        right = spread(right, rows, *keys, for_join=True)
    if strategy:
        left = left.hint(strategy)
    pairs = left.join(right, keys).where(overlaps(ls, le, rs, re_))
    if bin_days is not None:
        pairs = pairs.where(F.col("_bin") == day_bin(F.greatest(ls, rs), bin_days))
    return pairs.drop("_bin", "_slot")


def clip(
    pairs: DataFrame,
    left_span: Sequence[str] = WINDOW_SPAN,
    right_span: Sequence[str] = RUN_SPAN,
) -> DataFrame:
    """Replace the two spans of each pair by their intersection and its length in days."""
    (ls, le), (rs, re_) = left_span, right_span
    start, end = F.greatest(ls, rs), F.least(le, re_)
    return pairs.withColumns(
        {"clip_start": start, "clip_end": end, "clip_days": length_days(start, end)}
    ).drop(ls, le, rs, re_)
