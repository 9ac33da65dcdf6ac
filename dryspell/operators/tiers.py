"""Dating of the drought tiers reached inside a grazing window.

Each group is one grazing window of one unit. Its runs are disjoint and lie inside the window, so a
group never holds more rows than the window has days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dryspell.model import BELOW_D2, D2, D3, D4, GROUP_KEY, WEEK_DAYS

# Weeks a tier requires.
D2_WEEKS, D2A_WEEKS, D2B_WEEKS, D3B_WEEKS, D4B_WEEKS = 8, 4, 7, 4, 4

# Tier columns in the order that breaks ties between events of the same date.
EVENT_ORDER = ("D2_Sandwich", "D3b", "D4b", "D2a_2026", "D2b_2026", "D2", "D3a", "D4a")
SANDWICH_EVENT = "D2b_2026"


def _ordered(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("clip_start")


def first_run_reaching(level: int, days: int, w, value="drought_class") -> Column:
    """Last required day in the first run of ``level`` that alone lasts ``days`` days."""
    length = F.when(F.col(value) == level, F.col("clip_days"))
    before = F.max(length).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return F.when(
        (length >= days) & (F.coalesce(before, F.lit(0)) < days),
        F.date_sub("clip_end", F.col("clip_days") - days),
    )


def cumulative_crossing(level: int, days: int, w, value="drought_class") -> Column:
    """Last required day in the run of ``level`` that brings the group's total to ``days`` days."""
    length = F.when(F.col(value) == level, F.col("clip_days"))
    total = F.sum(length).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = total.cast("int")
    return F.when(
        (total >= days) & (total - length < days), F.date_sub("clip_end", total - days)
    )


def immediate(level: int, value="drought_class") -> Column:
    """First day of every run of ``level``."""
    return F.when(F.col(value) == level, F.col("clip_start"))


def sandwich(level: int, between: int, gap_days: int, days: int, w, value="drought_class") -> Column:
    """Last required day where two runs of ``level`` with one ``gap_days`` dip between them reach
    ``days`` days together and the first alone does not. Dated on the later run."""
    first_days = F.lag("clip_days", 2).over(w)
    together = F.col("clip_days") + first_days
    return F.when(
        (F.lag(value, 2).over(w) == level)
        & (F.lag(value, 1).over(w) == between)
        & (F.col(value) == level)
        & (first_days < days)
        & (F.lag("clip_days", 1).over(w) == gap_days)
        & (together >= days),
        F.date_sub("clip_end", together - days),
    )


def match_pattern(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    pattern: Sequence,
    name: str = "matched",
) -> DataFrame:
    """Flag the rows at which ``pattern`` starts, comparing consecutive rows of each group.

    A null never matches, and neither does an empty pattern nor one longer than the group.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    matched = F.lit(bool(pattern))
    for offset, wanted in enumerate(pattern):
        here = F.lead(value, offset).over(w) if offset else F.col(value)
        matched = matched & F.coalesce(here == wanted, F.lit(False))
    return df.withColumn(name, matched)


def relevant_runs(clipped: DataFrame) -> DataFrame:
    """Leave out the runs below D2 that do not last exactly one week; no tier can depend on them.

    They reach no tier themselves, and a tier needs a run below D2 only as a one-week dip between two
    D2 runs. Neighbouring runs differ in class, so the neighbours of a dip are always kept and no
    runs that were apart come to stand beside a dip. In most climates this drops the bulk of the rows
    before they are shuffled by window.
    """
    dip = F.col("clip_days") == WEEK_DAYS
    return clipped.where((F.col("drought_class") != BELOW_D2) | dip)


def date_tiers(clipped: DataFrame, keys: Sequence[str] = GROUP_KEY) -> DataFrame:
    """Add one date column per tier to the clipped runs. All tiers share one sorted window pass."""
    w = _ordered(keys)
    return clipped.withColumns({
        "D2_Sandwich": sandwich(D2, BELOW_D2, WEEK_DAYS, D2B_WEEKS * WEEK_DAYS, w),
        "D3b": cumulative_crossing(D3, D3B_WEEKS * WEEK_DAYS, w),
        "D4b": cumulative_crossing(D4, D4B_WEEKS * WEEK_DAYS, w),
        "D2a_2026": first_run_reaching(D2, D2A_WEEKS * WEEK_DAYS, w),
        "D2b_2026": first_run_reaching(D2, D2B_WEEKS * WEEK_DAYS, w),
        "D2": first_run_reaching(D2, D2_WEEKS * WEEK_DAYS, w),
        "D3a": immediate(D3),
        "D4a": immediate(D4),
    })


def event_rows(dated: DataFrame, keys: Sequence[str] = GROUP_KEY) -> DataFrame:
    """One row per dated tier, with the run start and the tier's rank that break ties later on."""
    options = ", ".join(
        f"struct({rank} as event_order, "
        f"'{SANDWICH_EVENT if name == 'D2_Sandwich' else name}' as event, "
        f"{name} as qualifying_date)"
        for rank, name in enumerate(EVENT_ORDER)
    )
    return (
        dated.where(F.coalesce(*EVENT_ORDER).isNotNull())
        .select(*keys, "clip_start", F.expr(f"inline(array({options}))"))
        .where(F.col("qualifying_date").isNotNull())
    )
