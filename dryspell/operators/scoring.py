"""Era-dependent scoring and the escalation filter."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dryspell.lineage import materialize
from dryspell.model import GROUP_KEY, LADDER, Rung
from dryspell.operators.quality import assert_empty

BIN_YEARS = 16


def ladder_factor(ladder: Iterable[Rung] = LADDER) -> Column:
    """Factor an event earns in a program year; 0 where the ladder has no rung for it."""
    branches = []
    for rung in ladder:
        name = rung.event.replace("\\", "\\\\").replace("'", "\\'")
        until = "" if rung.last_year is None else f" and program_year <= {int(rung.last_year)}"
        branches.append(
            f"when event = '{name}' and program_year >= {int(rung.first_year)}{until} "
            f"then {int(rung.factor)}"
        )
    return F.expr(f"case {' '.join(branches)} else 0 end") if branches else F.lit(0)


def overlapping_rungs(ladder: DataFrame) -> DataFrame:
    """Rungs of a ladder table that reach into the next rung of their event, with its first year as ``overlap``."""
    by_event = Window.partitionBy("event").orderBy("first_year", F.asc_nulls_last("last_year"))
    following = F.lead("first_year").over(by_event)
    rungs = ladder.select("event", "first_year", "last_year", following.alias("overlap"))
    return rungs.where(F.col("overlap").isNotNull() & (F.col("last_year").isNull() | (F.col("overlap") <= F.col("last_year"))))


def table_factor(events: DataFrame, ladder: DataFrame, bin_years: int = BIN_YEARS) -> DataFrame:
    """``events`` with the ``drought_factor`` of the rung that holds their year, null without one.

    Rungs are met by event and span of ``bin_years`` years, in which an event has few of them; the last rung of
    an event may be open and is met by event alone. The rungs are written before, so that Spark knows their size
    and broadcasts a small ladder.
    """
    first, last = F.col("first_year"), F.col("last_year")
    year_bin = lambda c: F.floor(c / F.lit(bin_years)).cast("bigint")
    bins = F.explode(F.sequence(year_bin(first), year_bin(last))).alias("_bin")
    closed = ladder.where(first <= last).select(
        "event", bins, first.alias("_first"), last.alias("_last"), F.col("factor").alias("_factor")
    )
    opened = ladder.where(last.isNull()).select("event", first.alias("_from"), F.col("factor").alias("_open"))
    year = F.col("program_year")
    met = events.withColumn("_bin", year_bin(year)).alias("e")
    closed, opened = materialize(closed).alias("c"), materialize(opened).alias("o")
    met = met.join(closed, (F.col("e.event") == F.col("c.event")) & (F.col("e._bin") == F.col("c._bin"))
                   & year.between(F.col("_first"), F.col("_last")), "left")
    met = met.join(opened, (F.col("e.event") == F.col("o.event")) & (year >= F.col("_from")), "left")
    factor = F.coalesce("_factor", "_open").alias("drought_factor")
    return met.select(*[F.col(f"e.`{c}`") for c in events.columns if c != "drought_factor"], factor)


def score_events(events: DataFrame, ladder: Iterable[Rung] | DataFrame = LADDER) -> DataFrame:
    """Add ``drought_factor`` and keep the events that earn something.

    A ladder of :class:`Rung` becomes one expression and needs no join. One that is a table (``event,
    first_year, last_year, factor``; a null last year leaves it open) is joined, whatever its size; spans of one
    event that overlap raise.
    """
    if isinstance(ladder, DataFrame):
        assert_empty(overlapping_rungs(ladder), "rungs that overlap the next one of their event")
        scored = table_factor(events, ladder)
    else:
        scored = events.withColumn("drought_factor", ladder_factor(ladder))
    return scored.where(F.col("drought_factor") > 0)


def escalating(
    df: DataFrame,
    keys: Sequence[str] = GROUP_KEY,
    order: Sequence[str] = ("qualifying_date", "clip_start", "event_order"),
    value: str = "drought_factor",
) -> DataFrame:
    """Keep the rows that raise ``value`` above everything before them in their group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.max(value).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return (
        df.withColumn("_before", before)
        .where(F.col("_before").isNull() | (F.col(value) > F.col("_before")))
        .drop("_before")
    )
