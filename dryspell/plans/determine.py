"""The determination: weekly classes and grazing windows to scored, escalating events."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.functions.levels import collapse_levels
from dryspell.lineage import materialize
from dryspell.model import GROUP_KEY, LADDER, RESULT_COLUMNS, Rung
from dryspell.operators.aggregate import long_from_wide
from dryspell.operators.intervals import HOT_ROWS, WINDOW_SPAN, binned, clip, interval_join
from dryspell.operators.runs import run_length_encode
from dryspell.operators.scoring import escalating, score_events
from dryspell.operators.tiers import date_tiers, event_rows, relevant_runs
from dryspell.operators.units import observed_only


def drought_runs(observations: DataFrame, block_days: int | None = None) -> DataFrame:
    """Runs per unit and source. Classes below D2 merge first, which leaves far fewer runs to join."""
    merged = observations.withColumn("drought_class", collapse_levels("drought_class"))
    return run_length_encode(merged, block_days=block_days)


def weekly_series(wide: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Observations of a weekly wide table, ready for :func:`determine`. The wide rows are shuffled by
    unit once, one row per unit and week; the long rows made from them are not shuffled again."""
    return long_from_wide(wide.repartition("fips"), sources)


def clipped_runs(
    windows: DataFrame,
    runs: DataFrame,
    bin_days: int | None = 366,
    salts: int = 1,
    sources: Sequence[str] | None = None,
    strategy: str | None = None,
    hot_rows: int = HOT_ROWS,
    write_windows: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """Runs of each unit cut to each of its grazing windows.

    With ``sources`` the windows are repeated per source and the join is on unit and source, which
    keeps to the sources given. The keys then cover the runs' own partitioning: where
    ``spark.sql.requireAllClusterKeysForCoPartition`` is off, Spark shuffles the windows alone and
    runs and pairs stay where the run encoding put them.

    With ``write_windows`` the windows, once per source and time bin as the join takes them, are written
    first: Spark then decides on a broadcast by the size of just these rows.
    """
    spans, on = runs.drop("run_weeks"), ["fips"]
    if sources:
        per_source = F.explode(F.array(*[F.lit(s) for s in sources]))
        windows, on = windows.withColumn("source", per_source), ["fips", "source"]
    if write_windows:
        if bin_days is not None:
            windows = binned(windows, WINDOW_SPAN, bin_days)
        windows = materialize(windows)
    options = {"bin_days": bin_days, "salts": salts, "strategy": strategy, "hot_rows": hot_rows, "rows": rows}
    return clip(interval_join(windows, spans, on, **options))


def events_of_runs(runs: DataFrame, windows: DataFrame, **join) -> DataFrame:
    """Every dated tier; ``join`` holds the options of :func:`clipped_runs`.

    After the join the pairs that matter are dealt out by window and source: also after a broadcast, which
    leaves all pairs of a unit where its runs are, a unit with many windows spreads over as many tasks.
    """
    pairs = relevant_runs(clipped_runs(windows, runs, **join))
    return event_rows(date_tiers(pairs.repartition(*GROUP_KEY)))


def dated_events(
    observations: DataFrame, windows: DataFrame, block_days: int | None = None, **join
) -> DataFrame:
    """:func:`events_of_runs` from observations. Units without a window leave before anything is encoded."""
    return events_of_runs(drought_runs(observed_only(observations, windows), block_days), windows, **join)


def eligible(events: DataFrame, ladder: Iterable[Rung] | DataFrame = LADDER) -> DataFrame:
    """Dated events that raise the factor of their window, as the result has them."""
    kept = escalating(score_events(events, ladder))
    return kept.select(
        *[c for c in RESULT_COLUMNS if c != "drought_factor"],
        F.col("drought_factor").cast("int").alias("drought_factor"),
    )


def determine_from_runs(
    runs: DataFrame, windows: DataFrame, ladder: Iterable[Rung] | DataFrame = LADDER, **join
) -> DataFrame:
    """:func:`determine` where the runs are known already (:mod:`dryspell.plans.run_state`)."""
    return eligible(events_of_runs(observed_only(runs, windows), windows, **join), ladder)


def determine(
    observations: DataFrame,
    windows: DataFrame,
    ladder: Iterable[Rung] | DataFrame = LADDER,
    block_days: int | None = None,
    **join,
) -> DataFrame:
    """Eligibility events that raise the factor of their window.

    ``observations``: ``fips, source, usdm_date, drought_class`` (one row per unit, source and week).
    ``windows``: ``fips, fsa_county, program_year, pasture_type, window_start, window_end``.
    ``join``: options of :func:`clipped_runs`.
    """
    return eligible(dated_events(observations, windows, block_days, **join), ladder)
