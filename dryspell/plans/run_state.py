"""Runs carried from build to build: new weeks extend or close runs, the archive is not encoded again.

A series is a run table of closed runs and one open run, the last. New weeks behind the open run are encoded by
themselves and joined to it. A week inside or before the open run, late or corrected, rewinds its series to the
run before the one it falls into: the runs from there on are void, and the series is encoded again from there.

Each build adds its closed runs and, for rewound series, the date from which older runs are void, under its own
id; the open runs, one for each series, are written anew. The build counts when it is committed
(:mod:`dryspell.versions`).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dryspell.functions.levels import collapse_levels
from dryspell.lineage import materialize
from dryspell.model import SERIES_KEY, WEEK_DAYS
from dryspell.operators.runs import merge_runs, run_length_encode
from dryspell.plans.determine import weekly_series
from dryspell.sources.tables import PIECE_SCHEMA, read_archive
from dryspell.versions import NOTHING, Version, commit, entries, newest, read_if_there, version

KEYS = list(SERIES_KEY)
VALUE = "drought_class"
RUN_COLUMNS = [*KEYS, VALUE, "run_start", "run_end", "run_weeks"]
RUN_SCHEMA = T.StructType([
    *[T.StructField(k, T.StringType()) for k in KEYS], T.StructField(VALUE, T.IntegerType()),
    T.StructField("run_start", T.DateType()), T.StructField("run_end", T.DateType()),
    T.StructField("run_weeks", T.LongType()),
])
BUILD = T.StructField("build", T.StringType())
VOID_SCHEMA = T.StructType([
    *[T.StructField(k, T.StringType()) for k in KEYS], T.StructField("void_from", T.DateType()), BUILD,
])
#: Live builds of a run table in their order. ``covers`` is the version of the weekly archive they reach.
BUILD_SCHEMA = "build string, number bigint, covers bigint"


def open_runs(spark: SparkSession, root: str, at: Version) -> DataFrame:
    """The last run of every series."""
    builds = entries(spark, root, at, BUILD_SCHEMA).where(F.col("number") == at.number)
    rows = read_if_there(spark, f"{root}/open", T.StructType([*RUN_SCHEMA.fields, BUILD]))
    return rows.join(builds.select("build"), "build", "left_semi").select(*RUN_COLUMNS)


def closed_runs(spark: SparkSession, root: str, at: Version) -> DataFrame:
    """All other runs: those that no later build made void."""
    builds = entries(spark, root, at, BUILD_SCHEMA).select("build", "number")
    rows = read_if_there(spark, f"{root}/closed", T.StructType([*RUN_SCHEMA.fields, BUILD])).join(builds, "build")
    void = read_if_there(spark, f"{root}/void", VOID_SCHEMA).join(builds, "build").select(
        *[F.col(k).alias(f"_{k}") for k in KEYS], "void_from", F.col("number").alias("_later")
    )
    same = [F.col(k) == F.col(f"_{k}") for k in KEYS]
    gone = (F.col("_later") > F.col("number")) & (F.col("run_start") >= F.col("void_from"))
    return rows.join(void, [*same, gone], "left_anti").select(*RUN_COLUMNS)


def read_runs(spark: SparkSession, root: str, at: Version | None = None) -> DataFrame:
    """All runs of the newest version, or of an earlier one."""
    at = newest(spark, root) if at is None else at
    return closed_runs(spark, root, at).unionByName(open_runs(spark, root, at))


def covered(spark: SparkSession, root: str, at: Version) -> int:
    """The version of the weekly archive that the runs reach."""
    found = entries(spark, root, at, BUILD_SCHEMA).agg(F.max("covers").alias("covers")).first().covers
    return found or 0


def rewound(late: DataFrame, runs: DataFrame) -> DataFrame:
    """Where each late series (``first_date``) starts anew: at the run before the one its first changed week
    falls into, at that run where it is the first, at the week itself where all runs come later."""
    met = runs.join(late, KEYS).where(F.col("run_start") <= F.col("first_date"))
    latest = Window.partitionBy(*KEYS).orderBy(F.desc("run_start"))
    two = met.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") <= 2)
    starts = two.groupBy(*KEYS).agg(F.min("run_start").alias("_start"))
    return late.join(starts, KEYS, "left").select(*KEYS, F.coalesce("_start", "first_date").alias("void_from"))


def advance(
    spark: SparkSession,
    root: str,
    changes: DataFrame,
    observations: DataFrame,
    covers: int = 0,
    step_days: int = WEEK_DAYS,
) -> Version:
    """Bring the runs under ``root`` up to date and return the new version.

    ``changes``: ``fips, source, usdm_date, drought_class`` of weeks that are new, came late or were corrected (a
    null class corrects a week to unknown). ``observations`` are all current ones, changes included; only those of
    series with late or corrected weeks are used, from where they start anew.
    """
    parent = newest(spark, root)
    changes = materialize(changes.select(*KEYS, "usdm_date", VALUE))
    last = open_runs(spark, root, parent)
    first = changes.groupBy(*KEYS).agg(F.min("usdm_date").alias("first_date"))
    known = first.join(last.select(*KEYS, "run_end"), KEYS, "left")
    # A run ends a step after its last week.
    is_late = F.coalesce(F.col("first_date") <= F.date_sub("run_end", step_days - 1), F.lit(False))
    touched = materialize(known.select(*KEYS, "first_date", is_late.alias("late")))
    late, on_time = touched.where("late").drop("late"), touched.where(~F.col("late")).select(*KEYS)

    added = run_length_encode(changes.join(on_time, KEYS, "left_semi"), KEYS, value=VALUE, step_days=step_days)
    rows = merge_runs(added.unionByName(last.join(on_time, KEYS, "left_semi")), KEYS, VALUE)
    void = materialize(rewound(late, read_runs(spark, root, parent).join(late.select(*KEYS), KEYS, "left_semi")))
    if not void.isEmpty():
        again = observations.join(void, KEYS).where(F.col("usdm_date") >= F.col("void_from"))
        rows = rows.unionByName(run_length_encode(again, KEYS, value=VALUE, step_days=step_days))
    after = F.lead("run_start").over(Window.partitionBy(*KEYS).orderBy("run_start"))
    rows = materialize(rows.withColumn("_last", after.isNull()))

    build = uuid.uuid4().hex
    kept = last.join(touched.select(*KEYS), KEYS, "left_anti")
    write_build(rows.where(~F.col("_last")).drop("_last"), f"{root}/closed", build)
    write_build(rows.where("_last").drop("_last").unionByName(kept), f"{root}/open", build)
    write_build(void, f"{root}/void", build)
    return add_build(entries(spark, root, parent, BUILD_SCHEMA), root, parent, build, covers)


def compact(spark: SparkSession, root: str) -> Version:
    """One build with all live runs instead of many, so that readers meet no void ones."""
    parent = newest(spark, root)
    build = uuid.uuid4().hex
    write_build(closed_runs(spark, root, parent), f"{root}/closed", build)
    write_build(open_runs(spark, root, parent), f"{root}/open", build)
    none = entries(spark, root, NOTHING, BUILD_SCHEMA)
    return add_build(none, root, parent, build, covered(spark, root, parent))


def write_build(rows: DataFrame, path: str, build: str) -> None:
    rows.withColumn("build", F.lit(build)).write.mode("append").partitionBy("build").parquet(path)


def add_build(live: DataFrame, root: str, parent: Version, build: str, covers: int) -> Version:
    row = live.sparkSession.createDataFrame([(build, parent.number + 1, covers)], BUILD_SCHEMA)
    return commit(live.unionByName(row).coalesce(1), root, parent)


def changed_weeks(spark: SparkSession, state: str, since: int, at: Version) -> DataFrame:
    """Weeks (``usdm_date``) with pieces that an earlier version of the weekly archive did not have."""
    before = version(spark, state, since) if since else NOTHING
    on = ["file", "usdm_date", "build"]
    new = entries(spark, state, at, PIECE_SCHEMA).join(entries(spark, state, before, PIECE_SCHEMA), on, "left_anti")
    return new.where(F.col("usdm_date").isNotNull()).select("usdm_date").distinct()


def update_runs(
    spark: SparkSession, root: str, weekly: str, state: str, sources: Sequence[str], at: Version | None = None
) -> DataFrame:
    """The runs of the weekly archive, brought up to its newest version (or ``at``) from the version they reach."""
    at = newest(spark, state) if at is None else at
    since = covered(spark, root, newest(spark, root))
    if since < at.number:
        wide = read_archive(spark, weekly, state, sources, at)
        weeks = changed_weeks(spark, state, since, at)
        cells = F.array(*[F.struct(F.lit(s).alias("source"), F.col(f"`{s}`").alias(VALUE)) for s in sources])
        # Cells without a class stay: they may correct a week to unknown.
        changes = wide.join(weeks, "usdm_date", "left_semi").select("fips", "usdm_date", F.inline(cells))
        changes = changes.withColumn(VALUE, collapse_levels(VALUE))
        advance(spark, root, changes, weekly_series(wide, sources), at.number)
    return read_runs(spark, root)
