"""Incremental weekly build: what is listed, posted and not built yet becomes a new version of the archive."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dryspell.functions.text import path_key
from dryspell.lineage import materialize
from dryspell.operators.aggregate import merged_wide, weekly_wide
from dryspell.operators.listings import waiting_for
from dryspell.operators.quality import assert_unique
from dryspell.sinks.tables import write_pieces
from dryspell.sources.manifests import raw_observations, read_manifest_files
from dryspell.sources.tables import PIECE_SCHEMA, read_pieces
from dryspell.versions import Version, commit, entries, newest, read_if_there


class Build(NamedTuple):
    """``built`` (``file``), ``skipped`` (``file, missing_sources, unposted``), and the version after the build."""

    built: DataFrame
    skipped: DataFrame
    version: Version


def not_built(manifest: DataFrame, live: DataFrame) -> DataFrame:
    """Manifest rows of sources whose rows of the file are not in the archive yet."""
    built = live.select("file", F.explode("sources").alias("source"))
    return manifest.join(built, ["source", "file"], "left_anti")


def written_pieces(spark: SparkSession, weekly_dir: str, build: str, sources: DataFrame) -> DataFrame:
    """Entries of what a build wrote, counted from its files; ``sources`` says by file whose rows it holds.
    A file whose rows all fell away has an entry too, so that it counts as built."""
    rows = read_if_there(spark, weekly_dir, "usdm_date date, file string, build string")
    counts = rows.where(F.col("build") == build).groupBy("file", "usdm_date").agg(F.count(F.lit(1)).alias("n_rows"))
    every = sources.join(counts, "file", "left").withColumns(
        {"build": F.lit(build), "n_rows": F.coalesce("n_rows", F.lit(0))}
    )
    return every.select(*PIECE_SCHEMA.fieldNames())


def ingest(
    spark: SparkSession,
    manifest: DataFrame,
    sources: Sequence[str],
    weekly_dir: str,
    state_dir: str,
    required_sources: Sequence[str] | None = None,
    posted: DataFrame | None = None,
) -> Build:
    """Build what is pending and return which files were built, which were skipped and what they wait for.

    A file is pending as long as the manifest lists it for a source whose rows are not in the archive, so a
    source that lists a built file later adds its rows to it. ``posted`` (``url``) holds what is really there:
    files with a pending URL that is not are skipped.

    Rows go to ``weekly_dir`` by week, file and build, and count when the new version is committed to
    ``state_dir``. A run that dies before leaves the archive as it was, and the next one builds the same files.
    """
    assert_unique(manifest, ["source", "file"], "weekly manifest")
    parent = newest(spark, state_dir)
    live = entries(spark, state_dir, parent, PIECE_SCHEMA)
    fresh = not_built(manifest, live)
    rows = manifest.join(fresh.select("file").distinct(), "file", "left_semi")
    rows = rows.withColumn("url", path_key("url"))
    if posted is not None:
        done = rows.join(fresh, ["source", "file"], "left_anti").select("url")
        posted = posted.select(path_key("url").alias("url")).unionByName(done)
    # One row per file of the todo list; it is used several times and must not change in between.
    gate = materialize(waiting_for(rows, required_sources, posted))
    skipped = gate.where(~F.col("posted")).select("file", "missing_sources", "unposted")
    ready = gate.where("posted").select("file")
    if ready.isEmpty():
        return Build(ready, skipped, parent)

    todo = materialize(fresh.join(ready, "file", "left_semi"))
    build = uuid.uuid4().hex
    raw = raw_observations(read_manifest_files(todo))
    ids = ["file", "fips", "usdm_date"]
    wide = weekly_wide(raw, sources, ids=ids, present="present")
    extended = live.join(ready, "file", "left_semi")
    if not extended.isEmpty():
        # Each source has its rows of a file from one build, so that nothing is merged within a source.
        old = read_pieces(spark, weekly_dir, sources, extended)
        wide = merged_wide(wide.unionByName(old), sources, ids=ids)
    write_pieces(wide, weekly_dir, build)

    listed = todo.select("file", "source").unionByName(extended.select("file", F.explode("sources").alias("source")))
    by_file = listed.groupBy("file").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    written = written_pieces(spark, weekly_dir, build, by_file)
    kept = live.join(ready, "file", "left_anti")
    return Build(ready, skipped, commit(kept.unionByName(written), state_dir, parent))
