"""The whole archive: build pending weeks, determine, validate, publish, and list what was published."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dryspell.lineage import materialize
from dryspell.operators.listings import verify
from dryspell.operators.quality import validate_inputs
from dryspell.operators.units import map_units
from dryspell.plans.determine import determine_from_runs, weekly_series
from dryspell.plans.ingest import Build, ingest
from dryspell.plans.publish import publish
from dryspell.plans.run_state import update_runs
from dryspell.sinks.manifests import write_file_manifest, write_url_manifest
from dryspell.sinks.tables import write_combined
from dryspell.sources.listings import file_inventory, inventory_listing, object_listing, posted_files
from dryspell.sources.manifests import folders, load_manifests
from dryspell.sources.tables import PIECE_SCHEMA, read_archive, read_crosswalk, read_windows
from dryspell.versions import entries


class Rebuilt(NamedTuple):
    """The validated result, and what the weekly build built and skipped."""

    result: DataFrame
    build: Build


def live_files(inventory: DataFrame, pieces: DataFrame, folder: str = "weekly") -> DataFrame:
    """Files of an inventory without those of weekly pieces that are no longer, or not yet, in the archive."""
    part = lambda name: F.url_decode(F.regexp_extract("path", f"/{name}=([^/]*)", 1))
    weekly = F.col("path").startswith(f"{folder}/")
    names = inventory.withColumns({"_file": part("file"), "_week": part("usdm_date"), "_build": part("build")})
    live = pieces.select(
        F.col("file").alias("_file"), F.col("usdm_date").cast("string").alias("_week"),
        F.col("build").alias("_build"), F.lit(True).alias("_live"),
    )
    kept = names.join(live, ["_file", "_week", "_build"], "left").where(~weekly | F.col("_live"))
    return kept.select(*inventory.columns)


def rebuild(
    spark: SparkSession,
    manifests: Mapping[str, str],
    crosswalk_path: str,
    windows_path: str,
    out_dir: str,
    base_url: str,
    prefix: str = "",
    posted: DataFrame | None = None,
    remote: str | None = None,
    **join,
) -> Rebuilt:
    """Bring the archive under ``out_dir`` up to date.

    ``manifests`` maps each source to its text manifest. ``posted`` (``url``) lists the weekly files that are
    really there; without it the folders of the manifests are listed. Files that are not there, or not listed
    by every source, are skipped and returned with what they wait for; the rest is built. Runs are carried over
    from the build before; only new weeks, and series with late ones, are encoded.

    The files of the archive are verified against the manifest written for them, and against ``remote``, saved
    listing responses of the store, where they are given. ``join`` holds options of the overlap join.
    """
    sources = sorted(manifests)
    data, weekly, state = f"{out_dir}/data", f"{out_dir}/data/weekly", f"{out_dir}/versions"
    manifest = load_manifests(spark, manifests)
    if posted is None:
        roots = folders(manifest)
        posted = posted_files(spark, roots) if roots else None
    build = ingest(spark, manifest, sources, weekly, state, sources, posted)
    wide = read_archive(spark, weekly, state, sources, build.version)
    write_combined(wide, f"{out_dir}/combined")

    crosswalk = read_crosswalk(spark, crosswalk_path)
    offices = read_windows(spark, windows_path)
    windows = materialize(map_units(offices, crosswalk))
    validate_inputs(offices, windows, crosswalk)

    join.setdefault("write_windows", True)
    runs = update_runs(spark, f"{out_dir}/runs", weekly, state, sources, build.version)
    eligibility = determine_from_runs(runs, windows, **join)
    observations = weekly_series(wide, sources)
    result = publish(eligibility, windows, f"{out_dir}/result", observations=observations, skipped=build.skipped)

    pieces = entries(spark, state, build.version, PIECE_SCHEMA)
    inventory = live_files(file_inventory(spark, data), pieces).orderBy("path")
    write_file_manifest(inventory, f"{out_dir}/file_manifest")
    manifest_files = spark.read.schema("path string, size bigint, mtime string").json(f"{out_dir}/file_manifest")
    key_prefix = f"{prefix}/data" if prefix else "data"
    listing = inventory_listing(manifest_files, key_prefix)
    verify(listing, inventory_listing(inventory, key_prefix))
    if remote is not None:
        verify(listing, object_listing(spark, remote))
    write_url_manifest(listing, base_url, f"{out_dir}/url_manifest", prefix)
    return Rebuilt(result, build)
