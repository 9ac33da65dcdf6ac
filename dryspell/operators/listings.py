"""File listings: reconciliation, the completeness gate, and what is left to build."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.functions.text import encode_key, is_internal, strip_prefix
from dryspell.operators.quality import assert_empty


def reconcile(
    expected: DataFrame,
    actual: DataFrame,
    allow_extra: Sequence[str] = (),
    exact: bool = True,
) -> DataFrame:
    """Problems between two listings (``key, size``): ``missing``, ``unexpected``, ``size mismatch``.

    One aggregation over both listings instead of a full outer join, so repeated keys combine before
    the shuffle. Sizes mismatch when any expected size differs from any actual size of the key.
    """
    size = F.col("size").cast("bigint")
    both = expected.select("key", size.alias("want"), F.lit(None).cast("bigint").alias("have"),
                           F.lit(1).alias("e"), F.lit(0).alias("a"))
    both = both.unionByName(
        actual.select("key", F.lit(None).cast("bigint").alias("want"), size.alias("have"),
                      F.lit(0).alias("e"), F.lit(1).alias("a"))
    )
    grouped = both.groupBy("key").agg(
        F.max("e").alias("e"), F.max("a").alias("a"),
        F.min("want").alias("want_min"), F.max("want").alias("want_max"),
        F.min("have").alias("have_min"), F.max("have").alias("have_max"),
    )
    differs = F.least("want_min", "have_min") != F.greatest("want_max", "have_max")
    problem = F.when(F.col("a") == 0, F.lit("missing"))
    if exact:
        extra = (F.col("e") == 0) & ~F.col("key").isin(*allow_extra)
        problem = problem.when(extra, F.lit("unexpected"))
    problem = problem.when((F.col("e") == 1) & differs, F.lit("size mismatch"))
    return (
        grouped.withColumn("problem", problem).where(F.col("problem").isNotNull())
        .select("key", "problem", F.col("want_max").alias("expected_size"),
                F.col("have_max").alias("actual_size"))
    )


def verify(expected: DataFrame, actual: DataFrame, **options) -> None:
    """Raise when two listings do not reconcile."""
    assert_empty(reconcile(expected, actual, **options), "listing differences")


def url_manifest(listing: DataFrame, base: str, prefix: str = "") -> DataFrame:
    """Published URLs of a listing in key order, without internal keys."""
    inner = strip_prefix("key", prefix) if prefix else F.col("key")
    url = F.concat(F.lit(base.rstrip("/") + "/"), encode_key("key"))
    return listing.where(~is_internal(inner)).select("key", url.alias("url")).orderBy("key")


def pending(manifest: DataFrame, built: DataFrame, on: str = "file") -> DataFrame:
    """Manifest rows whose output is not built yet."""
    return manifest.join(built.select(on), on, "left_anti")


def completeness_gate(
    manifest: DataFrame,
    required_sources: Sequence[str] | None = None,
    posted: DataFrame | None = None,
) -> DataFrame:
    """``file, posted``: whether a weekly file may be built.

    ``required_sources`` asks that every one of these sources lists the file. ``posted`` (``url``)
    asks that every URL the manifest lists for the file is really there. Either or both.
    """
    rows = manifest.select("source", "url", "file")
    if posted is not None:
        there = posted.select("url").distinct().withColumn("there", F.lit(True))
        rows = rows.join(there, "url", "left")
    else:
        rows = rows.withColumn("there", F.lit(True))
    checks = F.every(F.coalesce("there", F.lit(False)))
    for source in required_sources or ():
        checks = checks & F.bool_or(F.col("source") == source)
    return rows.groupBy("file").agg(checks.alias("posted"))


def waiting_for(
    manifest: DataFrame,
    required_sources: Sequence[str] | None = None,
    posted: DataFrame | None = None,
) -> DataFrame:
    """:func:`completeness_gate` with what a file waits for: ``file, posted, missing_sources, unposted``.

    Both arrays are empty where the file may be built. They hold source names and listed URLs, so at most
    as many as the file has sources.
    """
    rows = manifest.select("source", "url", "file")
    if posted is not None:
        there = posted.select("url").distinct().withColumn("there", F.lit(True))
        rows = rows.join(there, "url", "left")
    else:
        rows = rows.withColumn("there", F.lit(True))
    absent = F.when(F.col("there").isNull(), F.col("url"))
    required = F.array(*[F.lit(s) for s in required_sources or ()]).cast("array<string>")
    listed = rows.groupBy("file").agg(
        F.array_except(required, F.collect_set("source")).alias("missing_sources"),
        F.array_sort(F.collect_set(absent)).alias("unposted"),
    )
    complete = (F.size("missing_sources") == 0) & (F.size("unposted") == 0)
    return listed.select("file", complete.alias("posted"), "missing_sources", "unposted")


def nest_by_source(manifest: DataFrame) -> DataFrame:
    """One row per file with its ``(source, url)`` pairs in source order. Every row of the manifest is
    in one of the lists, whose length is the number of sources that list the file."""
    return manifest.groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct("source", "url"))).alias("entries")
    )


def unnest(nested: DataFrame) -> DataFrame:
    return nested.select("file", F.inline("entries"))
