"""Text manifests of weekly files, and the files they name."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dryspell.functions.levels import level_code
from dryspell.functions.text import base_name, path_key
from dryspell.model import RAW_OBSERVATION_SCHEMA
from dryspell.operators.quality import assert_empty
from dryspell.sources.listings import posted_files

# Fixed value: weekly files carry this in their names.
WEEKLY_MARK = "USDM_"

#: Spans of URLs a source's scan is narrowed to, at most.
SPANS = 64


def manifest_rows(lines: DataFrame, source: str, mark: str = WEEKLY_MARK) -> DataFrame:
    """``source, url, file`` of the lines (column ``value``) that name a weekly file."""
    return lines.where(F.col("value").contains(mark)).select(
        F.lit(source).alias("source"), F.col("value").alias("url"), base_name("value").alias("file")
    )


def load_manifests(
    spark: SparkSession, paths: Mapping[str, str], mark: str = WEEKLY_MARK
) -> DataFrame:
    """The manifests of several sources, each line tagged with its source."""
    parts = [manifest_rows(spark.read.text(path), source, mark) for source, path in paths.items()]
    return reduce(DataFrame.unionByName, parts)


def folders(manifest: DataFrame) -> list[str]:
    """The folders that hold a manifest's files: for each source what all its URLs start with. One row for
    each source reaches the driver."""
    ends = manifest.groupBy("source").agg(F.min("url").alias("lo"), F.max("url").alias("hi"))
    pairs = ends.agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("ends")).first().ends
    # What the smallest and the largest URL share, all between them share.
    found = sorted({os.path.commonprefix([lo, hi]).rpartition("/")[0] + "/" for lo, hi in pairs})
    return [f for f in found if not any(f != other and f.startswith(other) for other in found)]


class Span(NamedTuple):
    lo: str
    hi: str
    url: str


def url_spans(manifest: DataFrame, most: int = SPANS) -> list[Span]:
    """At most ``most`` spans of each source's URLs, in order, that hold them all: the first and last
    :func:`path_key`, and the first URL. A source with fewer URLs has a span for each."""
    by_source = Window.partitionBy("source").orderBy("key")
    rows = manifest.select("source", "url", path_key("url").alias("key"))
    spans = rows.withColumn("part", F.ntile(most).over(by_source)).groupBy("source", "part")
    ends = spans.agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.min("url").alias("url"))
    found = ends.agg(F.array_sort(F.collect_set(F.struct("lo", "hi", "url"))).alias("ends")).first().ends
    return [Span(*span) for span in found]


def read_manifest_files(
    manifest: DataFrame, schema: T.StructType = RAW_OBSERVATION_SCHEMA, mark: str = WEEKLY_MARK
) -> DataFrame:
    """The rows of every Parquet file (or table folder) a manifest names, with its ``source`` and ``file``.

    One scan for all sources. Up to ``SPANS`` URLs of a source are opened by name. Beyond that their folders are
    scanned: files outside the spans of the manifest's URLs are left out when the scan is planned, by their
    names alone, and the rest is met with the manifest by path. A URL that several sources list is read for
    each. Raises when a file is not there.
    """
    spark = manifest.sparkSession
    spans = url_spans(manifest)
    if not spans:
        empty = spark.createDataFrame([], schema)
        return empty.withColumns({c: F.lit(None).cast("string") for c in ("source", "file")})
    names = manifest.select("source", "file", path_key("url").alias("_key")).distinct()
    # The last part of the path with the mark in its name is the file, or the folder of a written table.
    path = path_key(F.col("_metadata.file_path"), encoded=True)
    key = F.regexp_extract(path, f"^(.*/[^/]*{re.escape(mark)}[^/]*)", 1)
    reader = spark.read.schema(schema)
    if all(span.lo == span.hi for span in spans):
        files = reader.parquet(*sorted({span.url for span in spans}))
    else:
        roots = folders(manifest)
        absent = names.join(posted_files(spark, roots), F.col("_key") == F.col("url"), "left_anti")
        assert_empty(absent.select("source", "file"), "manifest files that are not there")
        wanted = reduce(or_, [key.between(span.lo, span.hi) for span in spans])
        files = reader.option("recursiveFileLookup", True).parquet(*roots).where(wanted)
    return files.withColumn("_key", key).join(names, "_key").select(*schema.fieldNames(), "source", "file")


def raw_observations(files: DataFrame) -> DataFrame:
    """Raw file rows as observations: unit code, class ordinal, rows without a state dropped."""
    return files.where(F.col("STATEFP").isNotNull()).select(
        "source",
        "file",
        F.concat("STATEFP", "COUNTYFP").alias("fips"),
        "usdm_date",
        level_code("usdm_class").alias("drought_class"),
    )
