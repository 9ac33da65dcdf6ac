"""Versions of a table of immutable pieces: which pieces make up the table is decided by one small commit.

Pieces are written first, under the id of their build. A manifest then lists all live pieces, and a row in the
log makes it the table's newest version. The log row is one file that appears at once, so a run that dies at any
point before it changes nothing: its pieces and its manifest are never looked at. Readers take the newest row.

Builds of one table are meant to follow one another. Two that commit at the same time leave two rows of one
version; the one with the smaller manifest id counts, and the other build raises.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "version bigint, manifest string"


class Version(NamedTuple):
    number: int
    manifest: str | None


#: The table before its first build.
NOTHING = Version(0, None)


class ConcurrentBuild(RuntimeError):
    """Another build committed the same version."""


def read_if_there(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table; one that was never written is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def newest(spark: SparkSession, root: str) -> Version:
    """The newest committed version. One row reaches the driver."""
    log = read_if_there(spark, f"{root}/log", LOG_SCHEMA)
    row = log.orderBy(F.desc("version"), "manifest").first()
    return Version(row.version, row.manifest) if row else NOTHING


def version(spark: SparkSession, root: str, number: int) -> Version:
    """An earlier version."""
    log = read_if_there(spark, f"{root}/log", LOG_SCHEMA).where(F.col("version") == number)
    row = log.orderBy("manifest").first()
    if row is None:
        raise LookupError(f"{root} has no version {number}")
    return Version(row.version, row.manifest)


def entries(spark: SparkSession, root: str, at: Version, schema) -> DataFrame:
    """The live pieces of a version."""
    if at.manifest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/manifests/{at.manifest}")


def commit(pieces: DataFrame, root: str, parent: Version) -> Version:
    """Make ``pieces`` the version after ``parent``."""
    spark = pieces.sparkSession
    new = Version(parent.number + 1, uuid.uuid4().hex)
    pieces.write.parquet(f"{root}/manifests/{new.manifest}")
    row = spark.createDataFrame([new], LOG_SCHEMA).coalesce(1)
    row.write.mode("append").parquet(f"{root}/log")
    if version(spark, root, new.number) != new:
        raise ConcurrentBuild(f"version {new.number} of {root} was committed by another build")
    return new
