"""Readers of the input tables and of published results, all with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dryspell.model import CROSSWALK_SCHEMA, GRAZING_SCHEMA, PUBLISHED_NAMES, RESULT_SCHEMA
from dryspell.operators.aggregate import merged_wide
from dryspell.versions import Version, entries, newest, read_if_there


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """``fsa_county, fips`` pairs; only these two columns are read."""
    return (
        spark.read.parquet(path).select(*CROSSWALK_SCHEMA.fieldNames())
        .toDF("fsa_county", "fips").distinct()
    )


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """Grazing windows per office, year and pasture type."""
    raw = spark.read.parquet(path).select(*GRAZING_SCHEMA.fieldNames())
    return raw.select(
        F.col("Program Year").cast("int").alias("program_year"),
        F.concat("State FSA Code", "County FSA Code").alias("fsa_county"),
        F.col("Pasture Type").alias("pasture_type"),
        F.col("Grazing Period Start Date").cast("date").alias("window_start"),
        F.col("Grazing Period End Date").cast("date").alias("window_end"),
    )


def weekly_schema(sources: Sequence[str]) -> T.StructType:
    columns = [T.StructField("fips", T.StringType()), T.StructField("usdm_date", T.DateType())]
    return T.StructType(columns + [T.StructField(s, T.IntegerType()) for s in sources])


def read_weekly(spark: SparkSession, path: str, sources: Sequence[str]) -> DataFrame:
    """The weekly directory, one partition per week. A source a week lacks reads as null."""
    return spark.read.schema(weekly_schema(sources)).parquet(path)


#: What a version of the weekly archive lists: a file's rows of one week, and the build that wrote them. A file
#: without rows has one entry without a week.
PIECE_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("usdm_date", T.DateType()),
    T.StructField("build", T.StringType()),
    T.StructField("sources", T.ArrayType(T.StringType())),
    T.StructField("n_rows", T.LongType()),
])


def read_pieces(spark: SparkSession, path: str, sources: Sequence[str], pieces: DataFrame) -> DataFrame:
    """The rows of some pieces, with ``file`` and ``present`` (the sources that have a row)."""
    schema = T.StructType([
        *weekly_schema(sources), T.StructField("present", T.ArrayType(T.StringType())),
        T.StructField("file", T.StringType()), T.StructField("build", T.StringType()),
    ])
    rows = read_if_there(spark, path, schema)
    on = ["usdm_date", "file", "build"]
    return rows.join(pieces.select(*on), on, "left_semi").drop("build")


def read_archive(
    spark: SparkSession, path: str, state: str, sources: Sequence[str], at: Version | None = None
) -> DataFrame:
    """The weekly rows of the archive's newest version, or of an earlier one. A source a week lacks reads as
    null. Weeks that one file holds are read as they are; those of several files become one row per unit."""
    at = newest(spark, state) if at is None else at
    pieces = entries(spark, state, at, PIECE_SCHEMA).where(F.col("usdm_date").isNotNull())
    files = pieces.groupBy("usdm_date").agg(F.count(F.lit(1)).alias("_files")).where(F.col("_files") > 1)
    columns = weekly_schema(sources).fieldNames()
    alone = read_pieces(spark, path, sources, pieces.join(files, "usdm_date", "left_anti")).select(*columns)
    if files.isEmpty():
        return alone
    several = read_pieces(spark, path, sources, pieces.join(files, "usdm_date", "left_semi"))
    return alone.unionByName(merged_wide(several, sources).select(*columns))


def internal_names(published: DataFrame) -> DataFrame:
    back = {v: k for k, v in PUBLISHED_NAMES.items()}
    return published.select(*[F.col(f"`{c}`").alias(back[c]) for c in published.columns])


def published_names(eligibility: DataFrame) -> DataFrame:
    return eligibility.select(
        *[F.col(name).alias(heading) for name, heading in PUBLISHED_NAMES.items()]
    )


def read_result_csv(spark: SparkSession, path: str) -> DataFrame:
    """Published CSV with unit codes kept as text, leading zeros included."""
    reader = spark.read.schema(RESULT_SCHEMA).option("header", True)
    return internal_names(reader.option("dateFormat", "yyyy-MM-dd").csv(path))


def read_result_parquet(spark: SparkSession, path: str) -> DataFrame:
    return internal_names(spark.read.schema(RESULT_SCHEMA).parquet(path))
