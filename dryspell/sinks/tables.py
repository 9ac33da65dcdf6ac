"""Parquet and CSV output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.operators.sketches import RESULT_COUNTS, sketches
from dryspell.sources.tables import published_names

# Storage settings of every published Parquet file.
PARQUET_OPTIONS = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "13",
    "parquet.enable.dictionary": "true",
}

RESULT_ORDER = (
    "fips", "fsa_county", "source", "program_year", "pasture_type", "qualifying_date",
    "drought_factor",
)


def write_weeks(wide: DataFrame, path: str) -> None:
    """One partition directory per week, rows sorted by unit. Only the weeks in ``wide`` are replaced.

    Rows are range-partitioned by week and unit, so a large week is split over several tasks and
    each task still writes few weeks.
    """
    (
        wide.repartitionByRange("usdm_date", "fips")
        .sortWithinPartitions("usdm_date", "fips")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .options(**PARQUET_OPTIONS).partitionBy("usdm_date").parquet(path)
    )


def write_pieces(wide: DataFrame, path: str, build: str) -> None:
    """The rows of a build beside those of earlier ones: a folder for each week, file and build, rows sorted
    by unit. Nothing that is there is touched."""
    rows = wide.withColumn("build", F.lit(build))
    (
        rows.repartitionByRange("usdm_date", "file", "fips")
        .sortWithinPartitions("usdm_date", "file", "fips")
        .write.mode("append").options(**PARQUET_OPTIONS)
        .partitionBy("usdm_date", "file", "build").parquet(path)
    )


def write_combined(wide: DataFrame, path: str) -> None:
    """All weeks in one table sorted by unit and date."""
    wide.orderBy("fips", "usdm_date").write.mode("overwrite").options(
        **PARQUET_OPTIONS
    ).parquet(path)


def write_result_parquet(eligibility: DataFrame, path: str) -> None:
    rows = published_names(eligibility.orderBy(*RESULT_ORDER))
    rows.write.mode("overwrite").options(**PARQUET_OPTIONS).parquet(path)


def write_sketches(eligibility: DataFrame, path: str) -> None:
    """Sketches of the result's distinct counts, a row per program year. Years of several results merge."""
    rows = sketches(eligibility, ["program_year"], RESULT_COUNTS)
    rows.write.mode("overwrite").options(**PARQUET_OPTIONS).parquet(path)


def write_result_csv(eligibility: DataFrame, path: str) -> None:
    rows = published_names(eligibility.orderBy(*RESULT_ORDER))
    rows.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
