"""Validation and export of a determination."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dryspell.operators.quality import checked_result, coverage
from dryspell.sinks.columnar import write_document, write_shards
from dryspell.sinks.report import write_report
from dryspell.sinks.tables import write_result_csv, write_result_parquet, write_sketches


def publish(
    eligibility: DataFrame,
    windows: DataFrame,
    out_dir: str,
    observations: DataFrame | None = None,
    skipped: DataFrame | None = None,
    **header,
) -> DataFrame:
    """Validate, then write Parquet, CSV, the columnar document and the report under ``out_dir``.

    The result is computed once into the checkpoint folder, where its invariants are counted on the way, and
    everything is written from there. Nothing is written when an invariant fails. With ``observations`` the
    report counts windows that were left out, with ``skipped`` it lists weekly files that were not built.
    Returns the validated result.
    """
    result = checked_result(eligibility, windows)
    left_out = None if observations is None else coverage(windows, observations)
    write_report(result, f"{out_dir}/report", left_out, skipped)
    write_result_csv(result, f"{out_dir}/eligibility_csv")
    write_result_parquet(result, f"{out_dir}/eligibility_parquet")
    write_document(result, f"{out_dir}/eligibility_json", **header)
    write_shards(result, f"{out_dir}/eligibility_shards")
    write_sketches(result, f"{out_dir}/sketches")
    return result
