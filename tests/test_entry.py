"""The entry points as the driver calls them."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry_points
from dryspell.plans import catalog

# Rows of the flagship query recorded for the given tables.
RECORDED = {"sf0.001": 1629, "sf0.01": 3129, "sf0.1": 3733}


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.count() == RECORDED["sf0.001"]
    assert [f.name for f in result.schema] == [
        "fips", "fsa_county", "source", "program_year", "pasture_type", "event",
        "qualifying_date", "drought_factor",
    ]


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_recorded_rows(spark, sf_dir, size):
    folder = os.path.join(os.path.dirname(sf_dir), size)
    assert entry_points.queries()["eligibility"](spark, folder).count() == RECORDED[size]


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_imports_without_subpackage(tmp_path, left_out):
    """A copy of the library without ``llm``, with and without the pipeline's file, offers all domain queries."""
    root = os.path.dirname(os.path.abspath(entry_points.__file__))
    skip = shutil.ignore_patterns("__pycache__", *left_out)
    shutil.copytree(os.path.join(root, "dryspell"), tmp_path / "dryspell", ignore=skip)
    for name in {"__spark_entry__.py", "corpus_pipeline.py"} - set(left_out):
        if os.path.exists(os.path.join(root, name)):
            shutil.copy(os.path.join(root, name), tmp_path)
    listed = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", listed], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert [line.split() for line in said.stdout.splitlines()] == [sorted(catalog.QUERIES)] * 2
