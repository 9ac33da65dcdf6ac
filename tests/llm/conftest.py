from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dryspell.shipping import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def build(pairs, **extra):
        rows = [(d, t, "en", f"src{i % 3}", len(t or "")) for i, (d, t) in enumerate(pairs)]
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
        return df

    return build
