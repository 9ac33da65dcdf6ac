"""Cutting a plan where its result is used many times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

ROWS_A_TASK = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: the one the cluster names, a fresh one in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        named = sc.getCheckpointDir()
    return named


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The rows are computed once and outlive lost executors. Read back they have a known size, by which
    Spark broadcasts small tables and joins large ones sort-merge.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int, *keys: str, for_join: bool = False) -> DataFrame:
    """``df`` dealt by ``keys`` to a task for every ``ROWS_A_TASK`` of its ``rows``.

    Left to itself Spark joins shuffled pieces into one task up to a number of bytes, as they are compressed:
    narrow rows then make tasks of millions of rows. A join would deal both sides anew by the session's own
    number of partitions if that is larger, so ``for_join`` leaves it at that.
    """
    tasks = 1 + rows // ROWS_A_TASK
    if for_join and tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, *keys)
