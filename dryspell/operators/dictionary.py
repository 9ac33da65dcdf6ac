"""Sorted dictionaries of distinct values and the integer coding they give."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell.lineage import materialize

# monotonically_increasing_id keeps the row number of a partition in its lower bits.
ID_ROW_BITS = 33


def sorted_dictionary(df: DataFrame, dims: Mapping[str, str]) -> DataFrame:
    """``dim, value, code``: the distinct values of each column in byte order, coded from 0.

    ``dims`` maps a dictionary name to its column. No dictionary passes through one task whole: the
    values are range-partitioned and sorted, each row keeps its partition and its place in it, and
    the partition sizes give the offsets. The sorted values are written out before they are counted,
    so a task that runs again cannot place them differently.
    """
    pairs = F.array(*[
        F.struct(F.lit(d).alias("dim"), F.col(f"`{c}`").alias("value")) for d, c in dims.items()
    ])
    values = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
    placed = materialize(
        values.repartitionByRange("dim", "value").sortWithinPartitions("dim", "value")
        .withColumn("_id", F.monotonically_increasing_id())
    ).select(
        "dim", "value",
        F.shiftright("_id", ID_ROW_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << ID_ROW_BITS) - 1)).alias("_place"),
    )
    by_dim = Window.partitionBy("dim").orderBy("_part")
    pieces = placed.groupBy("dim", "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    offsets = pieces.select(
        "dim", "_part", (F.sum("_n").over(by_dim) - F.col("_n") - F.col("_first")).alias("_offset")
    )
    # One offset row per partition and dictionary.
    return placed.join(F.broadcast(offsets), ["dim", "_part"]).select(
        "dim", "value", (F.col("_offset") + F.col("_place")).cast("int").alias("code")
    )


def encode(df: DataFrame, dictionary: DataFrame, dims: Mapping[str, str]) -> DataFrame:
    """Add one code column per dictionary, named after it. ``dictionary`` is materialized, so Spark
    knows its size: small ones are broadcast, large ones joined sort-merge with hot values split."""
    for dim, column in dims.items():
        entry = dictionary.where(F.col("dim") == dim).select(
            F.col("value").alias(f"_{dim}"), F.col("code").alias(dim)
        )
        df = df.join(entry, F.col(column) == F.col(f"_{dim}")).drop(f"_{dim}")
    return df
