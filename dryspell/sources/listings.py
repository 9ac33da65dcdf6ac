"""File and object listings as tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dryspell.functions.text import encode_key, path_key


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """``path, size, mtime`` of every file under ``root``, sorted by path relative to it.

    File contents are not read. Hidden files are left out, as are names Spark reserves for itself
    (leading underscore).
    """
    bare = re.sub(r"^[a-z0-9]+:/+", "/", root).rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(
        F.regexp_replace("path", "^.*?" + re.escape(bare) + "/", "").alias("path"),
        F.col("length").alias("size"),
        F.date_format("modificationTime", "yyyy-MM-dd HH:mm:ss").alias("mtime"),
    ).orderBy("path")


def inventory_listing(inventory: DataFrame, prefix: str) -> DataFrame:
    """An inventory as ``key, size``, as the object store would list it under ``prefix``."""
    key = F.concat(F.lit(prefix.rstrip("/") + "/"), F.col("path"))
    return inventory.select(key.alias("key"), "size")


def object_listing(spark: SparkSession, path: str) -> DataFrame:
    """``key, size`` from saved listing responses, one JSON document per file; an empty listing has
    no ``Contents`` and gives no rows."""
    pages = spark.read.schema("Contents array<struct<Key: string, Size: bigint>>")
    rows = pages.option("multiLine", True).json(path).select(F.inline("Contents"))
    return rows.toDF("key", "size")


def posted_files(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """``url`` of every file under the folders, and of the folders that hold them, as :func:`path_key`
    writes them. A table of many part files is posted under the name of its folder. Only names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(folders))
    path = path_key(F.col("_metadata.file_path"), encoded=True)
    folder = F.regexp_replace(path, "/[^/]*$", "")
    return files.select(F.explode(F.array(path, folder)).alias("url")).distinct()


def posted_keys(listing: DataFrame, base: str) -> DataFrame:
    """``url`` of every key of a listing that is published under ``base``."""
    return listing.select(F.concat(F.lit(base.rstrip("/") + "/"), encode_key("key")).alias("url"))
