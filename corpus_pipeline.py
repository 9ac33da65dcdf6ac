"""The corpus pipeline: stages over the documents, each written as Parquet and reread by the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dryspell.lineage import shared_dir
from dryspell.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from dryspell.llm.queries import RATE, TARGETS, VOCABULARY
from dryspell.shipping import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counted rules and the line labels keep."""
    ship(spark)
    field = quality_rules.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.judge(docs, field).where("kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document holds; those left without a word go."""
    ship(spark)
    kept = line_dedup.drop_repeated_lines(docs)
    emptied = (F.col("n_dropped") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    kept = kept.where(~emptied).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    return kept.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    ship(spark)
    return ngram_join.keep_representatives(docs, ngram_join.similar_groups(docs)).select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares."""
    ship(spark)
    return mixing.mix(docs, TARGETS, RATE).where("kept").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    ship(spark)
    return packing.pack(packing.tokenize(docs, VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("mixing", mixture),
    ("packing", packed),
]

#: SQL cannot express decoding, raking or tokenizing; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables go to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
