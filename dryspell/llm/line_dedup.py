"""Drops lines that repeat across documents, except in one document.

Lines are exploded as hashes of their keys, counted by distinct documents, and the texts put together
again from what stays. A key is a line without white space at its ends, A-Z lower-cased; short keys stay.

Rows with a null ``doc_id`` belong to no document: they are counted nowhere and keep all lines. A null or
empty text is one empty line. Rows that repeat a ``doc_id`` are one document, and each is returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.llm.words import pieces

WHITE = " \t\n\x0b\x0c\r"


def key_hash(line: str, min_chars: int) -> bytes | None:
    """128 bits of the key of ``line``, or nothing where the key is too short to count."""
    key = line.strip(WHITE)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(key, doc_id), once for each key of a row."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keys, owners = [], []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = {key_hash(line, min_chars) for line in text.split("\n")} - {None}
                keys.extend(found)
                owners.extend([doc_id] * len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(owners, pa.int64())], ["key", "doc_id"]
            )

    held = docs.where("doc_id is not null and text is not null")
    return held.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        explode, "key binary, doc_id long"
    )


def repeated_keys(keys: DataFrame, min_docs: int) -> DataFrame:
    """Keys of at least ``min_docs`` documents, with the smallest ``doc_id``.

    With two documents the smallest and largest ids tell, so each task sends one row for a key. Above that
    the (key, doc_id) pairs are made distinct first, which spreads a common key over its documents.
    """
    if min_docs <= 2:
        found = keys.groupBy("key").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
        return found.where(F.lit(min_docs < 2) | (F.col("keeper") < F.col("last"))).drop("last")
    found = keys.distinct().groupBy("key").agg(F.min("doc_id").alias("keeper"), F.count("*").alias("n"))
    return found.where(F.col("n") >= min_docs).drop("n")


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``docs`` with the lines that stay as ``text``, and the columns ``n_lines`` and ``n_dropped``.

    Other columns are carried along, whatever their names; ``n_lines`` and ``n_dropped`` of the input are
    replaced.
    """
    keys = line_keys(docs, min_chars)
    repeated = repeated_keys(keys, min_docs)
    lost = (
        keys.join(repeated, "key")
        .where("doc_id > keeper")
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias("__lost"))
        .withColumnRenamed("doc_id", "__owner")
    )
    docs = docs.drop("n_lines", "n_dropped")
    joined = docs.join(lost, docs["doc_id"].cast("long") == lost["__owner"], "left").drop("__owner")
    plain = [c for c in docs.columns if c != "text"]

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts, totals, drops = [], [], []
            for text, lost_keys in zip(
                batch.column("text").to_pylist(), batch.column("__lost").to_pylist(), strict=True
            ):
                lines = (text or "").split("\n")
                totals.append(len(lines))
                if lost_keys:
                    gone = set(lost_keys)
                    lines = [x for x in lines if key_hash(x, min_chars) not in gone]
                    text = "\n".join(lines)
                texts.append(text)
                drops.append(totals[-1] - len(lines))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in plain]
                + [pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(drops, pa.int64())],
                [*plain, "text", "n_lines", "n_dropped"],
            )

    kinds = {f.name: f.dataType for f in docs.schema.fields}
    schema = ", ".join(
        [f"`{c.replace('`', '``')}` {kinds[c].simpleString()}" for c in plain]
        + ["text string", "n_lines long", "n_dropped long"]
    )
    return joined.select(*[F.col(f"`{c}`") for c in plain], "text", "__lost").mapInArrow(rebuild, schema)


def sha256(text: str | None) -> str:
    return hashlib.sha256((text or "").encode()).hexdigest()
