"""Nearest neighbours by cosine with cross-polytope hashing.

A table of the index turns unit vectors by a pseudo-rotation (random signs and a fast Hadamard transform,
three times) and files each under the signed axis nearest to it. A query looks into the buckets of its
nearest axes in every table. What it meets there is ranked in the bucket, and the best of all buckets are
ranked again by the exact measure on the original vectors.

Vectors that are null, empty, zero, of another length than most, or hold null or non-finite components
take no part; nor do rows without an id. Equal vectors are one point of the index that keeps as many of
its smallest ids as a result can name, so copies cannot swamp a bucket. Rows that repeat an id with the
same vector count once. A query with fewer results than it should have is compared with all points, in
blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dryspell.lineage import materialize

TABLES = 10
PROBES = 16
BUCKET_POINTS = 4096
SEED = 7


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of every row; the width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, width // (2 * half), 2, half)
        x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def rotated(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Unit rows, padded to a power of two, under the pseudo-rotation of one table."""
    width = 1 << max(x.shape[1] - 1, 0).bit_length()
    y = np.zeros((len(x), width))
    y[:, :x.shape[1]] = x
    rng = np.random.Generator(np.random.PCG64([seed, table, 0]))
    for _ in range(3):
        y = hadamard(y * rng.choice([-1.0, 1.0], width))
    return y


def axes(x: np.ndarray, table: int, probes: int, seed: int) -> np.ndarray:
    """Buckets (rows x probes) of one table, best first."""
    y = rotated(x, table, seed)
    return np.argsort(-np.concatenate((y, -y), axis=1), axis=1, kind="stable")[:, :probes].astype(np.int64)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    infinite = F.lit(float("inf"))
    sound = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < infinite))
    return vector.isNotNull() & sound & F.exists(vector, lambda v: v != 0)


def points(vectors: DataFrame, vec_id: str, vector: str, keep: int) -> DataFrame:
    """(point, vector, ids): distinct vectors with their ``keep`` smallest ids; point is the smallest."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    ).where(F.col("id").isNotNull() & usable(F.col("vector"))).distinct()
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    rows = rows.withColumn("nth", nth).where(F.col("nth") <= keep)
    return rows.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.col("ids")[0].alias("point"), "vector", "ids"
    )


def nearest(
    vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
    tables: int = TABLES, probes: int = PROBES, bucket_points: int = BUCKET_POINTS, seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found to every row that ``queries`` marks.

    A bucket is one axis however many points there are, so the share of them that a query meets, and with it
    recall, doesn't fall with their number. Large buckets are dealt to parts of ``4 * bucket_points`` points.
    """
    lengths = (
        vectors.where(usable(F.col(vector))).groupBy(F.size(vector).alias("n")).count()
        .orderBy(F.desc("count"), "n").limit(1).collect()
    )
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not lengths:
        return empty
    dim = lengths[0]["n"]
    right = vectors.where(F.size(vector) == dim)
    held = materialize(points(right, vec_id, vector, k + 1))
    n_points = held.count()
    asked = materialize(
        right.where(queries & usable(F.col(vector)) & F.col(vec_id).isNotNull())
        .select(F.col(vec_id).cast("long").alias("query"), F.col(vector).cast("array<double>").alias("vector"))
        .distinct()
    )
    # Queries with one vector are one search, among whose results each leaves out itself.
    searches = materialize(asked.groupBy("vector").agg(F.min("query").alias("search")))

    def file(key: str, probes: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 2000):
                    part = batch.slice(start, 2000)
                    x = unit(matrix(part.column("vector"), dim))
                    for table in range(tables):
                        found = axes(x, table, probes, seed)
                        for p in range(found.shape[1]):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(x), table, np.int32)), pa.array(found[:, p]),
                                 part.column(key), part.column("vector")],
                                ["table", "bucket", key, "vector"],
                            )
        return run

    layout = "table int, bucket long, {} long, vector array<double>"
    filed = held.select("point", "vector").mapInArrow(file("point", 1), layout.format("point"))
    probing = searches.select("search", "vector").mapInArrow(file("search", probes), layout.format("search"))
    # A bucket may still be large: its points are dealt to parts, and a query goes to every part.
    parts = filed.groupBy("table", "bucket").agg(
        F.ceil(F.count("*") / F.lit(4 * bucket_points)).cast("int").alias("parts")
    )
    parts = materialize(parts)
    filed = filed.join(parts, ["table", "bucket"]).withColumn("part", F.expr("cast(pmod(xxhash64(point), parts) as int)"))
    probing = probing.join(parts, ["table", "bucket"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # So are the queries of a bucket, by a bound that holds for any of them.
    turns = searches.count() // (32 * bucket_points) + 1
    filed = filed.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    probing = probing.withColumn("turn", F.expr(f"cast(pmod(xxhash64(search), {turns}) as int)"))
    keys = ["table", "bucket", "part", "turn"]

    def rank(points_table: pa.Table, query_table: pa.Table) -> pa.Table:
        # A few more than k, for what rounding may order otherwise here than in the last ranking.
        few = k + 8
        found = {"search": [], "point": []}
        if points_table.num_rows and query_table.num_rows:
            x = unit(matrix(points_table.column("vector").combine_chunks(), dim))
            q = unit(matrix(query_table.column("vector").combine_chunks(), dim))
            ids = points_table.column("point").to_numpy()
            names = query_table.column("search").to_numpy()
            for start in range(0, len(q), 256):
                scores = q[start:start + 256] @ x.T
                if scores.shape[1] > few:
                    best = np.argpartition(-scores, few - 1, axis=1)[:, :few]
                else:
                    best = np.tile(np.arange(scores.shape[1]), (len(scores), 1))
                found["search"].append(np.repeat(names[start:start + 256], best.shape[1]))
                found["point"].append(ids[best].ravel())
        return pa.table({n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in found.items()})

    met = (
        filed.select(*keys, "point", "vector").groupBy(*keys)
        .cogroup(probing.select(*keys, "search", "vector").groupBy(*keys))
        .applyInArrow(rank, "search long, point long")
        .distinct()
    )
    result = ranked(met, held, searches, asked, k)
    # What should have more results than it has is compared with all points, in blocks.
    result = materialize(result)
    total = right.where(usable(F.col(vector))).select(vec_id).where(F.col(vec_id).isNotNull()).distinct().limit(k + 1).count()
    short = asked.join(
        result.groupBy("query_id").count().where(F.col("count") >= min(k, total - 1)),
        F.col("query") == F.col("query_id"), "left_anti",
    )
    if total < 2 or short.isEmpty():
        return result
    short = materialize(short)
    block = 512
    few = searches.join(short.select("vector").distinct(), "vector", "left_semi")
    numbered = few.withColumn("part", F.expr(f"pmod(xxhash64(search), {max(1, few.count() // block)})"))
    blocks = [r["part"] for r in numbered.select("part").distinct().collect()]
    spread = held.withColumn("part", F.explode(F.array(*[F.lit(b) for b in blocks]).cast("array<long>")))
    spread = spread.withColumn("slice", F.expr(f"pmod(xxhash64(point), {n_points // (4 * bucket_points) + 1})"))
    slices = list(range(n_points // (4 * bucket_points) + 1))
    numbered = numbered.withColumn("slice", F.explode(F.array(*[F.lit(s) for s in slices]).cast("array<long>")))
    rest = (
        spread.select("part", "slice", "point", "vector").groupBy("part", "slice")
        .cogroup(numbered.select("part", "slice", "search", "vector").groupBy("part", "slice"))
        .applyInArrow(rank, "search long, point long")
    )
    more = ranked(rest.distinct(), held, searches, short, k)
    return result.join(short.select(F.col("query").alias("query_id")), "query_id", "left_anti").unionByName(more)


def ranked(met: DataFrame, held: DataFrame, searches: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of the pairs met, by the exact measure."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                dim = len(batch.column("a")[0])
                a, b = matrix(batch.column("a"), dim), matrix(batch.column("b"), dim)
                # Row by row in one order, so that equal vectors score alike.
                score = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
                weak = ~np.isfinite(score) | ((a * a).sum(axis=1) < 1e-200) | ((b * b).sum(axis=1) < 1e-200)
                if weak.any():
                    score[weak] = (unit(a[weak]) * unit(b[weak])).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("search"), batch.column("ids"), pa.array(score)], ["search", "ids", "score"]
                )

    pairs = met.join(searches.select("search", F.col("vector").alias("a")), "search").join(
        held.select("point", "ids", F.col("vector").alias("b")), "point"
    )
    scored = pairs.select("search", "ids", "a", "b").mapInArrow(
        measure, "search long, ids array<long>, score double"
    )
    best = Window.partitionBy("search").orderBy(F.desc("score"), "vec_id")
    listed = scored.select("search", "score", F.explode("ids").alias("vec_id")).withColumn(
        "nth", F.row_number().over(best)
    ).where(F.col("nth") <= k + 1)
    mine = asked.join(searches, "vector").select("query", "search")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return (
        mine.join(listed, "search").where("vec_id <> query")
        .select(F.col("query").alias("query_id"), rank.alias("rank"), "vec_id", "score")
        .where(F.col("rank") <= k)
    )
