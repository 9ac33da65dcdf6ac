"""Packs token sequences of documents into as few sequences of a fixed length as it can.

A document is its ids and an end id. Longer ones are cut into full pieces behind a shorter first one. The
histogram of piece lengths, at most ``size`` numbers whatever the corpus, states a configuration linear
program: how often to use each way of filling a sequence so that every piece has a place. It is solved by
multiplicative weights: lengths still short of places gain weight, and a knapsack dynamic program finds the
fullest sequence under the weights. Uses are rounded as they are made. The program places ``SHARE`` of the pieces
or more; the last ones, too few to be priced well, are placed best-fit first.
Pieces then look up their place by length and by rank among the pieces of that length.

A null text is empty and gives the end id alone. Rows that repeat a ``doc_id`` are packed each for itself.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell.lineage import materialize
from dryspell.llm.words import pieces

SIZE = 2048
END = 0
#: Share of the pieces that the program places, and how much longer pieces are preferred in it.
SHARE, LONG_BIAS = 0.95, 0.3
ROWS_A_BUCKET = 50_000
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
#: Text in these scripts is cut into words alike by both libraries; other texts take the slower one.
_PLAIN = re.compile("[^\u0000-ɏ‐-›€]")


@functools.cache
def encoder(vocabulary: str):
    """ids of a text: by the ranks file beside the vocabulary where both give the same ids, else by it."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(vocabulary)
    with open(re.sub(r"\.json$", ".tiktoken", vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if _PLAIN.search(text):
            return slow.encode(text, add_special_tokens=False).ids
        parts = text.split(SPECIAL)
        ids = fast.encode_ordinary(parts[0])
        for part in parts[1:]:
            ids.append(SPECIAL_ID)
            ids += fast.encode_ordinary(part)
        return ids

    return encode


def tokenize(docs: DataFrame, vocabulary: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, and the ids if asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in pieces(batches):
            out = defaultdict(list)
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.array([*encode(text or ""), END], dtype="<u4")
                head = (len(ids) - 1) % size + 1
                edges = [0, *range(head, len(ids) + 1, size)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    row = (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    for name, value in zip(("doc_id", "piece", "start", "length", "ids_crc32"), row):
                        out[name].append(value)
                    if with_ids:
                        out["ids"].append(ids[a:b])
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out)
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def fullest(weights: np.ndarray, size: int) -> list[int]:
    """Lengths that fit into ``size`` with the largest sum of weights (``weights[s]`` of length ``s``)."""
    value = np.zeros(size + 1)
    taken = np.zeros(size + 1, np.int64)
    for room in range(1, size + 1):
        ways = value[room - 1::-1][:room] + weights[1:room + 1]
        best = int(ways.argmax())
        if ways[best] > value[room - 1]:
            value[room], taken[room] = ways[best], best + 1
        else:
            value[room], taken[room] = value[room - 1], 0
    found, room = [], size
    while room > 0:
        if taken[room]:
            found.append(int(taken[room]))
            room -= taken[room]
        else:
            room -= 1
    return found


def fullest_of(weights: np.ndarray, size: int, left: np.ndarray) -> Counter:
    """:func:`fullest` with at most ``left[s]`` pieces of length ``s``: where it takes more, those there are stay
    and the rest of the room is filled anew without that length."""
    weights, found, room = weights.copy(), Counter(), size
    while True:
        config = Counter(fullest(weights, room))
        over = [s for s, k in config.items() if k > left[s]]
        if not over:
            return found + config
        for s in over:
            found[s] = int(left[s])
            room -= s * found[s]
            weights[s] = 0


def program(counts: dict[int, int], size: int, share: float) -> tuple[Counter, dict[int, int]]:
    """(configurations and how often each is used, pieces left over): a whole-numbered solution of the covering
    program for at least ``share`` of the pieces.

    Each round prices the lengths by multiplicative weights, their size times a factor that falls with the share
    of their pieces that have a place, finds the most valuable configuration under these prices by dynamic
    programming, and uses it as often as its scarcest length has pieces left. That rounds each use down as it is
    made, and prices the next on what is left, so nothing is lost to rounding. A round uses up a length or at
    least its full configurations, so there are few more rounds than lengths.
    """
    need = np.zeros(size + 1)
    for s, n in counts.items():
        need[s] = n
    left = need.copy()
    # Of configurations that fill a sequence alike those of longer pieces are better: short ones fill any gap.
    worth = np.arange(size + 1) * (1 + LONG_BIAS * np.arange(size + 1) / size)
    used: Counter = Counter()
    while left.sum() > (1 - share) * need.sum():
        placed = 1 - np.divide(left, need, out=np.ones_like(need), where=need > 0)
        config = fullest_of(np.where(left > 0, worth * np.exp(-placed), 0.0), size, left)
        times = min(int(left[s]) // k for s, k in config.items())
        for s, k in config.items():
            left[s] -= k * times
        used[tuple(sorted(config.elements(), reverse=True))] += times
    return used, {int(s): int(left[s]) for s in np.flatnonzero(left)}


def plan(counts: dict[int, int], size: int = SIZE, share: float = SHARE) -> list[tuple[tuple[int, ...], int]]:
    """Configurations and how many sequences use each; every piece of ``counts`` has one place."""
    used, left = program({s: n for s, n in counts.items() if n}, size, share)
    open_by_room: dict[int, Counter] = defaultdict(Counter)
    for config, times in used.items():
        open_by_room[size - sum(config)][config] += times
    # What the program left over: longest first, into the fullest sequence that has room.
    for s in sorted(left, reverse=True):
        todo = left[s]
        while todo:
            room = next((r for r in range(s, size + 1) if open_by_room.get(r)), None)
            if room is None:
                fit = size // s
                full, rest = divmod(todo, fit)
                if full:
                    open_by_room[size - fit * s][(s,) * fit] += full
                if rest:
                    open_by_room[size - rest * s][(s,) * rest] += 1
                break
            config, there = next(iter(open_by_room[room].items()))
            times = min(there, todo)
            open_by_room[room][config] -= times
            if not open_by_room[room][config]:
                del open_by_room[room][config]
            open_by_room[room - s][(*config, s)] += times
            todo -= times
    chosen: Counter = Counter()
    for group in open_by_room.values():
        chosen.update(group)
    return sorted((config, n) for config, n in chosen.items() if n)


def slots(configs: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, places in a sequence, offset of the first)."""
    found: dict[int, list] = defaultdict(list)
    taken: Counter = Counter()
    base = 0
    for config, times in configs:
        offset = 0
        for s, k in sorted(Counter(config).items(), reverse=True):
            found[s].append((taken[s], base, k, offset))
            taken[s] += times * k
            offset += s * k
        base += times
    return {s: np.array(rows, np.int64) for s, rows in found.items()}


def pack(docs_pieces: DataFrame, size: int = SIZE, share: float = SHARE) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. The pieces are written once to the shared folder."""
    spark = docs_pieces.sparkSession
    held = materialize(docs_pieces)
    rows = held.groupBy("length").count().collect()  # at most ``size`` rows
    counts = {r["length"]: r["count"] for r in rows}
    places = spark.sparkContext.broadcast(slots(plan(counts, size, share)))
    buckets = sum(counts.values()) // ROWS_A_BUCKET + 64

    # The rank within a length, counted in buckets so that a common length spreads over many tasks.
    bucketed = held.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    group = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = bucketed.groupBy("length", "bucket").count().select(
        "length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead")
    )
    ranked = bucketed.withColumn("place", F.row_number().over(group)).join(sums, ["length", "bucket"])

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for s in np.unique(length):
            table, at = places.value[int(s)], np.flatnonzero(length == s)
            row = table[np.searchsorted(table[:, 0], rank[at], side="right") - 1]
            done, nth = np.divmod(rank[at] - row[:, 0], row[:, 2])
            sequence[at], offset[at] = row[:, 1] + done, row[:, 3] + nth * s
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ranked = ranked.withColumn("found", find("length", F.col("ahead") + F.col("place") - 1))
    return ranked.select(*docs_pieces.columns, "found.sequence_id", "found.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the packed ids themselves, from pieces that were tokenized with ids."""
    part = F.struct("offset", "doc_id", "ids")
    parts = F.sort_array(F.collect_list(part))  # a sequence has ``size`` tokens at most
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids")
    )
