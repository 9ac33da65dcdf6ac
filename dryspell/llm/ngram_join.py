"""Links documents whose sets of word shingles have a Jaccard similarity of at least a threshold.

Every set is a point: its shingles are hashed into groups and counted by group. The overlap of two sets is
at most the sum over groups of the smaller count, and for boxes of points the sum of the smaller upper
edges, so an R-tree over the points leaves out pairs, and whole boxes, that cannot reach the threshold.
A few hundred groups tell little about sets of thousands, so the leaves compare finer points, with groups
for half of the shingles up to ``TREE_GROUPS``, and pairs of larger sets meet once more as points without that
bound. What is left is verified on the sets themselves.

One R-tree over all points would compare every point with most boxes, since boxes of unrelated texts of one
length overlap in nearly all of some dozen groups. The trees are therefore planted by shared shingle: two
sets that are similar enough share one of the first ``n - ceil(t n) + 1`` shingles of each under any common
order of shingles. The order puts shingles that are frequent in a sample last, so that a passage many
documents hold seldom roots a tree; as any order is right, the sample only moves work.

Links are found in two rounds. The first compares each point with the smallest one of its trees, which
joins groups of copies by one link each. The second joins the trees with themselves, between points not
yet in one class. Copies of a set are one point. Large trees are dealt to several tasks by pairs of blocks.
These links make the components. All links of a set are then counted among the members of its component.

Texts without words have an empty set and no links. A null ``doc_id`` takes no part, has no component and
is returned. Rows that repeat a ``doc_id`` with other texts are different points of that id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell.lineage import materialize
from dryspell.llm.components import components
from dryspell.llm.words import Texts, pieces, shingle_sets

GROUPS = 256
LEAF = 32
TREE_GROUPS = 2048
BLOCK = 2048
PART = 256
DEGREE_BLOCK = 512
DEGREE_SHINGLES = 1 << 22
FILTER_BITS = 1 << 24
SAMPLE_DOCS = 20_000
FREQUENT = 50_000
THRESHOLD = Fraction(4, 5)


def frequent_shingles(docs: DataFrame, words: int, sample_docs: int, frequent: int) -> np.ndarray:
    """At most ``frequent`` shingles, the commonest of about ``sample_docs`` documents: a hint on the order."""
    every = max(1, docs.count() // sample_docs)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = shingle_sets(Texts(batch.column("text")), words)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["h"])

    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text")
    counted = chosen.mapInArrow(explode, "h long").groupBy("h").count().where("count >= 8")
    rows = counted.orderBy(F.desc("count"), "h").limit(frequent).collect()
    return np.sort(np.array([r["h"] for r in rows], np.int64).view(np.uint64))


def fineness(n: int, groups: int) -> int:
    """The groups of the finer point of ``n`` shingles: ``groups``, doubled until they are half of ``n``."""
    while 2 * groups < n:
        groups *= 2
    return groups


def pack(counts: np.ndarray) -> bytes:
    """Counts in the smallest unsigned integers that hold them."""
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def unpack(point: bytes, groups: int) -> np.ndarray:
    return np.frombuffer(point, f"<u{len(point) // groups}")


def profiles(
    docs: DataFrame, words: int, groups: int, threshold: Fraction, frequent: np.ndarray | None,
) -> DataFrame:
    """(doc_id, set, n): the set's 128-bit name and size; with ``frequent`` also its points and prefix."""
    spark = docs.sparkSession
    late = None if frequent is None else spark.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            names, sizes, points, fine, prefixes = [], [], [], [], []
            for own in shingle_sets(Texts(batch.column("text")), words):
                n = len(own)
                names.append(xxhash.xxh3_128_digest(own.tobytes()) if n else None)
                sizes.append(n)
                if late is None:
                    continue
                spots, width = (own >> np.uint64(40)).astype(np.int64), fineness(n, groups)
                counts = np.bincount(spots % width, minlength=width)
                points.append(pack(counts.reshape(-1, min(width, max(groups, TREE_GROUPS))).sum(axis=0)))
                fine.append(pack(counts))
                first = n - math.ceil(threshold * n) + 1 if n else 0
                if len(late.value):
                    at = np.minimum(np.searchsorted(late.value, own), len(late.value) - 1)
                    common = late.value[at] == own
                    own = np.concatenate((own[~common], own[common]))
                prefixes.append(own[:first].view(np.int64))
            columns = [batch.column("doc_id"), pa.array(names, pa.binary()), pa.array(sizes, pa.int64())]
            if late is not None:
                columns += [pa.array(points, pa.binary()), pa.array(fine, pa.binary())]
                columns += [pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "set", "n", "point", "fine", "prefix"][:len(columns)])

    schema = "doc_id long, set binary, n long"
    schema += ", point binary, fine binary, prefix array<long>" * (late is not None)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def folded(points: np.ndarray, groups: int) -> np.ndarray:
    """Points (rows) of more groups as points of ``groups``: groups that agree modulo that number are one."""
    return points.reshape(len(points), points.shape[1] // groups, groups).sum(axis=1, dtype=np.int32)


class Fine:
    """Some rows' finer points, held by their number of groups."""

    def __init__(self, packed: list[bytes], sizes: np.ndarray, groups: int, most: int):
        widths = np.array([min(fineness(int(n), groups), most) for n in sizes], np.int64)
        self.width, self.spot, self.points = widths, np.zeros(len(widths), np.int64), {}
        for w in np.unique(widths).tolist():
            at = np.flatnonzero(widths == w)
            self.spot[at] = np.arange(len(at))
            self.points[w] = np.stack([unpack(packed[i], w) for i in at])

    def coarse(self, groups: int) -> np.ndarray:
        out = np.zeros((len(self.width), groups), np.int32)
        for w, points in self.points.items():
            out[self.width == w] = folded(points, groups)
        return out

    def overlap(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Bound on the shingles that rows ``i`` and ``j`` have in common, pair by pair."""
        out = np.zeros(len(i), np.int64)
        for a, left in self.points.items():
            for b, right in self.points.items():
                pairs = np.flatnonzero((self.width[i] == a) & (self.width[j] == b))
                for at in np.array_split(pairs, len(pairs) * max(a, b) // (1 << 22) + 1):
                    both = (folded(left[self.spot[i[at]]], min(a, b)), folded(right[self.spot[j[at]]], min(a, b)))
                    out[at] = np.minimum(*both).sum(axis=1)
        return out


def enough(overlap: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Whether ``overlap`` shingles in common suffice: i / (a + b - i) >= t."""
    p, q = threshold.numerator, threshold.denominator
    return (p + q) * overlap.astype(np.int64) >= p * (a.astype(np.int64) + b)


def tree_join(points: np.ndarray, sizes: np.ndarray, classes: np.ndarray, side: np.ndarray, threshold: Fraction):
    """Pairs of points of different classes whose bound reaches the threshold.

    ``side`` is 0 everywhere for a join with itself; with 0 and 1 only pairs across are asked for. Leaves
    hold points next to each other by class and size, and the upper levels join neighbouring boxes.
    """
    order = np.lexsort((sizes, classes, side))
    points, sizes, classes, side = points[order], sizes[order], classes[order], side[order]
    level = [np.arange(0, len(order), LEAF)]
    high = [np.maximum.reduceat(points, level[0], axis=0)]
    low_n, high_n = [np.minimum.reduceat(sizes, level[0])], [np.maximum.reduceat(sizes, level[0])]
    while len(high[-1]) > LEAF:
        cut = np.arange(0, len(high[-1]), LEAF)
        high.append(np.maximum.reduceat(high[-1], cut, axis=0))
        low_n.append(np.minimum.reduceat(low_n[-1], cut))
        high_n.append(np.maximum.reduceat(high_n[-1], cut))
    p, q = threshold.numerator, threshold.denominator
    top = len(high) - 1
    a, b = np.triu_indices(len(high[top]))
    for k in range(top, -1, -1):
        bound = np.concatenate([
            np.minimum(high[k][a[s:s + 4096]], high[k][b[s:s + 4096]]).sum(axis=1)
            for s in range(0, len(a), 4096)
        ]) if len(a) else np.zeros(0, np.int64)
        good = enough(bound, low_n[k][a], low_n[k][b], threshold)
        good &= (q * high_n[k][a] >= p * low_n[k][b]) & (q * high_n[k][b] >= p * low_n[k][a])
        a, b = a[good], b[good]
        width = len(high[k - 1]) if k else len(order)
        pairs = []
        for x, y in zip(a, b):
            left = np.arange(x * LEAF, min((x + 1) * LEAF, width))
            right = np.arange(y * LEAF, min((y + 1) * LEAF, width))
            i, j = np.repeat(left, len(right)), np.tile(right, len(left))
            keep = i <= j if k else (i < j) & (classes[i] != classes[j])
            if k == 0:
                keep &= (side[i] != side[j]) if side.any() else True
            i, j = i[keep], j[keep]
            if k == 0:
                fits = enough(np.minimum(points[i], points[j]).sum(axis=1), sizes[i], sizes[j], threshold)
                fits &= q * np.minimum(sizes[i], sizes[j]) >= p * np.maximum(sizes[i], sizes[j])
                i, j = i[fits], j[fits]
            pairs.append((i, j))
        a = np.concatenate([i for i, _ in pairs]) if pairs else np.zeros(0, np.int64)
        b = np.concatenate([j for _, j in pairs]) if pairs else np.zeros(0, np.int64)
    return order[a], order[b]


def tree_pairs(rows: DataFrame, groups: int, threshold: Fraction) -> DataFrame:
    """(a, b) candidates among (h, lo, hi, block, node, n, class, point) rows, a tree for each (h, lo, hi).
    Points have up to ``TREE_GROUPS`` groups; the boxes are made of them folded to ``groups``."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found = None, []

        def work(table: pa.Table):
            keys = np.stack([table.column(c).to_numpy() for c in ("h", "lo", "hi")])
            node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
            classes = table.column("class").to_numpy()
            block = table.column("block").to_numpy()
            fine = Fine(table.column("point").to_pylist(), n, groups, max(groups, TREE_GROUPS))
            points = fine.coarse(groups)
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for s, e in zip([0, *edges], [*edges, len(node)]):
                if e - s < 2:
                    continue
                cross = keys[1, s] != keys[2, s]
                side = (block[s:e] == keys[2, s]).astype(np.int8) if cross else np.zeros(e - s, np.int8)
                if cross and side.all() or len(np.unique(classes[s:e])) < 2:
                    continue
                i, j = tree_join(points[s:e], n[s:e], classes[s:e], side, threshold)
                fits = enough(fine.overlap(s + i, s + j), n[s + i], n[s + j], threshold)
                i, j = i[fits], j[fits]
                if len(i):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.minimum(node[s + i], node[s + j])),
                        pa.array(np.maximum(node[s + i], node[s + j])),
                    ], ["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if not held.num_rows:
                continue
            keys = np.stack([held.column(c).to_numpy() for c in ("h", "lo", "hi")])
            last = np.flatnonzero((keys != keys[:, -1:]).any(axis=0))
            upto = int(last[-1]) + 1 if len(last) else 0
            if upto:
                yield from work(held.slice(0, upto))
                held = held.slice(upto)
        if held is not None and held.num_rows:
            yield from work(held)

    return rows.mapInArrow(join, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, threshold: Fraction) -> DataFrame:
    """Those of the pairs (a, b) of nodes whose sets reach the threshold.

    The texts of the nodes at hand are fetched once, then go to where their pairs are: the text of ``b`` to
    a part of the pairs of ``a``, and that of ``a`` once to each of its parts of ``PART`` pairs. There the
    sets are made and compared one after the other.
    """
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts"))
    part = F.expr("cast(pmod(xxhash64(b), parts) as int)")
    second = pairs.join(degree, "a").select(
        F.col("a").alias("hub"), part.alias("part"), F.lit(1).alias("side"), F.col("b").alias("node")
    )
    first = degree.select(
        F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(0).alias("side"), F.col("a").alias("node"),
    )
    places = materialize(
        first.union(second).join(nodes.select("node", F.col("set").alias("name"), "rep"), "node")
    )
    texts = maybe_among(
        docs.select(F.col("doc_id").cast("long").alias("rep"), "text"), "rep", places.select("rep")
    )
    dealt = (
        texts.join(places, "rep").drop("rep")
        .repartition("hub", "part").sortWithinPartitions("hub", "part", "side", "node")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mine, done = None, np.zeros(0, np.uint64), None
        for batch in pieces(batches):
            sets = shingle_sets(Texts(batch.column("text")), words)
            a, b = [], []
            for own, hub, place, side, node, name in zip(
                sets, *(batch.column(c).to_pylist() for c in ("hub", "part", "side", "node", "name"))
            ):
                # An id may be repeated: the row with the node's own set is the one, and once is enough.
                if xxhash.xxh3_128_digest(own.tobytes()) != name or done == (hub, place, side, node):
                    continue
                done = hub, place, side, node
                if side == 0:
                    at, mine = (hub, place), own
                elif at == (hub, place):
                    spot = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                    common = np.array([(own[spot] == mine).sum()])
                    if enough(common, np.array([len(mine)]), np.array([len(own)]), threshold)[0]:
                        a.append(hub)
                        b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shingles that each left set has in common with each right one."""
    every, at = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    split = sum(map(len, left))
    rows = [np.repeat(np.arange(len(sets)), list(map(len, sets))) for sets in (left, right)]
    columns = [at[:split], at[split:]]
    held = [np.bincount(c, minlength=len(every)) for c in columns]
    found = np.zeros((len(left), len(right)))
    # Shingles of many sets are multiplied as columns, those of few are met one by one.
    many = np.minimum(*held) >= 16
    for start in range(0, int(many.sum()), 2048):
        chosen = np.flatnonzero(many)[start:start + 2048]
        spot = np.full(len(every), -1)
        spot[chosen] = np.arange(len(chosen))
        sides = []
        for row, column, sets in zip(rows, columns, (left, right)):
            here = spot[column] >= 0
            side = np.zeros((len(sets), len(chosen)), np.float32)
            side[row[here], spot[column[here]]] = 1
            sides.append(side)
        found += sides[0] @ sides[1].T
    order = np.argsort(columns[1], kind="stable")
    members, first = rows[1][order], np.concatenate(([0], np.cumsum(held[1])))
    ends = np.cumsum(list(map(len, left)))
    for i, end in enumerate(ends):
        own = columns[0][end - len(left[i]):end]
        own = own[~many[own]]
        n = held[1][own]
        places = np.repeat(first[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
        found[i] += np.bincount(members[places], minlength=len(right))
    return found.astype(np.int64)


def degrees(docs: DataFrame, nodes: DataFrame, words: int, threshold: Fraction, block: int) -> DataFrame:
    """(node, n_links): the other sets that reach the threshold, of (node, rep, set, n, root) rows.

    A link is between members of one component, so its members' sets meet in pairs of blocks, each pair of
    sets once. The links are counted where they are found.
    """
    groups = nodes.groupBy("root").agg(F.count("*").alias("m"), F.sum("n").alias("shingles")).where("m > 1")
    parts = F.ceil(F.greatest(F.col("m") / F.lit(block), F.col("shingles") / F.lit(DEGREE_SHINGLES)))
    members = materialize(
        nodes.join(groups.select("root", parts.cast("int").alias("parts")), "root")
        .select("root", "parts", "node", "rep", F.col("set").alias("name"))
    )
    texts = maybe_among(
        docs.select(F.col("doc_id").cast("long").alias("rep"), "text"), "rep", members.select("rep")
    )
    dealt = (
        texts.join(members, "rep").drop("rep")
        .withColumn("block", F.expr("cast(pmod(xxhash64(node), parts) as int)"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("root", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                "block", "node", "name", "text")
        .repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi", "block", "node")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, sets = None, ([], []), ([], [])

        def links() -> Iterator[pa.RecordBatch]:
            within = at is not None and at[1] == at[2]
            left, right = (0, 0) if within else (0, 1)
            if not (sets[left] and sets[right]):
                return
            sizes = [np.array(list(map(len, sets[k]))) for k in (left, right)]
            linked = enough(overlaps(sets[left], sets[right]), sizes[0][:, None], sizes[1][None, :], threshold)
            if within:
                np.fill_diagonal(linked, False)
                yield batch_of(names[0], linked.sum(axis=1))
            else:
                yield batch_of(names[0], linked.sum(axis=1))
                yield batch_of(names[1], linked.sum(axis=0))

        def batch_of(node: list[int], n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(n)], ["node", "n"])

        for batch in pieces(batches):
            keys = (batch.column(c).to_pylist() for c in ("root", "lo", "hi", "block", "node", "name"))
            for own, root, lo, hi, block, node, name in zip(shingle_sets(Texts(batch.column("text")), words), *keys):
                if (root, lo, hi) != at:
                    yield from links()
                    at, names, sets = (root, lo, hi), ([], []), ([], [])
                side = int(block != lo)
                # An id may be repeated: the row with the node's own set is the one, and once is enough.
                if xxhash.xxh3_128_digest(own.tobytes()) != name or names[side][-1:] == [node]:
                    continue
                names[side].append(node)
                sets[side].append(own)
        yield from links()

    return dealt.mapInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n_links"))


def maybe_among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``wanted``: a filter ahead of a join.

    The filter is a bitmap of ``FILTER_BITS`` bits whatever the number of keys. With many keys it lets more
    rows through, which costs time and nothing else.
    """
    spot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    found = (
        wanted.select(spot.alias("spot"))
        .selectExpr("cast(spot div 64 as int) as word", "shiftleft(1L, cast(spot % 64 as int)) as bit")
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    )
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    held = rows.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    @F.pandas_udf("boolean")
    def there(spots: pd.Series) -> pd.Series:
        x = spots.to_numpy().astype(np.uint64)
        return pd.Series((held.value[x >> np.uint64(6)] >> (x & np.uint64(63))) & np.uint64(1) == 1)

    return rows.where(F.col(key).isNotNull()).where(there(spot))


def bounded(pairs: DataFrame, points: DataFrame, groups: int, threshold: Fraction) -> DataFrame:
    """Those of the pairs whose finer points' summed minima allow the threshold."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            overlap = []
            for x, y, n_a, n_b in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "n_a", "n_b"))):
                wide, other = fineness(n_a, groups), fineness(n_b, groups)
                both = min(wide, other)
                # The finer of the two is folded: groups that agree modulo the other's number are one there.
                left = unpack(x, wide).reshape(-1, both).sum(axis=0)
                right = unpack(y, other).reshape(-1, both).sum(axis=0)
                overlap.append(int(np.minimum(left, right).sum()))
            sizes = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            keep = pa.array(np.flatnonzero(enough(np.array(overlap, np.int64), *sizes, threshold)))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(keep) for c in "ab"], ["a", "b"])

    p, q = threshold.numerator, threshold.denominator
    both = (
        pairs.join(points.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a")
        .join(points.select(F.col("node").alias("b"), F.col("fine").alias("y"), F.col("n").alias("n_b")), "b")
        .where(f"{q} * least(n_a, n_b) >= {p} * greatest(n_a, n_b)")
        .join(points.select(F.col("node").alias("a"), F.col("fine").alias("x")), "a")
    )
    return both.select("a", "b", "x", "y", "n_a", "n_b").mapInArrow(check, "a long, b long")


def similar_groups(
    docs: DataFrame, words: int = 5, threshold: Fraction = THRESHOLD, groups: int = GROUPS,
    sample_docs: int = SAMPLE_DOCS, frequent: int = FREQUENT, block: int = BLOCK,
    degree_block: int = DEGREE_BLOCK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links): a row for each of ``docs``.

    ``n_links`` counts the other sets that reach the threshold with the document's set; copies of a set are
    not counted.
    """
    hint = frequent_shingles(docs.where("doc_id is not null"), words, sample_docs, frequent)
    profile = materialize(profiles(docs, words, groups, threshold, hint))
    held = profile.where("doc_id is not null and set is not null")
    nodes = held.groupBy("set").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))
    # A node is named by its smallest id; if the id is repeated, by a negative hash from its second set on.
    nth = F.row_number().over(Window.partitionBy("rep").orderBy("set"))
    name = F.when(nth == 1, F.col("rep")).otherwise(-F.abs(F.xxhash64("set") % (1 << 62)) - 1)
    nodes = materialize(nodes.withColumn("node", name))
    first = held.join(nodes.select("set", "node", "rep"), "set").where("doc_id = rep")
    # A row may be stored more than once, and a node must be in a tree once.
    first = first.dropDuplicates(["set"])

    entries = first.select("node", F.explode("prefix").alias("h"))
    trees = entries.groupBy("h").agg(
        F.min("node").alias("leader"), F.max("node").alias("last"), F.count("*").alias("m"),
        F.bit_xor(F.xxhash64("node")).alias("mark"),
    )
    rows = entries.join(trees.where("leader < last").drop("last"), "h")
    rows = materialize(rows)
    points = first.select("node", "point", "fine").join(rows.select("node").distinct(), "node", "left_semi")
    points = materialize(points.join(nodes.select("node", "n"), "node").dropDuplicates(["node"]))
    # Trees of the same points are one tree.
    once = rows.where("node = leader").groupBy("m", "leader", "mark").agg(F.min("h").alias("h")).select("h")
    rows = materialize(rows.join(once, "h", "left_semi").select("h", "node", "m", "leader"))

    stars = rows.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    stars = bounded(stars, points, groups, threshold)
    # One link is enough for a first guess at the classes; the rest is left to the trees.
    stars = materialize(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    links = materialize(verified(stars, docs, nodes, words, threshold))
    classes = materialize(components(links))

    known = rows.join(classes, "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root")
    spans = known.groupBy("h").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    mixed = known.join(spans.where("low < high").select("h"), "h", "left_semi")
    parts = F.ceil(F.col("m") / F.lit(block)).cast("int")
    dealt = (
        mixed.withColumn("parts", parts)
        .withColumn("block", F.expr("cast(pmod(xxhash64(node, h), parts) as int)"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .join(points, "node")
        .select("h", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                "block", "node", "n", "class", "point")
        .repartition("h", "lo", "hi").sortWithinPartitions("h", "lo", "hi")
    )
    across = tree_pairs(dealt, groups, threshold).join(stars, ["a", "b"], "left_anti")
    across = materialize(bounded(across, points, groups, threshold))
    if not across.isEmpty():
        links = materialize(links.union(verified(across, docs, nodes, words, threshold)))
        classes = components(links)
    joined = nodes.select("set", "node", "rep", "n").join(classes, "node", "left")
    joined = materialize(joined.withColumn("root", F.coalesce("root", "node")))
    degree = degrees(docs, joined, words, threshold, degree_block)
    joined = joined.join(degree, "node", "left")
    least = joined.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = joined.join(least, "root").select("set", "component_id", "n_links")
    result = profile.select("doc_id", "set", F.col("n").alias("n_shingles")).join(named, "set", "left")
    return result.select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def keep_representatives(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``docs`` without the rows that are not the first of their group; rows without an id stay."""
    later = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("__later")).distinct()
    return docs.join(later, docs["doc_id"].cast("long") == F.col("__later"), "left_anti")
