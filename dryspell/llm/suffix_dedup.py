"""Removes every byte that a repeated string of ``window`` bytes covers, within and across documents.

A string is repeated when it starts in two places of any texts. The search narrows in steps, each exact:

1. The smallest hash of a ``gram``-byte string inside a window, the leftmost of equals, is its anchor. Equal windows
   have equal anchors in equal places. Neighbouring windows of one anchor are an interval. An interval whose
   anchor is nowhere else holds no repeated window; one whose bytes are all found again, around the same anchor,
   is wholly repeated; the others are open.
2. Windows of open intervals are dealt, ``SLOT`` to a slot, by their distance from the anchor. All windows of a slot
   hold its core, so a slot is that core as one symbol and the few bytes around it. Cores found once are done.
3. The slots of a core, one for each different rim, are joined to a text of symbols, whose suffix array puts
   equal windows side by side.

Groups are bounded or combined before they meet: copies inside one batch send one row to step 1, an anchor that
is common inside a batch is keyed with its bytes, and slots of a core with very many rims leave step 3 and are
counted window by window.

A null text is empty. Rows that repeat a ``doc_id`` are documents of their own, so equal rows lose whatever is long
enough. Texts shorter than ``window`` stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dryspell.lineage import materialize
from dryspell.llm.suffix_array import suffix_array
from dryspell.llm.words import CHUNK_BYTES, Texts, mix, pieces, powers

WINDOW, GRAM, SLOT = 200, 32, 16
#: Bytes hashed at a time, window starts of a long text looked at in one go.
BLOCK = 500_000
#: From so many different intervals in one batch on, an anchor's intervals are keyed by their bytes as well.
COMMON = 16
#: Slots of a core that one suffix array takes at most, and symbols after which an array is closed.
SLOTS, SYMBOLS = 20_000, 100_000

_rng = np.random.Generator(np.random.PCG64(7))
_TABLES = _rng.integers(0, 2**64, (2, 256), dtype=np.uint64)
_BASES = [int(x) * 2 + 1 for x in _rng.integers(2**61, 2**62, 2)]
_INVERSES = [pow(b, -1, 2**64) for b in _BASES]
_POSITION = np.uint64(2**24 - 1)


class Hashes:
    """Two 64-bit hashes of any range of some bytes."""

    def __init__(self, data: np.ndarray):
        self.sums = []
        for table, base in zip(_TABLES, _BASES):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(table[data] * powers(base, len(data))[:len(data)], out=sums[1:])
            self.sums.append(sums)
        self.inverse = [powers(base, len(data) + 1) for base in _INVERSES]

    def of(self, which: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = self.sums[which]
        return mix((sums[end] - sums[first]) * self.inverse[which][first])


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, by steps of doubled length."""
    step = 1
    while step * 2 <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[:len(values) - (width - step)], values[width - step:]) if step < width else values


def blocks(offsets: np.ndarray, window: int) -> Iterator[tuple[int, int, np.ndarray, int]]:
    """(first byte, end byte, offsets inside it, row) of stretches of about ``BLOCK`` bytes. Rows stay whole; a
    longer row comes in stretches that overlap by a window less one."""
    row = 0
    while row < len(offsets) - 1:
        upto = int(np.searchsorted(offsets, offsets[row] + BLOCK, side="right")) - 1
        if upto > row:
            yield offsets[row], offsets[upto], offsets[row:upto + 1] - offsets[row], row
            row = upto
            continue
        begin, end = offsets[row], offsets[row + 1]
        for at in range(begin, max(end - window + 1, begin + 1), BLOCK):
            stop = min(end, at + BLOCK + window - 1)
            yield at, stop, np.array([0, stop - at]), row
        row += 1


def intervals(texts: Texts, window: int, gram: int) -> dict[str, np.ndarray]:
    """Every interval of the texts: its row, first window (``start``, in the row), windows (``count``), bytes from
    the first window to the anchor (``lead``), and the hashes of the anchor (``key``) and of all bytes (``sub``)."""
    found = []
    for begin, end, offsets, row in blocks(texts.offsets, window):
        data = texts.bytes[begin:end]
        if len(data) < window:
            continue
        hashes = Hashes(data)
        place = np.arange(len(data) - gram + 1)
        keys = hashes.of(0, place, place + gram)
        best = smallest((keys & ~_POSITION) | place.astype(np.uint64), window - gram + 1) & _POSITION
        start = np.arange(len(best))
        own = np.searchsorted(offsets, start, side="right") - 1
        inside = start + window <= offsets[own + 1]
        start, own, anchor = start[inside], own[inside], best[inside].astype(np.int64)
        if not len(start):
            continue
        first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1]))))
        count = np.diff(np.concatenate((first, [len(start)])))
        s, p, own = start[first], anchor[first], own[first]
        sub = hashes.of(1, s, s + count - 1 + window) + (p - s).astype(np.uint64) * np.uint64(window) + count.astype(np.uint64)
        shift = begin - texts.offsets[row + own]
        found.append((row + own, s + shift, count, p - s, keys[p].view(np.int64), mix(sub).view(np.int64)))
    names = ("row", "start", "count", "lead", "key", "sub")
    if not found:
        return {n: np.zeros(0, np.int64) for n in names}
    return dict(zip(names, (np.concatenate(parts) for parts in zip(*found))))


def grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of equal keys that each row is in, and the size of each group."""
    order = np.lexsort(keys[::-1])
    changed = np.zeros(len(order), bool)
    for key in keys:
        sorted_key = key[order]
        changed[1:] |= sorted_key[1:] != sorted_key[:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(changed)
    return number, np.bincount(number) if len(order) else np.zeros(0, np.int64)


def firsts(number: np.ndarray) -> np.ndarray:
    """One row of each group."""
    return np.unique(number, return_index=True)[1]


def anchored(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Intervals as rows ``key, sub, shared, owner, mark, place``; ``place`` is the start, and below it in 32 bits
    the lead (16) and the count (16), or the count alone where ``sub`` is null: known to be repeated."""
    names = ["key", "sub", "shared", "owner", "mark", "place"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64()]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = Texts(batch.column(2))
            x = intervals(texts, window, gram)
            if not len(x["row"]):
                continue
            owner, mark = (np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in (0, 1))
            pair, often = grouped(x["key"], x["sub"])
            twin = often[pair] > 1
            out = [[] for _ in names]

            def add(key, sub, shared, row, place):
                out[0].append(pa.array(key, pa.int64()))
                out[1].append(pa.nulls(len(key), pa.int64()) if sub is None else pa.array(sub, pa.int64()))
                out[2].append(pa.array(np.full(len(key), shared), pa.bool_()))
                for column, values in zip(out[3:], (owner[row], mark[row], place)):
                    column.append(pa.array(values))

            place = x["start"] << 32 | x["lead"] << 16 | x["count"]
            # Repeated inside the batch: one row stands for each kind, the places go out as runs.
            at = np.flatnonzero(twin)
            if len(at):
                row, start, count = x["row"][at], x["start"][at], x["count"][at]
                follows = (row[1:] == row[:-1]) & (start[1:] == start[:-1] + count[:-1])
                head = np.flatnonzero(np.concatenate(([True], ~follows)))
                run = start[head] << 32 | np.add.reduceat(count, head)
                add(mix((run + row[head] * 977).view(np.uint64)).view(np.int64), None, False, row[head], run)
            # The others go by their anchor, those of a common anchor by their bytes too.
            at = np.concatenate((np.flatnonzero(~twin), at[firsts(pair[at])]))
            group, often = grouped(x["key"][at])
            common = often[group] >= COMMON
            key, sub, row, place = x["key"][at], x["sub"][at], x["row"][at], place[at]
            apart = mix((key ^ (sub << 1)).view(np.uint64)).view(np.int64)
            add(apart[common], sub[common], True, row[common], place[common])
            one = np.flatnonzero(common)[firsts(group[common])]
            seen = np.concatenate((np.flatnonzero(~common), one))
            add(key[seen], sub[seen], False, row[seen], place[seen])
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(parts).cast(kind) for parts, kind in zip(out, kinds)], names
            )

    return docs.select("owner", "mark", "text").mapInArrow(
        find, "key long, sub long, shared boolean, owner long, mark int, place long"
    )


def judged(rows: DataFrame, keys: list[str], sub: str) -> DataFrame:
    """``rows`` with ``mixed`` (their key has several ``sub``), ``twin`` (another row has key and ``sub``) and
    ``first`` (the first row of its key and ``sub``)."""
    w = Window.partitionBy(*keys).orderBy(sub)
    before, after = F.lag(sub).over(w), F.lead(sub).over(w)
    same = lambda c: F.coalesce(c == F.col(sub), F.lit(False))
    group = Window.partitionBy(*keys)
    mixed = F.min(sub).over(group) != F.max(sub).over(group)
    return rows.withColumns({"mixed": mixed, "twin": same(before) | same(after), "first": ~same(before)})


def placed(rows: DataFrame) -> DataFrame:
    """The places of each document; equal rows of equal documents count once."""
    return rows.groupBy("owner", "mark").agg(F.collect_set("place").alias("places"))


def covered(places: list[int], window: int) -> list[tuple[int, int]]:
    """Merged byte ranges of windows, from places that are start and count."""
    merged: list[tuple[int, int]] = []
    for start, count in sorted((p >> 32, p & 0xFFFFFFFF) for p in places):
        end = start + count - 1 + window
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def kept_bytes(data: bytes, ranges: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for r in ranges for x in r), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def slots(open_docs: DataFrame, window: int, slot: int) -> DataFrame:
    """Slots of open intervals: ``core`` as two hashes, ``rim`` (bytes before the core, after it, and where they
    part), and the slot's first window as ``start``. Windows of a slot are one for each byte it has spare."""
    core_bytes = window - slot + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = Texts(batch.column("text"))
            data = texts.bytes.tobytes()
            owner, mark = batch.column("owner").to_pylist(), batch.column("mark").to_pylist()
            first, core, end, own = [], [], [], []
            for i, places in enumerate(batch.column("open").to_pylist()):
                shift = int(texts.offsets[i])
                for place in places:
                    start, lead, count = (place >> 32) + shift, place >> 16 & 0xFFFF, place & 0xFFFF
                    anchor = start + lead
                    for far in range((lead - count + 1) // slot * slot, lead + 1, slot):
                        a, b = min(far + slot - 1, lead), max(far, lead - count + 1)
                        first.append(anchor - a)
                        core.append(anchor - far)
                        end.append(anchor - b + window)
                        own.append(i)
            at = np.array(core, np.int64)
            core1, core2 = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            # Hashes over whole blocks of the batch; a core lies in one of the overlapping blocks.
            for lo in range(0, len(texts.bytes), CHUNK_BYTES):
                here = np.flatnonzero((at >= lo) & (at < lo + CHUNK_BYTES))
                if len(here):
                    hashes = Hashes(texts.bytes[lo:lo + CHUNK_BYTES + core_bytes])
                    f = at[here] - lo
                    core1[here] = hashes.of(0, f, f + core_bytes).view(np.int64)
                    core2[here] = hashes.of(1, f, f + core_bytes).view(np.int64)
            rims = [
                bytes((c - f,)) + data[f:c] + data[c + core_bytes:e] for f, c, e in zip(first, core, end)
            ]
            starts = np.array(first, np.int64) - texts.offsets[np.array(own, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(core1), pa.array(core2), pa.array(rims, pa.binary()),
                 pa.array([owner[i] for i in own], pa.int64()), pa.array([mark[i] for i in own], pa.int32()),
                 pa.array(starts, pa.int64())],
                ["core1", "core2", "rim", "owner", "mark", "start"],
            )

    return open_docs.select("owner", "mark", "text", "open").mapInArrow(
        cut, "core1 long, core2 long, rim binary, owner long, mark int, start long"
    )


def repeated_windows(groups: list[list[bytes]], slot: int) -> list[list[int]]:
    """For the different rims of each core, which of the slot's windows occur in another one of them.

    A rim's text is the bytes before the core, the core as one symbol of its own, the bytes after, and a border.
    Equal windows are equal strings of ``slot`` symbols, side by side in the suffix array.
    """
    text: list[int] = []
    owner, offset = [], []
    number = 0
    for core, rims in enumerate(groups):
        for rim in rims:
            before = rim[0]
            begin = len(text)
            text += [x + 1 for x in rim[1:1 + before]]
            text.append(257 + core)
            text += [x + 1 for x in rim[1 + before:]]
            windows = len(text) - begin - slot + 1
            owner += [number] * windows + [-1] * (slot - 1) + [-1]
            offset += [*range(windows)] + [0] * slot
            text.append(0)
            number += 1
    found: list[list[int]] = [[] for _ in range(number)]
    order = np.array(suffix_array(text), np.int64)
    whose = np.array(owner, np.int64)[order]
    order, whose = order[whose >= 0], whose[whose >= 0]
    symbols = np.array(text, np.int32)
    width = np.arange(slot)
    again = np.zeros(len(order), bool)
    if len(order) > 1:
        same = np.ones(len(order) - 1, bool)
        for k in width:
            same &= symbols[order[1:] + k] == symbols[order[:-1] + k]
        again[1:] |= same
        again[:-1] |= same
    starts = np.array(offset, np.int64)[order]
    for who, start in zip(whose[again].tolist(), starts[again].tolist()):
        found[who].append(start)
    return found


def runs(start: int, windows: list[int]) -> list[int]:
    """Places of windows that are given by their offsets from ``start``."""
    out: list[list[int]] = []
    for w in sorted(windows):
        if out and out[-1][1] == w:
            out[-1][1] = w + 1
        else:
            out.append([w, w + 1])
    return [start + a << 32 | b - a for a, b in out]


def matched(rows: DataFrame, slot: int, symbols: int) -> DataFrame:
    """``owner, mark, place`` of the repeated windows of slots. ``rows`` come sorted by core and rim, all slots of
    a core in one task; ``twin`` says that another slot has the same core and rim."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core = None
        groups: list[list[bytes]] = []
        single: list[list[tuple | None]] = []
        held = 0
        out: tuple[list, list, list] = ([], [], [])

        def put(owner, mark, place):
            out[0].append(owner)
            out[1].append(mark)
            out[2].append(place)

        def close():
            nonlocal held
            several = [k for k, rims in enumerate(groups) if len(rims) > 1]
            found = iter(repeated_windows([groups[k] for k in several], slot) if several else ())
            for k in several:
                for row, windows in zip(single[k], found):
                    if row is not None:
                        for place in runs(row[2], windows):
                            put(row[0], row[1], place)
            groups.clear()
            single.clear()
            held = 0

        def batch_out():
            columns = [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), pa.int64()))]
            for v in out:
                v.clear()
            return pa.RecordBatch.from_arrays(columns, ["owner", "mark", "place"])

        for batch in batches:
            for c1, c2, rim, owner, mark, start, twin in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if core != (c1, c2):
                    if held > symbols:
                        close()
                    core = (c1, c2)
                    groups.append([])
                    single.append([])
                if twin:
                    put(owner, mark, start << 32 | len(rim) - slot + 1)
                if not groups[-1] or groups[-1][-1] != rim:
                    groups[-1].append(rim)
                    single[-1].append(None if twin else (owner, mark, start))
                    held += len(rim) + 1
            yield batch_out()
        close()
        yield batch_out()

    columns = ["core1", "core2", "rim", "owner", "mark", "start", "twin"]
    return rows.select(*columns).mapInArrow(find, "owner long, mark int, place long")


def counted(rows: DataFrame, slot: int) -> DataFrame:
    """``owner, mark, place`` of the repeated windows of slots, found by counting the windows themselves."""
    before = F.conv(F.hex(F.substring("rim", 1, 1)), 16, 10).cast("int")
    skips = F.sequence(F.lit(0), F.length("rim") - slot)
    each = rows.withColumn("before", before).withColumn("skip", F.explode(skips)).select(
        "core1", "core2", (F.col("before") - F.col("skip")).alias("left"),
        F.substring("rim", F.col("skip") + 2, F.lit(slot - 1)).alias("bytes"),
        "owner", "mark", (F.shiftleft(F.col("start") + F.col("skip"), 32) + 1).alias("place"),
    )
    window = ["core1", "core2", "left", "bytes"]
    many = each.groupBy(*window).agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > 1)
    return each.join(many, window).select("owner", "mark", "place")


def open_places(open_docs: DataFrame, window: int, slot: int, most: int, symbols: int) -> DataFrame:
    """Places of the repeated windows of open intervals, by document."""
    rows = materialize(slots(open_docs, window, slot))
    core = ["core1", "core2"]
    crowded = rows.groupBy(*core).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(*core)
    crowded = materialize(crowded)
    few = rows if crowded.isEmpty() else rows.join(crowded, core, "left_anti")
    found = matched(judged(few, core, "rim").where("mixed or twin"), slot, symbols)
    if few is not rows:
        found = found.unionByName(counted(rows.join(crowded, core, "left_semi"), slot))
    return placed(found)


def resolve(
    docs: DataFrame, places: list[str], window: int, rest: T.DataType | None, keep: bool, partial: bool
) -> DataFrame:
    """What is left of each document without the bytes of ``places`` columns. With ``partial`` documents with open
    places keep their text and places for later instead."""
    kinds = ["doc_id", *(["rest"] if rest else [])]
    found = T.StructType.fromDDL(
        "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep
    )
    later = T.StructType.fromDDL("owner long, mark int, text string, known array<long>, open array<long>")
    first = [T.StructField(k, t) for k, t in zip(kinds, (T.LongType(), rest))]
    schema = T.StructType([*first, *found, *(later if partial else [])])
    names = schema.fieldNames()
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out: list[list] = [[] for _ in found]
            lists = [batch.column(c).to_pylist() for c in places]
            waits = batch.column("open").is_valid() if partial else pa.array([False] * batch.num_rows)
            for text, wait, *held in zip(batch.column("text").to_pylist(), waits.to_pylist(), *lists, strict=True):
                if wait:
                    for v in out:
                        v.append(None)
                    continue
                data = text.encode()
                ranges = covered([p for one in held for p in one or ()], window)
                left = kept_bytes(data, ranges)
                values = (len(data), len(data) - len(left), len(ranges), hashlib.sha256(left).hexdigest(), left)
                for v, value in zip(out, values):
                    v.append(value)
            columns = [batch.column(k) for k in kinds]
            columns += [pa.array(v, t) for v, t in zip(out, types)]
            if partial:
                gone = pa.nulls(batch.num_rows, pa.string())
                text = batch.column("text").cast(pa.string())
                columns += [batch.column("owner"), batch.column("mark"), pc.if_else(waits, text, gone)]
                columns += [batch.column("known"), batch.column("open")]
            yield pa.RecordBatch.from_arrays(columns, names)

    needed = [*kinds, "text", *places, *(["owner", "mark", "open"] if partial else [])]
    return docs.select(*needed).mapInArrow(run, schema)


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    slot: int = SLOT,
    most_slots: int = SLOTS,
    symbols: int = SYMBOLS,
    keep: bool = True,
) -> DataFrame:
    """``doc_id``, the other columns without ``text``, and ``n_bytes, n_removed, n_spans, kept_sha256``; with
    ``keep`` the remaining bytes as ``kept`` (a cut may fall inside a character). Other columns named like an
    added one are replaced. Intermediate tables go to the shared folder.
    """
    if not slot <= window - gram + 1 <= 2**15 or gram < 1:
        raise ValueError("a slot has to fit into the starts of an interval")
    added = {"doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"}
    others = [c for c in docs.columns if c.lower() not in added]
    rest = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in others])
    text = F.coalesce("text", F.lit(""))
    held = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *([rest.alias("rest")] if others else []),
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("owner"), F.hash(text).alias("mark"),
    )
    kind = held.schema["rest"].dataType if others else None

    rows = judged(anchored(held, window, gram), ["key"], "sub")
    place, count = F.shiftright("place", 32), F.col("place").bitwiseAND(0xFFFF)
    known = F.when(F.col("sub").isNull(), F.col("place")).when(F.col("twin"), F.shiftleft(place, 32) + count)
    # Of equal intervals one stands for all where others of the anchor differ from them.
    opened = F.when(F.col("sub").isNotNull() & F.col("first") & (F.col("shared") | F.col("mixed")), F.col("place"))
    by_doc = rows.withColumns({"known": known, "opened": opened}).where("known is not null or opened is not null")
    by_doc = by_doc.groupBy("owner", "mark").agg(
        F.collect_set("known").alias("known"), F.collect_set("opened").alias("open")
    ).withColumn("open", F.when(F.size("open") > 0, F.col("open")))

    first = materialize(resolve(held.join(by_doc, ["owner", "mark"], "left"), ["known"], window, kind, keep, True))
    waiting = first.where("open is not null")
    more = open_places(waiting, window, slot, most_slots, symbols)
    second = resolve(waiting.join(more, ["owner", "mark"], "left"), ["known", "places"], window, kind, keep, False)
    out = first.where("open is null").select(second.columns).unionByName(second)
    return out.select("doc_id", *(["rest.*"] if others else []), *[c for c in out.columns if c not in ("doc_id", "rest")])
