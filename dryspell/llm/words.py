"""Words, shingles and lines of whole texts, computed on Arrow buffers inside tasks.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``. Words are hashed to 64 bits; a text is
worked on in pieces of a few MB that end at white space, so memory follows the number of words of the
texts at hand, never the number of rows of a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240117))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POSITION = _rng.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        table = np.cumprod(steps)
        if len(table) > 2 * CHUNK_BYTES:
            return table
        _powers[base] = table
    return _powers[base]


class Texts:
    """Some rows' texts as one byte array. ``offsets[i]:offsets[i + 1]`` are the bytes of row ``i``."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
        offsets = offsets[column.offset:column.offset + len(column) + 1]
        data = column.buffers()[2]
        data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
        self.bytes = data[offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]

    def __len__(self) -> int:
        return len(self.offsets) - 1


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``CHUNK_BYTES`` of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(Texts(batch.column(column)).offsets)
        ends = np.cumsum(sizes + 64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            upto = max(int(np.searchsorted(ends, before + CHUNK_BYTES, side="right")), at + 1)
            yield batch.slice(at, upto - at)
            at = upto


def spans(texts: Texts, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end byte of every word. No word crosses a row, or one of ``cuts``."""
    if not len(texts.bytes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~WHITE[texts.bytes]
    edge = np.zeros(len(solid) + 1, bool)
    edge[texts.offsets] = True
    if cuts is not None:
        edge[cuts] = True
    before = np.concatenate(([False], solid[:-1])) & ~edge[:-1]
    after = np.concatenate((solid[1:], [False])) & ~edge[1:]
    return np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1


def hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hashes of the byte ranges, which are in order and do not overlap."""
    out = np.zeros(len(first), np.uint64)
    at = 0
    while at < len(first):
        origin = first[at]
        upto = max(int(np.searchsorted(end, origin + CHUNK_BYTES, side="right")), at + 1)
        part = data[origin:end[upto - 1]]
        values = _BYTE[LOWER[part] if lower else part]
        values *= powers(_BASE, len(part))[:len(part)]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values)))
        f, e = first[at:upto] - origin, end[at:upto] - origin
        out[at:upto] = (sums[e] - sums[f]) * powers(_INVERSE, len(part))[f]
        at = upto
    return mix(out + (end - first).astype(np.uint64))


class Words:
    """The words of some texts: ``doc`` is the row, ``first`` and ``end`` the bytes, ``hash`` 64 bits."""

    def __init__(self, texts: Texts, lower: bool):
        self.texts = texts
        self.first, self.end = spans(texts)
        self.hash = hashes(texts.bytes, self.first, self.end, lower)
        self.doc = np.searchsorted(texts.offsets, self.first, side="right") - 1
        self.bounds = np.searchsorted(self.doc, np.arange(len(texts) + 1))


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Position of the first word and hash of every run of ``n`` words inside one text."""
    last = len(words.hash) - n + 1
    if last <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(last, np.uint64)
    for k in range(n):
        total += words.hash[k:k + last] * _POSITION[k]
    at = np.flatnonzero(words.doc[:last] == words.doc[n - 1:])
    return at, mix(total[at])


def shingle_sets(texts: Texts, n: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``n`` lower-cased words; the whole sequence if it has fewer."""
    words = Words(texts, lower=True)
    at, h = grams(words, n)
    bounds = np.searchsorted(at, words.bounds)
    out = []
    for i in range(len(texts)):
        f, e = words.bounds[i], words.bounds[i + 1]
        if e - f >= n:
            own = np.sort(h[bounds[i]:bounds[i + 1]])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif e > f:
            short = words.hash[f:e]
            total = (short * _POSITION[:e - f]).sum(dtype=np.uint64) + np.uint64((e - f) * 7919)
            out.append(mix(np.array([total], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
