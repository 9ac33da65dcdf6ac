"""Aligns the tokens of two tokenizers: smallest groups with common borders, and links of overlapping tokens.

A byte-level vocabulary (A) reads a space and the text, a piece vocabulary (B) the text, to which it adds the
space itself. The cumulative byte ends of both are dictionaries from end to index; ends that are in both, sorted,
cut the two id lists into groups, and links are expanded group by group.

Both tokenizers always end a token where a space follows something that is not white space, and neither looks
across: A's words begin there, and no piece of B holds a space after another character (checked when the
vocabulary is read). Stretches between such borders are aligned once and remembered in a bounded table.

Texts that are null, empty, or that a vocabulary changes (its bytes differ from space and text) have no tokens.
Rows that repeat a ``doc_id``, or lack one, are documents of their own and count each for itself.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dryspell.lineage import materialize
from dryspell.llm.packing import _PLAIN
from dryspell.llm.words import pieces

#: Stretches after which a Python worker forgets the older ones, the longest text of those it keeps, and how many
#: new ones are encoded in one text.
REMEMBERED, LONGEST, TOGETHER = 150_000, 64, 10_000
#: Id pairs that are broadcast with their counts: the commonest ones, at most so many rows of 17 bytes.
BROADCAST_PAIRS = 200_000

_BORDER = re.compile(r"(?<=\S)(?= )")
_LOOSE = re.compile(r"\s ")
_PIECE_ACROSS = re.compile("[^▁]▁")


class Aligned(NamedTuple):
    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: tuple[int, ...]


NOTHING = Aligned(0, 0, 0, "", ())


def ends_of(ids: list[int], lengths: list[int], borders: Sequence[int]) -> dict[int, int] | None:
    """From cumulative byte end to the index behind its token; nothing where a border is no end."""
    ends = list(accumulate(map(lengths.__getitem__, ids)))
    found = dict(zip(ends, range(1, len(ends) + 1)))
    return found if found.keys() >= set(borders) else None


def align(
    a: list[int], b: list[int], a_lengths: list[int], b_lengths: list[int], borders: Sequence[int]
) -> list[tuple] | None:
    """Groups and links of two id lists over the same bytes, for each stretch that ends at one of ``borders``
    (byte ends in order, the last that of all), as the fields of :class:`Aligned`. Nothing where a token crosses
    a border. A link is ``a << 32 | b``."""
    a_ends, b_ends = ends_of(a, a_lengths, borders), ends_of(b, b_lengths, borders)
    if a_ends is None or b_ends is None:
        return None
    a_text, b_text = list(map(str, a)), list(map(str, b))
    found, groups, links = [], [], []
    i = j = from_i = from_j = 0
    last = iter(borders)
    border = next(last)
    for common in sorted(a_ends.keys() & b_ends.keys()):
        to_i, to_j = a_ends[common], b_ends[common]
        if to_i == i + 1 and to_j == j + 1:
            groups.append(a_text[i] + "|" + b_text[j])
            links.append(a[i] << 32 | b[j])
        else:
            ours, theirs = a[i:to_i], b[j:to_j]
            groups.append(",".join(a_text[i:to_i]) + "|" + ",".join(b_text[j:to_j]))
            if to_i == i + 1:
                first = ours[0] << 32
                links += [first | y for y in theirs]
            elif to_j == j + 1:
                second = theirs[0]
                links += [x << 32 | second for x in ours]
            else:
                links += overlaps(ours, theirs, a_lengths, b_lengths)
        i, j = to_i, to_j
        if common == border:
            found.append((i - from_i, j - from_j, len(groups), ";".join(groups), tuple(links)))
            groups, links = [], []
            from_i, from_j, border = i, j, next(last, None)
    return found


def overlaps(a: list[int], b: list[int], a_lengths: list[int], b_lengths: list[int]) -> list[int]:
    """The links inside one group: the token that ends first gives way to the next of its list."""
    found = []
    i = j = 0
    a_end, b_end = a_lengths[a[0]], b_lengths[b[0]]
    while True:
        found.append(a[i] << 32 | b[j])
        step_a, step_b = a_end <= b_end, b_end <= a_end
        if step_a:
            i += 1
            if i == len(a):
                return found
            a_end += a_lengths[a[i]]
        if step_b:
            j += 1
            b_end += b_lengths[b[j]]


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the
    others counted up from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in set(shown)]
    return {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(hidden)}


class Aligner:
    """Both tokenizers, and what stretches of text gave."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(a_path)
        self.slow.encode_special_tokens = True
        self.fast = self._ranks(a_path)
        letters = byte_alphabet()
        entries = {i: t for t, i in self.slow.get_vocab(with_added_tokens=True).items()}
        added = {i: t.content for i, t in self.slow.get_added_tokens_decoder().items()}
        self.a_bytes = [
            added[i].encode() if i in added else bytes(letters[c] for c in entries.get(i, ""))
            for i in range(max(entries) + 1)
        ]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(names)
        ]
        self.a_lengths, self.b_lengths = list(map(len, self.a_bytes)), list(map(len, self.b_bytes))
        self.space = [names.index("▁")] if "▁" in names else None
        self.cut = self.space is not None and not any(_PIECE_ACROSS.search(p) for p in names)
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    @staticmethod
    def _ranks(a_path: str):
        import base64
        import os

        import public_tokenizers
        import tiktoken

        path = re.sub(r"\.json$", ".tiktoken", a_path)
        if not os.path.exists(path):
            return None
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, text: str) -> list[int]:
        if self.fast is None or _PLAIN.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def together(self, parts: list[str]) -> list[tuple] | None:
        """Stretches one after the other in one text; nothing where a vocabulary changes their bytes."""
        text = "".join([f" {part}" for part in parts])
        data = text.encode()
        a = self.encode_a(text)
        b = self.b.encode(text[1:]) if len(text) > 1 else self.space or []
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        borders = list(accumulate([len(part.encode()) + 1 for part in parts]))
        return align(a, b, self.a_lengths, self.b_lengths, borders)

    def whole(self, text: str) -> Aligned | None:
        """A text without any cut; nothing where a vocabulary changes its bytes."""
        found = self.together([text])
        return Aligned(*found[0]) if found else None

    def each(self, parts: list[str]) -> list[tuple | None]:
        """Stretches that end in something other than white space; those that fail are found by halving."""
        found = self.together(parts) if parts else []
        if found is not None:
            return found
        if len(parts) == 1:
            return [None]
        half = len(parts) // 2
        return self.each(parts[:half]) + self.each(parts[half:])

    def learn(self, parts: set[str]) -> dict[str, tuple | None]:
        """What these stretches give. New ones are remembered, the oldest half of many is forgotten."""
        new = parts - self.known.keys()
        again = {p: self.older[p] for p in new if p in self.older}
        new -= again.keys()
        joined = [p for p in new if p and not p[-1].isspace()]
        found = {}
        for k in range(0, len(joined), TOGETHER):
            found.update(zip(joined[k:k + TOGETHER], self.each(joined[k:k + TOGETHER])))
        for part in new - found.keys():
            found[part] = self.whole(part)
        self.known.update(again)
        self.known.update(found)
        needed = self.known
        if len(self.known) > REMEMBERED:
            self.older = {p: x for p, x in self.known.items() if len(p) <= LONGEST}
            self.known = {}
        return needed

    def stretches(self, text: str) -> list[str]:
        """The stretches of space and text, without the space that each begins with."""
        if not self.cut:
            return [text]
        if _LOOSE.search(f" {text}"):
            return [x[1:] for x in _BORDER.split(f" {text}")]
        return text.split(" ")

    def documents(self, texts: list[str | None]) -> Iterator[tuple[Aligned, Counter]]:
        """Each text aligned as a whole, with its links counted. Texts without tokens give nothing."""
        cut = [self.stretches(text) if text else [] for text in texts]
        known = self.learn(set(chain.from_iterable(cut)))
        for text, parts in zip(texts, cut):
            rows = list(map(known.__getitem__, parts))
            if None in rows:
                rows = [self.whole(text) or NOTHING]
            if not rows:
                rows = [NOTHING]
            n_a, n_b, n_groups, groups, links = zip(*rows)
            yield (
                Aligned(sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), ()), Counter(chain.from_iterable(links))
            )


@functools.cache
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def aligned(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """One row a document: ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256``, its distinct links with how
    often they occur (``links``), and the groups as text if asked for."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "groups"][:7 + with_groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        for batch in pieces(batches):
            counts, digests, groups, link, times, ends = [], [], [], [], [], [0]
            for whole, links in both.documents(batch.column(1).to_pylist()):
                counts.append((*whole[:3], links.total()))
                digests.append(hashlib.sha256(whole.groups.encode()).hexdigest() if whole.n_groups else "")
                if with_groups:
                    groups.append(whole.groups)
                link += links.keys()
                times += links.values()
                ends.append(len(link))
            rows = pa.StructArray.from_arrays(
                [pa.array(link, pa.int64()), pa.array(times, pa.int32())], ["link", "times"]
            )
            numbers = np.array(counts, np.int64).reshape(-1, 4).T
            columns = [batch.column(0), *map(pa.array, numbers), pa.array(digests, pa.string())]
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows))
            if with_groups:
                columns.append(pa.array(groups, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "links array<struct<link long, times int>>" + ", groups string" * with_groups
    )
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``link, a_id, b_id, n_docs, best``: how many documents hold each id pair linked, and whether that is
    the most of its A id. At most one row for each pair of the two vocabularies."""
    counts = rows.select(F.inline("links")).groupBy("link").agg(F.count(F.lit(1)).alias("n_docs"))
    a_id, b_id = F.shiftright("link", 32).cast("int"), F.col("link").bitwiseAND(0xFFFFFFFF).cast("int")
    most = F.max("n_docs").over(Window.partitionBy("a_id"))  # one row for each B id at most
    return counts.select("link", a_id.alias("a_id"), b_id.alias("b_id"), "n_docs").withColumn(
        "best", F.col("n_docs") == most
    )


def score(docs: DataFrame, a_path: str, b_path: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """:func:`aligned` without its links, with ``n_best`` (links whose pair is the best of its A id) and
    ``count_sum`` (documents of the pair, summed over links).

    The commonest ``broadcast_pairs`` pairs are broadcast, so that hot pairs never meet in one task; links of
    rarer pairs, if there are any, are joined by shuffle. Rows and pairs are written to the shared folder.
    """
    rows = materialize(aligned(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id()))
    counts = materialize(pair_counts(rows).select("link", "n_docs", "best"))
    links = rows.select("row", F.inline("links"))

    def sums(met: DataFrame) -> DataFrame:
        return met.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"),
        )

    if counts.count() <= broadcast_pairs:
        summed = sums(links.join(F.broadcast(counts), "link"))
    else:
        common = materialize(counts.orderBy(F.desc("n_docs"), "link").limit(broadcast_pairs))
        rare = counts.join(F.broadcast(common), "link", "left_anti")
        met = links.join(F.broadcast(common), "link", "left")
        rest = met.where(F.col("n_docs").isNull()).select("row", "link", "times").join(rare, "link")
        both = sums(met.where(F.col("n_docs").isNotNull())).unionByName(sums(rest))
        summed = both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.drop("links").join(summed, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
